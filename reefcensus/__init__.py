"""reefcensus: field-survey data on Spark.

Modules, from raw files to analysis tables:

* ``registry``   fixed values of the survey protocol (families, patterns,
                 block coordinates, layouts)
* ``functions``  Column expressions (NA text, canonical values, dates, keys)
* ``sources``    scans: plan CSVs, worksheet grids, lookups, stored tables
* ``operators``  DataFrame -> DataFrame steps (cleaning, checks, grid
                 reshapes, cover, traits, surveyors, day tables, joins)
* ``sinks``      writers with dynamic partition overwrite
* ``plans``      end-to-end flows, and the operator queries on the
                 benchmark tables with their DuckDB SQL
* ``streaming``  incremental day builds as a Structured Streaming job
* ``session``    session defaults and the shared checkpoint folder
"""
