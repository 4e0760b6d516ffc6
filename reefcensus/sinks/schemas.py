"""Schema register of a stored table: the union of the columns of all writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: folder beside the partitions; Spark's readers pass over it
REGISTER = "_schemas"
#: (stored, new) types that a wider one can hold, also when files keep the narrower
WIDER = {("int", "bigint"): T.LongType(), ("int", "double"): T.DoubleType(), ("float", "double"): T.DoubleType()}


class SchemaConflict(ValueError):
    """A column comes with a type that the stored table cannot take."""


def _plain(t: T.DataType) -> T.DataType:
    """The type with every part nullable."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_plain(t.keyType), _plain(t.valueType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in t])
    return t


def union_schema(stored: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both by name (letter case aside, the stored spelling wins);
    new ones come last. A column of two types becomes the wider one where
    files of the narrower can be read as it."""
    out = {f.name.lower(): T.StructField(f.name, _plain(f.dataType)) for f in stored}
    for f in new:
        old, kind = out.get(f.name.lower()), _plain(f.dataType)
        if old is None:
            out[f.name.lower()] = T.StructField(f.name, kind)
        elif old.dataType != kind:
            pair = old.dataType.simpleString(), kind.simpleString()
            wide = WIDER.get(pair) or WIDER.get(pair[::-1])
            if wide is None:
                raise SchemaConflict(f"column {old.name}: stored as {pair[0]}, now {pair[1]}")
            out[f.name.lower()] = T.StructField(old.name, wide)
    return T.StructType(list(out.values()))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def registered_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The union of what all writes to ``path`` have registered, or nothing
    for a table that was written by other means."""
    at = f"{path.rstrip('/')}/{REGISTER}"
    folder, fs = _folder(spark, at)
    if not fs.exists(folder):
        return None
    # a line per write that changed the schema
    lines = sorted((r["at"], r["schema"]) for r in spark.read.schema("at long, schema string").json(at).collect())
    out = T.StructType()
    for _, text in lines:
        out = union_schema(out, T._parse_datatype_json_string(text))
    return out


def register(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Adds the columns of ``schema`` to the table's register; the union. Two
    writers at once both leave their line, so neither's columns are lost."""
    known = registered_schema(spark, path)
    union = union_schema(known or T.StructType(), schema)
    if union != known:
        line = spark.range(1).select(F.lit(len(known or [])).cast("long").alias("at"), F.lit(union.json()).alias("schema"))
        line.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{REGISTER}")
    return union


def as_registered(df: DataFrame, union: T.StructType) -> DataFrame:
    """``df`` with the names and types that the register has for its columns."""
    known = {f.name.lower(): f for f in union}
    fields = [known[c.lower()] for c in df.columns]
    return df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(df.columns, fields)])
