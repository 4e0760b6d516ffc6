"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from reefcensus.functions.text import (  # noqa: F401
    canonical_text,
    glue,
    na_text,
    strip_repair_suffix,
)
from reefcensus.functions.dates import parse_day_first, parse_iso_date, season  # noqa: F401
from reefcensus.functions.labels import (  # noqa: F401
    deployment_key,
    group_flag,
    layer_letter,
    quadrat_id,
    survey_id,
    transect_id,
)
