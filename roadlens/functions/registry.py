"""SQL names for the scalar helpers, as session-scoped SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from roadlens.functions.columns import FLOW_LEVELS, FLOW_THRESHOLDS, SPEED_BANDS, TIME_PATTERN

_levels = " ".join(f"WHEN n > {limit} THEN '{name}'" for name, limit in zip(FLOW_LEVELS, FLOW_THRESHOLDS))
_bands = " ".join(f"WHEN n >= {lower} THEN '{name}'" for name, lower in reversed(SPEED_BANDS))

# The SQL function names and argument lists that existing queries call.
_FUNCTIONS = (
    "concat_String_string(a STRING, b STRING, sep STRING) RETURNS STRING RETURN concat(a, sep, b)",
    "random_prefix(s STRING, n INT) RETURNS STRING NOT DETERMINISTIC "
    "RETURN concat(CAST(floor(rand(7) * n) AS INT), '_', s)",
    "remove_random_prefix(s STRING) RETURNS STRING RETURN substring(s, instr(s, '_') + 1)",
    "safe_int(s STRING) RETURNS INT RETURN CASE WHEN s RLIKE '^[+-]?[0-9]+$' THEN try_cast(s AS INT) END",
    "zero_pad(s STRING, n INT) RETURNS STRING RETURN CASE WHEN length(s) < n THEN lpad(s, n, '0') ELSE s END",
    f"date_hour(t STRING) RETURNS STRING RETURN CASE WHEN t RLIKE '{TIME_PATTERN}' "
    "AND try_cast(substring_index(t, ' ', 1) AS DATE) IS NOT NULL THEN concat("
    f"regexp_extract(t, '{TIME_PATTERN}', 1), '_', regexp_extract(t, '{TIME_PATTERN}', 2)) END",
    f"flow_level(n BIGINT) RETURNS STRING RETURN CASE {_levels} ELSE '{FLOW_LEVELS[-1]}' END",
    f"speed_band(n INT) RETURNS STRING RETURN CASE {_bands} END",
)


def register(spark: SparkSession) -> None:
    """Make the helpers callable from spark.sql.

    The frequency map of checkpoints has no SQL name: a SQL function cannot aggregate over a group, and a Python
    aggregate would pull a whole group into one worker. Use operators.areas.area_road_flow.
    """
    for body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
