from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from roadlens.functions import columns as c
from roadlens.functions.registry import register


def values(spark, expr, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_range_label(spark):
    times = ["2024-01-05 12:03:00", "2024-01-05 12:57:00", "2024-01-05 09:55:00", "2024-01-05 23:58:00"]
    day = "2024-01-05 "
    want = [("12:00", "12:05"), ("12:55", "13:00"), ("09:55", "10:00"), ("23:55", "24:00")]
    assert values(spark, c.range_label, times) == [f"{day}{a}~{day}{b}" for a, b in want]


def test_lenient_time(spark):
    times = ["2024-01-05 26:10:00", "2024-01-05 00:00:01", "2024-1-5 0:0:1", "nonsense", None]
    as_text = lambda v: F.date_format(c.lenient_ts(v), "yyyy-MM-dd HH:mm:ss")
    assert values(spark, as_text, times) == ["2024-01-06 02:10:00", "2024-01-05 00:00:01", "2024-01-05 00:00:01", None, None]
    seconds = values(spark, c.lenient_seconds, times)
    assert seconds[0] - seconds[1] == 26 * 3600 + 600 - 1 and seconds[2:] == [seconds[1], None, None]
    assert values(spark, c.date_hour, times[:1]) == ["2024-01-05_26"]


def test_zero_pad_keeps_long_text(spark):
    assert values(spark, lambda v: c.zero_pad(v, 5), ["7", "123456", None]) == ["00007", "123456", None]


def test_flow_level(spark):
    assert values(spark, c.flow_level, [150, 151, 160, 161, 170, 171], "long") == [
        f"{x} LEVEL" for x in "DCCBBA"
    ]


def test_speed_band(spark):
    speeds = [-1, 0, 59, 60, 89, 90, 119, 120, None]
    want = [None, "low", "low", "normal", "normal", "medium", "medium", "high", None]
    assert values(spark, c.speed_band, speeds, "int") == want


def test_safe_int(spark):
    assert values(spark, c.safe_int, ["12", "-3", "x", "", " 1", "99999999999", None]) == [12, -3, *[None] * 5]


def test_concat_fields(spark):
    texts = ["a=|b=2|b=3|c=4=5|d=6=", "name=x|age=19", "rename=y", None]
    assert values(spark, lambda v: c.field_from_concat(v, "b"), texts) == ["2", None, None, None]
    assert values(spark, lambda v: c.field_from_concat(v, "name"), texts) == [None, "x", None, None]
    assert values(spark, lambda v: c.field_from_concat(v, "c"), texts)[0] is None
    assert values(spark, c.map_from_concat, texts)[:2] == [{"b": "3", "d": "6"}, {"name": "x", "age": "19"}]


def test_unit_half_up_is_exact(spark):
    pairs = [(p, q) for q in (1, 2, 3, 7, 8, 29, 40, 200, 1000, 9973) for p in range(0, q + 1, max(1, q // 400))]
    pairs += [(1, 10**12), (5, 1000), (10**12 - 1, 10**12)]
    ratios = [p / q for p, q in pairs]
    want = [float(Decimal(r).quantize(Decimal("0.01"), ROUND_HALF_UP)) for r in ratios]
    assert values(spark, c.unit_half_up, ratios, "double") == want


def test_first_param(spark):
    docs = ['{"startDate":["a","b"],"cars":[]}', "{}", None]
    assert values(spark, lambda v: c.first_element(c.params_map(v), "startDate"), docs) == ["a", None, None]
    assert values(spark, lambda v: c.first_element(c.params_map(v), "cars"), docs) == [None, None, None]


@pytest.mark.parametrize(
    "call, want",
    [
        ("concat_String_string('a','b',':')", "a:b"),
        ("remove_random_prefix('3_x_y')", "x_y"),
        ("remove_random_prefix(random_prefix('road', 10))", "road"),
        ("safe_int('x')", None),
        ("zero_pad('7', 2)", "07"),
        ("date_hour('2024-01-05 26:10:00')", "2024-01-05_26"),
        ("flow_level(161)", "B LEVEL"),
        ("speed_band(120)", "high"),
    ],
)
def test_sql_functions(spark, call, want):
    register(spark)
    assert spark.sql(f"SELECT {call}").first()[0] == want


def test_malformed_times_are_null_to_every_helper(spark):
    bad = ["2024-01-05 12:30", "2024-01-05 12", "2024-01-05 99:99:99", "2024-01-05", "2024-01-05T12:30:00", "2024-13-05 10:00:00", "2024-01-05 10:60:00", ""]
    for helper in (c.day_text, c.hour_text, c.date_hour, c.range_label, c.lenient_seconds, lambda v: c.lenient_ts(v).cast("string")):
        assert values(spark, helper, bad) == [None] * len(bad)
    register(spark)
    assert values(spark, lambda v: F.call_function("date_hour", v), [*bad, "2024-01-05 26:00:00"])[-2:] == [None, "2024-01-05_26"]
    assert values(spark, lambda v: F.call_function("safe_int", v), [" 12 ", "12"]) == [None, 12]
