import hashlib
import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.labels import band, surrogate_key
from tidemark.functions.numbers import clamp_round, finite_frame, improvement_pct, round_half_away, round_half_away_sql
from tidemark.plans import defaults as D


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=300), st.sampled_from([1, 2]))
def test_half_way_cases_round_away_from_zero(spark, thousandths, digits):
    rows = spark.createDataFrame([(i, n / 1000) for i, n in enumerate(thousandths)], "i int, x double")
    sql = F.expr(round_half_away_sql("x", digits))
    got = rows.select("i", round_half_away("x", digits).alias("r"), sql.alias("q")).orderBy("i").collect()
    step = Decimal(1).scaleb(-digits)
    for n, row in zip(thousandths, got):
        assert row.r == row.q == float((Decimal(n) / 1000).quantize(step, ROUND_HALF_UP))


def test_rounding_ignores_summation_noise(spark):
    """0.1 + 0.2 style noise on either side of a half-way case gives one answer."""
    rows = spark.createDataFrame([(1.005,), (1.00499999999999989,), (1.0050000000000003,)], "x double")
    assert {r[0] for r in rows.select(round_half_away("x", 2)).collect()} == {1.01}


def test_rounding_keeps_large_values_and_missing_ones(spark):
    rows = spark.createDataFrame([(1.0e17,), (None,), (float("nan"),)], "x double")
    big, missing, nan = [r[0] for r in rows.select(round_half_away("x", 2)).collect()]
    assert big == 1.0e17 and missing is None and math.isnan(nan)


def test_published_keys(spark):
    """Keys of published rows, so joins with stored data keep working."""
    got = spark.sql("SELECT 'ahmedabad' AS city, DATE '2026-11-27' AS d, 'kolkata' AS k").select(
        surrogate_key("city"), surrogate_key("k", "d")
    ).first()
    assert got[0] == "a4c92d499541677f0a88f619278a7d77"
    assert got[1] == "388db89a7d92b8dfea951022e1963772"
    assert got[1] == hashlib.md5(b"kolkata_2026-11-27").hexdigest()


def test_surrogate_key_is_null_with_a_null_part(spark):
    assert spark.sql("SELECT 'a' AS x, CAST(NULL AS STRING) AS y").select(surrogate_key("x", "y")).first()[0] is None


@pytest.mark.parametrize(
    "value,label",
    [
        (220.2, "Very Unhealthy"), (140.7, "Unhealthy for Sensitive Groups"), (73.9, "Moderate"), (38.8, "Good"),
        (50.0, "Good"), (50.1, "Moderate"), (300.0, "Very Unhealthy"), (300.1, "Hazardous"), (None, "Hazardous"),
    ],
)
def test_category_bands(spark, value, label):
    row = spark.createDataFrame([(value,)], "v double")
    assert row.select(band("v", D.AQI_CUTS, D.AQI_TOP)).first()[0] == label


def test_clamp_and_improvement(spark):
    rows = spark.createDataFrame([(-3.0,), (510.0,), (12.34,), (None,)], "v double")
    assert [r[0] for r in rows.select(clamp_round("v")).collect()] == [0.0, 500.0, 12.3, None]
    gain = spark.createDataFrame([(16.45, 9.69), (0.0, 0.0)], "b double, m double").select(improvement_pct("b", "m"))
    assert [r[0] for r in gain.collect()] == [41.1, 0.0]


def test_finite_frame_reaches_nested_values(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(float("nan"), [1.0, -inf], (2.0, [inf]), {"a": float("nan")})],
        "x double, xs array<double>, s struct<y: double, ys: array<double>>, m map<string, double>",
    )
    row = finite_frame(df).first()
    assert row.x is None and row.xs == [1.0, None] and row.s.y == 2.0 and row.s.ys == [None] and row.m == {"a": None}
