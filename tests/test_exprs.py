import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnmart import constants as C
from churnmart.functions import exprs as E


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")


def evaluate(df, expr):
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("bands", [C.CREDIT_TIERS, C.AGE_GROUPS, C.TENURE_BANDS, C.RISK_CATEGORIES])
def test_bands_are_right_closed_and_null_outside(spark, bands):
    values = [None, -2.0, -1.0, 900.5, 1e9]
    for edge in bands.edges:
        values += [edge - 0.5, float(edge), edge + 0.5]
    got = evaluate(column(spark, values, "DOUBLE"), E.bin_label(F.col("x"), bands))
    want = pd.cut(pd.Series(values, dtype="float"), bins=list(bands.edges), labels=list(bands.labels))
    assert got == [None if pd.isna(w) else w for w in want]


def test_tenure_zero_has_a_band_only_on_request(spark):
    df = column(spark, [0, 2, 3], "INT")
    assert evaluate(df, E.bin_label(F.col("x"), C.TENURE_BANDS))[0] is None
    assert evaluate(df, E.bin_label(F.col("x"), C.TENURE_BANDS, include_lowest=True)) == [
        "New (0-2 yrs)", "New (0-2 yrs)", "Growing (3-5 yrs)",
    ]


def test_strip_and_title_case_match_python(spark):
    values = ["\t o'brien smith-jones \n", "MIDDLE EAST", "x1y z", "", None, "éclair d'ÉTÉ", "a  b"]
    got = evaluate(column(spark, values, "STRING"), E.title_case(E.strip_ws(F.col("x"))))
    assert got == [None if v is None else v.strip().title() for v in values]


def test_round_even_matches_numpy_also_on_ties(spark):
    values = [0.125, 0.375, 2.5, 3.5, -2.5, 1.005, 12.345, 1208.5605, 0.045, None]
    values += [float(v) for v in np.random.default_rng(3).uniform(-1e6, 1e6, 500)]
    for digits in (0, 1, 2, 4):
        got = evaluate(column(spark, values, "DOUBLE"), E.round_even(F.col("x"), digits))
        want = [None if v is None else float(np.round(v, digits)) for v in values]
        assert got == want


def test_clip_keeps_null(spark):
    df = column(spark, [None, -5, 5, 50], "INT")
    assert evaluate(df, E.clip(F.col("x"), 0, 10)) == [None, 0, 5, 10]


def test_rates_round_half_up_and_survive_an_empty_whole(spark):
    df = column(spark, [1, 1, 2, 0], "INT")
    assert evaluate(df, E.rate_pct(F.col("x"), F.lit(800))) == [0.13, 0.13, 0.25, 0.0]
    assert evaluate(df, E.rate_pct(F.col("x"), F.lit(0))) == [None] * 4
    assert evaluate(df, E.share_pct(F.col("x"), F.lit(0), 1)) == [None] * 4


def test_map_label_unknown_is_null(spark):
    got = evaluate(column(spark, [0, 1, 2, None], "INT"), E.map_label(F.col("x"), C.CHURN_LABELS))
    assert got == ["Active", "Churned", None, None]


def test_skew_matches_pandas(spark):
    for values in ([1.0, 2.0, 2.0, 9.0, 4.0], [3.0, 3.0, 3.0], [1.0, 2.0]):
        df = column(spark, values, "DOUBLE")
        got = df.agg(E.adjusted_skew(F.count("x"), F.skewness("x"), F.min("x") == F.max("x"))).first()[0]
        want = pd.Series(values).skew()
        assert (got is None and np.isnan(want)) or got == pytest.approx(want)


def test_correlation_labels(spark):
    df = column(spark, [0.21, -0.2, 0.1, -0.5, 0.0], "DOUBLE")
    assert evaluate(df, E.correlation_label(F.col("x"))) == [
        "strong positive", "moderate negative", "weak positive", "strong negative", "weak negative",
    ]


def test_bitmaps_count_distinct_keys(spark):
    rows = [("a", k) for k in (1, 1, 2, 32768, 32769, 100_000, 100_000, -5, None, None)] + [("b", None)] + [("c", 7)] * 3
    df = spark.createDataFrame(rows, "g STRING, k LONG").repartition(3)
    bits = df.groupBy("g", E.key_bucket("k")).agg(E.key_bits("k"))
    got = {r.g: r.n for r in bits.groupBy("g").agg(E.count_bits().alias("n")).collect()}
    assert got == {"a": 6, "b": 0, "c": 1}
