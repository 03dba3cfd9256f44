import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.functions import labels, order_stats
from ebbtide.functions import weeks as wk
from ebbtide.functions.ratios import rate_change, relative_change


def test_week_keys_on_both_sides_of_the_year(spark):
    assert wk.week_key_of(dt.date(2000, 12, 31)) == 200053
    assert wk.week_key_of(dt.date(2001, 1, 1)) == 200101
    assert wk.week_key_minus(200131, 104) == 199931
    assert wk.week_key_minus(200102, 2) == 200052
    assert wk.month_key_minus(200101, 12) == 200001
    days = [dt.date(1999, 12, 27) + dt.timedelta(days=i) for i in range(800)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", wk.week_key(F.col("d")).alias("k"), wk.iso_week_key(F.col("d")).alias("iso")
    ).select("d", "k", "iso", wk.week_minus(F.col("k"), 104).alias("m"), wk.month_minus(wk.month_key(F.col("d")), 5).alias("mm"))
    for r in rows.collect():
        assert r.k == wk.week_key_of(r.d)
        assert r.m == wk.week_key_minus(r.k, 104)
        assert r.iso == wk.iso_week_key_of(r.d)
        assert r.mm == wk.month_key_minus(r.d.year * 100 + r.d.month, 5)


def test_changes_follow_infinity_arithmetic(spark):
    values = [None, 0.0, 2.0, -3.0]
    rows = spark.createDataFrame([(a, b) for a in values for b in values], "a double, b double")
    for r in rows.selectExpr("a", "b", f"{relative_change('a', 'b')} AS c").collect():
        a, b = np.float64(r.a or 0.0), np.float64(r.b or 0.0)
        with np.errstate(all="ignore"):
            want = (a - b) / b
        want = 0.0 if np.isnan(want) else (math.copysign(1.0, want) if np.isinf(want) else want)
        assert r.c == pytest.approx(want)


def test_rate_changes_with_missing_volume(spark):
    pairs = [(0.0, 0.0), (5.0, 0.0), (5.0, 2.0), (-5.0, 0.0), (0.0, 2.0), (-4.0, 2.0)]
    rows = spark.createDataFrame([(*x, *y) for x in pairs for y in pairs], "n4 double, d4 double, n double, d double")
    for r in rows.selectExpr("*", f"{rate_change('n4', 'd4', 'n', 'd')} AS c").collect():
        with np.errstate(all="ignore"):
            a, b = np.float64(r.n4) / np.float64(r.d4), np.float64(r.n) / np.float64(r.d)
            a, b = (np.float64(0.0) if np.isnan(v) else v for v in (a, b))
            want = (a - b) / b
        want = 0.0 if np.isnan(want) else (math.copysign(1.0, want) if np.isinf(want) else want)
        assert r.c == pytest.approx(want), r


def test_call_types(spark):
    rows = [
        ("Tech  Support", None, "tech support", ""),
        ("Billing & Payments", None, "billing and payments", ""),
        ("Card/PIN Maintenance", None, "card pin maintenance", ""),
        ("EFT Un-enroll Request", "x", "billing and payments", "eft"),
        ("Collections Attempt", None, "billing and payments", "collection"),
        ("Refund Request", "x", "billing and payments", "refund request"),
        ("NSF", None, "billing and payments", "nsf"),
        ("Close Account", None, "close inquiry", ""),
        ("Transaction", "Late Fee / Finance Charge", "fees", "late fee finance charge"),
        ("Site", None, "Others", ""),
        ("Account Details & Maintenance", "customer’s wish", "account details and maintenance", "customers wish"),
        (None, None, "Others", ""),
    ]
    df = spark.createDataFrame(rows, "t string, s string, want string, wants string")
    kind, subtype = labels.call_type(F.col("t"), F.col("s"))
    for r in df.select("t", "want", "wants", kind.alias("k"), subtype.alias("sub")).collect():
        assert (r.k, r.sub) == (r.want, r.wants), r


def test_profile_labels(spark):
    df = spark.range(1).select(
        labels.channel_class(F.lit("Unk"), F.lit("Telesales East")).alias("a"),
        labels.channel_class(F.lit("Regional inbound"), F.lit(None)).alias("b"),
        labels.channel_class(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("c"),
        labels.credit_grade(F.lit(300)).alias("d"),
        labels.credit_grade(F.lit(301)).alias("e"),
        labels.credit_grade(F.lit(-1)).alias("f"),
        labels.product_bucket(labels.product_combination([F.lit("PROPRIETARY"), F.lit("ECASH"), F.lit("NON-CORE"), F.lit("ECASH"), F.lit("others")])).alias("g"),
        labels.product_bucket(labels.product_combination([F.lit("FUEL"), F.lit("ECASH"), F.lit("MASTERCARD"), F.lit("PROPRIETARY")])).alias("h"),
        labels.payment_method(F.lit("X-ACH")).alias("i"),
        labels.truck_band(F.lit("A.express check account")).alias("j"),
        labels.state_group(F.lit("ca")).alias("k"),
    )
    assert tuple(df.first()) == (
        "outbound", "inbound", "unknown", "Worse", "Poor", "UNK", "ECASH_FUEL", "OTHERS", "CDN/ACH", "others", "CA",
    )


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    group = np.where(rng.random(4000) < 0.4, "hot", rng.integers(0, 40, 4000).astype(str))
    value = np.where(rng.random(4000) < 0.33, 0.0, np.round(rng.normal(size=4000), 2))
    value[rng.random(4000) < 0.05] = np.nan
    return pd.DataFrame({"id": np.arange(4000), "g": group, "v": value})


@pytest.mark.parametrize("piece", [50, 200_000])
def test_positions_in_many_or_one_range_agree_with_pandas(spark, skewed, piece):
    """Small ranges cut groups; ties and one hot group included."""
    df = spark.createDataFrame(skewed.assign(v=skewed.v.astype(object).where(skewed.v.notna(), None)), "id long, g string, v double")
    got = {(r.g, r.v): (r.n, r.below, r.dense) for r in order_stats.value_positions(df, ["g"], "v", piece).collect()}
    clean = skewed.dropna()
    clean = clean.assign(dense=clean.groupby("g").v.rank(method="dense"), first=clean.groupby("g").v.rank(method="min"))
    counts = clean.groupby(["g", "v"]).size()
    assert len(got) == len(counts)
    for r in clean.itertuples():
        assert got[(r.g, r.v)] == (counts[(r.g, r.v)], r.first - 1, r.dense)


def test_percentile_ranks_average_ties(spark, skewed):
    df = spark.createDataFrame(skewed.assign(v=skewed.v.astype(object).where(skewed.v.notna(), None)), "id long, g string, v double")
    got = {r.id: r.pct for r in order_stats.percentile_ranks(df, "id", ["v"]).collect()}
    want = skewed.set_index("id").v.rank(pct=True).dropna()
    assert len(got) == len(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


@pytest.mark.parametrize("values", [[5.0] * 6, [0.0, 0.0, 0.0], [1.0, 1.0, 1.0, 1.0, 2.0, 3.0], list(map(float, range(11))), [7.0]])
def test_quartile_scores_like_merged_bins(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k long, x_avg double")
    got = [r.x_score for r in order_stats.quartile_scores(df, "k", ["x_avg"]).orderBy("k").collect()]
    series = pd.Series(values).replace(0, np.nan)
    try:
        want = pd.qcut(series, 4, labels=False, duplicates="drop") + 1
    except (ValueError, IndexError):
        want = pd.Series([0] * len(values))
    assert got == want.fillna(0).astype(int).tolist()
