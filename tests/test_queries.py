"""Spark against the reference SQL on the smallest tables, and properties of the results."""

import duckdb
import pytest

import __spark_entry__ as entry_module

ROOT = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
CHECKED = [
    "run_params", "weekly_fact", "rollup_weekly", "week_ranges", "account_profile", "fee_ledger_weekly",
    "transaction_features", "fee_flags", "call_weekly", "survey_features", "parent_priority", "account_priority",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


def test_every_query_has_a_name_in_both_maps():
    rows_only = {"model_select", "rfe", "model_leaderboard", "tune", "train_segment", "score_segment"}
    core = {n for n in entry_module.queries() if not n.startswith("op") and n != "pipeline"}
    assert core - set(entry_module.oracle_sql()) == rows_only
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    got = entry_module.queries()[name](spark, ROOT)
    columns = sorted(got.columns)
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(r[k] for k in order) for r in result.fetchall()]
    have = [tuple(r[c] for c in columns) for r in got.collect()]

    def key(row):
        return [(v is not None, str(v)) for v in row]

    have, want = sorted(have, key=key), sorted(want, key=key)
    assert len(have) == len(want)
    assert have == want


def test_properties(spark):
    flags = entry_module.queries()["fee_flags"](spark, ROOT)
    for fee in ("late_interest_fee", "program_fee"):
        wrong = flags.where(f"{fee}_inv_cnt4 > {fee}_inv_cnt8 OR {fee}_inv_cnt8 > {fee}_inv_cnt13 OR {fee}_inv_cnt13 > {fee}_inv_cnt26 OR {fee}_inv_cnt26 > {fee}_inv_cnt52")
        assert wrong.count() == 0
    assert entry_module.entry(spark).count() >= 0
