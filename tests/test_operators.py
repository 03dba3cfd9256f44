import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.staging import shared_folder
from ebbtide.modelling import evaluate, explain, prepare, select
from ebbtide.operators import contact, fact, priority, ranges, rollup
from ebbtide.operators import calendar as cal
from ebbtide.params import RunParams
from ebbtide.sources import sinks

P = RunParams(current_week=200131, first_day=dt.date(1999, 1, 4), last_day=dt.date(2001, 8, 1))
DAY = dt.date(2001, 7, 30)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}


def test_calendar_and_windows(spark):
    calendar = cal.fiscal_calendar(spark, P)
    rows = calendar.collect()
    assert len({r.week_no for r in rows}) == len(rows)
    assert P.history_floor == 199931 and P.current_month == 200107
    assert len(P.history_mondays) == 105
    assert P.history_days == (dt.date(1999, 8, 2), dt.date(2001, 8, 6))


LEDGER = "account_no string, load_date date, tran_date date, product_code string, sub_product_1 string, sub_product_2 string, late_gl_no int, late_gl_amount double, revenue_amount double"


def test_ledger_signs_classes_and_dates(spark):
    earlier = dt.date(2001, 7, 16)
    rows = [
        ("AR-00007", DAY, earlier, "00500", "90001", "00068", None, None, -5.0),   # risk fee, earlier week
        ("AR-00007", DAY, earlier, "00500", "90001", "00068", None, None, 2.0),    # risk refund
        ("AR-00007", DAY, earlier, "00999", "90001", "00000", 55, -3.0, -9.0),     # late by load date, own amount
        ("AR-00007", DAY, DAY, "00175", "1", "2", 54, 4.0, -6.0),                  # late refund and fleet advance
        ("AR-00007", DAY, DAY, "00700", "90001", "00001", None, None, 0.0),        # equipment, zero amount
        ("AR-00008", DAY, DAY, "00175", "1", "2", None, None, -6.0),               # not active
        ("AR-00007", DAY, DAY, "00500", "90001", "99999", None, None, -6.0),       # no fee
    ]
    ledger = spark.createDataFrame(rows, LEDGER)
    products = spark.createDataFrame([("00700", "90001", "00001", "ELD EQUIPMENT"), ("00500", "90001", "99999", "OTHER")],
                                     "product_code string, sub_product_1 string, sub_product_2 string, description string")
    active = spark.createDataFrame([(7,)], "customer_id long")
    got = by_key(fact.fee_ledger_weekly(ledger, products, active, cal.fiscal_calendar(spark, P)), "week")
    assert set(got) == {200129, 200131}
    old, new = got[200129], got[200131]
    assert (old["risk_based_pricing_amount"], old["risk_based_pricing_refund"]) == (5.0, -2.0)
    assert (old["num_of_risk_fees_applied"], old["num_of_risk_fees_refunded"]) == (1, 1)
    assert old["late_interest_fee_amount"] is None
    assert (new["late_interest_fee_amount"], new["late_interest_fee_refund"]) == (3.0, -4.0)
    assert (new["fleet_advance_fee_amount"], new["eld_equi_fee_amount"], new["num_of_eld_eqi_fees_applied"]) == (6.0, 0.0, 0)


def test_settlement_keeps_its_sign(spark):
    rows = spark.createDataFrame([(7, DAY, "X ", 5.0), (7, DAY, "X", -2.0), (7, DAY, "Y", 9.0)],
                                 "customer_id long, invoice_date date, fee_type string, fee_amount double")
    active = spark.createDataFrame([(7,)], "customer_id long")
    r = fact.settlement_fee_weekly(rows, active, cal.fiscal_calendar(spark, P)).first()
    assert (r.express_fee_amount, r.express_fee_refund, r.num_of_expr_fees_applied, r.num_of_expr_fees_refunded) == (5.0, -2.0, 1, 1)


def test_representative_account(spark):
    def account(key, parent, volume, trx, last, limit, first):
        return (key, parent, volume, 1.0, trx, last, 200101, "TX", None, "daily", 10, "Field", "x", 700, "FUEL", None, None,
                None, None, None, "Wire", limit, first, 5.0)

    rows = [
        account(1, "A", 5.0, 9, 200120, None, 199901),                                   # single: limit stays missing
        account(2, "B", 5.0, 3, 200101, 10, 199905), account(3, "B", 5.0, 4, 200131, None, 199903),   # tie on volume
        account(4, "C", None, 1, 200101, None, 199901), account(5, "C", 0.0, 1, 200101, None, 199901),
        account(6, "D", 1.0, 1, 200101, 1, 199901), account(7, "D", 1.0, 1, 200101, 2, 199901),       # all equal: lowest code
    ]
    schema = ("customer_id long, parentname string, volume double, total_spend double, total_num_trx long, last_transaction_week int,"
              " last_transaction_month int, state_code string, num_of_trucks string, billing_freq string, due_days long, channel_1 string,"
              " channel_2 string, credit_score long, product_information_1 string, product_information_2 string, product_information_3 string,"
              " product_information_4 string, product_information_5 string, product_information_6 string, last_payment_method string,"
              " credit_limit long, first_trx_month int, total_producttype_spend double")
    got = by_key(rollup.rollup_profile(spark.createDataFrame(rows, schema), P), "parentname")
    assert {k: v["customer_id"] for k, v in got.items()} == {"A": 1, "B": 3, "C": 5, "D": 6}
    assert {k: v["credit_limit"] for k, v in got.items()} == {"A": None, "B": 10, "C": 0, "D": 3}
    assert got["B"]["first_trx_month"] == 199903 and got["B"]["churn_flag"] == "ACTIVE" and got["A"]["churn_flag"] == "CHURNER"


def weekly_rows(spark, activity):
    """(parent, active flags oldest first) to a weekly frame."""
    mondays = P.mondays
    rows = []
    for parent, flags in activity.items():
        from ebbtide.functions.weeks import week_key_of
        for monday, flag in zip(mondays[-len(flags):], flags):
            rows.append((parent, week_key_of(monday), float(flag), 0.0, 0.0, 0.0, 0.0, 0.0))
    names = ["total_gallons", *ranges.NONZERO_ACTIVITY]
    return spark.createDataFrame(rows, "parentname string, week int, " + ", ".join(f"{n} double" for n in names))


def test_trim_ranges_and_min_weeks(spark):
    weekly = weekly_rows(spark, {
        "twelve": [0] * 10 + [1] * 12,
        "thirteen": [0] * 5 + [1] * 13 + [0] * 4,
        "gap": [1] * 7 + [0] * 5 + [1] * 7,
        "long": [1] * 60,
    })
    labelled = ranges.labelled_weeks(weekly, P)
    counts = {r.parentname: r["count"] for r in labelled.groupBy("parentname").count().collect()}
    assert counts == {"thirteen": 13, "gap": 19, "long": 52}
    long = [r for r in labelled.where("parentname = 'long'").orderBy("week_rank").collect()]
    assert [r.week_range_4 for r in long[:9]] == ["range-1"] * 4 + ["range-2"] * 4 + [None]
    assert [r.week_range_26 for r in long] == ["range-1"] * 26 + ["range-2"] * 26
    from dataclasses import replace
    shifted = ranges.labelled_weeks(weekly, replace(P, offset=8))
    counts = {r.parentname: r["count"] for r in shifted.groupBy("parentname").count().collect()}
    assert counts == {"long": 52}
    first = shifted.orderBy("week_rank").first()
    assert first.week_rank == 9 and first.week_range_52 == "range-1"


def test_random_cutoff_only_cuts_active_parents(spark):
    weekly = weekly_rows(spark, {"a": [1] * 80, "b": [1] * 20, "c": [1] * 20})
    trimmed = ranges.lifetime_bounds(weekly, 13)
    status = spark.createDataFrame([("a", "ACTIVE"), ("b", "ACTIVE"), ("c", "CHURNER")], "parentname string, churn_flag string")
    for _ in range(2):
        counts = {r.parentname: r["count"] for r in ranges.random_cutoff(trimmed, status, P).groupBy("parentname").count().collect()}
        assert 28 <= counts["a"] < 80 and 12 <= counts["b"] < 20 and counts["c"] == 20


def test_survey_weights_rows(spark):
    labelled = spark.createDataFrame([("A", 1, "range-1", "range-1", "range-1"), ("A", 2, "range-1", "range-1", None)],
                                     "parentname string, week int, week_range_52 string, week_range_26 string, week_range_8 string")
    rows = [
        (1, "A", "Absolutely", 9, 0, "Promoter", "Detractor", DAY, 1),
        (1, "A", "no", 0, 5, "Detractor", "Detractor", DAY, 1),
        (2, "A", "no", 10, 10, "Promoter", "Promoter", DAY, 1),
        (2, "A", "Absolutely", 3, 3, "Detractor", "Detractor", DAY, 2),
    ]
    schema = ("customer_id long, parentname string, issue_solved string, product_rating int, agent_rating int, product_nps string,"
              " agent_nps string, case_response_dt date, case_week int")
    responses = spark.createDataFrame(rows, schema)
    r = contact.survey_features(labelled, responses).first()
    assert r["product_promoter_cnt_ratio_8"] == pytest.approx(4 / 9)          # 2 promoters on 2 rows of 3 * 3
    assert r["issue_solved_ratio_52"] == pytest.approx((1 * 3 + 1) / (9 + 1))
    assert r["agentrating_cnt_ratio_8"] == pytest.approx(4 / 9)               # counts rows with a product rating
    assert r["product_rating_avg_52"] == pytest.approx((9 + 10 + 3) / 3)
    once = contact.survey_features(labelled, responses, row_weighted=False).first()
    assert once["product_promoter_cnt_ratio_8"] == pytest.approx(2 / 3)
    # The same from the row-level table.
    weekly = contact.survey_weekly(responses).where("case_week = 1").agg(F.sum("product_promoter_cnt"), F.sum("total_counts")).first()
    assert tuple(weekly) == (4, 9)


def test_account_ranks(spark):
    schema = ("parentname_x string, acctcode long, last_transaction_week int, count_sf_cases_last3m long, phone string,"
              " last_4_weeks_gallons double, last_26_weeks_gallons double, last_52_weeks_revenue_y double, last_52_weeks_gallons_y double")
    rows = [
        ("A", 1, 200131, 3, "x", 0.0, 100.0, 1.0, 1.0),     # 1 + 1 + 1 + 1
        ("A", 2, 200131, 0, None, 50.0, 100.0, 1.0, 1.0),   # 2 + 1 + 2 + 2
        ("A", 3, 200120, 0, "x", 0.0, 0.0, 1.0, 1.0),       # 1 + 2 + 0 + 2
        ("A", 4, 200131, 0, "x", 5.0, 0.0, 1.0, 1.0),       # 1 + 1 + 3 + 2
        ("B", 5, 200131, 0, "x", 5.0, 0.0, 1.0, 1.0),
    ]
    got = by_key(priority.account_ranks(spark.createDataFrame(rows, schema)), "acctcode")
    assert set(got) == {1, 2, 3, 4}
    assert {k: v["global_rank_mean"] for k, v in got.items()} == {1: 1.0, 2: 1.75, 3: 1.25, 4: 1.75}
    assert {k: v["account_rank"] for k, v in got.items()} == {1: 1, 2: 3, 3: 2, 4: 3}


def test_validation_bounds_and_factor_text(spark):
    bounds = evaluate.validation_bounds(202050)
    assert [b[0] for b in bounds] == ["<202050", "202050-202101", "202050-202105", "202050-202110", "202050-202120", "202050-202130", "202050-202150"]
    texts = spark.createDataFrame([(0.1,), (12.0,), (-3.25,), (-0.001,), (100.0,)], "v double").select(explain.number_text(F.col("v"), 2).alias("t"))
    assert [r.t for r in texts.collect()] == ["0.1", "12.0", "-3.25", "0.0", "100.0"]


def test_model_preparation(spark):
    rows = spark.createDataFrame([("a", 1.0, 5.0, 0), ("b", 2.0, 5.0, 1), ("c", 6.0, 5.0, 1)], "parentname string, x double, k double, churn_flag int")
    assert [r.measure for r in prepare.constant_columns(rows, ["x", "k"]).collect()] == ["k"]
    scaled = by_key(prepare.standard_scale(rows, ["x", "k"]), "parentname")
    assert scaled["a"]["x"] == pytest.approx(-2 / (14 / 3) ** 0.5) and scaled["a"]["k"] == 0.0
    f = {r.measure: r.f for r in select.anova_f(rows, ["x", "k"]).collect()}
    assert f["x"] == pytest.approx(0.75, abs=1e-5) and f["k"] is None


def test_slices_are_replaced_alone(spark):
    path = f"{shared_folder(spark)}/slices-{uuid.uuid4().hex}"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "parentname string, churn_rank int")
    for week, batch in ((200129, rows), (200130, rows), (200131, rows), (200131, rows.where("churn_rank = 1")), (200129, rows.limit(0))):
        sinks.replace_slice(batch, path, week, DAY)
    counts = {r.run_week: r["count"] for r in spark.read.parquet(path).groupBy("run_week").count().collect()}
    assert counts == {200130: 2, 200131: 1}
    assert sinks.as_result(sinks.stamp(rows, 200131, DAY)).schema.names == sinks.RESULT_SCHEMA.names


def test_feature_lists_round_trip(spark):
    path = f"{shared_folder(spark)}/lists-{uuid.uuid4().hex}"
    votes = spark.createDataFrame([("m1", True, False), ("m2", True, True)], "measure string, a boolean, b boolean")
    wide = votes.select("measure", *[F.col("a" if k % 2 else "b").alias(v) for k, v in enumerate(select.VOTES)])
    sets = select.feature_sets(select.feature_votes(wide), "small")
    sinks.write_feature_lists(sets, path)
    back = {r["name"]: r["features"] for r in sinks.read_feature_lists(spark, path).collect()}
    assert back["logistic"] == ["m1", "m2"] and back["lasso"] == ["m2"] and back["total_5"] == ["m2"]


def test_factors_of_a_tree_follow_its_path(spark):
    """Against the path walked by hand; the weight and the ties by name count."""
    nodes = [
        {"id": 0, "prediction": 0.5, "left": 1, "right": 2, "feature": 0, "threshold": 1.0},
        {"id": 1, "prediction": 0.2}, {"id": 2, "prediction": 0.8, "left": 3, "right": 4, "feature": 1, "threshold": 0.0},
        {"id": 3, "prediction": 0.6}, {"id": 4, "prediction": 0.9},
    ]
    rows = spark.createDataFrame([("a", 0.0, 5.0), ("b", 2.0, -1.0), ("c", 2.0, 1.0)], "parentname string, `x.1` double, y double")
    found = explain.tree_attributions([(2.0, nodes)], ["x.1", "y"])
    got = {r[0]: (round(r[1], 9), round(r[2], 9)) for r in rows.select("parentname", found["x.1"], found["y"]).collect()}
    assert got == {"a": (-0.6, 0.0), "b": (0.6, -0.4), "c": (0.6, 0.2)}
    names = rows.select("parentname", *explain.feature_factors(found, ["y"], top=2)).collect()
    assert [(r.factor_1, r.factor_2) for r in names] == [("x.1", None)] * 3


def test_quality_gate_names_weak_segments(spark):
    board = spark.createDataFrame([("small", 0.4), ("small", 0.6), ("large", 0.3)], "segment string, f1_score double")
    assert [tuple(r) for r in evaluate.below_quality(board).collect()] == [("large", 0.3)]


def test_class_comes_from_the_unrounded_score(spark):
    rows = spark.createDataFrame([("a", 0.49996), ("b", 0.5)], "parentname string, churn_prob double")
    assert [(r.churn_prob, r.churn_flag_predicted) for r in evaluate.score_bands(rows).orderBy("parentname").collect()] == [(0.5, 0), (0.5, 1)]
    given = rows.selectExpr("*", "1 AS churn_flag_predicted")
    assert [r.churn_flag_predicted for r in evaluate.score_bands(given).collect()] == [1, 1]


def test_local_paths_are_refused_on_a_cluster():
    from types import SimpleNamespace

    from ebbtide.functions.staging import shared_folder as folder

    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)),
            sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k: conf.get(k)), applicationId="x"),
        )

    here = {"spark.checkpoint.dir": "file:///tmp/x"}
    assert folder(session("local-cluster[2,1,512]", **here)) == "file:///tmp/x"
    for wrong in ({}, here, {"spark.checkpoint.dir": "/tmp/x"}):
        with pytest.raises(ValueError):
            folder(session("yarn", **wrong))
    assert folder(session("yarn", **here, **{"spark.ebbtide.sharedMount": "true"})) == "file:///tmp/x"
    assert folder(session("yarn", **{"spark.checkpoint.dir": "hdfs://n/x/"})) == "hdfs://n/x"


def test_a_local_path_that_executors_share_is_staged_on_a_cluster(spark, tmp_path, monkeypatch):
    """Under a cluster's master name a folder is tried: a shared one serves, one that cannot be written is refused."""
    from ebbtide.functions import staging

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    for folder in (f"file://{tmp_path}", str(tmp_path)):
        assert staging.stage(spark.range(5), "tried", folder).count() == 5
        assert not list(tmp_path.glob("ebbtide/trial-*"))
        staging.release(spark, folder)
    (tmp_path / "file").write_text("")
    for wrong in (f"file://{tmp_path}/file/x", f"{tmp_path}/file/x"):
        with pytest.raises(ValueError):
            staging.stage(spark.range(5), "refused", wrong)


def test_a_query_that_stages_runs_on_a_cluster(spark, tmp_path, monkeypatch):
    """Under a cluster's master name, with a plain path as checkpoint folder: a registered query, and a stage in buckets."""
    import datetime as dt

    from ebbtide.functions import staging
    from ebbtide.plans.queries import QUERIES

    orders = [(10 * c + w, c, "O", 1.0, dt.datetime(2024, 1, 1) + dt.timedelta(weeks=w), ("1-URGENT", "5-LOW")[w % 2]) for c in range(4) for w in range(8)]
    tables = {
        "customer": spark.createDataFrame([(c, 1, 4000.0, "FURNITURE") for c in range(4)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": spark.createDataFrame([(o[0], 1) for o in orders], "l_orderkey long, l_suppkey long"),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/data/{name}.parquet")
    folder = f"{tmp_path}/shared"
    monkeypatch.setattr(staging, "_setting", lambda _, key: folder if key == staging.CHECKPOINT_DIR else None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    found = QUERIES["active_accounts"](spark, f"{tmp_path}/data")
    assert {r.customer_id for r in found.collect()} == {0, 1, 2, 3}
    assert staging.stage_bucketed(spark.range(50), "numbers", "id").count() == 50
    assert all(f.startswith(f"file://{folder}/ebbtide/") for f in found.inputFiles())
    staging.release(spark)


def test_a_trial_that_lacks_rows_is_refused(spark, tmp_path, monkeypatch):
    from ebbtide.functions import staging

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    read = type(spark.read.schema("id long")).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path: read(self, path).where("id > 0"))
    with pytest.raises(ValueError):
        staging.shared_folder(spark, str(tmp_path))


def test_without_a_checkpoint_folder_executors_of_their_own_use_the_warehouse():
    from types import SimpleNamespace

    from ebbtide.functions.staging import shared_folder as folder

    conf = {"spark.sql.warehouse.dir": "hdfs://n/tables/"}
    for master in ("local-cluster[2,1,512]", "yarn"):
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k: conf.get(k)), applicationId="x")
        assert folder(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)) == "hdfs://n/tables"


def test_the_profile_joins_the_lines_of_sales_once(spark):
    """Lines are read twice, once for sales and once for terms; volumes and products share the sales."""
    from ebbtide.plans.inputs import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = i.profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 2


@pytest.mark.parametrize("given, kept", [("64MB", 16 * 2**20), ("67108864b", 16 * 2**20), ("1g", 16 * 2**20), ("8m", 8 * 2**20), ("512k", 2**19), ("8388608", 8 * 2**20)])
def test_merged_partitions_stay_small_enough_to_be_sorted(spark, given, kept):
    from ebbtide.session import MERGED, configure

    session = spark.newSession()
    session.conf.set(MERGED, given)
    assert configure(session).conf.get(MERGED) == str(kept)


def test_ledger_scans_are_cut_by_both_dates(spark):
    from ebbtide.plans.inputs import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = i.ledger._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(l_shipdate" in p for p in pushed) and any("GreaterThanOrEqual(o_orderdate" in p for p in pushed)


def test_a_parent_with_a_third_of_all_accounts(spark):
    """The roll-up of a hot parent equals plain sums."""
    from ebbtide.plans.inputs import Inputs

    p = Inputs(spark, "/root/testdata/sf0.001").p
    week = p.current_week
    others = [f"CAST(NULL AS {'BIGINT' if m in fact.COUNT_MEASURES else 'DOUBLE'}) AS {m}" for m in fact.RAW_MEASURES if m != "total_gallons"]
    weeks = spark.range(900).selectExpr("id AS customer_id", f"{week} AS week", "CAST(id AS DOUBLE) AS total_gallons", *others)
    parents = spark.range(900).selectExpr("id AS customer_id", "IF(id % 3 = 0, 'hot', concat('p', CAST(id % 50 AS STRING))) AS parentname")
    got = {r.parentname: r.total_gallons for r in rollup.parent_weekly(weeks, parents, p).where(f"week = {week}").collect()}
    want = {}
    for k in range(900):
        name = "hot" if k % 3 == 0 else f"p{k % 50}"
        want[name] = want.get(name, 0.0) + k
    assert got == want
