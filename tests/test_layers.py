"""What the registered queries store, move and deal out."""

import glob
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from lakestrata.functions import exprs
from lakestrata.operators import gold, monitoring, signals, silver
from lakestrata.plans import catalog
from lakestrata.session import checkpoint_dir, materialize
from lakestrata.sources import fixtures
from tests.conftest import SF_SMALL, envelope_rows
from tests.test_silver import card


def layers(spark):
    return set(glob.glob(checkpoint_dir(spark).replace("file:", "") + "/layer-*"))


@pytest.mark.parametrize("name", ["silver_card", "silver_card_counts", "bronze_flatten", "validate_bronze", "validate_bronze_failures",
                                  "quarantine_listing", "gold_fraud_cases", "unmatched_fraud_cases", "fraud_cases_dedup"])
def test_layers_read_once_are_not_stored(spark, name):
    catalog.forget_frames()
    before = layers(spark)
    assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert layers(spark) == before
    catalog.forget_frames()


def test_silver_validation_stores_only_what_it_reads(spark):
    catalog.forget_frames()
    before = layers(spark)
    catalog.QUERIES["validate_silver_card"](spark, SF_SMALL).collect()
    (layer,) = layers(spark) - before
    assert spark.read.parquet(layer).columns == ["process_date", "event_id", "_errors"]
    catalog.forget_frames()


def test_deliveries_move_as_raw_text_alone(spark):
    rows = envelope_rows(spark, [card(), card(merchant_name="later"), card(event_id="evt_2", amount="1.005")])
    plan = silver.silver_cards(rows)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Window":
        plan = plan.children().apply(0)
    moved = {plan.output().apply(i).name() for i in range(plan.output().size())} - {"_rn"}
    assert moved == {"event_id", *silver.TAIL, "_raw"}
    stored = silver.silver_from_checked(silver.check_cards(rows))  # typed rows beside their text give the same
    key = lambda r: r["event_id"]
    got, want = (sorted(df.drop("silver_processed_time").collect(), key=key) for df in (silver.silver_cards(rows), stored))
    assert got == want and [r["merchant_name"] for r in got] == ["later", "Shop"]


def test_shuffle_partitions_grow_with_the_tables(spark, tmp_root):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for rows, large in ((10, False), (9_000_000, True)):
        d = f"{tmp_root}/{rows}"
        spark.range(1).write.parquet(f"{d}/orders.parquet")
        duckdb.sql(f"COPY (SELECT hash(i) AS l_orderkey FROM range({rows}) t(i)) TO '{d}/lineitem.parquet' (FORMAT parquet)")
        catalog.fit_partitions(spark, d)
        held = spark.conf.get(name, None)
        assert (held is not None and int(held) > 8) if large else held is None
    catalog.fit_partitions(spark, SF_SMALL)
    assert spark.conf.get(name, None) is None


def test_signal_shuffles_carry_answers_not_columns(spark):
    types = {"amount": "decimal(28,2)", "card_present": "boolean"}
    cards = spark.createDataFrame([], ", ".join(f"{c} {types.get(c, 'string')}" for c in signals.CARD_COLUMNS))
    logins = spark.createDataFrame([], "customer_id string, event_time string, event_type string, country string")
    customers = spark.createDataFrame([], "customer_id string, customer_status string")
    plan = signals.fraud_signals(cards, logins, customers)._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Window":
        plan = plan.children().apply(0)
    moved = {plan.output().apply(i).name() for i in range(plan.output().size())}
    assert {"transaction_id", "account_id", "_day", "_cross_border"} <= moved
    assert not moved & {"amount", "card_present", "entry_mode", "event_time", "merchant_country", "merchant_category_code"}


def test_card_lines_are_joined_narrow(spark, tmp_root):
    """The two large joins move numbers of the lines and orders, no texts of theirs; other and missing values keep their meaning."""
    d = f"{tmp_root}/cards"
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string"
    lines = [(1, 1, 1, 1, 10.25, "R", "O"), (1, 2, 1, 2, 3.0, "N", "F"), (1, 2, 2, 3, 3.0, "N", "F"), (2, 1, 1, 1, None, None, None), (2, 1, 2, 2, 0.005, "A", "X")]
    for name, rows, ddl in (("lineitem", lines, line), ("orders", [(1, 5, "1-URGENT"), (2, 6, None)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string"),
                            ("part", [(1, "ring", "B#1"), (2, "bolt", "B#2")], "p_partkey bigint, p_name string, p_brand string"),
                            ("supplier", [(1, "S1", 0), (2, "S2", 0)], "s_suppkey bigint, s_name string, s_nationkey int"),
                            ("nation", [(0, "PERU")], "n_nationkey int, n_name string")):
        spark.createDataFrame(rows, ddl).write.parquet(f"{d}/{name}.parquet")
    messages = fixtures.card_messages(spark, d)
    fields = ["amount", "authorization_status", "channel", "card_present", "entry_mode"]
    got = {tuple(r) for r in messages.select(F.get_json_object("value", "$.event_id"), *[F.get_json_object("value", f"$.{f}") for f in fields]).collect()}
    assert got == {("evt_card_auth_1_1", "10.25", "declined", "ecommerce", "false", "manual_keyed"), ("evt_card_auth_1_2", "3.00", "pending", "card_present", "true", "manual_keyed"),
                   ("evt_card_auth_1_3", "3.00", "approved", "card_present", "true", "manual_keyed"), ("evt_card_auth_2_1", None, "approved", "card_present", None, "card_on_file"),
                   ("evt_card_auth_2_2", "0.01", "approved", "card_present", "false", "card_on_file")}
    moved, plans = [], [messages._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "Join":
            moved += [(c.output().apply(i).name(), c.output().apply(i).dataType().simpleString()) for c in children for i in range(c.output().size())]
        plans += children
    assert {n for n, t in moved if t == "string"} == {"p_name", "p_brand", "s_name", "n_name"}


def test_silver_projection_is_small_enough_to_be_compiled(spark, capsys):
    rows = envelope_rows(spark, [card(), card(event_id="evt_2", amount="1.005"), card(event_id="evt_3", amount="12e-1")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = silver.silver_cards(rows)
        assert sorted(str(r["amount"]) for r in df.collect() if r["event_id"] != "evt_1") == ["1.00", "1.20"]
        capsys.readouterr()
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # the JVM interprets larger methods


def test_key_lists_are_compared_only_for_missing_values(spark):
    rows = spark.createDataFrame([("1", ["a"]), (None, ["a"]), (None, ["a", "b"])], "b string, keys array<string>")
    reason = exprs.missing_reason(F.col("keys"), ["b"], F.col, "missing: ")
    assert [r[0] for r in rows.select(reason).collect()] == [None, "missing: ['b']", None]


def test_cases_move_by_customer_without_the_cards_columns(spark):
    text = lambda names: ", ".join(f"{n} string" for n in names)
    risks = spark.createDataFrame([], text([*[f for f in gold.RISK_FIELDS if f != "risk_score"], "process_date"]) + ", risk_score bigint")
    cards = spark.createDataFrame([], text([c for c in [*silver.CARD_FIELDS, "process_date"] if c != "amount"]) + ", amount decimal(28,2)")
    logins = spark.createDataFrame([], text([*silver.LOGIN_FIELDS, "process_date"]))
    plans, moved = [gold.fraud_cases(cards, logins, risks)._jdf.queryExecution().analyzed()], []
    while plans:
        plan = plans.pop()
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "Join" and "customer_id" in plan.condition().get().sql():
            moved += [c.output().apply(i).name() for c in children for i in range(c.output().size())]
        plans += children
    assert "login_event_count" in moved and not {"merchant_name", "transaction_amount"} & set(moved)


def test_a_task_sorts_few_messages(spark):
    """The lines that adaptive execution joins into one task are sorted as messages, in a task's share of a small executor."""
    catalog.fit_partitions(spark, SF_SMALL)
    target = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    moved, sorted_ = 48, 1_000  # bytes a line, as measured
    assert target / moved * sorted_ < 250e6


def test_monitoring_stores_narrow_cards_and_no_cases(spark):
    catalog.forget_frames()
    before = layers(spark)
    assert catalog.QUERIES["monitoring_findings_empty_date"](spark, SF_SMALL).count() > 0
    stored = [set(spark.read.parquet(layer).columns) for layer in layers(spark) - before]
    assert [s for s in stored if "event_id" in s] == [set(gold.CARD_COLUMNS)]
    assert not [s for s in stored if "risk_event_id" in s]
    catalog.forget_frames()


def test_narrow_silver_has_the_rows_of_all_columns(spark):
    rows = envelope_rows(spark, [card(), card(merchant_name="later"), card(event_id="evt_2", amount="1.005"), card(event_id="evt_3", amount="abc"), "[]", None])
    wide = silver.silver_cards(rows)
    for columns in (gold.CARD_COLUMNS, signals.CARD_COLUMNS, ["bronze_ingest_time", "event_id"]):
        narrow = silver.silver_cards(rows, columns=columns)
        assert narrow.columns == columns
        assert sorted(map(str, narrow.collect())) == sorted(map(str, wide.select(*columns).collect()))


def test_a_stored_layer_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    table = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # deleted in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert table.count() == 7


def test_metrics_read_the_cases_once(spark):
    schema = ("process_date string, risk_event_id string, customer_id string, source_transaction_id string, risk_score bigint, risk_level string, "
              "merchant_name string, failed_login_count bigint, gold_processed_time string")
    cases = spark.createDataFrame([("d", "r1", "c", "t", 95, "high", None, 2, "x"), ("d", "r1", "c", "t", 40, "low", None, 5, "y"), ("d", "r1", "c", "t", 95, "high", None, 2, "w"),
                                   ("d", "r2", None, None, None, None, "shop", None, None), ("e", "r2", None, None, 7, "high", "", 1, None)], schema)
    health = spark.createDataFrame([], "process_date string, status string, records_read bigint, records_written bigint, records_rejected bigint")
    tx = spark.createDataFrame([], "process_date string, transaction_count bigint, approved_count bigint, declined_count bigint, total_amount decimal(28,2)")
    m = monitoring.metrics(health, tx, cases)
    got = {r["process_date"]: [r[c] for c in ("raw_cases", "cases", "duplicates", "max_score", "unmatched_merchants", "high_risk", "failed_logins")] for r in m.collect()}
    assert got == {"d": [4, 2, 2, 95, 1, 1, 2], "e": [1, 1, 0, 7, 1, 1, 1]}
    assert m._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number()") == 1
    leaves, plans = 0, [monitoring.metrics(health, tx, spark.range(1).selectExpr(*[f"cast(null as {t}) as {c}" for c, t in (x.split(" ") for x in schema.split(", "))]))._jdf.queryExecution().analyzed()]
    while plans:
        plan = plans.pop()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
        leaves += plan.nodeName() == "Range"
    assert leaves == 1
