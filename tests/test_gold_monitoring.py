from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata.functions.exprs import alert_id, half_even_average, percent
from lakestrata.operators import gold, health, monitoring
from tests.conftest import envelope_rows


def test_half_even_average_exact(spark):
    df = spark.createDataFrame([(Decimal("0.03"), 2), (Decimal("0.05"), 2), (Decimal("-0.05"), 2),
                                (Decimal("100.00"), 3)], "t decimal(28,2), n long")
    got = [r[0] for r in df.select(half_even_average(F.col("t"), F.col("n"))).collect()]
    assert got == [Decimal("0.02"), Decimal("0.02"), Decimal("-0.02"), Decimal("33.33")]


def test_percent_rounding_edges(spark):
    df = spark.createDataFrame([(2004, 10000), (2006, 10000), (2005, 10000), (2015, 10000), (1, 0)],
                               "p long, w long")
    got = [str(r[0]) for r in df.select(percent(F.col("p"), F.col("w"))).collect()]
    assert got == ["20.0", "20.1", "20.0", "20.2", "0.0"]


def test_alert_id_matches_hashlib(spark):
    import hashlib
    raw = "2024-01-31|warning|rule|msg"
    want = hashlib.sha256(raw.encode()).hexdigest()[:16]
    got = spark.range(1).select(alert_id(F.lit("2024-01-31"), F.lit("warning"), F.lit("rule"),
                                         F.lit("msg"))).first()[0]
    assert got == want


def _tx(spark, declined, approved):
    rows = [("declined", "ecommerce", "US", "1", declined, Decimal("1.00"), Decimal("1.00"), 0, declined, "t",
             "2024-01-31"),
            ("approved", "ecommerce", "US", "1", approved, Decimal("1.00"), Decimal("1.00"), approved, 0, "t",
             "2024-01-31")]
    return spark.createDataFrame(rows, "authorization_status string, channel string, merchant_country string, "
                                       "merchant_category_code string, transaction_count long, "
                                       "total_amount decimal(28,2), average_amount decimal(18,2), "
                                       "approved_count long, declined_count long, gold_processed_time string, "
                                       "process_date string")


def _cases(spark, scores, merchant="m"):
    rows = [(f"r{i}", "c", "txn", s, "high", merchant, 0, "t", "2024-01-31") for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "risk_event_id string, customer_id string, source_transaction_id string, "
                                       "risk_score long, risk_level string, merchant_name string, "
                                       "failed_login_count long, gold_processed_time string, process_date string")


def _health(spark, statuses=("success",)):
    rows = [(f"run{i}", f"job{i}", s, "2024-01-31", 1, 1, 0, "2024-01-31T00:00:00+00:00",
             "2024-01-31T00:00:01+00:00") for i, s in enumerate(statuses)]
    return spark.createDataFrame(rows, "run_id string, job_name string, status string, process_date string, "
                                       "records_read long, records_written long, records_rejected long, "
                                       "started_at string, finished_at string")


def _rules(spark, tx, cases, h):
    m = monitoring.metrics(h, tx, cases)
    return sorted(r["rule_id"] for r in monitoring.findings(m, h).collect())


def test_decline_rate_threshold_after_rounding(spark):
    h, c = _health(spark), _cases(spark, [10])
    assert _rules(spark, _tx(spark, 2004, 7996), c, h) == []           # 20.04 -> 20.0, not above
    assert _rules(spark, _tx(spark, 2006, 7994), c, h) == ["decline_rate_high"]  # 20.06 -> 20.1


def test_score_threshold_and_duplicates(spark):
    h, t = _health(spark), _tx(spark, 0, 5)
    assert _rules(spark, t, _cases(spark, [89]), h) == []
    assert _rules(spark, t, _cases(spark, [90]), h) == ["high_fraud_risk_score"]
    dup = _cases(spark, [10]).unionByName(_cases(spark, [5]))
    assert _rules(spark, t, dup, h) == ["duplicate_fraud_cases"]
    kept = monitoring.dedupe_cases(dup).collect()
    assert [r["risk_score"] for r in kept] == [10]


def test_missing_inputs_and_failed_jobs(spark):
    h = _health(spark, ("success", "failed"))
    empty_tx = _tx(spark, 0, 0).where("false")
    got = _rules(spark, empty_tx, _cases(spark, [1], merchant=None), h)
    assert got == ["missing_transaction_monitoring", "pipeline_job_not_successful", "unmatched_fraud_merchants"]
    m = monitoring.metrics(h, empty_tx, _cases(spark, [1]))
    st = monitoring.status(m, monitoring.findings(m, h)).first()
    assert st["status"] == "critical" and st["fail_on_critical"]


def test_latest_run_tie_breaks_on_run_id(spark):
    rows = [("b", "job", "success", "2024-01-31", 1, 1, 0, "2024-01-31T00:00:00+00:00", "2024-01-31T00:00:05+00:00"),
            ("a", "job", "failed", "2024-01-31", 1, 1, 0, "2024-01-31T00:00:01+00:00", "2024-01-31T00:00:05+00:00"),
            ("c", "job", "success", "2024-01-31", 1, 1, 0, "2024-01-31T00:00:00+00:00", "2024-01-31T00:00:04+00:00")]
    audit = spark.createDataFrame(rows, "run_id string, job_name string, status string, process_date string, "
                                        "records_read long, records_written long, records_rejected long, "
                                        "started_at string, finished_at string").withColumn(
        "input_prefix", F.lit("i")).withColumn("output_prefix", F.lit("o")).withColumn(
        "error_message", F.lit(None).cast("string"))
    h = health.pipeline_health(audit)
    assert sorted(r["duration_seconds"] for r in h.collect()) == [4.0, 4.0, 5.0]
    latest = health.latest_per_job(h).collect()
    assert [r["run_id"] for r in latest] == ["a"]


def test_fraud_case_joins(spark):
    cards = spark.createDataFrame(
        [("2024-01-31", "txn_1", "evt_a", Decimal("1.00"), "A", "US", "1", "approved"),
         ("2024-01-31", "txn_1", "evt_b", Decimal("2.00"), "B", "US", "1", "approved")],
        "process_date string, transaction_id string, event_id string, amount decimal(18,2), merchant_name string, "
        "merchant_country string, merchant_category_code string, authorization_status string")
    logins = spark.createDataFrame([("2024-01-31", "cust_1", "login_failed"), ("2024-01-31", "cust_1", "password_reset")],
                                   "process_date string, customer_id string, event_type string")
    risks = spark.createDataFrame(
        [("r1", "cust_1", "a", "c", "txn_1", 98, "high", "block", ["x"], "e", ["s"], "2024-01-31"),
         ("r2", "cust_2", "a", "c", "txn_9", 10, "low", "monitor", ["x"], "e", ["s"], "2024-01-31")],
        "risk_event_id string, customer_id string, account_id string, card_id string, source_transaction_id string, "
        "risk_score long, risk_level string, recommended_action string, rule_flags array<string>, "
        "explanation string, source_events array<string>, process_date string")
    out = {r["risk_event_id"]: r for r in gold.fraud_cases(cards, logins, risks).collect()}
    assert out["r1"]["merchant_name"] == "B" and out["r1"]["login_event_count"] == 2
    assert out["r1"]["failed_login_count"] == 1 and out["r1"]["password_reset_count"] == 1
    assert out["r2"]["merchant_name"] is None and out["r2"]["login_event_count"] == 0


def test_risk_events_take_only_objects_and_integral_scores(spark):
    scores = ["98", "98.0", '"98"', "true", "null", "1e2", "99999999999999999999"]
    bodies = [f'{{"risk_event_id": "s{i}", "risk_score": {s}, "rule_flags": ["a", "b"]}}' for i, s in enumerate(scores)]
    bodies += ['{"risk_event_id": "flags", "risk_score": 1, "rule_flags": "a", "source_events": ["e", "f"]}',
               '{"risk_event_id": "nulls", "rule_flags": null, "source_events": null, "customer_id": null}',
               '{"risk_event_id": "first", "risk_event_id": "last"}', "{}",
               "null", "[1]", '"text"', "", None, '{"risk_event_id": "broken"', '{"risk_event_id": "more"} x', "{'risk_event_id': 'quotes'}"]
    out = {r["risk_event_id"]: r for r in gold.risk_events(envelope_rows(spark, bodies), "2024-02-02").collect()}
    assert set(out) == {f"s{i}" for i in range(len(scores))} | {"flags", "nulls", "last", None}
    assert [out[f"s{i}"]["risk_score"] for i in range(len(scores))] == [98, None, None, None, None, None, None]
    assert all(out[f"s{i}"]["rule_flags"] == ["a", "b"] and out[f"s{i}"]["source_events"] == [] for i in range(len(scores)))
    assert (out["flags"]["risk_score"], out["flags"]["rule_flags"], out["flags"]["source_events"]) == (1, None, ["e", "f"])
    assert out["nulls"]["source_events"] == [] and out["nulls"]["customer_id"] is None and out["nulls"]["process_date"] == "2024-02-02"
