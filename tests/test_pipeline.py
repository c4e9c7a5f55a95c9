"""End-to-end golden scenario and rerun idempotency through PartitionRun.

The inputs are the demo scenarios of the card, login and risk producers.
Expected values follow from those constants: 1,500 cards in 10 groups of 150,
total 840,504.00, decline rate 10.0; 3 fraud cases, all unmatched; 4 jobs in
health reading 4,523 and writing 1,523 records; findings exactly
high_fraud_risk_score (98) and unmatched_fraud_merchants (3); status warning.
"""

import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata.functions import rules
from lakestrata.plans import publish
from lakestrata.plans.pipeline import PartitionRun, write_partition
from lakestrata.sources.bronze import envelope, write_bronze

DATE = "2024-01-31"
RUN = "20240131000000"

# ---------------------------------------------------------------------------
# FIXED VALUES: the amounts, statuses, channels, countries, categories and ids of the producers' demo scenarios, on
# which the golden totals depend. Names, addresses, devices and agents are made up.
# card: customer, account, card, amount, merchant id, merchant name, MCC, country, city, status, channel,
#       card present, entry mode
CARD_SCENARIOS = [
    ("cust_100001", "acct_200001", "card_300001", "42.50", "mrc_100001", "Merchant A", "5411", "US", "Chicago", "approved", "card_present", True, "chip"),
    ("cust_100002", "acct_200003", "card_300002", "18.25", "mrc_100002", "Merchant B", "5814", "US", "Chicago", "approved", "card_present", True, "contactless"),
    ("cust_100004", "acct_200005", "card_300004", "126.90", "mrc_100003", "Merchant C", "5541", "US", "Evanston", "approved", "card_present", True, "swipe"),
    ("cust_100001", "acct_200001", "card_300001", "76.13", "mrc_100004", "Merchant D", "5912", "US", "Chicago", "approved", "card_present", True, "chip"),
    ("cust_100005", "acct_200006", "card_300005", "9.99", "mrc_100005", "Merchant E", "4899", "US", "Seattle", "approved", "ecommerce", False, "card_on_file"),
    ("cust_100002", "acct_200003", "card_300002", "215.40", "mrc_100006", "Merchant F", "5732", "US", "Chicago", "approved", "card_present", True, "chip"),
    ("cust_100004", "acct_200005", "card_300004", "64.20", "mrc_100007", "Merchant G", "5942", "US", "Chicago", "approved", "card_present", True, "contactless"),
    ("cust_100003", "acct_200004", "card_300003", "2450.00", "mrc_900001", "Merchant H", "5944", "AE", "Dubai", "approved", "ecommerce", False, "manual_keyed"),
    ("cust_100005", "acct_200006", "card_300005", "1800.00", "mrc_900002", "Merchant I", "6051", "US", "Miami", "approved", "ecommerce", False, "manual_keyed"),
    ("cust_100003", "acct_200004", "card_300003", "799.99", "mrc_100008", "Merchant J", "5732", "US", "New York", "declined", "ecommerce", False, "manual_keyed"),
]
# login: sequence, customer, event type, status, failure reason, device, device type, ip, country, city, channel,
#        user agent
LOGINS = [
    (1, "cust_100001", "login_success", "success", None, "device_1", "ios", "192.0.2.4", "US", "Chicago", "mobile", "agent 2"),
    (2, "cust_100002", "login_success", "success", None, "device_2", "android", "192.0.2.5", "US", "Chicago", "mobile", "agent 1"),
    (3, "cust_100003", "login_failed", "failed", "invalid_password", "device_7", "web", "192.0.2.2", "NL", "Amsterdam", "web", "agent 3"),
    (4, "cust_100003", "login_failed", "failed", "invalid_password", "device_7", "web", "192.0.2.2", "NL", "Amsterdam", "web", "agent 3"),
    (5, "cust_100003", "login_failed", "failed", "invalid_password", "device_7", "web", "192.0.2.2", "NL", "Amsterdam", "web", "agent 3"),
    (6, "cust_100003", "password_reset", "success", None, "device_7", "web", "192.0.2.2", "NL", "Amsterdam", "web", "agent 3"),
    (7, "cust_100003", "new_device_registered", "success", None, "device_4", "web", "192.0.2.2", "NL", "Amsterdam", "web", "agent 3"),
    (8, "cust_100005", "login_success", "success", None, "device_5", "android", "192.0.2.3", "US", "Miami", "mobile", "agent 1"),
    (9, "cust_100004", "login_success", "success", None, "device_3", "ios", "192.0.2.1", "US", "Evanston", "mobile", "agent 2"),
    (10, "cust_100005", "new_device_registered", "success", None, "device_6", "web", "192.0.2.3", "US", "Miami", "web", "agent 3"),
]
# risk: id, transaction, customer, account, card, score, level, action
RISKS = [
    ("risk_000001", "txn_000008", "cust_100003", "acct_200004", "card_300003", 98, "high", "block_and_review"),
    ("risk_000002", "txn_000009", "cust_100005", "acct_200006", "card_300005", 82, "medium_high", "step_up_authentication"),
    ("risk_000003", "txn_000008", "cust_100003", "acct_200004", "card_300003", 95, "high", "block_and_review"),
]
# ---------------------------------------------------------------------------

TS = "2024-01-31T12:00:00+00:00"


def card_bodies(n=1500):
    out = []
    for i in range(n):
        s = CARD_SCENARIOS[i % 10]
        seq = f"{RUN}_{i + 1:06d}"
        out.append(json.dumps({
            "event_id": f"evt_card_auth_{seq}", "transaction_id": f"txn_{seq}", "authorization_id": f"auth_{seq}",
            "customer_id": s[0], "account_id": s[1], "card_id": s[2], "event_time": TS, "amount": s[3],
            "currency": "USD", "merchant_id": s[4], "merchant_name": s[5], "merchant_category_code": s[6],
            "merchant_country": s[7], "merchant_city": s[8], "authorization_status": s[9], "channel": s[10],
            "card_present": s[11], "entry_mode": s[12], "source_system": "synthetic-card-processor",
            "schema_version": "1.0.0"}))
    return out


def login_bodies():
    keys = ["customer_id", "event_type", "login_status", "failure_reason", "device_id", "device_type",
            "ip_address", "country", "city", "channel", "user_agent"]
    return [json.dumps({"event_id": f"evt_login_{r[0]:06d}", "login_event_id": f"login_{r[0]:06d}",
                        "event_time": TS, **dict(zip(keys, r[1:])),
                        "source_system": "synthetic-digital-banking-platform", "schema_version": "1.0.0"})
            for r in LOGINS]


def risk_bodies():
    return [json.dumps({"risk_event_id": r[0], "event_time": TS, "source_transaction_id": r[1], "customer_id": r[2],
                        "account_id": r[3], "card_id": r[4], "risk_score": r[5], "risk_level": r[6],
                        "recommended_action": r[7], "rule_flags": ["high_value_transaction"], "explanation": "x",
                        "source_events": ["evt_card_auth_000008"], "source_system": "synthetic-fraud-risk-engine",
                        "schema_version": "1.0.0"}) for r in RISKS]


def land(spark, root, topic_dir, topic, bodies):
    rows = [(None, b, topic, i % 6, i, None) for i, b in enumerate(bodies)]
    msgs = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                       "timestamp timestamp")
    write_bronze(envelope(msgs, DATE, F.lit(TS).cast("timestamp")), f"{root}/bronze/{topic_dir}")


def test_golden_partition_and_rerun(spark, tmp_root):
    land(spark, tmp_root, "card", "card-topic", card_bodies())
    land(spark, tmp_root, "login", "login-topic", login_bodies())
    land(spark, tmp_root, "risk", "risk-topic", risk_bodies())
    run = PartitionRun(spark, tmp_root, DATE)
    res = run.run()
    assert (res["silver_card"]["records_read"], res["silver_card"]["records_written"],
            res["silver_card"]["records_rejected"]) == (1500, 1500, 0)
    assert res["silver_login"]["records_written"] == 10
    assert "stopped_at" not in res
    assert len(res["silver_validation"]) == 2 and all(r["status"] == "passed" for r in res["silver_validation"])

    tx = spark.read.parquet(f"{tmp_root}/gold/tx").collect()
    assert len(tx) == 10 and {r["transaction_count"] for r in tx} == {150}
    assert sum(r["total_amount"] for r in tx) == Decimal("840504.00")

    cases = {r["risk_event_id"]: r for r in spark.read.parquet(f"{tmp_root}/gold/fraud").collect()}
    assert len(cases) == 3 and all(c["merchant_name"] is None for c in cases.values())
    c3 = cases["risk_000001"]
    assert (c3["login_event_count"], c3["failed_login_count"], c3["new_device_count"],
            c3["password_reset_count"]) == (5, 3, 1, 1)
    c5 = cases["risk_000002"]
    assert (c5["login_event_count"], c5["failed_login_count"], c5["new_device_count"],
            c5["password_reset_count"]) == (2, 0, 1, 0)

    m = spark.read.parquet(f"{tmp_root}/monitoring/metrics").first()
    assert (m["jobs"], m["records_read"], m["records_written"]) == (4, 4523, 1523)
    assert str(m["decline_rate"]) == "10.0"
    findings = {r["rule_id"]: r for r in spark.read.parquet(f"{tmp_root}/monitoring/findings").collect()}
    assert set(findings) == {"high_fraud_risk_score", "unmatched_fraud_merchants"}
    assert findings["high_fraud_risk_score"]["value"] == "98"
    assert findings["unmatched_fraud_merchants"]["value"] == "3"
    assert res["monitoring"]["status"] == "warning"
    summary = spark.read.parquet(f"{tmp_root}/monitoring/summary").first()
    assert summary["alert_count"] == 2 and summary["warning_count"] == 2

    kpis = {r["label"]: r for r in run.dashboard()["kpis"].collect()}
    assert kpis["Transactions"]["value"] == "1,500"
    assert kpis["Transactions"]["note"] == "$840,504.00 total amount"

    # Rerun of the same date: partitions are replaced, not appended to.
    run.run()
    assert spark.read.parquet(f"{tmp_root}/silver/card").count() == 1500
    assert spark.read.parquet(f"{tmp_root}/gold/tx").count() == 10
    assert spark.read.parquet(f"{tmp_root}/gold/fraud").count() == 3
    # alert history is append-only: both deliveries are kept
    assert spark.read.parquet(f"{tmp_root}/monitoring/alert_history").count() >= 4


def test_empty_partition_keeps_old_output(spark, tmp_root):
    land(spark, tmp_root, "card", "card-topic", ['{"event_id": 1', "not json"])
    res = PartitionRun(spark, tmp_root, DATE).silver("card")
    assert res["status"] == "failed" and res["records_rejected"] == 2
    assert spark.read.parquet(f"{tmp_root}/quarantine").count() == 2


def land_on(spark, root, topic_dir, bodies, date):
    rows = [(None, b, f"{topic_dir}-topic", 0, i, None) for i, b in enumerate(bodies)]
    msgs = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                       "timestamp timestamp")
    write_bronze(envelope(msgs, date, F.lit(TS).cast("timestamp")), f"{root}/bronze/{topic_dir}")


def healthy_bodies():
    """One risk event of a low score whose transaction has a card."""
    cards = card_bodies(10)
    approved = [c for c in cards if '"approved"' in c]
    risk = json.loads(risk_bodies()[0]) | {"risk_score": 10, "risk_level": "low",
                                           "source_transaction_id": json.loads(approved[0])["transaction_id"]}
    return approved, login_bodies(), [json.dumps(risk)]


def land_all(spark, root, bodies, date=DATE):
    for topic, b in zip(("card", "login", "risk"), bodies):
        land_on(spark, root, topic, b, date)


def test_healthy_date_finishes_without_findings(spark, tmp_root):
    land_all(spark, tmp_root, healthy_bodies())
    res = PartitionRun(spark, tmp_root, DATE).run()
    assert "stopped_at" not in res
    assert (res["monitoring"]["status"], res["monitoring"]["finding_count"]) == ("healthy", 0)
    assert spark.read.parquet(f"{tmp_root}/monitoring/summary").first()["alert_count"] == 0


def test_bad_then_healthy_rerun_clears_findings(spark, tmp_root):
    land_all(spark, tmp_root, (card_bodies(20), login_bodies(), risk_bodies()))
    assert PartitionRun(spark, tmp_root, DATE).run()["monitoring"]["status"] == "warning"
    # the same date again, now from other landing partitions
    land_all(spark, tmp_root, healthy_bodies(), "2024-02-02")
    run = PartitionRun(spark, tmp_root, DATE, ingest_date="2024-02-02", card_ingest_date="2024-02-02")
    history = spark.read.parquet(f"{tmp_root}/monitoring/alert_history").count()
    res = run.run()
    assert res["monitoring"]["status"] == "healthy"
    assert run.table("monitoring/findings").count() == 0
    assert run.table("monitoring/summary").first()["alert_count"] == 0
    assert spark.read.parquet(f"{tmp_root}/monitoring/alert_history").count() == history


def test_all_bad_input_stops_the_run(spark, tmp_root):
    land_all(spark, tmp_root, (["not json"], ["[]"], ["null"]))
    res = PartitionRun(spark, tmp_root, DATE).run()
    assert res["stopped_at"] == "silver_card" and "gold_tx" not in res
    assert res["silver_card"]["error_message"] == "No valid Silver records produced."
    assert res["monitoring"]["status"] == "critical"


def test_date_without_data_is_critical(spark, tmp_root):
    run = PartitionRun(spark, tmp_root, "2031-01-01")
    assert run.monitor()["status"] == "critical"
    assert {r["rule_id"] for r in run.table("monitoring/findings").collect()} == {
        "missing_pipeline_health", "missing_transaction_monitoring", "missing_fraud_cases"}


def test_failed_silver_does_not_report_old_gold_as_success(spark, tmp_root):
    run = PartitionRun(spark, tmp_root, DATE)
    assert run.gold_transactions()["status"] == "failed"
    assert run.gold_fraud()["status"] == "failed"


def test_quarantine_names_the_landing_object(spark, tmp_root):
    land_on(spark, tmp_root, "card", ["not json"], "2024-01-31")
    PartitionRun(spark, tmp_root, "2024-02-01", card_ingest_date="2024-01-31").silver("card")
    row = spark.read.parquet(f"{tmp_root}/quarantine").first()
    assert "ingest_date=2024-01-31/" in row["source_object_key"] and str(row["process_date"]) == "2024-02-01"


def frame_of(spark, values):
    return spark.createDataFrame([(v, DATE) for v in values], "v long, process_date string")


def seen(spark, path):
    folder = publish.current_folder(spark, path, f"process_date={DATE}")
    return sorted(r["v"] for r in spark.read.parquet(folder).collect()) if folder else None


class Killed(Exception):
    pass


def test_killed_write_keeps_the_old_partition(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    assert seen(spark, path) is None
    write_partition(frame_of(spark, [1, 2]), path, DATE)

    def killed(*_):
        raise Killed

    # while the rows are written, and before the commit file appears
    bad = frame_of(spark, [7]).withColumn("v", F.when(F.col("v") == 7, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        write_partition(bad, path, DATE)
    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(publish.Files, "write_text", killed)
        write_partition(frame_of(spark, [8]), path, DATE)
    assert seen(spark, path) == [1, 2]
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 2]  # staged rows are passed over


@pytest.mark.parametrize("at", ["delete", "rename"])
def test_a_commit_is_finished_by_others(spark, tmp_root, monkeypatch, at):
    path = f"{tmp_root}/t"
    write_partition(frame_of(spark, [1, 2]), path, DATE)
    whole = getattr(publish.Files, at)

    def killed(self, name, *rest):
        if name.endswith(f"t/process_date={DATE}") or rest and rest[0].endswith(f"t/process_date={DATE}"):
            raise Killed
        return whole(self, name, *rest)

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(publish.Files, at, killed)
        write_partition(frame_of(spark, [3]), path, DATE)
    assert seen(spark, path) == [3]  # committed, though the folders are not swapped
    publish.finish(spark, path, f"process_date={DATE}")
    publish.finish(spark, path, f"process_date={DATE}")
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [3] == seen(spark, path)
    write_partition(frame_of(spark, []), path, DATE)
    assert seen(spark, path) == []
    assert publish.Files(spark, path).names(f"{path}/_staged") == []


def test_bad_logins_leave_transactions_running(spark, tmp_root):
    cards, _, risks = healthy_bodies()
    land_all(spark, tmp_root, (cards, ["not json"], risks))
    res = PartitionRun(spark, tmp_root, DATE).run()
    assert res["stopped"] == ["silver_login"] and res["gold_tx"]["status"] == "success" and "gold_fraud" not in res
    assert "missing_transaction_monitoring" not in {r["rule_id"] for r in spark.read.parquet(f"{tmp_root}/monitoring/findings").collect()}


def test_bad_cards_leave_logins_running(spark, tmp_root):
    _, logins, risks = healthy_bodies()
    land_all(spark, tmp_root, (["not json"], logins, risks))
    res = PartitionRun(spark, tmp_root, DATE).run()
    assert res["stopped"] == ["silver_card"] and res["silver_login"]["status"] == "success"
    assert "gold_tx" not in res and "gold_fraud" not in res


def test_a_failed_latest_run_stops_before_monitoring(spark, tmp_root):
    land_all(spark, tmp_root, healthy_bodies())
    run = PartitionRun(spark, tmp_root, DATE)
    run.audit("nightly_extra", "failed", "a", "b", 0, 0, 0, datetime.now(timezone.utc), "broken")
    res = run.run(report_failures=False)
    assert res["stopped"] == ["latest runs"] and "monitoring" not in res
    assert [r["job_name"] for r in run.latest_runs().collect() if r["is_failure"]] == ["nightly_extra"]
    run.audit("nightly_extra", "success", "a", "b", 0, 0, 0, datetime.now(timezone.utc))
    res = run.run(report_failures=False)
    assert res["stopped"] == [] and res["monitoring"]["status"] == "healthy"


def test_failed_jobs_end_a_run_without_reports(spark, tmp_root):
    land_all(spark, tmp_root, (["not json"], ["[]"], ["null"]))
    res = PartitionRun(spark, tmp_root, DATE).run(report_failures=False)
    assert res["stopped"] == ["silver_card", "silver_login"] and not {"gold_health", "monitoring"} & set(res)


def test_counters_are_those_of_the_rows(spark, tmp_root):
    bodies = card_bodies(40)
    land_on(spark, tmp_root, "card", bodies + bodies[:7] + ["not json", "[]"], DATE)
    land_on(spark, tmp_root, "login", login_bodies(), DATE)
    land_on(spark, tmp_root, "risk", risk_bodies(), DATE)
    run = PartitionRun(spark, tmp_root, DATE)
    for times in (1, 2):
        res = run.run()
        counts = {k: tuple(res[k][f"records_{c}"] for c in ("read", "written", "rejected")) for k in ("silver_card", "silver_login", "gold_tx", "gold_fraud")}
        assert counts == {"silver_card": (49, 40, 2), "silver_login": (10, 10, 0), "gold_tx": (40, run.table("gold/tx").count(), 0), "gold_fraud": (53, 3, 0)}
        assert spark.read.parquet(f"{tmp_root}/quarantine").count() == 2 * times
        assert {r["job_name"]: r["records_read"] for r in run.latest_runs().collect()}[rules.JOB_SILVER_CARD] == 49
    assert publish.Files(spark, tmp_root).names(f"{tmp_root}/_work/{rules.JOB_SILVER_CARD}/_staged/process_date={DATE}") == []
