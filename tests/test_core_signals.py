import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import rules
from lakestrata.operators import core, signals, silver, validation
from lakestrata.sources.bronze import bronze_from_documents, read_bronze_documents
from lakestrata.operators import change_events
from lakestrata.streaming import cdc_stream
from lakestrata.streaming.cdc_stream import current_state, fold_stream
from tests.conftest import envelope_rows

ROW = "struct<order_id:string,customer_id:string,status:string,total:string>"


def test_cdc_fold_updates_and_deletes(spark):
    rows = [("r", None, ("o1", "c1", "O", "1.00"), 10), ("u", ("o1", "c1", "O", "1.00"), ("o1", "c1", "F", "1.00"), 11),
            ("r", None, ("o2", "c2", "O", "2.00"), 20), ("d", ("o2", "c2", "O", "2.00"), None, 22),
            ("u", ("o3", "c3", "O", "3.00"), ("o3", "c3", "P", "3.00"), 31), ("r", None, ("o3", "c3", "O", "3.00"), 30)]
    ch = spark.createDataFrame(rows, f"op string, before {ROW}, after {ROW}, lsn long")
    out = {r["order_id"]: r for r in core.fold_changes(ch, "order_id").collect()}
    assert set(out) == {"o1", "o3"}
    assert out["o1"]["status"] == "F" and out["o3"]["status"] == "P" and out["o3"]["source_lsn"] == 31


def test_constraint_report(spark):
    customers = spark.createDataFrame(
        [("c1", "A", "B", "a@x", "1990-01-01", "US", "active"), ("c1", "A", "B", "a@x", "1990-01-01", "US", "bogus"),
         ("c2", None, "B", "b@x", "1990-01-01", "US", None)],
        "customer_id string, first_name string, last_name string, email string, date_of_birth string, "
        "country_code string, customer_status string")
    accounts = spark.createDataFrame([("a1", "c1", "1", "r", "checking", "open", "2020-01-01"),
                                      ("a2", "c9", "2", "r", "x", "open", None)],
                                     "account_id string, customer_id string, account_number string, "
                                     "routing_number string, account_type string, account_status string, "
                                     "opened_at string")
    balances = spark.createDataFrame([("b1", "a1", 1.0, 1.0, "EUR")], "balance_id string, account_id string, "
                                     "available_balance double, current_balance double, currency string")
    profiles = spark.createDataFrame([("p1", "c1", "verified", "low", "clear", False, False, 101.0)],
                                     "risk_profile_id string, customer_id string, kyc_status string, "
                                     "kyc_risk_rating string, sanctions_screening_status string, pep_flag boolean, "
                                     "fraud_watchlist_flag boolean, risk_score double")
    now = F.lit("2024-01-01").cast("timestamp")
    missing = F.when(F.col("customer_id") != "c2", now)
    customers, accounts = (t.withColumns({"created_at": now, "updated_at": missing}) for t in (customers, accounts))
    balances = balances.withColumns({"balance_as_of": F.lit(None).cast("timestamp"), "created_at": now})
    profiles = profiles.withColumn("updated_at", now)
    report = core.constraint_report(customers, accounts, balances, profiles).collect()
    times = {(r["table_name"], r["constraint_name"]): r["violation_count"] for r in report
             if r["constraint_name"].split("_not_null")[0] in ("created_at", "updated_at", "balance_as_of")}
    assert len(times) == 7 and {k for k, n in times.items() if n} == {("customers", "updated_at_not_null"),
                                                                      ("account_balances", "balance_as_of_not_null")}
    rep = {r["constraint_name"]: r["violation_count"] for r in report}
    assert rep["customers_pkey"] == 2 and rep["customers_email_key"] == 2
    assert rep["customers_status_chk"] == 1  # NULL passes a CHECK
    assert rep["first_name_not_null"] == 1 and rep["customer_status_not_null"] == 1
    assert rep["opened_at_not_null"] == 1
    assert rep["accounts_customer_id_fkey"] == 1 and rep["accounts_type_chk"] == 1
    assert rep["account_balances_currency_chk"] == 1 and rep["risk_profiles_score_chk"] == 1
    assert rep["account_balances_account_id_fkey"] == 0


def test_signal_lookback_edges(spark):
    cards = spark.createDataFrame(
        [("d", "e1", "t1", "cust_1", "2024-01-02T00:00:00.000000+00:00", 100.0, False, "manual_keyed")],
        "process_date string, event_id string, transaction_id string, customer_id string, event_time string, "
        "amount double, card_present boolean, entry_mode string").withColumn("amount", F.col("amount").cast(
            "decimal(18,2)"))
    logins = spark.createDataFrame(
        [("d", "cust_1", "2024-01-01T00:00:00.000000+00:00", "login_failed"),     # exactly 24h before: in
         ("d", "cust_1", "2024-01-01T12:00:00.000000+00:00", "login_failed"),     # in
         ("d", "cust_1", "2023-12-31T23:59:59.999999+00:00", "password_reset"),   # just outside
         ("d", "cust_1", "2024-01-02T00:00:00.000001+00:00", "new_device_registered"),  # after the card
         ("d", "cust_2", "2024-01-01T12:00:00.000000+00:00", "login_failed")],    # other customer
        "process_date string, customer_id string, event_time string, event_type string")
    customers = spark.createDataFrame([("cust_1", "restricted")], "customer_id string, customer_status string")
    cards = cards.withColumns({"account_id": F.lit("acct_1"), "merchant_country": F.lit("US"),
                               "merchant_category_code": F.lit("5411")})
    out = signals.fraud_signals(cards, logins, customers).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["failed_logins"], r["password_resets"], r["new_devices"]) == (2, 0, 0)
    assert r["rule_flags"] == ["card_not_present", "manual_keyed", "multiple_failed_logins", "restricted_customer"]
    assert r["signal_score"] == 70 and r["risk_level"] == "high"


def test_every_documented_signal_and_midnight(spark):
    """A failed login at 23:50 of one business date counts for a card at 00:10 of the next; a quiet card scores 0."""
    cards = spark.createDataFrame(
        [("2024-01-02", "e1", "t1", "cust_1", "2024-01-02T00:10:00.000000+00:00", "60000.00", False, "manual_keyed", "acct_1", "AE", "5944"),
         ("2024-01-02", "e2", "t2", "cust_2", "2024-01-02T00:10:00.000000+00:00", "5.00", True, "chip", "acct_2", "US", "5411")],
        "process_date string, event_id string, transaction_id string, customer_id string, event_time string, "
        "amount string, card_present boolean, entry_mode string, account_id string, merchant_country string, "
        "merchant_category_code string").withColumn("amount", F.col("amount").cast("decimal(28,2)"))
    logins = spark.createDataFrame(
        [("2024-01-01", "cust_1", "2024-01-01T23:50:00.000000+00:00", t, "NL")
         for t in ("login_failed", "login_failed", "password_reset", "new_device_registered")],
        "process_date string, customer_id string, event_time string, event_type string, country string")
    customers = spark.createDataFrame([("cust_1", "restricted"), ("cust_2", "active")], "customer_id string, customer_status string")
    accounts = spark.createDataFrame([("acct_1", "cust_1", "restricted", "2023-12-20"), ("acct_2", "cust_2", "open", "2020-01-01"),
                                      ("acct_2", "cust_1", "frozen", "2024-01-01")],  # not held by the card's customer
                                     "account_id string, customer_id string, account_status string, opened_at string").withColumn(
        "opened_at", F.col("opened_at").cast("date"))
    profiles = spark.createDataFrame([("cust_1", "high", True), ("cust_2", "low", False)],
                                     "customer_id string, kyc_risk_rating string, fraud_watchlist_flag boolean")
    out = {r["event_id"]: r for r in signals.fraud_signals(cards, logins, customers, accounts, profiles).collect()}
    assert out["e1"]["rule_flags"] == list(signals.SignalParams().weights)
    assert (out["e1"]["failed_logins"], out["e1"]["foreign_logins"], out["e1"]["signal_score"]) == (2, 4, 100)
    assert out["e2"]["rule_flags"] == [] and (out["e2"]["signal_score"], out["e2"]["risk_level"]) == (0, "low")


def test_documents_reach_silver_with_their_path(spark, tmp_root):
    d = os.path.join(tmp_root, "docs")
    os.makedirs(d)
    body = {f: "x" for f in rules.CARD_REQUIRED_FIELDS} | {"amount": "10.00", "currency": "USD", "card_present": True,
                                                           "authorization_status": "approved"}
    envelope = {"bronze_ingest_time": "t", "kafka_topic": "x", "kafka_partition": 1, "kafka_offset": 5, "kafka_key": None}
    for name, text in (("good.json", json.dumps(envelope | {"raw_value": json.dumps(body), "parsed_value": body}, indent=1)),
                       ("raw.json", json.dumps(envelope | {"raw_value": json.dumps(body | {"event_id": "y"})})),
                       ("broken.json", '{"event_id": ')):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    bronze = bronze_from_documents(spark, d, "2024-01-31")
    checked = silver.check_cards(bronze)
    assert {r["event_id"] for r in silver.silver_from_checked(checked).collect()} == {"x", "y"}
    rejects = silver.quarantine(checked, rules.JOB_SILVER_CARD).collect()
    assert [r["source_object_key"].rsplit("/", 1)[1] for r in rejects] == ["broken.json"]
    assert rejects[0]["rejection_reason"] == silver.NOT_OBJECT and rejects[0]["raw_record"].startswith('{"event_id"')


def test_streamed_fold_equals_batch_fold(spark, tmp_root):
    rows = [("r", None, ("o1", "c1", "O", "1.00"), 10), ("d", ("o1", "c1", "O", "1.00"), None, 13), ("r", None, ("o2", "c2", "O", "2.00"), 20),
            ("u", ("o1", "c1", "O", "1.00"), ("o1", "c1", "F", "1.00"), 11),  # late: the delete stays
            ("u", ("o2", "c2", "O", "2.00"), ("o2", "c2", "P", "2.00"), 25)]
    schema = f"op string, before {ROW}, after {ROW}, lsn long"
    for part in (rows[:2], rows[2:4], rows[4:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_root}/feed")
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_root}/feed")
        fold_stream(feed, f"{tmp_root}/state", f"{tmp_root}/checkpoint", "order_id").awaitTermination()
    streamed = current_state(spark, f"{tmp_root}/state").collect()
    assert streamed == core.fold_changes(spark.createDataFrame(rows, schema), "order_id").collect()
    assert [(r["order_id"], r["status"]) for r in streamed] == [("o2", "P")]


def test_bronze_documents_reader_is_reject_tolerant(spark, tmp_root):
    d = os.path.join(tmp_root, "docs")
    os.makedirs(d)
    good = {"bronze_ingest_time": "t", "kafka_topic": "x", "kafka_partition": 1, "kafka_offset": 5,
            "kafka_key": None, "raw_value": '{"event_id": "e1"}', "parsed_value": {"event_id": "e1"}}
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump(good, f, indent=2)
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write("{ not json")
    df = read_bronze_documents(spark, d)
    rows = df.collect()
    assert len(rows) == 2
    ok = [r for r in rows if r["_corrupt_record"] is None]
    assert len(ok) == 1 and ok[0]["kafka_offset"] == 5 and ok[0]["parsed_value"] is not None


def test_bronze_validation_collects_all_errors(spark):
    bodies = ['{"event_id": "e", "event_time": "", "source_system": "s", "schema_version": "1"}',
              '[1]', '{"risk_event_id": "r", "event_time": "t", "customer_id": "c", "source_system": "s", '
              '"schema_version": "1"}']
    checked = validation.check_bronze(envelope_rows(spark, bodies)).collect()
    errs = sorted((r["_errors"] for r in checked), key=len)
    assert errs[0] == []
    assert errs[1] == ["parsed_value must be a JSON object"]
    assert errs[2] == ["missing event fields: ['customer_id']", "event field is null or empty: event_time",
                       "event field is null or empty: customer_id"]
    sample = validation.sample_objects(envelope_rows(spark, bodies), 2)
    assert sample.count() == 2


def test_bronze_documents_validation(spark):
    """Every rule of a document: absent envelope fields, a body of text, an empty raw text, null partition and offset."""
    body = {"event_id": "e", "event_time": "t", "customer_id": "c", "source_system": "s", "schema_version": "1"}
    good = {"bronze_ingest_time": "t", "kafka_topic": "x", "kafka_partition": 1, "kafka_offset": 2, "kafka_key": None,
            "raw_value": "{}", "parsed_value": body}
    docs = {"good": json.dumps(good), "null key text": json.dumps(good | {"kafka_key": "k"}, indent=2),
            "empty": json.dumps(good | {"raw_value": "", "kafka_topic": "", "kafka_partition": None, "kafka_offset": None}),
            "lacks": json.dumps({k: v for k, v in good.items() if k not in ("kafka_key", "raw_value")}),
            "text body": json.dumps({k: v for k, v in good.items() if k != "kafka_topic"} | {"parsed_value": "{}"}),
            "list body": json.dumps(good | {"parsed_value": [1]}), "no body": json.dumps(good | {"parsed_value": None}),
            "null field": json.dumps(good | {"parsed_value": body | {"customer_id": None, "event_id": ""}}),
            "absent field": json.dumps(good | {"parsed_value": {"risk_event_id": "r", "event_time": "t"}}),
            "list": "[1]", "broken": '{"a": '}
    df = spark.createDataFrame([("d", k, v) for k, v in docs.items()] + [("d", "nothing", None)],
                               "process_date string, source_object_key string, document string")
    got = {r["source_object_key"]: r["_errors"] for r in validation.check_bronze_documents(df).collect()}
    no_object = "parsed_value must be a JSON object"
    assert got.pop("good") == [] and got.pop("null key text") == []
    assert got.pop("empty") == ["raw_value is null or empty", "kafka_topic is null or empty", "kafka_partition is null", "kafka_offset is null"]
    assert got.pop("lacks") == ["missing Bronze fields: ['kafka_key', 'raw_value']", "raw_value is null or empty"]
    assert got.pop("text body") == ["missing Bronze fields: ['kafka_topic']", no_object]
    assert got.pop("list body") == [no_object] and got.pop("no body") == [no_object]
    assert got.pop("null field") == ["event field is null or empty: customer_id",
                                     "missing event identifier: expected one of ['event_id', 'risk_event_id']"]
    assert got.pop("absent field") == ["missing event fields: ['customer_id', 'schema_version', 'source_system']",
                                       *[f"event field is null or empty: {x}" for x in ("customer_id", "source_system", "schema_version")]]
    assert set(got) == {"list", "broken", "nothing"} and all(e == ["document must be a JSON object"] for e in got.values())


@pytest.mark.parametrize("partitions, bucket", [(1, 300), (200, 300), (8, 7), (8, 10 ** 9)])
def test_signal_lookback_hot_customer_matches_brute_force(spark, partitions, bucket):
    """One customer holds all activity; counts must equal a pairwise count,
    edges and same-instant ties included, at any number of partitions and
    any size of buckets."""
    import random
    from datetime import datetime, timedelta, timezone

    rnd = random.Random(7)
    base = datetime(2024, 1, 1, tzinfo=timezone.utc)
    iso = lambda t: t.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")
    secs = [rnd.randrange(0, 5 * 86400, 600) for _ in range(400)]  # coarse grid: many exact ties
    types = ["login_failed", "password_reset", "new_device_registered", "login_success"]
    logins = [("d", "cust_hot", f"l{i}", iso(base + timedelta(seconds=s)), rnd.choice(types))
              for i, s in enumerate(secs)]
    card_secs = [rnd.randrange(0, 6 * 86400, 600) for _ in range(150)] + [secs[0] + 86400, secs[1]]
    cards = [("d", f"c{i}", f"t{i}", "cust_hot", iso(base + timedelta(seconds=s)), 10.0, True, "chip")
             for i, s in enumerate(card_secs)]
    cdf = spark.createDataFrame(cards, "process_date string, event_id string, transaction_id string, "
                                "customer_id string, event_time string, amount double, card_present boolean, "
                                "entry_mode string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    ldf = spark.createDataFrame(logins, "process_date string, customer_id string, event_id string, "
                                "event_time string, event_type string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r["event_id"]: (r["failed_logins"], r["password_resets"], r["new_devices"])
               for r in signals.login_counts_before(cdf, ldf, 86400, bucket_seconds=bucket).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, cs in enumerate(card_secs):
        inside = [t for (_, _, _, _, t), s in zip(logins, secs) if cs - 86400 <= s <= cs]
        want = (inside.count("login_failed"), inside.count("password_reset"), inside.count("new_device_registered"))
        assert got[f"c{i}"] == want, (i, got[f"c{i}"], want)


@pytest.mark.parametrize("hot_rows", [0, 30, 10 ** 6])
def test_hot_and_other_customers_match_brute_force(spark, hot_rows):
    """Each customer's counts and facts, whether or not their rows are dealt over buckets; a customer may be missing, and a time."""
    import random

    rnd = random.Random(11)
    iso = lambda s: f"2024-01-{1 + s // 86400:02d}T{s // 3600 % 24:02d}:{s // 60 % 60:02d}:00.000000+00:00"
    share = ["hot"] * 12 + ["b", "c", "d", None]
    logins = [(rnd.choice(share), rnd.randrange(0, 6 * 86400, 600)) for _ in range(150)]
    cards = [(rnd.choice(share), rnd.randrange(0, 6 * 86400, 600)) for _ in range(120)] + [("hot", None), ("b", None), ("no login", 600)]
    cdf = spark.createDataFrame([("d", f"c{i}", c, iso(s) if s is not None else "never") for i, (c, s) in enumerate(cards)],
                                "process_date string, event_id string, customer_id string, event_time string")
    ldf = spark.createDataFrame([(c, iso(s), "login_failed") for c, s in logins], "customer_id string, event_time string, event_type string")
    facts = spark.createDataFrame([("hot", 1), ("b", 2), ("no login", 3), ("no card", 4)], "customer_id string, fact int")
    df = signals.login_counts_before(cdf, ldf, 86400, facts=facts, hot_rows=hot_rows)
    got = sorted((r["event_id"], r["failed_logins"], r["fact"]) for r in df.collect())
    known = {r["customer_id"]: r["fact"] for r in facts.collect()}
    assert got == sorted((f"c{i}", sum(1 for x, t in logins if x == c and c is not None and s is not None and s - 86400 <= t <= s), known.get(c))
                         for i, (c, s) in enumerate(cards))


def test_customers_of_few_rows_move_no_start_rows(spark):
    cards = spark.createDataFrame([("d", f"e{i}", f"c{i % 5}", f"2024-01-02T{i % 24:02d}:00:00.000000+00:00") for i in range(200)],
                                  "process_date string, event_id string, customer_id string, event_time string")
    logins = spark.createDataFrame([("c1", "2024-01-01T12:00:00.000000+00:00", "login_failed")], "customer_id string, event_time string, event_type string")
    df = signals.login_counts_before(cards, logins, 86400)
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Union":
        plan = plan.children().apply(0)
    sums = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan)
    assert sums.count() == 200 + 2  # the cards and the edges of a login, which alone move by customer and bucket


def test_foreign_key_counts_rows_not_keys(spark):
    """Orphans are counted per child row (a hot missing key counts every row);
    a parent key that repeats does not change the result."""
    child = spark.createDataFrame([(f"a{i}", "cust_missing") for i in range(50)]
                                  + [("b1", "cust_1"), ("b2", "cust_1"), ("b3", None), ("b4", "cust_2")],
                                  "account_id string, customer_id string")
    parent = spark.createDataFrame([("cust_1",), ("cust_1",), ("cust_3",)], "customer_id string")
    null = F.lit(None).cast("string")
    accounts = child.withColumns({c: null for c in ("account_number", "routing_number", "account_type", "account_status", "opened_at", "created_at", "updated_at")})
    customers = parent.withColumns({c: null for c in ("first_name", "last_name", "email", "date_of_birth", "country_code", "customer_status", "created_at", "updated_at")})
    balances = spark.createDataFrame([], "balance_id string, account_id string, available_balance double, "
                                         "current_balance double, currency string, balance_as_of timestamp, created_at timestamp")
    profiles = spark.createDataFrame([], "risk_profile_id string, customer_id string, kyc_status string, "
                                         "kyc_risk_rating string, sanctions_screening_status string, pep_flag boolean, "
                                         "fraud_watchlist_flag boolean, risk_score double, updated_at timestamp")
    rep = {r["constraint_name"]: r["violation_count"] for r in core.constraint_report(customers, accounts, balances, profiles).collect()}
    assert rep["accounts_customer_id_fkey"] == 51  # 50 rows of the hot missing key + cust_2; NULL passes
    assert rep["customers_pkey"] == 2 and rep["accounts_pkey"] == 0


def test_signal_lookback_untimed_card_and_carry(spark):
    """A card whose time does not parse still comes out once, counting
    nothing, with its carried columns; logins without a customer count for
    no card."""
    cards = spark.createDataFrame(
        [("d", "e1", "t1", "cust_1", "not a time", 5.0),
         ("d", "e2", "t2", "cust_1", "2024-01-02T00:00:00.000000+00:00", 7.0)],
        "process_date string, event_id string, transaction_id string, customer_id string, event_time string, "
        "amount double")
    logins = spark.createDataFrame(
        [("d", "cust_1", "l1", "2024-01-01T12:00:00.000000+00:00", "login_failed"),
         ("d", None, "l2", "2024-01-01T12:00:00.000000+00:00", "login_failed")],
        "process_date string, customer_id string, event_id string, event_time string, event_type string")
    out = {r["event_id"]: r for r in signals.login_counts_before(cards, logins, 86400,
                                                                  carry=["transaction_id", "amount"]).collect()}
    assert sorted(out) == ["e1", "e2"]
    assert (out["e1"]["failed_logins"], out["e1"]["transaction_id"], out["e1"]["amount"]) == (0, "t1", 5.0)
    assert (out["e2"]["failed_logins"], out["e2"]["transaction_id"]) == (1, "t2")


def test_change_events_are_decoded(spark):
    row = T.StructType.fromDDL("id string, amount decimal(10,2), day date, at timestamp, n int, ok boolean")
    one = {"id": "a", "amount": "12.30", "day": 19753, "at": 1706700000000001, "n": 4, "ok": True}

    def event(op="u", before=None, after=one, lsn=7, **more):
        return {"before": before, "after": after, "source": {"lsn": lsn, "snapshot": "false"}, "op": op, "ts_ms": 5} | more

    texts = [json.dumps(event()), json.dumps({"schema": {"fields": []}, "payload": event("d", one, None, 8)}), json.dumps(event("c", after=one | {"amount": None, "n": None})),
             json.dumps(event(extra={"x": [1]})), None, "", "[]", "7", '{"op": "u"', json.dumps(event("t")), json.dumps(event(lsn=None)), json.dumps(event(after=None)),
             json.dumps(event("d")), json.dumps(event(after=one | {"amount": "1,5"})), json.dumps(event(after=one | {"n": "x"})), json.dumps(event(before=one | {"day": "soon"}))]
    df = spark.createDataFrame(list(enumerate(texts)), "no int, value string")
    got = {r["no"]: r for r in change_events.decode_events(df, row).collect()}
    obj = "event must be a JSON object"
    assert [got[i]["problem"] for i in range(len(texts))] == [
        None, None, None, None, obj, obj, obj, obj, obj, "unknown op: t", "missing source.lsn", "missing after", "missing before",
        "bad value: after.amount", "bad value: after.n", "bad value: before.day"]
    a = got[0]["after"]
    assert (a["id"], str(a["amount"]), str(a["day"]), a["n"], a["ok"]) == ("a", "12.30", "2024-01-31", 4, True) and got[0]["lsn"] == 7
    assert a["at"].microsecond == 1
    assert got[1]["after"] is None and got[1]["before"]["id"] == "a" and got[1]["op"] == "d"
    assert got[2]["after"]["amount"] is None and got[2]["problem"] is None
    decoded = change_events.decode_events(df, row)
    assert change_events.quarantined_events(decoded, "t").count() == 12
    assert core.fold_changes(change_events.changes_of(decoded), "id").count() == 0  # the delete has the greatest LSN


def _feed(spark, rows):
    return spark.createDataFrame(rows, f"op string, before {ROW}, after {ROW}, lsn long")


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_batch_rewrites_only_its_buckets(spark, tmp_root):
    state = f"{tmp_root}/state"
    first = [("r", None, (f"o{i}", "c", "O", "1.00"), i) for i in range(3000)]
    assert len(cdc_stream.merge_batch(_feed(spark, first), 0, state, "order_id", buckets=64)) == 64
    change = [("u", None, ("o7", "c", "F", "1.00"), 9000), ("d", ("o8", "c", "O", "1.00"), None, 9001), ("r", None, ("new", "c", "O", "2.00"), 9002)]
    touched = cdc_stream.merge_batch(_feed(spark, change), 1, state, "order_id")
    assert len(touched) <= 3 and _size(f"{state}/batch=1") < 0.1 * _size(f"{state}/batch=0")
    want = core.fold_changes(_feed(spark, first + change), "order_id").orderBy("order_id").collect()
    assert cdc_stream.current_state(spark, state).orderBy("order_id").collect() == want
    # the batch again, as after a failure, and a late change
    assert cdc_stream.merge_batch(_feed(spark, change), 1, state, "order_id") == touched
    assert cdc_stream.current_state(spark, state).orderBy("order_id").collect() == want
    cdc_stream.merge_batch(_feed(spark, [("u", None, ("o8", "c", "P", "1.00"), 8999)]), 2, state, "order_id")
    assert cdc_stream.current_state(spark, state).orderBy("order_id").collect() == want
    for n in range(3, 7):
        cdc_stream.merge_batch(_feed(spark, [("u", None, ("o9", "c", str(n), "1.00"), 9100 + n)]), n, state, "order_id")
    rows = {r["order_id"]: r["status"] for r in cdc_stream.current_state(spark, state).collect()}
    assert rows["o9"] == "6" and len(rows) == 3000 and "o8" not in rows
    assert len(os.listdir(f"{state}/manifests")) <= 5 and _size(state) < 2 * _size(f"{state}/batch=0")


def test_state_without_a_version_is_empty(spark, tmp_root):
    assert cdc_stream.current_state(spark, f"{tmp_root}/none").collect() == []
    schema = _feed(spark, []).schema
    empty = cdc_stream.current_state(spark, f"{tmp_root}/none", schema=schema)
    assert empty.columns == ["order_id", "customer_id", "status", "total", "source_lsn", "last_op"] and empty.count() == 0
    cdc_stream.merge_batch(_feed(spark, []), 0, f"{tmp_root}/state", "order_id")
    assert cdc_stream.current_state(spark, f"{tmp_root}/state").columns == empty.columns


def test_a_killed_batch_leaves_the_state(spark, tmp_root, monkeypatch):
    state = f"{tmp_root}/state"
    cdc_stream.merge_batch(_feed(spark, [("r", None, ("o1", "c", "O", "1.00"), 1)]), 0, state, "order_id")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(cdc_stream.Files, "write_text", killed)
        cdc_stream.merge_batch(_feed(spark, [("u", None, ("o1", "c", "F", "1.00"), 2)]), 1, state, "order_id")
    assert [r["status"] for r in cdc_stream.current_state(spark, state).collect()] == ["O"]
    cdc_stream.merge_batch(_feed(spark, [("u", None, ("o1", "c", "F", "1.00"), 2)]), 1, state, "order_id")
    assert [r["status"] for r in cdc_stream.current_state(spark, state).collect()] == ["F"]
