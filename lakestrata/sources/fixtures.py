"""Map the driver's tables onto the pipeline's event shapes.

The driver gives TPC-H-style tables, not Kafka topics. These functions turn
them into Kafka-shaped messages (``key, value, topic, partition, offset,
timestamp``) whose JSON bodies follow the card, login and risk event
contracts, plus audit runs, core-banking reference tables and a CDC feed.
Everything is derived row by row from the tables (joins on keys only), so the
work grows with the data. Deterministic fault rules on the keys produce the
rejects the Silver jobs must quarantine.

The SQL twin of every mapping lives in ``lakestrata.plans.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import rules
from lakestrata.functions.exprs import iso_utc
from lakestrata.sources.bronze import object_key
from lakestrata.sources.tables import input_partitions, spread, table

# Business date every fixture message is landed under.
FIXTURE_DATE = "2024-01-31"
KAFKA_PARTITIONS = 6


def json_object(*fields: tuple[str, Column]) -> Column:
    """Compact JSON object text from (key, value) pairs, in order.

    Strings are quoted, booleans, numbers and arrays written as JSON values.
    A NULL value leaves the key out entirely, which is how fixtures model a
    missing field.
    """
    return F.to_json(F.struct(*[value.alias(key) for key, value in fields]))


def _s(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# Card events are placed in the month the ``events`` (login) table covers, so
# look-back joins between cards and logins find partners.
CARD_TIME_ORIGIN = "2024-01-01 00:00:00"
CARD_TIME_SPAN_SECONDS = 30 * 86400


def card_event_ts() -> Column:
    """Event time of a card message: a fixed spread over January 2024 keyed
    on (l_orderkey, l_linenumber)."""
    offset = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % CARD_TIME_SPAN_SECONDS
    return F.timestamp_seconds(F.unix_seconds(F.lit(CARD_TIME_ORIGIN).cast("timestamp")) + offset)


def card_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card-authorization message per lineitem.

    lineitem joins orders (customer), part (merchant name, category), supplier
    (merchant id, city) and nation (merchant country). ``(l_orderkey,
    l_linenumber)`` repeats in the data, which yields natural duplicate events.
    """
    # The lines are shuffled once for the parts and once for the orders, so what is read of them is
    # made narrow first: the price as cents, flags and priority as small numbers (0: any other value).
    flag, line_status, priority = F.col("l_returnflag"), F.col("l_linestatus"), F.col("o_orderpriority")
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.when(flag == "R", 1).when(flag == "N", 2).otherwise(0).cast("byte").alias("flag"),
        F.when(line_status == "O", 1).when(line_status == "F", 2).when(line_status.isNotNull(), 0).cast("byte").alias("line_status")),
        input_partitions(spark))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 2)
         .when(priority == "3-MEDIUM", 3).when(priority == "4-NOT SPECIFIED", 4).otherwise(0).cast("byte").alias("priority"))
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # nation has 25 rows by definition of the schema: a fixed-size broadcast.
    na = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    # it is joined last: the estimated size of a joined supplier is a product, too large to broadcast
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # orders after parts: the lines of an order end up in one task, where later steps can drop repeated ones before they move them
    j = (li.join(pt, F.col("l_partkey") == F.col("p_partkey"))
         .join(od, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(na, F.col("s_nationkey") == F.col("n_nationkey")))

    ok, ln, pk, sk, ck = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey"))
    event_id = _s("evt_card_auth_", ok, "_", ln)
    cents, flag, line_status, priority = (F.col(c) for c in ("cents", "flag", "line_status", "priority"))
    amount_2dp = _s(F.floor(cents / 100).cast("bigint"), ".", F.lpad((cents % 100).cast("string"), 2, "0"))
    signed = F.when(pk % 241 == 0, _s("-", amount_2dp)).otherwise(amount_2dp)
    amount = (F.when(pk % 233 == 0, F.lit("abc"))
              .when(pk % 7 == 0, _s(signed, "5"))
              .otherwise(signed))
    status = F.when(flag == 1, "declined").when((flag == 2) & (sk % 20 == 1), "pending").otherwise("approved")
    entry_mode = (F.when(priority == 1, "manual_keyed").when(priority == 2, "chip").when(priority == 3, "contactless")
                  .when(priority == 4, "swipe").otherwise("card_on_file"))
    drop_two = pk % 227 == 0
    card_id = F.when(~drop_two, _s("card_", ck))
    body = json_object(
        ("event_id", event_id),
        ("transaction_id", _s("txn_", ok)),
        ("authorization_id", _s("auth_", ok, "_", ln)),
        ("customer_id", _s("cust_", ck)),
        ("account_id", _s("acct_", ok)),
        ("card_id", card_id),
        ("event_time", iso_utc(card_event_ts())),
        ("amount", amount),
        ("currency", F.when(sk % 20 == 0, "EUR").otherwise("USD")),
        ("merchant_id", F.when(~((pk % 223 == 0) | drop_two), _s("mrc_", sk))),
        ("merchant_name", F.when(pk % 229 == 0, F.lit("")).otherwise(F.col("p_name"))),
        ("merchant_category_code", F.col("p_brand")),
        ("merchant_country", F.col("n_name")),
        ("merchant_city", F.when(ln % 3 != 0, F.col("s_name"))),
        ("authorization_status", status),
        ("channel", F.when(line_status == 1, "ecommerce").otherwise("card_present")),
        ("card_present", line_status == 2),
        ("entry_mode", entry_mode),
        ("source_system", F.lit("synthetic-card-processor")),
        ("schema_version", F.lit("1.0.0")),
    )
    value = F.when(pk % 211 == 0, _s('["', event_id, '"]')).otherwise(body)
    return j.select(
        card_id.alias("key"),
        value.alias("value"),
        F.lit(rules.CARD_TOPIC).alias("topic"),
        (ok % KAFKA_PARTITIONS).cast("int").alias("partition"),
        ((ok * 8 + ln) * 1024 + pk % 1024).cast("bigint").alias("offset"),
        card_event_ts().alias("timestamp"),
    )


def login_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One login message per row of ``events``."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"), input_partitions(spark))
    eid, uid = F.col("event_id"), F.col("user_id")
    etype = (F.when(F.col("event_type") == "click", "login_success")
             .when(F.col("event_type") == "error", "login_failed")
             .when(F.col("event_type") == "signup", "new_device_registered")
             .when(F.col("event_type") == "purchase", "password_reset")
             .otherwise("page_view"))
    failed = F.col("event_type") == "error"
    device_type = F.when(eid % 3 == 0, "ios").when(eid % 3 == 1, "android").otherwise("web")
    country = F.when(F.col("value") >= 45, "NL").otherwise("US")
    city = F.when(eid % 223 == 0, "").when(country == "NL", "Amsterdam").otherwise("Chicago")
    customer_id = F.when(eid % 211 != 0, _s("cust_", uid))
    body = json_object(
        ("event_id", _s("evt_login_", eid)),
        ("login_event_id", _s("login_", eid)),
        ("customer_id", customer_id),
        ("event_time", iso_utc(F.col("ts"))),
        ("event_type", etype),
        ("login_status", F.when(failed, "failed").otherwise("success")),
        ("failure_reason", F.when(failed, "invalid_password")),
        ("device_id", _s("dev_", uid, "_", eid % 3)),
        ("device_type", device_type),
        ("ip_address", _s("10.", uid % 256, ".", eid % 256, ".", eid % 7 + 1)),
        ("country", country),
        ("city", city),
        ("channel", F.when(device_type == "web", "web").otherwise("mobile")),
        ("user_agent", F.when(device_type == "web", "Mozilla/5.0")
         .when(device_type == "ios", "BankingApp/5.2 iOS")),
        ("source_system", F.lit("synthetic-digital-banking-platform")),
        ("schema_version", F.lit("1.0.0")),
    )
    value = F.when(eid % 401 == 0, _s("not json {", eid)).otherwise(body)
    return ev.select(
        customer_id.alias("key"),
        value.alias("value"),
        F.lit(rules.LOGIN_TOPIC).alias("topic"),
        (uid % KAFKA_PARTITIONS).cast("int").alias("partition"),
        eid.cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def risk_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A risk event for every order; every fifth order lands twice (the second
    copy with a lower score), as repeated landings do."""
    od = (table(spark, sf_dir, "orders")
          .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
          .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 5 == 0, 2).otherwise(1)))))
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    score = F.when(F.col("copy") == 1, ok % 101).otherwise(F.greatest(ok % 101 - 3, F.lit(0)))
    level = (F.when(score >= 90, "high").when(score >= 75, "medium_high")
             .when(score >= 50, "medium").otherwise("low"))
    action = (F.when(level == "high", "block_and_review").when(level == "medium_high", "step_up_authentication")
              .when(level == "medium", "manual_review").otherwise("monitor"))
    flags = (F.when(ok % 13 == 0, F.array().cast("array<string>"))
             .when(F.col("o_orderstatus") == "P", F.array(F.lit("high_value_transaction"), F.lit("pending_order")))
             .otherwise(F.array(F.lit("high_value_transaction"))))
    body = json_object(
        ("risk_event_id", _s("risk_", ok)),
        ("event_time", iso_utc(F.col("o_orderdate"))),
        ("source_transaction_id", _s("txn_", ok)),
        ("customer_id", _s("cust_", ck)),
        ("account_id", _s("acct_", ok)),
        ("card_id", _s("card_", ck)),
        ("risk_score", score.cast("bigint")),
        ("risk_level", level),
        ("recommended_action", action),
        ("rule_flags", flags),
        ("explanation", F.lit("Order reviewed by the risk engine.")),
        ("source_events", F.array(_s("evt_card_auth_", ok, "_1"))),
        ("source_system", F.lit("synthetic-fraud-risk-engine")),
        ("schema_version", F.lit("1.0.0")),
    )
    value = F.when(ok % 29 == 0, F.lit("null")).otherwise(body)
    return od.select(
        _s("cust_", ck).alias("key"),
        value.alias("value"),
        F.lit(rules.RISK_TOPIC).alias("topic"),
        (ck % KAFKA_PARTITIONS).cast("int").alias("partition"),
        (ok * 2 + F.col("copy")).cast("bigint").alias("offset"),
        F.col("o_orderdate").alias("timestamp"),
    )


def login_documents(bronze: DataFrame) -> DataFrame:
    """Bronze login rows as JSON documents (``process_date, source_object_key,
    document``) that hold the envelope and the parsed body. Some lack envelope
    fields, have an empty raw text, a body that is text or no JSON at all."""
    off = F.col("kafka_offset")
    kept = lambda n, c: F.when(off % n != 0, F.col(c)).alias(c)
    envelope = F.to_json(F.struct("bronze_ingest_time", kept(89, "kafka_topic"), kept(83, "kafka_partition"), kept(79, "kafka_offset"),
                                  "kafka_key", F.when(off % 97 == 0, "").otherwise(F.col("raw_value")).alias("raw_value")))
    body = F.when(off % 401 == 0, "null").when(off % 73 == 0, '"{}"').otherwise(F.col("raw_value"))
    document = F.concat(F.expr("left(envelope, length(envelope) - 1)"), F.lit(',"parsed_value":'), F.col("body"), F.lit("}"))
    return bronze.withColumns({"envelope": envelope, "body": body}).select(
        F.col("ingest_date").alias("process_date"), object_key(rules.BRONZE_LOGIN_PREFIX).alias("source_object_key"),
        F.when(off % 307 == 0, "[1]").otherwise(document).alias("document"))


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pipeline audit record per order (five jobs, one per priority)."""
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_orderdate", "o_orderpriority")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    failed = (F.col("o_orderstatus") == "P") & (ok % 50 == 0)
    read = (ck % 1000 + 1).cast("bigint")
    rejected = F.when(ok % 3 == 0, ck % 7).otherwise(0).cast("bigint")
    finished = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + ck)
    return od.select(
        _s("run_", ok).alias("run_id"),
        _s("job_", F.col("o_orderpriority")).alias("job_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.lit(FIXTURE_DATE).alias("process_date"),
        F.lit(f"s3://{rules.BRONZE_BUCKET}/orders/").alias("input_prefix"),
        F.lit(f"s3://{rules.GOLD_BUCKET}/orders/").alias("output_prefix"),
        read.alias("records_read"),
        F.when(failed, F.lit(0)).otherwise(read - rejected).cast("bigint").alias("records_written"),
        rejected.alias("records_rejected"),
        iso_utc(F.col("o_orderdate")).alias("started_at"),
        iso_utc(finished).alias("finished_at"),
        F.when(failed, F.lit("No valid records produced.")).alias("error_message"),
    )


# --- core banking reference tables and their change feed ------------------------

def _money_text(cents: Column) -> Column:
    """Non-negative integer cents -> 'D.CC' text (exact, no float steps)."""
    return _s(F.floor(cents / 100).cast("bigint"), ".", F.lpad((cents % 100).cast("string"), 2, "0"))


def _day(origin: str, days: Column) -> Column:
    return F.date_add(F.lit(origin).cast("date"), days.cast("int")).cast("timestamp")


def core_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers: one per ``customer`` row. Every 250th shares an e-mail,
    every 97th household has an unknown status and every 151st no time of its
    last update, so UNIQUE, CHECK and NOT NULL rules have something to find."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ck = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    status = (F.when(seg.isin("AUTOMOBILE", "BUILDING"), "active").when(seg == "FURNITURE", "inactive")
              .when(seg == "MACHINERY", "restricted")
              .when(ck % 97 == 0, "suspended").otherwise("closed"))
    return c.select(
        _s("cust_", ck).alias("customer_id"),
        F.split(F.col("c_name"), "#").getItem(0).alias("first_name"),
        F.split(F.col("c_name"), "#").getItem(1).alias("last_name"),
        F.when(ck % 250 == 0, F.lit("shared@example.com"))
         .otherwise(_s(F.lower(F.regexp_replace(F.col("c_name"), "#", ".")), "@example.com")).alias("email"),
        F.date_add(F.lit("1960-01-01").cast("date"), (ck % 15000).cast("int")).alias("date_of_birth"),
        F.lit("US").alias("country_code"),
        status.alias("customer_status"),
        _day("2019-01-01", ck % 1000).alias("created_at"),
        F.when(ck % 151 != 0, _day("2022-01-01", ck % 700)).alias("updated_at"),
    )


def core_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """accounts: one per order; every 997th points at an unknown customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    prio = F.col("o_orderpriority")
    atype = (F.when(prio.isin("1-URGENT", "4-NOT SPECIFIED"), "checking").when(prio == "2-HIGH", "savings")
             .when(prio == "3-MEDIUM", "money_market").otherwise("brokerage"))
    st = F.col("o_orderstatus")
    astatus = F.when(st == "O", "open").when(st == "F", "closed").otherwise("frozen")
    return o.select(
        _s("acct_", ok).alias("account_id"),
        F.when(ok % 997 == 0, _s("cust_missing_", ck)).otherwise(_s("cust_", ck)).alias("customer_id"),
        F.lpad(ok.cast("string"), 12, "0").alias("account_number"),
        F.lit("021000021").alias("routing_number"),
        atype.alias("account_type"),
        astatus.alias("account_status"),
        F.date_add(F.lit("2023-01-01").cast("date"), (ok % 400).cast("int")).alias("opened_at"),
        _day("2023-01-01", ok % 400).alias("created_at"),
        F.when(ok % 1009 != 0, _day("2023-02-01", ok % 400)).alias("updated_at"),
    )


def core_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """account_balances: one per order; every 499th is not in USD."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    ok = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return o.select(
        _s("bal_", ok).alias("balance_id"),
        _s("acct_", ok).alias("account_id"),
        _money_text(cents).cast("decimal(18,2)").alias("available_balance"),
        _money_text(cents).cast("decimal(18,2)").alias("current_balance"),
        F.when(ok % 499 == 0, "EUR").otherwise("USD").alias("currency"),
        F.when(ok % 1013 != 0, F.col("o_orderdate").cast("timestamp")).alias("balance_as_of"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def core_risk_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_risk_profiles: one per customer; scores above 100 occur."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    ck = F.col("c_custkey")
    bal = F.col("c_acctbal")
    score_cents = F.floor((F.round(bal * 100).cast("bigint") + 100000) / 90).cast("bigint")
    kyc = F.element_at(F.array(*[F.lit(x) for x in rules.KYC_STATUSES]), (F.col("c_nationkey") % 4 + 1).cast("int"))
    return c.select(
        _s("rp_", ck).alias("risk_profile_id"),
        _s("cust_", ck).alias("customer_id"),
        kyc.alias("kyc_status"),
        F.when(bal < 0, "high").when(bal < 5000, "medium").otherwise("low").alias("kyc_risk_rating"),
        F.lit("clear").alias("sanctions_screening_status"),
        F.lit(False).alias("pep_flag"),
        (ck % 50 == 0).alias("fraud_watchlist_flag"),
        _money_text(score_cents).cast("decimal(5,2)").alias("risk_score"),
        F.when(ck % 149 != 0, _day("2023-06-01", ck % 200)).alias("updated_at"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CDC feed of the orders table: a snapshot read ('r') of every order,
    an update ('u') of every third and a delete ('d') of every seventh, with
    increasing log sequence numbers. One scan; each order expands to its
    changes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    ok = F.col("o_orderkey")
    row = F.struct(_s("ord_", ok).alias("order_id"), _s("cust_", F.col("o_custkey")).alias("customer_id"),
                   F.col("o_orderstatus").alias("status"),
                   _money_text(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"))
    updated = row.withField("status", F.lit("U"))
    changes = F.array_compact(F.array(
        F.struct(F.lit("r").alias("op"), F.lit(None).cast(row_type()).alias("before"), row.alias("after"),
                 (ok * 10).alias("lsn"), F.lit("true").alias("snapshot")),
        F.when(ok % 3 == 0, F.struct(F.lit("u").alias("op"), row.alias("before"), updated.alias("after"),
                                     (ok * 10 + 1).alias("lsn"), F.lit("false").alias("snapshot"))),
        F.when(ok % 7 == 0, F.struct(F.lit("d").alias("op"),
                                     F.when(ok % 3 == 0, updated).otherwise(row).alias("before"),
                                     F.lit(None).cast(row_type()).alias("after"),
                                     (ok * 10 + 2).alias("lsn"), F.lit("false").alias("snapshot")))))
    return o.select(F.explode(changes).alias("c")).select("c.*")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of the orders table as JSON text, one for each order, every second one wrapped with
    a schema; some are cut off, of an unknown operation, without an LSN or a row, or hold a bad amount."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ok, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    total = F.when(ok % 107 == 0, F.lit("abc")).otherwise(_money_text(F.round(F.col("o_totalprice") * 100).cast("bigint")))
    row = F.struct(_s("ord_", ok).alias("order_id"), _s("cust_", F.col("o_custkey")).alias("customer_id"), F.col("o_orderstatus").alias("status"),
                   total.alias("total"), F.datediff(date, F.lit("1970-01-01").cast("date")).alias("order_date"),
                   (F.unix_micros(date.cast("timestamp")) + ok).alias("changed_at"), (ok % 2 == 0).alias("gift"))
    op = F.when(ok % 103 == 0, "x").when(ok % 7 == 0, "d").when(ok % 3 == 0, "u").otherwise("c")
    event = F.struct(F.when(ok % 7 == 0, row).when(ok % 3 == 0, row).alias("before"),
                     F.when((ok % 7 != 0) & (ok % 113 != 0), row.withField("status", F.when(ok % 3 == 0, "U").otherwise(F.col("o_orderstatus")))).alias("after"),
                     F.struct(F.when(ok % 109 != 0, ok * 10).alias("lsn"), F.lit("false").alias("snapshot"), F.lit("orders").alias("table")).alias("source"),
                     op.alias("op"), (ok * 1000).alias("ts_ms"))
    text = F.to_json(event)
    text = F.when(ok % 2 == 0, F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), text, F.lit("}"))).otherwise(text)
    return o.select(ok.alias("event_no"), F.when(ok % 101 == 0, F.substring(text, 1, 60)).otherwise(text).alias("value"))


ORDER_ROW = "order_id string, customer_id string, status string, total decimal(15,2), order_date date, changed_at timestamp, gift boolean"


def core_changes(rows: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """A CDC feed of a core table: a snapshot read of every row, an update of
    ``column`` for keys divisible by three and a delete for those by seven."""
    n = F.regexp_extract(key, "([0-9]+)$", 1).cast("bigint")
    row = F.struct(*rows.columns)
    updated = row.withField(column, F.lit(value))
    none = F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType)
    changes = F.array_compact(F.array(
        F.struct(F.lit("r").alias("op"), none.alias("before"), row.alias("after"), (n * 10).alias("lsn")),
        F.when(n % 3 == 0, F.struct(F.lit("u").alias("op"), row.alias("before"), updated.alias("after"),
                                    (n * 10 + 1).alias("lsn"))),
        F.when(n % 7 == 0, F.struct(F.lit("d").alias("op"), row.alias("before"), none.alias("after"),
                                    (n * 10 + 2).alias("lsn")))))
    return rows.select(F.explode(changes).alias("c")).select("c.*")


def row_type() -> str:
    return "struct<order_id:string,customer_id:string,status:string,total:string>"
