import json
from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata.operators import silver
from tests.conftest import envelope_rows

CARD = {
    "event_id": "evt_1", "transaction_id": "txn_1", "authorization_id": "auth_1", "customer_id": "cust_1",
    "account_id": "acct_1", "card_id": "card_1", "event_time": "2024-01-01T00:00:00+00:00", "amount": "42.50",
    "currency": "USD", "merchant_id": "mrc_1", "merchant_name": "Shop", "merchant_category_code": "5411",
    "merchant_country": "US", "merchant_city": "Chicago", "authorization_status": "approved",
    "channel": "card_present", "card_present": True, "entry_mode": "chip", "source_system": "s",
    "schema_version": "1.0.0",
}


def card(**over):
    d = dict(CARD)
    for k, v in over.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def reasons(spark, bodies):
    checked = silver.check_cards(envelope_rows(spark, bodies))
    return [r["rejection_reason"] for r in checked.orderBy("bronze_kafka_offset").collect()]


def test_body_shapes(spark):
    bad = '{"event_id": "x"'
    got = reasons(spark, [bad, "", "{'event_id': 'x'}", "[1, 2]", "null", card() + " trailing", card()])
    obj = silver.NOT_OBJECT
    assert got == [obj, obj, obj, obj, obj, obj, None]


def test_missing_vs_null_vs_empty(spark):
    got = reasons(spark, [card(merchant_id=..., card_id=...), card(merchant_name=None), card(merchant_name=""),
                          card(merchant_city=...), card(merchant_city=None)])
    assert got[0] == "missing fields: ['card_id', 'merchant_id']"
    assert got[1] == "field is null or empty: merchant_name"
    assert got[2] == "field is null or empty: merchant_name"
    assert got[3] is None and got[4] is None  # merchant_city is optional


def test_false_and_zero_are_not_empty(spark):
    assert reasons(spark, [card(card_present=False), card(amount=0)]) == [None, None]


def test_check_order(spark):
    got = reasons(spark, [card(currency="EUR", authorization_status="pending", amount="abc"),
                          card(authorization_status="pending", amount="abc"), card(amount="abc"),
                          card(merchant_id=..., currency="EUR")])
    assert got == ["unsupported currency: EUR", "unsupported authorization_status: pending",
                   "invalid amount: abc", "missing fields: ['merchant_id']"]


def test_amounts_half_even(spark):
    bodies = [card(event_id=f"e{i}", amount=a) for i, a in enumerate(
        ["42.505", "42.515", "-1", "NaN", "1e3", " 7.1 ", "abc", True])]
    rows = silver.check_cards(envelope_rows(spark, bodies)).orderBy("bronze_kafka_offset").collect()
    amounts = [r["amount"] for r in rows]
    assert amounts[:3] == [Decimal("42.50"), Decimal("42.52"), Decimal("-1.00")]
    assert amounts[3] is None and rows[3]["rejection_reason"] == "invalid amount: NaN"
    assert amounts[4] == Decimal("1000.00") and amounts[5] == Decimal("7.10")
    assert rows[6]["rejection_reason"] == "invalid amount: abc"
    assert rows[7]["rejection_reason"].startswith("invalid amount: ")


def test_duplicate_keys_last_wins(spark):
    body = card()[:-1] + ', "currency": "EUR"}'
    assert reasons(spark, [body]) == ["unsupported currency: EUR"]


def test_dedup_last_delivery_and_invalid_never_wins(spark):
    bodies = [card(merchant_name="first"), card(merchant_name="second"), card(currency="EUR")]
    rows = envelope_rows(spark, bodies, start_offset=9)  # offsets 9, 10, 11
    out = silver.silver_cards(rows).collect()
    assert len(out) == 1
    assert out[0]["merchant_name"] == "second" and out[0]["bronze_kafka_offset"] == 10


def test_dedup_is_per_process_date(spark):
    a = envelope_rows(spark, [card()], ingest_date="2024-01-30")
    b = envelope_rows(spark, [card()], ingest_date="2024-01-31")
    assert silver.silver_cards(a.unionByName(b)).count() == 2


def test_quarantine_and_counts(spark):
    bodies = [card(event_id="a"), card(event_id="a"), card(event_id="b", currency="EUR"), "oops"]
    checked = silver.check_cards(envelope_rows(spark, bodies))
    q = silver.quarantine(checked, "silver_card_authorizations").collect()
    assert sorted(r["rejection_reason"] for r in q) == [silver.NOT_OBJECT, "unsupported currency: EUR"]
    c = silver.run_counts(checked).collect()[0]
    assert (c["records_read"], c["records_valid"], c["records_rejected"], c["records_deduplicated"],
            c["duplicates"]) == (4, 2, 2, 1, 1)


def test_login_rules(spark):
    base = {"event_id": "l1", "login_event_id": "x", "customer_id": "c", "event_time": "t",
            "event_type": "login_success", "login_status": "success", "device_id": "d", "device_type": "ios",
            "ip_address": "1", "country": "US", "city": "X", "channel": "mobile", "source_system": "s",
            "schema_version": "1"}
    no_customer = {k: v for k, v in base.items() if k != "customer_id"}
    bodies = [json.dumps(base), json.dumps(no_customer), json.dumps({**base, "event_type": "page_view"}),
              json.dumps({**base, "login_status": "maybe"})]
    checked = silver.check_logins(envelope_rows(spark, bodies)).orderBy("bronze_kafka_offset").collect()
    assert [r["rejection_reason"] for r in checked] == [
        None, "missing fields: ['customer_id']", "unsupported event_type: page_view",
        "unsupported login_status: maybe"]


def test_amounts_are_rounded_from_all_their_digits(spark):
    import decimal
    import random

    r = random.Random(1)
    texts = ["0.0050000000000000000001", "0.005", "0.015", "0.0149999999999999999999999", "-0.0050000000000000000001", "1e-3", "5.0000000000000000000001e-3",
             "12345678901234567890123456.785", "12345678901234567890123456.7850000000000000001", "1.5E+3", ".5", "5.", "+7.125", "-7.135", "0e9", "0e999999", "1e-999999",
             "00000000000000000000000000000000000000000000000000000000000000000001.005", "99999999999999999999999999.994", "2.5e25", "0.00e-5", "-0.001"]
    texts += [f"{r.choice(['', '-'])}{r.randrange(10 ** r.randrange(1, 20))}.{''.join(r.choice('0005') for _ in range(r.randrange(1, 30)))}{r.choice(['', '', 'e-2', 'E3'])}" for _ in range(200)]
    none = ["", ".", "abc", "1_000", "NaN", "1e", "e5", "--1", "1.2.3", "1e99", "1" * 27, "Infinity"]
    got = {x["t"]: x["a"] for x in spark.createDataFrame([(t,) for t in texts + none], "t string").select("t", silver.parse_amount(F.col("t")).alias("a")).collect()}
    with decimal.localcontext(prec=200):
        for t in texts:
            want = decimal.Decimal(t).quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_EVEN)
            assert got[t] == want, t
    assert all(got[t] is None for t in none)
