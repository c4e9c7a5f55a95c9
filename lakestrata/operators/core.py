"""Core-banking reference tables: row counts (I1), change-feed fold to
current state (R1) and the constraint report (R2).

The constraint report re-states the tables' PRIMARY KEY, UNIQUE, NOT NULL,
FOREIGN KEY and CHECK rules as one grouped count over one scan of each table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions import rules


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table, by a union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def latest_changes(changes: DataFrame, key: str, lsn: str = "lsn") -> DataFrame:
    """The change with the greatest LSN of each key, deletes included. The key of
    a delete comes from ``before``. Changes with equal LSN are ordered by
    operation and content, so that a rerun picks the same one.

    ``row_number() = 1`` is pre-limited on the map side, so a key with a very
    long history still moves one row per task.
    """
    k = F.coalesce(F.col("after." + key), F.col("before." + key))
    w = Window.partitionBy("_key").orderBy(F.col(lsn).desc(), F.col("op").asc(), F.to_json("after").desc())
    return changes.withColumn("_key", k).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "_key")


def fold_changes(changes: DataFrame, key: str, lsn: str = "lsn") -> DataFrame:
    """Current state from a change feed (``op, before, after, lsn``): the
    change with the greatest LSN per key wins; a winning delete removes the
    row (R1)."""
    return latest_changes(changes, key, lsn).where(F.col("op") != "d").select(
        "after.*", F.col(lsn).alias("source_lsn"), F.col("op").alias("last_op"))


@dataclass
class TableRules:
    """The rules of one table: row conditions that are violations, keys that must
    not repeat, foreign keys (column, parent table), and the column they refer to."""

    rows: list[tuple[str, str, Column]]
    keys: list[tuple[str, str, str]]
    references: list[tuple[str, str, str]] = field(default_factory=list)
    referred: str = ""


def _not_null(*cols: str) -> list[tuple[str, str, Column]]:
    return [(f"{c}_not_null", "NOT NULL", F.col(c).isNull()) for c in cols]


def _check(name: str, cond: Column) -> tuple[str, str, Column]:
    """A CHECK is violated only when its condition is false (NULL passes)."""
    return (name, "CHECK", ~F.coalesce(cond, F.lit(True)))


def _table_rules() -> dict[str, TableRules]:
    c = F.col
    return {
        "customers": TableRules(
            [*_not_null("customer_id", "first_name", "last_name", "email", "date_of_birth", "country_code", "customer_status",
                        "created_at", "updated_at"),
             _check("customers_status_chk", c("customer_status").isin(*rules.CUSTOMER_STATUSES))],
            [("customers_pkey", "PRIMARY KEY", "customer_id"), ("customers_email_key", "UNIQUE", "email")], referred="customer_id"),
        "accounts": TableRules(
            [*_not_null("account_id", "customer_id", "account_number", "routing_number", "account_type", "account_status", "opened_at",
                        "created_at", "updated_at"),
             _check("accounts_type_chk", c("account_type").isin(*rules.ACCOUNT_TYPES)),
             _check("accounts_status_chk", c("account_status").isin(*rules.ACCOUNT_STATUSES))],
            [("accounts_pkey", "PRIMARY KEY", "account_id"), ("accounts_account_number_key", "UNIQUE", "account_number")],
            [("accounts_customer_id_fkey", "customer_id", "customers")], referred="account_id"),
        "account_balances": TableRules(
            [*_not_null("balance_id", "account_id", "available_balance", "current_balance", "currency",
                        "balance_as_of", "created_at"),
             _check("account_balances_currency_chk", c("currency") == rules.BALANCE_CURRENCY)],
            [("account_balances_pkey", "PRIMARY KEY", "balance_id")],
            [("account_balances_account_id_fkey", "account_id", "accounts")]),
        "customer_risk_profiles": TableRules(
            [*_not_null("risk_profile_id", "customer_id", "kyc_status", "kyc_risk_rating", "sanctions_screening_status",
                        "pep_flag", "fraud_watchlist_flag", "risk_score", "updated_at"),
             _check("risk_profiles_kyc_status_chk", c("kyc_status").isin(*rules.KYC_STATUSES)),
             _check("risk_profiles_rating_chk", c("kyc_risk_rating").isin(*rules.KYC_RISK_RATINGS)),
             _check("risk_profiles_sanctions_chk", c("sanctions_screening_status").isin(*rules.SANCTIONS_STATUSES)),
             _check("risk_profiles_score_chk", (c("risk_score") >= 0) & (c("risk_score") <= 100))],
            [("customer_risk_profiles_pkey", "PRIMARY KEY", "risk_profile_id"),
             ("customer_risk_profiles_customer_id_key", "UNIQUE", "customer_id")],
            [("customer_risk_profiles_customer_id_fkey", "customer_id", "customers")]),
    }


def constraint_report(customers: DataFrame, accounts: DataFrame, balances: DataFrame,
                      profiles: DataFrame) -> DataFrame:
    """Violation count per constraint of the four tables (R2).

    Each table is scanned once: a row is expanded into what it has to say about
    the rules (a violated row rule, a key, a foreign key, a key that others refer
    to). One count per (rule, key), partial before the shuffle so that no key can
    skew it, then decides every rule: repeated keys count their rows, foreign keys
    without a referred key theirs."""
    tables = {"customers": customers, "accounts": accounts, "account_balances": balances, "customer_risk_profiles": profiles}
    of = _table_rules()

    def said(rule: str, role: str, key: Column | None) -> Column:
        text = F.lit(None).cast("string") if key is None else key.cast("string")
        return F.struct(F.lit(rule).alias("rule"), F.lit(role).alias("role"), text.alias("key"))

    parts = []
    for name, df in tables.items():
        r = of[name]
        says = [F.when(bad, said(f"{name}.{rule}", "row", None)) for rule, _, bad in r.rows]
        says += [F.when(F.col(k).isNotNull(), said(f"{name}.{rule}", "key", F.col(k))) for rule, _, k in r.keys]
        says += [F.when(F.col(k).isNotNull(), said(f"{name}.{rule}", "child", F.col(k))) for rule, k, _ in r.references]
        says += [F.when(F.col(r.referred).isNotNull(), said(f"{child}.{rule}", "parent", F.col(r.referred)))
                 for child, own in of.items() for rule, _, parent in own.references if parent == name]
        parts.append(df.select(F.explode(F.array_compact(F.array(*says))).alias("s")).select("s.*"))
    role = lambda x: F.count_if(F.col("role") == x)
    per_key = reduce(DataFrame.unionByName, parts).groupBy("rule", "key").agg(
        role("row").alias("bad"), role("key").alias("n"), role("child").alias("children"), role("parent").alias("parents"))
    found = F.col("bad") + F.when(F.col("n") > 1, F.col("n")).otherwise(0) \
        + F.when(F.col("parents") == 0, F.col("children")).otherwise(0)
    counted = per_key.groupBy("rule").agg(F.sum(found).alias("found"))
    every = [(f"{t}.{rule}", t, rule, kind) for t, r in of.items() for rule, kind, _ in [*r.rows, *r.keys]]
    every += [(f"{t}.{rule}", t, rule, "FOREIGN KEY") for t, r in of.items() for rule, *_ in r.references]
    listed = customers.sparkSession.createDataFrame(every, "rule string, table_name string, constraint_name string, constraint_type string")
    return listed.join(counted, "rule", "left").select(
        "table_name", "constraint_name", "constraint_type", F.coalesce("found", F.lit(0)).cast("bigint").alias("violation_count"))
