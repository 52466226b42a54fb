"""Data-quality checks as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.money import signed
from ledgerline.functions.text import is_adult
from ledgerline.operators import lifecycle, quality, skew
from ledgerline.plans.registry import query
from ledgerline.plans.scalars import BIRTH_SQL, date_of_birth
from ledgerline.plans.views import with_views
from ledgerline.schemas import event_type_rows
from ledgerline.sources import standin


def expect(check: str, table: str, source: str, bad: str) -> str:
    """The SQL of a row check."""
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, count(*) AS n_rows,"
        f" count(*) FILTER (WHERE {bad}) AS n_bad FROM {source}"
    )


def expect_unique(check: str, table: str, columns: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, count(*) AS n_rows,"
        f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table})) AS n_bad FROM {table}"
    )


@query(expect_unique("unique_user", "customer", "c_custkey"))
def dq_unique_user(t):
    return quality.unique(t.customer, ["c_custkey"], "unique_user", "customer")


@query(expect_unique("unique_wallet", "lineitem", "l_orderkey, l_linenumber"))
def dq_unique_wallet(t):
    """Run on line items, whose (order, line) pairs repeat."""
    return quality.unique(t.lineitem, ["l_orderkey", "l_linenumber"], "unique_wallet", "lineitem")


@query(expect_unique("unique_email", "customer", "c_name"))
def dq_unique_email(t):
    return quality.unique(t.customer, ["c_name"], "unique_email", "customer")


_FIRSTS = """firsts AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at, min(ts) FILTER (WHERE event_type = 'click') AS kyc_at,
min(ts) FILTER (WHERE event_type = 'purchase') AS funded_at FROM events WHERE event_type IN ('signup', 'click', 'purchase') GROUP BY user_id)"""


def _firsts(t):
    kinds = {"signup": "signup_at", "click": "kyc_at", "purchase": "funded_at"}
    return lifecycle.first_times(t.events, "user_id", "ts", "event_type", kinds)


@query(f"WITH {_FIRSTS} " + expect("activated_implies_kyc", "users", "firsts", "funded_at IS NOT NULL AND (kyc_at IS NULL OR kyc_at > funded_at)"))
def dq_activated_implies_kyc(t):
    kyc_by_then = F.coalesce(F.col("kyc_at") <= F.col("funded_at"), F.lit(False))
    bad = {"activated_implies_kyc": F.col("funded_at").isNotNull() & ~kyc_by_then}
    return quality.row_checks(_firsts(t), "users", bad)


@query(
    """WITH w AS (SELECT c_custkey, c_acctbal > 0 AS is_activated, min(ts) AS activated_at FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'purchase' GROUP BY ALL) """
    + expect("activation_timestamp", "wallets", "w", "is_activated AND activated_at IS NULL")
)
def dq_activation_timestamp(t):
    """A positive balance claims activation; the funding event must be there."""
    paid = t.events.filter(F.col("event_type") == "purchase")
    first = paid.groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("ts").alias("activated_at"))
    wallets = t.customer.join(first, "c_custkey", "left")
    bad = {"activation_timestamp": (F.col("c_acctbal") > 0) & F.col("activated_at").isNull()}
    return quality.row_checks(wallets, "wallets", bad)


@query(f"WITH {_FIRSTS} " + expect("activation_after_creation", "wallets", "firsts", "funded_at <= signup_at"))
def dq_activation_after_creation(t):
    bad = {"activation_after_creation": F.col("funded_at") <= F.col("signup_at")}
    return quality.row_checks(_firsts(t), "wallets", bad)


_REQUIRED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query(" UNION ALL ".join(expect(f"not_null_{c}", "orders", "orders", f"{c} IS NULL") for c in _REQUIRED))
def dq_required_not_null(t):
    return quality.required(t.orders, _REQUIRED, "orders")


@query(expect("minimum_age", "orders", "orders", f"CAST({BIRTH_SQL} + INTERVAL 18 YEAR AS DATE) > CAST(o_orderdate AS DATE)"))
def dq_minimum_age(t):
    bad = {"minimum_age": ~is_adult(date_of_birth(), F.to_date("o_orderdate"))}
    return quality.row_checks(t.orders, "orders", bad)


@query(expect("amount_positive", "customer", "customer", "c_acctbal <= 0"))
def dq_amount_positive(t):
    return quality.row_checks(t.customer, "customer", {"amount_positive": F.col("c_acctbal") <= 0})


@query(expect("status_domain", "orders", "orders", "o_orderstatus NOT IN ('F', 'O')"))
def dq_status_domain(t):
    bad = {"status_domain": ~F.col("o_orderstatus").isin("F", "O")}
    return quality.row_checks(t.orders, "orders", bad)


@query(
    """SELECT 'lineitem_order' AS check_name, 'lineitem' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE NOT EXISTS
 (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')) AS n_bad FROM lineitem
UNION ALL SELECT 'event_user', 'events', count(*), count(*) FILTER (WHERE user_id NOT IN (SELECT c_custkey FROM customer)) FROM events"""
)
def dq_foreign_key(t):
    """Line items must have a settled order (a third has none); events must have a user."""
    settled = t.orders.filter(F.col("o_orderstatus") != "P")
    return quality.report(
        [
            quality.foreign_key(t.lineitem, "l_orderkey", settled, "o_orderkey", "lineitem_order", "lineitem"),
            quality.foreign_key(t.events, "user_id", t.customer, "c_custkey", "event_user", "events"),
        ]
    )


@query(
    """SELECT 'one_wallet_per_user' AS check_name, 'orders' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows,
count(*) FILTER (WHERE n > 1) AS n_bad FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)"""
)
def dq_one_wallet_per_user(t):
    """Orders stand for balance rows, so users with several show up."""
    return quality.at_most_once(t.orders, ["o_custkey"], "one_wallet_per_user", "orders")


@query(
    expect("length_p_name", "part", "part", "length(p_name) > 10")
    + " UNION ALL "
    + expect("length_p_brand", "part", "part", "length(p_brand) > 8")
)
def dq_string_length(t):
    return quality.max_length(t.part, {"p_name": 10, "p_brand": 8}, "part")


@query(
    expect("fits_decimal_8_2", "orders", "orders", "TRY_CAST(o_totalprice AS DECIMAL(8,2)) IS NULL")
    + " UNION ALL "
    + expect("fits_decimal_7_2", "orders", "orders", "TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL")
)
def dq_decimal_range(t):
    bad = {f"fits_decimal_{p}_2": quality.fits_decimal("o_totalprice", p, 2) for p in (8, 7)}
    return quality.row_checks(t.orders, "orders", bad)


@query(
    """SELECT c_custkey AS user_id, c_mktsegment AS segment, min(ts) AS event_time FROM customer
LEFT JOIN events ON user_id = c_custkey AND event_type = 'view' GROUP BY ALL HAVING min(ts) IS NULL"""
)
def dq_missing_event_time(t):
    """Users whose login row has no time, with their context."""
    logins = t.events.filter(F.col("event_type") == "view").groupBy(F.col("user_id").alias("c_custkey"))
    rows = t.customer.join(logins.agg(F.min("ts").alias("event_time")), "c_custkey", "left")
    return rows.filter(F.col("event_time").isNull()).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"), "event_time"
    )


@query(
    """SELECT 'lookup_complete' AS check_name, 'events' AS table_name, CAST(16 AS BIGINT) AS n_rows,
16 - count(DISTINCT event_type) AS n_bad FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase', 'error')"""
)
def dq_lookup_complete(t):
    """Event codes the log never shows."""
    codes = event_type_rows(t.spark).select("event_type_code")
    return quality.missing_codes(codes, standin.event_fact(t), "event_type_code", "lookup_complete", "events")


@query(
    f"WITH {_FIRSTS} "
    + expect("kyc_before_funding", "users", "firsts", "funded_at IS NOT NULL AND (kyc_at IS NULL OR kyc_at > funded_at)")
    + """ UNION ALL SELECT 'login_before_action', 'events', count(*), count(*) FILTER (WHERE login_at IS NULL) FROM
(SELECT event_type, max(CASE WHEN event_type = 'view' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS login_at
FROM events) WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT 'review_before_selection', 'events', count(*), count(*) FILTER (WHERE review_at IS NULL) FROM
(SELECT event_type, max(CASE WHEN event_type = 'click' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS review_at
FROM events) WHERE event_type = 'purchase'"""
)
def dq_event_precedence(t):
    """KYC comes before funding, a login before an action, a review before a selection."""
    kyc_by_then = F.coalesce(F.col("kyc_at") <= F.col("funded_at"), F.lit(False))
    first = quality.row_checks(
        _firsts(t), "users", {"kyc_before_funding": F.col("funded_at").isNotNull() & ~kyc_by_then}
    )
    kind, ts = F.col("event_type"), F.col("ts")
    needed = t.events.filter(kind.isin("view", "click", "purchase")).select("event_id", "user_id", "ts", "event_type")
    seen = skew.running(
        needed,
        ["user_id"],
        ["ts", "event_id"],
        {
            "login_at": ("max", F.when(kind == "view", ts), True),
            "review_at": ("max", F.when(kind == "click", ts), True),
        },
    )
    then = {
        "login_before_action": (kind.isin("click", "purchase"), F.col("login_at").isNull()),
        "review_before_selection": (kind == "purchase", F.col("review_at").isNull()),
    }
    return quality.report([first, quality.row_checks(seen, "events", then)])


@query(
    with_views("cash_flow")
    + """, b AS (SELECT *, coalesce(sum(CASE WHEN status IS DISTINCT FROM 'success' THEN 0 WHEN direction = 'credit' THEN amount ELSE -amount END) OVER
(PARTITION BY wallet_id ORDER BY event_time, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cash_flow)
"""
    + expect("sufficient_balance", "orders", "b", "direction = 'debit' AND status = 'success' AND amount > before")
)
def dq_sufficient_balance(t):
    """Successful debits above the balance the wallet had before them."""
    moved = signed(F.col("amount"), F.col("direction"), F.col("status"))
    ledger = skew.running(
        standin.cash_flow(t), ["wallet_id"], ["event_time", "transaction_id"], {"before": ("sum", moved, False)}
    )
    before = F.coalesce("before", F.lit(0).cast("decimal(18,2)"))
    debit = (F.col("direction") == "debit") & (F.col("status") == "success")
    return quality.row_checks(ledger, "orders", {"sufficient_balance": debit & (F.col("amount") > before)})


@query(
    """SELECT 'failed_no_balance_change' AS check_name, 'events' AS table_name, count(*) AS n_rows,
count(*) FILTER (WHERE event_type = 'error' AND reported <> coalesce(earlier, 0)) AS n_bad FROM (SELECT event_type,
sum(CAST(value AS DECIMAL(18,2))) OVER w AS reported, sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
AS earlier FROM events WHERE event_type IN ('purchase', 'error') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
)
def dq_failed_no_balance_change(t):
    """The balance the log reports must be the same before and after a failed attempt.

    The stand-in log reports what was attempted, whatever its status, so failures show here.
    """
    ledger = skew.running(
        standin.wallet_transactions(t),
        ["wallet_id"],
        ["event_time", "event_id"],
        {"before": ("sum", F.col("amount"), False), "after": ("sum", F.col("amount"), True)},
    )
    zero = F.lit(0).cast("decimal(18,2)")
    changed = F.coalesce("before", zero) != F.col("after")
    return quality.row_checks(
        ledger, "events", {"failed_no_balance_change": (F.col("status") == "failure") & changed}
    )


@query(
    """SELECT 'once_per_user' AS check_name, 'events' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_bad
FROM (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IN ('signup', 'click') GROUP BY ALL)"""
)
def dq_once_per_user(t):
    steps = t.events.filter(F.col("event_type").isin("signup", "click"))
    return quality.at_most_once(steps, ["user_id", "event_type"], "once_per_user", "events")


@query(
    """SELECT 'degenerate_key_match' AS check_name, 'lineitem' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_bad
FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = l_orderkey"""
)
def dq_degenerate_key_match(t):
    """The transaction id a position carries must be that of a settled transaction."""
    settled = standin.cash_flow(t).filter("status = 'success'")
    return quality.foreign_key(t.lineitem, "l_orderkey", settled, "transaction_id", "degenerate_key_match", "lineitem")
