"""Shared views of the oracle SQL, written on their own, not derived from the Spark code."""

from __future__ import annotations

VIEWS = {
    "plans": """
plans(plan_id, product_id, plan_name, plan_category, tenure_days, is_open_ended, rate_min,
      penalty_pct, lead_days, lead_lo, lead_hi) AS (VALUES
  (101, 101, 'flex_save', 'Savings', 90, FALSE, CAST(6 AS DECIMAL(5,2)), CAST(0 AS DECIMAL(5,2)), 15, 1, 30),
  (102, 101, 'fixed_save', 'Savings', 120, FALSE, 8, 2, 30, 1, 60),
  (103, 102, 'treasury_bills', 'Investments', 180, FALSE, 10, 5, 45, 1, 90),
  (104, 102, 'mutual_funds', 'Investments', NULL, TRUE, 8, 0, NULL, NULL, NULL))""",
    "event_types": """
event_types(event_type_id, event_type, event_type_code, event_type_category, event_type_stage,
            is_conversion_milestone, product_area) AS (VALUES
  (1, 'signup', 'signup_completed', 'Acquisition', 'Acquisition', TRUE, 'shared'),
  (2, 'view', 'app_login', 'Engagement', 'Engagement', FALSE, 'shared'),
  (4, 'purchase', 'wallet_funded', 'Activation', 'Activation', TRUE, 'shared'),
  (5, 'click', 'review_plan_options', 'Engagement', 'Consideration', FALSE, 'shared'),
  (15, 'error', 'wallet_funding_failed', 'Activation', 'Activation', FALSE, 'shared'))""",
    "positions": """
positions AS (
  SELECT o.o_custkey AS user_id, o.o_orderkey AS order_key, p.p_partkey AS part_key,
         concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                   strftime(l.l_shipdate, '%Y%m%d'), CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS position_key,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount_invested,
         CAST(l.l_shipdate AS DATE) AS start_date,
         l.l_returnflag = 'R' AS is_withdrawn_early,
         l.l_linestatus = 'F' AS is_redeemed,
         pl.*,
         CAST(l.l_shipdate AS DATE) + pl.tenure_days AS maturity_date,
         CASE WHEN l.l_returnflag = 'R' AND pl.tenure_days IS NOT NULL
              THEN greatest(CAST(l.l_shipdate AS DATE), CAST(l.l_shipdate AS DATE) + pl.tenure_days - pl.lead_days)
         END AS early_withdrawal_date
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN plans pl ON pl.plan_id = CASE p.p_type WHEN 'STANDARD' THEN 101 WHEN 'ECONOMY' THEN 102
       WHEN 'SMALL' THEN 102 WHEN 'MEDIUM' THEN 103 WHEN 'LARGE' THEN 103 WHEN 'PROMO' THEN 104 END)""",
    "milestones": """
milestones AS (
  SELECT a.user_id, s.signup_at,
         (SELECT min(e.ts) FROM events e WHERE e.user_id = a.user_id AND e.event_type = 'click'
             AND e.ts >= s.signup_at) AS kyc_at,
         (SELECT min(e.ts) FROM events e WHERE e.user_id = a.user_id AND e.event_type = 'purchase'
             AND e.ts >= s.signup_at) AS funded_at
  FROM (SELECT DISTINCT user_id FROM events WHERE event_type IN ('signup', 'click', 'purchase')) a
  LEFT JOIN (SELECT user_id, min(ts) AS signup_at FROM events WHERE event_type = 'signup' GROUP BY user_id) s
    ON s.user_id = a.user_id)""",
    "cash_flow": """
cash_flow AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS wallet_id, o_orderdate AS event_time,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failure' END AS status,
         CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'debit' ELSE 'credit' END AS direction,
         o_orderpriority
  FROM orders)""",
    "calendar": """
calendar AS (
  SELECT CAST(d AS DATE) AS date FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d))""",
}

_NEEDS = {"positions": ["plans"]}


def with_views(*names: str) -> str:
    """``WITH ...`` over the named views and what they need; append the SELECT."""
    ordered: list[str] = []
    for name in names:
        for need in [*_NEEDS.get(name, []), name]:
            if need not in ordered:
                ordered.append(need)
    return "WITH " + ",".join(VIEWS[name] for name in ordered)


def draw(seed: int | str, key: str) -> str:
    """The uniform draw in SQL."""
    return (
        f"(CAST(CAST(concat('0x', substr(md5(concat('{seed}:', {key})), 1, 8)) AS BIGINT) AS DOUBLE)"
        " / CAST(4294967296 AS DOUBLE))"
    )


def date_id(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"
