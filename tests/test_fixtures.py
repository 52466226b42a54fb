"""Hand-written rows that pin each business rule, independent of any SQL."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import calendar as cal
from ledgerline.functions import draws, money, text
from ledgerline.metrics import finance, growth
from ledgerline.operators import keys, lifecycle, positions, quality, sampling, skew, snapshots
from ledgerline.sources import catalog, readers, sinks
from ledgerline.session import scratch

D, T = dt.date, dt.datetime


def frame(spark, data, columns):
    return spark.createDataFrame(data, columns)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# --- calendar -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "start, end, months",
    [
        (T(2024, 1, 31), T(2024, 2, 29), 1),
        (T(2024, 1, 31), T(2024, 2, 28), 0),
        (T(2023, 11, 15), T(2024, 2, 14), 2),
        (T(2023, 11, 15), T(2024, 2, 15), 3),
        (T(2024, 3, 1, 12), T(2024, 4, 1, 11, 59), 0),
    ],
)
def test_complete_months(spark, start, end, months):
    assert one(spark, cal.complete_months(cal.ntz(start), cal.ntz(end))) == months


def test_month_end_clamps(spark):
    assert one(spark, cal.plus(cal.ntz(T(2024, 1, 31)), months=1)) == T(2024, 2, 29)
    assert one(spark, cal.month_length(cal.ntz(T(2024, 1, 31)))) == 29


def test_calendar_rows(spark):
    days = {r["date"]: r for r in cal.dim_date(spark, D(2024, 12, 28), D(2025, 1, 5)).collect()}
    assert len(days) == 9
    assert days[D(2024, 12, 30)]["week_of_year"] == 1
    assert (days[D(2024, 12, 29)]["day_of_week"], days[D(2024, 12, 29)]["is_weekend"]) == (0, True)
    assert (days[D(2024, 12, 28)]["day_of_week"], days[D(2024, 12, 28)]["is_weekend"]) == (6, True)
    assert days[D(2024, 12, 31)]["is_month_end"] and days[D(2025, 1, 1)]["is_month_start"]
    assert (days[D(2025, 1, 1)]["date_id"], days[D(2025, 1, 1)]["month_name"]) == (20250101, "January")
    wanted = schemas.STAR["dim_date"]
    got = cal.dim_date(spark, D(2024, 1, 1), D(2024, 1, 1)).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in wanted]


# --- text, money, draws ----------------------------------------------------------------------


def test_email_and_age(spark):
    assert one(spark, text.email(F.lit("Anna-Lou"), F.lit("O'Neil 3rd"), F.lit(7), "@example.com")) == "annalou.oneilrd7@example.com"
    assert [one(spark, text.age_bucket(F.lit(a))) for a in (17, 18, 24, 25, 65, 66)] == [
        None, "18-24", "18-24", "25-34", "55-65", None,
    ]
    assert one(spark, text.is_adult(F.lit(D(2006, 2, 28)), F.lit(D(2024, 2, 28))))
    assert not one(spark, text.is_adult(F.lit(D(2006, 3, 1)), F.lit(D(2024, 2, 29))))


def test_money(spark):
    ten = F.lit(Decimal("10.05")).cast("decimal(18,2)")
    assert one(spark, money.scaled(ten, "0.5")) == Decimal("5.03")
    assert one(spark, money.percent_of(ten, F.lit(Decimal("5.00")))) == Decimal("0.50")
    assert one(spark, money.signed(ten, F.lit("debit"), F.lit("success"))) == Decimal("-10.05")
    assert one(spark, money.signed(ten, F.lit("credit"), F.lit("failure"))) == Decimal("0.00")
    value = money.simple_interest_value(F.lit(Decimal("1000.00")).cast("decimal(18,2)"), F.lit(Decimal("8.00")), F.lit(120))
    assert one(spark, value) == Decimal("1026.30")


def test_draws_stay_in_range_and_repeat(spark):
    u = draws.uniform(1, F.col("id"))
    df = spark.range(5000).select(
        u.alias("u"),
        draws.uniform_int(u, F.lit(3), F.lit(9)).alias("i"),
        draws.triangular_int(u, F.lit(1), F.lit(15), F.lit(30)).alias("t"),
    )
    low, high, imin, imax, tmin, tmax, mean = df.agg(
        F.min("u"), F.max("u"), F.min("i"), F.max("i"), F.min("t"), F.max("t"), F.avg("t")
    ).first()
    assert 0 <= low and high < 1 and (imin, imax) == (3, 8) and tmin >= 1 and tmax <= 30
    assert abs(mean - (1 + 15 + 30) / 3) < 1
    assert rows(df) == rows(df.repartition(7))


def test_weights_become_intervals():
    assert sampling.cumulative([("a", 1.0), ("b", 3.0)]) == [("a", 0.0, 0.25), ("b", 0.25, 1.0)]
    assert all(
        abs(sum(w for c, *_, w in schemas.REGION_WEIGHTS if c == country) - 1) < 1e-9 for country, _ in schemas.COUNTRY_WEIGHTS
    )


def test_each_draw_lands_in_its_interval(spark):
    weights = [("a", 0.3), ("b", 0.003), ("c", 0.697)]
    df = spark.range(0, 1000).select((F.col("id") / 1000).alias("u"))
    out = sampling.range_bucket(df, F.col("u"), weights, "label")
    assert rows(out) == [(u / 1000, "a" if u < 300 else "b" if u < 303 else "c") for u in range(1000)]


def test_first_k_takes_k_of_each_group(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), "id")
    per_group = rows(sampling.first_k(df, ["g"], "id", 3, 5).groupBy("g").count())
    assert per_group == [(g, 3) for g in range(7)]


# --- balances and states ---------------------------------------------------------------------


def test_two_fundings_in_one_batch_both_count(spark):
    base = frame(
        spark,
        [(1, Decimal("0.00"), None, None), (2, Decimal("7.00"), 5, T(2024, 1, 1))],
        "wallet_id bigint, current_balance decimal(18,2), last_transaction_id bigint, last_updated_at timestamp_ntz",
    )
    changes = frame(
        spark,
        [(1, Decimal("10.00"), T(2024, 1, 2), 11), (1, Decimal("5.00"), T(2024, 1, 2), 12)],
        "wallet_id bigint, amount decimal(18,2), at timestamp_ntz, id bigint",
    )
    out = snapshots.apply_amounts(base, changes, "wallet_id", F.col("amount"), "at", "id")
    assert rows(out, "wallet_id", "current_balance", "last_transaction_id", "last_updated_at") == [
        (1, Decimal("15.00"), 12, T(2024, 1, 2)),
        (2, Decimal("7.00"), 5, T(2024, 1, 1)),
    ]


def test_last_login_never_moves_back_and_kyc_stays(spark):
    base = frame(spark, [(1, T(2024, 1, 10)), (2, None)], "user_id bigint, at timestamp_ntz")
    changes = frame(spark, [(1, T(2024, 1, 5)), (2, T(2024, 1, 3)), (2, T(2024, 1, 4))], "user_id bigint, ts timestamp_ntz")
    assert rows(snapshots.latest_time(base, changes, "user_id", "at", "ts")) == [(1, T(2024, 1, 10)), (2, T(2024, 1, 4))]
    assert rows(snapshots.earliest_time(base, changes, "user_id", "at", "ts")) == [(1, T(2024, 1, 10)), (2, T(2024, 1, 3))]


def test_merge_replaces_whole_rows(spark):
    columns = "id bigint, name string, n int"
    base = frame(spark, [(1, "a", 1), (2, "b", 2)], columns)
    delta = frame(spark, [(2, None, 9), (3, "c", 3)], columns)
    assert rows(snapshots.merge(base, delta, ["id"])) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]


KINDS = {"signup": "signup_at", "click": "kyc_at", "purchase": "funded_at"}


def test_lifecycle_states_and_kyc_replay(spark):
    events = frame(
        spark,
        [
            (1, "signup", T(2024, 1, 1)),
            (2, "signup", T(2024, 1, 1)), (2, "click", T(2024, 1, 2)), (2, "click", T(2024, 1, 5)),
            (3, "signup", T(2024, 1, 1)), (3, "click", T(2024, 1, 2)), (3, "purchase", T(2024, 1, 3)),
            (4, "purchase", T(2024, 1, 1)), (4, "signup", T(2024, 1, 2)), (4, "purchase", T(2024, 1, 4)),
            (5, "click", T(2024, 1, 1)),
        ],
        "user_id bigint, kind string, ts timestamp_ntz",
    )
    times = lifecycle.milestones(events, "user_id", "ts", "kind", KINDS)
    assert rows(times) == [
        (1, T(2024, 1, 1), None, None),
        (2, T(2024, 1, 1), T(2024, 1, 2), None),
        (3, T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 3)),
        (4, T(2024, 1, 2), None, T(2024, 1, 4)),
        (5, None, None, None),
    ]
    state = lifecycle.lifecycle_state(F.col("signup_at"), F.col("kyc_at"), F.col("funded_at"), D(2024, 1, 4))
    assert rows(times.select("user_id", state)) == [
        (1, "Registered"), (2, "KYC_Completed"), (3, "Activated"), (4, "Registered"), (5, None),
    ]


ATTEMPTS = [
    (1, 1, "failure", T(2024, 1, 1, 10)), (2, 1, "failure", T(2024, 1, 1, 11)), (3, 1, "success", T(2024, 1, 1, 11, 30)),
    (4, 1, "failure", T(2024, 1, 2)), (5, 2, "success", T(2024, 1, 1)), (6, 2, "failure", T(2024, 1, 3)),
    (7, 2, "success", T(2024, 1, 3)),
]


def test_retry_pairs(spark):
    df = frame(spark, ATTEMPTS, "id bigint, wallet bigint, status string, ts timestamp_ntz")
    status = F.col("status")
    pairs = lifecycle.retry_pairs(df, "wallet", "ts", "id", status == "failure", status == "success")
    assert rows(pairs, "id", "success_at", "lag_minutes") == [
        (1, T(2024, 1, 1, 11, 30), 90), (2, T(2024, 1, 1, 11, 30), 30), (4, None, None), (6, T(2024, 1, 3), 0),
    ]


def test_failed_funding_leaves_the_balance_alone(spark):
    df = frame(
        spark,
        [(1, T(2024, 1, 1), "failure", Decimal("50.00")), (2, T(2024, 1, 2), "success", Decimal("20.00")), (3, T(2024, 1, 3), "failure", Decimal("9.00"))],
        "id bigint, ts timestamp_ntz, status string, amount decimal(18,2)",
    ).withColumn("wallet", F.lit(1))
    moved = money.signed(F.col("amount"), F.lit("credit"), F.col("status"))
    out = skew.running(df, ["wallet"], ["ts", "id"], {"balance": ("sum", moved, True), "before": ("sum", moved, False)})
    assert rows(out, "id", "balance", "before") == [
        (1, Decimal("0.00"), None), (2, Decimal("20.00"), Decimal("0.00")), (3, Decimal("20.00"), Decimal("20.00")),
    ]


def test_sessions_break_after_thirty_idle_minutes(spark):
    times = [T(2024, 1, 1, 9, 50), T(2024, 1, 1, 10, 20), T(2024, 1, 1, 10, 50, 1), T(2024, 1, 1, 23, 55), T(2024, 1, 2, 0, 10)]
    df = frame(spark, [(i, 1, ts) for i, ts in enumerate(times)], "id bigint, user_id bigint, ts timestamp_ntz")
    out = lifecycle.sessions(df, "user_id", "ts", "id", 30, {})
    assert rows(out, "session_no", "session_start", "session_end", "events") == [
        (1, times[0], times[1], 2), (2, times[2], times[2], 1), (3, times[3], times[4], 2),
    ]


# --- positions -------------------------------------------------------------------------------


def test_open_ended_positions_never_mature(spark):
    df = frame(spark, [(1, D(2024, 1, 1), 90), (2, D(2024, 1, 1), None)], "id bigint, start date, tenure int")
    end = positions.maturity_date(F.col("start"), F.col("tenure"))
    status = positions.status_as_of(end, D(2030, 1, 1))
    assert rows(df.select("id", end, status)) == [(1, D(2024, 3, 31), "Matured"), (2, None, "Active")]


def test_maturing_today_is_still_active(spark):
    assert one(spark, positions.status_as_of(F.lit(D(2024, 3, 31)), D(2024, 3, 31))) == "Active"


def test_penalty_and_payout(spark):
    amount = F.lit(Decimal("200.00")).cast("decimal(18,2)")
    fine = positions.penalty(amount, F.lit(Decimal("5.00")), F.lit(True))
    assert one(spark, fine) == Decimal("10.00")
    assert one(spark, positions.penalty(amount, F.lit(Decimal("5.00")), F.lit(False))) is None
    none = F.lit(None).cast("decimal(18,2)")
    assert one(spark, positions.paid_out(F.lit("Redeemed"), none, amount, fine)) == Decimal("190.00")
    assert one(spark, positions.paid_out(F.lit("Active"), amount, amount, none)) is None


HELD = "user_id bigint, position_key string, start_date date, maturity_date date, is_withdrawn_early boolean, is_redeemed boolean"


def test_overdue_position_hides_its_user(spark):
    df = frame(
        spark,
        [
            (1, "a", D(2024, 1, 1), D(2024, 2, 1), False, False), (1, "b", D(2024, 1, 1), D(2024, 3, 10), False, False),
            (2, "c", D(2024, 1, 1), D(2024, 3, 10), False, False), (2, "d", D(2024, 1, 1), None, False, False),
            (3, "e", D(2024, 1, 1), None, False, False), (4, "f", D(2024, 1, 1), D(2024, 3, 5), True, False),
        ],
        HELD,
    )
    near = positions.near_maturity(df, D(2024, 3, 1), 30)
    assert rows(near, "user_id", "position_key", "days_left") == [(2, "c", 9)]


def test_aum_moves_on_start_and_closing_day(spark):
    df = frame(
        spark,
        [(D(2024, 1, 2), D(2024, 1, 4), Decimal("10.00")), (D(2023, 12, 1), None, Decimal("5.00")), (D(2023, 12, 1), D(2023, 12, 9), Decimal("99.00"))],
        "start_date date, closed_on date, amount_invested decimal(18,2)",
    )
    daily = rows(finance.aum_daily(df, D(2024, 1, 1), D(2024, 1, 5)))
    assert daily == [(D(2024, 1, d), Decimal(a)) for d, a in ((1, "5.00"), (2, "15.00"), (3, "15.00"), (4, "5.00"), (5, "5.00"))]
    for day, amount in daily:
        assert finance.aum(df, day).first()["aum"] == amount


# --- metrics -----------------------------------------------------------------------------------


def test_adoption_before_funding_does_not_convert(spark):
    df = frame(
        spark,
        [(T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 3)), (T(2024, 1, 1), T(2024, 1, 3), T(2024, 1, 2)), (T(2024, 1, 1), None, T(2024, 1, 2)), (T(2024, 1, 5), None, None)],
        "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz",
    )
    funnel = growth.ordered_funnel(df, [("signup", F.col("a")), ("funded", F.col("b")), ("adopted", F.col("c"))])
    assert rows(funnel) == [(1, "signup", 4, 1.0, 1.0), (2, "funded", 2, 0.5, 0.5), (3, "adopted", 1, 0.5, 0.25)]


def test_retention_edges(spark):
    signups = frame(spark, [(1, D(2024, 1, 1)), (2, D(2024, 1, 1)), (3, D(2024, 1, 5))], "user_id bigint, signup_day date")
    activity = frame(
        spark,
        [(1, T(2024, 1, 8)), (1, T(2024, 1, 8, 23, 59)), (2, T(2024, 1, 9)), (3, T(2024, 1, 12))],
        "user_id bigint, ts timestamp_ntz",
    )
    out = growth.retention(signups, activity, "user_id", "ts", [7, 30], D(2024, 1, 12))
    # User 1 came on day 7, user 2 on day 8; user 3's day 7 is not over, nor is any day 30.
    assert rows(out, "horizon_days", "eligible_users", "retained_users", "retention_rate") == [(7, 2, 1, 0.5)]


def test_retained_and_churned_add_up(tables):
    out = growth.retention_churn(tables.orders, "o_custkey", "o_orderdate").collect()
    active = {r["month"]: r["active_users"] for r in growth.monthly_active(tables.orders, "o_custkey", "o_orderdate").collect()}
    assert out
    for r in out:
        assert r["retained_users"] + r["churned_users"] == r["previous_users"] and r["retained_users"] <= active[r["month"]]


def test_segment_thresholds(spark):
    assert one(spark, finance.segment(F.lit(15), F.lit(5000))) == "High_Engagement_High_Balance"
    assert one(spark, finance.segment(F.lit(14), F.lit(4999))) == "Moderate_Engagement_Low_Balance"
    assert one(spark, finance.segment(F.lit(3), F.lit(0))) == "Low_Engagement_Low_Balance"


# --- keys -----------------------------------------------------------------------------------------


def test_dense_keys_with_one_value_in_a_third_of_the_rows(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000).alias("v"), F.xxhash64("id").alias("tie")
    )
    keyed = keys.dense_key(df, ["v", "tie"], "key", after=967).collect()
    in_order = sorted(keyed, key=lambda r: (r["v"], r["tie"]))
    assert [r["key"] for r in in_order] == list(range(968, 968 + 30000))


def test_dense_keys_of_nothing_and_with_nulls(spark):
    empty = frame(spark, [], "v int, tie int")
    assert keys.dense_key(empty, ["v", "tie"], "key").count() == 0
    some = frame(spark, [(2, 1), (None, 2), (1, 3)], "v int, tie int")
    assert rows(keys.dense_key(some, ["v", "tie"], "key"), "key", "v") == [(1, None), (2, 1), (3, 2)]


@pytest.mark.parametrize("n", [3, 5, 23])
def test_ntile_sizes(spark, n):
    sizes = [r[1] for r in rows(keys.ntile(spark.range(n), ["id"], 5, "tile").groupBy("tile").count())]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_tiles_of_several_columns(spark):
    df = frame(spark, [(i, i % 3, -i) for i in range(11)], "id bigint, a int, b int")
    one_by_one = keys.ntile(keys.ntile(df, ["a", "id"], 4, "ta"), ["b", "id"], 4, "tb")
    assert rows(keys.ntiles(df, "id", {"a": "ta", "b": "tb"}, 4)) == rows(one_by_one)


def test_every_draw_falls_into_an_interval(spark):
    """Three equal weights do not add up to one after rounding."""
    weights = [("a", 1.0), ("b", 1.0), ("c", 1.0), ("never", 0.0)]
    assert sampling.cumulative(weights)[2][-1] == 1.0
    df = frame(spark, [(i, u) for i, u in enumerate([0.0, 0.333333, 0.999999, 0.9999999, 1 - 2**-53])], "id bigint, u double")
    assert rows(sampling.range_bucket(df, F.col("u"), weights, "label"), "id", "label") == [
        (0, "a"), (1, "b"), (2, "c"), (3, "c"), (4, "c"),
    ]


def test_bad_rows_stop_a_load(spark):
    df = frame(spark, [(1, 5), (2, -5), (3, None)], "id bigint, amount int")
    fine = quality.row_checks(df, "t", {"small": F.col("amount") > 10})
    bad = quality.row_checks(df, "t", {"positive": F.col("amount") <= 0})
    assert rows(quality.enforce(fine)) == rows(fine)
    with pytest.raises(ValueError, match="positive on t: 1 of 3 rows"):
        quality.enforce(quality.report([fine, bad]))


def test_next_debit_is_the_first_later_one(spark):
    closed = frame(spark, [(1, "p", T(2024, 1, 5)), (1, "q", T(2024, 1, 9)), (2, "r", T(2024, 1, 1)), (None, "s", T(2024, 1, 1))], "user_id bigint, position_key string, closed_at timestamp_ntz")
    debits = frame(spark, [(1, 7, T(2024, 1, 5)), (1, 8, T(2024, 1, 7)), (1, 9, T(2024, 1, 8)), (None, 10, T(2024, 1, 2))], "user_id bigint, transaction_id bigint, event_time timestamp_ntz")
    assert rows(positions.next_debit(closed, debits), "position_key", "withdrawn_at") == [
        ("p", T(2024, 1, 7)), ("q", None), ("r", None), ("s", T(2024, 1, 2)),
    ]


# --- quality ----------------------------------------------------------------------------------------


def bad(df):
    return {r["check_name"]: (r["n_rows"], r["n_bad"]) for r in df.collect()}


def test_one_violation_per_check(spark):
    df = frame(
        spark,
        [
            (1, "a", Decimal("5.00"), "Active", 1e3), (2, "b", Decimal("0.00"), "Matured", 12345.0),
            (2, "c", Decimal("1.00"), "Withdrawn Early", None), (3, None, Decimal("1.00"), None, 1.0), (4, "toolong", None, "Redeemed", 1.0),
        ],
        "id bigint, name string, amount decimal(18,2), status string, big double",
    )
    checks = quality.row_checks(
        df,
        "t",
        {
            "amount_positive": F.col("amount") <= 0,
            "status_domain": ~F.col("status").isin(schemas.POSITION_STATUSES),
            "fits": quality.fits_decimal("big", 5, 2),
        },
    )
    assert bad(checks) == {"amount_positive": (5, 1), "status_domain": (5, 1), "fits": (5, 2)}
    assert bad(quality.unique(df, ["id"], "u", "t")) == {"u": (5, 1)}
    assert bad(quality.at_most_once(df, ["id"], "o", "t")) == {"o": (5, 1)}
    assert bad(quality.required(df, ["name", "id"], "t")) == {"not_null_name": (5, 1), "not_null_id": (5, 0)}
    assert bad(quality.max_length(df, {"name": 3}, "t")) == {"length_name": (5, 1)}
    parents = frame(spark, [(1,), (2,), (2,)], "pid bigint")
    assert bad(quality.foreign_key(df, "id", parents, "pid", "fk", "t")) == {"fk": (5, 2)}


def test_checks_on_an_empty_table(spark):
    empty = frame(spark, [], "id bigint, name string")
    assert bad(quality.unique(empty, ["id"], "u", "t")) == {"u": (None, 0)} or bad(quality.unique(empty, ["id"], "u", "t")) == {"u": (0, 0)}
    assert bad(quality.required(empty, ["name"], "t")) == {"not_null_name": (0, 0)}


# --- sources and sinks --------------------------------------------------------------------------------


def test_quoted_commas_and_quotes_survive_csv(spark):
    schema = schemas.contract("id int, description string")
    df = frame(spark, [(1, 'Asks, early, for "money"'), (2, "plain")], schema)
    path = sinks.overwrite_csv(df, scratch(spark, "quoted"))
    assert rows(readers.read_csv(spark, path, schema)) == rows(df)


def test_headers_match_by_name_in_any_case(spark):
    df = frame(spark, [("x", 1)], "NAME string, Id int")
    shaped = readers.conform(df, schemas.contract("id bigint not null, name string, extra date"))
    assert rows(shaped) == [(1, "x", None)]
    with pytest.raises(ValueError, match="missing"):
        readers.conform(df, schemas.contract("other int not null"))


def test_static_dimensions_from_csv(spark):
    header = [f.name for f in schemas.STAR["dim_product"].fields]
    df = frame(spark, [(101, "savings", 'Save, "grow"'), (102, "investments", "Invest")], ", ".join(f"{n} {k}" for n, k in zip(header, ("int", "string", "string"))))
    path = sinks.overwrite_csv(df, scratch(spark, "product"))
    loaded = catalog.load_static(spark, {"dim_product": path}, schemas.STAR)
    assert rows(loaded["dim_product"]) == rows(df)


def test_star_tables_register_by_name(spark):
    base = scratch(spark, "star")
    for name, schema in schemas.STAR.items():
        spark.createDataFrame([], schema).select(*[F.col(c).alias(c.upper()) for c in reversed(schema.names)]).write.parquet(f"{base}/{name}")
    views = catalog.register_star(spark, base)
    assert set(views) == set(schemas.STAR)
    for name, schema in schemas.STAR.items():
        assert [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        spark.catalog.dropTempView(name)


def test_internal_user_columns_stay_inside(spark):
    users = spark.createDataFrame([], schemas.STAR["dim_user"])
    public = sinks.export_public(users, schemas.INTERNAL_USER_COLUMNS, scratch(spark, "users"))
    assert len(public.columns) == 20 and not set(public.columns) & set(schemas.INTERNAL_USER_COLUMNS)


def test_landing_a_day_leaves_other_days_alone(spark):
    path = scratch(spark, "days")
    first = frame(spark, [(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "id bigint, d date")
    sinks.land_by_day(first, F.col("d"), path)
    again = frame(spark, [(3, D(2024, 1, 2))], "id bigint, d date")
    for _ in range(2):
        landed = sinks.land_by_day(again, F.col("d"), path)
    assert rows(landed, "id", "load_date") == [(1, D(2024, 1, 1)), (3, D(2024, 1, 2))]


def test_star_contracts_of_the_dimensions(spark):
    assert [len(schemas.STAR[t]) for t in ("dim_date", "dim_user", "fact_user_event", "fact_investment_position")] == [13, 25, 12, 18]
    assert (len(schemas.EVENT_TYPES), len(schemas.PLANS), len(schemas.TRANSACTION_TYPES)) == (16, 4, 4)
    assert rows(schemas.plan_rows(spark), "plan_id", "tenure_days", "is_open_ended", "lead_days") == [
        (101, 90, False, 15), (102, 120, False, 30), (103, 180, False, 45), (104, None, True, None),
    ]
    assert rows(schemas.fixed_rows(spark, [("it's \\ \"q\"", None)], "a string, b int")) == [("it's \\ \"q\"", None)]
