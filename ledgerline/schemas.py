"""Table contracts of the star schema, the fixed dimension rows and the input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(15,2)": T.DecimalType(15, 2),
    "decimal(5,2)": T.DecimalType(5, 2),
}


def contract(columns: str) -> T.StructType:
    """A schema from "name type [not null], ..."; needs no session, unlike ``fromDDL``."""
    fields = []
    for column in columns.split(", "):
        name, kind, *mandatory = column.split()
        fields.append(T.StructField(name, _TYPES[kind], not mandatory))
    return T.StructType(fields)


# --- star schema -----------------------------------------------------------------

STAR = {
    "dim_date": contract(
        "date_id int not null, date date, year int, quarter int, month int, month_name string,"
        " day int, week_of_year int, day_of_week int, day_name string, is_weekend boolean,"
        " is_month_start boolean, is_month_end boolean"
    ),
    "dim_event_type": contract(
        "event_type_id int not null, event_type_code string not null,"
        " event_type_display_name string not null, event_type_description string not null,"
        " event_type_category string not null, event_type_stage string not null,"
        " is_conversion_milestone boolean not null, product_area string not null"
    ),
    "dim_product": contract(
        "product_id int not null, product_name string not null, product_display_name string not null"
    ),
    "dim_plan": contract(
        "plan_id int not null, product_id int not null, plan_name string not null,"
        " plan_display_name string not null, plan_category string not null,"
        " plan_weight decimal(5,2) not null, interest_rate_min decimal(5,2) not null,"
        " interest_rate_max decimal(5,2) not null, tenure_days int, is_open_ended boolean not null,"
        " liquidity_type string not null, early_withdrawal_allowed boolean not null,"
        " penalty_rate_pct decimal(5,2) not null, risk_level string not null"
    ),
    "dim_transaction_type": contract(
        "transaction_type_id int not null, transaction_type_code string not null,"
        " transaction_type_name string not null, transaction_type_description string not null,"
        " transaction_category string not null, transaction_direction string not null"
    ),
    "dim_user": contract(
        "user_id bigint not null, first_name string not null, last_name string not null,"
        " country string not null, region string not null, city string not null,"
        " email_address string not null, reported_annual_income decimal(18,2) not null,"
        " acquisition_channel string not null, device_type string not null,"
        " customer_persona string not null, kyc_completed boolean not null,"
        " date_of_birth date not null, birth_date_id int not null,"
        " signup_date timestamp_ntz not null, signup_date_id int not null,"
        " is_activated_user boolean not null, wallet_activation_timeframe int,"
        " customer_behaviour_segment string not null, is_immediate_login boolean not null,"
        " supposed_activation_date timestamp_ntz, kyc_completion_date timestamp_ntz,"
        " last_login_at timestamp_ntz, created_at timestamp_ntz not null,"
        " last_updated_at timestamp_ntz not null"
    ),
    "dim_wallet": contract(
        "wallet_id bigint not null, user_id bigint not null, wallet_currency string not null,"
        " wallet_created_at timestamp_ntz not null, wallet_activated_at timestamp_ntz,"
        " wallet_created_date_id int not null, wallet_activated_date_id int,"
        " created_at timestamp_ntz not null, last_updated_at timestamp_ntz not null"
    ),
    "fact_user_event": contract(
        "event_id bigint not null, user_id bigint not null, event_type_id int not null,"
        " wallet_id bigint, plan_id int, event_time timestamp_ntz not null,"
        " event_date_id int not null, device_type string, is_money_movement_activity boolean,"
        " transaction_type_id int, transaction_id bigint, investment_id bigint"
    ),
    "fact_transaction": contract(
        "transaction_id bigint not null, wallet_id bigint not null,"
        " transaction_type_id int not null, transaction_amount decimal(18,2) not null,"
        " transaction_status string not null, transaction_timestamp timestamp_ntz not null,"
        " transaction_date_id int not null"
    ),
    "fact_investment_position": contract(
        "investment_id bigint not null, user_id bigint not null, wallet_id bigint not null,"
        " plan_id int not null, amount_invested decimal(18,2) not null,"
        " expected_maturity_value decimal(18,2), investment_start_date timestamp_ntz not null,"
        " investment_start_date_id int not null, investment_maturity_date timestamp_ntz,"
        " investment_maturity_date_id int, investment_status string not null,"
        " is_withdrawn_early boolean not null, penalty_amount decimal(18,2),"
        " amount_paid_out decimal(18,2), early_withdrawal_date timestamp_ntz,"
        " early_withdrawal_date_id int, created_at timestamp_ntz not null,"
        " last_updated_at timestamp_ntz not null"
    ),
    "fact_wallet_balance": contract(
        "wallet_id bigint not null, user_id bigint not null,"
        " current_balance decimal(15,2) not null, created_at timestamp_ntz not null,"
        " last_updated_at timestamp_ntz not null, last_updated_date_id int,"
        " last_transaction_id bigint, last_event_id bigint"
    ),
}

# Columns of the user dimension that steer the simulation and stay internal.
INTERNAL_USER_COLUMNS = [
    "is_activated_user",
    "wallet_activation_timeframe",
    "customer_behaviour_segment",
    "is_immediate_login",
    "supposed_activation_date",
]

POSITION_STATUSES = ["Active", "Redeemed", "Matured", "Withdrawn_Early"]

# --- input tables ----------------------------------------------------------------

INPUT = {
    "region": contract("r_regionkey int, r_name string"),
    "nation": contract("n_nationkey int, n_name string, n_regionkey int"),
    "customer": contract(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": contract("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": contract(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": contract(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": contract(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": contract(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}

# --- fixed values: event types, plans, transaction types, draw parameters ----------

EVENT_TYPES = [
    # id, code, category, stage, milestone, product area
    (1, "signup_completed", "Acquisition", "Acquisition", True, "shared"),
    (2, "app_login", "Engagement", "Engagement", False, "shared"),
    (3, "kyc_completed", "Onboarding", "Onboarding", True, "shared"),
    (4, "wallet_funded", "Activation", "Activation", True, "shared"),
    (5, "review_plan_options", "Engagement", "Consideration", False, "shared"),
    (6, "plan_selected", "Consideration", "Consideration", False, "shared"),
    (7, "savings_plan_created", "Engagement", "Adoption", True, "savings"),
    (8, "investment_plan_created", "Engagement", "Adoption", True, "investment"),
    (9, "review_current_investment", "Engagement", "Engagement", False, "shared"),
    (10, "request_early_withdrawal", "Liquidity_Action", "Retention", False, "shared"),
    (11, "investment_vests", "Liquidity_Action", "Retention", False, "shared"),
    (12, "investment_proceeds_wallet_transfer", "Liquidity_Action", "Retention", False, "shared"),
    (13, "wallet_withdrawal", "Liquidity_Action", "Retention", False, "shared"),
    (14, "assets_sale", "Liquidity_Action", "Retention", False, "investment"),
    (15, "wallet_funding_failed", "Activation", "Activation", False, "shared"),
    (16, "withdrawal_failed", "Liquidity_Action", "Retention", False, "shared"),
]

PLANS = [
    # id, product, name, category, weight, rate min, rate max, tenure, open ended,
    # liquidity, penalty pct, risk
    (101, 101, "flex_save", "Savings", "0.30", "6", "6", 90, False, "flexible", "0", "Low"),
    (102, 101, "fixed_save", "Savings", "0.35", "8", "8", 120, False, "locked", "2", "Medium"),
    (103, 102, "treasury_bills", "Investments", "0.20", "10", "10", 180, False, "locked", "5", "Medium"),
    (104, 102, "mutual_funds", "Investments", "0.15", "8", "18", None, True, "flexible", "0", "High"),
]

TRANSACTION_TYPES = [
    # id, code, category, direction
    (1, "wallet_funding", "Funding", "credit"),
    (2, "wallet_withdrawal", "Withdrawal", "debit"),
    (3, "investment_funding", "Investment", "debit"),
    (4, "investment_proceeds_transfer", "Investment", "credit"),
]

ACQUISITION_CHANNELS = [
    # channel, weight
    ("Organic Search", 0.25),
    ("Paid Social", 0.2),
    ("Referral Program", 0.2),
    ("Direct Traffic", 0.15),
    ("Paid Search", 0.1),
    ("Partnerships", 0.1),
]

COUNTRY_WEIGHTS = [("UK", 0.8), ("Ireland", 0.2)]

REGION_WEIGHTS = [
    # country, region, weight
    ("UK", "Greater London", 0.3),
    ("UK", "Wales", 0.15),
    ("UK", "Scotland", 0.15),
    ("UK", "North West", 0.1),
    ("UK", "South East", 0.1),
    ("UK", "Midlands", 0.2),
    ("Ireland", "Dublin Region", 0.4),
    ("Ireland", "Rest of Ireland", 0.6),
]

CITY_WEIGHTS = [
    # region, city, weight
    ("Greater London", "London", 1.0),
    ("Wales", "Cardiff", 0.5),
    ("Wales", "Swansea", 0.3),
    ("Wales", "Newport", 0.2),
    ("Scotland", "Edinburgh", 0.4),
    ("Scotland", "Glasgow", 0.4),
    ("Scotland", "Aberdeen", 0.2),
    ("North West", "Manchester", 0.5),
    ("North West", "Liverpool", 0.3),
    ("North West", "Chester", 0.2),
    ("South East", "Brighton", 0.4),
    ("South East", "Reading", 0.35),
    ("South East", "Southampton", 0.25),
    ("Midlands", "Birmingham", 0.45),
    ("Midlands", "Coventry", 0.2),
    ("Midlands", "Leicester", 0.2),
    ("Midlands", "Nottingham", 0.15),
    ("Dublin Region", "Dublin", 1.0),
    ("Rest of Ireland", "Cork", 0.4),
    ("Rest of Ireland", "Galway", 0.25),
    ("Rest of Ireland", "Limerick", 0.2),
    ("Rest of Ireland", "Waterford", 0.15),
]

SEGMENTS = [
    # segment, monthly logins lo, hi, early withdrawal probability
    ("High_Engagement_High_Balance", 20, 40, 0.05),
    ("High_Engagement_Low_Balance", 15, 30, 0.15),
    ("Moderate_Engagement_High_Balance", 8, 15, 0.08),
    ("Moderate_Engagement_Low_Balance", 4, 10, 0.20),
    ("Low_Engagement_High_Balance", 1, 3, 0.10),
    ("Low_Engagement_Low_Balance", 0, 2, 0.30),
]

PERSONA_SEGMENTS = [
    # persona, weights over SEGMENTS in the order above
    ("Starter Investor", [0.02, 0.55, 0.03, 0.2, 0.0, 0.2]),
    ("Goal-Oriented Saver", [0.03, 0.15, 0.1, 0.45, 0.07, 0.2]),
    ("Wealth Builder", [0.2, 0.05, 0.45, 0.1, 0.15, 0.05]),
    ("Active Investor", [0.7, 0.05, 0.15, 0.05, 0.05, 0.0]),
    ("Capital Preserver", [0.05, 0.0, 0.35, 0.0, 0.6, 0.0]),
]

EARLY_WITHDRAWAL_LEAD = [
    # plan, shortest, most likely, longest lead in days before maturity
    (101, 1, 15, 30),
    (102, 1, 30, 60),
    (103, 1, 45, 90),
]

DAILY_BANDS = [
    # table, fewest and most rows expected per day
    ("fact_user_event", 4000, 8000),
    ("fact_transaction", 2500, 6000),
    ("fact_investment_position", 200, 800),
]

# --- small dimension frames ---------------------------------------------------------


def fixed_rows(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A few fixed rows as a VALUES list: known to the optimizer, with no Python worker behind."""
    typed = [column.split() for column in columns.split(", ")]
    quote = {"'": "\\'", "\\": "\\\\"}

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + "".join(quote.get(ch, ch) for ch in value) + "'"
        return str(value)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in typed)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in typed)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS rows({names})")


def event_type_rows(spark: SparkSession) -> DataFrame:
    return fixed_rows(
        spark,
        EVENT_TYPES,
        "event_type_id int, event_type_code string, event_type_category string,"
        " event_type_stage string, is_conversion_milestone boolean, product_area string",
    )


def plan_rows(spark: SparkSession) -> DataFrame:
    """The plans with their terms and the usual lead of an early withdrawal."""
    lead = {plan: usual for plan, _, usual, _ in EARLY_WITHDRAWAL_LEAD}
    return fixed_rows(
        spark,
        [(*plan, lead.get(plan[0])) for plan in PLANS],
        "plan_id int, product_id int, plan_name string, plan_category string,"
        " plan_weight decimal(5,2), interest_rate_min decimal(5,2),"
        " interest_rate_max decimal(5,2), tenure_days int, is_open_ended boolean,"
        " liquidity_type string, penalty_rate_pct decimal(5,2), risk_level string, lead_days int",
    )


def transaction_type_rows(spark: SparkSession) -> DataFrame:
    return fixed_rows(
        spark,
        TRANSACTION_TYPES,
        "transaction_type_id int, transaction_type_code string, transaction_category string,"
        " transaction_direction string",
    )
