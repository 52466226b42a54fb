"""The star tables themselves as the source of operators and metrics.

``Star`` gives the same frames as ``standin`` makes of the input tables, so whatever runs on one
runs on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.lifecycle import milestones
from ledgerline.sources.catalog import register_star

MILESTONES = {"signup_completed": "signup_at", "kyc_completed": "kyc_at", "wallet_funded": "funded_at"}
TERMS = (
    "plan_name", "plan_category", "product_id", "tenure_days", "is_open_ended", "interest_rate_min", "interest_rate_max", "penalty_rate_pct",
)


class Star:
    """The eleven star tables by name."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Star:
        return cls(register_star(spark, folder))

    def event_fact(self) -> DataFrame:
        """Events with their code; an unknown type keeps its row without a code."""
        codes = self.frames["dim_event_type"].select("event_type_id", "event_type_code")
        amounts = self.frames["fact_transaction"].select("transaction_id", F.col("transaction_amount").alias("amount"))
        events = self.frames["fact_user_event"].join(codes, "event_type_id", "left").join(amounts, "transaction_id", "left")
        return events.select(
            "event_id", "user_id", "wallet_id", "event_type_code", "event_time", "event_date_id", "amount", "is_money_movement_activity"
        )

    def _transactions(self) -> DataFrame:
        kinds = self.frames["dim_transaction_type"].select(
            "transaction_type_id", "transaction_type_code", F.lower("transaction_direction").alias("direction")
        )
        return self.frames["fact_transaction"].join(kinds, "transaction_type_id", "left").select(
            "transaction_id",
            "wallet_id",
            F.col("transaction_timestamp").alias("event_time"),
            F.col("transaction_amount").alias("amount"),
            F.col("transaction_status").alias("status"),
            "direction",
            "transaction_type_code",
        )

    def cash_flow(self) -> DataFrame:
        """Transactions with their direction."""
        return self._transactions().drop("transaction_type_code")

    def wallet_transactions(self) -> DataFrame:
        """Fundings of wallets, named like events."""
        fundings = self._transactions().filter("transaction_type_code = 'wallet_funding'")
        return fundings.drop("transaction_type_code").withColumnRenamed("transaction_id", "event_id")

    def user_milestones(self, *, kyc: bool = True) -> DataFrame:
        """First signup, and first KYC and funding at or after it, per user."""
        kinds = {code: name for code, name in MILESTONES.items() if kyc or name != "kyc_at"}
        return milestones(self.event_fact(), "user_id", "event_time", "event_type_code", kinds)

    def wallets(self) -> DataFrame:
        return self.frames["dim_wallet"].select("wallet_id", "user_id", "wallet_created_at", "wallet_activated_at")

    def positions(self) -> DataFrame:
        """Positions with the terms of their plan; one of no known plan stays without."""
        terms = self.frames["dim_plan"].select("plan_id", *TERMS)
        return self.frames["fact_investment_position"].join(terms, "plan_id", "left").select(
            "user_id",
            F.col("investment_id").cast("string").alias("position_key"),
            "plan_id",
            "amount_invested",
            F.to_date("investment_start_date").alias("start_date"),
            F.to_date("investment_maturity_date").alias("maturity_date"),
            F.to_date("early_withdrawal_date").alias("early_withdrawal_date"),
            "is_withdrawn_early",
            (F.col("investment_status") == "Redeemed").alias("is_redeemed"),
            *TERMS,
        )

    def users(self, *columns: str) -> DataFrame:
        return self.frames["dim_user"].select("user_id", *columns)
