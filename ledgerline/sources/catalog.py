"""The bronze catalog: input tables registered as views with a description each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import STAR
from ledgerline.sources.readers import Tables, conform, read_csv, register

BRONZE = {
    "region": "regions of the world",
    "nation": "countries and their region",
    "customer": "registered users, one wallet each",
    "supplier": "partners",
    "part": "things invested in; the type stands for the plan",
    "orders": "cash movements",
    "lineitem": "investment positions",
    "events": "user events",
}


# The star schema, for folders that hold its own tables.
STAR_NOTES = {
    "dim_date": "calendar days",
    "dim_event_type": "kinds of events, with category, stage and milestone flag",
    "dim_product": "savings and investment products",
    "dim_plan": "plans of the products, with rates, tenure and penalty",
    "dim_transaction_type": "kinds of money movements and their direction",
    "dim_user": "registered users",
    "dim_wallet": "wallets, one per user",
    "fact_user_event": "events of users",
    "fact_transaction": "money movements",
    "fact_investment_position": "savings and investment positions",
    "fact_wallet_balance": "current balance per wallet",
}


def register_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Read the eleven star tables from ``<folder>/<table>``, shape them and register views."""
    base = folder.rstrip("/")
    frames = {name: conform(spark.read.parquet(f"{base}/{name}"), STAR[name]) for name in STAR_NOTES}
    register(spark, frames)
    return frames


def load_static(spark: SparkSession, files: dict[str, str], contracts: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Static dimensions from headered CSV files, each shaped to its contract."""
    return {name: conform(read_csv(spark, path, contracts[name]), contracts[name]) for name, path in files.items()}


def register_bronze(tables: Tables) -> dict[str, DataFrame]:
    frames = {name: tables.read(name) for name in BRONZE}
    register(tables.spark, frames)
    return frames


def bronze_counts(tables: Tables) -> DataFrame:
    """Register the catalog and count the rows behind each name."""
    register_bronze(tables)
    counted = [
        tables.spark.table(name).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(text).alias("description"), "row_count"
        )
        for name, text in BRONZE.items()
    ]
    return reduce(DataFrame.unionByName, counted)
