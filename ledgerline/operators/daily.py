"""The daily load: all tables of a day are published together, or none is.

A load reads its own day's events and positions and the tables of the day before, writes new
folders under ``<root>/data``, checks them, and then appends one file of rows to
``<root>/commits``: the manifest. It names the folders of the load, the load it rests on, and the
highest keys. Readers go from a load to the one it rests on and see exactly the folders on that way.
A load that dies, or is repeated, leaves folders that no manifest names, or a later version of its day.

Tables that grow (``facts``, ``transactions``, ``redemptions``) add a folder per load, tables of state
(``users``, ``wallets``) write one row per key anew. Event and transaction keys go on from the highest
keys of the load before, in the order of time, source and source key.

Events without a time belong to the first load that sees them: a later load takes those that no
earlier one has. Users and wallets without a key are one user and one wallet.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.calendar import ntz, within_day
from ledgerline.functions.money import money, signed
from ledgerline.operators import quality
from ledgerline.operators.keys import dense_key
from ledgerline.sources.sinks import overwrite

GROWING = ("facts", "transactions", "redemptions")
STATE = {
    "users": {"signup_at": "min", "kyc_at": "min", "last_login_at": "max", "last_event_key": "max", "events": "sum"},
    "wallets": {"balance": "sum", "funded_at": "min", "last_updated_at": "max", "last_transaction_key": "max"},
}
KEYS = {"users": "user_id", "wallets": "wallet_id"}
MANIFEST = "version long, day date, base long, table_name string, folder string, event_key long, transaction_key long"
PROCEEDS_AFTER_HOURS = 3


def event_movements(events: DataFrame) -> DataFrame:
    """The event log as movements: what happened, when, to whom, and the money that it moved."""
    kind = F.col("event_type")
    return events.select(
        F.lit("event").alias("source"), F.col("event_id").cast("string").alias("source_id"), "user_id", kind.alias("kind"), "ts",
        F.when(kind.isin("purchase", "error"), money(F.col("value"))).alias("amount"),
        F.when(kind == "purchase", "success").when(kind == "error", "failure").alias("status"),
    )


def vesting_movements(matured: DataFrame) -> DataFrame:
    """A matured position vests at midnight, and its proceeds reach the wallet some hours later."""
    at = F.col("maturity_date").cast("timestamp_ntz")
    paid_at = at + F.make_dt_interval(hours=F.lit(PROCEEDS_AFTER_HOURS))
    steps = F.array(
        F.struct(F.lit("vest").alias("source"), F.lit("investment_vests").alias("kind"), at.alias("ts"),
                 F.lit(None).cast("decimal(18,2)").alias("amount"), F.lit(None).cast("string").alias("status")),
        F.struct(F.lit("proceeds").alias("source"), F.lit("investment_proceeds_wallet_transfer").alias("kind"), paid_at.alias("ts"),
                 money(F.col("amount_invested")).alias("amount"), F.lit("success").alias("status")),
    )
    return matured.select(F.col("position_key").alias("source_id"), "user_id", F.inline(steps)).select(
        "source", "source_id", "user_id", "kind", "ts", "amount", "status"
    )


def changes(facts: DataFrame, transactions: DataFrame) -> dict[str, DataFrame]:
    """What a load does to each user and wallet, one row per key."""
    kind, ts = F.col("kind"), F.col("ts")
    users = facts.groupBy("user_id").agg(
        F.min(F.when(kind == "signup", ts)).alias("signup_at"),
        F.min(F.when(kind == "click", ts)).alias("kyc_at"),
        F.max(F.when(kind == "view", ts)).alias("last_login_at"),
        F.max("event_key").alias("last_event_key"),
        F.count("*").alias("events"),
    )
    moved = signed(F.col("amount"), F.lit("credit"), F.col("status"))
    paid = F.col("status") == "success"
    wallets = transactions.groupBy("wallet_id").agg(
        money(F.sum(moved)).alias("balance"),
        F.min(F.when(paid, ts)).alias("funded_at"),
        F.max(F.when(paid, ts)).alias("last_updated_at"),
        F.max("transaction_key").alias("last_transaction_key"),
    )
    return {"users": users, "wallets": wallets}


def combine(old: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """Add the changes of a load to a table of state; both hold one row per key, null included."""
    key, kinds = KEYS[table], STATE[table]
    fresh = new.select(F.col(key).alias("_key"), F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in kinds])
    merged = {}
    for column, kind in kinds.items():
        before, after = F.col(column), F.col(f"_{column}")
        if kind == "sum":
            merged[column] = F.coalesce(before + after, before, after).cast(old.schema[column].dataType)
        else:
            merged[column] = (F.greatest if kind == "max" else F.least)(before, after)
    both = old.withColumn("_old", F.lit(True)).join(fresh, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    name = F.when(F.col("_old"), F.col(key)).otherwise(F.col("_key"))
    return both.withColumns({key: name, **merged}).select(key, *kinds)


# --- manifest ---------------------------------------------------------------------------------


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: a row per load and table."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/commits")


def _newest(spark: SparkSession, root: str, day: dt.date | None) -> tuple[int, int, int]:
    """Version and highest keys of the last load of ``day``, or of the last day there is."""
    rows = commits(spark, root)
    rows = rows if day is None else rows.filter(F.col("day") == F.lit(day))
    found = rows.orderBy(F.desc("day"), F.desc("version")).limit(1).collect()
    if not found:
        raise ValueError(f"no load of {day or 'any day'} is committed under {root}")
    return found[0].version, found[0].event_key, found[0].transaction_key


def _folders(spark: SparkSession, root: str, version: int) -> dict[str, list[str]]:
    """The folders that a load sees, per table. Loads, not rows, are collected."""
    by_version: dict[int, list] = {}
    for row in commits(spark, root).filter(F.col("version") <= version).collect():
        by_version.setdefault(row.version, []).append(row)
    seen: dict[str, list[str]] = {}
    while version in by_version:
        for row in by_version[version]:
            if row.table_name in GROWING or row.table_name not in seen:
                seen.setdefault(row.table_name, []).append(f"{root}/{row.folder}")
        version = by_version[version][0].base
    return seen


def as_of(spark: SparkSession, root: str, table: str, day: dt.date | None = None) -> DataFrame:
    """A table as the last committed load of a day left it (by default, of the last day)."""
    version, _, _ = _newest(spark, root, day)
    return spark.read.parquet(*_folders(spark, root, version)[table])


def _publish(
    spark: SparkSession, root: str, day: dt.date, base: tuple[int, int, int], tables: dict[str, DataFrame], folders: dict[str, str],
    checks: Callable[[dict[str, DataFrame]], DataFrame],
) -> dict[str, DataFrame]:
    """Check the written tables and name them in the manifest, in one file."""
    quality.enforce(checks(tables))
    version = base[0] + 1
    if base[0]:
        version = commits(spark, root).agg(F.max("version")).first()[0] + 1
    high = tables["facts"].agg(F.max("event_key")).first()[0] or base[1], tables["transactions"].agg(F.max("transaction_key")).first()[0] or base[2]
    rows = [(version, day, base[0], name, folder, *high) for name, folder in folders.items()]
    # A file shows under its name only when its job is committed, so all rows show at once.
    spark.createDataFrame(rows, T.StructType.fromDDL(MANIFEST)).coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return tables


def load_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """What every load must meet before it is published."""
    facts, transactions = tables["facts"], tables["transactions"]
    return quality.report([
        quality.row_checks(facts, "facts", {"event_key_set": F.col("event_key").isNull(), "amount_not_negative": F.col("amount") < 0}),
        quality.row_checks(transactions, "transactions", {
            "known_status": ~F.coalesce(F.col("status").isin("success", "failure"), F.lit(False)), "amount_set": F.col("amount").isNull(),
        }),
        quality.unique(facts, ["source", "source_id"], "loaded_once", "facts"),
    ])


# --- loads ------------------------------------------------------------------------------------


def _load(
    events: DataFrame, matured: DataFrame | None, day: dt.date, root: str, base: tuple[int, int, int],
    state: Callable[[str, DataFrame], DataFrame], checks: Callable[[dict[str, DataFrame]], DataFrame],
) -> dict[str, DataFrame]:
    mark = f"{day}-{uuid.uuid4().hex[:12]}"
    folders = {name: f"data/{name}/{mark}" for name in (*GROWING, *STATE)}

    def write(name: str, df: DataFrame) -> DataFrame:
        return overwrite(df, f"{root}/{folders[name]}")

    moves = event_movements(events)
    if matured is not None:
        moves = moves.unionByName(vesting_movements(matured))
    facts = write("facts", dense_key(moves, ["ts", "source", "source_id"], "event_key", after=base[1], bare=True))
    paid = facts.filter("amount IS NOT NULL").select("event_key", F.col("user_id").alias("wallet_id"), "source", "source_id", "ts", "amount", "status")
    tables = {"facts": facts, "transactions": write("transactions", dense_key(paid, ["event_key"], "transaction_key", after=base[2], bare=True))}
    closed = facts.filter("source = 'vest'").select(F.col("source_id").alias("position_key"), F.to_date("ts").alias("redeemed_on"))
    tables["redemptions"] = write("redemptions", closed)
    for name, delta in changes(facts, tables["transactions"]).items():
        tables[name] = write(name, state(name, delta))
    return _publish(events.sparkSession, root, day, base, tables, folders, checks)


def backfill(
    events: DataFrame, before: dt.date, root: str, positions: DataFrame | None = None,
    checks: Callable[[dict[str, DataFrame]], DataFrame] = load_checks,
) -> dict[str, DataFrame]:
    """First load: everything before a day, and events without a time."""
    later = F.coalesce(F.col("ts") >= ntz(before), F.lit(False))
    matured = None if positions is None else positions.filter(_vests() & (F.col("maturity_date") < F.lit(before)))
    return _load(events.filter(~later), matured, before - dt.timedelta(days=1), root, (0, 0, 0), lambda _, delta: delta, checks)


def run_day(
    events: DataFrame, day: dt.date, root: str, positions: DataFrame | None = None,
    checks: Callable[[dict[str, DataFrame]], DataFrame] = load_checks,
) -> dict[str, DataFrame]:
    """Load one day on top of the last load of the day before."""
    spark, yesterday = events.sparkSession, day - dt.timedelta(days=1)
    base = _newest(spark, root, yesterday)
    before = {name: spark.read.parquet(*folders) for name, folders in _folders(spark, root, base[0]).items()}
    known = before["facts"].filter("ts IS NULL AND source = 'event'").select(F.col("source_id").alias("_known"))
    undated = events.filter("ts IS NULL")
    undated = undated.join(known, undated["event_id"].cast("string") == known["_known"], "left_anti")
    todays = events.filter(within_day(F.col("ts"), day)).unionByName(undated)
    matured = None if positions is None else positions.filter(_vests() & (F.col("maturity_date") == F.lit(day)))
    return _load(todays, matured, day, root, base, lambda name, delta: combine(before[name], delta, name), checks)


def _vests() -> Column:
    return ~F.coalesce(F.col("is_withdrawn_early"), F.lit(False))


def rerun_from(
    events: DataFrame, day: dt.date, last: dt.date, root: str, positions: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Load a corrected day again, and all later days, whose states rest on it.

    Readers see the old days until the last day is committed again.
    """
    tables: dict[str, DataFrame] = {}
    while day <= last:
        tables = run_day(events, day, root, positions)
        day += dt.timedelta(days=1)
    return tables
