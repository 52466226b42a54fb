"""Writing tables and landing days. Every sink returns the frame read back from its files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.schemas import fixed_rows


def overwrite(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def append_by_day(df: DataFrame, day: Column, path: str, column: str = "load_date") -> DataFrame:
    """Add late rows to the folders of their days and leave what lies there."""
    dated = df.withColumn(column, day)
    dated.hint("rebalance", F.col(column)).write.mode("append").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(dated.schema).parquet(path)


def export_public(df: DataFrame, internal: Sequence[str], path: str) -> DataFrame:
    """Export all but the internal columns."""
    return overwrite(df.drop(*internal), path)


def land_by_day(df: DataFrame, day: Column, path: str, column: str = "load_date") -> DataFrame:
    """Write rows under ``<column>=<day>``; only the days present in ``df`` are replaced.

    The rows of a day meet in one partition, which the rebalance then cuts to file size if the
    day dwarfs the others; small days share a task.
    """
    dated = df.withColumn(column, day)
    (
        dated.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    return df.sparkSession.read.schema(dated.schema).parquet(path)


def publish(frames: dict[str, DataFrame], base_uri: str) -> dict[str, DataFrame]:
    """Write each table to ``<base_uri>/<table>``; the scheme of the URI picks the store."""
    return {name: overwrite(df, f"{base_uri.rstrip('/')}/{name}") for name, df in frames.items()}


def load_report(frames: dict[str, DataFrame], base_uri: str) -> DataFrame:
    """Load tables and report the rows of each, counted by the write itself."""
    spark = next(iter(frames.values())).sparkSession
    loaded = []
    for name, df in frames.items():
        seen = Observation(name)
        overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{base_uri}/{name}")
        loaded.append((name, seen.get["rows"]))
    return fixed_rows(spark, loaded, "table_name string, rows_loaded bigint")


def materialize_table(df: DataFrame, name: str, base_uri: str) -> DataFrame:
    """Silver layer: a stored table with its files in the shared folder."""
    df.write.mode("overwrite").option("path", f"{base_uri}/{name}").saveAsTable(name)
    return df.sparkSession.table(name)


def gold_view(df: DataFrame, name: str) -> DataFrame:
    """Gold layer: a view, recomputed when read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
