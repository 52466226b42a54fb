"""Reading: the input tables, CSV reference tables, and frames shaped to a contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import INPUT


class Tables:
    """The input tables of one data folder, read lazily: ``tables.orders``, ``tables.events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in INPUT:
            reader = reader.schema(INPUT[name])
        return reader.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in INPUT:
            return self.read(name)
        raise AttributeError(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered CSV with a fixed schema; quoted fields may hold commas and doubled quotes."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def matched(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The column of ``df`` for each one of a contract, matching names without regard to case.

    Missing nullable columns become null; a missing mandatory column is an error.
    """
    have = {c.lower(): c for c in df.columns}
    columns = []
    for field in schema.fields:
        if field.name.lower() in have:
            columns.append(F.col(f"`{have[field.name.lower()]}`"))
        elif field.nullable:
            columns.append(F.lit(None))
        else:
            raise ValueError(f"mandatory column {field.name} is missing")
    return columns


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and reorder to a contract; a value that does not fit its type is an error."""
    return df.select([c.cast(f.dataType).alias(f.name) for c, f in zip(matched(df, schema), schema.fields)])


def append_by_name(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Append rows by column name; columns that ``extra`` lacks become null."""
    return base.unionByName(extra, allowMissingColumns=True)


def register(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def unregister(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


def stream_table(tables: Tables, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """An input table as a file stream; event times become zoned, as watermarks need."""
    spark = tables.spark
    path = tables.path(name)
    files = spark.read.schema(INPUT[name]).parquet(path).inputFiles()
    is_file = len(files) == 1 and files[0].endswith(f"/{name}.parquet")
    reader = spark.readStream.schema(INPUT[name])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not is_file:
        stream = reader.parquet(path)
    else:
        # A stream source must be a folder; pick the one file out of it.
        stream = reader.option("pathGlobFilter", f"{name}.parquet").parquet(tables.folder)
    return zoned(stream)


def zoned(df: DataFrame) -> DataFrame:
    """Naive timestamps read as UTC instants."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    )
