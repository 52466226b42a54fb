"""Dense surrogate keys 1..n in a total order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row of its partition here


def _once(df: DataFrame, name: str) -> DataFrame:
    """The frame stored in the scratch folder, so that further passes read files."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_key(df: DataFrame, order: Sequence[str], name: str, *, after: int = 0, bare: bool = False) -> DataFrame:
    """Number the rows after+1, after+2, ... along ``order`` (ascending, nulls first).

    Rows are range-partitioned and sorted inside their partition, then written to the scratch
    folder with their partition and place. The key is the place plus the rows of all partitions
    before. The written table fixes which row lies where: no retry or lost executor can move
    one afterwards, and ``df`` is not computed again for the counts.

    Choosing the ranges takes a pass of its own. ``df`` is stored before it, so that joins in it
    run once; ``bare`` says that ``df`` only reads and filters files, which is as cheap.

    ``order`` must end in a tiebreak. As it takes part in the ranges, a value that a third of
    the rows share is spread over several partitions.
    """
    spark, order = df.sparkSession, list(order)
    df = df if bare else _once(df, f"rows-{name}")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    path = scratch(spark, f"keys-{name}")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_place") + (after + 1)
    return (
        stored.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, number.cast("long"))
        .drop("_part", "_place", "_offset")
    )


def conditional_key(
    df: DataFrame, condition: Column, order: Sequence[str], name: str, *, after: int = 0
) -> DataFrame:
    """Dense keys for the rows that meet ``condition``; the others get null."""
    once = _once(df.withColumn("_keyed", F.coalesce(condition, F.lit(False))), f"rows-{name}")
    keyed = dense_key(once.filter("_keyed"), order, name, after=after, bare=True)
    rest = once.filter("NOT _keyed").withColumn(name, F.lit(None).cast("long"))
    return keyed.unionByName(rest).drop("_keyed")


def high_water_mark(df: DataFrame, key: str) -> DataFrame:
    """The largest key so far, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias(f"max_{key}"))


def continue_keys(
    stored: DataFrame, arrivals: DataFrame, order: Sequence[str], key: str, *, bare: bool = False
) -> DataFrame:
    """Number ``arrivals`` on from the largest stored key."""
    mark = high_water_mark(stored, key).first()[0]
    return dense_key(arrivals, order, key, after=mark, bare=bare)


def ntile(df: DataFrame, order: Sequence[str], tiles: int, name: str, *, bare: bool = False) -> DataFrame:
    """Global ntile through dense ranks, so that no task sorts the whole table."""
    return _tiled(dense_key(df, order, "_rank", bare=bare), tiles, name)


def ntiles(df: DataFrame, key: str, columns: dict[str, str], tiles: int) -> DataFrame:
    """A global ntile per column, ties by the key, which is unique: {column: name of its tile}.

    The frame is stored and counted once; only key and column are sorted for each tile.
    """
    once = _once(df, f"rows-{key}")
    n, out = once.count(), once
    for column, name in columns.items():
        ranked = dense_key(once.select(column, key), [column, key], "_rank", bare=True)
        out = out.join(_tiled(ranked, tiles, name, n).select(key, name), key)
    return out


def _tiled(ranked: DataFrame, tiles: int, name: str, n: int | None = None) -> DataFrame:
    small, large = divmod(ranked.count() if n is None else n, tiles)
    border = large * (small + 1)
    rank = F.col("_rank") - 1
    tile = F.when(rank < border, F.floor(rank / (small + 1))).otherwise(
        large + F.floor((rank - border) / max(small, 1))
    )
    return ranked.withColumn(name, (tile + 1).cast("int")).drop("_rank")
