"""Running aggregates per key over a table laid out once in key and time order.

Rows are range-partitioned by key, order and tiebreak, sorted, and stored with their partition and
place. A key lies in as many partitions as its rows need, whatever share of the table it has, and
rows of one time, or of none, are told apart by the tiebreak, so they are spread too. A scan then
runs inside each partition, and what a key had in earlier partitions is carried over: of each
partition only the first key can have begun before, so there is at most one carry per partition.

Any number of scans reads one layout, also scans of what earlier scans found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import _ROW_BITS, _once
from ledgerline.session import scratch

_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
PART, PLACE = "_part", "_place"


def _merge(kind: str, carry: Column, local: Column) -> Column:
    if kind == "min":
        return F.least(carry, local)
    if kind == "max":
        return F.greatest(carry, local)
    return F.coalesce(carry + local, carry, local)


def laid_out(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, bare: bool = True, partitions: int | None = None
) -> DataFrame:
    """The rows stored in the order of keys and ``order``, nulls first, with partition and place.

    ``order`` ends in a tiebreak, which takes part in the ranges. Choosing them reads ``df`` once
    more; ``bare`` says that it only reads and filters files, otherwise it is stored before.
    """
    columns = [*keys, *order]
    df = df if bare else _once(df, "scan-rows")
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *columns).sortWithinPartitions(*columns)
    placed = ranged.withColumn(PART, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    path = scratch(df.sparkSession, "scan")
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def scan(
    rows: DataFrame, keys: Sequence[str], scans: dict[str, tuple[str, Column, bool]], *, reverse: bool = False
) -> DataFrame:
    """Running aggregates per key over rows that ``laid_out`` has stored.

    ``scans`` maps an output column to (sum | min | max | count, value, include current row). With
    ``reverse`` the rows are read from the last to the first. The result is laid out as the rows
    are: another scan may read its columns, and costs no further exchange of rows.
    """
    key = F.struct(*keys)  # never null, so that null keys compare like others
    names = {out: f"_in_{out}" for out in scans}
    rows = rows.withColumns({names[out]: value for out, (_, value, _) in scans.items()})

    def along(column: str) -> Column:
        return F.desc(column) if reverse else F.asc(column)

    def summed(kind: str) -> str:
        return "sum" if kind == "count" else kind  # counts of parts are added up

    # What each partition has of a key, and of those that began in an earlier one, what came before.
    parts = rows.groupBy(PART, key.alias("_key")).agg(*[_AGG[kind](names[out]).alias(out) for out, (kind, _, _) in scans.items()])
    by_part = Window.partitionBy("_key").orderBy(along(PART))
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carries = parts.select(
        F.col(PART).alias("_of"), F.col("_key").alias("_carried"), F.row_number().over(by_part).alias("_turn"),
        *[_AGG[summed(kind)](out).over(before).alias(f"_carry_{out}") for out, (kind, _, _) in scans.items()],
    )
    carries = carries.filter("_turn > 1").drop("_turn")

    own = Window.partitionBy(PART, *keys).orderBy(along(PLACE))
    local = rows.withColumns(
        {
            out: _AGG[kind](names[out]).over(own.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
            for out, (kind, _, inclusive) in scans.items()
        }
    )
    # At most one row per partition: the one key that goes on from the partition before.
    joined = local.join(F.broadcast(carries), F.col(PART) == F.col("_of"), "left")
    goes_on = key.eqNullSafe(F.col("_carried"))
    merged = {}
    for out, (kind, _, _) in scans.items():
        found = F.when(goes_on, _merge(kind, F.col(f"_carry_{out}"), F.col(out))).otherwise(F.col(out))
        merged[out] = found if kind == "count" else found.cast(rows.schema[names[out]].dataType)
    kept = [c for c in rows.columns if c not in names.values() and c not in scans]
    return joined.withColumns(merged).select(*kept, *scans)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scans: dict[str, tuple[str, Column, bool]],
    *,
    reverse: bool = False,
    bare: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Running aggregates per key along ``order``, for one scan of a table: see ``laid_out`` and ``scan``."""
    names = {out: f"_value_{out}" for out in scans}
    valued = df.withColumns({names[out]: value for out, (_, value, _) in scans.items()})
    rows = laid_out(valued, list(keys), list(order), bare=bare, partitions=partitions)
    found = scan(rows, list(keys), {out: (kind, F.col(names[out]), inclusive) for out, (kind, _, inclusive) in scans.items()}, reverse=reverse)
    return found.select(*df.columns, *scans)
