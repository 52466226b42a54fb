"""Repeatable sampling and assignment: the same rows on any cluster, in any order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.draws import uniform
from ledgerline.schemas import fixed_rows


def sample_fraction(df: DataFrame, key: Sequence[str], fraction: float, seed: int) -> DataFrame:
    return df.filter(uniform(seed, *[F.col(k) for k in key]) < fraction)


def sample_stratified(
    df: DataFrame, key: Sequence[str], stratum: Column, fractions: dict[str, float], seed: int
) -> DataFrame:
    """Keep its own share of each stratum; strata without a share are dropped."""
    share = reduce(
        lambda out, item: out.when(stratum == item[0], F.lit(item[1])), fractions.items(), F
    )
    return df.filter(uniform(seed, *[F.col(k) for k in key]) < share)


def cumulative(weights: Sequence[tuple]) -> list[tuple]:
    """(..., name, weight) rows -> (..., name, lo, hi) intervals per leading columns.

    The borders are rounded to 6 digits. The last interval of weight ends at 1 whatever the
    rounding, so that every draw falls into one.
    """
    out, totals, last = [], {}, {}
    for *parent, name, weight in weights:
        totals[tuple(parent)] = totals.get(tuple(parent), 0.0) + weight
    reached: dict[tuple, float] = {}
    for *parent, name, weight in weights:
        lo = reached.get(tuple(parent), 0.0)
        hi = round(lo + weight / totals[tuple(parent)], 6)
        reached[tuple(parent)] = hi
        if weight > 0:
            last[tuple(parent)] = len(out)
        out.append((*parent, name, lo, hi))
    for at in last.values():
        out[at] = (*out[at][:-1], 1.0)
    return out


_CELLS = 64


def range_bucket(
    df: DataFrame, draw: Column, weights: Sequence[tuple], name: str, parent: str | None = None
) -> DataFrame:
    """Range join of each draw to the interval that holds it.

    The unit interval is cut into cells; each interval is listed once per cell it touches. So the
    join is an equality on the cell (and on ``parent``, where the intervals depend on it) with
    the borders as a filter, not a comparison with every interval. The list is fixed and small,
    hence the broadcast.
    """
    listed = [
        (*(parents if parent else ()), cell, label, lo, hi)
        for *parents, label, lo, hi in cumulative(weights)
        for cell in range(int(lo * _CELLS), min(int(hi * _CELLS), _CELLS - 1) + 1)
    ]
    columns = f"_cell int, {name} string, _lo double, _hi double"
    keys = ["_cell"]
    if parent:
        columns, keys = f"{parent} string, {columns}", [parent, "_cell"]
    table = fixed_rows(df.sparkSession, listed, columns)
    placed = df.withColumn("_draw", draw).withColumn("_cell", F.floor(F.col("_draw") * _CELLS).cast("int"))
    joined = placed.join(F.broadcast(table), keys)
    inside = (F.col("_draw") >= F.col("_lo")) & (F.col("_draw") < F.col("_hi"))
    return joined.filter(inside).select(*df.columns, name)


def first_k(df: DataFrame, group: Sequence[str], key: str, k: int, seed: int) -> DataFrame:
    """k rows of each group by the order of a hash: a choice without replacement.

    The rank filter is applied before the shuffle too, so each task sends at most k per group.
    """
    dice = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    order = Window.partitionBy(*group).orderBy("_dice", key)
    return (
        df.withColumn("_dice", dice)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= k)
        .drop("_dice", "_rank")
    )


def top_k_random(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k random rows overall: each task keeps its own k."""
    dice = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(dice, key).limit(k)
