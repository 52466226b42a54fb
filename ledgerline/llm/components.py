"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest of its neighbourhood."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node sends itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    sent = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return sent.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(u, root) for every node of ``links`` (u, v) that is not its own root; root is the smallest.

    Every round is stored in the shared folder, so a lost executor costs one round. The rounds
    needed grow with the logarithm of the longest chain; nodes with many links are aggregated
    before they are joined, and split by the adaptive join.
    """
    now = stored(links.select("u", "v").filter("u <> v").distinct(), name)
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = stored(_small_star(_large_star(now)), name)
    return now.select("u", F.col("v").alias("root"))
