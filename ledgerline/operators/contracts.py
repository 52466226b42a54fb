"""Loads under a contract: rows that break it are set aside with their reasons, the rest replace the table.

A row breaks its contract when a value does not fit the type of its column, when a mandatory column
or a part of the key is null, when a named condition holds, or when its key occurs again. Of the
rows of one key the largest by its other columns stays, a rule that any partitioning follows. Every
row read is found again, in the table or in the quarantine, with all its reasons; the load checks
this, and the allowed share of bad rows, before the table is touched.

Judging is one pass over the input. Equal rows are counted before rows of one key meet, and keys are
reduced by partial aggregation, so a key that holds a third of all rows takes no task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import quality
from ledgerline.schemas import fixed_rows
from ledgerline.session import scratch
from ledgerline.sources.readers import matched
from ledgerline.sources.sinks import overwrite

RAW, REASONS, COPIES = "_raw", "_reasons", "_copies"


@dataclass(frozen=True)
class Contract:
    """Columns (those not nullable are mandatory), a key, and conditions in SQL that make a row bad."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    bad: dict[str, str] = field(default_factory=dict)

    @property
    def mandatory(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable or f.name in self.key]


@dataclass(frozen=True)
class Loaded:
    table: DataFrame
    quarantine: DataFrame  # _raw as JSON, _reasons, _copies
    report: DataFrame


def judged(df: DataFrame, contract: Contract) -> DataFrame:
    """The columns of the contract, the reasons against each row, and bad rows as they came."""
    sources = matched(df, contract.schema)
    typed = {f.name: source.try_cast(f.dataType) for f, source in zip(contract.schema.fields, sources)}
    lost = [F.when(s.isNotNull() & v.isNull(), F.lit(f"cast_{c}")) for (c, v), s in zip(typed.items(), sources)]
    null = [F.when(s.isNull(), F.lit(f"null_{c}")) for c, s in zip(typed, sources) if c in contract.mandatory]
    raw = df.select(*[v.alias(c) for c, v in typed.items()], F.array_compact(F.array(*lost, *null)).alias(REASONS),
                    F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(RAW))
    named = [F.when(F.expr(condition), F.lit(name)) for name, condition in contract.bad.items()]
    if named:
        raw = raw.withColumn(REASONS, F.concat(REASONS, F.array_compact(F.array(*named))))
    return raw.withColumn(RAW, F.when(F.size(REASONS) > 0, F.col(RAW)))


def one_per_key(rows: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One row of each key, and the others as quarantined rows."""
    columns, others = rows.columns, [c for c in rows.columns if c not in key]
    row = F.struct(*others) if others else F.lit(0)
    counted = overwrite(rows.groupBy(*columns).agg(F.count("*").alias(COPIES)), scratch(rows.sparkSession, "rows-counted"))
    best = counted.groupBy(*key).agg(F.max(row).alias("_best"), F.sum(COPIES).alias("_n"))
    best = overwrite(best, scratch(rows.sparkSession, "rows-by-key"))
    kept = best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in columns])
    # Joined to stored keys, so that the adaptive join may split the rows of a hot one.
    again = counted.join(best.filter("_n > 1").drop("_n"), list(key))
    left = F.col(COPIES) - F.when(row.eqNullSafe(F.col("_best")), 1).otherwise(0)
    extra = again.select(
        F.to_json(F.struct(*columns)).alias(RAW), F.array(F.lit("duplicate_" + "_".join(key))).alias(REASONS), left.alias(COPIES)
    )
    return kept, extra.filter(F.col(COPIES) > 0)


def load(df: DataFrame, contract: Contract, target: str, quarantine: str, most_bad: float = 1.0) -> Loaded:
    """Replace the table at ``target``; raise, and leave it, when more than ``most_bad`` of the rows are bad."""
    spark = df.sparkSession
    every = overwrite(judged(df, contract), scratch(spark, "rows-judged"))
    good = every.filter(F.size(REASONS) == 0).drop(REASONS, RAW)
    bad = every.filter(F.size(REASONS) > 0).select(RAW, REASONS, F.lit(1).cast("bigint").alias(COPIES))
    if contract.key:
        good, extra = one_per_key(good, contract.key)
        bad = bad.unionByName(extra)
    # The quarantine is a record of this load alone, in a folder of its own.
    aside = overwrite(bad, quarantine)
    n, n_good = every.count(), good.count()
    n_bad = aside.agg(F.coalesce(F.sum(COPIES), F.lit(0))).first()[0]
    checks = [("rows_add_up", target, n, abs(n - n_good - n_bad)), ("share_of_bad_rows", target, n, n_bad if n_bad > most_bad * n else 0)]
    report = fixed_rows(spark, checks, "check_name string, table_name string, n_rows bigint, n_bad bigint")
    quality.enforce(report)
    return Loaded(overwrite(good, target), aside, report)


def reasons(quarantine: DataFrame) -> DataFrame:
    """Rows per reason; a row with several counts for each."""
    each = quarantine.select(F.explode(REASONS).alias("reason"), COPIES)
    return each.groupBy("reason").agg(F.sum(COPIES).alias("n_rows"))
