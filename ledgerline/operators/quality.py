"""Data-quality checks: each yields (check_name, table_name, n_rows, n_bad)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _named(df: DataFrame, check: str, table: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.coalesce(F.col("n_bad"), F.lit(0)).cast("bigint").alias("n_bad"),
    )


def row_checks(df: DataFrame, table: str, bad: dict[str, Column | tuple[Column, Column]]) -> DataFrame:
    """Any number of row conditions over one table in one scan; null conditions are not bad.

    A check given as (scope, condition) looks only at the rows in its scope.
    """
    counts, rows = [], []
    for i, (name, check) in enumerate(bad.items()):
        scope, condition = check if isinstance(check, tuple) else (F.lit(True), check)
        counts += [F.count_if(scope).alias(f"_n{i}"), F.count_if(scope & condition).alias(f"_b{i}")]
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(table).alias("table_name"),
                F.col(f"_n{i}").alias("n_rows"),
                F.col(f"_b{i}").alias("n_bad"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def unique(df: DataFrame, keys: Sequence[str], check: str, table: str) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return _named(per_key.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_bad")), check, table)


def at_most_once(df: DataFrame, keys: Sequence[str], check: str, table: str) -> DataFrame:
    """Keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return _named(
        per_key.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_bad")), check, table
    )


def required(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    return row_checks(df, table, {f"not_null_{c}": F.col(c).isNull() for c in columns})


def max_length(df: DataFrame, limits: dict[str, int], table: str) -> DataFrame:
    return row_checks(df, table, {f"length_{c}": F.length(c) > n for c, n in limits.items()})


def fits_decimal(column: str, precision: int, scale: int) -> Column:
    """Bad when the value does not fit DECIMAL(precision, scale)."""
    return F.col(column).isNotNull() & F.col(column).try_cast(f"decimal({precision},{scale})").isNull()


def foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str, check: str, table: str) -> DataFrame:
    """Child rows without a parent. Children are counted per key first, so a hot key is one row."""
    per_key = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(key).alias(column)).distinct().withColumn("_known", F.lit(True))
    missing = F.when(F.col("_known").isNull(), F.col("n"))
    return _named(
        per_key.join(known, column, "left").agg(F.sum("n").alias("n_rows"), F.sum(missing).alias("n_bad")),
        check,
        table,
    )


def missing_codes(expected: DataFrame, found: DataFrame, code: str, check: str, table: str) -> DataFrame:
    """Expected lookup codes that the table lacks."""
    have = found.select(code).distinct().withColumn("_have", F.lit(True))
    counted = expected.join(have, code, "left").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("_have").isNull()).alias("n_bad")
    )
    return _named(counted, check, table)


def enforce(found: DataFrame) -> DataFrame:
    """Stop a load: raise when a check of the report has bad rows, naming each; else pass it on."""
    bad = found.filter("n_bad > 0").orderBy("table_name", "check_name").collect()  # one row per check
    if bad:
        raise ValueError("; ".join(f"{r.check_name} on {r.table_name}: {r.n_bad} of {r.n_rows} rows" for r in bad))
    return found


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
