"""The catalog of queries: name -> (Spark build function, SQL oracle or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import prepare
from ledgerline.sources.readers import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(prepare(spark), folder))


CATALOG: dict[str, Query] = {}


def query(oracle: str | None = None):
    """Register a build function under its own name; ``oracle`` is the same question in SQL."""

    def wrap(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, build, oracle)
        return build

    return wrap


def load_all() -> dict[str, Query]:
    from ledgerline.plans import (  # noqa: F401
        assignment,
        finance,
        growth,
        layers,
        lifecycle,
        quality,
        relational,
        scalars,
        state,
        streams,
    )

    return CATALOG
