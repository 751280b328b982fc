"""The catalogue: each query is registered under its key, with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import table


class Tables:
    """The tables of one folder as attributes; only those that are used are opened."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # reached only on first use: the opened table then is an attribute like any other
        opened = table(self.spark, self.folder, name)
        setattr(self, name, opened)
        return opened

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


Plan = Callable[[Tables], DataFrame]
QUERIES: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = plan
        if sql is not None:
            SQL[key] = sql
        return plan

    return register


def as_callable(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(Tables(spark, folder))
