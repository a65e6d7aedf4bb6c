"""Registration of queries and typed access to the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govpub.functions.columns import MONEY, VOLUME

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The supplied Parquet tables, dates as dates and amounts as exact decimals."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new folder below the warehouse, which driver and executors share."""
        return f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/govpub-{name}-{uuid.uuid4().hex}"

    def lineitem(self) -> DataFrame:
        return self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
            F.to_date("l_shipdate").alias("l_shipdate"), volume("l_quantity").alias("l_quantity"),
            money("l_extendedprice").alias("l_extendedprice"), money("l_discount").alias("l_discount"),
            money("l_tax").alias("l_tax"))

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
            F.to_date("o_orderdate").alias("o_orderdate"), money("o_totalprice").alias("o_totalprice"))

    def nations(self) -> DataFrame:
        region = self.raw("region")
        nation = self.raw("nation")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            "n_nationkey", "n_name", "n_regionkey", "r_name")


def query(sql: str | None = None) -> Callable:
    """Register a query under its function name, with the SQL that has to give the same rows."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


def volume(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(VOLUME)


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def out_num(c: str | Column) -> Column:
    """Exact decimals leave a query as double, whole numbers as bigint, dates as text."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def out_int(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def out_text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def count() -> Column:
    return F.count(F.lit(1))
