"""Queries over the test tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sumstone.sources.schemas import TABLES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def register(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under ``name``; ``covers`` lists the operator ids it exercises."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
