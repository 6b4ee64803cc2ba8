"""The extract chain and small relational helpers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def extract(
    spark: SparkSession,
    table: str | DataFrame,
    select: Sequence[str] | None = None,
    where: str | None = None,
    drop: Sequence[str] | None = None,
    limit: int | None = None,
    aux: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """aux, select, where, drop, limit, applied in this order.

    ``where`` comes after ``select`` but may still name columns that ``select`` left out, and ``drop``
    hides columns that were only needed to filter on.
    """
    df = spark.table(table) if isinstance(table, str) else table
    if aux is not None:
        df = df.transform(aux)
    if select:
        df = df.selectExpr(*select)
    if where:
        df = df.where(where)
    if drop:
        df = df.drop(*drop)
    return df if limit is None else df.limit(limit)


def result_columns(spark: SparkSession, query: str) -> list[str]:
    """Column names of a query, from analysis alone: no job runs."""
    return spark.sql(query).columns
