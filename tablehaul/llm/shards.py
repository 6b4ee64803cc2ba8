"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled by a seeded hash (md5) and ranked within their source; rank over size of the source is a row's fraction.
In the order of fractions all sources run through the whole table evenly, so cutting that order into equal parts gives
every shard the mixture, each source to within a row or two, and row counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.llm.frames import free_prefix

#: Rows ranked together in a task; more rows make more parts.
PART_ROWS = 8192
#: The order of a source's rows; times the number of parts it fits a bigint.
HASH_BITS = 40


def _hash(docs: DataFrame, seed: int) -> Column:
    """``HASH_BITS`` bits of a hash of the whole row, so that rows that share a doc_id, or have none, are spread too."""
    texts = [F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")) for f in docs.schema if not _unhashed(f.dataType)]
    digits = HASH_BITS // 4
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)), 1, digits), 16, 10).cast("bigint")


def _unhashed(kind: T.DataType) -> bool:
    return isinstance(kind, (T.MapType, T.VariantType, T.ArrayType, T.StructType))


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 0, part_rows: int = PART_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, source) with ``shard`` and ``slot``, gapless from 0 in each shard.

    Ranks are not made in one window for each source: a source is cut by hash into parts of about ``part_rows`` rows,
    counted, and ranked part by part; the same is done for the order of fractions. So neither a hot source nor the whole
    table meets in a task. The hash is of all plain columns, so many rows with one doc_id or with none are spread as well; only
    rows that are equal in all of them stay together, and they are interchangeable. A null source is a source of its own.
    With fewer rows than shards some shards stay empty; an empty table has no rows. Columns named ``shard`` or ``slot`` are
    replaced, others may have any name.
    """
    docs = docs.drop("shard", "slot")
    n = docs.count()
    parts = max(1, -(-n // part_rows))
    p = free_prefix(docs)
    key = F.col(f"{p}hash")
    stratum = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = docs.withColumn(f"{p}hash", _hash(docs, seed)).withColumn(f"{p}stratum", stratum)
    rows = rows.withColumn(f"{p}part", F.shiftright(key * parts, HASH_BITS))
    # A small table of counts: sources x parts, at most a row for each document.
    sizes = rows.groupBy(f"{p}stratum", f"{p}part").agg(F.count("*").alias(f"{p}size"))
    in_source = Window.partitionBy(f"{p}stratum").orderBy(f"{p}part")
    starts = sizes.select(
        F.col(f"{p}stratum").alias(f"{p}source"), F.col(f"{p}part").alias(f"{p}at"),
        (F.sum(f"{p}size").over(in_source) - F.col(f"{p}size")).alias(f"{p}start"),
        F.sum(f"{p}size").over(Window.partitionBy(f"{p}stratum")).alias(f"{p}of"),
    )
    ties = [f"{p}hash", "doc_id"]

    def ranked(frame: DataFrame) -> DataFrame:
        joined = frame.join(starts, (F.col(f"{p}stratum") == F.col(f"{p}source")) & (F.col(f"{p}part") == F.col(f"{p}at")))
        rank = F.col(f"{p}start") + F.row_number().over(Window.partitionBy(f"{p}stratum", f"{p}part").orderBy(*ties)) - 1
        fraction = (rank + 0.5) / F.col(f"{p}of")
        placed = joined.withColumn(f"{p}fraction", fraction).drop(*[p + c for c in ("source", "at", "start", "of", "part")])
        return placed.withColumn(f"{p}band", F.floor(F.col(f"{p}fraction") * parts))

    bands = ranked(rows.select("doc_id", f"{p}stratum", f"{p}hash", f"{p}part")).groupBy(f"{p}band").agg(F.count("*").alias(f"{p}size"))
    # One row for each part, ordered in one window: their number is rows / part_rows.
    in_order = F.sum(f"{p}size").over(Window.orderBy(f"{p}band"))
    before = bands.select(F.col(f"{p}band").alias(f"{p}at"), (in_order - F.col(f"{p}size")).alias(f"{p}start"))
    in_band = Window.partitionBy(f"{p}band").orderBy(f"{p}fraction", f"{p}stratum", *ties)
    place = F.col(f"{p}start") + F.row_number().over(in_band) - 1
    ordered = ranked(rows).join(before, F.col(f"{p}band") == F.col(f"{p}at")).withColumn(f"{p}place", place)
    shard = F.expr(f"(`{p}place` * {shards}) div {max(n, 1)}")
    first = F.expr(f"(`{p}shard` * {n} + {shards - 1}) div {shards}")
    out = ordered.withColumn(f"{p}shard", shard).withColumn("shard", F.col(f"{p}shard").cast("int"))
    out = out.withColumn("slot", F.col(f"{p}place") - first)
    return out.drop(*[p + c for c in ("stratum", "hash", "fraction", "band", "at", "start", "place", "shard")])
