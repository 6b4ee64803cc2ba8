"""Written intermediate tables, joins that survive hot keys, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.sources.scratch import scratch_path

#: A key is hot from this part of all rows on. There can't be more hot keys than this number, so they may be broadcast.
HOT_PART = 1000
MOST_ROUNDS = 60
#: Ids up to this number are broadcast to find their rows; more are joined by shuffle.
BROADCAST_IDS = 200_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: lost executors don't lose them, and lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, keyed: DataFrame, key: str | list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row that ``keyed`` has for a key, of one or several columns; its column ``count`` says how many rows have the key.

    Rows of hot keys, at most ``HOT_PART`` keys, meet a broadcast table and aren't shuffled; all others are joined as
    usual. ``how`` is inner or left; for left, keys of ``rows`` that ``keyed`` lacks must be rare.
    """
    hot = F.col(count) * HOT_PART >= max(total, 1)
    few = F.broadcast(keyed.where(hot))
    with_hot = rows.join(few, key)
    others = rows.join(F.broadcast(keyed.where(hot).select(key)), key, "left_anti")
    return with_hot.unionByName(others.join(keyed.where(~hot), key, how))


def text_key(text: str = "text") -> Column:
    """A hash of a whole text, that of the empty one for null: tells rows with the same doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def rows_by_key(docs: DataFrame, keys: DataFrame, inside: bool) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text are among ``keys`` (doc_id, text_key), or are not.

    A null id only equals a null id. Rows that only share their doc_id with one of ``keys`` are not among them.
    """
    keys = keys.select(F.col("doc_id").alias(_WANTED[0]), F.col("text_key").alias(_WANTED[1])).distinct()
    few = keys.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    same = F.col("doc_id").eqNullSafe(F.col(_WANTED[0])) & (text_key() == F.col(_WANTED[1]))
    return docs.join(F.broadcast(keys) if few else keys, same, "left_semi" if inside else "left_anti")


# Names that no column of a table has.
_WANTED = ("wanted id of rows_by_key", "wanted text of rows_by_key")


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b): label is the smallest node of the connected component.

    Alternating large-star and small-star steps, each written to shared storage: every step keeps at most one edge for
    each edge and node before it, and their number grows with the logarithm of the component size. Nodes are bigint.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_star(both, "b > a"), "large-star")
        current = stored(_star(large, None), "small-star")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(nodes.select(F.col("label").alias("node"), "label").distinct())


def _star(pairs: DataFrame, only: str | None) -> DataFrame:
    """Each neighbour b of a is tied to the smallest of a and its neighbours; ``only`` picks the neighbours that are."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    least = least.select("a", F.least("a", "m").alias("m"), "n")
    total = pairs.count()  # of written rows: their files' own numbers
    tied = join_counted(pairs, least, "a", "n", total)
    out = (tied.where(only) if only else tied).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if only is None:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
