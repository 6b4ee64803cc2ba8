"""Hard negatives of anchor vectors by exact whole-number scores.

Components are scaled to whole numbers. A score is an inner product, multiplied modulo several small primes in float32, where
every partial sum stays below 2**24 and so exact, and put together again by signed mixed-radix digits (Chinese
remaindering). Rows are cut into slices and anchors into blocks; a task multiplies one slice with one block and keeps the
few best of each anchor, and windows over those pick the best of all. Negatives need the anchor's positives first, so the
tiles are multiplied twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.components import stored
from tablehaul.llm.frames import in_batches

#: Rows of a slice and anchors of a block.
SLICE_ROWS, BLOCK_ROWS = 8192, 2048
#: Scores that are in memory at once.
SCORES_AT_ONCE = 1 << 21
#: Components that are multiplied between two reductions.
CHUNK = 512
#: Tiles of a task, about, and most tasks of a pass.
TILES_PER_TASK, MOST_TASKS = 4, 20_000
#: Scores must be below this, so that a hundred times as much still is a bigint.
MOST_SCORE = 2**56
LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Window5:
    """How many positives and negatives, and between which percentages of the positive's score negatives lie."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def primes_for(width: int, bound: int) -> list[int]:
    """The largest primes that keep a chunk's float32 sums exact, until their product covers -bound to bound."""
    half = isqrt((2**24 - 1) // max(1, min(width, CHUNK)))
    found, product, p = [], 1, 2 * half + 1
    while product <= 2 * bound:
        if p < 3:
            raise ValueError(f"no primes for scores up to {bound}")
        if all(p % q for q in range(3, isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def centred(values: np.ndarray, p: int) -> np.ndarray:
    """The residue nearest to zero, as float32."""
    rest = np.fmod(values, p)
    rest -= p * (rest > p // 2)
    rest += p * (rest < -(p // 2))
    return rest.astype(np.float32)


def _floor_mod(values: np.ndarray, p: int) -> np.ndarray:
    return values - p * (values // p)


def products(anchors: list[np.ndarray], rows: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products from the residues of both sides for each prime."""
    value, base = None, 1
    for a, b, p in zip(anchors, rows, primes):
        rest = np.zeros((len(a), len(b)), np.int32)
        for at in range(0, a.shape[1], CHUNK):
            rest = _floor_mod(rest + (a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int32), p)
        if value is None:
            digit = rest.astype(np.int64)
        else:
            digit = _floor_mod(_floor_mod(rest - value, p) * pow(base, -1, p), p)
        digit -= p * (digit > p // 2)
        value = digit if value is None else value + base * digit
        base *= p
    return value


def best_of_each(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``most`` largest allowed scores of each row; of equal ones those in the first columns."""
    masked = np.where(allowed, scores, LOWEST)
    least = np.partition(masked, -most, axis=1)[:, -most] if masked.shape[1] > most else np.full(len(masked), LOWEST)
    row, column = np.nonzero(allowed & (masked >= least[:, None]))
    order = np.lexsort((-scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < most], column[place < most]


PACKED = "block long, uids binary, ids binary, labels binary, wanted binary, width int, data binary"


def _packed(rows: DataFrame, blocks: int, scale: float, most_wanted: int = 0) -> DataFrame:
    """One row for each block of rows, dealt by a hash and sorted by id: matrix, ids, labels, scores of positives."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
        lists = table["vector"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes.max(initial=0))
        matrix = np.zeros((len(sizes), width))
        matrix[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        matrix = np.floor(scale * matrix)
        small = np.abs(matrix).max(initial=0) < 2**15
        wanted = np.full((len(sizes), most_wanted), LOWEST, np.int64)
        if most_wanted:
            for i, scores in enumerate(table["wanted"].to_pylist()):
                wanted[i, : len(scores)] = scores
        columns = {
            "block": [table["block"][0].as_py()], "uids": [table["uid"].to_numpy().tobytes()],
            "ids": [table["vec_id"].to_numpy().tobytes()], "labels": [table["label"].to_numpy().tobytes()],
            "wanted": [wanted.tobytes()], "width": pa.array([width if small else -width], pa.int32()),
            "data": [matrix.astype(np.int16 if small else np.float64).tobytes()],
        }
        return pa.table(columns)

    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block")
    columns = ["uid", "vec_id", "label", "vector"] + (["wanted"] if most_wanted else [])
    return in_batches(rows.select(block, *columns)).groupBy("block").applyInArrow(pack, PACKED)


@dataclass
class _Side:
    uids: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    wanted: np.ndarray
    matrix: np.ndarray

    @staticmethod
    def of(row: dict, width: int) -> _Side:
        uids, ids, labels, wanted = (np.frombuffer(row[c], np.int64) for c in ("uids", "ids", "labels", "wanted"))
        own = abs(row["width"])
        # A width below zero says that the numbers are large; width 0 has no numbers.
        data = np.frombuffer(row["data"], np.int16 if row["width"] >= 0 else np.float64).reshape(len(ids), own)
        matrix = np.zeros((len(ids), width))
        matrix[:, :own] = data
        return _Side(uids, ids, labels, wanted.reshape(len(ids), -1), matrix)


FOUND = "uid long, kind int, other long, other_id long, score long"


def _tiles(anchors: DataFrame, slices: DataFrame, blocks: int, cuts: int, primes: list[int], rules: Window5, negatives: bool) -> DataFrame:
    """The best rows of each tile for each anchor: positives (kind 0), or negatives for the positive at place ``kind``."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((5, 0), np.int64)]
        for a_row in left.to_pylist():
            for b_row in right.to_pylist():
                width = max(abs(a_row["width"]), abs(b_row["width"]))
                a, b = _Side.of(a_row, width), _Side.of(b_row, width)
                rows = [centred(b.matrix, p) for p in primes]
                step = max(1, SCORES_AT_ONCE // max(1, len(b.ids)))
                for at in range(0, len(a.ids), step):
                    own = slice(at, at + step)
                    scores = products([centred(a.matrix[own], p) for p in primes], rows, primes)
                    same = a.labels[own, None] == b.labels
                    if not negatives:
                        wishes = [(0, same & (a.uids[own, None] != b.uids))]
                    else:
                        wishes = []
                        for j in range(a.wanted.shape[1]):
                            goal = a.wanted[own, j, None]
                            there = np.maximum(goal, -MOST_SCORE)
                            fits = (goal > LOWEST) & (rules.low * there <= 100 * scores) & (100 * scores <= rules.high * there)
                            wishes.append((j, fits & ~same))
                    for kind, allowed in wishes:
                        r, c = best_of_each(scores, allowed, rules.negatives if negatives else rules.positives)
                        out.append(np.stack([a.uids[own][r], np.full(len(r), kind), b.uids[c], b.ids[c], scores[r, c]]))
        uid, kind, other, other_id, score = np.concatenate(out, axis=1)
        return pa.table({"uid": uid, "kind": kind.astype(np.int32), "other": other, "other_id": other_id, "score": score})

    tasks = min(MOST_TASKS, -(-blocks * cuts // TILES_PER_TASK))
    left = anchors.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1)))).withColumn("tile", F.col("block") * cuts + F.col("cut"))
    right = slices.withColumn("anchors", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("tile", F.col("anchors") * cuts + F.col("block"))
    both = [x.select("tile", *(c.split()[0] for c in PACKED.split(", ")[1:])).repartition(tasks, "tile").groupBy("tile") for x in (left, right)]
    return both[0].cogroup(both[1]).applyInArrow(meet, FOUND)


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("uid", "kind").orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def mine_hard_negatives(vectors: DataFrame, rules: Window5 = Window5(), scale: float = 256.0) -> DataFrame:
    """For each anchor and positive, the rows of other labels whose score is near below the positive's.

    ``vectors`` has vec_id bigint, label, vector (an array of numbers) and anchor boolean; other columns are not looked
    at. A component x counts as floor(scale * x). Positives are the rows of the anchor's label with the largest scores,
    itself left out; negatives are rows of other labels with ``low * positive <= 100 * score <= high * positive``. Larger
    scores come first, of equal ones the smaller vec_id. Returns anchor_id, positive_id, rank from 1, negative_id,
    positive_score, negative_score.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part; a null ``anchor`` is no
    anchor. A shorter vector has zeros for what it lacks, so an empty one scores 0 with all. Rows that share a vec_id are
    rows of their own: each may be an anchor, a positive of the other or a negative. Scores of 2**56 or more are refused
    with an error. An empty table, or one without anchors, has no rows.
    """
    spark = vectors.sparkSession
    vector = F.col("vector").cast("array<double>")
    clean = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), vector.alias("vector"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    clean = clean.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector")))
    rows = stored(clean.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    largest = F.max(F.aggregate("vector", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(F.floor(F.lit(scale) * x).cast("double")), F.abs(scale * x))))
    total, n_anchors, width, top = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vector")), largest).first()
    if not n_anchors:
        return spark.createDataFrame([], RESULT)
    top = float(top) + 1
    if not width * top * top < MOST_SCORE:
        raise ValueError(f"scores of {width} components up to {top} may be {MOST_SCORE} or more")
    primes = primes_for(width, int(width * top * top) + 1)
    cuts, blocks = -(-total // SLICE_ROWS), -(-n_anchors // BLOCK_ROWS)
    slices = stored(_packed(rows, cuts, scale), "slices")
    anchors = rows.where("anchor")
    near = _tiles(_packed(anchors, blocks, scale), slices, blocks, cuts, primes, rules, negatives=False)
    positives = stored(_best(near, rules.positives).select("uid", F.col("place").alias("kind"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = F.transform(F.array_sort(F.collect_list(F.struct("kind", "positive_score"))), lambda x: x["positive_score"])
    wishing = anchors.join(positives.groupBy("uid").agg(scores.alias("wanted")), "uid")
    below = _tiles(_packed(wishing, blocks, scale, rules.positives), slices, blocks, cuts, primes, rules, negatives=True)
    best = _best(below, rules.negatives).select("uid", (F.col("kind") + 1).alias("kind"), F.col("place").alias("rank"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return named.join(best, ["uid", "kind"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
