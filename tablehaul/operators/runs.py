"""Sums over runs of equal adjacent keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.operators.aggregate import LOW_BITS, joined_halves
from tablehaul.sources.scratch import scratch_path

_PLACE = "_part int, _fragment long, _edge boolean, _high long, _low long, rows long, _numbers long"


def run_sum(
    df: DataFrame,
    key: str,
    value: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """One row per run of equal ``key`` values in ``order_by`` order, within ``partition_by`` if given.

    Columns: ``partition_by``, ``key``, the ``order_by`` values of the first row of the run, ``total`` (sum of
    the whole numbers in ``value``) and ``rows``. Rows that tie in ``order_by`` are taken in key order.

    Data is cut by ranges of the order itself, so neither one huge partition value nor a global order ends
    up in one task. Each range yields fragments of runs; only the first and last fragment of a range can
    continue in a neighbour, and these (two per range at most) are stitched together. Rows that tie in all of it are
    spread over ranges too. Sums are exact; one that does not fit a bigint fails the job. The rows are
    computed once and written, as a sample of them sets the ranges; the fragments are written to ``scratch``, as both
    steps read them and must see the same ranges.
    """
    spark = df.sparkSession
    group, order = [*partition_by, key], [o for o in order_by if o not in (*partition_by, key)]
    ranges = list(dict.fromkeys([*partition_by, *order_by, key]))
    rows = df.select(*group, *order, F.col(value).cast("bigint").alias("_value"))
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    written = scratch_path(spark, "run-rows")
    spread.write.parquet(written)
    known = spark.read.schema(spread.schema).parquet(written)
    placed = known.repartitionByRange(*ranges, "_tie").drop("_tie").sortWithinPartitions(*ranges)
    schema = T.StructType([*df.select(*group, *order).schema, *T.StructType.fromDDL(_PLACE)])
    path = scratch or scratch_path(spark, "runs")
    placed.mapInArrow(_fragments(len(group)), schema).write.mode("overwrite").parquet(path)

    fragments = spark.read.schema(schema).parquet(path)
    result = [*group, *order, F.when(F.col("_numbers") > 0, joined_halves(F.col("_high"), F.col("_low"), "the sum of a run")).alias("total"), "rows"]
    inner = fragments.where(~F.col("_edge"))
    return inner.select(*result).unionAll(_stitched(fragments.where("_edge"), group, order).select(*result))


def _stitched(edges: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    # One window over all edges: at most two rows per range, a number set by the partition count, not the data.
    line = Window.orderBy("_part", "_fragment")
    same_group = F.lit(True)
    for c in group:
        same_group = same_group & F.col(c).eqNullSafe(F.lag(c).over(line))
    continues = same_group & (F.col("_part") != F.lag("_part").over(line))
    marked = edges.withColumn("_start", F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1))
    numbered = marked.withColumn("_run", F.sum("_start").over(line))
    place = F.struct("_part", "_fragment")
    return numbered.groupBy("_run").agg(
        *[F.min_by(c, place).alias(c) for c in group + order],
        *[F.sum(c).alias(c) for c in ("_high", "_low", "rows", "_numbers")],
    )


def _fragments(group_width: int):
    """A pass over sorted rows (group columns, order columns, number) that yields one row per run fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        previous = pending = None  # last row seen; fragment still open
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(previous, batch, group_width))
            previous = batch.slice(batch.num_rows - 1)
            cuts = np.unique(np.concatenate([[0], starts]))
            totals = _totals(batch, cuts)
            if len(starts) == 0 or starts[0] != 0:  # the batch goes on with the open fragment
                pending = (pending[0], pending[1] + totals[:, 0])
                totals = totals[:, 1:]
            if len(starts) == 0:
                continue
            heads = batch.take(pa.array(starts)).select(range(batch.num_columns - 1))
            if pending is not None:
                heads = pa.Table.from_batches([pending[0], heads]).combine_chunks().to_batches()[0]
                totals = np.column_stack([pending[1], totals])
            last = heads.num_rows - 1
            if last:
                yield _placed(heads.slice(0, last), totals[:, :last], part, number, edge_at=0 if number == 0 else None)
                number += last
            pending = (heads.slice(last), totals[:, last])
        if pending is not None:
            yield _placed(pending[0], pending[1][:, None], part, number, edge_at=0)

    return run


def _changes(previous: pa.RecordBatch | None, batch: pa.RecordBatch, width: int) -> np.ndarray:
    """For each row, whether its group differs from the row before."""
    rows = pa.Table.from_batches([batch] if previous is None else [previous, batch]).combine_chunks()
    changed = np.zeros(rows.num_rows - 1, dtype=bool)
    for i in range(width):
        column = rows.column(i)
        here, before = column.slice(1), column.slice(0, rows.num_rows - 1)
        differs = pc.fill_null(pc.not_equal(here, before), False)
        differs = pc.or_(differs, pc.xor(pc.is_null(here), pc.is_null(before)))
        changed |= differs.to_numpy()
    return np.concatenate([[True], changed]) if previous is None else changed


def _totals(batch: pa.RecordBatch, cuts: np.ndarray) -> np.ndarray:
    """Sum, row count and count of non-NULL numbers of each stretch of rows."""
    values = batch.column(batch.num_columns - 1)
    known = pc.is_valid(values).to_numpy(zero_copy_only=False)
    numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
    rows = np.diff([*cuts, len(numbers)])
    return np.array([*half_sums(numbers, cuts), rows, np.add.reduceat(known.astype(int), cuts)], dtype=np.int64)


def half_sums(numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the stretches of whole numbers that begin at ``starts``, in two halves that can't overflow.

    Each number is ``high * 2**LOW_BITS + low``; some two thousand million of them may be added up.
    """
    low = numbers & ((1 << LOW_BITS) - 1)
    return np.add.reduceat(numbers >> LOW_BITS, starts), np.add.reduceat(low, starts)


def exact_sums(numbers: np.ndarray, starts: np.ndarray) -> list[int]:
    """Sums of the stretches of whole numbers that begin at ``starts``."""
    high, low = half_sums(numbers, starts)
    if not ((high + (low >> LOW_BITS) >= 1 << 31) | (high + (low >> LOW_BITS) < -(1 << 31))).any():
        return ((high << LOW_BITS) + low).tolist()
    return [(h << LOW_BITS) + l for h, l in zip(high.tolist(), low.tolist(), strict=True)]


def _placed(
    heads: pa.RecordBatch, totals: np.ndarray, part: int, number: int, edge_at: int | None
) -> pa.RecordBatch:
    size = heads.num_rows
    edge = np.zeros(size, dtype=bool)
    if edge_at is not None:
        edge[edge_at] = True
    place = [
        pa.array(np.full(size, part), pa.int32()),
        pa.array(np.arange(number, number + size), pa.int64()),
        pa.array(edge),
        *[pa.array(row, pa.int64()) for row in totals],
    ]
    names = [*heads.schema.names, "_part", "_fragment", "_edge", "_high", "_low", "rows", "_numbers"]
    return pa.RecordBatch.from_arrays([*heads.columns, *place], names)
