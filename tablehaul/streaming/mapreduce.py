"""Line-oriented map, combine and reduce jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.functions.text import line_key
from tablehaul.operators.aggregate import reduce_by_key
from tablehaul.sources.lines import read_lines, write_lines
from tablehaul.streaming.pipes import Stage, run_stage


@dataclass(frozen=True)
class named:
    """A built-in reducer over ``key<TAB>whole number`` lines: ``sum``, ``min``, ``max`` or ``count``."""

    reducer: str


def map_reduce(
    spark: SparkSession,
    input: DataFrame | str | Sequence[str],
    output: str | None = None,
    mapper: Stage | None = None,
    reducer: Stage | named | None = None,
    combiner: Stage | bool | None = None,
    map_tasks: int | None = None,
    reduce_tasks: int | None = None,
) -> DataFrame:
    """Map lines, bring lines of a key together in key order, reduce them.

    ``input`` is a DataFrame of lines, a path, or several paths and globs. A stage is a callable from an
    iterator of lines to lines, or a shell command. The key of a line is the text before its first tab. A
    reducer sees its whole partition, sorted by key, as one stream, so keys never need to fit in memory.

    ``combiner`` folds the lines of each map partition before the shuffle (``True``: with the reducer); it sees
    the lines of a key one after another, but keys in no set order. With one, a key that holds much of the data
    reaches its reducer as one line per map partition. A reducer marked ``associative`` is its own combiner if none is
    given, unless ``combiner=False``. Without any, all lines of a key stream through one task. A combiner without a reducer and without ``reduce_tasks`` is the last step. ``reduce_tasks=0`` stops after the map; a number without a reducer sorts the lines by key. ``output``
    overwrites a dataset with the result, which is then read back from there.
    """
    if isinstance(input, DataFrame):
        lines = input.repartition(map_tasks) if map_tasks else input
    else:
        lines = read_lines(spark, input)
        if map_tasks:
            splits = lines.rdd.getNumPartitions()
            lines = lines.coalesce(map_tasks) if map_tasks < splits else lines.repartition(map_tasks)
    if mapper is not None:
        lines = run_stage(lines, mapper)
    if combiner is True and reducer is None:
        raise ValueError("combiner=True means the reducer, and there is none")
    if isinstance(reducer, named) and combiner not in (None, True, False):
        raise ValueError("a named reducer combines by itself; it takes no combiner")
    if reduce_tasks == 0 and combiner not in (None, False):
        raise ValueError("without a reduce step (reduce_tasks=0) no combiner runs")
    if combiner is None and getattr(reducer, "associative", False):
        combiner = True
    combiner = combiner or None
    if reduce_tasks != 0 and (reducer is not None or combiner is not None or reduce_tasks):
        lines = _reduced(lines, reducer, reducer if combiner is True else combiner, reduce_tasks)
    if output is None:
        return lines
    write_lines(lines, output)
    return read_lines(spark, output)


def _reduced(
    lines: DataFrame, reducer: Stage | named | None, combiner: Stage | named | None, tasks: int | None
) -> DataFrame:
    if isinstance(reducer, named):
        # Partial aggregation is built in, a combiner would only repeat it.
        text = F.get(F.split("value", "\t", 3), F.lit(1))
        number = text.try_cast("bigint")
        bad = F.raise_error(F.concat(F.lit("no whole number after the first tab: "), F.col("value"))).cast("bigint")
        numbers = lines.toDF("value").select(line_key("value").alias("key"), F.coalesce(number, bad).alias("number"))
        totals = reduce_by_key(numbers, "key", "number", reducer.reducer)
        if tasks:
            totals = totals.repartition(tasks, "key")
        return totals.select(F.concat_ws("\t", "key", reducer.reducer).alias("value"))
    lines = lines.toDF("value")
    if combiner is not None:
        hashed = getattr(combiner, "in_any_order", None)
        lines = run_stage(lines, hashed) if hashed else run_stage(_keys_adjacent(lines), combiner)
    if reducer is None:
        return _sorted_lines(lines, tasks) if tasks else lines
    # Only the lines travel: the key is taken from them again on the other side.
    key = line_key("value")
    gathered = lines.repartition(tasks, key) if tasks else lines.repartition(key)
    return run_stage(_in_key_order(gathered), reducer)


def _sorted_lines(lines: DataFrame, tasks: int | None) -> DataFrame:
    # No reducer needs a key whole, so ranges may cut through a hot key, even one whose lines are all alike.
    order = ("key", "value", "source")
    keyed = lines.select(line_key("value").alias("key"), "value", F.spark_partition_id().alias("source"))
    ranged = keyed.repartitionByRange(tasks, *order) if tasks else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).select("value")


def _keys_adjacent(lines: DataFrame) -> DataFrame:
    # A combiner may get the lines of a key in several pieces, so it needs them adjacent, not in key order: a sort
    # on one number is a radix sort, much cheaper than comparing texts, and two keys with one hash do no harm.
    hashed = lines.select(F.xxhash64(line_key("value")).alias("hash"), "value")
    return hashed.sortWithinPartitions("hash").select("value")


def _in_key_order(lines: DataFrame) -> DataFrame:
    return lines.select(line_key("value").alias("key"), "value").sortWithinPartitions("key").select("value")
