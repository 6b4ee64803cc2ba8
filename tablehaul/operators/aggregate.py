"""Per-key reduction with built-in aggregates (partial aggregation before the shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.text import tokenize

REDUCERS = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
#: Exact sums are kept in two halves: the numbers' upper bits, and their lower bits so many.
LOW_BITS = 32


def exact_sum(value: Column) -> Column:
    """The sum of a bigint column. Only the whole sum must fit a bigint, not the partial ones before the shuffle."""
    return joined_halves(F.sum(F.shiftright(value, LOW_BITS)), F.sum(value.bitwiseAND(F.lit((1 << LOW_BITS) - 1))))


def joined_halves(high: Column, low: Column, what: str = "the sum of a key") -> Column:
    """The sum that two halves stand for."""
    high = high + F.shiftright(low, LOW_BITS)
    low = low.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    fits = high.isNull() | high.between(-(1 << 31), (1 << 31) - 1)
    return F.when(fits, F.shiftleft(high, LOW_BITS).bitwiseOR(low)).otherwise(F.raise_error(F.lit(f"{what} does not fit a bigint")).cast("bigint"))


def reduce_by_key(
    df: DataFrame, keys: str | list[str], value: str | Column, reducers: str | list[str] = "sum"
) -> DataFrame:
    """One row per key with a column per named reducer (``sum``, ``min``, ``max``, ``count``)."""
    names = [reducers] if isinstance(reducers, str) else reducers
    unknown = set(names) - set(REDUCERS)
    if unknown:
        raise ValueError(f"unknown reducers {sorted(unknown)}, known: {sorted(REDUCERS)}")
    keys = [keys] if isinstance(keys, str) else keys
    whole = isinstance(df.select(value).schema[0].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    number = (F.col(value) if isinstance(value, str) else value).cast("bigint") if whole else value
    return df.groupBy(*keys).agg(*[(exact_sum(number) if whole and n == "sum" else REDUCERS[n](value)).alias(n) for n in names])


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, n): how often each Unicode word occurs."""
    words = lines.select(F.explode(tokenize(column)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))
