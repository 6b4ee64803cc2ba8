"""Ready-made stages of a word count job, over Arrow batches of lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablehaul.operators.aggregate import LOW_BITS
from tablehaul.operators.runs import exact_sums
from tablehaul.streaming.pipes import associative, batched

# Fixed value: what separates Unicode words.
BETWEEN_WORDS = r"[^\p{L}\p{N}_]+"
WHOLE_NUMBER = re.compile(r"[+-]?[0-9]+")
# Texts split at a time: bounds the size of a batch of words when texts are long.
TEXTS_AT_ONCE = 256
# Bounds of what is summed up at a time where lines have no order.
LINES_COMBINED = 500_000
BYTES_COMBINED = 32 << 20


@batched
def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Mapper: ``word<TAB>1`` for each Unicode word of each line."""
    for lines in batches:
        for start in range(0, len(lines), TEXTS_AT_ONCE):
            found = pc.split_pattern_regex(lines.slice(start, TEXTS_AT_ONCE), BETWEEN_WORDS).flatten()
            yield pc.binary_join_element_wise(found.filter(pc.not_equal(found, "")), "1", "\t")


@associative
@batched
def sum_adjacent(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Combiner and reducer: the sum of adjacent ``key<TAB>whole number`` lines of one key.

    On sorted lines this is the sum per key, on others the sum per run.
    """
    open_key, open_sum = None, 0  # the run that may go on in the next batch
    for lines in batches:
        if not len(lines):
            continue
        fields = pc.split_pattern(lines, "\t", max_splits=2)
        keys, numbers = pc.list_element(fields, 0), _whole_numbers(pc.list_element(fields, 1))
        differs = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(differs) + 1])
        sums, heads = exact_sums(numbers, starts), keys.take(pa.array(starts))
        if heads[0].as_py() == open_key:
            sums[0] += open_sum
        elif open_key is not None:
            yield pa.array([f"{open_key}\t{_checked([open_sum])[0]}"])
        open_key, open_sum = heads[-1].as_py(), sums[-1]
        texts = pa.array(_checked(sums[:-1]), pa.int64()).cast(pa.string())
        yield pc.binary_join_element_wise(heads.slice(0, len(heads) - 1), texts, "\t")
    if open_key is not None:
        yield pa.array([f"{open_key}\t{_checked([open_sum])[0]}"])


@batched
def _sum_in_any_order(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Combiner: sums per key of some lines at a time, by a hash table of bounded size; needs no order of the lines."""
    some, size = [], 0
    for lines in batches:
        some.append(lines)
        size += len(lines)
        if size >= LINES_COMBINED or sum(x.nbytes for x in some) >= BYTES_COMBINED:
            yield _sums(some)
            some, size = [], 0
    if size:
        yield _sums(some)


def _sums(arrays: list[pa.Array]) -> pa.Array:
    fields = pc.split_pattern(pa.concat_arrays(arrays), "\t", max_splits=2)
    numbers = _whole_numbers(pc.list_element(fields, 1))
    if numbers.dtype == object:  # sums of sums
        total: dict[str, int] = {}
        for key, number in zip(pc.list_element(fields, 0).to_pylist(), numbers.tolist(), strict=True):
            total[key] = total.get(key, 0) + number
        return pa.array([f"{key}\t{number}" for key, number in total.items()], pa.string())
    halves = {"high": numbers >> LOW_BITS, "low": numbers & ((1 << LOW_BITS) - 1)}
    table = pa.table({"key": pc.list_element(fields, 0), **halves}).group_by("key").aggregate([("high", "sum"), ("low", "sum")])
    high, low = (table[f"{c}_sum"].to_pylist() for c in halves)
    # What is summed up here is a part of a sum; only the whole one must fit a bigint.
    sums = [str((h << LOW_BITS) + l) for h, l in zip(high, low, strict=True)]
    return pc.binary_join_element_wise(table["key"].combine_chunks(), pa.array(sums, pa.string()), "\t")


def _whole_numbers(texts: pa.Array) -> np.ndarray:
    """Whole numbers; of Python's own kind if some partial sum is beyond bigint."""
    try:
        return texts.cast(pa.int64()).to_numpy()
    except pa.ArrowInvalid:
        wide = texts.to_pylist()
        for text in wide:
            if text is None or not WHOLE_NUMBER.fullmatch(text):
                raise
        return np.array([int(text) for text in wide], object)


# A job that combines with this stage need not put the lines of a key next to each other before.
sum_adjacent.in_any_order = _sum_in_any_order


def _checked(sums: list[int]) -> list[int]:
    if any(not -(1 << 63) <= s < 1 << 63 for s in sums):
        raise OverflowError("the sum of a run does not fit a bigint")
    return sums
