"""Token counts: texts are encoded in Arrow batches balanced by bytes, and only lengths come back.

Texts are cut where the tokenizer can't join both sides, equal units of a batch are encoded once, and the counts of
the units are added up per text. So a long text is never encoded as one string, and a batch never holds more than its
bytes and its distinct units.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tablehaul.llm.frames import batch_with, in_batches, schema_with
from tablehaul.llm.textarrays import byte_slices, flat, strings, sums

#: Bytes of text that are encoded together.
BATCH_BYTES = 8 << 20
#: Units given to the library in one call.
UNITS_PER_CALL = 20_000
#: The library's sign for a blank. A text that spells it is encoded whole.
BLANK = "▁"


@cache
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the units, first the texts' own, and whether a unit begins with a line feed inside its text.

    No piece has a blank after another character, and none has a line feed. So a text may be cut before a run of
    blanks, and before a line feed. The first blank of a unit is left out, as the library puts one before each string.
    """
    blank = data == 0x20
    after = np.ones(len(data), bool)
    after[1:] = ~blank[:-1]
    cut = (blank & after) | (data == 0x0A)
    own = offsets[:-1][np.diff(offsets) > 0]
    cut[own] = True
    starts = np.flatnonzero(cut)
    at_text = np.zeros(len(data), bool)
    at_text[own] = True
    inside = ~at_text[starts]
    return starts, inside


def text_lengths(texts: pa.Array, model: str) -> np.ndarray:
    """Number of tokens of each text, as encoding it whole gives it."""
    sp = processor(model)
    data, offsets = flat(texts)
    starts, inside = safe_cuts(data, offsets)
    blank_first = inside & (data[starts] == 0x20)
    feed_first = inside & (data[starts] == 0x0A)
    first = np.searchsorted(starts, offsets)
    # A unit at the start of its text differs from the same bytes inside one: it gets a mark of its own.
    keep = np.ones(len(data), bool)
    keep[starts[blank_first]] = False
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    units = strings(data[keep], np.append(before[starts], before[-1])).dictionary_encode()
    spelled = units.dictionary.to_pylist()
    lengths = np.zeros(len(spelled), np.int64)
    for begin in range(0, len(spelled), UNITS_PER_CALL):
        part = sp.encode(spelled[begin : begin + UNITS_PER_CALL], num_threads=1)
        lengths[begin : begin + len(part)] = [len(x) for x in part]
    per_unit = lengths[units.indices.to_numpy()] if len(starts) else np.zeros(0, np.int64)
    per_unit[feed_first] -= 1  # the blank that the library puts before the line feed
    per_unit[blank_first & (np.diff(np.append(before[starts], before[-1])) == 0)] = 1  # a lone blank
    out = sums(per_unit, first)
    spell_blank = pc.fill_null(pc.match_substring(texts.cast(pa.large_string()), BLANK), False).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(spell_blank):
        out[i] = len(sp.encode(texts[int(i)].as_py()))
    return out


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``model`` is the path of a sentencepiece model whose pieces hold a blank in front only. A null text is empty: 0
    bytes, 0 tokens. Columns of ``docs`` with the name of an added one are replaced.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            texts = batch.column("text")
            n = text_lengths(texts, model)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield batch_with(batch, {"n_bytes": size, "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    return in_batches(docs).mapInArrow(count, schema_with(docs, "n_bytes bigint, n_tokens bigint, over_limit boolean"))
