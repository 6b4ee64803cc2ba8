"""Substring dedup by sliding sentence spans.

Runs of several consecutive sentences are hashed, equal runs are found in one global join, and the sentences covered
by any run that isn't the first of its kind are taken out of their text.

Of all runs of enough words, two for each sentence are enough: the shortest that begins and the shortest that ends with it.
A sentence s of a repeated run from b to e is in a shorter one that repeats with it: in the shortest that begins with b if it
reaches s, else in the shortest that ends with s, which begins at b or later, as b to s then has enough words. Runs are
compared by their words; where the same words are parted into other sentences, only those two are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.components import join_counted, stored
from tablehaul.llm.frames import batch_with, in_batches, schema_with
from tablehaul.llm.textarrays import SLICE_BYTES, byte_slices, flat, mixed, powers, words_of

#: A span ends with the first sentence that gives it two sentences and so many words,
SPAN_WORDS = 20
#: or so many words, however few sentences.
LONE_WORDS = 40
#: Bytes of text at once: its sentences and spans take some 30 times as much memory.
AT_ONCE = SLICE_BYTES // 2
_BASES = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)


def sentences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First sentence of each text, first word and first byte of each sentence, and the words' hashes.

    A sentence ends with a word whose last sign, before closing quotes and brackets, is ``.``, ``!`` or ``?``, and at a
    line feed. A-Z count as a-z; white space between words doesn't count.
    """
    words = words_of(texts)
    data, _ = flat(texts)
    n = len(words.hash)
    begins = np.zeros(n + 1, bool)
    if n:
        last = data[words.end - 1]
        closing = np.isin(last, np.frombuffer(b"\"')]", np.uint8)) & (words.end - words.start > 1)
        last = np.where(closing, data[np.maximum(words.end - 2, 0)], last)
        feeds = np.append(0, np.cumsum(data == 10))
        begins[1:n] = np.isin(last[:-1], np.frombuffer(b".!?", np.uint8)) | (feeds[words.start[1:]] > feeds[words.end[:-1]])
        begins[words.first[:-1]] = True
        begins[n] = False
    at = np.flatnonzero(begins)
    return np.searchsorted(at, words.first), at, words.start[at], words.hash


def spans(first: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, sentence after the last, 128-bit hash as two columns) of the shortest spans that begin and that end at
    each sentence, each once.

    No span reaches into another text; a sentence too near to an edge of its text begins or ends none.
    """
    m = len(at)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
    edge = np.append(at, len(hashes))  # first word of each sentence
    own_end = np.repeat(first[1:], np.diff(first))  # sentence after the text's last
    begin = np.arange(m)
    two = np.maximum(np.searchsorted(edge, edge[:-1] + SPAN_WORDS), begin + 2)
    lone = np.searchsorted(edge, edge[:-1] + LONE_WORDS)
    end = np.minimum(two, np.maximum(lone, begin + 1))
    good = end <= own_end
    # The same from the other side: the last sentence that is early enough, for spans that end before sentence k + 1.
    last = np.arange(1, m + 1)
    two = np.minimum(np.searchsorted(edge, edge[1:] - SPAN_WORDS, side="right") - 1, last - 2)
    lone = np.minimum(np.searchsorted(edge, edge[1:] - LONE_WORDS, side="right") - 1, last - 1)
    start = np.maximum(two, lone)
    fits = start >= np.repeat(first[:-1], np.diff(first))
    # A span that is both is the shortest from its begin; it was taken there.
    fits[fits] = end[start[fits]] != last[fits]
    begin, end = np.append(begin[good], start[fits]), np.append(end[good], last[fits])
    out = np.zeros((2, len(begin)), np.uint64)
    for k, base in enumerate(_BASES):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed(hashes + np.uint64(k)) * powers(base, len(hashes)), out=total[1:])
        back = powers(pow(base, -1, 2**64), len(hashes) + 1)
        out[k] = mixed((total[edge[end]] - total[edge[begin]]) * back[edge[begin]] + (edge[end] - edge[begin]).astype(np.uint64))
    return begin, end, out.view(np.int64)


def _text_key() -> Column:
    """A hash of the whole text, to tell rows with the same doc_id apart."""
    return F.xxhash64("text")


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, key, begin, end, h1, h2): sentence numbers count within the text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", AT_ONCE):
            first, at, _, hashes = sentences(batch.column("text"))
            begin, end, value = spans(first, at, hashes)
            owner = np.searchsorted(first, begin, side="right") - 1
            columns = [
                batch.column("doc_id").take(pa.array(owner)), batch.column("key").take(pa.array(owner)), pa.array((begin - first[owner]).astype(np.int32)),
                pa.array((end - first[owner]).astype(np.int32)), pa.array(value[0]), pa.array(value[1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "begin", "end", "h1", "h2"])

    given = docs.select(F.col("doc_id").cast("bigint"), "text", _text_key().alias("key"))
    return in_batches(given).mapInArrow(find, "doc_id bigint, key bigint, begin int, end int, h1 bigint, h2 bigint")


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated sentences cut out of ``text``.

    Adds ``n_sentences`` and ``n_removed``; the text is unchanged, byte for byte, where nothing is removed. Of equal spans the
    one with the smallest (doc_id, sentence) stays, so a text's own repetitions go too. A null doc_id comes before all
    others. Rows with the same doc_id and text count as one document: they don't repeat each other at the same sentence.
    Rows with the same doc_id and other texts are documents of their own. A null
    text stays null; a text may end up empty. Added columns replace those of ``docs`` with their name.
    """
    found = stored(_occurrences(docs), "spans")
    h = ["h1", "h2"]
    # Few spans repeat: only the hashes of all are counted, and only those that do are compared by place.
    repeated = stored(found.groupBy(*h).agg(F.count("*").alias("times")).where("times > 1"), "repeated-hashes")
    total = repeated.agg(F.sum("times")).first()[0] or 0
    again = stored(join_counted(found, repeated, h, "times", total), "repeated-spans")
    here = F.struct("doc_id", "begin", "key")
    heads = again.groupBy(*h, "times").agg(F.min(here).alias("head"))
    again = join_counted(again.drop("times"), heads, h, "times", total).where(~here.eqNullSafe(F.col("head")))
    covered = again.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("_covered"))
    covered = covered.select(F.col("doc_id").alias("_covered_id"), F.col("key").alias("_covered_key"), "_covered")
    docs = docs.drop("_covered", "_covered_id", "_covered_key")
    joined = docs.join(covered, F.col("doc_id").eqNullSafe(F.col("_covered_id")) & (_text_key() == F.col("_covered_key")), "left").drop("_covered_id", "_covered_key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", AT_ONCE):
            texts = batch.column("text")
            first, _, byte, _ = sentences(texts)
            data, offsets = flat(texts)
            removed = np.zeros(batch.num_rows, np.int64)
            out = texts.to_pylist()
            for t, own in enumerate(batch.column("_covered").to_pylist()):
                n = int(first[t + 1] - first[t])
                gone = np.zeros(n, bool)
                for span in own or []:
                    gone[span["begin"] : span["end"]] = True
                removed[t] = gone.sum()
                if removed[t]:
                    edge = np.append(byte[first[t] : first[t + 1]], offsets[t + 1])
                    kept = [data[edge[k] : edge[k + 1]].tobytes() for k in np.flatnonzero(~gone)]
                    head = data[offsets[t] : edge[0]].tobytes() if kept else b""
                    out[t] = (head + b"".join(kept)).decode()
            added = {"text": pa.array(out, pa.string()), "n_sentences": pa.array(np.diff(first)), "n_removed": pa.array(removed)}
            result = batch_with(batch, added)
            yield result.select([x for x in result.schema.names if x != "_covered"])

    return in_batches(joined).mapInArrow(cut, schema_with(docs, "text string, n_sentences bigint, n_removed bigint"))
