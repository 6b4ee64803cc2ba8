"""Language identification by language-bitmask n-gram filters.

Each language's most frequent letter n-grams go into Bloom filters that share their slots: a slot holds one bit for
each language (bit-sliced), so a probe returns the set of all languages that have the n-gram. A text's n-grams are
probed, the hits of each language counted and corrected for the filter's false positives, and the best language wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.frames import batch_with, in_batches, sampled, schema_with
from tablehaul.llm.textarrays import byte_slices, crc32_mod, flat, mixed, sums

SIZES = (2, 3, 4)
#: Labelled texts that the filters are fitted to.
SAMPLE_ROWS = 20_000
#: n-grams kept for each language and size: the most frequent ones of the sample.
KEPT = 800
SLOTS = 1 << 16
PROBES = 2
UNKNOWN = "und"


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 texts, and the offsets of the texts in them."""
    begins = (data & 0xC0) != 0x80
    at = np.flatnonzero(begins)
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32)
    lead = padded[at]
    more = (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & np.array([0x7F, 0x1F, 0x0F, 0x07], np.uint32)[more]
    for k in range(1, 4):
        longer = more >= k
        point[longer] = (point[longer] << 6) | (padded[at[longer] + k] & 0x3F)
    return point, np.append(0, np.cumsum(begins))[offsets]


def letter_ngrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size: hashes of all n-grams of letters and single blanks, and the first one of each text.

    ASCII signs and digits part n-grams; other characters beside ASCII count as letters here.
    """
    points, offsets = code_points(*flat(pc.utf8_lower(texts.cast(pa.large_string()))))
    points[points == 0x0A] = 0x20
    good = ((points >= ord("a")) & (points <= ord("z"))) | (points >= 0x80) | (points == 0x20)
    owner_end = np.repeat(offsets[1:], np.diff(offsets))
    for size in SIZES:
        n = max(0, len(points) - size + 1)
        code = np.full(n, size, np.uint64)
        fine = np.arange(size, n + size) <= owner_end[:n]
        for k in range(size):
            code = code * np.uint64(0x9E3779B97F4A7C15) + points[k : n + k]
            fine &= good[k : n + k]
        at = np.flatnonzero(fine)
        yield size, code[at], np.searchsorted(at, offsets)


@dataclass
class Filters:
    """``masks[w, slot]`` holds the bits of languages ``64 w`` to ``64 w + 63``."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    common: int

    @classmethod
    def build(cls, grams: list[tuple[str, int]], rows: dict[str, int]) -> Filters:
        languages = sorted(rows)
        masks = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint64)
        number = {x: i for i, x in enumerate(languages)}
        codes = np.array([g for _, g in grams], np.int64).view(np.uint64)
        own = np.array([number[x] for x, _ in grams], np.int64)
        for slots in _slots(codes):
            np.bitwise_or.at(masks, (own // 64, slots), np.uint64(1) << (own % 64).astype(np.uint64))
        fill = np.array([np.count_nonzero(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / SLOTS for i in range(len(languages))])
        common = max(range(len(languages)), key=lambda i: (rows[languages[i]], -i)) if languages else 0
        return cls(languages, masks, fill**PROBES, common)

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the share of the best language in the corrected hits of all."""
        n = len(texts)
        hits, total = np.zeros((len(self.languages), n)), np.zeros(n)
        for _, codes, first in letter_ngrams(texts):
            total += np.diff(first)
            found = None
            for slots in _slots(codes):
                found = self.masks[:, slots] if found is None else found & self.masks[:, slots]
            for i in range(len(self.languages)):
                hits[i] += sums(((found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64), first)
        worded = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        f = self.false_rate[:, None]
        true = np.maximum(0, (hits - total * f) / (1 - np.minimum(f, 0.999)))
        best = np.where(true.max(axis=0) > 0, true.argmax(axis=0), self.common)
        score = np.where(worded, true.max(axis=0) / np.maximum(true.sum(axis=0), 1e-9), 0.0)
        return [self.languages[b] if w else UNKNOWN for b, w in zip(best, worded)], np.clip(score, 0, 1)


def _slots(codes: np.ndarray) -> Iterator[np.ndarray]:
    value = mixed(codes.copy())
    for k in range(PROBES):
        yield ((value >> np.uint64(20 * k)) % np.uint64(SLOTS)).astype(np.int64)


def fit_language(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, kept: int = KEPT) -> Filters:
    """Filters from about ``sample_rows`` rows of ``docs`` (doc_id, text, lang) that have a language.

    ``kept`` is the number of n-grams of each size that a language keeps, the most frequent of the sample; it bounds what the
    filters weigh, about 3 * ``kept`` numbers for each language. Rows are picked by a hash of doc_id; a null doc_id is hashed like any other value. An n-gram counts for a language
    once for each text that has it. Without a labelled row there is no language, and every text is ``und``.
    """
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    chosen = sampled(labelled, "doc_id", labelled.count(), sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            coded = batch.column("lang").dictionary_encode()
            lang = coded.indices.to_numpy()
            for size, codes, first in letter_ngrams(batch.column("text")):
                owner = lang[np.repeat(np.arange(batch.num_rows), np.diff(first))]
                for i, name in enumerate(coded.dictionary.to_pylist()):
                    values, n = np.unique(codes[owner == i], return_counts=True)
                    names = pa.array([name] * len(values), pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(np.full(len(values), size, np.int32)), pa.array(values.view(np.int64)), pa.array(n)], ["lang", "size", "gram", "n"])

    grams = in_batches(chosen).mapInArrow(count, "lang string, size int, gram bigint, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    # A language has a few thousand n-grams of a size in the bounded sample; only the most frequent come back.
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    telling = grams.withColumn("place", place).where(F.col("place") <= kept).select("lang", "gram").collect()
    rows = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    return Filters.build([(r["lang"], r["gram"]) for r in telling], rows)


def identify_language(docs: DataFrame, filters: Filters) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    ``und`` with score 0 if the text is null, empty or has no letter. A text with letters but without a known n-gram
    gets the most frequent language of the sample and score 0. Columns of ``docs`` with these names are replaced.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 4 << 20):
            names, score = filters.judge(batch.column("text"))
            yield batch_with(batch, {"lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})

    return in_batches(docs).mapInArrow(judge, schema_with(docs, "lang_pred string, score double"))
