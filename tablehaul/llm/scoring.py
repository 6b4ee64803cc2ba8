"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs are made over all training texts, quantised on a logarithmic scale, and stored in a Bloom
filter: an n-gram of level q is entered once for each level up to q. A count is read by probing level after level until
one is missing. The filter is broadcast while it is small; a larger one stays in its segments, and the n-grams of each
slice of texts go to the segment of their bucket and come back with their levels. Probabilities are interpolated from
what the probes say.

The exact base score needs each word's exact count, which no task holds for all words: the distinct words of each slice of
texts go to the bucket of their hash, are counted there, and the counts come back to the slice. A word that all documents
have is one entry for each slice there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.components import stored
from tablehaul.llm.frames import in_batches
from tablehaul.llm.textarrays import byte_slices, flat, mixed, slice_hashes, words_of

#: Bytes of text behind a bucket of counts.
BUCKET_TEXT = 24 << 20
BITS_PER_ENTRY = 12
PROBES = 5
#: A filter up to this size is broadcast; a larger one is asked segment by segment. The driver holds it about three times.
MOST_FILTER_BYTES = 128 << 20
#: Counts are below 2**63.
MOST_LEVEL = 63
#: Weight of the pair's estimate at a history seen very often, and the count at which half of it is reached.
PAIR_WEIGHT, HALF_COUNT = 0.6, 8.0
END = int(mixed(np.array([0x5851F42D4C957F2D], np.uint64))[0])
SLICE = 8 << 20


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First token of each text and the tokens' hashes: lower-cased words, then one end."""
    words = words_of(texts)
    n = len(words.first) - 1
    hashes = np.insert(words.hash, words.first[1:], np.uint64(END))
    return words.first + np.arange(n + 1), hashes


def pairs_of(first: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before; the end stands before the first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = np.uint64(END)
    return mixed(mixed(before.copy()) + tokens)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def text_key(texts: pa.Array) -> np.ndarray:
    """A hash of each whole text, to tell rows with the same doc_id apart."""
    data, offsets = flat(texts)
    return slice_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


@dataclass
class LogFilter:
    """Bit segments by bucket: segment b has the bits ``8 * start[b]`` to ``8 * start[b + 1]`` of ``bits``."""

    bits: np.ndarray
    start: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.start) - 1

    @staticmethod
    def segment(hashes: np.ndarray, counts: np.ndarray, bits_per_entry: float) -> bytes:
        """The segment of a bucket's n-grams."""
        level = level_of(counts)
        entries = int(level.sum())
        size = max(64, int(entries * bits_per_entry) // 8 * 8 + 8)
        bits = np.zeros(size, bool)
        for q in range(1, int(level.max()) + 1 if len(level) else 1):
            for place in LogFilter._places(hashes[level >= q], q, size):
                bits[place] = True
        return np.packbits(bits, bitorder="little").tobytes()

    @staticmethod
    def _places(hashes: np.ndarray, level: int, size) -> Iterator[np.ndarray]:
        value = mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
        step = mixed(value.copy()) | np.uint64(1)
        for k in range(PROBES):
            yield ((value + np.uint64(k) * step) % np.asarray(size, np.uint64)).astype(np.int64)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level of each n-gram, 0 if it isn't there."""
        out = np.zeros(len(hashes), np.int64)
        at = np.arange(len(hashes))
        home = bucket_of(hashes, self.buckets)
        base, size = self.start[home], (self.start[home + 1] - self.start[home]) * 8
        level = 1
        while len(at) and level <= MOST_LEVEL:
            there = np.ones(len(at), bool)
            for place in self._places(hashes[at], level, size[at]):
                there &= (self.bits[base[at] + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 > 0
            at = at[there]
            out[at] = level
            level += 1
        return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, after a byte that says how many."""
    width = 1 if values.max(initial=0) < 256 else 2 if values.max() < 65536 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(packed: pa.Scalar) -> np.ndarray:
    data = packed.as_buffer()
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


ENTRIES = "slice bigint, doc_id array<bigint>, text_key array<bigint>, words binary, train binary, in_docs binary, doc binary, times binary"


def _entries(docs: DataFrame) -> DataFrame:
    """For each slice of texts: its distinct words with their training counts and, word by word, the (document, times) that
    have them. Documents are numbers in their slice.
    """
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())] + [pa.binary()] * 5
    names = [x.split()[0] for x in ENTRIES.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(byte_slices(batches, "text", SLICE)):
            first, tokens = tokens_of(batch.column("text"))
            n = batch.num_rows
            owner = np.repeat(np.arange(n), np.diff(first))
            words, code = np.unique(tokens, return_inverse=True)
            learns = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            train = np.bincount(code[learns[owner]], minlength=len(words))
            pair, times = np.unique(code.astype(np.int64) * n + owner, return_counts=True)
            in_docs = np.bincount(pair // n, minlength=len(words))
            columns = [
                [(part << 32) + number], [batch.column("doc_id").to_pylist()], [text_key(batch.column("text"))], [words.tobytes()],
                *[[_packed(x)] for x in (train, in_docs, pair % n, times)],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return in_batches(docs.select("doc_id", "text", "held_out")).mapInArrow(emit, ENTRIES)


def _homes(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by bucket, the buckets that have any, and where each begins in the order."""
    home = bucket_of(hashes, buckets)
    order = np.argsort(home, kind="stable")
    here, starts = np.unique(home[order], return_index=True)
    return order, here, starts


COUNTED = "slice bigint, bucket int, counts binary, total bigint, distinct bigint, segment binary"


def _counted(entries: DataFrame, buckets: int) -> DataFrame:
    """The counts over all training texts of each slice's words, by bucket; and once for each bucket its totals and its filter
    segment.

    However many documents have a word, its bucket gets it once from each slice.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, train in zip(batch.column("slice").to_pylist(), batch.column("words"), batch.column("train")):
                words, train = np.frombuffer(words.as_buffer(), np.uint64), _unpacked(train)
                order, here, starts = _homes(words, buckets)
                columns = [
                    pa.array(np.full(len(here), name)), pa.array(here.astype(np.int32)),
                    pa.array([words[own].tobytes() for own in np.split(order, starts[1:])], pa.binary()),
                    pa.array([_packed(train[own]) for own in np.split(order, starts[1:])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "bucket", "words", "train"])

    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in COUNTED.split(", ")]

    def count(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["words"]]
        distinct, code = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(code, np.concatenate([_unpacked(x) for x in table["train"]]), minlength=len(distinct)).astype(np.int64)
        edges = np.cumsum([len(x) for x in words])[:-1]
        seen = total > 0
        none = [None] * table.num_rows
        columns = [table["slice"].to_pylist(), table["bucket"].to_pylist(), [total[own].tobytes() for own in np.split(code, edges)], none, none, none]
        own_row = [None, columns[1][0], None, int(total.sum()), int(seen.sum()), LogFilter.segment(distinct[seen], total[seen], BITS_PER_ENTRY)]
        return pa.table([pa.array([*c, x], k) for c, x, k in zip(columns, own_row, kinds)], names=names)

    asked = in_batches(entries.select("slice", "words", "train")).mapInArrow(ask, "slice bigint, bucket int, words binary, train binary")
    return asked.groupBy("bucket").applyInArrow(count, COUNTED)


def _base(entries: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """A row for each document: sum of log10(count + 1) of its tokens, and how many are known."""

    def add(entry: pa.Table, answers: pa.Table) -> pa.Table:
        words = np.frombuffer(entry["words"][0].as_buffer(), np.uint64)
        order, here, starts = _homes(words, buckets)
        total = np.zeros(len(words), np.int64)
        told = {b: np.frombuffer(x.as_buffer(), np.int64) for b, x in zip(answers["bucket"].to_pylist(), answers["counts"])}
        for b, own in zip(here.tolist(), np.split(order, starts[1:])):
            total[own] = told[b]
        in_docs, doc, times = (_unpacked(entry[c][0]) for c in ("in_docs", "doc", "times"))
        which = np.repeat(np.arange(len(words)), in_docs)
        n = len(entry["doc_id"][0])
        logs = np.bincount(doc, times * np.log10(total + 1.0)[which], minlength=n)
        known = np.bincount(doc, times * (total > 0)[which], minlength=n).astype(np.int64)
        return pa.table([entry["doc_id"][0].values, entry["text_key"][0].values, pa.array(logs), pa.array(known)], names=["_id", "_key", "logs", "known"])

    answers = counted.where("total IS NULL").select("slice", "bucket", "counts")
    return entries.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(add, "_id bigint, _key bigint, logs double, known bigint")


def _pair_segments(docs: DataFrame, buckets: int) -> DataFrame:
    """Filter segments of the pairs in training texts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", SLICE):
            pairs, n = np.unique(pairs_of(*tokens_of(batch.column("text"))), return_counts=True)
            first = np.argsort(n > 1, kind="stable")  # in each bucket those seen once come first; they need no count
            pairs, n = pairs[first], n[first]
            order, here, starts = _homes(pairs, buckets)
            rows = [(b, pairs[own].tobytes(), n[own][n[own] > 1].astype(np.uint32).tobytes()) for b, own in zip(here.tolist(), np.split(order, starts[1:]))]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "pairs", "more"])

    def count(table: pa.Table) -> pa.Table:
        hashes, numbers = [], []
        for p, m in zip(table["pairs"], table["more"]):
            hashes.append(np.frombuffer(p.as_buffer(), np.uint64))
            more = np.frombuffer(m.as_buffer(), np.uint32)
            numbers.append(np.append(np.ones(len(hashes[-1]) - len(more), np.uint32), more))
        hashes, numbers = np.concatenate(hashes), np.concatenate(numbers)
        order = np.argsort(hashes)
        hashes, numbers = hashes[order], numbers[order]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        total = np.add.reduceat(numbers, starts, dtype=np.int64)
        segment = LogFilter.segment(hashes[starts], total, BITS_PER_ENTRY)
        return pa.table([pa.array([table["bucket"][0].as_py()], pa.int32()), pa.array([segment], pa.binary())], names=["bucket", "segment"])

    rows = in_batches(docs.where("NOT held_out").select("text")).mapInArrow(emit, "bucket int, pairs binary, more binary")
    return rows.groupBy("bucket").applyInArrow(count, "bucket int, segment binary")


def _filter(segments: DataFrame, buckets: int) -> LogFilter:
    """The filter of all segments. Only one partition of them is beside it in the driver's memory at a time."""
    sizes = {r["bucket"]: r["n"] for r in segments.select("bucket", F.octet_length("segment").alias("n")).collect()}  # a number for each bucket
    start = np.append(0, np.cumsum([sizes.get(b, 8) for b in range(buckets)]))
    bits = np.zeros(start[-1], np.uint8)
    for r in segments.toLocalIterator():
        at = start[r["bucket"]]
        bits[at : at + len(r["segment"])] = np.frombuffer(r["segment"], np.uint8)
    return LogFilter(bits, start)


#: From distinct n-grams to their levels.
Levels = Callable[[np.ndarray], np.ndarray]
SCORED = "doc_id bigint, text_key bigint, held_out boolean, n_tokens bigint, score double"
NAMES = [x.split()[0] for x in SCORED.split(", ")]


def _scored(batch: pa.RecordBatch | pa.Table, word_levels: Levels, pair_levels: Levels, n: int, v: int) -> list[pa.Array]:
    """The columns of ``SCORED`` for some texts, given the levels of distinct words and pairs."""
    texts = batch.column("text")
    first, tokens = tokens_of(texts)
    distinct, code = np.unique(tokens, return_inverse=True)
    count = _count(word_levels(distinct))
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[first[:-1]] = np.searchsorted(distinct, np.uint64(END))
    pair, pair_code = np.unique(pairs_of(first, tokens), return_inverse=True)
    pair_count = _count(pair_levels(pair))[pair_code]
    history = np.maximum(count[before], pair_count)
    single = (count[code] + 1) / (n + v + 1)
    weight = PAIR_WEIGHT * history / (history + HALF_COUNT)
    value = np.log10(weight * pair_count / np.maximum(history, 1) + (1 - weight) * single)
    sums = pa.array(np.add.reduceat(value, first[:-1]))
    return [batch.column("doc_id"), pa.array(text_key(texts)), batch.column("held_out"), pa.array(np.diff(first)), sums]


def _scores_by_broadcast(docs: DataFrame, words: DataFrame, pairs: DataFrame, buckets: int, n: int, v: int) -> DataFrame:
    spark = docs.sparkSession.sparkContext
    # One by one, and each is written to a file of blocks: the driver keeps no more than one of them.
    sent = []
    for segments in (words, pairs):
        whole = _filter(segments, buckets)
        sent.append(spark.broadcast((whole.bits, whole.start)))
        del whole

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_filter, pair_filter = (LogFilter(*x.value) for x in sent)
        for batch in byte_slices(batches, "text", SLICE // 2):
            yield pa.RecordBatch.from_arrays(_scored(batch, word_filter.levels, pair_filter.levels, n, v), names=NAMES)

    return in_batches(docs).mapInArrow(score, SCORED)


def _scores_by_segment(docs: DataFrame, words: DataFrame, pairs: DataFrame, buckets: int, n: int, v: int) -> DataFrame:
    """The same scores with no filter in one place: a task holds one segment, or one slice of texts and its levels."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(byte_slices(batches, "text", SLICE // 2)):
            names = pa.array(np.full(batch.num_rows, (part << 32) + number))
            yield pa.RecordBatch.from_arrays([names, *(batch.column(c) for c in ("doc_id", "text", "held_out"))], names=["slice", "doc_id", "text", "held_out"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", SLICE // 2):
            names = batch.column("slice").to_numpy()
            edges = np.flatnonzero(np.append(True, names[1:] != names[:-1])).tolist() + [len(names)]
            for begin, end in zip(edges[:-1], edges[1:]):
                first, tokens = tokens_of(batch.column("text").slice(begin, end - begin))
                rows = []
                for kind, grams in enumerate((np.unique(tokens), np.unique(pairs_of(first, tokens)))):
                    order, here, starts = _homes(grams, buckets)
                    rows += [(names[begin], kind, b, own.tobytes()) for b, own in zip(here, np.split(grams[order], starts[1:]))]
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "kind", "bucket", "grams"])

    def answer(asked: pa.Table, segment: pa.Table) -> pa.Table:
        bits = np.frombuffer(segment["segment"][0].as_buffer() if segment.num_rows else bytes(8), np.uint8)
        filter_ = LogFilter(bits, np.array([0, len(bits)]))
        levels = [filter_.levels(np.frombuffer(x.as_buffer(), np.uint64)).astype(np.uint8).tobytes() for x in asked["grams"]]
        return pa.table([asked["slice"], asked["kind"], asked["grams"], pa.array(levels, pa.binary())], names=["slice", "kind", "grams", "levels"])

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = answers["kind"].to_numpy()

        def told(kind: int) -> Levels:
            own = answers.filter(pa.array(kinds == kind))
            grams = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in own["grams"]])
            levels = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in own["levels"]])
            grams, once = np.unique(grams, return_index=True)
            return lambda hashes: levels[once][np.searchsorted(grams, hashes)].astype(np.int64)

        return pa.table(_scored(texts, told(0), told(1), n, v), names=NAMES)

    slices = stored(in_batches(docs).mapInArrow(cut, "slice bigint, doc_id bigint, text string, held_out boolean"), "slices")
    asked = in_batches(slices.select("slice", "text")).mapInArrow(ask, "slice bigint, kind int, bucket int, grams binary")
    segments = words.withColumn("kind", F.lit(0)).unionByName(pairs.withColumn("kind", F.lit(1)))
    answers = asked.groupBy("kind", "bucket").cogroup(segments.groupBy("kind", "bucket")).applyInArrow(answer, "slice bigint, kind int, grams binary, levels binary")
    return slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(score, SCORED)


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id bigint, text, held_out boolean); rows with ``held_out`` teach nothing.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, both sums of log10. Each text is a
    sequence of words and an end; a null or empty text is the end alone. A null doc_id is a value like any other, and
    repeated rows are scored each. Without training texts every token is unknown. Other columns are not looked at.

    The filter has ``BITS_PER_ENTRY`` bits for each level of each n-gram, however many there are.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-volume // BUCKET_TEXT))
    entries = stored(_entries(docs), "word-entries")
    counted = stored(_counted(entries, buckets), "word-counts")
    whole = counted.where("total IS NOT NULL")
    totals = whole.agg(F.sum("total"), F.sum("distinct")).first()
    n, v = totals[0] or 0, totals[1] or 0
    words, pairs = whole.select("bucket", "segment"), stored(_pair_segments(docs, buckets), "pair-segments")
    held = words.unionByName(pairs).agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    # What is collected and broadcast are model parameters of counted size, not rows of documents.
    scores = _scores_by_broadcast if held <= MOST_FILTER_BYTES else _scores_by_segment
    scored = scores(docs, words, pairs, buckets, n, v)
    # Rows that were repeated have equal sums; one is enough.
    base = _base(entries, counted, buckets).groupBy("_id", "_key").agg(F.min("logs").alias("logs"), F.min("known").alias("known"))
    joined = scored.join(base, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    return joined.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"), "score",
    )


def _count(level: np.ndarray) -> np.ndarray:
    """The mean count of a level, if counts fall off with their square: 1, 2.3, 5, then near 1.4 times the range's begin."""
    means = np.array([0.0, 1.0] + [_mean(2.0 ** (q - 1)) for q in range(2, MOST_LEVEL + 1)])
    return means[level]


def _mean(begin: float) -> float:
    if begin > 64:
        return begin * 2 * np.log(2)
    c = np.arange(begin, 2 * begin)
    return float((1 / c).sum() / (1 / c**2).sum())
