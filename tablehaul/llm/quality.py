"""Quality rules: gradient-boosted trees over document statistics, scored as flat numpy arrays.

The trees are fitted on the driver to a bounded sample of labelled rows (``Trees.fit``); statistics and scores are made
for every whole text inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.frames import batch_with, in_batches, sampled, schema_with
from tablehaul.llm.textarrays import SLICE_BYTES, SPACES, byte_slices, byte_table, flat, runs, slice_hashes, sums, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
#: Features and the sign that the quality must follow as they rise: -1 falls, 0 free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "duplicate_lines": -1, "repeated_words": -1,
    "upper_case": -1, "digits": 0, "points": 0, "exclamations": -1, "wide_letters": 0, "words_per_line": 0,
    "distinct_words": 0,
}
#: Labelled rows that the trees are fitted to.
SAMPLE_ROWS = 20_000
#: A document goes if its probability of good quality is lower.
LEAST_QUALITY = 0.5
#: Bytes of text at once: its statistics take some 40 times as much memory.
AT_ONCE = SLICE_BYTES // 2


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and the features, a row for each text."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    first, start, end = runs(data, offsets, ~byte_table(SPACES)[data])
    words = slice_hashes(data, start, end)
    n_words = np.diff(first)

    def counted(members: np.ndarray) -> np.ndarray:
        return sums(members, offsets)

    solid = ~byte_table(SPACES)[data]
    word_chars = counted(solid & ((data & 0xC0) != 0x80))
    symbols = counted(byte_table(SYMBOLS)[data])

    line_first, line_start, line_end = runs(data, offsets, data != 10)
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(solid)])
    worded = before[line_end] > before[line_start]
    line_owner = np.repeat(np.arange(n), np.diff(line_first))[worded]
    lines = slice_hashes(data, line_start[worded], line_end[worded])
    n_lines = np.bincount(line_owner, minlength=n)
    distinct_lines = _distinct(lines, line_owner, n)

    value, at = windows(words, first, WINDOW)
    repeated = np.zeros(len(words) + 1, np.int64)
    again = at[_repeated(value, np.searchsorted(at, first))]
    np.add.at(repeated, again, 1)
    np.add.at(repeated, again + WINDOW, -1)
    n_repeat = sums(np.cumsum(repeated[:-1]) > 0, first)

    per_word = np.maximum(n_words, 1)
    per_char = np.maximum(word_chars, 1)
    features = np.stack([
        np.log1p(n_words),
        word_chars / per_word,
        symbols / per_word,
        (n_lines - distinct_lines) / np.maximum(n_lines, 1),
        n_repeat / per_word,
        counted(byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")[data]) / per_char,
        counted(byte_table(b"0123456789")[data]) / per_char,
        counted(byte_table(b".,;:?")[data]) / per_word,
        counted(data == ord("!")) / per_word,
        counted(data >= 0xC0) / per_char,
        n_words / np.maximum(n_lines, 1),
        _distinct(words, np.repeat(np.arange(n), n_words), n) / per_word,
    ], axis=1)
    counts = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": n_lines - distinct_lines,
        "n_repeat_words": n_repeat,
    }
    return {k: v.astype(np.int64) for k, v in counts.items()}, features


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each owner; owners rise."""
    first = np.searchsorted(owner, np.arange(n + 1))
    out = np.zeros(n, np.int64)
    for i, (begin, stop) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if stop > begin:
            own = np.sort(values[begin:stop])
            out[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    return out


def _repeated(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions of the values that their text has twice or more."""
    out = [np.zeros(0, np.int64)]
    for begin, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - begin > 1:
            own = values[begin:stop]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            if same.any():
                out.append(begin + order[np.append(same, False) | np.append(False, same)])
    return np.concatenate(out)


@dataclass
class Trees:
    """Boosted trees as node arrays: a leaf has feature -1; ``roots`` holds the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                goes_left = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(f < 0, node, np.where(goes_left, self.left[node], self.right[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-total))

    @classmethod
    def fit(
        cls, x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 32, least: float = 5.0,
    ) -> Trees:
        """Second-order boosting of the log loss over quantile bins; ``signs`` are the monotonic constraints.

        A split on a constrained feature must order its children's values, and the values below it stay on their
        side of the middle of the two.
        """
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        coded = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        start = float(np.log(share / (1 - share)))
        score = np.full(len(y), start)
        nodes: list[list] = []  # feature, threshold, left, right, value
        roots = []

        def grow(rows: np.ndarray, left_depth: int, low: float, high: float) -> int:
            g, h = gradient[rows], hessian[rows]
            me = len(nodes)
            nodes.append([-1, 0.0, me, me, rate * float(np.clip(-g.sum() / (h.sum() + 1), low, high))])
            if not left_depth or len(rows) < 2 * least:
                return me
            best = (1e-6, None)
            whole = g.sum() ** 2 / (h.sum() + 1)
            for f, sign in enumerate(signs):
                if not len(edges[f]):
                    continue
                width = len(edges[f]) + 1
                gl = np.cumsum(np.bincount(coded[rows, f], g, width))[:-1]
                hl = np.cumsum(np.bincount(coded[rows, f], h, width))[:-1]
                nl = np.cumsum(np.bincount(coded[rows, f], minlength=width))[:-1]
                gr, hr = g.sum() - gl, h.sum() - hl
                vl, vr = np.clip(-gl / (hl + 1), low, high), np.clip(-gr / (hr + 1), low, high)
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - whole
                gain[(nl < least) | (len(rows) - nl < least) | (sign * (vr - vl) < 0)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, (vl[k] + vr[k]) / 2, sign))
            if best[1] is None:
                return me
            f, k, middle, sign = best[1]
            on_left = coded[rows, f] <= k
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[sign]
            nodes[me][:2] = [f, float(edges[f][k])]
            nodes[me][2] = grow(rows[on_left], left_depth - 1, *bounds[0])
            nodes[me][3] = grow(rows[~on_left], left_depth - 1, *bounds[1])
            return me

        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), depth, -np.inf, np.inf))
            model = cls._of(nodes[roots[-1] :], roots[-1:], 0.0, depth)
            score += np.log(np.maximum(q := model.probability(x), 1e-12) / np.maximum(1 - q, 1e-12))
        return cls._of(nodes, roots, start, depth)

    @classmethod
    def _of(cls, nodes: list[list], roots: list[int], start: float, depth: int) -> Trees:
        shift = roots[0] if roots else 0
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes)) if nodes else [np.zeros(0)] * 5
        return cls(feature.astype(int), threshold, left.astype(int) - shift, right.astype(int) - shift, value, np.array(roots, int) - shift, start, depth)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees for the label ``quality`` (0 or 1), from about ``sample_rows`` labelled documents.

    Labels without a document, null ids and null labels are left out. With no label of one of the kinds there is
    nothing to learn: None.
    """
    good = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int"))
    chosen = sampled(good, "doc_id", good.count(), sample_rows).select("doc_id", "quality")
    # The sample is bounded by sample_rows, so it may be broadcast.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", AT_ONCE):
            _, x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("quality"), pa.array(list(x))], ["doc_id", "y", "x"])

    rows = in_batches(labelled.select("doc_id", "text", "quality")).mapInArrow(measure, "doc_id bigint, y int, x array<double>")
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    y = got["y"].to_numpy(float) > 0
    if not len(y) or y.all() or not y.any():
        return None
    return Trees.fit(np.stack(got["x"].to_list()), y.astype(float), list(FEATURES.values()))


def judge_quality(docs: DataFrame, trees: Trees | None, least_quality: float = LEAST_QUALITY) -> DataFrame:
    """All rows and columns of ``docs`` with the counts, ``base_failed``, ``quality_score`` and ``kept``.

    A null or empty text has no word, so it fails the base rule. Without trees the base rule alone decides and the
    score is null. Columns of ``docs`` with the name of an added one are replaced.
    """
    added = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, quality_score double"
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", AT_ONCE):
            counts, x = statistics(batch.column("text"))
            n, repeated = counts["n_words"], counts["n_repeat_words"]
            failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
            score = trees.probability(x) if trees else None
            kept = ~failed if score is None else ~failed & (score >= least_quality)
            scores = pa.nulls(len(n), pa.float64()) if score is None else pa.array(score)
            columns = {k: pa.array(v) for k, v in counts.items()}
            yield batch_with(batch, columns | {"base_failed": pa.array(failed), "kept": pa.array(kept), "quality_score": scores})

    return in_batches(docs).mapInArrow(judge, schema_with(docs, added))
