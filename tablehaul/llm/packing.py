"""Best-fit packing: token sequences of a fixed length, filled by best-two-fit.

Each document becomes token ids with an end id. Only longer documents are cut. A bin is filled greedily with the
largest piece that fits; if a gap is left, the bin's smallest piece gives way to two pieces that fill the gap more
tightly. Pieces are packed in groups of a bounded number of pieces, dealt by a hash, so no task sees the whole table
and each group leaves one ill-filled sequence at most.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.frames import in_batches
from tablehaul.llm.textarrays import SPACES, byte_slices, byte_table, flat, lower_table, strings

#: Token ids in a sequence.
SEQUENCE = 2048
END_ID = 0
#: Documents whose last pieces are packed together.
GROUP_DOCS = 20_000
BATCH_BYTES = 2 << 20
UNITS_PER_STRING = 100
#: Units that a Python worker remembers, about 50 bytes each, and the bytes of the longest that it does. They are copied for
#: each batch, and the worker, which goes on to other stages, keeps them.
UNITS_KEPT = 200_000
LONGEST_KEPT = 64


@cache
def encoder(path: str):
    """The tokenizer, and for each id whether it ends a unit."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[i for word, i in tokenizer.get_vocab().items() if word.endswith("</w>")]] = True
    return tokenizer, ends


def worker_memory(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    home = sys.modules.setdefault("tablehaul_worker_memory", types.ModuleType("tablehaul_worker_memory"))
    return vars(home).setdefault(name, {})


def unit_ids(spelled: list[str], path: str) -> list[bytes]:
    """The ids of each unit, as 32-bit numbers.

    Units of letters only are one word each, so many of them are encoded as one string; its ids are cut where a word
    ends. All other units are encoded one by one.
    """
    tokenizer, ends = encoder(path)
    found: dict[str, bytes] = {}
    plain, rest = [], []
    for x in spelled:
        (plain if x.isalpha() and (x.isascii() or x.lower().isalpha()) else rest).append(x)
    for begin in range(0, len(plain), UNITS_PER_STRING):
        part = plain[begin : begin + UNITS_PER_STRING]
        ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
        stops = ((np.flatnonzero(ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(part):  # a letter that the library splits at
            rest += part
            continue
        raw, at = ids.tobytes(), 0
        for x, stop in zip(part, stops):
            found[x] = raw[at:stop]
            at = stop
    for begin in range(0, len(rest), 1000):
        part = rest[begin : begin + 1000]
        for x, encoded in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
            found[x] = np.array(encoded.ids, np.uint32).tobytes()
    return [found[x] for x in spelled]


def coded(units: pa.Array, path: str) -> tuple[np.ndarray, pa.Array]:
    """The number of each unit, and the ids of the unit with each number.

    Units that the worker remembers have the first numbers and are not encoded again. Once it knows too many, the half
    that it met last stays.
    """
    memory = worker_memory(f"units {path}")
    spelled, ids, met = memory.get("units") or (pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int64))
    both = pa.concat_arrays([spelled, units]).dictionary_encode()
    code = both.indices.to_numpy()[len(spelled) :]
    new = both.dictionary[len(spelled) :].to_pylist()
    ids = pa.concat_arrays([ids, pa.array(unit_ids(new, path), pa.large_binary())])
    met = np.append(met, np.zeros(len(new), np.int64))
    memory["batch"] = met[code] = memory.get("batch", 0) + 1
    kept = np.flatnonzero(pc.binary_length(both.dictionary).to_numpy() <= LONGEST_KEPT)
    if len(kept) > UNITS_KEPT:
        kept = np.sort(kept[np.argsort(-met[kept], kind="stable")[: UNITS_KEPT // 2]])
    if len(kept) == len(ids):
        memory["units"] = both.dictionary, ids, met
    else:
        memory["units"] = both.dictionary.take(pa.array(kept)), ids.take(pa.array(kept)), met[kept]
    return code, ids


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the units and where blanks are.

    White space is dropped by the tokenizer and parts words. Punctuation after an ASCII letter begins a word of its own
    too; the signs that special tokens are spelled with are left alone.
    """
    space = byte_table(SPACES)[data]
    letter = byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")[data]
    cut = ~space
    cut[1:] &= space[:-1] | (letter[:-1] & byte_table(b".,!?;:$%&*#()-")[data[1:]])
    own = offsets[:-1][np.diff(offsets) > 0]
    cut[own] = ~space[own]
    return np.flatnonzero(cut), space


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the end id, and their offsets: the same as encoding each text whole."""
    data, offsets = flat(texts)
    starts, space = units_of(data, offsets)
    solid = data[~space]
    edges = np.append(np.cumsum(~space, dtype=np.int32 if len(data) < 2**31 else np.int64)[starts] - 1, len(solid))
    if len(solid) < 2 or not ((solid[:-1] == ord("<")) & (solid[1:] == ord("|"))).any():
        solid = lower_table()[solid]  # else lower case could spell a special token
    code, ids = coded(strings(solid, edges), path)
    ids = pa.concat_arrays([ids, pa.array([np.array([END_ID], np.uint32).tobytes()], pa.large_binary())])
    ends = np.searchsorted(starts, offsets[1:])
    out = ids.take(pa.array(np.insert(code, ends, len(ids) - 1)))
    if not len(out):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    place = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1) // 4
    return np.frombuffer(out.buffers()[2], np.uint32, place[-1]), np.append(0, place[ends + np.arange(len(ends)) + 1])


def pieces(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length and ids_crc32, or the ids themselves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            ids, offsets = token_ids(batch.column("text"), tokenizer)
            sizes = np.diff(offsets)
            number = -(-sizes // length)
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * length
            begin = offsets[owner] + start
            size = np.minimum(sizes[owner] - start, length)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(owner)), "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start), "length": pa.array(size),
            }
            if with_ids:
                columns["ids"] = pa.array([ids[b : b + s].astype(np.int64) for b, s in zip(begin, size)], pa.list_(pa.int64()))
            else:
                raw = ids.astype("<u4", copy=False)
                columns["ids_crc32"] = pa.array([zlib.crc32(raw[b : b + s]) for b, s in zip(begin.tolist(), size.tolist())], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = dict(docs.dtypes)["doc_id"]
    last = "ids array<bigint>" if with_ids else "ids_crc32 bigint"
    return in_batches(docs.select("doc_id", "text")).mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, {last}")


def best_two_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item of ``sizes`` (1 to ``room``). Works on how many items there are of each size."""
    order = np.argsort(sizes, kind="stable")
    left = np.bincount(sizes, minlength=room + 1)
    taken = np.concatenate([[0], np.cumsum(left)[:-1]])  # where the next item of each size stands in the order
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    values = np.arange(room + 1)
    fits = np.maximum.accumulate(np.where(left > 0, values, 0))  # largest size there is up to each size

    def take(size: int, times: int = 1) -> None:
        nonlocal fits
        left[size] -= times
        if left[size] <= 0:
            fits = np.maximum.accumulate(np.where(left > 0, values, 0))

    bins = 0
    rest = len(sizes)
    while rest:
        content: list[int] = []
        gap = room
        while gap and fits[gap]:
            content.append(int(fits[gap]))
            gap -= content[-1]
            take(content[-1])
        if gap and len(content) > 1 and rest > len(content):
            smallest = content[-1]
            space = gap + smallest
            one = np.flatnonzero(left[: space + 1])
            other = fits[space - one]
            # the same size twice needs two items of it
            lone = (other == one) & (left[one] < 2)
            other[lone] = fits[one[lone] - 1]
            other[other > space - one] = 0
            total = np.where(other > 0, one + other, 0)
            if len(total) and total.max() > smallest:
                k = int(np.argmax(total))
                pair = [int(one[k]), int(other[k])]
                content[-1:] = pair
                left[smallest] += 1
                for size in pair:
                    take(size)
                fits = np.maximum.accumulate(np.where(left > 0, values, 0))
        at = 0
        for size in content:
            item = order[taken[size]]
            taken[size] += 1
            bin_of[item], offset[item] = bins, at
            at += size
        rest -= len(content)
        bins += 1
    return bin_of, offset


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = SEQUENCE, with_ids: bool = False, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """A row for each piece with its ``sequence_id`` and its ``offset`` in the sequence.

    A null or empty text is a piece of the end id alone. Repeated rows are packed each for itself. An empty table gives
    no row. Columns other than doc_id and text are not looked at. ``sequence_id`` is unique, not gapless.
    """
    groups = max(1, -(-docs.count() // group_docs))
    cut = pieces(docs, tokenizer, length, with_ids)
    # By the content too: many rows may share a doc_id, or have none.
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", cut.columns[4]), F.lit(groups)))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        by = [(c, "ascending") for c in ("length", "doc_id", "start", table.schema.names[4])]
        table = table.sort_by(by[:3] if with_ids else by)
        bins, offset = best_two_fit(table["length"].to_numpy(), length)
        table = table.append_column("sequence_id", pa.array(key[0].as_py() * (1 << 40) + bins))
        return table.append_column("offset", pa.array(offset)).drop_columns(["group"])

    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes)
    return dealt.groupBy("group").applyInArrow(pack, f"{schema}, sequence_id bigint, offset bigint")
