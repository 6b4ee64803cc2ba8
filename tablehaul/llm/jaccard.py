"""N-gram Jaccard join by prefix trees.

Every text becomes its set of word shingles; equal sets are one node. Shingles have one global order: first those of a
fixed part of the hash space by the number of nodes that have them, rarest first, then the others by hash. Two sets that
reach the similarity share one of the first shingles of both (prefix filter), so nodes that share one fall into a
block. Within a block the ordered sets are stored in a trie; all probes walk it together, share the overlaps of common
beginnings, and leave a subtree as soon as the lengths that remain can't make up for the shingles missed.

Links inside a block are counted for each node, and those that join different groups are given on, so the output grows
with the nodes, not with pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.components import connected, join_counted, rows_by_key, stored, text_key
from tablehaul.llm.frames import in_batches
from tablehaul.llm.textarrays import byte_slices, distinct_by_text, mixed, windows, words_of

#: Bytes of entries in a bucket, and shingles of the sets in a tile.
BUCKET_BYTES = 12 << 20
TILE_SHINGLES = 1_000_000
#: A shingle that so many nodes of a slice of texts have, and this part of them, is dealt by node.
HOT_NODES, HOT_PART = 64, 8
#: The rank of shingles that are ordered by hash.
LAST = np.int64(1) << 62
#: Cells of the membership table of probes and shingles.
TABLE_CELLS = 32 << 20
#: Representatives (a few numbers each) that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``size`` words; linked if 100 * intersection >= ``percent`` * union."""

    size: int = 5
    percent: int = 80

    def least(self, n: np.ndarray | int) -> np.ndarray | int:
        """The smallest intersection of a set of ``n`` with any set it is linked with."""
        return -(-self.percent * n // 100)

    def prefix(self, n: np.ndarray | int) -> np.ndarray | int:
        return n - self.least(n) + 1

    @property
    def part(self) -> float:
        """Part of the hash space whose shingles are ordered by frequency: 2.5 prefixes long."""
        return min(1.0, 2.5 * (100 - self.percent) / 100)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one."""
    words = words_of(texts)
    values, at = windows(words.hash, words.first, size)
    sets = distinct_by_text(values, np.searchsorted(at, words.first))
    counts = np.diff(words.first)
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        own = words.hash[words.first[t] : words.first[t + 1]]
        whole, _ = windows(own, np.array([0, len(own)]), len(own))
        sets[t] = mixed(whole ^ np.uint64(len(own)))
    return sets


def signature(shingles: np.ndarray) -> int:
    """A 63-bit name of a set; -1 of the empty one."""
    if not len(shingles):
        return -1
    places = np.arange(1, len(shingles) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    value = mixed(shingles ^ mixed(places)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([value]))[0] >> np.uint64(1))


def _hot(tokens: np.ndarray, nodes: int) -> np.ndarray:
    """Shingles that many of a slice's nodes have; sorted."""
    found, times = np.unique(tokens, return_counts=True)
    return found[(times >= HOT_NODES) & (times * HOT_PART >= nodes)]


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with keys, and which."""
    home = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    here, starts = np.unique(home[order], return_index=True)
    return zip(here.tolist(), np.split(order, starts[1:]))


ENTRY_FIELDS = "kind int, doc_id bigint, text_key bigint, sig bigint, n bigint, emitted bigint, token bigint, rank bigint"


def _entries(docs: DataFrame, rule: Similarity, buckets: int) -> DataFrame:
    """Rows of kind 0: the set of each document. Rows of kind 1: shingles in frequency order that several nodes have. Rows of
    kind 2: for shingles whose nodes are dealt to several buckets, how many one bucket has.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(byte_slices(batches, "text")):
            sets = shingle_sets(batch.column("text"), rule.size)
            sig = np.fromiter(map(signature, sets), np.int64, len(sets))
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            _, once = np.unique(sig, return_index=True)
            once = once[size[once] > 0]
            limit = np.uint64(int(rule.part * (2**64 - 2**12)))
            taken = [max(int(np.searchsorted(sets[i], limit, side="right")), int(rule.prefix(size[i]))) for i in once]
            tokens = np.concatenate([sets[i][:k] for i, k in zip(once, taken)]) if len(once) else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(once), dtype=np.int32), taken)
            numbers = np.stack([size[once], np.array(taken, np.int64)]).astype(np.uint32)
            shift = (int(sig[0]) + number) % buckets if len(sig) else 0
            documents = [batch.column(c).to_pylist() for c in ("doc_id", "text_key")] + [sig.tolist(), size.tolist()]
            rows = [(shift, False, [dict(zip(("doc_id", "text_key", "sig", "n"), d)) for d in zip(*documents)], b"", b"", b"")]
            hot = _hot(tokens, len(once))
            spread = np.isin(tokens, hot) if len(hot) else np.zeros(len(tokens), bool)
            for apart in (False, True):
                chosen = np.flatnonzero(spread == apart)
                # The shingles of many nodes are dealt by node too; their own bucket hears of them.
                keys = mixed(tokens[chosen]) + (mixed(sig[once][owner[chosen]].view(np.uint64)) if apart else np.uint64(0))
                for b, own in _by_bucket(keys, buckets):
                    own = chosen[own]
                    held, local = np.unique(owner[own], return_inverse=True)  # a bucket gets the nodes it has shingles of
                    nodes = sig[once][held].tobytes() + numbers[:, held].tobytes()
                    rows.append((b, apart, [], tokens[own].tobytes(), local.astype(np.int32).tobytes(), nodes))
            rows += [(b, True, [], hot[own].tobytes(), b"", b"") for b, own in _by_bucket(mixed(hot.copy()), buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shipped)], schema=shipped)

    shipped = pa.schema([
        ("bucket", pa.int32()), ("apart", pa.bool_()), ("docs", pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_id", "text_key", "sig", "n")]))),
        ("tokens", pa.binary()), ("owner", pa.binary()), ("nodes", pa.binary()),
    ])
    names = [x.split()[0] for x in ENTRY_FIELDS.split(", ")]

    def count(table: pa.Table) -> pa.Table:
        docs_of = [d for row in table["docs"].to_pylist() for d in row]
        kind0 = [
            np.zeros(len(docs_of), np.int32), *[pa.array([d[c] for d in docs_of], pa.int64()) for c in ("doc_id", "text_key", "sig", "n")],
            *[pa.nulls(len(docs_of), pa.int64())] * 3,
        ]
        tokens, sigs, small, told = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.uint32)], [np.zeros(0, np.uint64)]
        for t, o, n, apart in zip(table["tokens"], table["owner"], table["nodes"], table["apart"].to_pylist()):
            t, o, n = (np.frombuffer(x.as_buffer(), np.uint8) for x in (t, o, n))
            if apart:
                told.append(np.unique(t.view(np.uint64)))
            if len(n):
                held, owner = len(n) // 16 * 8, o.view(np.int32)
                tokens.append(t.view(np.uint64))
                sigs.append(n[:held].view(np.int64)[owner])
                small.append(n[held:].view(np.uint32).reshape(2, -1)[:, owner])
        token, sig = np.concatenate(tokens), np.concatenate(sigs)
        order = np.lexsort((sig, token))
        token, sig = token[order], sig[order]
        n, taken = np.concatenate(small, axis=1)[:, order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1]) | (n[1:] != n[:-1])
        token, sig, n, taken = token[new], sig[new], n[new], taken[new]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        times = np.diff(np.append(starts, len(token)))
        # A shingle that is dealt apart has nodes in other buckets too: it is given on with its part of the count.
        split = np.isin(token[starts], np.concatenate(told))
        shared = np.repeat((times > 1) | split, times)
        early = token[shared] <= np.uint64(int(rule.part * (2**64 - 2**12)))
        rank = np.where(early, np.repeat(times, times)[shared], LAST)
        none = pa.nulls(int(shared.sum()), pa.int64())
        kind1 = [
            np.ones(int(shared.sum()), np.int32), none, none, sig[shared], n[shared].astype(np.int64), taken[shared].astype(np.int64),
            token[shared].view(np.int64), rank,
        ]
        none = pa.nulls(int(split.sum()), pa.int64())
        kind2 = [np.full(int(split.sum()), 2, np.int32), *[none] * 5, token[starts][split].view(np.int64), times[split].astype(np.int64)]
        return pa.table([pa.chunked_array([pa.array(x) for x in columns]) for columns in zip(kind0, kind1, kind2)], names=names)

    sent = in_batches(docs.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")).mapInArrow(
        emit, "bucket int, apart boolean, docs array<struct<doc_id:bigint,text_key:bigint,sig:bigint,n:bigint>>, tokens binary, owner binary, nodes binary"
    )
    return sent.groupBy("bucket").applyInArrow(count, ENTRY_FIELDS)


def trie_links(
    sets: list[np.ndarray], sizes: np.ndarray, probes: np.ndarray, stored_sets: np.ndarray, rule: Similarity, copies: np.ndarray | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between probes and stored sets (indexes into ``sets``), as many as join different groups; and for each set the
    number of all sets that it is linked with, each counted as many times as it has ``copies``.

    Probes and stored sets are the same sets, or have none in common.

    Shingles that only one of the sets has can't be in an overlap; the trie leaves them out, the sizes count them. The
    trie's order is by frequency, so that common beginnings are long. Each stored set adds a branch where it leaves
    the set before it; ``overlap[d]`` holds the overlaps of all probes with the first d shingles of the branch at hand.
    """
    copies = np.ones(len(sets), np.int64) if copies is None else copies
    counts = np.zeros(len(sets), np.int64)
    if not len(probes) or not len(stored_sets):
        return [], counts
    both_sides = probes[0] != stored_sets[0]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1
    rank_of = np.full(len(count), -1, np.int64)
    by = np.argsort(-count[common], kind="stable")
    rank_of[np.flatnonzero(common)[by]] = np.arange(len(by))
    rank = rank_of[code]
    keep = rank >= 0
    rank, owner = rank[keep], owner[keep]
    order = np.lexsort((rank, owner))
    rank, owner = rank[order], owner[order]
    edges = np.searchsorted(owner, np.arange(len(sets) + 1))
    paths = [rank[a:b] for a, b in zip(edges[:-1], edges[1:])]
    width = len(by)

    by_path = sorted(stored_sets.tolist(), key=lambda i: paths[i].astype(">u4").tobytes())
    shared = [0] * len(by_path)
    for k in range(1, len(by_path)):
        a, b = paths[by_path[k - 1]], paths[by_path[k]]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        shared[k] = int(differ[0]) if len(differ) else n
    # For each branch: where its subtree ends, the longest path and the smallest set in it.
    ends, longest, smallest = [0] * len(by_path), [len(paths[i]) for i in by_path], [int(sizes[i]) for i in by_path]
    stack: list[int] = []
    for k in range(len(by_path) + 1):
        while stack and (k == len(by_path) or shared[k] <= shared[stack[-1]]):
            done = stack.pop()
            ends[done] = k
            if stack:
                longest[stack[-1]] = max(longest[stack[-1]], longest[done])
                smallest[stack[-1]] = min(smallest[stack[-1]], smallest[done])
        if k < len(by_path):
            stack.append(k)

    group = np.arange(len(sets))
    links: list[tuple[int, int]] = []
    deepest = max((len(paths[i]) for i in by_path), default=0)
    step = max(1, min(len(probes), TABLE_CELLS // max(1, width), TABLE_CELLS // max(1, deepest + 1)))
    for begin in range(0, len(probes), step):
        asked = probes[begin : begin + step]
        has = np.zeros((width, len(asked)), bool)
        for column, i in enumerate(asked):
            has[paths[i], column] = True
        n = sizes[asked]
        length = np.array([len(paths[i]) for i in asked])
        least = rule.least(n)
        overlap = np.zeros((deepest + 1, len(asked)), np.int32)
        k = 0
        while k < len(by_path):
            i, depth = by_path[k], shared[k]
            # What the subtree can still give: the shingles left on its longest path, and those left of the probe.
            rest = np.minimum(longest[k] - depth, length - overlap[depth])
            possible = overlap[depth] + rest >= np.maximum(least, rule.least(smallest[k]))
            if not possible.any():
                k = ends[k]
                continue
            path = paths[i]
            if len(path) > depth:
                overlap[depth + 1 : len(path) + 1] = overlap[depth] + np.cumsum(has[path[depth:]], axis=0, dtype=np.int32)
            same = overlap[len(path)]
            linked = asked[(100 * same.astype(np.int64) >= rule.percent * (n + sizes[i] - same)) & (asked != i)]
            counts[linked] += copies[i]
            if both_sides:
                counts[i] += copies[linked].sum()
            for x in linked[group[linked] != group[i]]:
                if group[x] != group[i]:
                    links.append((int(x), int(i)))
                    group[group == max(group[x], group[i])] = min(group[x], group[i])
            k += 1
    return links, counts


def _links(docs: DataFrame, tiles: DataFrame, rule: Similarity) -> DataFrame:
    """Links (a, b) of nodes, found tile by tile, and with a null ``b`` how many rows of other nodes a node is linked with in a
    tile. ``tiles``: doc_id, text_key, sig, n, copies, block, a, b, part."""
    n_tiles = tiles.count()
    known = F.broadcast(tiles) if n_tiles <= BROADCAST_ROWS else tiles
    known = known.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(known, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key")))
    texts = texts.drop("_id", "_key", "doc_id")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), rule.size)
            wanted = batch.column("sig").to_pylist()
            right = pa.array([signature(x) == s for x, s in zip(sets, wanted)])
            column = pa.array([x.tobytes() for x in sets], pa.binary())
            names = ["sig", "copies", "block", "a", "b", "part"]
            out = pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [column], names=[*names, "shingles"])
            yield out.filter(right)

    def join(table: pa.Table) -> pa.Table:
        sig, once = np.unique(table["sig"].to_numpy(), return_index=True)  # rows that were repeated
        table = table.take(pa.array(once))
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets], np.int64)
        part = table["part"].to_numpy()
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        found, counts = trie_links(sets, sizes, np.flatnonzero(part == a), np.flatnonzero(part == b), rule, table["copies"].to_numpy())
        some, (x, y) = np.flatnonzero(counts), np.array(found, np.int64).reshape(-1, 2).T
        columns = [np.append(sig[x], sig[some]), pa.chunked_array([pa.array(sig[y]), pa.nulls(len(some), pa.int64())]), np.append(np.zeros(len(x), np.int64), counts[some])]
        return pa.table(columns, names=["a", "b", "links"])

    sets = in_batches(texts).mapInArrow(sets_of, "sig bigint, copies bigint, block bigint, a int, b int, part int, shingles binary")
    return sets.groupBy("block", "a", "b").applyInArrow(join, "a bigint, b bigint, links bigint")


def _named(docs: DataFrame, rule: Similarity) -> DataFrame:
    """A written row for each row of ``docs``: doc_id, text_key, n, the label of its component (null without shingles), n_links."""
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(volume / 6 * rule.part * 12 / BUCKET_BYTES) + 1)
    entries = stored(_entries(docs, rule, buckets), "shingles")
    sets = entries.where("kind = 0").select("doc_id", "text_key", "sig", "n")
    ranked = _ranked(entries)

    # The prefix of a node: shingles that only it has come first in the order; they share nothing, but take their places.
    held = ranked.groupBy("sig", "n", "emitted").agg(F.sort_array(F.collect_set(F.struct("rank", "token"))).alias("own"))
    places = F.expr(f"CAST(n - ({rule.percent} * n + 99) div 100 + 1 - (emitted - size(own)) AS int)")
    prefix = held.select("sig", "n", F.explode(F.slice("own", F.lit(1), F.greatest(places, F.lit(0)))).alias("x"))
    keyed = prefix.select("sig", "n", F.col("x.token").alias("token"))
    keyed = stored(keyed, "prefixes")
    heads = keyed.groupBy("token").agg(F.min("sig").alias("head"), F.count("*").alias("nodes")).where("nodes > 1")
    heads = stored(heads, "heads")
    total = keyed.count()
    edges = join_counted(keyed, heads, "token", "nodes", total).select(F.col("sig").alias("a"), F.col("head").alias("b"))
    blocks = stored(connected(edges), "blocks")

    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    nodes = stored(sets.where("n > 0").groupBy("sig", "n").agg(first, F.count("*").alias("copies")), "nodes")
    nodes = nodes.select("sig", "n", "first.*", "copies")
    placed = nodes.join(blocks.select(F.col("node").alias("sig"), F.col("label").alias("block")), "sig")
    placed = stored(placed, "placed")
    mass = placed.groupBy("block").agg(F.sum("n").alias("mass"), F.count("*").alias("members"))
    mass = stored(mass.where("members > 1"), "mass")
    parts = F.ceil(F.col("mass") / TILE_SHINGLES).cast("int")
    cut = join_counted(placed, mass, "block", "members", placed.count()).withColumn("parts", parts)
    cut = cut.withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = stored(cut.select(
        "doc_id", "text_key", "sig", "n", "copies", "block", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part"
    ), "tiles")

    links = stored(_links(docs, tiles, rule), "links")
    labels = connected(links.where("b IS NOT NULL")).select(F.col("node").alias("sig"), "label")
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("sig")).agg(F.sum("links").alias("links"))
    known = stored(nodes.select("sig", "copies").join(labels, "sig", "left").join(counts, "sig", "left").select(
        "sig", "copies", F.coalesce("label", "sig").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ), "known-nodes")
    named = join_counted(sets.where("n > 0"), known, "sig", "copies", sets.count())
    none = sets.where("n = 0").select("doc_id", "text_key", "n", F.lit(None).cast("bigint").alias("label"), F.lit(0).cast("bigint").alias("n_links"))
    return stored(named.select("doc_id", "text_key", "n", "label", "n_links").unionByName(none), "named")


def _ranked(entries: DataFrame) -> DataFrame:
    """Shingles of nodes with their rank; of those dealt to several buckets the counts are added up."""
    rows = entries.where("kind = 1").select("sig", "n", "emitted", "token", "rank")
    split = stored(entries.where("kind = 2").groupBy("token").agg(F.sum("rank").alias("whole")), "split-shingles")
    few = split.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(split) if few else split, "token", "left")
    whole = F.when(F.col("rank") < int(LAST), F.col("whole"))
    return joined.withColumn("rank", F.coalesce(whole, "rank")).drop("whole")


def jaccard_groups(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and n_links.

    component_id is the smallest doc_id that is reachable by links, n_links the number of other rows that the row is linked
    with itself. A text that is null, empty or without a word has no shingle and is linked with nothing: its component is
    its own doc_id. Rows with equal sets are linked, however many there are. A null doc_id stays null and is never the
    smallest, unless all of a component's are null. Rows with the same doc_id are rows of their own. Very long texts are one
    set like others. Other columns are not looked at. An empty table gives no row.
    """
    named = _named(docs, rule)
    smallest = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    smallest = stored(smallest, "smallest")
    linked = join_counted(named.where("label IS NOT NULL"), smallest, "label", "rows", named.count())
    out = linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    return out.unionByName(named.where("label IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "n_links"))


def one_of_each_group(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` without those linked, directly or not, with a row of smaller (doc_id, hash of the text), a null id last.

    Of repeated rows one stays, with any one's other columns. Rows without a shingle stay.
    """
    named = _named(docs, rule).where("label IS NOT NULL").select("doc_id", "text_key", "label")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    heads = stored(named.groupBy("label").agg(F.min(row).alias("head"), F.count("*").alias("rows")), "heads-of-groups")
    judged = join_counted(named, heads, "label", "rows", named.count())
    judged = stored(judged.select("doc_id", "text_key", row.eqNullSafe(F.col("head")).alias("stays"), "rows"), "judged")
    kept = rows_by_key(docs, judged.where("NOT stays"), inside=False)
    # Repeated rows have one place in the order.
    again = stored(judged.where("stays AND rows > 1").groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "repeated-rows")
    whole = F.struct(*[F.col(c) for c in docs.columns])
    one = rows_by_key(kept, again, inside=True).groupBy("doc_id", text_key().alias("repeated text")).agg(F.any_value(whole).alias("row"))
    return rows_by_key(kept, again, inside=False).unionByName(one.select("row.*"))
