"""Operators on single rows against brute force: URLs, packing, quality, tokens, shards, languages, scores, leaks."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tablehaul.llm.packing as packing
from tablehaul.llm import quality, queries, spans
from tablehaul.llm.decontaminate import find_leaks, remove_leaks
from tablehaul.llm.language import fit_language, identify_language
from tablehaul.llm.packing import best_two_fit, pack_documents, token_ids
from tablehaul.llm.quality import Trees, fit_quality, judge_quality
from tablehaul.llm.scoring import LogFilter, score_documents
from tablehaul.llm.shards import shard_documents
from tablehaul.llm.textarrays import words_of
from tablehaul.llm.tokens import count_tokens, text_lengths
from tablehaul.llm.urls import Rule, filter_urls, host_rule

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE = queries.tokenizer_file("word_bpe_49k.json")
PIECES = queries.tokenizer_file("piece_bpe_32k.model")
SIGNS = [
    "a", "The", "'s", "'", " ", "  ", "\n", "é", "É", "\t", "é", "<s>", "<|endoftext|>", "日本", "\x00", "1", "thing", ".", ",", "!", "?",
    "　", " ", "▁", "\U0001f600", "\r", "İ", "Σ", "ς", "ŉ", "|", "<", "$$",
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def random_texts(seed, n=200):
    rnd = random.Random(seed)
    return [rnd.choice([None, "", *["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 30))) for _ in range(6)]]) for _ in range(n)]


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


@pytest.mark.parametrize("at_once", [1, 7, 1 << 20])
def test_words_of_random_texts(monkeypatch, at_once):
    import tablehaul.llm.textarrays as textarrays

    monkeypatch.setattr(textarrays, "HASH_BYTES", at_once)
    texts = random_texts(1)
    words = words_of(pa.array(texts, pa.string()))
    by_hash = {}
    for t, text in enumerate(texts):
        own = BLANKS.findall(lowered(text))
        assert len(own) == words.first[t + 1] - words.first[t]
        for word, h in zip(own, words.hash[words.first[t] : words.first[t + 1]].tolist()):
            assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


# --- URL filters --------------------------------------------------------------------------------------


def judge_url(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = lowered(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = []
    for k, rule in enumerate(rules):
        if rule.listed:
            own, slash, tail = rule.name.partition("/")
            fit = (host == own or host.endswith("." + own)) and path.startswith(slash + tail)
        else:
            pattern = ".*".join(map(re.escape, rule.name.split("*")))
            fit = re.search(("^([^/]*\\.)?" if rule.text.startswith("||") else "") + pattern, host + path, re.S)
        if fit:
            fits.append((rule.listed, len(rule.name), -k, rule))
    best = max(fits)[3] if fits else None
    listed = best is not None and best.listed
    return host, path, best.name if listed else None, best.name if best and not listed else None, best.verdict if best else default


RULES = [
    *queries.LISTED, Rule("||bad.net/", "block"), Rule("/ads/*.gif", "block"), Rule("-track", "block"), Rule("/ads/ok.gif", "allow"),
    Rule("casino*win", "block"), Rule(".example.net/", "allow"),
]
URLS = [
    None, "", "no scheme", "http://", "http:///path", "HTTP://WWW.Example.ORG/es/1", "http://example.org/es/", "http://example.org/en/12?x#y",
    "http://a.example.org/en/2", "http://xexample.org/es/", "http://org/", "http://org", "http://org?x", "http://a.com/fr/1", "http://com/de/",
    "http://a.com/FR/", "http://bad.net/", "http://very.bad.net/x", "http://notbad.net/", "http://x.net/ads/1.gif", "http://x.net/ads/ok.gif",
    "http://x.net/a/casino-mega-win", "x://y://z.org/", "http://u@h:80/de/", "http://x-track.net/é\n/ads/\n.gif", "http://www.example.net/",
]


def test_urls_equal_brute_force(spark):
    rows = [(i, u, "host", 1, "p") for i, u in enumerate(URLS + URLS[:9])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict int, token string")
    out = filter_urls(pages, RULES)
    assert collections.Counter(out.columns) == collections.Counter(["page_id", "url", "token", "host", "path", "rule", "pattern", "verdict"])
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["pattern"], r["verdict"]) for r in out.collect()}
    assert got == {i: judge_url(u, RULES) for i, u, *_ in rows}


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert filter_urls(pages, []).first()["verdict"] == "allow"
    assert filter_urls(pages.limit(0), RULES).collect() == []


def test_tokens_of_rules():
    assert host_rule("example.org", "/en/1", "block").tokens == ["en", "example", "org"]
    assert Rule("casino*win", "block").tokens == [] and Rule("/ads/*.gif", "block").tokens == ["ads"]


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.REGISTRY.items() if sql))
def test_queries_equal_sql(spark, folder, name):
    db = duckdb.connect()
    for table in ("pages", "documents"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    query, sql = queries.REGISTRY[name]
    got = query(spark, folder)
    want = db.execute(sql)
    names = [d[0] for d in want.description]
    assert set(names) == set(got.columns)
    assert sorted(str(tuple(r[n] for n in names)) for r in got.collect()) == sorted(map(str, want.fetchall()))


# --- tokens and packing -------------------------------------------------------------------------------


def test_token_counts_equal_whole_texts(docs, odd_rows, spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for seed in range(5):
        texts = random_texts(seed)
        assert text_lengths(pa.array(texts, pa.string()), PIECES).tolist() == [len(sp.encode(t or "")) for t in texts]
    out = count_tokens(docs(odd_rows), PIECES, limit=10).collect()
    want = [(i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 10) for i, t in odd_rows]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out), key=str) == sorted(want, key=str)
    assert count_tokens(docs([]), PIECES).collect() == []


def test_ids_equal_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_BPE)
    for seed in range(5, 10):
        texts = random_texts(seed)
        ids, offsets = token_ids(pa.array(texts, pa.string()), WORD_BPE)
        for t, text in enumerate(texts):
            assert ids[offsets[t] : offsets[t + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("group_docs", [4, 20_000])
def test_packing_is_whole_and_gapless(docs, odd_rows, group_docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_BPE)
    out = [r.asDict() for r in pack_documents(docs(odd_rows), WORD_BPE, group_docs=group_docs).collect()]
    want = collections.Counter()
    for doc, text in odd_rows:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[(doc, k // 2048, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist() and sum(n for _, n in own) <= 2048
    assert pack_documents(docs([]), WORD_BPE).collect() == []


def test_packing_gives_the_ids_themselves(docs):
    out = pack_documents(docs([(1, "the thing " * 1500), (2, "a")]), WORD_BPE, length=1000, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in out) and sum(r["length"] for r in out) == 3003


def test_best_two_fit_is_near_the_bound():
    rnd = random.Random(1)
    for most in (30, 400, 1000, 2048):
        sizes = np.array([rnd.randint(1, most) for _ in range(3000)])
        bins, offset = best_two_fit(sizes, 2048)
        used = np.bincount(bins, sizes)
        assert used.max() <= 2048 and len(used) <= math.ceil(sizes.sum() / 2048) * (1.01 if most < 1500 else 1.1) + 1
        for b in range(0, len(used), 17):
            own = np.flatnonzero(bins == b)
            own = own[np.argsort(offset[own])]
            assert (offset[own] == np.cumsum(sizes[own]) - sizes[own]).all()


def test_two_pieces_take_the_place_of_the_smallest():
    # Greedy fills 6 + 3 and leaves 1; 2 + 2 in the place of 3 fill all.
    bins, _ = best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sorted(np.bincount(bins, [6, 3, 2, 2]).tolist()) == [3, 10]


def test_worker_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "UNITS_KEPT", 3)
    for seed in (1, 2):
        token_ids(pa.array(random_texts(seed, 20), pa.string()), WORD_BPE)
    first, _ = token_ids(pa.array(["word thing"]), WORD_BPE)
    again, _ = token_ids(pa.array(["word thing"]), WORD_BPE)
    assert first.tolist() == again.tolist()


def test_units_met_lately_stay_when_the_memory_is_full(monkeypatch):
    """A worker encodes a unit that each batch has once only, however many others come and go."""
    tokenizer, ends = packing.encoder(WORD_BPE)
    given: list[str] = []

    class Recorder:
        def encode(self, text, **options):
            given.extend(text.split())
            return tokenizer.encode(text, **options)

        def encode_batch(self, texts, **options):
            given.extend(x for text in texts for x in text.split())
            return tokenizer.encode_batch(texts, **options)

        encode_batch_fast = encode_batch

    monkeypatch.setattr(packing, "encoder", lambda path: (Recorder(), ends))
    monkeypatch.setattr(packing, "UNITS_KEPT", 20)
    packing.worker_memory(f"units {WORD_BPE}").clear()
    for k in range(30):
        text = " ".join(["rather", "often", "42nd", *("seldom" + chr(97 + k % 26) * (k + i + 1) for i in range(0, 70, 10))])
        ids, _ = token_ids(pa.array([text]), WORD_BPE)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert [given.count(x) for x in ("rather", "often", "42nd")] == [1, 1, 1]
    packing.worker_memory(f"units {WORD_BPE}").clear()


def test_a_worker_keeps_few_bytes_of_units():
    """What a worker remembers of 300,000 different units stays small, as it lies beside the work of other stages."""
    memory = packing.worker_memory(f"units {WORD_BPE}")
    memory.clear()
    try:
        for begin in range(0, 300_000, 50_000):
            token_ids(pa.array([" ".join(f"{i:06d}" for i in range(begin, begin + 50_000))]), WORD_BPE)
        spelled, ids, met = memory["units"]
        assert 100_000 <= len(spelled) <= 200_000
        assert spelled.nbytes + ids.nbytes + met.nbytes < 12 << 20
    finally:
        memory.clear()


@pytest.mark.parametrize("module, function, run", [
    (quality, "statistics", lambda docs: judge_quality(docs, None)),
    (spans, "sentences", spans.remove_repeated_spans),
    (packing, "token_ids", lambda docs: packing.pieces(docs, WORD_BPE)),
])
def test_no_step_of_the_pipeline_takes_more_than_two_megabytes_of_text_at_once(spark, monkeypatch, module, function, run):
    """Of a batch of 6 MB; a longer text is alone."""
    taken, steps = [], []
    texts = ["one two three. four five six seven. " * 3000] * 50 + ["eight nine. " * 200_000]

    class Steps:
        def __init__(self, df):
            self.df = df

        def mapInArrow(self, step, schema):
            steps.append(step)
            return self.df.limit(0).select(*[F.lit(None).cast(t).alias(n) for n, t in kinds(schema)])

    def kinds(schema):
        return [(f.name, f.dataType) for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema)]

    def recorded(given, *more):
        taken.append([len(x) for x in given.to_pylist()])
        return original(given, *more)

    original = getattr(module, function)
    monkeypatch.setattr(module, "in_batches", Steps)
    monkeypatch.setattr(module, function, recorded)
    run(spark.createDataFrame([], "doc_id bigint, text string"))
    given = pa.record_batch({
        "doc_id": pa.array(range(51)), "text": pa.array(texts), "key": pa.array(range(51)),
        "_covered": pa.array([[]] * 51, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    })
    for step in steps:
        taken.clear()
        assert list(step(iter([given])))
        assert [n for part in taken for n in part] == [len(x) for x in texts]
        assert all(sum(part) <= 2 << 20 for part in taken if len(part) > 1)
    packing.worker_memory(f"units {WORD_BPE}").clear()


# --- quality ------------------------------------------------------------------------------------------


def counts_by_force(text):
    text = text or ""
    words = BLANKS.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if BLANKS.search(line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def test_quality_counts_equal_brute_force(docs, odd_rows, texts):
    rnd = random.Random(6)
    lines = ["a b c d e f g h i", "x # y", "", "  ", "x # y ", "é $ 日本"]
    made = [(100 + i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    rows = odd_rows + made + texts
    out = judge_quality(docs(rows), None)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(((r["doc_id"], *[r[n] for n in names], r["base_failed"], r["kept"]) for r in out.collect()), key=str)
    want = []
    for doc, text in rows:
        c = counts_by_force(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        want.append((doc, *c, failed, not failed))
    assert got == sorted(want, key=str)
    assert judge_quality(docs([]), None).collect() == []


def test_trees_keep_their_constraints_and_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=3000) * 0.3 < 0.5).astype(float)
    trees = Trees.fit(x, y, [-1, 0, 1])
    assert ((trees.probability(x) > 0.5) == (y > 0)).mean() > 0.9
    for f, sign in ((0, -1), (2, 1)):
        probe = np.repeat(rng.normal(size=(50, 1, 3)), 40, axis=1)
        probe[:, :, f] = np.linspace(-4, 4, 40)
        p = trees.probability(probe.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(p, axis=1) >= -1e-9).all()


def test_trees_judge_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    trees = fit_quality(documents, labels.where("doc_id % 2 = 0"))
    judged = judge_quality(documents, trees).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in judged)
    assert len(judged) > 100 and right / len(judged) > 0.97


def test_no_trees_from_labels_of_one_kind(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id bigint, quality int, toxic int")
    assert fit_quality(docs([(1, "a"), (2, "b")]), labels) is None
    assert fit_quality(docs([]), labels.limit(0)) is None


# --- shards -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("part_rows", [3, 8192])
def test_shards_match_the_mixture(spark, part_rows):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["big"] * 6 + ["b", "c", None, ""]), "t") for i in range(1003)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id bigint, source string, slot string"), 10, part_rows=part_rows).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(1003))
    sizes = collections.Counter(r["shard"] for r in out)
    assert set(sizes.values()) == {100, 101} and set(sizes) == set(range(10))
    for shard in range(10):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sizes[shard]))
    whole = collections.Counter(s for _, s, _ in rows)
    each = collections.Counter((r["shard"], r["source"]) for r in out)
    assert all(abs(each[(k, s)] - n / 10) <= 2 for s, n in whole.items() for k in range(10))


def test_shards_do_not_depend_on_parts_or_order(spark):
    rows = [(i % 90, f"s{i % 3}") for i in range(100)]
    a, b = (spark.createDataFrame(x, "doc_id bigint, source string") for x in (rows, rows[::-1]))
    key = lambda df: sorted((r["doc_id"], r["source"], r["shard"], r["slot"]) for r in df.collect())
    assert key(shard_documents(a, 7, part_rows=5)) == key(shard_documents(b.repartition(3), 7, part_rows=1000))
    assert {s for *_, s, _ in key(shard_documents(a.limit(3), 7))} <= set(range(7))
    assert shard_documents(a.limit(0), 7).collect() == []
    nulls = spark.createDataFrame([(None, None), (None, "a"), (None, None)], "doc_id bigint, source string")
    assert sorted((r["shard"], r["slot"]) for r in shard_documents(nulls, 2).collect()) == [(0, 0), (0, 1), (1, 0)]


def test_shard_query(spark, folder, texts):
    out = {r["doc_id"]: r for r in queries.op9_sharding(spark, folder).collect()}
    for doc, text in texts:
        assert out[doc]["size"] == len(text.encode()) + 16 and out[doc]["text_crc32"] == zlib.crc32(text.encode())
    assert {r["law"] for r in out.values()} == {"rows"} and len(out) == len(texts)


# --- language -----------------------------------------------------------------------------------------


def test_languages_of_held_out_texts(spark):
    out = queries.op10_language_id(spark, "/root/testdata/sf0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = out.collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_language_of_odd_rows(docs, odd_rows, texts):
    filters = fit_language(docs(texts))
    out = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in identify_language(docs(odd_rows), filters).collect()}
    for row in [(1, None), (2, ""), (3, " \n\t ")]:
        assert out[row] == ("und", 0.0)
    assert out[(5, "a")] == ("en", 0.0) and out[odd_rows[10]][0] == "en"
    none = fit_language(docs([]))
    assert {r["lang_pred"] for r in identify_language(docs(odd_rows), none).collect()} == {"und"}
    assert identify_language(docs([]), filters).collect() == []


def test_more_than_64_languages(spark):
    rows = [(i, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + i % 7)}"] * 30), f"l{i}") for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = identify_language(table, fit_language(table)).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) > 95


# --- scores -------------------------------------------------------------------------------------------


def base_by_force(rows):
    tokens = {k: BLANKS.findall(lowered(t)) + [None] for k, (_, t, _) in enumerate(rows)}
    counts = collections.Counter(w for k, (_, _, held) in enumerate(rows) if not held for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return [
        (doc, held, len(tokens[k]), sum(counts[w] > 0 for w in tokens[k]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[k]))
        for k, (doc, _, held) in enumerate(rows)
    ]


def test_base_scores_equal_brute_force(spark, odd_rows, texts, monkeypatch):
    import tablehaul.llm.scoring as scoring

    monkeypatch.setattr(scoring, "BUCKET_TEXT", 100_000)
    monkeypatch.setattr(scoring, "SLICE", 60_000)
    rows = [(d, t, crc(d) % 7 == 2) for d, t in odd_rows + [(d + 100, t) for d, t in texts]]
    out = score_documents(spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, held_out boolean, logs int").repartition(3)).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=key)
    want = sorted(base_by_force(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(r["score"] < 0 for r in out)
    seen = [r for r in out if not r["held_out"] and r["n_tokens"] > 20]
    assert np.mean([r["score"] > r["base_score"] for r in seen]) > 0.9


def test_scores_without_training_or_rows(spark):
    table = spark.createDataFrame([(1, "a b", True), (2, None, None)], "doc_id bigint, text string, held_out boolean")
    alone = score_documents(table.where("doc_id = 1")).first()
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"]) == (3, 0, 0) and alone["base_score"] == 0
    both = {r["doc_id"]: r for r in score_documents(table).collect()}
    assert both[2]["train_tokens"] == 1 and both[2]["n_known"] == 1 and both[1]["n_known"] == 1
    assert score_documents(table.limit(0)).collect() == []


def test_scores_do_not_depend_on_what_is_broadcast(spark, odd_rows, texts, monkeypatch):
    import tablehaul.llm.scoring as scoring

    monkeypatch.setattr(scoring, "BUCKET_TEXT", 100_000)
    monkeypatch.setattr(scoring, "SLICE", 60_000)
    rows = [(d, t, crc(d) % 7 == 2) for d, t in odd_rows + [(d + 100, t) for d, t in texts]]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean").repartition(3)
    key = lambda r: (str(r[0]), r[2], r[5], r[6])
    scored = lambda: sorted(map(tuple, score_documents(table).collect()), key=key)
    want = scored()
    monkeypatch.setattr(scoring, "MOST_FILTER_BYTES", 1000)
    got = scored()
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_pairs_learnt_once_count(spark):
    rows = [(1, "a b", False), (2, "c d", False), (3, "a b", True), (4, "a d", True)]
    out = {r["doc_id"]: r for r in score_documents(spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")).collect()}
    assert out[3]["score"] > out[4]["score"] and math.isclose(out[3]["base_score"], out[4]["base_score"])
    assert math.isclose(out[1]["score"], out[3]["score"])


def test_filter_gives_levels_back():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.5, 20_000), 10**6)
    filter_ = LogFilter(np.frombuffer(LogFilter.segment(hashes, counts, 12), np.uint8), np.zeros(2, np.int64))
    filter_.start[1] = len(filter_.bits)
    level = filter_.levels(hashes)
    exact = 1 + np.floor(np.log2(counts)).astype(int)
    assert (level >= exact).all() and (level == exact).mean() > 0.98
    assert (filter_.levels(rng.integers(0, 2**63, 20_000, dtype=np.uint64)) == 0).mean() > 0.98


def test_ngrams_are_of_characters():
    from tablehaul.llm.language import code_points, letter_ngrams
    from tablehaul.llm.textarrays import flat

    texts = ["", "aé日\U0001f600\x7f߿ࠀ￿", None, "Ünï 日本語", "ab1cd", "\U0010ffff"]
    points, offsets = code_points(*flat(pa.array(texts, pa.string())))
    assert [points[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [[ord(c) for c in t or ""] for t in texts]
    for size, codes, first in letter_ngrams(pa.array(texts, pa.string())):
        want = []
        for t in texts:
            t = (t or "").lower()
            grams = [t[k : k + size] for k in range(len(t) - size + 1)]
            want.append([g for g in grams if all("a" <= c <= "z" or c > "\x7f" or c == " " for c in g)])
        assert np.diff(first).tolist() == list(map(len, want)) and len(set(codes.tolist())) == len({g for own in want for g in own})


# --- hot keys, odd names and settings ------------------------------------------------------------------


def test_many_rules_are_a_plan_of_few_literals(spark, monkeypatch):
    import time

    import tablehaul.llm.urls as urls

    rules = [Rule(f"||site{i}.org/", "block") for i in range(20_000)] + [Rule("*bad*", "block"), Rule("||shop.*/sale*", "block")]
    rows = [(i, f"http://a.site{i * 7}.org/x", 1, "b", 2) for i in range(50)] + [(90, "http://z.org/so/bad/", 1, "b", 2), (91, None, 1, "b", 2)]
    rows += [(92, "http://shop.example.com/sale-1", 1, "b", 2), (93, "http://shop.org/" + "x" * 200_000 + "/bad", 1, "b", 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, best int, _best string, token int")
    start = time.perf_counter()
    got = {r["page_id"]: (r["pattern"], r["verdict"], r["best"], r["_best"]) for r in filter_urls(pages, rules).collect()}
    assert time.perf_counter() - start < 30
    assert got[3] == ("site21.org/", "block", 1, "b") and got[90][0] == "*bad*" and got[91] == (None, "allow", 1, "b")
    assert got[92][0] == "shop.*/sale*" and got[93][0] == "*bad*" and sum(v[1] == "block" for v in got.values()) == 53
    few = rules[:300] + rules[-2:]
    want = sorted(map(str, filter_urls(pages, few).collect()))
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    assert sorted(map(str, filter_urls(pages, few).collect())) == want
    assert filter_urls(pages, []).where("verdict = 'allow'").count() == len(rows)


def test_rows_without_an_id_are_spread(spark):
    """Neither parts of shards nor groups of packing grow with the rows that share a doc_id or have none."""
    from pyspark.sql import functions as F

    import tablehaul.llm.shards as shards

    docs = spark.range(60_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("s").alias("source"))
    part = F.shiftright(shards._hash(docs, 0) * 8, shards.HASH_BITS)
    sizes = [r["count"] for r in docs.groupBy(part.alias("part")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * 7500
    out = shard_documents(docs.limit(2000), shards=7, part_rows=100).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"))
    assert {(r["n"], r["slots"]) for r in out.collect()} <= {(285, 285), (286, 286)}
    packed = pack_documents(docs.limit(3000), WORD_BPE, group_docs=300)
    groups = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 40).alias("group")).count().collect()]
    assert len(groups) == 10 and max(groups) < 2 * 300


def test_columns_of_any_name(spark):
    rows = [(i, f"text {i}", "s", 1, 2, 3, 4, "5") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _start int, _hash int, __part int, _band int, _size string")
    out = shard_documents(docs, shards=3, part_rows=10)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.count() == 50
    assert sorted(map(tuple, out.select(docs.columns).collect())) == sorted(rows)


def test_sizes_of_batches_may_have_units(spark):
    from tablehaul.llm.frames import ARROW_BYTES, in_batches

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for given, left in (("16m", ARROW_BYTES), ("2m", 2 << 20), ("4096k", 4 << 20), (str(1 << 20), 1 << 20)):
            spark.conf.set(name, given)
            in_batches(spark.range(1))
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) == left
    finally:
        spark.conf.set(name, before)


# --- leaks --------------------------------------------------------------------------------------------

QUESTION = "A train with 3 cars leaves the old station at 14 hours and John pays 25 dollars to go 120 km with 3 friends."


def leaks_of(spark, docs, texts, items):
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id bigint, text string, at int")
    return {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs(texts), benchmark).collect()}


def test_changed_questions_are_found(spark, docs):
    filler = "Nothing here has to do with any of it, but it goes on and on for a while."
    changed = QUESTION.replace("3", "7").replace("14", "9.5").replace("John", "Mary").replace("25", "31").replace("120 km", "88 miles")
    twice = "The farmer keeps 3 brown cows and sells 3 red carts to the old miller near our little town"
    rows = [
        (1, f"{filler} {QUESTION} {filler}"), (2, f"{filler}\n{changed}\n{filler}"), (3, filler), (4, QUESTION.upper()), (5, None), (6, ""),
        (7, " ".join(QUESTION.split()[:9])), (8, f"{changed} {filler} {QUESTION}"), (9, twice.replace("3 brown", "4 brown").replace("3 red", "5 red")),
        (10, twice.replace("3", "6")), (1, f"{filler} {QUESTION}"), (None, QUESTION),
    ]
    found = leaks_of(spark, docs, rows, [QUESTION, "too short", None, "", twice])
    assert {d for d, _ in found} >= {1, 2, 8, 10, None} and not {d for d, _ in found} & {3, 5, 6, 7}
    assert not found[(1, 0)]["changed"] and found[(2, 0)]["changed"] and found[(2, 0)]["n_exact"] == 0
    # 3 stands for 4 and for 5 in one copy: only windows that are exactly the item's count.
    assert found[(10, 4)]["changed"] and ((9, 4) not in found or found[(9, 4)]["n_found"] == found[(9, 4)]["n_exact"])
    assert leaks_of(spark, docs, [], [QUESTION]) == {} and leaks_of(spark, docs, rows, []) == {}


def test_short_dense_and_renamed_items_are_found(spark, docs):
    filler = "Nothing here has to do with any of it, but it goes on and on for a while."
    short, dense = "Who wrote the old song?", "Add 3 km, 14 km, 25 km, 7 kg, 31 kg and 12 hours to 9 days"
    named = "Anna counts the red stones. Anna gives two to a friend of hers. Bob then takes four of all those away."
    renamed = named.replace("Anna", "Clara").replace("Bob", "David")
    rows = [
        (1, f"{filler} {short} {filler}"), (2, f"{filler} {dense}. {filler}"), (3, f"{filler} {renamed}"), (4, filler),
        (5, "Who wrote that old song?"), (6, dense.replace("14", "15").replace("31", "32").replace("9", "8")), (7, f"So he asked {short}"),
    ]
    found = leaks_of(spark, docs, rows, [short, dense, named])
    assert set(found) == {(1, 0), (7, 0), (2, 1), (3, 2)}
    assert found[(3, 2)]["changed"] and not found[(2, 1)]["changed"] and found[(1, 0)]["n_windows"] == 1


def test_a_repeated_window_counts_once(spark, docs):
    phrase = " ".join(QUESTION.split()[4:13])
    rows = [(1, " And so on. ".join([phrase] * 20)), (2, f"{QUESTION} Once more: {QUESTION}")]
    found = leaks_of(spark, docs, rows, [QUESTION])
    assert set(found) == {(2, 0)} and found[(2, 0)]["n_found"] == found[(2, 0)]["n_windows"]


def test_leaks_are_taken_out(spark, docs):
    """Only rows whose own text leaks go, whatever rows share their doc_id."""
    table = docs([(1, QUESTION), (2, "b"), (None, "c"), (None, QUESTION), (7, f"So. {QUESTION}"), (7, "clean"), (1, QUESTION), (None, None)])
    benchmark = spark.createDataFrame([(5, QUESTION)], "item_id bigint, text string")
    leaks = find_leaks(table, benchmark)
    left = remove_leaks(table, leaks)
    assert sorted(str(r["text"]) for r in left.collect()) == ["None", "b", "c", "clean"] and left.columns == table.columns
    assert remove_leaks(table, leaks.limit(0)).count() == 8


def test_two_values_that_become_one_are_no_copy(spark, docs):
    item = "The farmer keeps 3 brown cows and sells 5 red carts to the old miller near our little town"
    rows = [(1, item.replace("3", "9").replace("5", "9")), (2, item.replace("3", "8").replace("5", "9"))]
    found = leaks_of(spark, docs, rows, [item])
    assert set(found) == {(2, 0)} and found[(2, 0)]["share"] == 1.0


def test_recall_of_changed_questions(spark, folder, docs):
    """Of all benchmark items, with numbers, names and units put in and then changed by a seed, nearly all are found."""
    rnd, filler = random.Random(11), "Nothing here has to do with any of it, but it goes on for a while."
    names, units = [f"{a}{b}" for a in ("Mar", "Jo", "Pet", "Han") for b in ("ta", "na", "ro", "lin")], ["km", "kg", "hours", "dollars", "miles"]

    def question(words, seed):
        own = random.Random(seed)
        numbers, people = own.sample(range(2, 999), len(words)), own.sample(names, 4)
        return [str(numbers[int(w[1:])]) if w[0] == "#" else people[int(w[1:])] if w[0] == "@" else own.choice(units) if w == "%" else w for w in words]

    items, rows = [], []
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").collect():
        words = [w.strip(".,?!").lower() for w in r["text"].split()]
        for at in range(len(words) - 4, 3, -7):
            words[at:at] = rnd.choice([[f"#{at}", f"%{rnd.randrange(5)}"], [f"@{rnd.randrange(4)}"], [f"#{at}"]])
        items.append(" ".join(question(words, 1)))
        rows.append((len(rows), f"{filler} {' '.join(question(words, 2 + len(rows)))} {filler}"))
    found = leaks_of(spark, docs, rows, items)
    assert sum((i, i) in found for i in range(len(rows))) >= 0.9 * len(rows)
    assert sum(found[(i, i)]["changed"] for i in range(len(rows)) if (i, i) in found) >= 0.9 * len(rows)


def test_leaks_of_tables_equal_brute_force(spark, folder, texts):
    """Items stand in texts word by word here, so plain windows find the same documents."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    plain = lambda t: re.findall(r"\w+", (t or "").lower())
    want = set()
    for doc, text in texts:
        joined = " " + " ".join(plain(text)) + " "
        want |= {(doc, item) for item, t in items if " " + " ".join(plain(t)) + " " in joined}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_benchmark_decontamination(spark, folder).collect()}
    assert want and found >= want
    for doc, item in found - want:  # only with most of the item's windows
        own, text = plain(dict(items)[item]), " ".join(plain(dict(texts)[doc]))
        assert sum(" ".join(own[k : k + 8]) in text for k in range(len(own) - 7)) >= 0.4 * (len(own) - 7)


@pytest.mark.parametrize("bound", [0, 200_000])
def test_leaks_with_and_without_broadcast(spark, folder, monkeypatch, bound):
    import tablehaul.llm.components as components
    import tablehaul.llm.decontaminate as module

    monkeypatch.setattr(module, "BROADCAST_WINDOWS", bound)
    monkeypatch.setattr(components, "BROADCAST_IDS", bound)
    leaks = queries.op2_benchmark_decontamination(spark, folder)
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert remove_leaks(documents, leaks).count() == documents.count() - leaks.select("doc_id").distinct().count()
