"""The pipeline: each stage does what its operator says, and clean documents come through."""

from __future__ import annotations

import collections
import random

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_pairs import groups_by_force, spans_by_force
from tests.llm.test_rows import counts_by_force


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for name, stage in pipeline.STAGES:
        result = pipeline.stored(stage(spark, docs, folder), name)
        out.append(result.collect())
        if name != pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns and [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]
        docs = result
    return out


def test_quality_keeps_rows_whole(stages):
    before, after = ({r["doc_id"]: r for r in rows} for rows in stages[:2])
    assert all(before[i] == r for i, r in after.items())
    for i in before.keys() - after.keys():
        n, *_, repeated = counts_by_force(before[i]["text"])
        failed = n < 20 or 100 * repeated > 30 * n
        junk = failed or "!!" in before[i]["text"] or " | " in before[i]["text"] or any(x * 2 in before[i]["text"] for x in "#$%&*")
        assert junk, before[i]["text"][:200]


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1:3]
    groups = groups_by_force([(r["doc_id"], r["text"]) for r in before], pipeline.NEAR)
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, _, c, _ in groups})


def test_repeated_spans_go(stages):
    before, after = stages[2:4]
    want = {d: t for d, t, n, lost in spans_by_force([(r["doc_id"], r["text"]) for r in before]) if not lost or lost < n}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] != next(b["text"] for b in before if b["doc_id"] == r["doc_id"]))


def test_leaks_go_and_all_others_are_packed(stages):
    before, after, packed = stages[3:6]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) >= 0.8 * len(before)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in after}
    room = collections.Counter()
    for r in packed:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 2048


def test_run_equals_the_stages(spark, folder, stages):
    pick = lambda rows: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)
    assert pick(pipeline.run(spark, folder).collect()) == pick(stages[-1])


def test_stages_take_odd_rows(spark, folder, odd_rows):
    rows = [(i, t, None, None, None) for i, t in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == []
        out = stage(spark, docs, folder)
        assert out.count() > 0, name
    near = pipeline.near_duplicates(spark, docs, folder).collect()
    assert sorted(r["doc_id"] for r in near if r["doc_id"] is not None) == [1, 2, 3, 5, 7, 9, 10, 11, 13]
    assert sum(r["doc_id"] is None for r in near) == 2


def test_clean_rows_stay_beside_rows_with_their_id(spark, folder):
    """Rows that share a doc_id, or have none, are judged each by its own text."""
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first()["text"]
    rnd = random.Random(1)
    clean = [" ".join(rnd.choice("this goes from here to there with many more words of all kinds now".split()) for _ in range(40)) for _ in range(4)]
    rows = [(None, clean[0]), (None, f"{clean[1]} {item}"), (7, clean[2]), (7, clean[3]), (7, clean[3]), (8, f"{clean[0]} so"), (8, item)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    near = [(r["doc_id"], r["text"]) for r in pipeline.near_duplicates(spark, docs, folder).collect()]
    assert sorted(near, key=str) == sorted([rows[1], rows[2], rows[3], rows[5], rows[6]], key=str)
    left = [(r["doc_id"], r["text"]) for r in pipeline.benchmark_leaks(spark, docs, folder).collect()]
    assert sorted(left, key=str) == sorted([rows[0], rows[2], rows[3], rows[4], rows[5]], key=str)
