"""Pipes, map/combine/reduce, word counts, run sums."""

from __future__ import annotations

import random
import re
import sys
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablehaul import (
    batched, map_reduce, named, pipe_from, pipe_into, read_lines, reduce_by_key, run_sum, sum_adjacent, tokenize,
    word_count, words,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def texts(df):
    return sorted(r[0] for r in df.collect())


def words_of(lines):
    for line in lines:
        for word in re.findall(r"\w+", line):
            yield f"{word}\t1"


def sum_lines(lines):
    pairs = (line.split("\t")[:2] for line in lines)
    for key, group in groupby(pairs, key=lambda p: p[0]):
        yield f"{key}\t{sum(int(v) for _, v in group)}"


WORDS = ("the cat the dog", "", "Zoë naïve_1 42", "?! ...")
COUNTS = {"the": 2, "cat": 1, "dog": 1, "Zoë": 1, "naïve_1": 1, "42": 1}


def test_tokenize_and_word_count(lines):
    assert lines("a-b ç1_x").select(tokenize("value")).first()[0] == ["a", "b", "ç1_x"]
    assert {r.word: r.n for r in word_count(lines(*WORDS)).collect()} == COUNTS


@pytest.mark.parametrize("combiner", [None, True, sum_lines, sum_adjacent])
@pytest.mark.parametrize("partitions", [1, 3])
def test_word_count_job(spark, lines, combiner, partitions):
    out = map_reduce(spark, lines(*WORDS, partitions=partitions), mapper=words_of, reducer=sum_lines,
                     combiner=combiner, reduce_tasks=2)
    assert texts(out) == sorted(f"{k}\t{n}" for k, n in COUNTS.items())


def test_reducers_agree(spark, lines):
    rnd = random.Random(5)
    pairs = [(rnd.choice(["hot"] * 5 + list("abcdef")), rnd.randint(-9, 9)) for _ in range(30_000)]
    want = {}
    for k, v in pairs:
        want[k] = want.get(k, 0) + v
    want = sorted(f"{k}\t{v}" for k, v in want.items())
    data = lines(*[f"{k}\t{v}" for k, v in pairs], partitions=4).persist()
    awk = "awk -F'\\t' 'NR>1 && $1!=k {print k\"\\t\"s; s=0} {k=$1; s+=$2} END {if (NR) print k\"\\t\"s}'"
    for n in (1, 3, 7):
        assert texts(map_reduce(spark, data, reducer=sum_lines, reduce_tasks=n)) == want
        assert texts(map_reduce(spark, data, reducer=awk, combiner=True, reduce_tasks=n)) == want
    assert texts(map_reduce(spark, data, reducer=named("sum"))) == want
    typed = data.selectExpr("split(value, '\t')[0] k", "int(split(value, '\t')[1]) v")
    assert sorted(f"{r.k}\t{r.sum}" for r in reduce_by_key(typed, "k", "v").collect()) == want
    data.unpersist()


def test_named_reducers(spark, lines):
    data = lines("a\t3", "b\t1", "a\t5")
    assert texts(map_reduce(spark, data, reducer=named("max"))) == ["a\t5", "b\t1"]
    assert texts(map_reduce(spark, data, reducer=named("min"))) == ["a\t3", "b\t1"]
    assert texts(map_reduce(spark, data, reducer=named("count"))) == ["a\t2", "b\t1"]
    with pytest.raises(ValueError):
        map_reduce(spark, data, reducer=named("median"))


def test_map_only_command_and_batches(spark, lines):
    assert texts(map_reduce(spark, lines("b", "a"), mapper="tr a-z A-Z", reduce_tasks=0)) == ["A", "B"]

    @batched
    def upper(batches):
        for lines in batches:
            yield pc.utf8_upper(lines)

    assert texts(map_reduce(spark, lines("b", "a"), mapper=upper)) == ["A", "B"]


def test_reducer_that_emits_nothing(spark, lines, tmp_path):
    def nothing(lines):
        pass

    out = map_reduce(spark, lines("a\t1", "b\t2"), str(tmp_path / "out"), reducer=nothing, reduce_tasks=2)
    assert out.count() == 0 and (tmp_path / "out" / "_SUCCESS").exists()


def test_paths_tasks_and_output(spark, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "f").write_text("w w\n" * 3)
    out = str(tmp_path / "out")
    inputs = [str(tmp_path / "x"), str(tmp_path / "y")]
    for tasks in (1, 5):
        got = map_reduce(spark, inputs, out, mapper=words_of, reducer=sum_lines, combiner=True,
                         map_tasks=tasks, reduce_tasks=1)
        assert texts(got) == ["w\t12"]
    assert texts(read_lines(spark, out)) == ["w\t12"]


def test_identity_reduce_sorts_by_key(spark, lines):
    out = map_reduce(spark, lines("b\t1", "a\t2", "c", partitions=3), reduce_tasks=1)
    assert [r[0] for r in out.collect()] == ["a\t2", "b\t1", "c"]
    alike = lines(*["hot\t1"] * 4000, "a\t1", partitions=4)
    loads = map_reduce(spark, alike, reduce_tasks=4).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in loads) == 4001 and max(r["count"] for r in loads) < 3000


def test_pipes(spark, lines, tmp_path):
    data = lines("ab", "b", "", "ça", partitions=4)
    assert texts(pipe_from(data, "grep -F a", ok_codes=(0, 1))) == ["ab", "ça"]
    with pytest.raises(Exception, match="exited with code 1"):
        pipe_from(data, "grep -F zzz").collect()
    with pytest.raises(Exception, match="exited with code 3"):
        pipe_from(data, "cat; exit 3").collect()
    assert texts(pipe_from(lines("x", "y"), "head -n 1")) == ["x"]
    assert texts(pipe_from(lines("x", "y"), "printf abc")) == ["abc"]
    assert pipe_from(data, "cat").limit(1).count() == 1
    pipe_into(data, "tr a-z A-Z", str(tmp_path / "o"))
    assert texts(read_lines(spark, str(tmp_path / "o"))) == sorted(["AB", "B", "", "çA"])


def test_pipe_behind_a_failing_stage_ends(spark, lines):
    def fail(lines):
        for line in lines:
            yield str(int(line))

    failing = map_reduce(spark, lines("1", "x"), mapper=fail)
    with pytest.raises(Exception, match="invalid literal"):
        pipe_from(failing, "sort").collect()


def test_pipe_of_much_data(spark, lines):
    big = spark.range(200_000).selectExpr("concat(id, repeat('x', 50)) value")
    assert pipe_from(big, "cat").distinct().count() == 200_000
    assert pipe_from(big, "head -n 5").count() == 5 * big.rdd.getNumPartitions()
    long = lines("y" * 5_000_000, "z")
    assert [len(t) for t in texts(pipe_from(long, "cat"))] == [5_000_000, 1]


def brute_force_runs(rows):
    out = []
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        user, place, key, value = row
        if out and out[-1][0] == user and out[-1][1] == key:
            out[-1][3] += value or 0
            out[-1][4] += 1
        else:
            out.append([user, key, place, value or 0, 1])
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 40])
@pytest.mark.parametrize("shape", ["mixed", "hot user", "one key", "two keys", "empty"])
def test_run_sum_against_brute_force(spark, partitions, shape):
    rnd = random.Random(partitions)
    rows = []
    for place in range(0 if shape == "empty" else 400):
        user = 1 if shape == "hot user" else rnd.randint(1, 4)
        key = {"one key": "k", "two keys": rnd.choice("ab")}.get(shape, rnd.choice(["a", "b", None]))
        rows.append((user, place, key, rnd.randint(-5, 5)))
    df = spark.createDataFrame(rows, "user int, place int, key string, value int")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", partitions < 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = run_sum(df, "key", "value", ["place"], ["user"])
        found = sorted(((r.user, r.key, r.place, r.total, r["rows"]) for r in got.collect()), key=repr)
        assert found == brute_force_runs(rows)
        whole = run_sum(df.drop("user"), "key", "value", ["place"])
        found = sorted(((r.key, r.place, r.total, r["rows"]) for r in whole.collect()), key=repr)
        assert found == sorted((r[1:] for r in brute_force_runs([(0, *r[1:]) for r in rows])), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_run_sum_fixture_and_nulls(spark):
    rows = [(0, "a", 1), (1, "a", 2), (2, "b", 3), (3, "a", 4), (4, "c", None)]
    df = spark.createDataFrame(rows, "i int, k string, v int")
    got = [(r.k, r.total) for r in run_sum(df, "k", "v", ["i"]).orderBy("i").collect()]
    assert got == [("a", 3), ("b", 3), ("a", 4), ("c", None)]
    by_key = [(r.k, r.total) for r in run_sum(df, "k", "v", ["k", "i"]).orderBy("k").collect()]
    assert by_key == [("a", 7), ("b", 3), ("c", None)]


def test_run_sum_spreads_a_hot_partition_value(spark, tmp_path):
    rows = spark.range(30_000).selectExpr("if(id % 3 < 2, 1, id) user", "id place", "string(id % 2) key", "1 value")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        path = str(tmp_path / "fragments")
        got = run_sum(rows, "key", "value", ["place"], ["user"], scratch=path)
        loads = [r["sum(rows)"] for r in spark.read.parquet(path).groupBy("_part").sum("rows").collect()]
        assert sum(loads) == 30_000 and max(loads) < 30_000 / 4
        assert got.selectExpr("sum(total)").first()[0] == 30_000
        assert got.count() == 30_000 - _merged(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.enabled", True)


def _merged(rows):
    """Rows that continue a run, from the sorted rows themselves."""
    ordered = sorted((r.user, r.place, r.key) for r in rows.collect())
    return sum(a[0] == b[0] and a[2] == b[2] for a, b in zip(ordered, ordered[1:]))


def test_combiner_shrinks_a_hot_key_before_the_shuffle(spark, lines):
    def count_lines(lines):
        for key, group in groupby(lines, key=lambda line: line.split("\t")[0]):
            yield f"{key}\t{sum(1 for _ in group)}"

    data = lines(*["hot\t1"] * 3000, *[f"k{i}\t1" for i in range(500)], partitions=3)
    seen = dict(t.split("\t") for t in texts(map_reduce(spark, data, reducer=count_lines, combiner=sum_lines)))
    assert int(seen["hot"]) <= 3 and set(seen.values()) <= {"1", "2", "3"}


def test_reducer_partitioning_keeps_keys_whole(spark, lines):
    data = lines(*[f"{k}\t{i}" for i in range(50) for k in "abcdefgh"], partitions=5)
    out = texts(map_reduce(spark, data, reducer=sum_lines, reduce_tasks=3))
    assert out == [f"{k}\t{sum(range(50))}" for k in "abcdefgh"]


def test_ready_made_stages(spark, lines):
    out = map_reduce(spark, lines(*WORDS, partitions=3), mapper=words, reducer=sum_adjacent, combiner=True)
    assert texts(out) == sorted(f"{k}\t{n}" for k, n in COUNTS.items())
    runs = map_reduce(spark, lines("a\t1\tx", "a\t2", "b\t3", "a\t4"), mapper=sum_adjacent)
    assert [r[0] for r in runs.collect()] == ["a\t3", "b\t3", "a\t4"]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_sum_adjacent_over_batches(size):
    rnd = random.Random(size)
    data = [f"{rnd.choice('aab')}\t{rnd.randint(-3, 9)}" for _ in range(200)]
    batches = [pa.array(data[i : i + size]) for i in range(0, len(data), size)]
    got = [line for out in sum_adjacent(iter([pa.array([], pa.string()), *batches])) for line in out.to_pylist()]
    assert got == list(sum_lines(data))
    assert list(sum_adjacent(iter([]))) == []
    with pytest.raises(OverflowError):
        list(sum_adjacent(iter([pa.array([f"a\t{2**62}", f"a\t{2**62}"])])))
