"""Datasets of lines that grow in one step, keep their order and guard their input; tables that change in one step; statements
told apart by Spark's parser; partial sums of any size; reducers that run before the shuffle."""

from __future__ import annotations

import os
import random
import time
from itertools import groupby

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tablehaul.sources.lines as lines_module
import tablehaul.sources.tables as tables_module
from tablehaul import (
    associative, dump, load_partition, load_table, map_reduce, named, numbered_lines, positioned_lines, read_delimited, read_lines, reduce_by_key,
    run_script, run_sum, sql, sum_adjacent, table_stats, write_lines,
)
from tablehaul.plans.script import is_query
from tablehaul.sources.tables import name_parts

BIG = 1 << 62


def texts(df):
    return [r["value"] for r in df.collect()]


def numbers(spark, start, end, parts=3):
    return spark.range(start, end, 1, parts).select(F.col("id").cast("string").alias("value"))


# --- appending --------------------------------------------------------------------------------------


def test_appends_are_read_in_order(spark, tmp_path):
    path = str(tmp_path / "a set")
    for k in range(13):
        write_lines(numbers(spark, 10 * k, 10 * k + 10), path, mode="append", compression="gzip" if k % 2 else None)
    assert texts(read_lines(spark, path, ordered=True)) == [str(i) for i in range(130)]
    assert [(r["number"], r["value"]) for r in numbered_lines(spark, path).orderBy("number").collect()] == [(i + 1, str(i)) for i in range(130)]
    assert sorted(texts(read_lines(spark, [path]))) == sorted(str(i) for i in range(130))
    assert sorted(p.name for p in (tmp_path / "a set").iterdir() if p.is_dir()) == [f"then-{k:06d}" for k in range(1, 13)]
    write_lines(numbers(spark, 0, 3), path)
    assert sorted(texts(read_lines(spark, path))) == ["0", "1", "2"]


def test_an_append_that_stops_leaves_the_old_lines(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    write_lines(numbers(spark, 0, 5), path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(lines_module, "_publish", killed)  # all new files are written, none is shown
        with pytest.raises(KeyboardInterrupt):
            write_lines(numbers(spark, 5, 50), path, mode="append")
    assert texts(read_lines(spark, path, ordered=True)) == [str(i) for i in range(5)]
    failing = numbers(spark, 5, 9).select(F.raise_error(F.lit("no")).cast("string").alias("value"))
    with pytest.raises(Exception, match="no"):
        write_lines(failing, path, mode="append")
    assert texts(read_lines(spark, path, ordered=True)) == [str(i) for i in range(5)]
    write_lines(numbers(spark, 5, 9), path, mode="append")
    assert texts(read_lines(spark, path, ordered=True)) == [str(i) for i in range(9)]


def test_a_number_that_is_taken_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "set")
    write_lines(numbers(spark, 0, 2), path)
    for k, start in enumerate((2, 4)):
        hidden = f"{path}/_appending-{k}"
        numbers(spark, start, start + 2).write.text(hidden)
        lines_module._publish(spark, hidden, path, 1)  # both writers saw no append
    assert texts(read_lines(spark, path, ordered=True)) == [str(i) for i in range(6)]


def test_one_header_for_all_appends(spark, tmp_path):
    path = str(tmp_path / "set")
    for start in (0, 4):
        dump(spark, spark.range(start, start + 4).repartition(2), path, header=True, mode="append")
    assert sorted(r["id"] for r in read_delimited(spark, path, "id int", header="dataset").collect()) == list(range(8))
    write_lines(read_lines(spark, path), path, mode="append")  # its own lines once more
    assert read_lines(spark, path).count() == 18


# --- order ------------------------------------------------------------------------------------------


def test_order_of_files_blocks_and_appends(spark, tmp_path):
    rnd, want = random.Random(3), []
    for name in ("00-first", "part-2", "part-10", "part-00011-x.txt", "z"):
        own = [f"{name} {i} " + "x" * rnd.randint(0, 40) for i in range(rnd.choice([0, 1, 400]))]
        (tmp_path / name).write_text("".join(line + "\n" for line in own))
        want += own
    for number in ("2", "10"):
        (tmp_path / f"then-{number}").mkdir()
        for name in ("part-9", "part-10"):
            (tmp_path / f"then-{number}" / name).write_text(f"{number} {name}\n")
            want.append(f"{number} {name}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")  # files of several blocks
    try:
        assert texts(read_lines(spark, str(tmp_path), ordered=True)) == want
        numbered = numbered_lines(spark, str(tmp_path)).orderBy("number").collect()
        assert [(r["number"], r["value"]) for r in numbered] == list(enumerate(want, 1))
        placed = positioned_lines(spark, str(tmp_path)).sort("file", "block", "row")
        assert texts(placed) == want and placed.columns == ["value", "file", "block", "row"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_order_with_tables_of_files_that_are_not_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines_module, "BROADCAST_FILES", 0)
    write_lines(numbers(spark, 0, 100, 7), str(tmp_path / "set"))
    assert texts(read_lines(spark, str(tmp_path / "set"), ordered=True)) == [str(i) for i in range(100)]
    assert [r["value"] for r in numbered_lines(spark, str(tmp_path / "set")).orderBy("number").collect()] == [str(i) for i in range(100)]


def test_ordered_lines_are_placed_without_a_sample(spark, tmp_path):
    """One scan of the lines: their places are known from the files' sizes."""
    write_lines(numbers(spark, 0, 1000, 4), str(tmp_path / "set"))
    plan = read_lines(spark, str(tmp_path / "set"), ordered=True)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("FileScan text") == 1
    numbering = numbered_lines(spark, str(tmp_path / "set"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(value" not in numbering and "SortMergeJoin" not in numbering


def test_empty_datasets_have_an_order(spark, tmp_path):
    write_lines(numbers(spark, 0, 0), str(tmp_path / "none"))
    assert texts(read_lines(spark, str(tmp_path / "none"), ordered=True)) == []
    assert numbered_lines(spark, str(tmp_path / "none")).collect() == []


# --- own input --------------------------------------------------------------------------------------


def test_own_input_is_refused_wherever_it_lies(spark, tmp_path):
    path = str(tmp_path / "over all")
    write_lines(numbers(spark, 0, 4), f"{path}/day=1")
    write_lines(numbers(spark, 0, 4), f"{path}/day=2")
    both = spark.read.text(path).select("value")
    beside = read_lines(spark, f"{path}/day=2")
    for rows, target in ((both, path), (both, f"{path}/day=1"), (beside, path), (beside, f"{path}/day=2"), (beside, f"file:{path}/day=2/")):
        with pytest.raises(ValueError, match="is read by"):
            write_lines(rows, target)
    write_lines(beside, f"{path}/day=1")
    write_lines(beside, f"{path}/day=")  # a name that another begins with
    assert sorted(texts(read_lines(spark, f"{path}/day=1"))) == ["0", "1", "2", "3"]


def test_many_input_files_are_looked_at_at_once(spark, tmp_path):
    for i in range(4000):
        (tmp_path / f"f{i}").write_text("x\n")
    lines = read_lines(spark, str(tmp_path))
    lines.inputFiles()
    start = time.perf_counter()
    lines_module._refuse_own_input(lines, str(tmp_path / "other"))
    assert time.perf_counter() - start < 1.0  # 14 seconds file by file


# --- tables -----------------------------------------------------------------------------------------


def test_names_of_tables():
    assert name_parts("a") == ["a"] and name_parts(" `a b` ") == ["a b"] and name_parts("db.`x``.y`") == ["db", "x`.y"]
    assert name_parts("c.d.`1`") == ["c", "d", "1"]
    for wrong in ("", "a.", "`a", "a b", "a..b", "."):
        with pytest.raises(ValueError):
            name_parts(wrong)


def source(tmp_path, *lines, name="source"):
    (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
    return str(tmp_path / name)


def test_quoted_names_load(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS `2nd`")
    for name in ("`1st`", "`select`", "default.`order`", "`2nd`.`3`"):
        for rows in (["1", "2"], ["3"]):
            assert sorted(r["a"] for r in load_table(spark, source(tmp_path, *rows), name, "a int").collect()) == [int(x) for x in rows]
        spark.sql(f"DROP TABLE {name}")
    spark.sql("CREATE TABLE `4` (a int, `the day` string) USING parquet PARTITIONED BY (`the day`)")
    assert load_partition(spark, source(tmp_path, "5"), "`4`", {"the day": "x"}).collect()[0]["the day"] == "x"
    spark.sql("DROP TABLE `4`")
    spark.sql("DROP DATABASE `2nd` CASCADE")


def test_a_reload_is_one_catalog_call(spark, tmp_path, monkeypatch):
    columns = "a int COMMENT 'the first', b varchar(4)"
    load_table(spark, source(tmp_path, "1\tabcdef"), "swapped", columns)
    calls, run = [], type(spark).sql

    def noted(self, text, *args, **more):
        calls.append(text.split()[0])
        assert spark.catalog.tableExists("swapped")
        assert [tuple(r) for r in run(self, "SELECT * FROM swapped").collect()] == [(1, "abcd")]
        return run(self, text, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", noted)
        loaded = load_table(spark, source(tmp_path, "2\tx", "3\ty"), "swapped", columns)
    assert calls.count("ALTER") == 1 and not {"DROP", "CREATE"} & set(calls)
    assert sorted(map(tuple, loaded.collect())) == [(2, "x"), (3, "y")]
    place = [r["data_type"] for r in spark.sql("DESCRIBE EXTENDED swapped").collect() if r["col_name"] == "Location"][0]
    parent = place.removeprefix("file:").rpartition("/")[0]
    assert sum(n.startswith("swapped") for n in os.listdir(parent)) == 1  # the old rows are gone
    spark.sql("DROP TABLE swapped")
    assert not any(n.startswith("swapped") for n in os.listdir(parent))


def test_other_columns_change_names_and_back(spark, tmp_path, monkeypatch):
    load_table(spark, source(tmp_path, "1"), "renamed", "a int")
    run = type(spark).sql

    def failing(self, text, *args, **more):
        if text.startswith("ALTER") and "_loading_" in text:
            raise RuntimeError("the catalog is away")
        return run(self, text, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError, match="away"):
            load_table(spark, source(tmp_path, "x\ty"), "renamed", "a string, b string")
    assert [tuple(r) for r in spark.table("renamed").collect()] == [(1,)]
    assert [tuple(r) for r in load_table(spark, source(tmp_path, "x\ty"), "renamed", "a string, b string").collect()] == [("x", "y")]
    assert sorted(t.name for t in spark.catalog.listTables() if "renamed" in t.name) == ["renamed"]
    spark.sql("DROP TABLE renamed")


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "place")
    for name, more in (("kept_managed", {}), ("kept_external", {"location": place})):
        load_table(spark, source(tmp_path, "1"), name, "a int", **more)
        with monkeypatch.context() as patch:
            broken = lambda spark, path, schema, *_: spark.range(3).select(
                *[F.raise_error(F.lit("broken")).cast("int").alias(name) for name in schema.names]
            )
            patch.setattr(tables_module, "read_delimited", broken)
            for columns in ("a int", "a int, b int"):
                with pytest.raises(Exception, match="broken"):
                    load_table(spark, source(tmp_path, "2"), name, columns, **more)
        assert [r["a"] for r in spark.table(name).collect()] == [1]
        again = load_table(spark, source(tmp_path, "2", "3"), name, "a int", **more)
        assert sorted(r["a"] for r in again.collect()) == [2, 3]
        spark.sql(f"DROP TABLE {name}")
    assert sorted(r["a"] for r in spark.read.parquet(place).collect()) == [2, 3]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("place")] == ["place"]


# --- scripts ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "statement, query",
    [
        ("SELECT 1", True), ("/* a */ (SELECT 1) UNION (SELECT 2)", True), ("WITH a AS (SELECT 1) SELECT * FROM a", True), ("VALUES (1)", True),
        ("FROM range(3) SELECT id", True), ("TABLE t", True), ("SELECT * FROM t WHERE a > :least", True), ("FROM t |> WHERE a > 1", True),
        ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", False), ("FROM t INSERT INTO u SELECT a", False),
        ("FROM t INSERT INTO u SELECT a INSERT INTO v SELECT b", False), ("INSERT OVERWRITE t VALUES (1)", False), ("DROP TABLE IF EXISTS t", False),
        ("CREATE TABLE t AS SELECT 1", False), ("SHOW TABLES", False), ("SET a.b = 1", False), ("EXPLAIN SELECT 1", False), ("no statement", False),
        ("CACHE TABLE c AS SELECT 1", False), ("MERGE INTO t USING u ON t.a = u.a WHEN MATCHED THEN DELETE", False),
    ],
)
def test_what_is_a_query(spark, statement, query):
    assert is_query(spark, statement) is query


def test_inserts_take_no_querys_place(spark):
    script = """
        DROP TABLE IF EXISTS filled; CREATE TABLE filled (a BIGINT) USING parquet;
        WITH r AS (SELECT id FROM range(3)) INSERT INTO filled SELECT id FROM r;
        SELECT a, a * :times AS b FROM filled ORDER BY a DESC;
        FROM filled INSERT INTO filled SELECT a + 10; DROP TABLE filled
    """
    assert [tuple(r) for r in run_script(spark, script, args={"times": 2}).collect()] == [(2, 4), (1, 2), (0, 0)]
    assert sql(spark, "SHOW DATABASES", format=None).columns == ["namespace"]
    with pytest.raises(Exception, match="(?i)syntax"):
        run_script(spark, "SELECT 1; SELEKT 2")


# --- sums and hot keys ------------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{"reducer": sum_adjacent, "combiner": True}, {"reducer": sum_adjacent}, {"reducer": named("sum")}])
def test_partial_sums_beyond_bigint(spark, how):
    def lines(*parts):
        rows = [(i, f"a\t{n}") for i, part in enumerate(parts) for n in part]
        return spark.createDataFrame(rows, "i int, value string").repartitionById(len(parts), "i").select("value")

    assert texts(map_reduce(spark, lines([BIG, BIG], [-BIG]), **how)) == [f"a\t{BIG}"]
    assert texts(map_reduce(spark, lines([BIG] * 4, [-BIG] * 4, [5]), **how)) == ["a\t5"]
    assert texts(map_reduce(spark, lines([-BIG] * 3, [BIG, BIG]), **how)) == [f"a\t{-BIG}"]
    for whole in ([[BIG, BIG], []], [[BIG], [BIG]], [[-BIG, -BIG], [-1]]):
        with pytest.raises(Exception, match="does not fit a bigint"):
            map_reduce(spark, lines(*whole), **how).collect()


def test_wide_partials_in_several_tables(spark, monkeypatch):
    import tablehaul.streaming.stages as stages

    monkeypatch.setattr(stages, "LINES_COMBINED", 3)
    lines = [f"{k}\t{n}" for n in (BIG, BIG, BIG, -BIG, -BIG, -BIG, 7) for k in "ab"]
    combined = [x for out in stages._sum_in_any_order(iter([pa.array(lines)])) for x in out.to_pylist()]
    again = [x for out in stages._sum_in_any_order(iter([pa.array(combined)])) for x in out.to_pylist()]
    assert sorted(again) == ["a\t7", "b\t7"]
    with pytest.raises(Exception):
        list(stages._sum_in_any_order(iter([pa.array(["a\tx", f"a\t{BIG * 4}"])])))


def test_sums_by_key(spark):
    rows = spark.createDataFrame([("a", BIG), ("a", BIG), ("a", -BIG), ("b", None), ("c", -1)], "k string, n bigint").repartition(3)
    got = {r["k"]: tuple(r)[1:] for r in reduce_by_key(rows, "k", "n", ["sum", "min", "count"]).collect()}
    assert got == {"a": (BIG, -BIG, 3), "b": (None, None, 0), "c": (-1, -1, 1)}
    assert reduce_by_key(spark.range(3).selectExpr("id k", "id * 0.5D x"), "k", "x").schema["sum"].dataType.simpleString() == "double"


def test_an_associative_reducer_runs_before_the_shuffle(spark, tmp_path):
    """Nine of ten lines have one key: its reducer gets a line for each map partition, not all of them."""
    seen = spark.sparkContext.accumulator(0)

    @associative
    def longest(lines):
        for key, run in groupby((line.split("\t") for line in lines), key=lambda pair: pair[0]):
            values = [v for _, v in run]
            seen.add(len(values) if key == "hot" and len(values) < 1000 else 0)
            yield f"{key}\t{max(values, key=lambda v: (len(v), v))}"

    keys = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 70))
    lines = spark.range(0, 40_000, 1, 8).select(F.concat_ws("\t", keys, F.col("id").cast("string")).alias("value"))
    got = dict(x.split("\t") for x in texts(map_reduce(spark, lines, reducer=longest, reduce_tasks=4)))
    assert got["hot"] == "39999" and len(got) == 8
    assert seen.value == 8  # the second time, one line of each of eight map partitions
    plain = dict(x.split("\t") for x in texts(map_reduce(spark, lines, reducer=longest, combiner=False, reduce_tasks=4)))
    assert plain == got


def test_run_sums_compute_their_input_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 1000, 1, 4).selectExpr("id", "id div 10 AS k", "1L AS n").mapInArrow(noted, "id bigint, k bigint, n bigint")
    out = run_sum(rows, "k", "n", ["id"]).collect()
    assert len(out) == 100 and {r["total"] for r in out} == {10} and computed.value == 1000


def test_statistics_of_text(spark, tmp_path):
    write_lines(numbers(spark, 0, 30, 3), str(tmp_path / "set"))
    row = table_stats(spark.read.text(str(tmp_path / "set"))).first()
    assert (row["row_count"], row["file_count"], row["byte_count"]) == (30, 3, sum(len(str(i)) + 1 for i in range(30)))
