"""Sums at the edge of bigint, ties, file order, appended files, bytes, lossless escapes and stricter jobs."""

from __future__ import annotations

import random
import time
from datetime import datetime
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tablehaul.streaming.pipes as pipes
from tablehaul import (
    dump, extract_csv, load_partition, load_table, map_reduce, named, parse_lines, pipe_from, read_delimited, read_lines, result_lines,
    run_script, run_sum, sum_adjacent, table_stats, write_lines,
)
from tablehaul.plans.queries import REGISTRY
from tablehaul.plans.script import statements

BIG = 1 << 62


def arrays(*lines):
    return [pa.array([x]) for x in lines]


@pytest.mark.parametrize("numbers", [[BIG] * 3, [BIG] * 5, [-BIG] * 3, [BIG, BIG]])
def test_sums_beyond_bigint_fail(spark, numbers):
    with pytest.raises(OverflowError):
        list(sum_adjacent(arrays(*[f"a\t{n}" for n in numbers])))
    rows = spark.createDataFrame([(i, "a", n) for i, n in enumerate(numbers)], "i int, k string, n bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        with pytest.raises(Exception, match="does not fit a bigint"):
            run_sum(rows, "k", "n", ["i"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("numbers", [[BIG, 4096], [BIG, BIG - 1], [-BIG, -BIG], [BIG, BIG, -BIG], [-1, 1, -1]])
@pytest.mark.parametrize("batch", ["1", "1000"])
def test_sums_that_fit_pass(spark, numbers, batch):
    lines = [f"a\t{n}" for n in numbers]
    given = arrays(*lines) if batch == "1" else [pa.array(lines)]
    assert [x for out in sum_adjacent(given) for x in out.to_pylist()] == [f"a\t{sum(numbers)}"]
    rows = spark.createDataFrame([(i, "a", n) for i, n in enumerate(numbers)], "i int, k string, n bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert [r["total"] for r in run_sum(rows, "k", "n", ["i"]).collect()] == [sum(numbers)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tied_rows_spread_over_ranges(spark, tmp_path):
    rows = spark.range(200_000).select(F.lit(1).alias("i"), F.lit("a").alias("k"), F.lit(2).cast("bigint").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = run_sum(rows, "k", "n", ["i"], scratch=str(tmp_path / "runs")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [(r["total"], r["rows"]) for r in out] == [(400_000, 200_000)]
    parts = [r["rows"] for r in spark.read.parquet(str(tmp_path / "runs")).collect()]
    assert len(parts) > 2 and max(parts) < 100_000


def test_part_files_sort_by_number(spark, tmp_path):
    names = ["part-20240101120001", "part-20240101120000", "part-99999-x.txt", "part-100000-x.txt", "part-7", "part-00010", "other", "part-x"]
    for name in names:
        (tmp_path / name).write_text(name + "\n")
    got = [r[0] for r in read_lines(spark, str(tmp_path), ordered=True).collect()]
    assert got == ["other", "part-7", "part-00010", "part-99999-x.txt", "part-100000-x.txt", "part-20240101120000", "part-20240101120001", "part-x"]


def test_folders_like_partitions_add_no_column(spark, tmp_path):
    (tmp_path / "p=x").mkdir()
    (tmp_path / "p=x" / "a").write_text("line\n")
    assert read_lines(spark, str(tmp_path)).columns == ["value"]


def test_appended_lines_come_after(spark, tmp_path):
    path = str(tmp_path / "out")
    for start in (0, 10, 20):
        dump(spark, spark.range(start, start + 10, 1, 3), path, header=True, mode="append")
    assert [r[0] for r in read_lines(spark, path, ordered=True).collect()] == ["id", *map(str, range(30))]
    back = read_delimited(spark, path, "id int", header="dataset")
    assert sorted(r["id"] for r in back.collect()) == list(range(30))
    extract_csv(spark, str(tmp_path / "csv"), spark.range(2), header=True, mode="append")
    extract_csv(spark, str(tmp_path / "csv"), spark.range(2), header=True, mode="append")
    assert sorted(r[0] for r in read_lines(spark, str(tmp_path / "csv")).collect()) == ["0", "0", "1", "1", "id"]


def test_a_dataset_is_not_overwritten_by_itself(spark, tmp_path):
    path = str(tmp_path / "own")
    write_lines(spark.range(5).select(F.col("id").cast("string")), path)
    with pytest.raises(ValueError, match="is read by"):
        dump(spark, read_lines(spark, path), path)
    assert read_lines(spark, path).count() == 5


def test_more_than_one_column_is_refused(spark):
    two = spark.range(1).selectExpr("string(id) a", "string(id) b")
    for call in (lambda: pipe_from(two, "cat"), lambda: parse_lines(two, "x int"), lambda: map_reduce(spark, two, mapper=lambda x: x)):
        with pytest.raises(ValueError, match="one column"):
            call()
    dotted = spark.range(2).selectExpr("string(id) `a.b`")
    assert sorted(r[0] for r in pipe_from(dotted, "cat").collect()) == ["0", "1"]
    assert sorted(r[0] for r in parse_lines(dotted, "x int").collect()) == [0, 1]


def test_pipes_keep_all_bytes(spark):
    lines = spark.sql("SELECT cast(X'78FF79' AS string) AS value")
    out = pipe_from(lines, "cat; printf 'a\\377b\\n'").select(F.hex(F.col("value").cast("binary"))).collect()
    assert [r[0] for r in out] == ["78FF79", "61FF62"]


def test_batches_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(pipes, "BYTES_PER_BATCH", 10)
    assert list(pipes._by_bytes(["aaaa", "bbbb", "cccc", "d" * 30, "e"])) == [["aaaa", "bbbb"], ["cccc"], ["d" * 30], ["e"]]


def test_jobs_refuse_what_they_would_not_do(spark, lines):
    pairs = lines("a\t1", "b\t2", "a\t3")
    assert sorted(r[0] for r in map_reduce(spark, pairs, combiner=sum_adjacent).collect()) == ["a\t4", "b\t2"]
    for options in ({"combiner": True}, {"reducer": named("sum"), "combiner": sum_adjacent}, {"combiner": sum_adjacent, "reduce_tasks": 0}):
        with pytest.raises(ValueError):
            map_reduce(spark, pairs, **options)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert map_reduce(spark, pairs, reducer=named("sum"), reduce_tasks=3).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    with pytest.raises(Exception, match="no whole number"):
        map_reduce(spark, lines("a\t1", "b"), reducer=named("count")).collect()


def test_sums_in_any_order(monkeypatch):
    import tablehaul.streaming.stages as stages

    monkeypatch.setattr(stages, "LINES_COMBINED", 3)
    lines = ["a\t1", "b\t2", "a\t3", f"a\t{BIG}", f"a\t{BIG - 1}", "\t5"]
    out = [x for batch in sum_adjacent.in_any_order(arrays(*lines)) for x in batch.to_pylist()]
    assert sorted(out) == sorted(["a\t4", "b\t2", f"a\t{2 * BIG - 1}", "\t5"])
    # A part of a sum may be beyond bigint; the reducer, which has the whole, refuses it.
    parts = [x for batch in sum_adjacent.in_any_order(arrays(f"a\t{BIG}", f"a\t{BIG}")) for x in batch.to_pylist()]
    assert parts == [f"a\t{2 * BIG}"]
    with pytest.raises(OverflowError):
        list(sum_adjacent(arrays(*parts)))


def test_escaped_text_is_lossless(spark, tmp_path):
    rows = spark.sql("""
        SELECT * FROM VALUES
            (1, array(), array(array()), map(), struct(NULL, 'x')), (2, array(NULL), array(NULL), map('a', NULL), NULL),
            (3, NULL, NULL, NULL, struct('', NULL)), (4, array(''), array(array('')), map('', array()), struct('N', '2')),
            (5, array('', NULL), array(array(NULL), array()), map('k', array(NULL)), struct('\\\\N', '\\\\E0'))
        AS t(i, a, b, m, s)
    """).selectExpr("i", "cast(a AS array<string>) a", "cast(b AS array<array<string>>) b", "cast(m AS map<string,array<string>>) m", "cast(s AS struct<x:string,y:string>) s")
    dump(spark, rows, str(tmp_path / "t"), on_conflict="escape")
    back = read_delimited(spark, str(tmp_path / "t"), rows.schema, escaped=True)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_repeated_map_keys_take_no_quadratic_time(spark):
    rnd = random.Random(1)
    keys = [f"k{rnd.randrange(12_000)}" for _ in range(16_000)]
    line = ",".join(f"{k}:{i}" for i, k in enumerate(keys))
    rows = spark.createDataFrame([(line,)], "value string")
    began = time.time()
    got = parse_lines(rows, "m map<string,int>").first()["m"]
    want: dict = {}
    for i, k in enumerate(keys):
        want.setdefault(k, i)
    assert got == want and time.time() - began < 10


def test_tables_have_the_declared_columns(spark, tmp_path):
    (tmp_path / "t").write_text("1\tabcd\tab\n")
    columns = "a int COMMENT 'it''s a', b varchar(3), c char(4)"
    load_table(spark, str(tmp_path / "t"), "declared_columns", columns)
    told = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql("DESCRIBE declared_columns").collect()}
    assert told["a"][1] == "it's a" and told["b"][0] == "varchar(3)" and told["c"][0] == "char(4)"
    assert spark.table("declared_columns").first().asDict() == {"a": 1, "b": "abc", "c": "ab  "}
    with pytest.raises(Exception):
        load_table(spark, str(tmp_path / "none"), "declared_columns", "a int")
    assert spark.table("declared_columns").count() == 1


def test_null_partition_is_the_default_one(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS null_partition")
    spark.sql("CREATE TABLE null_partition (a int, p string) USING parquet PARTITIONED BY (p)")
    (tmp_path / "t").write_text("5\n")
    assert load_partition(spark, str(tmp_path / "t"), "null_partition", {"p": None}).first().asDict() == {"a": 5, "p": None}


def test_scripts_end_comments_and_raw_texts_rightly():
    assert statements("select 1 /* a /* b */ ; c */; select r'\\'; select 2 -- x;\n") == [
        "select 1 /* a /* b */ ; c */", "select r'\\'", "select 2 -- x;",
    ]


def test_a_set_at_the_end_is_no_result(spark):
    assert run_script(spark, "select 7 AS n; set spark.sql.ansi.enabled;").collect()[0]["n"] == 7
    assert run_script(spark, "/* only */ set spark.sql.ansi.enabled").columns == ["key", "value"]


def test_xml_is_read_back(spark):
    text = "a<b>&\"c\"\n\t]]> \x01 é"
    rows = spark.createDataFrame([(1, text)], "`count(1)` int, `2 x` string")
    for kind in ("xmlattr", "xmlelements"):
        root = ElementTree.fromstring("".join(r[0] for r in result_lines(rows, kind).collect()))
        row = root[0]
        got = dict(row.attrib) if kind == "xmlattr" else {x.tag: x.text for x in row}
        assert got == {"count_1_": "1", "_2_x": text.replace("\x01", "�")}


def test_tab_spelling_in_dsv(spark):
    assert result_lines(spark.sql("SELECT 1 a, 2 b"), "dsv", sep=r"\t").first()[0] == "1\t2"


def test_statistics_of_nested_maps(spark, tmp_path):
    spark.sql("SELECT 1 a, struct(map(1, 2) AS m) s, array(map(1, 2)) l").write.parquet(str(tmp_path / "t"))
    out = {r["column_name"]: r for r in table_stats(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert out["a"]["min_value"] == "1" and out["s"]["min_value"] is None and out["l"]["max_value"] is None
    assert out["a"]["file_count"] == 1 and out["a"]["byte_count"] > 0


def test_nested_items_are_parsed_once_and_named_after_rows_multiply(spark, tmp_path):
    day = datetime(2024, 1, 2)
    rows = [(1, 2, 3, 4, 5.0, 0.5, "A", "O", day)] * 2 + [(2, 1, None, 7, None, 0.1, "", None, None), (3, 1, 1, 1, 1.0, 1.0, None, "F", day)]
    ddl = (
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = REGISTRY["delimited_nested_round_trip"][0](spark, str(tmp_path))
    first = (1, 2, 5.0, 0.5, 2, "A", day)
    items = [("id 0", "3"), ("id 1", "4"), ("id 2", None), ("tag 0 0", "x"), ("tag 0 1", "O"), ("tag 1 0", "A")]
    second = (2, 1, None, 0.1, 2, "", None)
    # Raw text reads an empty text as an empty list, and a list of one NULL as NULL: no items of the third order.
    want = [first + x for x in items] * 2 + [second + x for x in [("id 0", None), ("id 1", "7"), ("id 2", None), ("tag 0 0", "x"), ("tag 0 1", None)]]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.rsplit("Generate ", 1)
    assert "[quantity]" in below and "[quantity]" not in above and "transform(" not in above
    assert plan.count("split(value") == 1
