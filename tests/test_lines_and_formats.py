"""Lines, headers, CSV and result formats."""

from __future__ import annotations

import gzip

import pytest

from tablehaul import (
    extract_csv, line_record, read_lines, read_sequence_lines, result_lines, to_long_form, write_lines,
)
from tablehaul.sources.csv import csv_lines


def texts(df):
    return [r[0] for r in df.collect()]


def test_hidden_files_are_skipped_and_gzip_is_read(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n")
    (tmp_path / "_b.txt").write_text("two\n")
    (tmp_path / ".c.txt").write_text("three\n")
    with gzip.open(tmp_path / "d.gz", "wt") as f:
        f.write("four\n")
    assert sorted(texts(read_lines(spark, str(tmp_path)))) == ["four", "one"]


def test_file_order(spark, tmp_path):
    (tmp_path / "part-00001").write_text("".join(f"b{i}\n" for i in range(500)))
    (tmp_path / "part-00000").write_text("a0\na1\n")
    (tmp_path / "00-first").write_text("h\n")
    assert texts(read_lines(spark, str(tmp_path), ordered=True)) == ["h", "a0", "a1"] + [f"b{i}" for i in range(500)]


def test_file_order_past_five_digits(spark, tmp_path):
    for number in ("99999", "100000", "00007"):
        (tmp_path / f"part-{number}-x.txt").write_text(number + "\n")
    assert texts(read_lines(spark, str(tmp_path), ordered=True)) == ["00007", "99999", "100000"]


def test_several_inputs_and_globs(spark, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "f").write_text(d + "\n")
    assert sorted(texts(read_lines(spark, [str(tmp_path / "x"), str(tmp_path / "y")]))) == ["x", "y"]
    assert sorted(texts(read_lines(spark, str(tmp_path / "*" / "f")))) == ["x", "y"]


def test_append_and_overwrite(spark, tmp_path, lines):
    path = str(tmp_path / "out")
    write_lines(lines("a"), path)
    write_lines(lines("b"), path, mode="append")
    assert sorted(texts(read_lines(spark, path))) == ["a", "b"]
    write_lines(lines("c"), path)
    assert texts(read_lines(spark, path)) == ["c"]


def test_sequence_file(spark, tmp_path):
    path = str(tmp_path / "seq")
    spark.sparkContext.parallelize([("k", 1), ("l", 2)], 1).saveAsSequenceFile(path)
    assert sorted(texts(read_sequence_lines(spark, path))) == ["k\t1", "l\t2"]


def test_line_record(lines):
    df = lines("1\thamer\ttool").select(line_record("value", {"hamer": "hammer"}))
    assert df.first()[0] == ["1", "hammer", "tool"]


ROWS = [(1, 'a"b', "x,y"), (2, "", None), (None, None, "p\\q"), (4, "l\nm", " s ")]


@pytest.mark.parametrize(
    "options",
    [
        {}, {"sep": "|"}, {"quoteAll": True}, {"nullValue": "NIL"}, {"escape": '"'}, {"quote": "'"},
        {"escapeQuotes": False}, {"sep": ";", "quoteAll": True, "nullValue": "-"},
    ],
)
def test_csv_text_equals_the_csv_writer(spark, tmp_path, options):
    df = spark.createDataFrame(ROWS, "i int, s string, t string").selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:01' w", "date'2024-01-02' d", "1.50BD c", "2e10d e"
    )
    df.coalesce(1).write.csv(str(tmp_path / "a"), **options)
    want = "".join(p.read_text() for p in (tmp_path / "a").glob("part-*"))
    got = "".join(t + "\n" for t in texts(csv_lines(df.coalesce(1), options)))
    assert got == want


def test_csv_extract_chain_with_one_header(spark, tmp_path):
    numbers = spark.range(20).selectExpr("id a", "id * 2 b", "id c", "date'2024-01-01' d")
    numbers.repartition(3).createOrReplaceTempView("ex")
    path = tmp_path / "out"
    extract_csv(spark, str(path), "ex", select=["a", "b", "c", "string(d)"], drop=["a", "b"], where="a < 10",
                limit=100, header=True)
    rows = "".join(p.read_text() for p in sorted(path.glob("part-*"))).splitlines()
    assert rows[0] == "c,d" and sorted(rows[1:]) == sorted(f"{i},2024-01-01" for i in range(10))
    with pytest.raises(Exception, match="already exists"):
        extract_csv(spark, str(path), "ex", mode="error")


def test_csv_of_nested_and_single_null_columns(spark, tmp_path):
    df = spark.sql("select array(1,null) a, map('k',1) m, named_struct('x',1,'y','z') s, cast(null as array<int>) n")
    assert texts(csv_lines(df, {})) == ['"1,\\\\N",k:1,"1,z",']
    one = spark.createDataFrame([(None,), ("x",)], "s string")
    assert texts(csv_lines(one, {}, header=True)) == ["s", "", "x"]
    assert texts(csv_lines(one, {"nullValue": "-"})) == ["-", "x"]
    assert texts(csv_lines(spark.sql("select 1 `a,b`, 2 `a,b`"), {}, header=True)) == ['"a,b","a,b"', "1,2"]


def test_separated_formats(spark):
    df = spark.sql("select 1 a, 'x' b, cast(null as string) c, array(1,2) d, map('k',true) e")
    assert texts(result_lines(df)) == ['1\tx\tNULL\t[1,2]\t{"k":true}']
    assert texts(result_lines(df.select("a", "b"), "csv2", header=True)) == ["a,b", "1,x"]
    assert texts(result_lines(df.select("a", "b"), "dsv")) == ["1|x"]
    assert texts(result_lines(df.select("a", "b"), "dsv", sep=";", header=True)) == ["a;b", "1;x"]
    assert texts(result_lines(df.select("a", "c"), "csv", header=True)) == ["'a','c'", "'1','NULL'"]
    assert texts(result_lines(df.select("a", "b"), "tsv")) == ["'1'\t'x'"]
    with pytest.raises(ValueError, match="unknown format"):
        result_lines(df, "table")


def test_markup_formats(spark):
    df = spark.sql("""select 1 a, '<b & "c">' b""")
    assert texts(result_lines(df, "xmlattr")) == [
        "<resultset>", '<result a="1" b="&lt;b &amp; &quot;c&quot;&gt;"/>', "</resultset>",
    ]
    assert texts(result_lines(df, "xmlelements")) == [
        "<resultset>", "<result><a>1</a><b>&lt;b &amp; &quot;c&quot;&gt;</b></result>", "</resultset>",
    ]


def test_markup_is_read_by_an_xml_parser(spark, tmp_path):
    import xml.etree.ElementTree as ET

    df = spark.sql("""select 1 a, '<b & "c">' b union all select 2, 'é' """)
    for format in ("xmlattr", "xmlelements"):
        path = tmp_path / format
        write_lines(result_lines(df, format), str(path))
        root = ET.fromstring("".join(p.read_text() for p in sorted(path.glob("part-*"))))
        found = [r.attrib or {c.tag: c.text for c in r} for r in root]
        assert found == [{"a": "1", "b": '<b & "c">'}, {"a": "2", "b": "é"}]


def test_long_form(spark):
    df = spark.sql("select 1 id, 2 a, cast(null as int) b")
    assert sorted(map(tuple, to_long_form(df, ["id"]).collect())) == [(1, "a", "2"), (1, "b", None)]


def test_markup_of_numbers_and_times_is_their_text(spark):
    row = spark.sql(
        "SELECT -1.5D AS d, double('NaN') AS x, 1.50BD AS m, true AS b, date'2020-01-02' AS day, timestamp_ntz'2020-01-02 03:04:05' AS at, "
        "CAST(NULL AS INT) AS n, '<&>' AS t, array('<') AS a"
    )
    expected = (
        '<result d="-1.5" x="NaN" m="1.50" b="true" day="2020-01-02" at="2020-01-02 03:04:05" n="NULL" t="&lt;&amp;&gt;" a="[&quot;&lt;&quot;]"/>'
    )
    assert [r.value for r in result_lines(row, "xmlattr").collect()][1:-1] == [expected]
