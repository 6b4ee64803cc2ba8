"""Parsing and formatting of delimited text."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from tablehaul import dump, format_lines, parse_lines, read_delimited, read_lines


def parsed(lines, texts, ddl, **options):
    return [r[0] for r in parse_lines(lines(*texts), f"x {ddl}", **options).collect()]


GOLDEN = {
    "int": [
        (r"\N", None), ("", None), ("x", None), ("99999999999", None), ("+3", 3), ("-0", 0), (" 7 ", None),
        ("7 ", None), ("1.5", 1), ("-1.9", -1), ("1.", 1), ("1.x", None), ("1e3", None), (" 1.5", None),
        ("5\u2028", None), ("007", 7), ("0000000000000000000000012", 12),
    ],
    "tinyint": [("127", 127), ("128", None), ("128.5", None)],
    "bigint": [("9223372036854775807", 9223372036854775807), ("9223372036854775808", None)],
    "string": [("", ""), (r"\N", None), (r"\\N", r"\\N"), (" a ", " a "), (r"a\nb", r"a\nb")],
    "double": [("1e3", 1000.0), (" 2.5", 2.5), ("", None), ("x", None)],
    "boolean": [("TRUE", True), ("false", False), ("t", None), ("1", None), ("yes", None)],
    "decimal(5,2)": [
        ("1.239", Decimal("1.24")), ("99999", None), ("", None), (" 1.2 ", None), ("1.2", Decimal("1.20")),
    ],
    "date": [
        ("2024-01-01", date(2024, 1, 1)), ("2024-1-1", date(2024, 1, 1)), ("x", None), ("2024", None),
        ("2024-01-01 10:00:00", None),
    ],
    "timestamp_ntz": [
        ("2024-01-01 00:00:00.5", datetime(2024, 1, 1, 0, 0, 0, 500000)), ("2024-01-01", None),
        ("2024-01-01T00:00:00", None), ("2024-01-01 00:00:00", datetime(2024, 1, 1)),
    ],
    "array<int>": [("1,x,,3", [1, None, None, 3]), ("", []), (",", [None, None]), (r"\N", None)],
    "array<string>": [("a,,b", ["a", "", "b"]), (r"a,\N", ["a", None]), ("", [])],
    "map<string,int>": [
        ("a:1,a:2", {"a": 1}), ("a", {"a": None}), ("", {}), (":5", {"": 5}), ("a:b:c", {"a": None}),
        (r"\N", None), (r"m:\N", {"m": None}), (r"\N:1,b:2", {"b": 2}),
    ],
    "map<int,string>": [("1:a:b,x:c,1:d", {1: "a:b"})],
    "struct<a:int,b:string>": [
        ("1,q", (1, "q")), ("1", (1, None)), ("1,q,z", (1, "q")), ("", (None, None)), (r"\N", None),
    ],
    "array<array<int>>": [("1:2,3", [[1, 2], [3]])],
    "array<map<string,int>>": [("a\x041:b\x042,c\x043", [{"a": 1, "b": 2}, {"c": 3}])],
    "map<string,array<int>>": [("a:1\x042,b:3", {"a": [1, 2], "b": [3]})],
    "varchar(2)": [("abc", "ab")],
    "binary": [("YWI=", bytearray(b"ab"))],
}


@pytest.mark.parametrize("ddl", GOLDEN)
def test_scalar_and_nested_rules(lines, ddl):
    texts, values = zip(*GOLDEN[ddl], strict=True)
    assert parsed(lines, texts, ddl) == list(values)


def test_nan(lines):
    assert str(parsed(lines, ["NaN"], "double")[0]) == "nan"


EDGE = [
    "id\tname\tarr\tm", "1\tann\tx,y\tk:1,j:2", "2\t\\N\t\\N\t\\N", "3\t\t\t", "zz\tbad\tx\tk", "4\tshort",
    "5\ta\tb\tc:1\textra",
]
EDGE_ROWS = [
    (1, "ann", ["x", "y"], {"k": 1, "j": 2}), (2, None, None, None), (3, "", [], {}),
    (None, "bad", ["x"], {"k": None}), (4, "short", None, None), (5, "a", ["b"], {"c": 1}),
]
EDGE_DDL = "id int, name string, arr array<string>, m map<string,int>"


def test_header_is_left_out_of_each_file(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(EDGE) + "\n")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "_hidden.txt").write_text("9\tx\n")
    rows = read_delimited(spark, str(tmp_path), EDGE_DDL, header=True).collect()
    assert sorted(map(repr, rows)) == sorted(repr(r) for r in spark.createDataFrame(EDGE_ROWS * 2, EDGE_DDL).collect())


@pytest.mark.parametrize("split_bytes", ["64", "1000", "128MB"])
def test_header_with_many_splits_and_blank_lines(spark, tmp_path, split_bytes):
    for i in range(5):
        body = "".join(f"{i}-{j}\n" + ("\n" if j % 7 == 0 else "") for j in range(i * 20))
        (tmp_path / f"f{i}.txt").write_text(f"{i}-0\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = sorted(r[0] for r in read_delimited(spark, str(tmp_path), "x string", header=True).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [f"{i}-{j}" for i in range(5) for j in range(i * 20)] + [""] * sum(
        1 for i in range(5) for j in range(i * 20) if j % 7 == 0
    )
    assert got == sorted(want)


def test_header_that_is_a_blank_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n1\n")
    assert [r.x for r in read_delimited(spark, str(tmp_path), "x int", header=True).collect()] == [1]


@pytest.mark.parametrize("sep", ["|", ".", "$", "\\001", r"\t", "||", "a", ";"])
def test_separator_is_taken_literally(spark, lines, sep):
    df = spark.createDataFrame([(1, "x y"), (2, None)], "i int, s string")
    text = format_lines(df, sep=sep)
    assert parse_lines(text, "i int, s string", sep=sep).collect() == df.collect()


def test_text_of_values(spark):
    df = spark.sql(
        "select true a, cast(1.5 as decimal(5,2)) b, timestamp_ntz'2024-01-01 10:00:00' c, 1e10d d, "
        "array(array(1,2),array(3)) e, map('k',cast(null as int)) f, named_struct('a',1,'b','q') g, "
        "cast(null as string) h, array('x',null) i, cast(null as array<int>) j, cast('ab' as binary) k"
    )
    line = format_lines(df).first()[0]
    assert line == "true\t1.50\t2024-01-01 10:00:00\t1.0E10\t1:2,3\tk:\\N\t1,q\t\\N\tx,\\N\t\\N\tYWI="


def test_repeated_column_names(spark):
    df = spark.sql("select 1 a, 2 a")
    assert [r[0] for r in format_lines(df, header=True).collect()] == ["a\ta", "1\t2"]


def test_dump_order_and_header_once(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(1000).selectExpr("id", "id % 7 k").repartition(4).createOrReplaceTempView("numbers")
    dump(spark, "select k, id from numbers order by k desc, id", path, header=True)
    files = sorted(p for p in (tmp_path / "out").glob("part-*"))
    text = "".join(p.read_text() for p in files).splitlines()
    assert text[0] == "k\tid" and len(text) == 1001
    assert text[1:] == [f"{k}\t{i}" for k in range(6, -1, -1) for i in range(1000) if i % 7 == k]
    assert [r[0] for r in read_lines(spark, path, ordered=True).collect()] == text
    back = read_delimited(spark, path, "k int, id int", header="dataset")
    assert back.count() == 1000 and back.where("id is null").count() == 0


def test_dump_of_one_partition_keeps_one_header(spark, tmp_path):
    path = str(tmp_path / "out")
    dump(spark, "select id from range(10) limit 3", path, header=True, compression="gzip")
    assert [r[0] for r in read_lines(spark, path, ordered=True).collect()] == ["id", "0", "1", "2"]
    assert read_delimited(spark, path, "id int", header="dataset").count() == 3


NASTY = ["a\tb", "x\ny", "\r", "\\N", "\\", "\\n", "\\\\n", "a,b:c", "\\t\t\\0", "", "plain", "é\x04\u2028", "\\\t"]


# A list of one NULL reads back as NULL and a list of one empty text as an empty list: the format has one
# spelling for both, so the lists here start with a plain item.
@pytest.mark.parametrize("seed", range(3))
def test_escaped_round_trip(spark, tmp_path, seed):
    rnd = random.Random(seed)

    def word():
        return rnd.choice([None, *NASTY, "".join(rnd.choice("ab\\\t\n,:N0n") for _ in range(8))])

    rows = [
        (rnd.choice([None, i]), word(), ["-", *[word() for _ in range(rnd.randint(0, 3))]],
         {f"{word()}{j}": word() for j in range(rnd.randint(0, 3))}, (word(), rnd.random()),
         rnd.choice([None, datetime(2024, 1, 1, 1, 2, 3, i)]))
        for i in range(60)
    ]
    ddl = "i int, s string, a array<string>, m map<string,string>, t struct<p:string,q:double>, w timestamp_ntz"
    df = spark.createDataFrame(rows, ddl)
    path = str(tmp_path / "out")
    dump(spark, df, path, on_conflict="escape")
    back = read_delimited(spark, path, ddl, escaped=True)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_plain_round_trip_at_random(spark, tmp_path):
    df = spark.range(500).selectExpr(
        "id", "id / 7 d", "cast(id / 3 as float) f", "if(id % 3 = 0, null, md5(string(id))) s",
        "array(id / 9, null) a", "map(md5(string(id)), id) m", "date_add(date'2024-01-01', int(id)) day",
        "id % 2 = 0 b", "cast(id / 8 as decimal(10,3)) c",
    )
    path = str(tmp_path / "out")
    dump(spark, df, path, sep="|", csep=";", ksep="=")
    back = read_delimited(spark, path, df.schema, sep="|", csep=";", ksep="=")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_conflict_policy(spark, lines):
    df = spark.createDataFrame([("a\tb",)], "s string")
    assert format_lines(df).first()[0] == "a\tb"
    assert format_lines(df, on_conflict="escape").first()[0] == "a\\0b"
    with pytest.raises(Exception, match="holds a separator"):
        format_lines(df, on_conflict="error").collect()
    nested = spark.createDataFrame([(["a,b"],)], "s array<string>")
    with pytest.raises(Exception, match="holds a separator"):
        format_lines(nested, on_conflict="error").collect()
    fine = spark.createDataFrame([("a,b", ["x"], None)], "s string, a array<string>, n string")
    assert format_lines(fine, on_conflict="error").count() == 1
    assert format_lines(fine, on_conflict="error").collect()[0][0] == "a,b\tx\t\\N"
    with pytest.raises(ValueError):
        format_lines(df, on_conflict="maybe")
    with pytest.raises(ValueError, match="escape code"):
        format_lines(df, sep="n", on_conflict="escape")
    with pytest.raises(TypeError):
        parse_lines(lines("x"), "i interval day")


def test_wide_rows(spark):
    ddl = ", ".join(f"k{i} {('int', 'string', 'double', 'array<int>')[i % 4]}" for i in range(60))
    values = tuple((i, f"s{i}", i / 8, [i, None])[i % 4] for i in range(60))
    df = spark.createDataFrame([values, (None,) * 60], ddl)
    assert parse_lines(format_lines(df), ddl).collect() == df.collect()


def test_codes_only_for_the_levels_around_a_value(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' t, 'a:b,c' s, array('d:e,f') a, map('k:', 'v:,') m")
    line = format_lines(df, on_conflict="escape").first()[0]
    assert line == "2024-01-01 10:00:00\ta:b,c\td:e\\1f\tk\\2:v\\2\\1"


def test_parse_stays_in_the_jvm(lines):
    plan = parse_lines(lines("1"), "a int, b map<string,int>")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
