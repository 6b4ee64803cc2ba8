"""Registered queries over the given tables, each beside the SQL that gives the same rows.

``REGISTRY`` maps a name to (query, oracle SQL). A query takes the session and the folder of the tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehaul.functions.columns import column_list
from tablehaul.functions.text import line_record, tokenize
from tablehaul.operators.aggregate import reduce_by_key
from tablehaul.operators.aggregate import word_count as count_words
from tablehaul.operators.extract import extract, result_columns
from tablehaul.operators.runs import run_sum
from tablehaul.operators.stats import table_properties as properties_of
from tablehaul.operators.stats import table_stats as stats_of
from tablehaul.plans.script import run_script
from tablehaul.plans.script import sql as sql_lines
from tablehaul.sources.csv import extract_csv
from tablehaul.sources.delimited import dump, format_lines, parse_lines, read_delimited
from tablehaul.sources.formats import result_lines, to_long_form
from tablehaul.sources.lines import numbered_lines, positioned_lines, read_lines, write_lines
from tablehaul.sources.scratch import scratch_path
from tablehaul.sources.tables import load_partition, load_table
from tablehaul.streaming.mapreduce import map_reduce, named
from tablehaul.streaming.pipes import batched, pipe_from, pipe_into
from tablehaul.streaming.stages import sum_adjacent, words

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def registered(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        REGISTRY[query.__name__] = (query, oracle)
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- relational -----------------------------------------------------------------------------------


@registered("SELECT * FROM nation")
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "nation").createOrReplaceTempView("tablehaul_nation")
    return extract(spark, "tablehaul_nation")


@registered("""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice < 400000
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def extract_chain(spark: SparkSession, folder: str) -> DataFrame:
    return extract(
        spark,
        table(spark, folder, "orders"),
        aux=lambda orders: orders.orderBy(F.desc("o_totalprice"), "o_orderkey"),
        select=["o_orderkey", "string(o_custkey) AS customer", "o_totalprice", "o_orderstatus"],
        where="o_orderstatus = 'F' AND o_totalprice < 400000",
        drop=["o_orderstatus"],
        limit=100,
    )


@registered("""
    SELECT l_orderkey, l_linenumber, l_quantity * 2 AS doubled FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'
""")
def select_where_hidden_column(spark: SparkSession, folder: str) -> DataFrame:
    return extract(
        spark,
        table(spark, folder, "lineitem"),
        select=["l_orderkey", "l_linenumber", "l_quantity * 2 AS doubled"],
        where="l_shipdate >= TIMESTAMP_NTZ '1998-01-01' AND l_returnflag = 'R'",
    )


# --- delimited text -------------------------------------------------------------------------------

ORDER_LINE = (
    "concat_ws(chr(9), o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, o_totalprice::VARCHAR, "
    "o_orderdate::VARCHAR, o_orderpriority)"
)


@registered(f"SELECT {ORDER_LINE} AS value FROM orders")
def dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dump-lines")
    dump(spark, table(spark, folder, "orders"), path)
    return read_lines(spark, path)


@registered(f"""
    SELECT concat_ws(chr(9), 'o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
        'o_orderpriority') AS value
    UNION ALL SELECT {ORDER_LINE} FROM orders
""")
def dump_header_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dump-header")
    dump(spark, table(spark, folder, "orders"), path, header=True)
    return read_lines(spark, path)


@registered("SELECT * FROM orders")
def dump_header_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "header-round-trip")
    orders = table(spark, folder, "orders")
    dump(spark, orders, path, sep="|", header=True, compression="gzip")
    return read_delimited(spark, path, column_list(orders), sep="|", header="dataset")


@registered("SELECT * FROM orders")
def header_in_every_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "file-headers")
    orders = table(spark, folder, "orders")
    written = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    finished = F.col("o_orderstatus").eqNullSafe("F")
    for rows in (written.where(finished), written.where(~finished)):
        rows.write.mode("append").csv(path, sep="\t", header=True)
    return read_delimited(spark, path, column_list(orders), header=True)


@registered("SELECT * FROM lineitem")
def delimited_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "round-trip")
    lineitem = table(spark, folder, "lineitem")
    dump(spark, lineitem, path)
    return read_delimited(spark, path, lineitem.schema)


_NESTED_ITEMS = """
    unnest([
        struct_pack(name := 'id 0', item := l_partkey::VARCHAR), struct_pack(name := 'id 1', item := l_suppkey::VARCHAR),
        struct_pack(name := 'id 2', item := NULL), struct_pack(name := 'tag 0 0', item := 'x'),
        struct_pack(name := 'tag 0 1', item := l_linestatus), struct_pack(name := 'tag 1 0', item := l_returnflag)]) AS cell
"""


@registered(f"""
    SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_discount AS discount, CAST(2 AS INTEGER) AS amounts,
        l_returnflag AS flag, l_shipdate AS shipped, cell.name AS name, cell.item AS item
    FROM (SELECT *, {_NESTED_ITEMS} FROM lineitem)
""")
def delimited_nested_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every item of every nested value, a row for each item of the arrays."""
    path = scratch_path(spark, "nested-round-trip")
    nested = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "array(l_partkey, l_suppkey, NULL) AS ids",
        "map('quantity', l_quantity, 'discount', l_discount) AS amounts",
        "struct(l_returnflag AS flag, l_shipdate AS shipped) AS state",
        "array(array('x', l_linestatus), array(l_returnflag)) AS tags",
    )
    dump(spark, nested, path, sep="|", csep=";", ksep="=")
    back = read_delimited(spark, path, nested.schema, sep="|", csep=";", ksep="=")
    # Single values are taken out before rows multiply, and items are exploded as plain texts and named afterwards.
    flat = back.selectExpr(
        "l_orderkey", "l_linenumber", "amounts['quantity'] AS quantity", "amounts['discount'] AS discount",
        "size(amounts) AS amounts", "state.flag AS flag", "state.shipped AS shipped", "ids", "tags",
    )
    kept = flat.columns[:-2]
    # Not a column of its own: Spark would filter by such a one first, and parse all lines twice.
    lists = "CASE WHEN ids IS NOT NULL AND flatten(tags) IS NOT NULL THEN concat(array(CAST(ids AS array<string>)), tags) END"
    rows = flat.selectExpr(*kept, f"posexplode({lists}) AS (list, items)").selectExpr(*kept, "list", "posexplode(items) AS (i, item)")
    return rows.selectExpr(*kept, "CASE WHEN list = 0 THEN concat('id ', i) ELSE concat('tag ', list - 1, ' ', i) END AS name", "item")


@registered("""
    SELECT vec_id, label, CAST(pos - 1 AS INTEGER) AS pos, CAST(embedding[pos] AS DOUBLE) AS item
    FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
""")
def delimited_array_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "array-round-trip")
    embeddings = table(spark, folder, "embeddings")
    dump(spark, embeddings, path)
    back = read_delimited(spark, path, embeddings.schema)
    items = back.select("vec_id", "label", F.posexplode("embedding").alias("pos", "item"))
    return items.withColumn("item", F.col("item").cast("double"))


@registered("SELECT * FROM documents")
def delimited_escaped_texts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "escaped")
    documents = table(spark, folder, "documents")
    dump(spark, documents, path, on_conflict="escape")
    return read_delimited(spark, path, documents.schema, escaped=True)


@registered("""
    SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, lines[pos] AS line, url
    FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT page_id, url, string_split(html, chr(10)) AS lines FROM pages))
""")
def delimited_text_lists(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "text-lists")
    lists = table(spark, folder, "pages").selectExpr("page_id", "split(html, '\\n') AS html_lines", "url")
    dump(spark, lists, path, on_conflict="escape")
    back = read_delimited(spark, path, lists.schema, escaped=True)
    return back.select("page_id", F.posexplode("html_lines").alias("pos", "line"), "url")


@registered("""
    SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS whole_price,
        CASE WHEN o_orderkey <= 127 THEN CAST(o_orderkey AS TINYINT) END AS small_key,
        TRY_CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18, 2)) AS DECIMAL(6, 1)) AS short_price,
        CAST(NULL AS INTEGER) AS priority, CAST(NULL AS DATE) AS day, o_orderdate AS moment,
        o_custkey % 2 = 0 AS even, CAST(NULL AS BOOLEAN) AS status, CAST(NULL AS INTEGER) AS padded
    FROM orders
""")
def delimited_guarded_values(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that the declared type does not fit: cut, rounded or NULL by the rules of the format."""
    texts = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS a", "o_orderkey AS b", "o_totalprice AS c", "o_orderpriority AS d",
        "o_orderdate AS e", "o_orderdate AS f", "upper(string(o_custkey % 2 = 0)) AS g", "o_orderstatus AS h",
        "concat(' ', o_custkey, ' ') AS i",
    )
    return parse_lines(
        format_lines(texts),
        "o_orderkey bigint, whole_price int, small_key tinyint, short_price decimal(6,1), priority int, day date, "
        "moment timestamp_ntz, even boolean, status boolean, padded int",
    )


# --- tables ---------------------------------------------------------------------------------------


@registered("SELECT c_custkey, c_name, c_acctbal, rpad(c_mktsegment, 10, ' ') AS c_mktsegment FROM customer")
def load_table_customers(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customers-text")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    dump(spark, customers, path, header=True)
    return load_table(
        spark, path, "tablehaul_customers",
        "c_custkey bigint, c_name varchar(30) COMMENT 'as registered', c_acctbal double, c_mktsegment char(10)",
        header="dataset", location=scratch_path(spark, "customers-table"),
    )


@registered("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, o_totalprice * 2, 'F' FROM orders WHERE o_orderstatus = 'O'
""")
def load_partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    name, path = "tablehaul_orders", scratch_path(spark, "partition-text")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    target = scratch_path(spark, "partitioned-table")
    orders.write.partitionBy("o_orderstatus").option("path", target).saveAsTable(name)
    dump(spark, orders.where("o_orderstatus = 'O'").selectExpr("o_orderkey", "o_totalprice * 2"), path)
    return load_partition(spark, path, name, {"o_orderstatus": "F"})


@registered("""
    SELECT column_name, row_count, null_count, min_value, max_value FROM (
        SELECT 'o_orderkey' AS column_name, count(*) AS row_count, count(*) - count(o_orderkey) AS null_count,
            min(o_orderkey)::VARCHAR AS min_value, max(o_orderkey)::VARCHAR AS max_value FROM orders
        UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), min(o_custkey)::VARCHAR,
            max(o_custkey)::VARCHAR FROM orders
        UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus),
            max(o_orderstatus) FROM orders
        UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice), min(o_totalprice)::VARCHAR,
            max(o_totalprice)::VARCHAR FROM orders
        UNION ALL SELECT 'o_orderdate', count(*), count(*) - count(o_orderdate), min(o_orderdate)::VARCHAR,
            max(o_orderdate)::VARCHAR FROM orders
        UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), min(o_orderpriority),
            max(o_orderpriority) FROM orders)
""")
def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    # File and byte counts are left out: SQL over the table has no counterpart for them.
    return stats_of(table(spark, folder, "orders")).drop("file_count", "byte_count")


@registered("""
    SELECT 'value' AS column_name, count(*) AS row_count, 3::BIGINT AS file_count,
        CAST(sum(strlen(line) + 1) AS BIGINT) AS byte_count, 0::BIGINT AS null_count, min(line) AS min_value, max(line) AS max_value
    FROM (SELECT o_orderkey || chr(9) || o_orderpriority AS line FROM orders)
""")
def table_stats_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files and bytes too, of a dataset of three files written before."""
    path = scratch_path(spark, "three-files")
    lines = format_lines(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"))
    write_lines(lines.repartition(3), path)
    return stats_of(spark.read.text(path))


@registered("""
    SELECT 'rows' AS name, count(*)::VARCHAR AS text, count(*) AS number FROM supplier
    UNION ALL SELECT 'largest', max(s_suppkey)::VARCHAR, max(s_suppkey) FROM supplier
    UNION ALL SELECT 'first name', min(s_name), NULL FROM supplier
    UNION ALL SELECT 'location', 'set', NULL
""")
def table_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Properties that a load noted on its table; where it lies depends on the session."""
    name, place = "tablehaul_noted", scratch_path(spark, "noted-table")
    suppliers = table(spark, folder, "supplier")
    noted = suppliers.agg(F.count("*"), F.max("s_suppkey"), F.min("s_name")).first()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    suppliers.write.option("path", place).saveAsTable(name)
    texts = ", ".join(f"'{k}' = '{v}'" for k, v in zip(("rows", "largest", "first name"), noted, strict=True))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({texts})")
    found = properties_of(spark, name)
    is_place = (F.col("name") == "location") & F.contains("text", F.lit(place))
    return found.where(F.col("name").isin("rows", "largest", "first name", "location")).withColumn("text", F.when(is_place, "set").otherwise(F.col("text")))


@registered("""
    SELECT unnest(['o_orderkey', 'customer', 'lines', 'last_line']) AS name, unnest([0, 1, 2, 3]::BIGINT[]) AS place,
        (SELECT count(*) FROM orders) AS rows
""")
def schema_probe(spark: SparkSession, folder: str) -> DataFrame:
    """Column names of a query that isn't run, beside the number of rows that it would read."""
    table(spark, folder, "orders").createOrReplaceTempView("tablehaul_probed")
    names = result_columns(spark, """
        SELECT o.o_orderkey, o.o_custkey AS customer, count(*) OVER (PARTITION BY o.o_custkey) AS lines, 'limit 1' AS last_line
        FROM tablehaul_probed o LIMIT 10
    """)
    rows = spark.table("tablehaul_probed").agg(F.count("*").alias("rows"))
    return rows.select(F.posexplode(F.array(*map(F.lit, names))).alias("place", "name"), "rows").withColumn("place", F.col("place").cast("bigint"))


@registered("SELECT p_partkey, p_name, p_size FROM part")
def load_quoted_names(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose name needs quotes, loaded twice: the second load points it to its new rows."""
    path, name = scratch_path(spark, "quoted-text"), "default.`2_tablehaul_parts`"
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    for rows in (parts.where("p_partkey % 2 = 0"), parts):
        dump(spark, rows, path)
        load_table(spark, path, name, column_list(parts))
    return spark.table(name)


# --- lines ----------------------------------------------------------------------------------------


@registered("""
    SELECT concat(c_custkey, '|', c_name) AS value FROM customer
    UNION ALL SELECT concat(s_suppkey, '|', s_name) FROM supplier
""")
def append_output(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "append")
    dump(spark, table(spark, folder, "customer").select("c_custkey", "c_name"), path, sep="|")
    dump(spark, table(spark, folder, "supplier").select("s_suppkey", "s_name"), path, sep="|", mode="append")
    return read_lines(spark, path)


@registered("""
    SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS number,
        o_orderkey || chr(9) || o_orderpriority AS value FROM orders
""")
def ordered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a dumped ORDER BY with their numbers in file order."""
    path = scratch_path(spark, "ordered-lines")
    ordered = table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    dump(spark, ordered.select("o_orderkey", "o_orderpriority"), path)
    return numbered_lines(spark, path)


@registered("""
    SELECT row_number() OVER (ORDER BY batch, k) AS number, value FROM (
        SELECT 0 AS batch, 0 AS k, 'c_custkey|c_name' AS value
        UNION ALL SELECT 1, c_custkey, c_custkey || '|' || c_name FROM customer
        UNION ALL SELECT 2, s_suppkey, s_suppkey || '|' || s_name FROM supplier
        UNION ALL SELECT 3, p_partkey, p_partkey || '|' || p_name FROM part)
""")
def append_keeps_order(spark: SparkSession, folder: str) -> DataFrame:
    """Appended lines come after those that were there, with one header for all."""
    path = scratch_path(spark, "append-order")
    for name, key, text in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name")):
        mode = "overwrite" if name == "customer" else "append"
        dump(spark, table(spark, folder, name).orderBy(key).select(key, text), path, sep="|", header=True, mode=mode)
    return numbered_lines(spark, path)


@registered("""
    SELECT concat(c_custkey, chr(9), c_name) AS value FROM customer
    UNION ALL SELECT concat(s_suppkey, chr(9), s_name) FROM supplier
    UNION ALL SELECT concat(p_partkey, chr(9), p_name) FROM part
""")
def multi_input_lines(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "inputs")
    for name, columns in {
        "customer": ["c_custkey", "c_name"], "supplier": ["s_suppkey", "s_name"], "part": ["p_partkey", "p_name"],
    }.items():
        dump(spark, table(spark, folder, name).select(*columns), f"{base}/{name}")
    return map_reduce(spark, [f"{base}/customer", f"{base}/supp*", f"{base}/part"], reduce_tasks=0)


@registered("""
    SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(sum(o_orderkey) AS BIGINT) AS total, count(*) AS rows
    FROM orders GROUP BY o_custkey
""")
def dump_keeps_query_order(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in file order carry the order of the query: keys it sorted are adjacent, one run for each."""
    path = scratch_path(spark, "ordered")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    dump(spark, orders.orderBy("o_custkey", "o_orderkey"), path)
    lines = positioned_lines(spark, path).withColumn("fields", line_record("value"))
    keyed = lines.selectExpr("file", "block", "row", "fields[0] AS customer", "fields[1] AS number")
    return run_sum(keyed, "customer", "number", ["file", "block", "row"]).select("customer", "total", "rows")


@registered("""
    SELECT CAST(rec[1] AS BIGINT) AS p_partkey, rec[2] AS p_name, rec[3] AS p_type
    FROM (SELECT string_split(replace(concat_ws(chr(9), p_partkey::VARCHAR, p_name, p_type), 'widget', 'gadget'),
        chr(9)) AS rec FROM part)
""")
def line_fix_up(spark: SparkSession, folder: str) -> DataFrame:
    lines = format_lines(table(spark, folder, "part").select("p_partkey", "p_name", "p_type"))
    record = lines.select(line_record("value", {"widget": "gadget"}).alias("rec"))
    return record.selectExpr("bigint(rec[0]) AS p_partkey", "rec[1] AS p_name", "rec[2] AS p_type")


# --- CSV and result formats -----------------------------------------------------------------------


@registered("""
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey < 10
""")
def csv_extract_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    extract_csv(
        spark, path, table(spark, folder, "customer"), select=["c_custkey", "c_name", "c_acctbal", "c_nationkey"],
        where="c_nationkey < 10", drop=["c_nationkey"], sep=";", quote_all=True, null_value="-",
    )
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").csv(path, sep=";", nullValue="-")


@registered("""
    SELECT concat_ws(',', '"event_id"', '"event_type"', '"props"') AS value
    UNION ALL SELECT concat('"', event_id, '","', event_type, '","', replace(props, '"', '""'), '"') FROM events
""")
def csv_extract_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv-lines")
    extract_csv(
        spark, path, table(spark, folder, "events"), select=["event_id", "event_type", "props"], header=True,
        quote_all=True, escape='"',
    )
    return read_lines(spark, path)


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")


def _separated(sep: str, quote: str = "") -> str:
    def joined(*items: str) -> str:
        return f" || '{sep}' || ".join(f"'{quote}' || {i} || '{quote}'" for i in items)

    sep = sep.replace("'", "''")
    quote = quote.replace("'", "''")
    titles = joined("'c_custkey'", "'c_name'", "'c_acctbal'")
    values = joined("c_custkey::VARCHAR", "coalesce(c_name, 'NULL')", "coalesce(c_acctbal::VARCHAR, 'NULL')")
    return f"SELECT {titles} AS value UNION ALL SELECT {values} FROM customer"


@registered(_separated("\t"))
def format_tsv2(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(_customers(spark, folder), "tsv2", header=True)


@registered(_separated(","))
def format_csv2(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(_customers(spark, folder), "csv2", header=True)


@registered(_separated(";"))
def format_dsv(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(_customers(spark, folder), "dsv", sep=";", header=True)


@registered(_separated("\t", "'"))
def format_tsv_quoted(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(_customers(spark, folder), "tsv", header=True)


@registered(_separated(",", "'"))
def format_csv_quoted(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(_customers(spark, folder), "csv", header=True)


_SAFE_PROPS = """replace(replace(replace(props, '&', '&amp;'), '<', '&lt;'), '"', '&quot;')"""


@registered(f"""
    SELECT '<resultset>' AS value UNION ALL SELECT '</resultset>'
    UNION ALL SELECT concat('<result event_id="', event_id, '" event_type="', event_type, '" props="',
        {_SAFE_PROPS}, '"/>') FROM events
""")
def format_xmlattr(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(table(spark, folder, "events").select("event_id", "event_type", "props"), "xmlattr")


@registered(f"""
    SELECT '<resultset>' AS value UNION ALL SELECT '</resultset>'
    UNION ALL SELECT concat('<result><event_id>', event_id, '</event_id><event_type>', event_type,
        '</event_type><props>', {_SAFE_PROPS}, '</props></result>') FROM events
""")
def format_xmlelements(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(table(spark, folder, "events").select("event_id", "event_type", "props"), "xmlelements")


@registered("""
    SELECT c_custkey, 'c_name' AS name, c_name AS value FROM customer
    UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR FROM customer
    UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal::VARCHAR FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
""")
def long_form(spark: SparkSession, folder: str) -> DataFrame:
    return to_long_form(table(spark, folder, "customer"), ["c_custkey"])


# --- scripts --------------------------------------------------------------------------------------


@registered("""
    SELECT n_name, count(*) AS customers, CAST(sum(c_custkey) AS BIGINT) AS key_sum
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_mktsegment = 'BUILDING' GROUP BY n_name
""")
def sql_script_variables(spark: SparkSession, folder: str) -> DataFrame:
    script = """
        DROP VIEW IF EXISTS {prefix}_segment;  -- made below; a semicolon in a comment ends nothing
        CREATE OR REPLACE TEMP VIEW {prefix}_segment AS
            SELECT *, 'a;  b' AS note FROM parquet.`{folder}/customer.parquet`;
        SELECT n_name, count(*) AS customers, sum(c_custkey) AS key_sum
        FROM {prefix}_segment JOIN parquet.`{folder}/nation.parquet` ON c_nationkey = n_nationkey
        WHERE c_mktsegment = :segment AND note = 'a;  b'
        GROUP BY n_name;
    """
    return run_script(spark, script, {"prefix": "tablehaul", "folder": folder}, {"segment": "BUILDING"})


@registered("""
    SELECT 'o_custkey' || chr(9) || 'orders' || chr(9) || 'last_pending' AS value
    UNION ALL SELECT o_custkey || chr(9) || count(*) || chr(9) ||
        coalesce(max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END)::VARCHAR, 'NULL')
    FROM orders GROUP BY o_custkey
""")
def sql_result_lines(spark: SparkSession, folder: str) -> DataFrame:
    script = """
        SELECT o_custkey, count(*) AS orders, max(CASE WHEN o_orderstatus = :status THEN o_orderkey END) AS last_pending
        FROM parquet.`{folder}/orders.parquet` GROUP BY o_custkey
    """
    return sql_lines(spark, script, {"folder": folder}, {"status": "P"}, header=True)


@registered("""
    SELECT n_regionkey, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey
""")
def script_with_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last query, though the statements after it drop what it reads."""
    script = """
        DROP TABLE IF EXISTS {name};
        CREATE TABLE {name} USING parquet LOCATION '{place}' AS
            SELECT n_regionkey FROM parquet.`{folder}/customer.parquet` JOIN parquet.`{folder}/nation.parquet`
            ON c_nationkey = n_nationkey; /* rows of /* nested; */ regions; */
        SELECT n_regionkey, count(*) AS customers FROM {name} GROUP BY n_regionkey;
        DROP TABLE {name};
        SET spark.sql.ansi.enabled;
    """
    place = scratch_path(spark, "script-table")
    return run_script(spark, script, {"name": "tablehaul_regions", "place": place, "folder": folder})


@registered("""
    SELECT o_orderstatus, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders
    WHERE o_totalprice > 100000 GROUP BY o_orderstatus
""")
def script_with_insert(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last query between and before inserts that begin like queries."""
    script = """
        DROP TABLE IF EXISTS {name};
        CREATE TABLE {name} (status STRING, customer BIGINT) USING parquet LOCATION '{place}';
        WITH dear AS (SELECT * FROM parquet.`{folder}/orders.parquet` WHERE o_totalprice > :least)
            INSERT INTO {name} SELECT o_orderstatus, o_custkey FROM dear;
        SELECT status AS o_orderstatus, count(*) AS orders, sum(customer) AS customers FROM {name} GROUP BY status;
        FROM {name} INSERT INTO {name} SELECT 'late', 1;
        WITH none AS (SELECT 'later' AS s) INSERT INTO {name} SELECT s, 2 FROM none;
    """
    return run_script(spark, script, {"name": "tablehaul_inserts", "place": scratch_path(spark, "inserts"), "folder": folder}, {"least": 100000})


@registered("""
    SELECT '<resultset>' AS value UNION ALL SELECT '</resultset>'
    UNION ALL SELECT concat('<result><doc_id>', doc_id, '</doc_id><text>',
        replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'),
            chr(9), '&#9;'), chr(10), '&#10;'), chr(13), '&#13;'), '</text></result>') FROM documents
""")
def xml_documents(spark: SparkSession, folder: str) -> DataFrame:
    return result_lines(table(spark, folder, "documents").select("doc_id", "text"), "xmlelements")


# --- pipes ----------------------------------------------------------------------------------------


@registered("""
    SELECT concat(event_id, chr(9), event_type, chr(9), props) AS value FROM events
    WHERE contains(concat(event_id, chr(9), event_type, chr(9), props), 'error')
""")
def pipe_filter(spark: SparkSession, folder: str) -> DataFrame:
    lines = format_lines(table(spark, folder, "events").select("event_id", "event_type", "props"))
    return pipe_from(lines, "grep -F error", ok_codes=(0, 1))


@registered("SELECT upper(concat(p_partkey, chr(9), p_name, chr(9), p_type)) AS value FROM part")
def pipe_into_dataset(spark: SparkSession, folder: str) -> DataFrame:
    source, path = scratch_path(spark, "pipe-source"), scratch_path(spark, "pipe-target")
    write_lines(format_lines(table(spark, folder, "part").select("p_partkey", "p_name", "p_type")), source)
    pipe_into(read_lines(spark, source), "tr a-z A-Z", path)
    return read_lines(spark, path)


# --- map, combine, reduce -------------------------------------------------------------------------


def sum_adjacent_keys(lines: Iterator[str]) -> Iterable[str]:
    pairs = (line.split("\t")[:2] for line in lines)
    for key, run in groupby(pairs, key=lambda pair: pair[0]):
        yield f"{key}\t{sum(int(number) for _, number in run)}"


def _key_value(lines: DataFrame, key: str, value: str) -> DataFrame:
    return lines.select(
        F.substring_index("value", "\t", 1).alias(key),
        F.get(F.split("value", "\t"), F.lit(1)).cast("bigint").alias(value),
    )


WORDS_SQL = r"regexp_extract_all(text, '[\p{L}\p{N}_]+')"


@registered(f"""
    SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, words[pos] AS word
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos
        FROM (SELECT doc_id, {WORDS_SQL} AS words FROM documents))
""")
def tokenize_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.posexplode(tokenize("text")).alias("pos", "word"))


WORD_COUNT_SQL = f"SELECT word, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS word FROM documents) GROUP BY word"


@registered(WORD_COUNT_SQL)
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_words(table(spark, folder, "documents"), "text")


@registered(WORD_COUNT_SQL)
def word_count_job(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("text")
    counted = map_reduce(spark, texts, mapper=words, reducer=sum_adjacent, combiner=True)
    return _key_value(counted, "word", "n")


@registered(f"SELECT concat(role, chr(9), len({WORDS_SQL})) AS value FROM conversations")
def map_only(spark: SparkSession, folder: str) -> DataFrame:
    def count_per_line(lines: Iterator[str]) -> Iterable[str]:
        for line in lines:
            role, text = line.split("\t", 1)
            yield f"{role}\t{len(re.findall(r'\w+', text))}"

    turns = table(spark, folder, "conversations").select(F.concat_ws("\t", "role", "text").alias("value"))
    return map_reduce(spark, turns, mapper=count_per_line, reduce_tasks=0)


@registered("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def map_combine_reduce_events(spark: SparkSession, folder: str) -> DataFrame:
    @batched
    def one_per_event(batches):
        for lines in batches:
            event_types = pc.list_element(pc.split_pattern(lines, "\t", max_splits=1), 0)
            yield pc.binary_join_element_wise(event_types, "1", "\t")

    out = scratch_path(spark, "event-counts")
    events = format_lines(table(spark, folder, "events").select("event_type", "props"))
    counted = map_reduce(spark, events, out, one_per_event, sum_adjacent_keys, combiner=True, reduce_tasks=3)
    return _key_value(counted, "event_type", "n")


SUM_COMMAND = (
    r"""awk -F '\t' 'NR > 1 && $1 != key {printf "%s\t%.0f\n", key, total; total = 0} """
    r"""{key = $1; total += $2} END {if (NR) printf "%s\t%.0f\n", key, total}'"""
)


@registered("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def map_reduce_command(spark: SparkSession, folder: str) -> DataFrame:
    events = format_lines(table(spark, folder, "events").select("event_type", "event_id"))
    counted = map_reduce(
        spark, events, mapper=r"""awk -F '\t' '{print $1 "\t1"}'""", reducer=SUM_COMMAND, combiner=True, reduce_tasks=3
    )
    return _key_value(counted, "event_type", "n")


@registered("""
    SELECT concat(event_type, chr(9), event_id, chr(9), props) AS value,
        dense_rank() OVER (ORDER BY event_type) AS key_number FROM events
""")
def sort_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted lines, each with the number of its key as file order has it."""
    events = format_lines(table(spark, folder, "events").select("event_type", "event_id", "props"))
    path = scratch_path(spark, "sorted-lines")
    map_reduce(spark, events, path, reduce_tasks=4)
    lines = numbered_lines(spark, path).withColumn("key", F.substring_index("value", "\t", 1))
    # Keys are few, their lines many: each key's first line says where it stands.
    starts = lines.groupBy("key").agg(F.min("number").alias("start"))
    keys = starts.withColumn("key_number", F.row_number().over(Window.orderBy("start")).cast("bigint"))
    return lines.join(keys.select("key", "key_number"), "key").select("value", "key_number")


@registered("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def combine_only(spark: SparkSession, folder: str) -> DataFrame:
    """A combiner without a reducer leaves a line for each key and map partition."""
    @batched
    def one_per_event(batches):
        for lines in batches:
            event_types = pc.list_element(pc.split_pattern(lines, "\t", max_splits=1), 0)
            yield pc.binary_join_element_wise(event_types, "1", "\t")

    events = format_lines(table(spark, folder, "events").select("event_type", "props"))
    combined = map_reduce(spark, events, mapper=one_per_event, combiner=sum_adjacent)
    return _key_value(combined, "event_type", "n").groupBy("event_type").agg(F.sum("n").alias("n"))


@registered("SELECT upper(concat(p_partkey, chr(9), p_name)) AS value, 3::BIGINT AS tasks FROM part")
def map_tasks_hint(spark: SparkSession, folder: str) -> DataFrame:
    """Lines through three mappers, each line with the number of mappers that had lines."""
    source = scratch_path(spark, "hinted")
    write_lines(format_lines(table(spark, folder, "part").select("p_partkey", "p_name")), source)
    shouted = map_reduce(spark, source, mapper="tr a-z A-Z", map_tasks=3).withColumn("task", F.spark_partition_id())
    tasks = shouted.agg(F.countDistinct("task").alias("tasks"))
    return shouted.select("value").crossJoin(F.broadcast(tasks))  # one row


@registered("SELECT concat(s_suppkey, chr(9), s_name) AS value FROM supplier")
def output_overwritten(spark: SparkSession, folder: str) -> DataFrame:
    """The output of a job takes the place of the lines that were there."""
    path = scratch_path(spark, "overwritten")
    write_lines(format_lines(table(spark, folder, "customer")), path)
    return map_reduce(spark, format_lines(table(spark, folder, "supplier").select("s_suppkey", "s_name")), path, reduce_tasks=0)


@registered("SELECT (SELECT count(*) FROM customer) AS lines, 0::BIGINT AS output")
def reducer_without_output(spark: SparkSession, folder: str) -> DataFrame:
    """A reducer that reads its lines and gives none, beside the number of lines it got."""
    lines = format_lines(table(spark, folder, "customer").select("c_custkey", "c_name"))

    def silent(lines: Iterator[str]) -> None:
        for _ in lines:
            pass

    nothing = map_reduce(spark, lines, reducer=silent, reduce_tasks=2).agg(F.count("*").alias("output"))
    return lines.agg(F.count("*").alias("lines")).crossJoin(F.broadcast(nothing))  # one row each


@registered("""
    SELECT event_type, min(day) AS day, CAST(sum(k) AS BIGINT) AS total, count(*) AS rows
    FROM (SELECT event_type, strftime(ts, '%Y-%m') AS day, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events)
    GROUP BY event_type, day
""")
def run_sum_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of a key within a month: most rows tie in the order, which only has the month."""
    events = _event_numbers(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM"))
    return run_sum(events, "event_type", "k", ["day"], ["day"]).select("event_type", "day", "total", "rows")


@registered("""
    SELECT concat(l_suppkey, chr(9), CAST(sum(l_linenumber) AS BIGINT)) AS value FROM lineitem GROUP BY l_suppkey
""")
def map_reduce_named(spark: SparkSession, folder: str) -> DataFrame:
    lines = format_lines(table(spark, folder, "lineitem").select("l_suppkey", "l_linenumber"))
    return map_reduce(spark, lines, reducer=named("sum"))


@registered("""
    SELECT o_orderpriority AS priority, CAST(sum(CAST(o_orderkey AS HUGEINT) * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END)) AS BIGINT) AS total,
        CAST(sum(o_orderkey * (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END)) AS BIGINT) AS named_total
    FROM orders GROUP BY o_orderpriority
""")
def sum_wide_partials(spark: SparkSession, folder: str) -> DataFrame:
    """Sums that fit a bigint of numbers near its bounds: what is added up before the shuffle does not fit."""
    # Each order has 2**62 and its own number; a second line in another partition takes the 2**62 away again.
    orders = table(spark, folder, "orders").selectExpr("o_orderpriority", "o_orderkey * if(o_orderkey % 2 = 0, 1, -1) AS k")
    large = F.lit(1 << 62)
    halves = [orders.select("o_orderpriority", n.alias("n")).repartition(2) for n in (F.col("k") + large, -large)]
    lines = format_lines(halves[0].unionAll(halves[1]))
    by_stage = _key_value(map_reduce(spark, lines, reducer=sum_adjacent), "priority", "total")
    by_name = _key_value(map_reduce(spark, lines, reducer=named("sum")), "priority", "named_total")
    return by_stage.join(by_name, "priority")


@registered("""
    SELECT l_returnflag, CAST(sum(l_partkey) AS BIGINT) AS sum, min(l_partkey) AS min, max(l_partkey) AS max,
        count(l_partkey) AS count
    FROM lineitem GROUP BY l_returnflag
""")
def reduce_sum_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return reduce_by_key(
        table(spark, folder, "lineitem"), "l_returnflag", "l_partkey", ["sum", "min", "max", "count"]
    )


_RUNS_SQL = """
    WITH numbered AS (
        SELECT *, regexp_extract(props, '[0-9]+')::BIGINT AS k,
            row_number() OVER ({part} ORDER BY ts, event_id)
            - row_number() OVER (PARTITION BY {both} ORDER BY ts, event_id) AS island
        FROM events)
    SELECT {keys}, min(ts) AS ts, min(event_id) AS event_id, CAST(sum(k) AS BIGINT) AS total, count(*) AS rows
    FROM numbered GROUP BY {both}, island
"""


def _event_numbers(spark: SparkSession, folder: str) -> DataFrame:
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    return table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", k.alias("k"))


@registered(_RUNS_SQL.format(part="PARTITION BY user_id", both="user_id, event_type", keys="user_id, event_type"))
def run_sum_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return run_sum(_event_numbers(spark, folder), "event_type", "k", ["ts", "event_id"], ["user_id"])


@registered(_RUNS_SQL.format(part="", both="event_type", keys="event_type"))
def run_sum_overall(spark: SparkSession, folder: str) -> DataFrame:
    return run_sum(_event_numbers(spark, folder), "event_type", "k", ["ts", "event_id"])
