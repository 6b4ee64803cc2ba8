"""SQL scripts: variables, statements, results as rows or text."""

from __future__ import annotations

import re
from collections.abc import Mapping

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.sources.formats import result_lines
from tablehaul.sources.scratch import scratch_path

_PLACEHOLDER = re.compile(r"\{\{|\}\}|\{(\w+)\}")
# A raw text, a quoted text, a quoted name, a line comment, the begin of a block comment, or the end of a statement.
_PIECE = re.compile(
    r"""(?<!\w)[rR]'[^']*'|(?<!\w)[rR]"[^"]*"|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*|;""", re.DOTALL
)
_COMMENT_EDGE = re.compile(r"/\*|\*/")
# Kinds of plans that do something instead of giving the rows of a query.
_ACTS = tuple(f"org.apache.spark.sql.catalyst.plans.logical.{name}" for name in ("Command", "InsertIntoStatement", "CompoundBody"))


def render(text: str, variables: Mapping[str, object] | None = None) -> str:
    """Fill ``{name}`` placeholders in one pass; ``{{`` and ``}}`` stand for braces.

    For names of tables and columns. Values are safer as bound parameters, see :func:`sql`.
    """
    known = variables or {}

    def fill(match: re.Match) -> str:
        if match[1] is None:
            return match[0][0]
        if match[1] not in known:
            raise KeyError(f"no value for variable {match[1]!r}")
        return str(known[match[1]])

    return _PLACEHOLDER.sub(fill, text)


def resolve_variables(variables: Mapping[str, object]) -> dict[str, str]:
    """Variables whose values use variables set before them."""
    resolved: dict[str, str] = {}
    for name, value in variables.items():
        resolved[name] = render(str(value), resolved)
    return resolved


def statements(script: str) -> list[str]:
    """The statements of a script; semicolons in quotes and comments do not end one."""
    found, begin, bare, at = [], 0, "", 0
    while match := _PIECE.search(script, at):
        bare += script[at : match.start()]
        at = match.end()
        if match[0] == "/*":
            at = _comment_end(script, at)
        elif match[0] == ";":
            found.append((script[begin : match.start()].strip(), bare.strip()))
            begin, bare = at, ""
        elif not match[0].startswith("--"):
            bare += match[0]
    found.append((script[begin:].strip(), (bare + script[at:]).strip()))
    return [text for text, without_comments in found if without_comments]


def _comment_end(script: str, at: int) -> int:
    """Where a block comment ends, whose begin is behind; comments inside of it count."""
    depth = 1
    while depth:
        edge = _COMMENT_EDGE.search(script, at)
        if edge is None:
            return len(script)
        at = edge.end()
        depth += 1 if edge[0] == "/*" else -1
    return at


def is_query(spark: SparkSession, statement: str) -> bool:
    """Whether a statement only gives rows, by Spark's own parser: no command and no insert, whatever words it begins with."""
    try:
        plans = [spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)]
    except (ParseException, Py4JJavaError):
        return False  # it fails with Spark's message when its turn comes
    gateway = spark.sparkContext._gateway
    while plans:
        plan = plans.pop()
        if any(is_instance_of(gateway, plan, kind) for kind in _ACTS):
            return False
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return True


def run_script(
    spark: SparkSession,
    script: str,
    variables: Mapping[str, object] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run the statements in order; the rows of the last query are the result.

    They are computed lazily if nothing follows the query. If statements follow, they may drop what it reads: it is
    written to the shared folder before them. Without a query the last statement's rows are the result.
    """
    parts = statements(render(script, variables))
    queries = [i for i, part in enumerate(parts) if is_query(spark, part)]
    wanted = queries[-1] if queries else len(parts) - 1
    result = None
    for i, statement in enumerate(parts):
        rows = spark.sql(statement, args=dict(args or {}))
        if i == wanted:
            result = rows
            if i < len(parts) - 1 and rows.columns:
                path = scratch_path(spark, "result")
                names = [f"c{k}" for k in range(len(rows.columns))]
                placed = rows.toDF(*names).withColumn("place", F.monotonically_increasing_id())
                placed.write.parquet(path)
                back = spark.read.schema(placed.schema).parquet(path)
                # Files come back in any order; only a query that asked for one pays for it again.
                ordered = back.sort("place") if re.search(r"\border\s+by\b", statement, re.IGNORECASE) else back
                result = ordered.drop("place").toDF(*rows.columns)
    if result is None:
        raise ValueError("the script holds no statement")
    return result


def sql(
    spark: SparkSession,
    script: str,
    variables: Mapping[str, object] | None = None,
    args: Mapping[str, object] | None = None,
    format: str | None = "tsv2",
    sep: str | None = None,
    header: bool = False,
) -> DataFrame:
    """The result of a script as text lines in ``format``, or as rows with ``format=None``.

    ``variables`` fill ``{name}`` placeholders, ``args`` bind ``:name`` parameters.
    """
    rows = run_script(spark, script, variables, args)
    return rows if format is None else result_lines(rows, format, sep, header)
