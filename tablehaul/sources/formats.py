"""Result rows as text in the output formats of a SQL command line."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.delimited import Separators
from tablehaul.sources.lines import headed

# Separator of each separated format; dsv takes its own, with this default.
SEPARATED = {"tsv2": "\t", "csv2": ",", "dsv": "|"}
QUOTED = {"tsv": "\t", "csv": ","}
MARKUP = ("xmlattr", "xmlelements")
NULL_TEXT = "NULL"
# Entities of signs, and of white space that a parser would change in an attribute or at a line end.
MARKUP_CODES = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "\t": "&#9;", "\n": "&#10;", "\r": "&#13;"}
ILLEGAL_IN_XML = r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"

# Any sign that is replaced: an entity's, or one that XML can't hold.
CHANGED_IN_XML = r"[^\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]|[&<>\"]"

# Types whose text has neither kind of sign.
PLAIN_IN_XML = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def result_lines(df: DataFrame, format: str = "tsv2", sep: str | None = None, header: bool = False) -> DataFrame:
    """One line per row, column ``value``, in one of the formats

    ``tsv2``, ``csv2``, ``dsv`` (values joined as they are), ``tsv``, ``csv`` (every value in single
    quotes), ``xmlattr``, ``xmlelements`` (one element per row inside a ``resultset`` element). Characters that XML
    can't hold become U+FFFD; signs that a name can't hold become ``_``.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    texts = [_text(F.col(n), f.dataType) for n, f in zip(names, df.schema, strict=True)]
    if format in SEPARATED:
        joiner = Separators(sep).at(0) if format == "dsv" and sep else SEPARATED[format]
        lines = rows.select(F.concat_ws(joiner, *texts).alias("value"))
        return headed(lines, joiner.join(df.columns)) if header else lines
    if format in QUOTED:
        joiner = QUOTED[format]
        lines = rows.select(F.concat_ws(joiner, *[_in_quotes(t) for t in texts]).alias("value"))
        return headed(lines, joiner.join(f"'{c}'" for c in df.columns)) if header else lines
    if format in MARKUP:
        element = _attributes if format == "xmlattr" else _elements
        safe = [t if isinstance(f.dataType, PLAIN_IN_XML) else _markup_safe(t) for t, f in zip(texts, df.schema, strict=True)]
        lines = rows.select(element([_markup_name(c) for c in df.columns], safe).alias("value"))
        return headed(lines, "<resultset>", "</resultset>")
    known = ", ".join([*SEPARATED, *QUOTED, *MARKUP])
    raise ValueError(f"unknown format {format!r}, known: {known}; see to_long_form for one line per cell")


def to_long_form(df: DataFrame, ids: list[str], columns: list[str] | None = None) -> DataFrame:
    """One (name, value) row per cell, values as text, beside the id columns."""
    wide = columns or [c for c in df.columns if c not in ids]
    kinds = {f.name: f.dataType for f in df.schema}
    cells = df.select(*ids, *[_text(df[f"`{c}`"], kinds[c], None).alias(c) for c in wide])
    return cells.unpivot(ids, wide, "name", "value")


def _text(value: Column, dtype: T.DataType, null_text: str | None = NULL_TEXT) -> Column:
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    text = F.to_json(value) if nested else value.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def _in_quotes(text: Column) -> Column:
    return F.concat(F.lit("'"), text, F.lit("'"))


def _attributes(names: list[str], texts: list[Column]) -> Column:
    parts = [F.concat(F.lit(f' {n}="'), t, F.lit('"')) for n, t in zip(names, texts, strict=True)]
    return F.concat(F.lit("<result"), *parts, F.lit("/>"))


def _elements(names: list[str], texts: list[Column]) -> Column:
    parts = [F.concat(F.lit(f"<{n}>"), t, F.lit(f"</{n}>")) for n, t in zip(names, texts, strict=True)]
    return F.concat(F.lit("<result>"), *parts, F.lit("</result>"))


def _markup_safe(text: Column) -> Column:
    # Most values need no change, and one search for any sign is cheaper than a search for each.
    return F.when(text.rlike(CHANGED_IN_XML), _replaced(text)).otherwise(text)


def _replaced(text: Column) -> Column:
    for character, entity in MARKUP_CODES.items():
        text = F.replace(text, F.lit(character), F.lit(entity))
    return F.regexp_replace(text, ILLEGAL_IN_XML, "\ufffd")


def _markup_name(name: str) -> str:
    safe = re.sub(r"[^\w.-]", "_", name)
    return safe if re.match(r"[^\W\d]", safe) else f"_{safe}"
