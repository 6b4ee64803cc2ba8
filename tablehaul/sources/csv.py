"""CSV extract."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.delimited import Separators, format_value
from tablehaul.operators.extract import extract
from tablehaul.sources.lines import has_files, write_lines


def extract_csv(
    spark: SparkSession,
    path: str,
    table: str | DataFrame,
    sep: str = ",",
    header: bool = False,
    quote: str | None = None,
    escape: str | None = None,
    escape_quotes: bool | None = None,
    quote_all: bool | None = None,
    null_value: str | None = None,
    mode: str = "overwrite",
    select: Sequence[str] | None = None,
    where: str | None = None,
    drop: Sequence[str] | None = None,
    limit: int | None = None,
    aux: Callable[[DataFrame], DataFrame] | None = None,
    compression: str | None = None,
) -> None:
    """Run the extract chain on a table and write CSV, with the header exactly once for the directory."""
    df = extract(spark, table, select=select, where=where, drop=drop, limit=limit, aux=aux)
    options = {
        "sep": sep, "quote": quote, "escape": escape, "escapeQuotes": escape_quotes,
        "quoteAll": quote_all, "nullValue": null_value,
    }
    header = header and not (mode == "append" and has_files(spark, path))
    write_lines(csv_lines(df, options, header), path, mode, compression)


def csv_lines(df: DataFrame, options: dict[str, object], header: bool = False) -> DataFrame:
    """One CSV record per row, column ``value``, by the rules of Spark's CSV writer."""
    given = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if v is not None}
    names = [f"c{i}" for i in range(len(df.columns))]
    flat = df.toDF(*names).select(*[_flattened(n, f.dataType) for n, f in zip(names, df.schema, strict=True)])
    record = F.to_csv(F.struct(*names), given)
    if len(names) == 1:
        # A row that is one NULL has no CSV record of its own.
        record = F.when(F.col(names[0]).isNull(), F.lit(given.get("nullValue", ""))).otherwise(record)
    lines = flat.select(record.alias("value"))
    if not header:
        return lines
    titles = df.sparkSession.range(0, 1, 1, 1).select(
        F.to_csv(F.struct(*[F.lit(c).alias(n) for c, n in zip(df.columns, names, strict=True)]), given).alias("value")
    )
    return titles.unionAll(lines)


def _flattened(name: str, dtype: T.DataType):
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = format_value(F.col(name), dtype, Separators(), 1)
        return F.when(F.col(name).isNotNull(), text).alias(name)
    return F.base64(name).alias(name) if isinstance(dtype, T.BinaryType) else F.col(name)
