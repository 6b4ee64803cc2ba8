r"""Typed rows from delimited text and back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.columns import the_column
from tablehaul.functions.delimited import Separators, conflicts, format_row, parse_steps, split_row
from tablehaul.sources.lines import first_file, has_files, headed, read_lines, write_lines


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: str | T.StructType,
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    header: bool | str = False,
    escaped: bool = False,
) -> DataFrame:
    r"""Read delimited text with a declared schema (DDL text or a ``StructType``).

    ``header=True`` leaves out the first line of every file; ``header="dataset"`` leaves out only the first
    line of the first file in name order, which is where :func:`dump` puts it. ``escaped`` reads text
    written with ``on_conflict="escape"``.
    """
    if header == "dataset":
        lines = _without_dataset_header(spark, path)
    elif header:
        lines = _without_first_lines(read_lines(spark, path))
    else:
        lines = read_lines(spark, path)
    return parse_lines(lines, columns, sep, csep, ksep, escaped)


def parse_lines(
    lines: DataFrame,
    columns: str | T.StructType,
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    escaped: bool = False,
) -> DataFrame:
    """Parse a one-column DataFrame of lines into typed columns."""
    schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
    seps = Separators(sep, csep, ksep, escaped)
    rows = lines.select(split_row(the_column(lines), seps).alias("fields"))
    for step in parse_steps(schema, seps):
        rows = rows.select(*step)
    return rows


def format_lines(
    df: DataFrame,
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    header: bool = False,
    on_conflict: str = "raw",
) -> DataFrame:
    r"""One text line per row, column ``value``; optionally a header line ahead of them.

    A separator or line break inside a value is written as it is (``raw``), as a backslash code that
    ``escaped=True`` reads back (``escape``), or fails the job (``error``). Raw text has one spelling for a
    NULL collection and a collection of one NULL, and one for an empty collection and one empty text; ``escape``
    has a code for each.
    """
    if on_conflict not in ("raw", "escape", "error"):
        raise ValueError(f"unknown conflict policy {on_conflict!r}")
    # Positional names let rows with repeated column names through.
    names = [f"c{i}" for i in range(len(df.columns))]
    schema = T.StructType(
        [T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, df.schema, strict=True)]
    )
    seps = Separators(sep, csep, ksep, on_conflict == "escape")
    line = format_row(schema, seps)
    if on_conflict == "error":
        message = F.lit("a value holds a separator, a line break or the NULL marker")
        line = F.when(conflicts(schema, seps), F.raise_error(message).cast("string")).otherwise(line)
    lines = df.toDF(*names).select(line.alias("value"))
    return headed(lines, seps.at(0).join(df.columns)) if header else lines


def dump(
    spark: SparkSession,
    query: str | DataFrame,
    path: str,
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    header: bool = False,
    mode: str = "overwrite",
    on_conflict: str = "raw",
    compression: str | None = None,
) -> None:
    """Write the rows of one SQL query as a directory of delimited text.

    Part files concatenated in name order keep the ORDER BY of the query, header first. ``mode="append"`` puts the rows
    after those that are there; a dataset that has rows gets no second header.
    """
    df = spark.sql(query) if isinstance(query, str) else query
    header = header and not (mode == "append" and has_files(spark, path))
    write_lines(format_lines(df, sep, csep, ksep, header, on_conflict), path, mode, compression)


def _without_dataset_header(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    lines = read_lines(spark, path)
    first = first_file(lines)
    if first is None:
        return lines
    # Both sides filter on the file alone, so each reads only its own files.
    in_first = F.col("_metadata.file_path") == F.lit(first)
    return lines.where(~in_first).unionAll(_without_first_lines(lines.where(in_first)))


def _without_first_lines(lines: DataFrame) -> DataFrame:
    """Leave out the first line of each file in one pass, without a join or a second scan.

    Rows arrive in file order within a task, so the first line of a file is the row where a new file
    starts at offset 0. Only a hash of the file name travels with the rows.
    """
    tagged = lines.select(
        F.col("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") == 0).alias("at_start"),
    )
    return tagged.mapInArrow(_drop_file_starts, "value string")


def _drop_file_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_file, last_at_start = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column("file").to_numpy()
        at_start = batch.column("at_start").to_numpy(zero_copy_only=False)
        new_file = np.empty(len(file), dtype=bool)
        new_file[0] = file[0] != last_file or not last_at_start
        new_file[1:] = (file[1:] != file[:-1]) | ~at_start[:-1]
        last_file, last_at_start = file[-1], at_start[-1]
        yield batch.select(["value"]).filter(pa.array(~(new_file & at_start)))
