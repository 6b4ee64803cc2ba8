"""Datasets of text lines."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How the name of a part file begins, before its number, and that of a folder of appended lines.
PART, APPENDED = "part-", "then-"
#: Bytes of text of a partition that keeps file order.
PLACED_BYTES = 64 << 20
#: Bytes of the smallest blocks that a scan cuts files into, as a rule.
LEAST_BLOCK = 4 << 20
#: Rows of a table of files or file blocks that is broadcast; a longer one is joined by shuffle.
BROADCAST_FILES = 100_000


def read_lines(spark: SparkSession, paths: str | Sequence[str], ordered: bool = False) -> DataFrame:
    """The lines of every non-hidden file under one or more paths or globs, decompressed by file suffix.

    Lines that were appended to a dataset are read with it. ``ordered`` returns the lines in file-name order, which costs
    a shuffle of all lines; where each goes is known from the files' sizes, so nothing is sampled or computed twice.
    """
    if not ordered:
        # Only the lines: folders named like partitions would add columns.
        return _text(spark, paths).select("value")
    lines, total, _ = _positioned(spark, paths)
    parts = max(-(-total // PLACED_BYTES), spark.sparkContext.defaultParallelism)
    part = F.floor(F.col("at") * (parts / max(total, 1))).cast("int")
    placed = lines.withColumn("part", F.least(part, F.lit(parts - 1))).repartitionById(parts, "part")
    return placed.sortWithinPartitions("file", "block", "row").select("value")


def positioned_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their place: columns ``value``, ``file``, ``block``, ``row``; sorting by the last three restores
    the order of the files' content. ``file`` is the number of the file in name order."""
    return _positioned(spark, paths)[0].select("value", "file", "block", "row")


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their ``number`` in file order, from 1, without a shuffle of lines.

    The lines of each file block are counted first; a block's lines are then numbered from the sum of those before it.
    """
    lines, total, n = _positioned(spark, paths)
    here = ["file", "block"]
    # A row for each file block. The ids of a block's rows are consecutive, as one task reads it.
    blocks = lines.groupBy(*here).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.orderBy(*here)) - F.col("n")
    starts = blocks.select(*here, (before - F.col("first") + 1).alias("shift"))
    few = n + total // LEAST_BLOCK <= BROADCAST_FILES
    return lines.join(F.broadcast(starts) if few else starts, here).select((F.col("row") + F.col("shift")).alias("number"), "value")


def _positioned(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, int, int]:
    """Lines with file number, block, row id and the place ``at`` of the block in all bytes; all bytes; number of files."""
    files, total, n = _files(spark, paths)
    lines = _text(spark, paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    known = lines.join(F.broadcast(files) if n <= BROADCAST_FILES else files, "path")
    return known.select("value", "file", "block", "row", (F.col("start") + F.col("block")).alias("at")), total, n


def _files(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, int, int]:
    """(path, file, start): the number of each file in name order and the bytes before it; all bytes; number of files."""
    # Only names and lengths: a scan of the listing that opens no file.
    listed = spark.read.format("binaryFile").load(_with_appended(spark, paths))
    listed = listed.select(F.col("_metadata.file_path").alias("path"), "length")
    n, total = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    order = Window.orderBy("key")  # a row for each file
    ranked = listed.withColumn("key", _name_order(F.col("path"))).select(
        "path", F.row_number().over(order).alias("file"), (F.sum("length").over(order) - F.col("length")).alias("start")
    )
    return ranked, total, n


def _name_order(path: Column) -> Column:
    """A text that sorts like the path, but part files by their number, whatever its length: part-99999, part-100000,
    and what was appended after the files of the dataset itself."""
    name = F.substring_index(path, "/", -1)
    folder = F.substr(path, F.lit(1), F.length(path) - F.length(name))
    appended = F.regexp_extract(folder, f"/{APPENDED}([0-9]+)/$", 1)
    base = F.when(appended == "", folder).otherwise(F.substr(folder, F.lit(1), F.length(folder) - F.length(appended) - len(APPENDED) - 1))
    digits = F.regexp_extract(name, f"^{PART}([0-9]+)(?![^-.])", 1)
    rest = F.substr(name, F.length(digits) + len(PART) + 1)
    ranked = F.when(digits == "", name).otherwise(F.concat(F.lit(PART), _number_order(digits), rest))
    return F.concat(base, F.when(appended == "", F.lit("\x00")).otherwise(F.concat(F.lit("\x01"), _number_order(appended), F.lit("/"))), ranked)


def _number_order(digits: Column) -> Column:
    """A text that sorts like the number: how many digits it has, then the digits."""
    number = F.ltrim(digits, F.lit("0"))
    return F.concat(F.lpad(F.length(number).cast("string"), 3, "0"), F.lit("."), number)


def _text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(_with_appended(spark, paths))


def _with_appended(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The paths, each followed by the folders of lines that were appended there."""
    out = []
    for path in [paths] if isinstance(paths, str) else paths:
        fs, _ = folder_of(spark, path)
        found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, f"{APPENDED}[0-9]*"))
        out += [path, *[s.getPath().toString() for s in found or []]]
    return out


def _input_names(df: DataFrame) -> list[str]:
    """Names of the files that the rows are read from; one call whatever their number."""
    as_json = df.sparkSession._jvm.com.fasterxml.jackson.databind.ObjectMapper()
    return json.loads(as_json.writeValueAsString(df._jdf.inputFiles()))


def first_file(lines: DataFrame) -> str | None:
    """The first file in name order that lines are read from, as ``_metadata.file_path`` spells it; None without files."""
    first = min(_input_names(lines), key=_file_order, default=None)
    return first and re.sub("^file:/+", "file:/", first)  # the scan spells local paths with one slash


def _file_order(file: str) -> tuple:
    """The same order as that of ``_name_order``."""
    folder, _, name = file.rpartition("/")
    appended = re.fullmatch(rf"(.*)/{APPENDED}([0-9]+)", folder)
    part = re.match(rf"{PART}([0-9]+)(?![^-.])", name)
    place = (appended[1], int(appended[2])) if appended else (folder, -1)
    return (place[0] + "/", place[1], PART if part else name, int(part[1]) if part else 0, name)


def read_sequence_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The records of sequence files as ``key<TAB>value`` lines, the form a line job would get them in."""
    joined = paths if isinstance(paths, str) else ",".join(paths)
    records = spark.sparkContext.sequenceFile(joined)
    return records.map(lambda kv: (f"{kv[0]}\t{kv[1]}",)).toDF("value string")


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write a one-column DataFrame of lines as a dataset; ``mode`` is ``overwrite`` or ``append``.

    Appended lines come after those that are there, in a numbered folder of the dataset that appears in one step, whole or
    not at all. A dataset that is being read can't be overwritten: it would be gone before it has been read.
    """
    if mode != "append":
        _refuse_own_input(lines, path)
        lines.write.mode(mode).text(path, compression=compression)
    elif not has_files(lines.sparkSession, path):
        lines.write.mode("append").text(path, compression=compression)
    else:
        _write_after(lines, path, compression)


def folder_of(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _shown_names(fs, target) -> list[str]:
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return [n for n in names if not n.startswith(("_", "."))]


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a dataset has any file that readers see."""
    fs, target = folder_of(spark, path)
    shown = spark._jvm.org.apache.hadoop.fs.Path(target, "[^_.]*")
    return bool(len(fs.globStatus(shown) or []))


def _refuse_own_input(lines: DataFrame, path: str) -> None:
    fs, target = folder_of(lines.sparkSession, path)
    own = fs.makeQualified(target).toUri().getPath().rstrip("/")
    # Only files of the plan's own scans count; their names are known without reading them.
    paths = (unquote(urlsplit(name).path) for name in _input_names(lines))
    if any(file == own or file.startswith(own + "/") for file in paths):
        raise ValueError(f"{path} is read by the rows that would overwrite it")


def _write_after(lines: DataFrame, path: str, compression: str | None) -> None:
    """Write beside the dataset's files, hidden from readers, then show the new files by renaming their folder."""
    spark = lines.sparkSession
    fs, target = folder_of(spark, path)
    hidden = f"{path.rstrip('/')}/_appending-{uuid.uuid4().hex}"
    lines.write.text(hidden, compression=compression)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(target, f"{APPENDED}[0-9]*")) or []
    numbers = [int(s.getPath().getName().removeprefix(APPENDED)) for s in found]
    _publish(spark, hidden, path, max(numbers, default=0) + 1)


def _publish(spark: SparkSession, hidden: str, path: str, number: int) -> None:
    """Rename the folder to the first free number from ``number`` on; a rename that doesn't overwrite is one step."""
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(hidden)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    source = folder_of(spark, hidden)[0].makeQualified(source)
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    while True:
        try:
            return files.rename(source, jvm.org.apache.hadoop.fs.Path(path, f"{APPENDED}{number:06d}"), no_options)
        except Py4JJavaError as failure:  # another writer took the number
            if failure.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            number += 1


def headed(lines: DataFrame, header: str, footer: str | None = None) -> DataFrame:
    """Lines with one header line before the first partition and, if given, a footer after the last.

    A union keeps the partitions of its inputs in order, so the part files do too.
    """
    return _around(lines, header).unionAll(lines) if footer is None else (
        _around(lines, header).unionAll(lines).unionAll(_around(lines, footer))
    )


def _around(lines: DataFrame, text: str) -> DataFrame:
    return lines.sparkSession.range(0, 1, 1, 1).select(F.lit(text).alias("value"))
