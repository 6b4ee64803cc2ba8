"""Loading delimited text into tables and partitions."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablehaul.sources.delimited import read_delimited
from tablehaul.sources.lines import folder_of


def load_table(
    spark: SparkSession,
    path: str | Sequence[str],
    table: str,
    columns: str | T.StructType,
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    header: bool | str = False,
    escaped: bool = False,
    location: str | None = None,
) -> DataFrame:
    """Replace a table by the rows of delimited text; the text is parsed once, the table is Parquet.

    The table has the declared columns with their types (``varchar``, ``char``) and comments. A load that fails leaves the
    old table as it was. New rows are written to a folder of their own. A managed table that has the declared columns
    already is then pointed to that folder by one catalog call, so that it exists at every moment, with the old rows or the
    new. A table with other columns changes names with the new one; if the second of the two calls fails, the first is undone.
    ``location`` makes the table external at that path, whose old content is set aside until the new is in its place.
    """
    schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
    repeated = {n for n in schema.names if [m.lower() for m in schema.names].count(n.lower()) > 1}
    if repeated:
        raise ValueError(f"a table cannot hold repeated column names: {sorted(repeated)}")
    rows = read_delimited(spark, path, schema, sep, csep, ksep, header, escaped)
    parts = name_parts(table)
    # A name alone could also be that of a temporary view.
    parts = [spark.catalog.currentDatabase(), *parts] if len(parts) == 1 else parts
    name = _quoted(parts)
    present = _present(spark, name) if spark.catalog.tableExists(name) else None
    if location:
        _write_in_place(rows, location)
        if present == _Present("EXTERNAL", "parquet", _columns(schema), _qualified(spark, location)):
            spark.catalog.refreshTable(name)
        else:
            _created(spark, parts, schema, present is not None, location)
    elif present and present.kind == "MANAGED" and (present.provider, present.columns) == ("parquet", _columns(schema)):
        _point_to_new_rows(spark, name, parts[-1], present.location, rows)
    else:
        _created(spark, parts, schema, present is not None, None, rows)
    return spark.table(name)


_PART = re.compile(r"\s*(?:`((?:[^`]|``)+)`|([^\s`.]+))\s*(?:\.|$)")


def name_parts(table: str) -> list[str]:
    """The parts of a table's name; a part in backquotes may hold any sign."""
    parts, at = [], 0
    while at < len(table):
        match = _PART.match(table, at)
        if match is None:
            raise ValueError(f"not a table's name: {table!r}")
        parts.append(match[1].replace("``", "`") if match[1] else match[2])
        at = match.end()
    if not parts or table.rstrip().endswith("."):
        raise ValueError(f"not a table's name: {table!r}")
    return parts


def _quoted(parts: Sequence[str]) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass(frozen=True)
class _Present:
    """What a table is now."""

    kind: str
    provider: str
    columns: tuple[tuple[str, str, str], ...]
    location: str


def _columns(schema: T.StructType) -> tuple[tuple[str, str, str], ...]:
    return tuple((f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment") or "") for f in schema)


def _present(spark: SparkSession, name: str) -> _Present:
    described = [(r["col_name"], r["data_type"], r["comment"] or "") for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    names = [k for k, _, _ in described]
    # Columns come first, with their declared types; what is known of the table follows after a line of its own.
    end = min(i for i, k in enumerate(names) if k == "" or k.startswith("# "))
    known = {k: v for k, v, _ in described[end:]}
    columns = () if "# Partition Information" in names else tuple(described[:end])
    return _Present(known.get("Type", ""), known.get("Provider", "").lower(), columns, known.get("Location", ""))


def _point_to_new_rows(spark: SparkSession, name: str, last: str, old: str, rows: DataFrame) -> None:
    fresh = f"{old.rstrip('/').rpartition('/')[0]}/{re.sub(r'[^A-Za-z0-9_]', '_', last)}-{uuid.uuid4().hex}"
    _whole_or_nothing(rows, fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(fresh)}")
    spark.catalog.refreshTable(name)
    _delete(spark, old)


def _created(
    spark: SparkSession, parts: list[str], schema: T.StructType, replaces: bool, location: str | None, rows: DataFrame | None = None
) -> None:
    """Create the table under a name of its own, with its rows, then give it its name."""
    name, (fresh, aside) = _quoted(parts), (_quoted([*parts[:-1], f"{parts[-1]}_{word}_{uuid.uuid4().hex}"]) for word in ("loading", "replaced"))
    declared = ", ".join(_declared(f) for f in schema)
    spark.sql(f"CREATE TABLE {fresh} ({declared}) USING parquet" + (f" LOCATION {_literal(location)}" if location else ""))
    try:
        if rows is not None:
            spark.sql(f"INSERT OVERWRITE {fresh} SELECT * FROM {{rows}}", rows=rows)
        if replaces:
            spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        except Exception:
            if replaces:
                spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if replaces:
        spark.sql(f"DROP TABLE {aside}")


def _write_in_place(rows: DataFrame, location: str) -> None:
    """Write beside a folder, then let the two change places; the old content is whole until the new is there."""
    spark = rows.sparkSession
    fresh, aside = (f"{location.rstrip('/')}_{word}-{uuid.uuid4().hex}" for word in ("loading", "replaced"))
    _whole_or_nothing(rows, fresh)
    fs, target = folder_of(spark, location)
    there = fs.exists(target)
    if there:
        _rename(spark, location, aside)
    try:
        _rename(spark, fresh, location)
    except Exception:
        if there:
            _rename(spark, aside, location)
        raise
    if there:
        _delete(spark, aside)


def _whole_or_nothing(rows: DataFrame, path: str) -> None:
    try:
        rows.write.parquet(path)
    except Exception:
        _delete(rows.sparkSession, path)
        raise


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = folder_of(spark, source)
    if not fs.rename(path, folder_of(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = folder_of(spark, path)
    fs.delete(target, True)


def _qualified(spark: SparkSession, path: str) -> str:
    fs, target = folder_of(spark, path)
    return fs.makeQualified(target).toString()


def _declared(field: T.StructField) -> str:
    name, comment = field.name.replace("`", "``"), (field.metadata or {}).get("comment")
    text = "" if comment is None else " COMMENT '" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"`{name}` {field.dataType.simpleString()}{text}"


def load_partition(
    spark: SparkSession,
    path: str | Sequence[str],
    table: str,
    partition: str | Mapping[str, object],
    sep: str = "\t",
    csep: str = ",",
    ksep: str = ":",
    header: bool | str = False,
    escaped: bool = False,
) -> DataFrame:
    """Overwrite exactly one partition of a table with the rows of delimited text.

    ``partition`` is a dict or the text inside ``PARTITION (...)``, such as ``"day='2024-01-01'"``.
    """
    table = _quoted(name_parts(table))
    spec = partition if isinstance(partition, str) else ", ".join(f"{_quoted([k])}={_literal(v)}" for k, v in partition.items())
    keys = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    target = spark.table(table)
    schema = T.StructType([f for f in target.schema if f.name not in keys])
    rows = read_delimited(spark, path, schema, sep, csep, ksep, header, escaped)
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({spec}) SELECT * FROM {{rows}}", rows=rows)
    return spark.table(table)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"  # the default partition
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
