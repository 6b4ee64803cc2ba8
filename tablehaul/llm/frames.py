"""Helpers for operators that add columns to a table of documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes of a batch of rows that goes to Python: it lies in both processes at once, beside what is made of it.
ARROW_BYTES = 4 << 20
_ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, for Arrow functions; lowers the session's bound of a batch to ``ARROW_BYTES`` if it is larger.

    The session's other bound counts rows, and ten thousand long texts are far too many. Results are lazy, so the bound must
    stay as it is until they are computed; the session keeps it.
    """
    conf = df.sparkSession.conf
    # Spark reads sizes with units, such as 16m.
    now = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(_ARROW_SETTING))
    if not 0 < now <= ARROW_BYTES:
        conf.set(_ARROW_SETTING, f"{ARROW_BYTES}b")
    return df


def free_prefix(df: DataFrame) -> str:
    """How no column's name begins: for columns that an operator adds and drops again."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def schema_with(docs: DataFrame, added: str) -> T.StructType:
    """The columns of ``docs`` and then the added ones; an added column takes the place of one with its name."""
    new = T._parse_datatype_string(added)
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in docs.schema if f.name.lower() not in names] + new.fields)


def batch_with(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    names = {x.lower() for x in added}
    kept = [i for i, name in enumerate(batch.schema.names) if name.lower() not in names]
    columns = [batch.column(i) for i in kept] + list(added.values())
    return pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[i] for i in kept] + list(added))


def sampled(rows: DataFrame, key: str, total: int, most: int) -> DataFrame:
    """About ``most`` of ``total`` rows, picked by a hash of their key; all rows if there are no more."""
    if total <= most:
        return rows
    steps = 1 << 30
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(steps)) < int(steps * (most / total)))
