"""Statistics and properties of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def _unordered(dtype: T.DataType) -> bool:
    """Whether values of a type have no order, or hold some that have none."""
    if isinstance(dtype, T.StructType):
        return any(_unordered(f.dataType) for f in dtype)
    return _unordered(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, _UNORDERED)


def table_stats(df: DataFrame) -> DataFrame:
    """One row per column of a file-backed table: row and NULL counts, min and max as text, files and bytes.

    One aggregate over the columns, which keeps no group and sorts nothing, and one over the file names, for which
    no column is read.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    files = (
        df.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.max("_metadata.file_size").alias("bytes"))
        .agg(F.struct(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).alias("size"))
    )

    def extreme(aggregate: Callable[[Column], Column], name: str) -> Column:
        return F.lit(None).cast("string") if _unordered(kinds[name]) else (
            aggregate(_col(name)).cast("string")
        )

    columns = [
        F.struct(
            F.lit(name).alias("column_name"),
            (F.count("*") - F.count(_col(name))).alias("null_count"),
            extreme(F.min, name).alias("min_value"),
            extreme(F.max, name).alias("max_value"),
        )
        for name in df.columns
    ]
    whole = df.agg(F.count("*").alias("row_count"), F.array(*columns).alias("columns"))
    return whole.withColumn("size", files.scalar()).select(
        "row_count", F.col("size.files").alias("file_count"), F.col("size.bytes").alias("byte_count"),
        F.inline("columns"),
    )


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    """(name, text, number) of every table property and of the location; digits also come as numbers."""
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").toDF("name", "text")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").select("col_name", "data_type")
    location = described.where("col_name = 'Location'").select(F.lit("location"), "data_type")
    number = F.when(F.col("text").rlike("^[0-9]+$"), F.col("text").try_cast("bigint"))
    return properties.unionAll(location).withColumn("number", number)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
