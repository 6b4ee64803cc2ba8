"""Column lists as DDL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_list(df: DataFrame) -> str:
    """``"id int, name string"`` for a DataFrame, in the form the load functions take."""
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)


def the_column(lines: DataFrame) -> Column:
    """The one column of a DataFrame of lines."""
    if len(lines.columns) != 1:
        raise ValueError(f"lines have one column, not {lines.columns}")
    return F.col("`" + lines.columns[0].replace("`", "``") + "`")
