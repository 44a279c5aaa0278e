"""Small aggregates as JSON sections for readers outside Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, TimestampType


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, doubles rounded to six places, dates and times as ISO text."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            value = F.round(value.cast("double"), 6)
        elif isinstance(f.dataType, DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(f.dataType, TimestampType):
            value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def write_sections(sections: Mapping[str, DataFrame], root: str) -> None:
    """One folder of JSON lines per section, written by the executors; NULLs are kept."""
    for name, df in sections.items():
        out = presentable(df).write.mode("overwrite").option("ignoreNullFields", False)
        out.json(f"{root}/{name}")
