"""Calendar dimension: one row per day with its month attributes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

ATTRIBUTES = ["calendar_date", "month_number", "year_number", "month_year_name"]


@dataclass(frozen=True)
class Calendar:
    """Calendar days plus their bounds, which interval joins clamp to.

    Its size is bounded by the span: (last - first + 1) rows, 36,525 a century.
    """

    days: DataFrame
    first: date
    last: date

    @staticmethod
    def between(spark: SparkSession, first: date, last: date) -> "Calendar":
        return Calendar(calendar(spark, first, last), first, last)

    @staticmethod
    def of(days: DataFrame) -> "Calendar":
        """Wrap an existing calendar table (gaps allowed); one small job for the bounds."""
        lo, hi = days.agg(F.min("calendar_date"), F.max("calendar_date")).first()
        return Calendar(days.select(*ATTRIBUTES), lo, hi)


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    return spark.range((last - first).days + 1).select(day.alias("calendar_date")).select(
        "calendar_date",
        F.month("calendar_date").alias("month_number"),
        F.year("calendar_date").alias("year_number"),
        F.date_format("calendar_date", "MMMM yyyy").alias("month_year_name"),
    )
