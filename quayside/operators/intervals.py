"""Date x interval joins without a theta join.

Joining a calendar to intervals with `>=` and `<` plans as a nested loop over
days x rows. Here every interval is clamped to the calendar and exploded into
its own days, inside the task that holds the row; the calendar attributes then
arrive by an equi-join on the day. One row yields at most one row per calendar
day, so the explosion is bounded whatever the dates hold.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.operators.spread import shuffle_partitions
from quayside.sources.calendar import Calendar


def day_span(start: Column, end: Column, first: date, last: date, *, closed: bool, open_end: bool = False):
    """(low, high) day of an interval inside [first, last]; NULL bounds stay NULL.

    `closed` counts the end day itself. `open_end` reads a NULL end as "still
    running". least/greatest skip NULLs in Spark, hence the explicit tests.
    """
    low = F.to_date(start)
    high = F.to_date(end) if closed else F.date_sub(F.to_date(end), 1)
    if open_end:
        high = F.coalesce(high, F.lit(last))
    return (
        F.when(low.isNotNull(), F.greatest(low, F.lit(first))),
        F.when(high.isNotNull(), F.least(high, F.lit(last))),
    )


def explode_days(df: DataFrame, start: Column, end: Column, cal: Calendar, *, closed: bool,
                 open_end: bool = False, day: str = "calendar_date") -> DataFrame:
    """One row per (row, calendar day its interval covers)."""
    low, high = day_span(start, end, cal.first, cal.last, closed=closed, open_end=open_end)
    return (
        df.withColumn("_low", low)
        .withColumn("_high", high)
        # sequence() would count down when high < low
        .filter(F.col("_low") <= F.col("_high"))
        .withColumn(day, F.explode(F.sequence("_low", "_high")))
        .drop("_low", "_high")
    )


def explode_ranges(df: DataFrame, start: Column, end: Column, cal: Calendar, *, closed: bool) -> DataFrame:
    """Each row once for every aligned range of days its interval is made of, as `_level` and `_place`.

    A range of level k is 2 ** k days long and begins at a multiple of that,
    counted from the calendar's first day; an interval of n days is at most
    2 log2(n) of them, so rows do not grow with the length of their intervals.
    What is idempotent (a maximum, a minimum, "any") can be taken per range and
    then per day with `days_of_ranges`, however intervals overlap.
    """
    low, high = day_span(start, end, cal.first, cal.last, closed=closed)
    first, behind = F.datediff(F.col("_low"), F.lit(cal.first)), F.datediff(F.col("_high"), F.lit(cal.first)) + 1
    pieces = []
    for k in range(((cal.last - cal.first).days + 1).bit_length()):
        left, right = F.shiftright(first + ((1 << k) - 1), k), F.shiftright(behind, k)
        odd = left % 2
        pieces.append(F.when((odd == 1) & (left < right), F.struct(F.lit(k).alias("level"), left.alias("place"))))
        pieces.append(F.when((right % 2 == 1) & (left + odd < right), F.struct(F.lit(k).alias("level"), (right - 1).alias("place"))))
    return (
        df.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
        .withColumn("_range", F.explode(F.array_compact(F.array(*pieces))))
        .withColumn("_level", F.col("_range.level")).withColumn("_place", F.col("_range.place")).drop("_low", "_high", "_range")
    )


def days_of_ranges(df: DataFrame, cal: Calendar, day: str = "calendar_date") -> DataFrame:
    """One row per row of `explode_ranges` and day of its range."""
    length = F.expr("shiftleft(1, _level)")
    first = F.date_add(F.lit(cal.first), F.col("_place") * length)
    return df.withColumn(day, F.explode(F.sequence(first, F.date_add(first, length - 1)))).drop("_level", "_place")


def days_covered(df: DataFrame, start: Column, end: Column, cal: Calendar, *, closed: bool) -> int:
    """Rows that `explode_days` would make, added up without making them; a job over the two bounds alone."""
    low, high = day_span(start, end, cal.first, cal.last, closed=closed)
    spans = df.select(low.alias("_low"), high.alias("_high")).filter("_low <= _high")
    return spans.agg(F.sum(F.datediff("_high", "_low") + 1)).first()[0] or 0


def covering_days(df: DataFrame, start: Column, end: Column, cal: Calendar, *, closed: bool) -> DataFrame:
    """`explode_days` plus the calendar attributes; days the calendar lacks drop out."""
    return explode_days(df, start, end, cal, closed=closed).join(cal.days, "calendar_date")


def free_days(df: DataFrame, members: DataFrame, group: list[str], start: Column, end: Column, cal: Calendar, *,
              closed: bool) -> DataFrame:
    """Calendar days of each of `members` (one row per group) that no interval of its group in `df` covers.

    No interval is exploded: +1 on its first day and -1 after its last one are
    summed per (group, day) before anything is ordered, and the stretches
    without a running interval are exploded. An empty `group` is one group, of
    a row per calendar day at most.
    """
    low, high = day_span(start, end, cal.first, cal.last, closed=closed)
    spans = df.select(*group, low.alias("_low"), high.alias("_high")).filter("_low <= _high")
    change = F.explode(F.array(
        F.struct(F.col("_low").alias("day"), F.lit(1).alias("n")),
        F.struct(F.date_add("_high", 1).alias("day"), F.lit(-1).alias("n"))))
    edges = F.explode(F.array(*[
        F.struct(F.lit(d).alias("day"), F.lit(0).alias("n")) for d in (cal.first, cal.last + timedelta(days=1))]))
    daily = (
        spans.select(*group, change.alias("c")).unionByName(members.select(*group, edges.alias("c")))
        .groupBy(*group, F.col("c.day").alias("_day")).agg(F.sum("c.n").alias("_n"))
    )
    by_day = Window.partitionBy(*group).orderBy("_day")
    stretches = daily.select(
        *group, "_day", F.lead("_day").over(by_day).alias("_next"),
        F.sum("_n").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_running"),
    ).filter("_running = 0 and _next is not null")
    return stretches.withColumn("calendar_date", F.explode(F.sequence("_day", F.date_sub("_next", 1)))).select(*group, "calendar_date")


def running_counts(df: DataFrame, group: list[str], start: Column, end: Column, counted: Column,
                   cal: Calendar, *, open_end: bool) -> DataFrame:
    """Rows alive per group and day, over closed intervals, without exploding rows.

    Every interval becomes +1 on its first day and -1 on the day after its last
    one. The changes are summed per (group, day) before anything is ordered, so
    the window sees at most one row per calendar day and group; then each
    stretch between two changes is exploded. `alive` counts rows, `n` counts
    the rows where `counted` is not NULL.
    """
    low, high = day_span(start, end, cal.first, cal.last, closed=True, open_end=open_end)
    one = F.when(counted.isNotNull(), 1).otherwise(0)
    spans = df.select(*group, low.alias("_low"), high.alias("_high"), one.alias("_one")).filter("_low <= _high")
    change = F.explode(
        F.array(
            F.struct(F.col("_low").alias("day"), F.lit(1).alias("rows"), F.col("_one").alias("hits")),
            F.struct(F.date_add("_high", 1).alias("day"), F.lit(-1).alias("rows"), (-F.col("_one")).alias("hits")),
        )
    )
    daily = (
        spans.select(*group, change.alias("c"))
        .groupBy(*group, F.col("c.day").alias("_day"))
        .agg(F.sum("c.rows").alias("_rows"), F.sum("c.hits").alias("_hits"))
    )
    by_day = Window.partitionBy(*group).orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretches = daily.select(
        *group,
        "_day",
        F.lead("_day").over(by_day).alias("_next"),
        F.sum("_rows").over(so_far).alias("alive"),
        F.sum("_hits").over(so_far).alias("n"),
    ).filter("alive > 0")
    # few rows that are about to grow to one per day
    return stretches.repartition(shuffle_partitions(df), *group, "_day").withColumn(
        "calendar_date", F.explode(F.sequence("_day", F.date_sub("_next", 1)))
    ).select(*group, "calendar_date", "alive", "n")
