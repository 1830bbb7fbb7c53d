"""What a run did: counts per table, merge outcomes, error classes, summary lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

# Database error code -> class shown in the report.
ERROR_CLASSES = (
    ("ORA-01843", "Date format error"),
    ("ORA-01400", "NULL constraint: "),  # followed by the quoted column
    ("ORA-00932", "Data type mismatch"),
    ("ORA-01036", "Bind variable count mismatch"),
)


def load_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, records), with a NULL table_name for the total."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table_name"), "records") for n, df in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.rollup("table_name").agg(F.sum("records").alias("records"))


# The sentences of a merge account.
def merge_outcome(table: Column, inserted: Column, updated: Column) -> Column:
    """The one-line account of a merge."""
    new = F.concat(F.format_number(inserted, 0), F.lit(" new record(s) inserted"))
    old = F.concat(F.format_number(updated, 0), F.lit(" existing record(s) updated"))
    return F.concat(
        table, F.lit(": "),
        F.when((inserted > 0) & (updated > 0), F.concat(new, F.lit(", "), old))
        .when(inserted > 0, new)
        .when(updated > 0, old)
        .otherwise("No changes (data already up to date)"),
    )


def error_class(message: Column) -> Column:
    """Class of a database error message; other messages keep their first 100 characters."""
    quoted = F.regexp_extract(message, '"([^"]+)"', 1)
    column = F.when(quoted == "", "unknown column").otherwise(quoted)
    result = None
    for code, label in ERROR_CLASSES:
        value = F.concat(F.lit(label), column) if label.endswith(": ") else F.lit(label)
        result = F.when(message.contains(code), value) if result is None else result.when(message.contains(code), value)
    return result.otherwise(F.left(message, F.lit(100)))


def run_summary(stats: DataFrame, log: DataFrame, *, tables: int = 5, messages: int = 3) -> DataFrame:
    """Summary lines (section, line_no, item, records).

    `stats`: (system, table_name, records); `log`: (level, seq, message). Per
    system: total records, number of tables, the first tables by name and how
    many more; per level: the number of messages, the first ones, how many more.
    Only row_number <= k is kept per group, which Spark cuts down to k rows per
    task before it shuffles.
    """
    totals = stats.groupBy("system").agg(F.sum("records").alias("records"), F.count(F.lit(1)).alias("n"))
    levels = log.groupBy("level").agg(F.count(F.lit(1)).alias("n"))

    def line(df, section, no, item, records):
        return df.select(section.alias("section"), F.lit(no).cast("int").alias("line_no") if isinstance(no, int)
                         else no.cast("int").alias("line_no"), item.alias("item"), records.cast("bigint").alias("records"))

    def first(df, group, order, k):
        return df.withColumn("_no", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("_no") <= k)

    def more(df, group, k, what):
        rest = F.col("n") - k
        return line(df.filter(rest > 0), F.col(group), k + 2, F.format_string(f"... and %d more {what}", rest), rest)

    system, level = F.col("system"), F.col("level")
    parts = [
        line(totals, system, 0, F.lit("Total Records"), F.col("records")),
        line(totals, system, 1, F.lit("Tables Processed"), F.col("n")),
        line(first(stats, "system", "table_name", tables), system, F.col("_no") + 1, F.col("table_name"), F.col("records")),
        more(totals, "system", tables, "tables"),
        line(levels, level, 0, F.lit("Messages"), F.col("n")),
        line(first(log, "level", "seq", messages), level, F.col("_no") + 1, F.col("message"), F.lit(None)),
        more(levels, "level", messages, "messages"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
