"""Dense row numbers in a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quayside.session import new_folder

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def number_rows(df: DataFrame, order: list[str], column: str, start: int = 0, folder: str | None = None) -> DataFrame:
    """Add `column` = start + 1, start + 2, ... in the order of `order` (NULLs last).

    Range partitions are sorted on their own and written to the shared folder
    with each row's place in its partition, so a lost executor cannot change a
    number once given; the partition sizes (one row per partition) turn the
    places into global numbers.
    """
    spark = df.sparkSession
    keys = [*[F.col(c).asc_nulls_last() for c in order], F.col("_tie")]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    folder = folder or new_folder(spark, "numbering")
    placed.write.parquet(folder)
    saved = spark.read.schema(placed.schema).parquet(folder).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    sizes = saved.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition of the sort above
    ahead = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_ahead"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return saved.join(F.broadcast(ahead), "_part").withColumn(
        column, F.lit(start + 1) + F.col("_ahead") + row
    ).drop("_part", "_place", "_ahead")
