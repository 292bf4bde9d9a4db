"""Surrogate ids in arrival order, without sending all rows through one task."""

from pyspark.sql import DataFrame, Window, functions as F

from firmament.session import scratch

# ``monotonically_increasing_id`` counts the rows of a partition in its low 33 bits.
_PLACE_BITS = 33


def assign_ids(new_rows: DataFrame, id_column: str, arrival: str, existing: DataFrame | None = None) -> DataFrame:
    """Number ``new_rows`` by ``arrival``, whose values are unique, going on after the greatest existing id.

    The rows are dealt to ranges of ``arrival``, put in order there and written once to the shared folder with
    their place in their range, so a lost task never changes an id. A range starts after the rows of all ranges
    before it. There are as many ranges as shuffle partitions, which bounds the counts that are broadcast.
    """
    spark = new_rows.sparkSession
    path = scratch(spark, "ids")
    placed = new_rows.repartitionByRange(F.col(arrival)).sortWithinPartitions(arrival).withColumn(
        "_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path).withColumn("_range", F.shiftright("_at", _PLACE_BITS))

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    base = F.lit(0) if existing is None else existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1) + 1
    return (
        written.join(F.broadcast(starts), "_range")
        .withColumn(id_column, (base + F.col("_start") + place).cast("bigint"))
        .drop("_range", "_at", "_start")
    )
