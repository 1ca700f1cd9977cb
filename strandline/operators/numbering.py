"""Numbers in a global order without bringing all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.storage import durable


def numbered_in_order(rows: DataFrame, order: list[Column | str], name: str = "number", ranges: list[Column | str] | None = None) -> DataFrame:
    """rows with `name`, their place from 1 in the given order; rows equal in it get places in any order among them.

    ranges, if given, are a coarser form of the order by which the rows are dealt: the driver samples those columns.

    Two passes: rows are dealt into ranges of the order and written, so that the ranges stay the
    same; then each range is numbered on its own, after the sizes of those before it. Only one size a
    range comes to the driver.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = durable(rows.repartitionByRange(parts, *(ranges or order)).withColumn("_range", F.spark_partition_id()), "ranges")
    before, total = {}, 0
    for r in sorted(ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()):  # at most `parts` rows
        before[r["_range"]] = total
        total += r["n"]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)).cast("long")
    if not before:
        return ranged.select(*rows.columns, place.alias(name))
    after = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_range"))
    return ranged.select(*rows.columns, (place + after).alias(name))


def numbered_within(rows: DataFrame, groups: list[str], order: list[Column | str], name: str, ranges: list[Column | str] | None = None) -> DataFrame:
    """rows with `name`, their place from 1 in the given order within their group, and no group in one task.

    The first place of each group is broadcast: the groups are loci, and kinds, of which there are few.
    """
    placed = numbered_in_order(rows, [*groups, *order], "_place", [*groups, *(ranges or order)])
    placed = durable(placed, "placed")
    first = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in groups]).agg(F.min("_place").alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups]
    return placed.join(F.broadcast(first), same).select(*rows.columns, (F.col("_place") - F.col("_first") + 1).alias(name))
