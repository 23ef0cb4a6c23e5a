"""Row numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.sources.staging import reliable


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df plus a number from 0 in the given order: range partitions, numbered on their own, plus offsets of as many
    rows as partitions."""
    parts = reliable(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__size"))
    offsets = sizes.select("__part", (F.sum("__size").over(W.orderBy("__part")) - F.col("__size")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn("__inside", inside).join(F.broadcast(offsets), "__part").withColumn(name, (F.col("__before") + F.col("__inside")).cast("long")).drop("__part", "__before", "__inside")
