"""Dense surrogate keys in a global order without a single-task window."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickvault.session import work_path

_PID = "_range_pid"
# monotonically_increasing_id() puts the partition id in the upper 31 bits
# and the row's position inside the partition in the lower 33 bits.
_ROW_BITS = 33


def global_row_number(df: DataFrame, order_cols: Sequence[str], out_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_cols)`` as BIGINT, computed in parallel.

    Rows are range-partitioned, sorted, and stored in the shared folder with
    their range and their position in it (``monotonically_increasing_id``).
    The stored rows are then counted per range and shifted by the rows of all
    earlier ranges: positions and counts come from the same files, so they
    agree whatever bounds the range exchange sampled.  The offset table has
    one row per range partition, so broadcasting it is bounded by the
    partition count, not the data.  ``order_cols`` must form a total order
    (ties would be numbered in an arbitrary order).
    """
    cols = list(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_path(spark, "numbered")
    (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
       .withColumn("_mid", F.monotonically_increasing_id())
       .withColumn(_PID, F.shiftright("_mid", _ROW_BITS).cast("int"))
       .withColumn("_local_rn", F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1) + 1)
       .drop("_mid").write.parquet(path))
    local = spark.read.parquet(path)
    offsets = (local.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
                    .withColumn("_offset", F.coalesce(F.sum("_n").over(
                        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                    .drop("_n"))
    return (local.join(F.broadcast(offsets), _PID)
                 .withColumn(out_col, (F.col("_offset") + F.col("_local_rn")).cast("bigint"))
                 .select(*df.columns, out_col))
