"""Order-dependent numbering without a single-partition window.

``row_number() over (order by k)`` and running sums over a global order would
put every row into one task.  Here the frame is range-partitioned on the
order (balanced partitions, sorted inside), one small aggregate gives the
count/total of every partition, a window over those few rows turns them into
offsets, and the offsets are broadcast back (size bounded by the number of
partitions).

The sorted frame is staged as Parquet in the shared checkpoint folder together
with its partition and place, so the counting pass and the numbering pass see
the same rows even if executors are lost in between.  The number of partitions
is the session's, never fixed here.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.session import scratch_path

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: evaluated once, lineage cut."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stage(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None,
           range_columns: int | None = None, staged: bool = False) -> DataFrame:
    """Range-partition + sort + number the rows, then write them.

    The input is written first, unless it is ``staged`` already: the range partitioner's sampling
    job and the shuffle then read one evaluation of it.  ``range_columns``: how many columns
    of ``order`` spread the rows well enough.
    """
    df = df if staged else written(df, "unsorted")
    by = order[:range_columns] if range_columns else order
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    return written(ranged.sortWithinPartitions(*order).withColumn("__mid", F.monotonically_increasing_id()), "sorted")


def _offsets(totals: DataFrame, total_col: str) -> DataFrame:
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__pid", F.coalesce(F.sum(total_col).over(w), F.lit(0)).alias("__off"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str,
                      num_partitions: int | None = None, range_columns: int | None = None,
                      staged: bool = False) -> DataFrame:
    """Consecutive 1..n in ``order`` (ties broken arbitrarily; make ``order`` total)."""
    staged = _stage(df, order, num_partitions, range_columns, staged).withColumns({
        "__pid": F.shiftright("__mid", _LOCAL_BITS),
        "__pos": F.col("__mid").bitwiseAND((1 << _LOCAL_BITS) - 1)})
    counts = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = _offsets(counts, "__n")
    out = staged.join(F.broadcast(offsets), "__pid")
    return (out.withColumn(name, F.col("__off") + F.col("__pos") + 1)
               .drop("__pid", "__pos", "__mid", "__off"))


def global_running_sum(df: DataFrame, order: Sequence[str | Column], values: dict[str, str],
                       num_partitions: int | None = None) -> DataFrame:
    """Running sums (inclusive) of ``values`` (source -> output) over a global order.

    Inside a partition the running sum is a window partitioned by the partition
    index, i.e. bounded by one range partition.  Intended for tables whose order
    key is unique (e.g. distinct scores after a group-by).
    """
    staged = _stage(df, order, num_partitions).withColumn(
        "__pid", F.shiftright("__mid", _LOCAL_BITS))
    totals = staged.groupBy("__pid").agg(*[F.sum(src).alias(f"__t_{src}") for src in values])
    w_tot = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__t_{src}").over(w_tot), F.lit(0))
                                       .alias(f"__o_{src}") for src in values])
    w = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding,
                                                                 Window.currentRow)
    local = staged.withColumns({f"__l_{src}": F.sum(src).over(w) for src in values})
    out = local.join(F.broadcast(offsets), "__pid")
    return (out.withColumns({dst: F.col(f"__o_{src}") + F.col(f"__l_{src}")
                             for src, dst in values.items()})
               .drop("__pid", "__mid", *[f"__o_{s}" for s in values], *[f"__l_{s}" for s in values]))
