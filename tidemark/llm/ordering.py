"""Places and running sums over a whole table, without one task that holds a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import materialise, small


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        n = batch.column(batch.schema.get_field_index("_amount")).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = total + np.cumsum(n)
        yield batch.append_column("_run", pa.array(ends - n, pa.int64()))
        total = int(ends[-1]) if len(ends) else total


def placed(rows: DataFrame, group: list[str], order: list[str], label: str, amount: str | None = None) -> DataFrame:
    """``rows`` with ``_at``: how many rows of the same ``group`` stand before it in ``order``, or what their ``amount`` adds up to.

    ``rows`` should be narrow and read from a table, as Spark samples them first to deal
    them out by range.  Each range is sorted and counted on its own; ranges are put
    together by a table with a row per range and group.  So a group of any size is spread
    over many tasks, and only its ranges meet in one.  The result is read from a table in
    the shared folder, so all who read it see the same places.  Group columns must not be
    null; ties of ``order`` may fall either way.
    """
    cols = [*group, *order]
    dealt = rows.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id())
    if amount is None:
        dealt = dealt.withColumn("_run", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        last = F.max("_run") + 1 - F.min("_run")
    else:
        dealt = dealt.withColumn("_amount", F.col(amount).cast("long"))
        dealt = dealt.mapInArrow(_running, StructType([*dealt.schema.fields, StructField("_run", LongType())])).drop("_amount")
        last = F.sum(F.col(amount).cast("long"))
    table = materialise(dealt, label)
    ranges = table.groupBy(*group, "_part").agg(F.min("_run").alias("_low"), last.alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*group, "_part", (F.coalesce(before, F.lit(0)) - F.col("_low")).alias("_shift"))
    joined = table.join(small(ranges), [*group, "_part"])
    return joined.select(*rows.columns, (F.col("_run") + F.col("_shift")).alias("_at"))
