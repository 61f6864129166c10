"""Running sums in a global order, by a range sort: no task ever holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from jobtide.llm.frames import stored

ROWS_PER_RANGE = 2_000_000


def running_sums(
    df: DataFrame, label: str, group: str, value: str, order: list[Column], rows: int = 0
) -> DataFrame:
    """`df` with `before`: the sum of `value` over earlier rows of its `group` in the given order.

    The rows are sorted by group and order over ranges, so a group with a third of all rows is
    spread over many tasks; rows that agree in all keys are told apart by a row number, and can
    be parted as well. Each task sums its own range. Only the first group of a range can have begun in
    an earlier one, so what has to be added is one number for each range at most. Null is a group.
    `rows`, if known, is the number of rows, for which the number of ranges is raised.
    """
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_RANGE)
    keys = [F.col(group), *order, F.col("_row")]
    schema = StructType([*df.schema, StructField("before", LongType()), StructField("_range", IntegerType())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, total = None, 0  # the group that the batches before ended with, and its sum
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = batch.column(batch.schema.get_field_index(group))
            codes = names.dictionary_encode(null_encoding="encode").indices.to_numpy()
            values = batch.column(batch.schema.get_field_index(value)).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
            upto = np.cumsum(values) - values
            before = upto - np.repeat(upto[starts], np.diff([*starts, n]))
            if last is not None and names[0].as_py() == last[0]:
                before[: starts[1] if len(starts) > 1 else n] += total
            last, total = (names[n - 1].as_py(),), int(before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before, pa.int64()), pa.array(np.full(n, part, np.int32))],
                schema.fieldNames(),
            )

    placed = stored(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
        .mapInArrow(sums, schema),
        label,
    )
    # A row for each range and group in it.
    whole = placed.groupBy("_range", group).agg(F.sum(value).alias("_own"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        whole.withColumn("_earlier", F.sum("_own").over(earlier))
        .where("_earlier IS NOT NULL")
        .select(F.col("_range").alias("_r"), F.col(group).alias("_g"), "_earlier")
    )
    # One row for each range at most, whatever the number of rows and groups.
    same = (placed["_range"] == F.col("_r")) & placed[group].eqNullSafe(F.col("_g"))
    return placed.join(F.broadcast(carried), same, "left").select(
        *df.columns, (F.col("before") + F.coalesce("_earlier", F.lit(0))).alias("before")
    )
