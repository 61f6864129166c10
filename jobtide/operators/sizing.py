"""Choices that depend on the size of the input files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Input bytes per shuffle partition.
BYTES_PER_PARTITION = 256 * 1024**2
# Rows per shuffle partition, where they are known: repetitive rows take hardly a byte of a file each.
ROWS_PER_PARTITION = 500_000
HASH_JOIN_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# The user's own number, and the one that has taken its place.
OWN_PARTITIONS = "spark.jobtide.ownInitialPartitionNum"


def file_bytes(scan: DataFrame) -> int:
    """Size of the files behind a plain file scan, from the listing alone."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(side: DataFrame, scan: DataFrame) -> DataFrame:
    """Mark ``side`` for broadcast if the files of ``scan`` are below the broadcast threshold.

    ``scan`` is the file scan that bounds the rows of ``side``. The planner's own
    estimate multiplies the sizes of joined tables, so it takes a dimension that
    is itself a join for huge and may broadcast the fact instead. Beyond the
    threshold no mark is set: the sides are then sorted and merged, and AQE
    splits hot keys.
    """
    spark = side.sparkSession
    threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(side) if file_bytes(scan) <= threshold else side


@contextmanager
def hash_joins(spark: SparkSession) -> Iterator[None]:
    """Let AQE hash the smaller side of a shuffled join instead of sorting both, where it measures that each of its
    partitions is small; larger ones are sorted and merged as before. A threshold of the user's own stays."""
    if spark.conf.get(HASH_JOIN_BYTES) not in ("0", "0b"):
        yield
        return
    # A smaller one than this has no effect.
    spark.conf.set(HASH_JOIN_BYTES, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.unset(HASH_JOIN_BYTES)


def size_shuffles(fact: DataFrame, rows: int = 0) -> None:
    """Start shuffles with enough partitions for ``fact``, of ``rows`` rows if known, to fit into executor memory.

    AQE merges partitions that turn out small but does not split evenly large
    ones, so the number to start with must grow with the input. It is set anew for
    each fact; where the session's own number is enough, what the user had set comes back.
    """
    conf = fact.sparkSession.conf
    now = conf.get(INITIAL_PARTITIONS, None) or ""
    own, _, ours = (conf.get(OWN_PARTITIONS, None) or "").partition("/")
    if not ours or ours != now:
        own = now  # the user has set it, not this function
    needed = str(max(file_bytes(fact) // BYTES_PER_PARTITION, rows // ROWS_PER_PARTITION))
    if int(needed) > int(own or conf.get("spark.sql.shuffle.partitions")):
        conf.set(OWN_PARTITIONS, f"{own}/{needed}")
        conf.set(INITIAL_PARTITIONS, needed)
    elif own:
        conf.set(INITIAL_PARTITIONS, own)
    else:
        conf.unset(INITIAL_PARTITIONS)
