"""Token counts from an exact length histogram.

Documents are aggregated by encoded length. Suffix sums over the histogram answer
totals, quantiles and truncated totals for every context limit, without reading a
text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.bpe import public_vocabulary, byte_encoder
from jobtide.llm.frames import pick, stored

# Lengths of one block of the suffix sums; blocks are summed first, then lengths within each.
BLOCK = 64


def encoded_lengths(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every whole text; a null text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(vocabulary or public_vocabulary()).encode
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"]
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents by length, with what suffix sums tell at each length.

    n_tokens; documents of this length; documents_at_least and tokens_at_least, the
    suffix sums; truncated_tokens, the total if every document is cut to n_tokens;
    share_at_most, the share of documents of at most this length.

    Rows with a null length are left out. An empty table gives no rows.
    """
    counts = stored(
        lengths.where(F.col("n_tokens").isNotNull())
        .groupBy("n_tokens")
        .agg(F.count("*").alias("documents"))
        .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)),
        "length-histogram",
    )
    tokens = F.col("n_tokens") * F.col("documents")
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    blocks = (
        counts.groupBy("block")
        .agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_documents"),
            F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_tokens"),
            F.sum("d").over(every).alias("all_documents"),
            F.sum("t").over(every).alias("all_tokens"),
        )
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        counts.withColumn("d", F.sum("documents").over(inside))
        .withColumn("t", F.sum(tokens).over(inside))
        .join(blocks, "block")
        .withColumn("documents_at_least", F.col("later_documents") + F.col("d"))
        .withColumn("tokens_at_least", F.col("later_tokens") + F.col("t"))
        .select(
            "n_tokens",
            "documents",
            "documents_at_least",
            "tokens_at_least",
            (
                F.col("all_tokens")
                - F.col("tokens_at_least")
                + F.col("n_tokens") * F.col("documents_at_least")
            ).alias("truncated_tokens"),
            (
                (F.col("all_documents") - F.col("documents_at_least") + F.col("documents"))
                / F.col("all_documents")
            ).alias("share_at_most"),
        )
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row (tokens, documents_cut): what remains if every document is cut to `limit`.

    Between two lengths of the histogram the total is linear in the limit, so the
    shortest length of at least `limit` tells it: tokens of shorter documents plus
    `limit` for each other one. No such length: the whole total.
    """
    longer = F.col("n_tokens") > limit
    return histogram.agg(
        F.coalesce(
            F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("documents")), F.lit(0)
        ).alias("tokens"),
        F.coalesce(F.sum(F.when(longer, F.col("documents"))), F.lit(0)).alias("documents_cut"),
    )


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """One row (n_tokens): the least length that at least `share` of the documents do not exceed.

    Null for an empty histogram.
    """
    return histogram.where(F.col("share_at_most") >= share).agg(F.min("n_tokens").alias("n_tokens"))
