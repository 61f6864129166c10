"""Importance resampling towards a target distribution of hashed words.

Every feature, a run of consecutive words, falls into a bucket by its CRC-32. The logarithm
of a bucket's share in the target over that in the documents is its gain, and the mean of a
document's gains is its weight. Weights with Gumbel noise in the order of their sums draw
documents without replacement in proportion to their weights.

The cutoff is found without a sort of all documents: a mergeable quantile sketch gives nested
brackets around it, one more pass counts exactly what lies above and inside each, and the
narrowest bracket that holds the cutoff is sorted, alone, to locate it. The widest bracket holds
all scores, so one always does.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import pick, stored
from jobtide.llm.ordered import running_sums
from jobtide.llm.words import ALNUM, LOWER, as_strings, firsts, numbered, slabs, spans

BUCKETS = 10_000
# The sketch's rank error is the number of rows over this.
ACCURACY = 10_000


def _hashed(
    raw: np.ndarray, offsets: np.ndarray, longest: int, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, first) of the features of one, two ... words of a slab, text by text."""
    raw = LOWER[raw]
    starts, ends = spans(raw, offsets, ALNUM)
    first = firsts(starts, offsets)
    ids, names = numbered(raw, starts, ends)
    names = names.to_pylist()
    yield np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))[ids], first
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for n in range(2, longest + 1):
        held = np.flatnonzero(row[: max(0, len(row) - n + 1)] == row[n - 1 :])
        grams = np.stack([ids[held + i] for i in range(n)], axis=1)
        kinds, own = np.unique(grams, axis=0, return_inverse=True)
        codes = [zlib.crc32(b" ".join([names[i] for i in kind])) % buckets for kind in kinds.tolist()]
        yield np.array(codes, np.int64)[own.ravel()], np.searchsorted(held, first)


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often features of the whole texts of `docs` (text) fall into each bucket.

    A task passes on one number for each bucket at most. Null and empty texts have no
    features, repeated rows count each, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, raw, offsets in slabs(as_strings(batch.column(0))):
                for found, _ in _hashed(raw, offsets, longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())], ["bucket", "n"]
        )

    parts = pick(docs, text="string").mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket floor(1000 ln) of its smoothed share in `target` over that in `source`.

    Takes two tables of `bucket_counts`; the driver gets one number for each bucket.
    """

    def counts(table: DataFrame) -> list[int]:
        out = [0] * buckets
        for row in table.toLocalIterator():
            out[row.bucket] = row.n
        return out

    s, t = counts(source), counts(target)
    whole_s, whole_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array(
        [math.floor(1000 * math.log((b + 1) * whole_s / ((a + 1) * whole_t))) for a, b in zip(s, t)], np.int64
    )


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id; a null id is an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of `docs` (doc_id, text), a row for each.

    weight is the floored mean of the gains of a text's features, 0 without any; null texts have none.
    """
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, raw, offsets in slabs(as_strings(batch.column(1))):
                size, total, words = 0, 0, None
                for found, first in _hashed(raw, offsets, longest, buckets):
                    upto = np.concatenate([[0], np.cumsum(gain[found])])
                    total, size = total + np.diff(upto[first]), size + np.diff(first)
                    words = np.diff(first) if words is None else words
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(words, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(total // np.maximum(size, 1), pa.int64()),
                    ],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    weights = pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long"
    )
    return weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _order() -> list[Column]:
    """The order of drawing: larger scores, then smaller ids, null last, then the row."""
    return [-F.col("score"), F.col("doc_id").isNull().cast("int"), F.coalesce("doc_id", F.lit(0)), F.col("row")]


def cutoff(scored: DataFrame, percent: int, accuracy: int = ACCURACY) -> tuple | None:
    """The key, as `_order` has it, of the last of the first `percent` of the rows; None if there is none."""
    top = 1 - percent / 100
    widths = [2 / accuracy]
    while widths[-1] < 1:
        widths.append(4 * widths[-1])
    edges = [min(max(top + side * width, 0.0), 1.0) for width in widths for side in (-1, 1)]
    sketch = scored.agg(
        F.count("*").alias("n"),
        F.percentile_approx("score", edges, accuracy).alias("edges"),
        F.min("score").alias("least"),
        F.max("score").alias("most"),
    ).first()
    wanted = percent * sketch.n // 100
    if not wanted:
        return None
    brackets = [*zip(sketch.edges[::2], sketch.edges[1::2]), (sketch.least, sketch.most)]
    score = F.col("score")
    counted = scored.agg(
        *[
            count
            for i, (low, high) in enumerate(brackets)
            for count in (
                F.count_if(score > high).alias(f"above{i}"),
                F.count_if(score >= low).alias(f"upto{i}"),
            )
        ]
    ).first()
    held = next(i for i in range(len(brackets)) if counted[f"above{i}"] < wanted <= counted[f"upto{i}"])
    low, high = brackets[held]
    above, inside = counted[f"above{held}"], counted[f"upto{held}"] - counted[f"above{held}"]
    keys = _order()
    bracket = scored.where(score.between(low, high)).select(
        F.lit(0).alias("all"), F.lit(1).cast("long").alias("one"), *[key.alias(f"k{i}") for i, key in enumerate(keys)]
    )
    sorted_ = running_sums(
        bracket, "bracket", "all", "one", [F.col(f"k{i}") for i in range(len(keys))], inside
    )
    last = sorted_.where(F.col("before") == wanted - above - 1).first()
    return tuple(last[f"k{i}"] for i in range(len(keys)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """All `docs` (doc_id, text) with weight and score, and the rank of those drawn towards `target` (text).

    Of the documents with `least_words` words or more the first `percent`, rounded down, are drawn
    in the order of score; ties go to smaller doc_ids, nulls last, and rows that repeat an id are drawn
    each for itself. rank is null where a document is not drawn. Features are runs of 1 to `longest`
    words. Null and empty texts have weight 0 and are not drawn. An empty table gives no rows, an
    empty target equal shares in all buckets. Other columns are left out.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    scored = weigh(docs, gain, longest, seed).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "resample-scored")
    eligible = F.col("n_words") >= least_words
    last = cutoff(scored.where(eligible), percent, accuracy)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = eligible & (F.struct(*_order()) <= F.struct(*[F.lit(k).cast(t) for k, t in zip(last, ("long", "int", "long", "long"))]))
    chosen = scored.where(drawn).select("*", F.lit(0).alias("all"), F.lit(1).cast("long").alias("one"))
    ranked = running_sums(chosen, "resample-drawn", "all", "one", _order())
    return ranked.select(*columns, (F.col("before") + 1).alias("rank")).unionByName(
        scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
