"""Mixing sources to target weights by distributed prefix sums.

Each source has a budget of words. Its documents get hash-random keys and are range-sorted
by source and key; running sums of their sizes, made range by range, say where each one
lies in the source's random order. The budget is spent on whole passes over the source while
it lasts, then on the documents in order, and is cut exactly inside the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import pick, stored
from jobtide.llm.ordered import running_sums
from jobtide.llm.words import PRINTED, as_strings, slabs, spans

# Fixed value: what is no word, as a pattern.
WORD = "[^\\x20\\x09-\\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of `docs` (doc_id, source, text): the number of words of the whole text.

    Null and empty texts have size 0, null ids and sources stay null, repeated rows are counted
    each, an empty table gives no rows. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [
                np.diff(np.searchsorted(spans(raw, offsets, PRINTED)[0], offsets))
                for _, _, raw, offsets in slabs(as_strings(batch.column(2)))
            ]
            size = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size], ["doc_id", "source", "size"])

    return pick(docs, doc_id="long", source="string", text="string").mapInArrow(
        run, "doc_id long, source string, size long"
    )


def in_turn(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """`sources` (one row for each source) with `weight`: the cycle's weights by code point, null last."""
    counted = sources.select("*", F.lit(0).alias("_all"), F.lit(1).cast("long").alias("_one"))
    order = [F.col("source").isNull().cast("int"), F.col("source")]
    placed = running_sums(counted, "mix-sources", "_all", "_one", order)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    turn = (F.col("before") % len(cycle) + 1).cast("int")
    return placed.withColumn("weight", F.element_at(weights, turn)).drop("_all", "_one", "before")


def targets(sources: DataFrame, share: float, times: float) -> DataFrame:
    """`sources` (source, source_size, weight) with `target`, their part of `share` times all words.

    No target exceeds `times` its source's size; the excess is shared again by weight among the
    others until none is above. Each round is one sum over the sources that gives the driver three
    numbers, and at least one more source reaches its limit in it.
    """
    whole = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    budget = share * (whole.n or 0)
    level, full = (budget / whole.w if whole.w else 0.0), 0
    limit = times * F.col("source_size")
    while True:
        above = limit < F.lit(level) * F.col("weight")
        now = sources.agg(
            F.count_if(above).alias("full"),
            F.sum(F.when(above, limit)).alias("spent"),
            F.sum(F.when(~above, F.col("weight"))).alias("left"),
        ).first()
        if now.full == full or not now.left:
            break
        level, full = (budget - now.spent) / now.left, now.full
    # If all are at their limit there is nobody left to share with.
    own = limit if now.full and not now.left else F.least(limit, F.lit(level) * F.col("weight"))
    return sources.withColumn("target", own.cast("double"))


def mix(
    docs: DataFrame,
    cycle: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    times: int = 2,
    seed: int = 2024,
) -> DataFrame:
    """What a mix of `docs` (doc_id, source, text) takes of each document, a row for each.

    size and source_size count words, target is the words wanted of the source (see `targets`; weights
    from `in_turn`), taken those taken of the document: `epochs` times the whole and the first `cut`
    words once more. The taken words of a source sum up to its target, rounded down. The order within
    a source is that of a hash of seed and id, so runs agree; rows that repeat an id follow by
    size, largest first, and rows that agree in id, source and size are interchangeable. A null id is an empty
    text, a null source is a source. An empty table gives no rows, other columns are left out.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    sized = stored(sizes(docs).withColumn("key", F.unhex(F.substring(key, 1, 16))), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = stored(in_turn(stored(per_source, "mix-totals"), cycle), "mix-weights")
    rows = sources.agg(F.sum("docs")).first()[0] or 0
    wanted = targets(sources, share, times).select(F.col("source").alias("_source"), "source_size", "target")
    placed = running_sums(
        sized, "mix-order", "source", "size", [F.col("key"), F.col("doc_id"), -F.col("size")], rows
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return (
        placed.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "source", "size", "source_size", "target", epochs.alias("epochs"), cut.alias("cut"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("cut"))
    )


def mixed_texts(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc_id, source, epoch, text): the texts that a plan of `mix` takes, a row for each pass.

    Whole passes give the text as it is, the cut one its first words joined by a space; what nothing
    is taken of gives no row. `docs` must have unique, non-null ids. Hot sources do not matter: the
    join is on the id.
    """
    taken = plan.select("doc_id", "epochs", "cut")
    both = pick(docs, doc_id="long", source="string", text="string").join(taken, "doc_id")
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("cut").cast("int")), " ")
    texts = F.concat(
        F.array_repeat(F.col("text"), F.col("epochs").cast("int")),
        F.when(F.col("cut") > 0, F.array(first_words)).otherwise(F.array().cast("array<string>")),
    )
    return both.select("doc_id", "source", F.posexplode(texts).alias("epoch", "text"))
