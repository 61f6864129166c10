"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import (
    captures,
    grades,
    language,
    line_rules,
    mixing,
    neighbours,
    packing,
    pieces,
    resample,
    runs,
    simhash,
    suffixes,
    token_counts,
)
from jobtide.llm.frames import pick, table
from jobtide.llm.oracle import ORACLE_SQL


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of at most 1024 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents with its suffix sums."""
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"))
    return token_counts.length_histogram(lengths)


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours of every hundredth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line and document rules over all documents."""
    return line_rules.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_lines_removed",
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the texts decoded from them."""
    return pieces.round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        "n_byte_pieces",
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("decoded").cast("long").alias("n_decoded_chars"),
        F.crc32(F.encode("decoded", "utf-8")).alias("decoded_crc32"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those not held out."""
    return language.identify(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id"
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of all documents, learned from the labels."""
    docs = table(spark, sf_dir, "documents")
    return grades.score(docs, grades.train(docs, grades.graded(table(spark, sf_dir, "labels"))))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document repeats of smaller ones, in strings of 50 bytes."""
    return suffixes.removals(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, as the index of the archives has them."""
    return captures.archive_and_index(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def looped(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with every tenth text's words repeating from some place on, by a hash of the id.

    A text without words, or without an id, stays as it is.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    words = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0)))
    )
    placed = words.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, turns)), F.lit(1), F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which are made to repeat."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    return runs.periodic_runs(looped(docs)).drop("runs")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn towards the words of the benchmark."""
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times all words takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_neighbours": op2_neighbours,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_resampling": op12_resampling,
    "op13_mixing": op13_mixing,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
