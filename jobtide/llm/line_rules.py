"""Line-first cleaning.

Every line of a text is judged on its own by rules for punctuation, navigation and
boilerplate. What is boilerplate is counted, whatever its language: a short line that stands in
many different texts (copies of a text count once). Failing lines are removed. A document is rejected if it then has lost too
much of its text, or if it is too short or too repetitive as a whole.

The cost of a document follows its length: words are interned once, repeated windows
are found by doubling exact pair numbers, so nothing is compared pair by pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import by_place, pick, place, stored, utf8

# The characters that part words, and the symbols that are counted.
WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
# What boilerplate lines say, in lower case.
BOILERPLATE = re.compile(
    rb"lorem ipsum|javascript|cookie|privacy policy|terms of (?:use|service)"
    rb"|all rights reserved|copyright \(c\)|subscribe to|sign up|log ?in to|click here|read more"
    rb"|share this|page not found"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the line and document rules."""

    navigation_bars: float = 0.2  # share of a line's words that are separators such as | or >
    navigation_symbols: float = 0.3  # symbols for each word of a line
    shouting: float = 0.7  # share of a line's words that end in two stops or more
    bare_words: int = 3  # a line without a closing mark needs more words than this
    boilerplate_words: int = 30  # a longer line that mentions boilerplate is prose about it
    common_percent: int = 1  # of the different texts that hold a short line make it boilerplate ...
    common_texts: int = 20  # ... if they are so many at least
    most_lost: float = 0.5  # share of a document's characters in removed lines
    least_words: int = 20
    window: int = 8
    most_repeated: int = 30  # percent of words in repeated windows


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[
            (c, pa.int64())
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_removed")
        ],
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("clean_text", pa.string()),
    ]
)
COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_lines_removed long, base_failed boolean, kept boolean, clean_text string"
)
CLOSING = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", b"]", "”".encode(), "…".encode())
BARS = {b"|", b">", b">>", "»".encode(), "·".encode(), "•".encode(), b"/", b"-", b"<", b"<<"}
DOUBLED = (b"!!", b"??", b"..")


def repeated_words(words: list[bytes], size: int) -> int:
    """Words in windows of `size` (a power of two) that are found twice or more, the first included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) > len(words) - size:  # a repeated window repeats `size` words
        return 0
    step = 1
    while step < size:
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids = np.unique(pairs, return_inverse=True)
        if len(ids) == int(ids.max()) + 1:
            return 0
        step *= 2
    again = np.bincount(ids)[ids] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    marks[:n] += again
    marks[size : size + n] -= again
    return int(np.count_nonzero(np.cumsum(marks)[:-1]))


def line_fails(line: bytes, rules: Rules) -> bool:
    """Whether a line with a word is noise: navigation, symbols, shouting, boilerplate, a bare label."""
    words = line.split()
    n = len(words)
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols > rules.navigation_symbols * n:
        return True
    if sum(map(BARS.__contains__, words)) > rules.navigation_bars * n:
        return True
    if n <= rules.bare_words and not line.rstrip().endswith(CLOSING):
        return True
    if any(map(line.__contains__, DOUBLED)):
        if sum(w.endswith(DOUBLED) for w in words) > rules.shouting * n:
            return True
    return n <= rules.boilerplate_words and BOILERPLATE.search(line.lower()) is not None


def line_key(line: bytes) -> bytes:
    """What a line is counted by: a digest of it without the white space around it."""
    return md5(line.strip(WHITE), usedforsecurity=False).digest()


def common_lines(docs: DataFrame, rules: Rules = Rules()) -> frozenset[bytes]:
    """Keys of the short lines that are boilerplate in `docs` (text).

    (line, text) pairs are made distinct before lines are counted, both with partial sums, so a line of all
    texts is no hot key. The driver gets at most 100 / `common_percent` keys of 16 bytes for each short
    line that a text has in the mean, whatever the number of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, texts = [], []
            for text in batch.column(0).to_pylist():
                raw = utf8(text)
                short = {
                    line_key(line)
                    for line in raw.split(b"\n")
                    if 0 < len(line.split()) <= rules.boilerplate_words
                }
                if not raw.strip(WHITE):
                    continue
                lines += [None, *short]  # null counts the texts
                texts += [md5(raw, usedforsecurity=False).digest()] * (1 + len(short))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines, pa.binary()), pa.array(texts, pa.binary())], ["line", "text"]
            )

    pairs = pick(docs, text="string").mapInArrow(run, "line binary, text binary").distinct()
    counted = stored(pairs.groupBy("line").agg(F.count("*").alias("holders")), "line-holders")
    whole = counted.where("line is null").first()
    if whole is None:
        return frozenset()
    enough = F.expr(f"holders >= {rules.common_texts} and 100 * holders >= {rules.common_percent * whole.holders}")
    return frozenset(bytes(row.line) for row in counted.where(F.col("line").isNotNull() & enough).collect())


def judge(text: str | None, rules: Rules = Rules(), common: frozenset[bytes] = frozenset()) -> tuple:
    """The columns of one document behind doc_id; `common` holds the keys of boilerplate lines."""
    raw = utf8(text)
    words = raw.split()
    n_words = len(words)
    bare = raw.translate(None, WHITE)
    word_chars = len(bare) if raw.isascii() else len(bare.decode("utf-8", "surrogatepass"))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = raw.split(b"\n")
    seen: set[bytes] = set()
    with_words = duplicates = removed = lost = total = 0
    kept_lines = []
    for line in lines:
        bare_size = len(line) if line else 0
        if not line.strip(WHITE):
            kept_lines.append(line)
            continue
        with_words += 1
        total += bare_size
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        known = common and len(line.split()) <= rules.boilerplate_words and line_key(line) in common
        if known or line_fails(line, rules):
            removed += 1
            lost += bare_size
        else:
            kept_lines.append(line)
    repeats = repeated_words(words, rules.window)
    base_failed = n_words < rules.least_words or 100 * repeats > rules.most_repeated * n_words
    kept = not base_failed and lost <= rules.most_lost * total
    if text is None or not removed:
        clean = text
    else:
        clean = b"\n".join(kept_lines).decode("utf-8", "surrogatepass")
    return (
        n_words, word_chars, n_symbols, duplicates, repeats, with_words, removed, base_failed, kept, clean,
    )


def clean_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Judge every whole text of `docs` (doc_id, text); one row for each input row.

    Columns: doc_id; n_words; word_chars, code points in words; n_symbols; n_dup_lines,
    lines with a word that equal an earlier line; n_repeat_words; n_lines with a word and
    n_lines_removed; base_failed; kept; clean_text, the text without the lines that fail.

    A null text has no words, fails the base rule and stays null. Null doc_ids stay
    null. Repeated rows are judged each. An empty table gives no rows. Other columns
    are left out.
    """
    common = common_lines(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(text, rules, common) for text in batch.column(1).to_pylist()]
            if not rows:
                continue
            columns = [batch.column(0), *zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, SCHEMA)],
                schema=SCHEMA,
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(run, COLUMNS)


def keep_clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that the rules keep, their text without the lines that fail.

    n_chars, if there, follows the text. A null or empty text fails, repeated rows are judged each,
    null doc_ids do not matter, an empty table gives no rows. Other columns come back unchanged,
    also where their names repeat or clash.
    """
    at, size = place(docs, "text"), place(docs, "n_chars")
    plain = by_place(docs)
    common = common_lines(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(text, rules, common) for text in batch.column(at).to_pylist()]
            new = {at: pa.array([j[-1] for j in judged], batch.column(at).type)}
            if size is not None:
                sizes = pa.array([None if j[-1] is None else len(j[-1]) for j in judged], pa.int64())
                new[size] = sizes.cast(batch.column(size).type)
            columns = [new.get(i, column) for i, column in enumerate(batch.columns)]
            out = pa.RecordBatch.from_arrays(columns, batch.schema.names)
            yield out.filter(pa.array([j[-2] for j in judged], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
