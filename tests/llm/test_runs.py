"""Periodic runs against plain code."""

import hashlib
import random
import zlib

import pytest

from jobtide.llm.queries import looped
from jobtide.llm.runs import periodic_runs


def plain_runs(words):
    """Every lag, every diagonal; of equal stretches the smallest period."""
    n, found = len(words), {}
    for lag in range(1, n // 4 + 1):
        i = lag
        while i < n:
            j = i
            while j < n and words[j] == words[j - lag]:
                j += 1
            start, length = i - lag, j - i + lag
            if length >= max(6, 4 * lag):
                found.setdefault((start, length), lag)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(text):
    words = (text or "").split(" ") if text else []
    words = [w for w in words if w]
    runs = plain_runs(words)
    kept = [True] * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = [False] * (length - period)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    joined = " ".join(w for w, k in zip(words, kept) if k)
    return (
        len(words),
        len(runs),
        *longest,
        1000 * longest[1] // longest[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        sum(kept),
        hashlib.sha256(joined.encode()).hexdigest(),
    )


COLUMNS = (
    "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "n_kept", "collapsed_sha256",
)


def texts():
    rng = random.Random(5)
    out = [None, "", "   ", "a", "a " * 5, "a " * 6, " b" * 5000, "x y z " * 900 + "x", "é ü " * 40]
    for _ in range(400):
        letters = "abcdef"[: rng.choice([1, 2, 3, 6])]
        words = [rng.choice(letters) for _ in range(rng.randrange(50))]
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))] * rng.choice([1, 1, 2])
        loop = [unit[i % len(unit)] for i in range(rng.randrange(90))]
        at = rng.randrange(len(words) + 1)
        out.append(rng.choice([" ", "  "]).join(words[:at] + loop + words[at:]))
    return out


def test_runs_match_plain_code(spark):
    rows = list(enumerate(texts()))
    rows += [rows[7], rows[20], (None, "q r " * 9)]
    found = periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = sorted(map(str, ((i, *plain_row(text)) for i, text in rows)))
    assert sorted(str((r.doc_id, *[r[c] for c in COLUMNS])) for r in found) == expected
    assert all([tuple(run) for run in r.runs] == sorted((tuple(run) for run in r.runs), key=lambda x: (x[0], x[2])) for r in found)


def test_white_space_is_five_controls_and_the_space(spark):
    text = "a\tb\na\x0bb\x0ca\rb a\x1fb a\x1fb"
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 8 and row.n_runs == 0
    text = "a\tb\na\x0bb\x0ca\rb a b"
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.n_kept) == (1, 0, 8, 2, 2)


def test_empty_table_and_clashing_columns(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    frame = spark.createDataFrame([(1, "u " * 7, "t", 3, 4)], "doc_id long, text string, TEXT string, DOC_ID int, `a.b` int")
    frame = frame.toDF("doc_id", "text", "TEXT", "DOC_ID", "a.b")
    assert [(r.doc_id, r.n_runs) for r in periodic_runs(frame).collect()] == [(1, 1)]


@pytest.mark.parametrize("text", ["one", "a b c d e f g h i j k l m n o p q r s t u v w x y z", " lead and trail ", "", None])
def test_looped_texts(spark, text):
    docs = spark.createDataFrame([(i, text) for i in range(60)] + [(None, text)], "doc_id long, text string")
    for row in looped(docs).collect():
        words = (text or "").split()
        h = zlib.crc32(str(row.doc_id).encode())
        if row.doc_id is None or h % 10 or not words:
            assert row.text == text
            continue
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert row.text.split() == [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
