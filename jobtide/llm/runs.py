"""Periodic runs of words: an online sparse dynamic program over diagonals.

The words of a text matched against the same words `p` places earlier form the diagonal of
lag `p`. Word by word, each earlier occurrence of what stands here increments the match
length of its lag; a lag without an occurrence ends, and a diagonal that ends with enough
matches is a run of period `p`, emitted at once.

What keeps it sparse: a run of period `q` needs 3q matches (6 - q for short ones), so with
lags of 2^k to 2^(k+1) - 1 only occurrences of the whole window of 3 * 2^k words that ends here
can belong to one. Of these the nearest one is enough: if a window of at least `q` words of
a run with smallest period `q` came back sooner than after `q` words, the run would have a
smaller period (Fine and Wilf). So each word has one lag for each power of two at most, and a text
of n words takes n log n steps, however often its words repeat. Windows are named by
doubling, exactly, and a window that stands once in its text is not looked at further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jobtide.llm.frames import pick
from jobtide.llm.words import PRINTED, as_strings, firsts, numbered, slabs, spans

# A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4
SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, "
    "n_kept long, collapsed_sha256 string"
)
RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
FOUND = {
    **dict.fromkeys(("n_words", "n_runs", "start", "length", "period", "exponent_milli"), pa.int64()),
    "runs": pa.list_(RUN),
    "runs_sha256": pa.string(),
    "n_kept": pa.int64(),
    "collapsed_sha256": pa.string(),
}

Run = tuple[int, int, int]


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct key, and which keys stand more than once."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    return name.astype(np.int64), count[name] > 1


def occurrences(word: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(words, lags, window) of earlier occurrences that can belong to a run, by powers of two of the lag.

    `word` numbers the words of several texts, one behind the other, `row` the texts. The window
    of so many words that ends at the word stands `lag` words earlier, too, and not later.
    """
    n = len(word)
    width = int(word.max(initial=0)) + 1
    name = np.full(n, -1, np.int64)
    at = np.arange(2, n)
    at = at[row[at] == row[at - 2]]
    pairs, _ = _names(word[at - 1].astype(np.int64) * width + word[at])
    threes, _ = _names(pairs * width + word[at - 2])
    found, again = _names(row[at].astype(np.int64) * (n + 1) + threes)
    at, found = at[again], found[again]
    window, low = 3, 1
    while len(at):
        name[at] = found
        order = np.argsort(found, kind="stable")
        here, same = at[order], found[order]
        lag = here[1:] - here[:-1]
        near = (same[1:] == same[:-1]) & (low <= lag) & (lag < 2 * low)
        yield here[1:][near], lag[near], window
        held = at[at >= window]
        before = name[held - window]
        both = (before >= 0) & (row[held] == row[held - window])
        held, before = held[both], before[both]
        found, again = _names(name[held] * n + before)
        name[at] = -1
        at, found = held[again], found[again]
        window, low = 2 * window, 2 * low


def diagonals(events: Iterable[tuple[int, int, int]]) -> Iterator[Run]:
    """Runs (start, length, period) from (word, lag, window) in the order of the words.

    `live` holds the match length of every lag that the last word has incremented.
    """
    live: dict[int, int] = {}
    grown: dict[int, int] = {}
    at = -1

    def ended(last: int, lags: Iterable[int], lengths: dict[int, int]) -> Iterator[Run]:
        for lag in lags:
            length = lengths[lag] + lag
            if length >= max(LEAST, TIMES * lag):
                yield last - length + 1, length, lag

    for word, lag, window in events:
        if word != at:
            # The word before is complete: what it has not incremented has ended one word earlier.
            yield from ended(at - 1, live.keys() - grown.keys(), live)
            live, grown = grown, {}
            if word != at + 1:
                yield from ended(at, live, live)
                live = {}
            at = word
        grown[lag] = live.get(lag, window - 1) + 1
    yield from ended(at - 1, live.keys() - grown.keys(), live)
    yield from ended(at, grown, grown)


def _promising(word: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Which texts have five words in a row twice, as every run has; a few others may pass."""
    if len(word) < 5:
        return np.zeros(n_rows, bool)
    own = word.astype(np.uint64)
    key = row[4:].astype(np.uint64)
    for i in range(5):
        key = (key ^ own[i : len(own) - 4 + i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    inside = np.flatnonzero(row[4:] == row[:-4])
    order = inside[np.argsort(key[inside])]
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(n_rows, bool)
    out[row[order[1:][same]]] = True
    return out


def find(word: np.ndarray, first: np.ndarray) -> dict[int, list[Run]]:
    """The runs of each text that has any, by start, then period.

    `word` numbers the words of several texts, one behind the other; `first` is the number of
    each text's first word, with the number of all words at its end.
    """
    n_rows = len(first) - 1
    row = np.repeat(np.arange(n_rows, dtype=np.int32), np.diff(first))
    chosen = _promising(word, row, n_rows)[row]
    place = np.flatnonzero(chosen)  # the words looked at, and where they stand
    parts = list(occurrences(word[place], row[place]))
    if not parts:
        return {}
    at = np.concatenate([p[0] for p in parts])
    lag = np.concatenate([p[1] for p in parts])
    window = np.repeat([p[2] for p in parts], [len(p[0]) for p in parts])
    order = np.argsort(at, kind="stable")
    out: dict[int, list[Run]] = {}
    for start, length, period in diagonals(zip(at[order].tolist(), lag[order].tolist(), window[order].tolist())):
        text = int(row[place[start]])
        out.setdefault(text, []).append((int(place[start] - first[text]), length, period))
    for runs in out.values():
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def _collapsed(
    raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray
) -> tuple[bytes, np.ndarray]:
    """The kept words of each text joined by one space, as bytes and offsets."""
    begin = starts[kept]
    text = np.searchsorted(first, np.flatnonzero(kept), "right") - 1
    follows = np.zeros(len(begin), np.int64)
    # A word that is not the first one kept stands behind a byte of white space of its text.
    follows[1:] = text[1:] == text[:-1]
    change = np.zeros(len(raw) + 1, np.int8)
    np.add.at(change, begin - follows, 1)
    np.add.at(change, ends[kept], -1)
    taken = np.cumsum(change[:-1], dtype=np.int8) > 0
    out = raw[taken]
    out[~PRINTED[out]] = 0x20
    size = np.concatenate([[0], np.cumsum(taken)])
    return out.tobytes(), size[offsets]


def _slab(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """The values of `FOUND` for each text of a slab."""
    starts, ends = spans(raw, offsets, PRINTED)
    first = firsts(starts, offsets)
    runs = find(numbered(raw, starts, ends)[0], first)
    kept = np.ones(len(starts), bool)
    for text, own in runs.items():
        for start, length, period in own:
            kept[first[text] + start + period : first[text] + start + length] = False
    joined, cuts = _collapsed(raw, offsets, starts, ends, first, kept)
    n_kept = np.concatenate([[0], np.cumsum(kept)])[first]
    for i in range(len(offsets) - 1):
        own = runs.get(i, [])
        start, length, period = min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in own)
        yield (
            int(first[i + 1] - first[i]),
            len(own),
            start,
            length,
            period,
            1000 * length // period if own else None,
            [dict(zip(("start", "length", "period"), run)) for run in own],
            hashlib.sha256(lines.encode()).hexdigest(),
            int(n_kept[i + 1] - n_kept[i]),
            hashlib.sha256(joined[cuts[i] : cuts[i + 1]]).hexdigest(),
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The periodic runs of the whole texts of `docs` (doc_id, text), a row for each.

    n_words counts the words, runs lists every run (start, length, period) by start, then
    period; start, length, period and exponent_milli are those of the longest one (ties: smallest
    start, then period). n_kept and collapsed_sha256 tell of the words left once every run is
    reduced to its first period. Null and empty texts have no words: no runs, nulls for
    the longest, digests of nothing. Null doc_ids stay null, repeated rows are looked at each, an
    empty table gives no rows, other columns are left out. Texts are looked at in slabs of
    bounded bytes; a longer text is one slab.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, raw, offsets in slabs(as_strings(batch.column(1))):
                columns = map(pa.array, zip(*_slab(raw, offsets)), FOUND.values())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), *columns], ["doc_id", *FOUND]
                )

    return pick(docs, doc_id="long", text="string").mapInArrow(run, SCHEMA)
