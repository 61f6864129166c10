"""Language identification by rank-order profiles.

A profile is the list of the most frequent n-grams (one to three letters, words padded by
a space), most frequent first. A document's profile is compared with that of each
language by the out-of-place distance: the sum over its n-grams of how far their ranks
lie apart, and the profile's length for an n-gram that the language's profile lacks. The
nearest language is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.frames import pick, stored

WIDE = np.uint64(21)  # bits of a code point
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Parameters of the profiles."""

    longest: int = 3  # letters of an n-gram, at most 3
    profile: int = 400  # n-grams of a language's profile
    own: int = 400  # n-grams of a document's profile
    slab: int = 1 << 18  # characters that are counted together
    languages: int = 64  # languages that a task sums at a time


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, its lower-case letter, or 0 if it is no letter."""
    points = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            points[point] = ord(low) if len(low) == 1 else point
    return points


def profile_counts(texts: list[str], longest: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """All n-grams of some texts, and for each text the numbers of its n-grams and their counts.

    An n-gram is its code points, 21 bits each. Runs of other characters are one space; a
    gram of a space alone, or with a space inside, does not count.
    """
    joined = "".join(f" {t} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = letters()[points]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    keep = low > 0
    keep[1:] |= low[:-1] > 0
    # A text's first space stays; the next one stood behind a space.
    keep[np.cumsum([0, *[len(t) + 2 for t in texts[:-1]]])] = True
    low, owner = low[keep].astype(np.uint64), owner[keep]
    blank = low == 0
    low[blank] = 32
    grams, owners = [low[~blank]], [owner[~blank]]
    run = low
    for n in range(2, longest + 1):
        run = (run[:-1] << WIDE) | low[n - 1 :]
        first = owner[: len(run)]
        good = first == owner[n - 1 :]
        for inner in range(1, n - 1):
            good &= ~blank[inner : inner + len(run)]
        if n == 2:
            good &= ~(blank[:-1] & blank[1:])
        grams.append(run[good])
        owners.append(first[good])
    flat, owned = np.concatenate(grams), np.concatenate(owners)
    numbers, kinds = pd.factorize(flat)
    order = np.argsort(owned, kind="stable")
    numbers = numbers[order]
    ends = np.searchsorted(owned[order], np.arange(len(texts) + 1))
    found, counts = [], []
    for begin, end in zip(ends.tolist(), ends[1:].tolist()):
        count = np.bincount(numbers[begin:end], minlength=len(kinds) if end - begin > len(kinds) // 8 else 0)
        held = np.flatnonzero(count)
        found.append(held)
        counts.append(count[held])
    return kinds, found, counts


def slabs(texts: list[str | None], size: int) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of about `size` characters, with the number of the first."""
    first, group, held = 0, [], 0
    for i, text in enumerate(texts):
        group.append(text or "")
        held += len(group[-1])
        if held >= size or i == len(texts) - 1:
            yield first, group
            first, group, held = i + 1, [], 0


def learn(samples: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Profiles (lang, gram, rank) of the languages of `samples` (text, lang), rank from 0.

    All rows count with their whole texts; each task sends one row for each language and
    n-gram. Ties in frequency go to the smaller code points. Null texts or languages are
    left out; an empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, pd.Series] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(total), pa.string()),
                        pa.array(total.index.to_numpy(np.uint64).view(np.int64), pa.int64()),
                        pa.array(total.to_numpy(np.int64), pa.int64()),
                    ],
                    ["lang", "gram", "n"],
                )
            sums.clear()

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, texts in slabs(batch.column(0).to_pylist(), settings.slab):
                kinds, found, counts = profile_counts(texts, settings.longest)
                by_lang: dict[str, np.ndarray] = {}
                for i in range(len(texts)):
                    total = by_lang.setdefault(langs[first + i], np.zeros(len(kinds), np.int64))
                    total[found[i]] += counts[i]
                for lang, total in by_lang.items():
                    held = np.flatnonzero(total)
                    more = pd.Series(total[held], kinds[held])
                    sums[lang] = sums[lang].add(more, fill_value=0) if lang in sums else more
                if len(sums) > settings.languages:
                    yield from send()
        yield from send()

    counts = (
        pick(samples, text="string", lang="string")
        .where("text is not null and lang is not null")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.withColumn("rank", F.row_number().over(ranked) - 1)
        .where(F.col("rank") < settings.profile)
        .select("lang", "gram", "rank")
    )


def predict(docs: DataFrame, profiles: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The nearest language of every whole text of `docs` (doc_id, text).

    Columns: doc_id; lang_pred; score from 0 to 1, one less the distance as a share of the
    largest possible. Only the text is looked at. Texts that are null or have no letter,
    and all texts if no language was learned, get `und` and score 0. Of equally near
    languages the first by name is taken. Null doc_ids stay null, repeated rows are judged
    each, other columns are left out.
    """
    known = profiles.toPandas()  # `profile` rows a language
    langs = sorted(known["lang"].unique())
    grams = np.unique(known["gram"].to_numpy(np.int64).view(np.uint64))
    ranks = np.full((len(langs), len(grams) + 1), -1, np.int64)
    at = np.searchsorted(grams, known["gram"].to_numpy(np.int64).view(np.uint64))
    ranks[np.searchsorted(langs, known["lang"].to_numpy(str)), at] = known["rank"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for _, texts in slabs(batch.column(1).to_pylist(), settings.slab):
                kinds, found, counts = profile_counts(texts, settings.longest)
                place = np.minimum(np.searchsorted(grams, kinds), max(len(grams) - 1, 0))
                if len(grams):
                    place = np.where(grams[place] == kinds, place, len(grams))
                by_kind = ranks[:, place]
                for held, count in zip(found, counts):
                    if not len(held) or not langs:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    # Most frequent first, ties by the gram itself.
                    if len(held) > settings.own:
                        least = np.partition(count, len(count) - settings.own)[-settings.own]
                        held, count = held[count >= least], count[count >= least]
                    held = held[np.lexsort((kinds[held], -count))][: settings.own]
                    theirs = by_kind[:, held]
                    away = np.where(
                        theirs < 0,
                        settings.profile,
                        np.minimum(np.abs(theirs - np.arange(len(held))), settings.profile),
                    ).sum(axis=1)
                    best = int(away.argmin())
                    names.append(langs[best])
                    scores.append(1 - float(away[best]) / (settings.profile * len(held)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows of `docs` (doc_id, text, lang) that are not held out, predict all rows."""
    rows = pick(docs, doc_id="long", text="string", lang="string")
    profiles = stored(learn(rows.where(~held_out()), settings), "language-profiles")
    return predict(rows, profiles, settings).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
