"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds
t_1 < t_2 < ... part them: P(grade >= k) = sigmoid(w.x - t_k). So a document gets an
expected grade and the tail probability of every grade from one sum.

Features are the distinct words, word beginnings and symbol runs of a text and a few marks
of its shape (repetition, symbols, capitals), hashed into `buckets` numbers. The model is fitted on at
most `sample` rated documents, chosen by a hash of doc_id; all documents are scored.

The task that fits holds four bytes for each feature of a sampled document and eight for each
that is fitted; whatever else it makes of them, it makes in blocks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import by_place, pick, place, stored, utf8

# Bytes of the word beginnings that are features beside the words.
STEMS = (4, 5, 6)
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKENS = re.compile(rb"[a-z0-9\x80-\xff]+|[^\sa-z0-9\x80-\xff]+")
# Documents whose features are made or read at once, and (row, column) pairs that are worked on at once.
DOCUMENTS, PAIRS = 256, 1 << 18


@dataclass(frozen=True)
class Settings:
    """Parameters of features and fit."""

    sample: int = 24_000  # rated documents to fit on, at most
    buckets: int = 1 << 20
    least_documents: int = 6  # rated documents that must hold a feature
    deviation: float = 4.0  # least deviation of a feature from chance, in standard deviations
    tested: int = 10_000  # features up to which that bar holds; it rises slowly beyond
    ridge: float = 0.05  # of the feature that changes the odds most; weaker ones have more
    rounds: int = 300  # steps of the fit, at most
    slope: float = 1e-6  # of the loss at its end


def features(text: str | None, buckets: int) -> np.ndarray:
    """A text's distinct feature numbers, in rising order."""
    raw = utf8(text)
    low = raw.lower()
    tokens = TOKENS.findall(low)
    kinds = set(tokens)
    n = max(len(tokens), 1)
    letters = max(len(raw) - raw.count(b" "), 1)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>!"))
    marks = [
        b"\x00distinct %d" % (20 * len(kinds) // n if n > 40 else -1),
        b"\x00symbols %d" % min(20 * symbols // n, 20),
        b"\x00capitals %d" % (10 * capitals // letters),
        b"\x00size %d" % n.bit_length(),
    ]
    stems = {b"\x01" + k[:size] for k in kinds for size in STEMS if len(k) > size}
    found = [*kinds, *stems, *marks]
    hashed = np.fromiter(map(crc32, found), np.int64, len(found))
    return np.unique(hashed % buckets)


def blocks(n: int, least: int = 0) -> Iterator[slice]:
    """Where `n` pairs part into blocks of at most `PAIRS`, or of `least` if that is more."""
    size = max(PAIRS, least)
    return (slice(at, at + size) for at in range(0, n, size))


def sums(keys: np.ndarray, others: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """For each key 0..size-1 the sum of the values of its others, added in the order of the pairs.

    Every block begins with the sums so far, so the blocks do not change the rounding.
    """
    out, own = np.zeros(size), np.arange(size)
    for block in blocks(len(keys), size):
        added = np.concatenate([out, values[others[block]]])
        out = np.bincount(np.concatenate([own, keys[block]]), added, size)
    return out


def telling(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """Features whose presence goes with reaching some grade, by (row, column) pairs, and their effects.

    The bar is one of significance alone, so with more ratings rarer features pass. It is
    `deviation` for up to `tested` features; beyond, it rises so that about as many pass by
    chance (a tail of exp(-z*z/2)): 5.03 at 2^20 features. Words of few documents would be
    learned by heart; they are left out. The effect is the largest change of the logarithm of
    the odds to reach a grade.
    """
    n = len(grades)
    held = sums(columns, rows, np.ones(n), settings.buckets)
    strongest, effect = np.zeros(settings.buckets), np.zeros(settings.buckets)
    for k in range(1, int(grades.max()) + 1):
        reached = (grades >= k).astype(float)
        share = reached.mean()
        good = sums(columns, rows, reached, settings.buckets)
        spread = np.sqrt(np.maximum(held * (1 - held / n), 1e-9) * share * (1 - share))
        strongest = np.maximum(strongest, np.abs(good - held * share) / spread)
        other = reached.sum() - good
        odds = np.log((good + 0.5) / (held - good + 0.5)) - np.log((other + 0.5) / (n - held - other + 0.5))
        effect = np.maximum(effect, np.abs(odds))
    candidates = (held >= settings.least_documents) & (held < n)
    surplus = max(1.0, np.count_nonzero(candidates) / settings.tested)
    least = np.sqrt(settings.deviation**2 + 2 * np.log(surplus))
    chosen = np.flatnonzero(candidates & (strongest >= least))
    return chosen, effect[chosen]


def fit(
    rows: np.ndarray,
    columns: np.ndarray,
    width: int,
    grades: np.ndarray,
    settings: Settings,
    effects: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for documents given as (row, column) pairs and grades 0..K.

    Thresholds are t_1 and the logarithms of the steps to the next ones, so they stay in
    order. The mean negative log-likelihood with the ridge is minimised by L-BFGS steps on the whole
    sample, in units of each feature's own curvature; everything is deterministic. With
    `effects` the ridge grows with the inverse square of a feature's effect, so that many
    weak features do not outvote a rare telling one.
    """
    ridge = np.full(width, settings.ridge)
    if effects is not None and width:
        ridge *= (effects.max() / np.maximum(effects, 1e-3)) ** 2
    top, n = int(grades.max()), len(grades)
    share = np.clip([(grades >= k).mean() for k in range(1, top + 1)], 1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    start = np.concatenate([np.zeros(width), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    own = np.arange(n)

    def cuts_of(theta: np.ndarray) -> np.ndarray:
        return theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1 :]))])

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        """The penalised loss and its slopes."""
        weights = theta[:width]
        steps = np.exp(theta[width + 1 :])
        score = sums(rows, columns, weights, n)
        tails = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts_of(theta), -30, 30)))
        full = np.concatenate([np.ones((n, 1)), tails, np.zeros((n, 1))], axis=1)
        slope = full * (1 - full)
        chance = np.maximum(full[own, grades] - full[own, grades + 1], 1e-9)
        up, down = slope[own, grades] / chance, slope[own, grades + 1] / chance
        by_score = -(up - down) / n
        by_cut = np.zeros(top)
        for k in range(top):
            by_cut[k] = (up[grades == k + 1].sum() - down[grades == k].sum()) / n
        slopes = np.empty_like(theta)
        slopes[:width] = sums(columns, rows, by_score, width) + ridge * weights / n
        slopes[width] = by_cut.sum()
        slopes[width + 1 :] = by_cut[::-1].cumsum()[::-1][1:] * steps
        return -np.log(chance).mean() + (ridge * weights**2).sum() / (2 * n), slopes

    # A unit of each parameter changes the slope of the loss about alike.
    held = sums(columns, rows, np.ones(n), width)
    unit = np.concatenate([1 / np.sqrt((0.1 * held + ridge) / n), np.ones(top)])
    theta = lowest(lambda x: _scaled(loss, x, unit), start / unit, settings.rounds, settings.slope) * unit
    return theta[:width], cuts_of(theta)


def _scaled(loss: Callable, x: np.ndarray, unit: np.ndarray) -> tuple[float, np.ndarray]:
    value, slopes = loss(x * unit)
    return value, slopes * unit


def lowest(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, slope: float, memory: int = 12
) -> np.ndarray:
    """Where a smooth function that gives its value and slopes is least, by L-BFGS with backtracking.

    Ends when no slope is above `slope`, no step lowers the value any more, or after `rounds` steps.
    """
    value, slopes = loss(x)
    moved: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if not len(x) or np.abs(slopes).max() <= slope:
            break
        way, parts = slopes.copy(), []
        for step, change in reversed(moved):
            part = (step @ way) / (step @ change)
            parts.append(part)
            way -= part * change
        if moved:
            step, change = moved[-1]
            way *= (step @ change) / (change @ change)
        for (step, change), part in zip(moved, reversed(parts)):
            way += (part - (change @ way) / (step @ change)) * step
        fall, length = slopes @ way, 1.0
        while True:
            there = x - length * way
            lower, then = loss(there)
            if lower <= value - 1e-4 * length * fall:
                break
            length /= 2
            if length < 1e-10:
                return x
        step, change = there - x, then - slopes
        if step @ change > 1e-12:
            moved = [*moved, (step, change)][-memory:]
        x, value, slopes = there, lower, then
    return x


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most `DOCUMENTS` at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS):
            yield batch.slice(at, DOCUMENTS)


def fitted(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """The model's rows from those of the sample: doc_id, grade, features as int32 in bytes.

    Of rows of one doc_id the first counts. Documents stand in the order of their ids.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    for piece in pieces(batches):
        found = piece.column(2).to_pylist()
        ids, marks = (piece.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        sizes = np.array([len(f) // 4 for f in found])
        parts.append((ids, marks, sizes, np.frombuffer(b"".join(found), "<i4")))
    if not parts:
        return
    ids, marks, sizes, flat = (np.concatenate(own) for own in zip(*parts))
    parts.clear()
    _, first = np.unique(ids, return_index=True)
    # Grades that no sampled document has are left out of the fit.
    present, grades = np.unique(marks[first], return_inverse=True)
    if len(present) < 2:
        return
    position = np.full(len(ids), -1, np.int32)
    position[first] = np.arange(len(first))
    rows = np.repeat(position, sizes)
    if len(first) < len(ids):
        rows, flat = rows[rows >= 0], flat[rows >= 0]
    common, effects = telling(rows, flat, grades, settings)
    number = np.full(settings.buckets, -1, np.int32)
    number[common] = np.arange(len(common))
    picked = []
    for block in blocks(len(flat)):
        at = number[flat[block]]
        picked.append((rows[block][at >= 0], at[at >= 0]))
    del flat
    rows, columns = (np.concatenate(own) for own in zip(*picked))
    picked.clear()
    order = np.argsort(rows, kind="stable")
    rows, columns = rows[order], columns[order]
    del order
    weights, cuts = fit(rows, columns, len(common), grades, settings, effects)
    for kind, numbers, values in (("weight", common, weights), ("cut", present[1:], cuts), ("least", present[:1], [0.0])):
        kinds = pa.array([kind] * len(numbers), pa.string())
        yield pa.RecordBatch.from_arrays(
            [kinds, pa.array(numbers, pa.int64()), pa.array(values, pa.float64())], ["kind", "number", "value"]
        )


def train(docs: DataFrame, ratings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The model as rows (kind, number, value): kind 'weight' by feature, 'cut' by grade.

    `ratings` holds (doc_id, grade), grades from 0; several ratings of a document count as
    the least. Null ids or grades are left out. With fewer than two grades among the
    sampled documents the model is empty. At most `settings.sample` documents are read by
    the one task that fits; the model has at most `settings.buckets` weights.
    """
    rated = (
        pick(ratings, doc_id="long", grade="int")
        .where("doc_id is not null and grade >= 0")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    share = settings.sample / max(rated.count(), 1)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = (
        rated.where(place < F.lit(int(min(1.0, 1.1 * share) * (1 << 30))))
        .orderBy(place, "doc_id")
        .limit(settings.sample)
    )
    # At most `sample` rows of 12 bytes.
    texts = pick(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [features(t, settings.buckets).astype("<i4").tobytes() for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array(found, pa.binary())],
                ["doc_id", "grade", "features"],
            )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fitted(batches, settings)

    extracted = stored(
        texts.mapInArrow(extract, "doc_id long, grade int, features binary"), "rated-features"
    )
    model = extracted.coalesce(1).mapInArrow(solve, "kind string, number long, value double")
    return stored(model, "grades-model")


class Model:
    """A trained model on the driver: at most `buckets` weights of 8 bytes, shared once with each executor."""

    def __init__(self, model: DataFrame, settings: Settings) -> None:
        rows = model.orderBy("kind", "number").toPandas()
        cuts = rows[rows["kind"] == "cut"]
        learned = rows[rows["kind"] == "weight"]
        weights = np.zeros(settings.buckets)
        weights[learned["number"].to_numpy(np.int64)] = learned["value"].to_numpy()
        self.shared = model.sparkSession.sparkContext.broadcast(weights)
        self.cuts = cuts["value"].to_numpy(float)
        least = rows[rows["kind"] == "least"]["number"].to_numpy(float)
        self.grades = np.concatenate([least, cuts["number"].to_numpy(float)])
        self.buckets = settings.buckets

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """For each text the probability of every grade but the least, or of a higher one."""
        sums = np.array([self.shared.value[features(t, self.buckets)].sum() for t in texts])
        return 1 / (1 + np.exp(-np.clip(sums.reshape(-1, 1) - self.cuts, -50, 50)))


def score(docs: DataFrame, model: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score every whole text of `docs` (doc_id, text); one row for each input row.

    Columns: doc_id; expected_grade; tail_probability, that of the highest grade; kept,
    whether it is at least a half. With an empty model nothing is known: expected_grade and
    tail_probability are null and every document is kept. A null text is scored as an
    empty one. Null doc_ids stay null; repeated rows are scored each; other columns are
    left out.
    """
    trained = Model(model, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            expected = top = pa.nulls(n, pa.float64())
            kept = pa.array([True] * n, pa.bool_())
            if len(trained.cuts) and n:
                tails = trained.tails(batch.column(1).to_pylist())
                expected = pa.array(trained.grades[0] + tails @ np.diff(trained.grades))
                top, kept = pa.array(tails[:, -1]), pa.array(tails[:, -1] >= 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), expected, top, kept],
                ["doc_id", "expected_grade", "tail_probability", "kept"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, expected_grade double, tail_probability double, kept boolean"
    )


def keep_good(docs: DataFrame, model: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` that `score` keeps, with all their columns.

    A null text is judged as an empty one, repeated rows are judged each, null doc_ids do not matter, an
    empty table gives no rows. Other columns come back unchanged, also where their names repeat or clash.
    """
    trained = Model(model, settings)
    at = place(docs, "text")
    plain = by_place(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(trained.cuts) and batch.num_rows:
                tails = trained.tails(batch.column(at).to_pylist())
                batch = batch.filter(pa.array(tails[:, -1] >= 0.5))
            yield batch

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from the labels table: 0 low quality, 1 good but toxic, 2 good; null labels give no rating."""
    plain = pick(labels, doc_id="long", quality="int", toxic="int")
    return plain.select(
        "doc_id",
        F.when(F.col("quality") == 0, 0)
        .when(F.col("toxic") == 1, 1)
        .when(F.col("toxic") == 0, 2)
        .alias("grade"),
    ).where("grade is not null")
