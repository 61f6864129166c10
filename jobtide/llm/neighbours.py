"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to `width` dimensions by Gaussian columns, which are 2-stable: the
squared projected distance of two vectors over their squared distance follows a
chi-square law with `width` degrees of freedom. Projected points are indexed by a
kd-tree. A query goes through it in the order of projected distance and verifies what it
meets on the whole vectors, until the chi-square test says that with probability
`certainty` a vector nearer than the k-th found would have been met.

The upper levels of the tree, fitted on a bounded sample, part all vectors into cells;
every vector is indexed. Each shard of a cell builds its lower levels itself. A query
searches its own cell first and then the cells that pass the test against the distance it
brings along. Only the queries travel; the vectors stay in their buckets, unless a shard
is asked by more than `block` queries: then they come in blocks, each a group of its own
with a copy of the shard's vectors.

Hot vectors: of equal vectors only the `k + 1` smallest ids can be in any answer, so every
task passes on no more, and equal queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.frames import bucketed, pick, stored
from jobtide.llm.simhash import mix


@dataclass(frozen=True)
class Settings:
    """Parameters of index and search."""

    neighbours: int = 10
    width: int = 8  # projected dimensions, an even number
    certainty: float = 0.99
    seed: int = 20_25
    sample: int = 16_384  # vectors that the upper levels are fitted on, at most
    shard: int = 8_192  # vectors of a shard, about
    leaf: int = 128
    block: int = 4_096  # queries that one task holds against a shard at once, about


def chi_square(x: float, freedom: int) -> float:
    """Distribution function of the chi-square law for an even number of degrees of freedom."""
    half = x / 2
    return 1 - exp(-half) * sum(half**i / factorial(i) for i in range(freedom // 2))


def stopping_ratio(certainty: float, freedom: int) -> float:
    """The squared projected over the squared true distance beyond which the test stops."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < certainty else (low, middle)
    return high


def projection(dimensions: int, settings: Settings) -> np.ndarray:
    """The projecting matrix; the same for a seed on every machine."""
    return np.random.default_rng(settings.seed).standard_normal((dimensions, settings.width))


class Cells:
    """Upper levels of the kd-tree: cells with their boxes."""

    def __init__(self, points: np.ndarray, cells: int) -> None:
        width = points.shape[1]
        self.axis, self.cut, self.child = [], [], []
        self.low, self.high = [], []

        def part(own: np.ndarray, want: int, low: np.ndarray, high: np.ndarray) -> int:
            """Number of a node, or -1 - cell."""
            spread = np.ptp(own, axis=0) if len(own) else np.zeros(width)
            axis = int(spread.argmax())
            if want <= 1 or len(own) < 4 or spread[axis] == 0:
                self.low.append(low)
                self.high.append(high)
                return -len(self.low)
            cut = float(np.median(own[:, axis]))
            left = own[:, axis] < cut
            if not left.any():
                cut = float(np.nextafter(cut, np.inf))
                left = own[:, axis] < cut
            node = len(self.axis)
            self.axis.append(axis)
            self.cut.append(cut)
            self.child.append([0, 0])
            upper, lower = high.copy(), low.copy()
            upper[axis] = lower[axis] = cut
            self.child[node][0] = part(own[left], want // 2, low, upper)
            self.child[node][1] = part(own[~left], want - want // 2, lower, high)
            return node

        self.root = part(points, cells, np.full(width, -np.inf), np.full(width, np.inf))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def __len__(self) -> int:
        return len(self.low)

    def find(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                out[own] = -1 - node
            elif len(own):
                left = points[own, self.axis[node]] < self.cut[node]
                todo += [(self.child[node][0], own[left]), (self.child[node][1], own[~left])]
        return out

    def squared_distances(self, point: np.ndarray) -> np.ndarray:
        """Least squared projected distance from a point to each cell."""
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (away**2).sum(axis=1)


class Tree:
    """A shard's kd-tree: its vectors in the order of the leaves, and the leaves' boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, leaf: int) -> None:
        order: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            own = todo.pop()
            if len(own) <= leaf:
                order.append(own)
                continue
            axis = int(np.ptp(points[own], axis=0).argmax())
            half = len(own) // 2
            ranked = own[np.argpartition(points[own, axis], half)]
            todo += [ranked[half:], ranked[:half]]
        at = np.concatenate(order)
        self.ids, self.vectors, self.points = ids[at], vectors[at], points[at]
        self.ends = np.cumsum([len(o) for o in order])
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.low = np.minimum.reduceat(self.points, self.begins)
        self.high = np.maximum.reduceat(self.points, self.begins)

    def nearest(
        self, vector: np.ndarray, point: np.ndarray, most: int, bound: float, ratio: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the `most` nearest found within `bound`, nearest first, then by id."""
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        boxes = (away**2).sum(axis=1)
        ids, found = np.zeros(0, np.int64), np.zeros(0)
        for leaf in np.argsort(boxes, kind="stable").tolist():
            if boxes[leaf] > ratio * bound * bound:
                break
            own = slice(self.begins[leaf], self.ends[leaf])
            near = ((self.points[own] - point) ** 2).sum(axis=1) <= ratio * bound * bound
            exact = np.sqrt(((self.vectors[own][near] - vector) ** 2).sum(axis=1))
            good = exact <= bound
            if not good.any():
                continue
            ids = np.concatenate([ids, self.ids[own][near][good]])
            found = np.concatenate([found, exact[good]])
            if len(ids) > most:
                best = np.lexsort((ids, found))[:most]
                ids, found = ids[best], found[best]
            if len(ids) == most:
                bound = min(bound, found.max())
        best = np.lexsort((ids, found))
        return ids[best], found[best]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the vectors that take part.

    Left out are null ids, and vectors that are null, zero, hold null or non-finite numbers,
    or have another length than most.
    """
    plain = pick(vectors, vec_id="long", embedding="array<double>").where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
    )

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    plain = plain.where(F.forall("embedding", good)).where(F.exists("embedding", lambda x: x != 0))
    common = (
        plain.groupBy(F.size("embedding").alias("n"))
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), "n")
        .first()
    )
    size = common["n"] if common else 0
    return plain.where(F.size("embedding") == size).withColumnRenamed("embedding", "vector")


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of numbers from lists of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def smallest_ids(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows that stay if of equal vectors the `most` smallest ids stay, each once."""
    kinds, _ = pd.factorize(np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * 8}").ravel().astype("O"))
    order = np.lexsort((ids, kinds))
    kinds, ids = kinds[order], ids[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (kinds[1:] != kinds[:-1]) | (ids[1:] != ids[:-1])
    order, kinds = order[fresh], kinds[fresh]
    new = np.ones(len(kinds), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    begin = np.flatnonzero(new)
    rank = np.arange(len(kinds)) - np.repeat(begin, np.diff(np.append(begin, len(kinds))))
    return np.sort(order[rank < most])


FOUND = "query bigint, vec_id bigint, score double"


def search(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """The nearest neighbours of the vectors marked by `is_query`, among all of `vectors`.

    `vectors` has vec_id and embedding. Columns: query_id; rank from 1; vec_id; score, the
    Euclidean distance of the whole vectors in double precision. Neighbours come nearest
    first, ties by the smaller vec_id; a row is no neighbour of its own vec_id. Fewer than
    `neighbours` candidates: all that are found. Repeated rows count once. `usable` says which
    vectors take part; a table without any gives no rows. Other columns are left out.
    """
    most = settings.neighbours + 1
    spark = vectors.sparkSession
    rows = usable(vectors)
    total = rows.count()
    nothing = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], nothing)
    place = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30))
    share = min(1.0, 1.1 * settings.sample / total)
    fitted = rows.where(place < int(share * (1 << 30))).select("vector").limit(settings.sample).collect()
    dimensions = len(fitted[0][0]) if fitted else len(rows.first()["vector"])
    directions = projection(dimensions, settings)
    sample = np.array([r[0] for r in fitted], float).reshape(-1, dimensions) @ directions
    shards = max(1, -(-total // settings.shard))
    cells = Cells(sample, min(shards, max(1, len(sample) // 32)))
    salts = max(1, -(-shards // len(cells)))
    ratio = stopping_ratio(settings.certainty, settings.width)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, own = batch.column(0).to_numpy(), matrix(batch.column(1), dimensions)
            stay = smallest_ids(ids, own, most)
            cell = cells.find(own[stay] @ directions)
            shard = cell * salts + ids[stay] // 7 % salts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(stay)), batch.column(1).take(pa.array(stay)), pa.array(shard)],
                ["vec_id", "vector", "shard"],
            )

    index = bucketed(
        rows.mapInArrow(file, "vec_id bigint, vector array<double>, shard bigint"),
        "vector-shards",
        "shard",
        len(cells) * salts,
    )
    asked = stored(rows.where(is_query), "queries")
    # Equal queries are searched once, under the smallest id.
    queries = stored(asked.groupBy("vector").agg(F.min("vec_id").alias("query")), "distinct-queries")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int], list[int]]]:
        """Places of queries in their batch and shards to visit, some thousands at a time.

        A query visits its own cell, or the others that pass the test.
        """
        for batch in batches:
            own = matrix(batch.column(0), dimensions) if batch.num_rows else np.zeros((0, dimensions))
            bounds = batch.column(2).to_numpy(zero_copy_only=False)
            points = own @ directions
            home = cells.find(points)
            which, where = [], []
            for i in range(len(points)):
                if bounds[i] < 0:
                    visit = home[i : i + 1]
                else:
                    reach = cells.squared_distances(points[i]) <= ratio * bounds[i] ** 2
                    reach[home[i]] = False
                    visit = np.flatnonzero(reach)
                for cell in visit.tolist():
                    which += [i] * salts
                    where += range(cell * salts, (cell + 1) * salts)
                    if len(which) >= settings.block:
                        yield batch, which, where
                        which, where = [], []
            if which:
                yield batch, which, where

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, where in wanted(batches):
            shards, asked = np.unique(where, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(asked)], ["shard", "asked"])

    def look(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(own) and len(asking):
            ids = own["vec_id"].to_numpy()
            data = np.stack(own["vector"].to_list())
            stay = smallest_ids(ids, data, most)
            ids, data = ids[stay], data[stay]
            tree = Tree(ids, data, data @ directions, settings.leaf)
            for vector, query, bound in zip(asking["vector"], asking["query"], asking["bound"]):
                limit = bound if 0 <= bound < np.inf else np.inf
                near, score = tree.nearest(vector, vector @ directions, most, limit, ratio)
                out.append(pd.DataFrame({"query": query, "vec_id": near, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "vec_id": [], "score": []})

    def visit(asking: DataFrame) -> DataFrame:
        asking = asking.select("vector", "query", "bound")
        many = (
            asking.mapInArrow(count, "shard bigint, asked bigint")
            .groupBy("shard")
            .agg(F.sum("asked").alias("asked"))
            .where(F.col("asked") > settings.block)
            .collect()  # at most one row for each shard
        )
        blocks = np.ones(len(cells) * salts, np.int64)
        for shard, asked in many:
            blocks[shard] = -(-asked // settings.block)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Copies of the queries for the shards, each in the block of its id."""
            for batch, which, where in wanted(batches):
                take = pa.array(which, pa.int64())
                query = mix(batch.column(1).to_numpy().view(np.uint64)[which])
                block = (query % blocks[where].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(take) for i in range(3)], pa.array(where, pa.int64()), pa.array(block)],
                    ["vector", "query", "bound", "shard", "block"],
                )

        def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The shards' vectors once for each block of queries."""
            for batch in batches:
                times = blocks[batch.column(2).to_numpy()]
                for number in range(int(times.max(initial=0))):
                    part = batch.filter(pa.array(times > number))
                    block = pa.array(np.full(part.num_rows, number))
                    yield pa.RecordBatch.from_arrays([*part.columns, block], ["vec_id", "vector", "shard", "block"])

        kind = "vector array<double>, query bigint, bound double, shard bigint, block bigint"
        copies = asking.mapInArrow(ask, kind)
        if not many:
            return index.groupBy("shard").cogroup(copies.groupBy("shard")).applyInPandas(look, FOUND)
        repeated = index.select("vec_id", "vector", "shard").mapInArrow(
            repeat, "vec_id bigint, vector array<double>, shard bigint, block bigint"
        )
        return (
            repeated.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInPandas(look, FOUND)
        )

    first = stored(visit(queries.withColumn("bound", F.lit(-1.0))), "own-cells")
    nearest = Window.partitionBy("query").orderBy("score", "vec_id")
    bounds = (
        first.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") == most)
        .select("query", F.col("score").alias("bound"))
    )
    asking = queries.join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    best = stored(
        first.union(visit(asking))
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= most)
        .select("query", "vec_id", "score"),
        "nearest",
    )
    names = asked.select("vector", F.col("vec_id").alias("query_id")).distinct()
    named = names.join(queries, "vector").select("query_id", "query")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.join(best, "query")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= settings.neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
