"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from jobtide.llm import neighbours, queries

FOLDER = "/root/testdata/sf0.1"


def plain(ids, data, most):
    out = {}
    for i, q in enumerate(ids):
        if q % 100 == 0:
            away = np.sqrt(((data - data[i]) ** 2).sum(axis=1))
            others = np.flatnonzero(ids != q)
            best = others[np.lexsort((ids[others], away[others]))][:most]
            out[q] = [(int(ids[j]), away[j]) for j in best]
    return out


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        rows = out.setdefault(r.query_id, [])
        rows.append((r.vec_id, r.score))
        assert r["rank"] == len(rows)
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    ids, data = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_list()).astype(float)
    want = plain(ids, data, 10)
    got = answers(queries.op2_neighbours(spark, FOLDER))
    assert set(got) == set(want)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.95 * sum(map(len, want.values()))
    place = {int(v): i for i, v in enumerate(ids)}
    for q, rows in got.items():
        assert len(rows) == 10
        for i, score in rows:
            assert score == pytest.approx(np.sqrt(((data[place[i]] - data[place[q]]) ** 2).sum()), rel=1e-14)


def test_without_stopping_early_all_is_exact(spark):
    rng = np.random.default_rng(8)
    data = rng.integers(-3, 4, (900, 4)).astype(float)  # many ties and equal vectors
    data[300:600] = data[300]
    data = data[(data != 0).any(axis=1)]
    ids = rng.permutation(len(data)) * 10
    frame = spark.createDataFrame(
        [(int(i), [float(x) for x in v], 1) for i, v in zip(ids, data)], "vec_id long, embedding array<float>, score int"
    ).repartition(5)
    settings = neighbours.Settings(certainty=1 - 1e-12, shard=100, leaf=8, neighbours=10)
    got = answers(neighbours.search(frame, F.col("vec_id") % 100 == 0, settings))
    want = plain(ids, data, 10)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_queries_come_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = rng.standard_normal((3_000, 16))
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>"
    ).repartition(4)
    largest = []
    real = GroupedData.cogroup

    def cogroup(index, copies):
        largest.append(copies._df.groupBy("shard", "block").count().agg(F.max("count")).first()[0])
        return real(index, copies)

    monkeypatch.setattr(GroupedData, "cogroup", cogroup)
    settings = neighbours.Settings(certainty=1 - 1e-12, shard=500, leaf=32, block=10)
    got = answers(neighbours.search(frame, F.col("vec_id") % 100 == 0, settings))
    assert len(largest) == 2 and max(largest) <= 20  # of 30 queries, most of which visit every shard
    want = plain(np.arange(3_000), data, 10)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0]), (9, []), (100, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert answers(neighbours.search(frame, F.col("vec_id") % 100 == 0)) == {0: [(1, 0.0), (7, 1.0)]}
    assert neighbours.search(frame.limit(0), F.lit(True)).collect() == []


def test_chi_square():
    # Tabled values: 18.307 for ten degrees at 0.95, 13.362 for eight at 0.9.
    assert neighbours.chi_square(18.307, 10) == pytest.approx(0.95, abs=1e-4)
    assert neighbours.stopping_ratio(0.9, 8) == pytest.approx(13.362, abs=1e-3)
