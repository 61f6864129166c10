"""Importance resampling against plain code."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobtide.llm import resample as r
from jobtide.llm.ordered import running_sums


def features(text, longest):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % r.BUCKETS
        for n in range(1, longest + 1)
        for i in range(len(words) - n + 1)
    ]


def plain(docs, target, percent, longest):
    s = Counter(b for _, text in docs for b in features(text, longest)[1])
    t = Counter(b for text in target for b in features(text, longest)[1])
    all_s, all_t = sum(s.values()) + r.BUCKETS, sum(t.values()) + r.BUCKETS
    rows = []
    for i, text in docs:
        words, own = features(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in own]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((i, len(words), len(own), weight, score))
    long = sorted((x for x in rows if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = Counter((*x, rank + 1) for rank, x in enumerate(long[: percent * len(long) // 100]))
    rest = Counter(rows) - Counter(x[:-1] for x in drawn.elements())
    return drawn + Counter((*x, None) for x in rest.elements())


def table():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "ÀB", "naïve", "Zebra", "x-y", "a1"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 60, 200])))) for i in range(700)]
    docs += [docs[5], docs[6], docs[9], (None, "null id " * 30), (900, None), (901, ""), (902, " ,;- ")]
    docs += [(1000 + i, "same text " * 20) for i in range(300)]
    return docs, [" ".join(rng.choices(vocabulary[:40], k=50)) for _ in range(30)] + [None, ""]


@pytest.mark.parametrize(("longest", "accuracy", "percent"), [(1, 10_000, 10), (1, 2, 10), (3, 50, 35), (1, 10, 100)])
def test_draws_match_plain_code(spark, longest, accuracy, percent):
    docs, target = table()
    found = r.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"),
        percent=percent,
        longest=longest,
        accuracy=accuracy,
    )
    assert Counter(tuple(x) for x in found.collect()) == plain(docs, target, percent, longest)


def test_few_empty_and_clashing(spark):
    target = spark.createDataFrame([("a",)], "text string")
    few = spark.createDataFrame([(1, "a " * 30, "x")], "doc_id long, text string, c string").toDF("doc_id", "text", "TEXT")
    assert [(x.doc_id, x.rank) for x in r.resample(few, target).collect()] == [(1, None)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert r.resample(none, target).count() == 0
    docs = spark.createDataFrame([(i, "b c " * 15) for i in range(20)], "doc_id long, text string")
    ranks = [x.rank for x in r.resample(docs, target.limit(0)).collect()]
    assert sorted(x for x in ranks if x) == [1, 2] and len(ranks) == 20


def test_one_id_with_most_rows(spark):
    docs = spark.createDataFrame([(7, "a b c d " * 6)] * 400 + [(i, "z " * 25) for i in range(100)], "doc_id long, text string")
    ranks = sorted(x.rank for x in r.resample(docs, docs.limit(3), percent=50).collect() if x.rank)
    assert ranks == list(range(1, 251))


def test_running_sums_of_a_hot_and_a_null_group(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(9), i) for i in range(3000) for g in [rng.choice([None, "hot", "hot", "a", "b"])]]
    frame = spark.createDataFrame(rows, "g string, v long, i int").repartition(6)
    found = running_sums(frame, "test-sums", "g", "v", [F.col("i")], 0).collect()
    sums: Counter = Counter()
    expected = set()
    for g, v, i in rows:
        expected.add((g, v, i, sums[g]))
        sums[g] += v
    assert {tuple(x) for x in found} == expected and len(found) == len(rows)
