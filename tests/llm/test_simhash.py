"""SimHash, links and components against plain code."""

import random

import numpy as np
import xxhash

from jobtide.llm import queries, simhash
from jobtide.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    """Smallest reachable id of each (id, print)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints():
    for text in (None, "", " \n ", "One", "One two three", "A b C d e É f " * 9, "x\x1cy z  w\tv" * 5):
        assert simhash.fingerprint(text, 4, 42) == plain_print(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("one two three é")).alias("h")).first()
    assert simhash.fingerprint("one two three é", 4, 42) == row.h % 2**64


def planted(rng, groups, size, flips):
    values = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(size):
            value = base
            for b in rng.sample(range(64), rng.randint(0, flips)):
                value ^= 1 << b
            values.add(value)
    return sorted(values)


def links_match(spark, values, settings):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    edges = simhash.links(frame, settings).collect()
    for a, b in edges:
        assert ((a ^ b) % 2**64).bit_count() <= settings.distance
    found = {r.vertex: r.root for r in components(spark.createDataFrame(edges or [(0, 0)], "a long, b long")).collect()}
    prints = list(zip(signed, values))
    want = plain_components(prints, settings.distance)
    assert [found.get(v, v) for v in signed] == want


def test_no_link_is_lost(spark):
    rng = random.Random(4)
    values = planted(rng, 60, 5, 3) + [rng.getrandbits(64) for _ in range(300)]
    links_match(spark, sorted(set(values)), simhash.Settings())


def test_hot_values_are_parted_again(spark):
    rng = random.Random(5)
    # One wide group, most of it with the same bits everywhere but in one corner.
    values = planted(rng, 1, 500, 6) + [(0xABCDEF << 40) | rng.getrandbits(40) for _ in range(400)]
    links_match(spark, sorted(set(values)), simhash.Settings(split=40))


def test_no_group_is_hot(spark, monkeypatch):
    rng = random.Random(6)
    # A ball that no parting of the bits takes apart.
    values = planted(rng, 1, 300, 3) + [rng.getrandbits(64) for _ in range(50)]
    largest = []
    kind = type(spark.range(0))
    real = kind.repartition

    def repartition(frame, *keys):
        if keys == ("place",):
            largest.append(max([r["count"] for r in frame.groupBy("place").count().collect()], default=0))
        return real(frame, *keys)

    monkeypatch.setattr(kind, "repartition", repartition)
    links_match(spark, sorted(set(values)), simhash.Settings(split=60))
    assert len(largest) == 4 and max(largest) <= 120


def test_layout_covers_the_distance():
    rng = np.random.default_rng(1)
    for total in (10, 10_000, 1e9):
        for sample in (np.zeros(0, np.uint64), rng.integers(0, 2**63, 500).astype(np.uint64)):
            parts = simhash.layout(sample, total, 4, list(range(64)))
            # Were every part exceeded by one, more than the distance would differ.
            assert sum(t + 1 for _, t in parts) > 4
            bits = [b for group, _ in parts for b in group]
            assert len(bits) == len(set(bits))


def test_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(200)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.vertex: r.root for r in rows} == dict.fromkeys(range(201), 0)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_matches_plain_code(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    prints = [(i, plain_print(t)) for i, t in docs]
    want = {
        i: (f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))
    }
    rows = queries.op7_simhash(spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want
    assert len(rows) == len(docs)


def test_odd_rows(spark):
    text = "some words that are the same in each of these rows"
    rows = [(5, text, 1), (3, text, 2), (3, text, 2), (None, text, 3), (8, None, 4), (9, "", 5), (None, "alone here", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    out = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    assert sorted(out, key=str) == sorted(
        [(5, 3), (3, 3), (3, 3), (None, 3), (8, 8), (9, 8), (None, None)], key=str
    )
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 8, None, None]


def test_texts_that_share_an_id_are_kept_by_component(spark):
    one, two = "some words that are the same in each of these rows", "an entirely other text without any near copy"
    rows = [(3, one, 1), (5, one, 2), (5, two, 3), (7, "lonely words alone", 4), (7, "further unlike things here", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(r.fingerprint for r in kept.collect()) == [1, 3, 4, 5]
