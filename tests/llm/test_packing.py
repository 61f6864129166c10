"""Packing and token counts against plain code."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from jobtide.llm import packing, queries, token_counts
from jobtide.llm.bpe import byte_encoder, public_vocabulary

FOLDER = "/root/testdata/sf0.001"
ODD = [
    "",
    "  ",
    " a  b\n\n c\t\td \x1c x",
    "é ﬁ 中文 字　　x  ",
    "a" * 3000,
    "ab12cd!" * 3000,
    "x<|endoftext|>y",
    "don't I'll  '  's",
    "\n\n\n",
    "\x85 \xa0a\xa0b",
    "😀 👍🏽x​ y",
    "a. b.  c.\n d \n e. \n\n f",
]


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_file(public_vocabulary())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def least_cost(places, prices, costs):
    """The cheapest cuts' cost, trying every window."""
    place, price = [0, *places], [0.0, *prices]
    best = [0.0]
    for j in range(1, len(place)):
        tries = []
        for i in range(j):
            n = place[j] - place[i]
            if n <= costs.window:
                free = n & (n - 1) == 0 and n >= costs.least_power
                tries.append(best[i] + (0 if free else costs.window - n))
        best.append(min(tries) + price[j] + costs.opening)
    return best[-1]


def cost_of(ends, places, prices, costs):
    price, total, begin = dict(zip(places, prices)), 0.0, 0
    for end in ends:
        n = end - begin
        free = n & (n - 1) == 0 and n >= costs.least_power
        total += (0 if free else costs.window - n) + price[end] + costs.opening
        begin = end
    return total


def test_cuts_are_the_cheapest():
    rng = random.Random(5)
    costs = packing.Costs(window=64, least_power=8)
    for _ in range(60):
        at, places = 0, []
        for _ in range(rng.randint(1, 40)):
            at += rng.randint(1, 30)
            places.append(at)
        prices = [rng.choice([0.0, 4.0, 16.0]) for _ in places]
        ends = packing.best_cuts(places, prices, costs)
        assert ends[-1] == places[-1]
        assert max(b - a for a, b in zip([0, *ends], ends)) <= costs.window
        assert cost_of(ends, places, prices, costs) == least_cost(places, prices, costs)


def test_ids_are_those_of_the_tokenizer(exact):
    encoder = byte_encoder(public_vocabulary())
    for text in ODD:
        assert encoder.encode(text).tolist() == exact(text)


def test_ids_beside_much_white_space(exact):
    encoder = byte_encoder(public_vocabulary())
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice("ab1 \n\t\r\x85\xa0.'sé\x1c\x0b-") for _ in range(rng.randint(0, 14)))
        assert encoder.encode(text).tolist() == exact(text)


def test_cuts_of_a_block_are_those_of_its_documents():
    encoder = byte_encoder(public_vocabulary())
    costs = packing.Costs(window=64, long_sentence=12, between=4)
    rng = random.Random(6)
    words = ["a", "the ", "end. ", "\n", "\n\n", " ", "q!", "? ", "x" * 90, "xqzj" * 40]
    texts = ["", "a", *["".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)], ""]
    docs = [np.append(encoder.encode(text), np.uint32(0)) for text in texts]
    ends = np.cumsum([len(ids) for ids in docs])
    places, prices = packing.block_cuts(np.concatenate(docs), ends, encoder, costs)
    alone = [packing.block_cuts(ids, np.array([len(ids)]), encoder, costs) for ids in docs]
    assert places.tolist() == [at for (own, _), end, ids in zip(alone, ends, docs) for at in (own + end - len(ids)).tolist()]
    assert prices.tolist() == [price for _, own in alone for price in own.tolist()]
    assert set(prices.tolist()) == {0.0, costs.sentence, costs.word, costs.inside}
    assert np.diff(places, prepend=0).max() <= costs.window // 2


def test_every_id_lies_in_one_piece(spark, exact):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, "no id. here"), (3, ODD[3])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = packing.pack(frame, costs=packing.Costs(block=2000)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length * 4 == len(r.ids) > 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text in {i: t for i, t in docs}.items():
        want = b"".join(x.to_bytes(4, "little") for x in [*exact(text or ""), 0])
        copies = 2 if doc_id == 3 else 1
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert sum(len(r.ids) for r in own) == copies * len(want)
        for r in own:
            assert want[4 * r.start : 4 * (r.start + r.length)] == r.ids
            assert r.doc_tokens * 4 == len(want)


def test_query_packs_all_documents_with_little_padding(spark):
    rows = queries.op1_packing(spark, FOLDER).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.sequence_id] += r.length
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes.values())
    assert padding < 0.03 * 1024 * len(sizes)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs)
    encoder = byte_encoder(public_vocabulary())
    for r in rows[:200]:
        raw = encoder.encode(docs[r.doc_id]).astype("<u4").tobytes() + bytes(4)
        assert r.ids_crc32 == zlib.crc32(raw[4 * r.start : 4 * (r.start + r.length)])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).collect() == []
    assert token_counts.length_histogram(token_counts.encoded_lengths(none)).collect() == []


def test_columns_with_clashing_names(spark):
    frame = spark.createDataFrame([(1, "a b.", 7, "x")], "doc_id long, text string, start int, TEXT string")
    assert [r.ids[-4:] for r in packing.pack(frame).collect()] == [bytes(4)]


def test_histogram_answers_every_limit(spark, exact):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "a b c"), (1, "a b c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lengths = sorted(len(exact(t or "")) for _, t in docs)
    got = token_counts.encoded_lengths(frame)
    assert sorted(r.n_tokens for r in got.collect()) == lengths
    histogram = token_counts.length_histogram(got)
    for r in histogram.collect():
        n = r.n_tokens
        assert r.documents == lengths.count(n)
        assert r.documents_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert r.share_at_most == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 5, 700, 10**6):
        row = token_counts.truncated_total(histogram, limit).first()
        assert row.tokens == sum(min(x, limit) for x in lengths)
        assert row.documents_cut == sum(x > limit for x in lengths)
    assert token_counts.quantile(histogram, 0.5).first()[0] == lengths[(len(lengths) - 1) // 2]


def test_token_count_query_counts_all_documents(spark):
    rows = queries.op4_token_counts(spark, FOLDER).collect()
    assert sum(r.documents for r in rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
