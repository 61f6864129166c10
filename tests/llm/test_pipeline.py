"""The corpus pipeline against plain code, stage by stage."""

from collections import defaultdict

import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from jobtide.llm import grades, line_rules
from jobtide.llm.bpe import byte_encoder, public_vocabulary
from test_line_rules import plain_common
from test_simhash import plain_components, plain_print

FOLDER = "/root/testdata/sf0.001"


def without_repeats(docs, size=50):
    """Texts of (doc_id, text) without strings that start in a smaller document too."""
    coded = [(doc, text.encode()) for doc, text in docs]
    first = {}
    for doc, raw in coded:
        for i in range(len(raw) - size + 1):
            first[raw[i : i + size]] = min(doc, first.get(raw[i : i + size], doc))
    out = {}
    for doc, raw in coded:
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc:
                gone[i : i + size] = b"\1" * size
        out[doc] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage."""
    from jobtide.llm.frames import stored

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), "stage"))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(stages):
    for docs in stages[1:-1]:
        assert docs.dtypes == stages[0].dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "SimHash near-dedup", "suffix-array dedup", "packing",
    ]


def test_classifier_takes_effect(spark, stages):
    ratings = grades.graded(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scored = grades.score(stages[0], grades.train(stages[0], ratings)).collect()
    before = texts(stages[0])
    assert texts(stages[1]) == {r.doc_id: before[r.doc_id] for r in scored if r.kept}


def test_rules_take_effect(stages):
    before = texts(stages[1])
    common = plain_common(before.values())
    judged = {doc: line_rules.judge(text, common=common) for doc, text in before.items()}
    assert texts(stages[2]) == {doc: row[-1] for doc, row in judged.items() if row[-2]}
    for row in stages[2].collect():
        assert row.n_chars == len(row.text)


def test_one_document_of_each_group_stays(stages):
    docs = sorted(texts(stages[2]).items())
    groups = plain_components([(doc, plain_print(text)) for doc, text in docs])
    assert texts(stages[3]) == {doc: text for (doc, text), first in zip(docs, groups) if doc == first}


def test_repeated_passages_go(stages):
    assert texts(stages[4]) == without_repeats(texts(stages[3]).items())


def test_windows_hold_every_id(stages):
    encoder = byte_encoder(public_vocabulary())
    pieces = defaultdict(list)
    for r in stages[5].collect():
        pieces[r.doc_id].append((r.start, r.ids))
    for doc, text in texts(stages[4]).items():
        want = encoder.encode(text).astype("<u4").tobytes() + bytes(4)
        assert b"".join(ids for _, ids in sorted(pieces.pop(doc))) == want
    assert not pieces


def test_odd_rows_pass_through_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long_text = " ".join(f"word{i} and thing{i * i}" for i in range(400)) + "."
    rows = [
        (1, long_text, None, None, None),
        (1, long_text, None, None, None),
        (2, long_text + " More.", "en", "s", 5),
        (None, long_text[5:], "en", "s", 5),
        (3, None, None, None, None),
        (4, "", "en", "s", 0),
    ]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        docs.collect()


EXTRA = {"TEXT": "clash", "DOC_ID": 77, "text ": "blank", "a.b": 1.5, "_doc": 1, "_digest": "d", "row": "r", "doc": 9}
LONG = " ".join(f"word{i} and thing{i * i}" for i in range(300)) + "."


def odd_frame(spark, extra):
    """Documents with further columns, a repeated `text` among them if `extra` is given as a list."""
    rows = [(i, LONG[7 * i :] if i % 2 else f"{LONG} Copy.", "en", "s", None) for i in range(1, 7)]
    rows += [rows[0], (None, LONG, "en", "s", 4), (9, None, None, None, None), (10, "", "fr", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    for i, value in enumerate(extra.values()):
        frame = frame.withColumn(f"extra{i}", F.lit(value))
    return frame.toDF("doc_id", "text", "lang", "source", "n_chars", *extra)


@pytest.mark.parametrize("extra", [EXTRA, {**EXTRA, "text": "again"}])
def test_clashing_names_pass_through_every_stage(spark, extra):
    docs = odd_frame(spark, EXTRA)
    if "text" in extra:
        docs = docs.withColumn("more", F.lit("again")).toDF(*docs.columns, "text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select("c0", "c1", "c2", "c3", "c4")
    plain = plain.toDF("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, FOLDER), stage(spark, plain, FOLDER)
        if name == "packing":
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            continue
        assert got.columns == docs.columns
        rows = [tuple(row) for row in got.collect()]
        assert sorted(str(row[:5]) for row in rows) == sorted(str(tuple(r)) for r in want.collect()), name
        assert {row[5:] for row in rows} <= {(*EXTRA.values(), *["again"] * ("text" in extra))}, name


def test_run_over_files_with_dotted_and_reserved_names(spark, tmp_path):
    keep = {name: EXTRA[name] for name in ("a.b", "_doc", "_digest", "row", "doc")}
    odd_frame(spark, keep).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == corpus_pipeline.run(spark, FOLDER).columns
    assert {row.doc_id for row in got.collect()} <= {*range(1, 11), None}


def test_run_is_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.dtypes == stages[5].dtypes
    key = lambda r: (r.doc_id, r.start)
    assert sum(len(r.ids) for r in got.collect()) == sum(len(r.ids) for r in stages[5].collect())
    assert {key(r)[0] for r in got.collect()} == {key(r)[0] for r in stages[5].collect()}
