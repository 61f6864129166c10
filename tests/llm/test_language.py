"""Language profiles against plain counting, and accuracy on documents kept from learning."""

import zlib
from collections import Counter

from jobtide.llm import language, queries

FOLDER = "/root/testdata/sf0.01"


def plain_profile(texts, size, longest=3):
    counts = Counter()
    for text in texts:
        low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
        for word in low.split():
            padded = f" {word} "
            for n in range(1, longest + 1):
                for i in range(len(padded) - n + 1):
                    if padded[i : i + n].strip():
                        counts[padded[i : i + n]] += 1

    def code(gram):
        out = 0
        for c in gram:
            out = out << 21 | ord(c)
        return out

    ranked = sorted(((-k, code(g)) for g, k in counts.items()))[:size]
    return {g: r for r, (_, g) in enumerate(ranked)}


def plain_prediction(text, profiles, settings):
    own = plain_profile([text], settings.own)
    if not own or not profiles:
        return "und", 0.0
    away = {
        lang: sum(
            min(abs(theirs[g] - r), settings.profile) if g in theirs else settings.profile for g, r in own.items()
        )
        for lang, theirs in profiles.items()
    }
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (settings.profile * len(own))


SAMPLES = [
    ("The cat and the dog are in the house, and the bird is out.", "en"),
    ("Der Hund und die Katze sind in dem Haus, das ist schön.", "de"),
    ("Größe, STRASSE und İstanbul ﬁ 中文 x1y", "de"),
    ("Le chat et le chien sont dans la maison.", "fr"),
    (None, "fr"),
    ("nobody knows", None),
    ("", "en"),
]


def test_profiles_and_predictions(spark):
    settings = language.Settings(profile=30, own=25, slab=60)
    frame = spark.createDataFrame(SAMPLES, "text string, lang string").repartition(3)
    profiles = language.learn(frame, settings)
    got = {}
    for r in profiles.collect():
        got.setdefault(r.lang, {})[r.gram] = r["rank"]
    langs = {lang for t, lang in SAMPLES if t is not None and lang}
    want = {g: plain_profile([t for t, lang in SAMPLES if lang == g], 30) for g in langs}
    assert got == want
    texts = [t for t, _ in SAMPLES] + ["123 !?", "the bird", "schön", "x" * 3000, "a a b b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, profiles, settings).collect()}
    for i, text in enumerate(texts):
        name, score = plain_prediction(text, want, settings)
        assert rows[i][0] == name and abs(rows[i][1] - score) < 1e-12, text


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op6_language_id(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    kept_out = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id] for r in kept_out)
    assert right >= 0.97 * len(kept_out) > 0


def test_odd_rows(spark):
    rows = [(None, None, None, 1), (1, "", "en", 2), (2, "the cat and the dog", "en", 3), (2, "the cat and the dog", "en", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = language.identify(frame).collect()
    assert len(out) == 4 and {r.lang_pred for r in out if r.doc_id in (None, 1)} == {"und"}
    assert language.identify(frame.limit(0)).collect() == []
