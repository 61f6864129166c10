"""Line rules against plain counting."""

import hashlib
import random
import re
from collections import Counter

from jobtide.llm import line_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def plain(text):
    """The base counts of a text, found pair by pair."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_counts_match_plain_code():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "é\x1c\x85 ü　x\r\ny", "a b c d e f g h " * 3]
    for _ in range(60):
        words = rng.choices(["a", "b", "é#", "c|", "d."], k=rng.randint(0, 60))
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words))
    for text in texts:
        row = line_rules.judge(text)
        want = plain(text)
        assert row[:5] == want, text
        assert row[7] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (row[7] and row[8])


def plain_common(texts, least=20, percent=1):
    """Keys of short lines that stand in many different texts."""
    different = {t for t in texts if t and WORD.search(t)}
    holders = Counter()
    for text in different:
        lines = {x.strip(" \t\n\v\f\r") for x in text.split("\n") if 0 < len(WORD.findall(x)) <= 30}
        holders.update(lines)
    found = [x for x, n in holders.items() if n >= least and 100 * n >= percent * len(different)]
    return frozenset(hashlib.md5(x.encode()).digest() for x in found)


MENUS = {
    "fr": "Accueil Nos services Mentions légales Nous écrire",
    "de": "Startseite Impressum Datenschutz Kontakt Warenkorb",
    "es": "Inicio Quiénes somos Aviso legal Contacto Tienda",
}


def test_menus_of_any_language_go_by_their_frequency(spark):
    rows = []
    for i in range(120):
        lang = ("fr", "de", "es")[i % 3]
        own = "\n".join(prose(1000 * i + j) for j in range(5))
        rows.append((i, f"  {MENUS[lang]}\t\n{own}"))
    # Copies of one text, and a line that few texts hold, are no boilerplate.
    copied = "A line that only one text has but many rows\n" + "\n".join(prose(j) for j in range(900, 905))
    rows += [(1000 + i, copied) for i in range(60)]
    rows += [(2000 + i, f"Nineteen texts hold this line here\n{prose(5000 + i)}\n{prose(6000 + i)}") for i in range(19)]
    # A text that is little more than a menu goes as a whole.
    rows += [(3000, "\n".join([*MENUS.values(), prose(7)]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    common = line_rules.common_lines(frame)
    assert common == plain_common([t for _, t in rows]) == {line_rules.line_key(m.encode()) for m in MENUS.values()}
    out = {r.doc_id: r for r in line_rules.clean_lines(frame).collect()}
    for i, text in rows:
        if i < 1000:
            assert out[i].kept and out[i].clean_text == text.split("\n", 1)[1] and out[i].n_lines_removed == 1
        elif i < 3000:
            assert out[i].kept and out[i].n_lines_removed == 0
    assert not out[3000].kept and not out[3000].base_failed
    assert {r.doc_id for r in line_rules.keep_clean(frame).collect()} == {i for i, _ in rows if i < 3000}


def test_common_lines_of_nothing(spark):
    frame = spark.createDataFrame([(None,), ("",), (" \n ",)], "text string")
    assert line_rules.common_lines(frame) == line_rules.common_lines(frame.limit(0)) == frozenset()


PROSE = "The %d quick foxes jump over %d lazy dogs near %d river banks."


def prose(i):
    return PROSE % (i, i + 100, i + 200)


def test_lines_are_judged_first():
    good = "\n".join(prose(i) for i in range(6))
    noise = "Home | About | Contact | Login | Help"
    kept = line_rules.judge(good + "\n" + noise)
    assert kept[8] and kept[6] == 1 and kept[9] == good
    lost = line_rules.judge("\n".join([noise.replace(" |", f"{i} |") for i in range(20)] + [good]))
    assert not lost[8] and not lost[7]
    for bad in ("And&&& a$$$ then*** the###", "OF!! THE!! AND!!", "click here", "Read more", "All rights reserved."):
        assert line_rules.line_fails(bad.encode(), line_rules.Rules()), bad
    for fine in ("A short one.", "Is it?", prose(1), "A heading of four words"):
        assert not line_rules.line_fails(fine.encode(), line_rules.Rules()), fine


def test_query_covers_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op3_quality_rules(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        if len(docs[r.doc_id]) < 6000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(docs[r.doc_id])


def test_odd_rows(spark):
    rows = [(None, None, 1, True), (1, "", 2, False), (1, "", 2, False), (2, prose(1) * 3, 3, True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    out = line_rules.clean_lines(frame).collect()
    assert len(out) == 4 and [r.clean_text for r in out if r.doc_id is None] == [None]
    assert line_rules.clean_lines(frame.limit(0)).collect() == []
    assert line_rules.keep_clean(frame).columns == frame.columns
