import random
import re

import pytest

from shopledger.llm import licenses

SCHEMA = "doc_id long, text string, labels string, score double"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute_base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    found = [
        (i, label)
        for i in range(len(words))
        for phrase, label in PHRASES.items()
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def longest_ending(words, i, sequences):
    """Longest sequence of template words that ends at word i."""
    size = 0
    while size <= i and any(
        words[i - size : i + 1] == s[k : k + size + 1] for s in sequences for k in range(len(s) - size)
    ):
        size += 1
    return size


def test_matching_statistics_against_search():
    rng = random.Random(1)
    tool = licenses.automaton((("a", "x y x y z"), ("b", "y z")), (("c", "x y z x x y x y z z y"), ("d", "z z x y y x y z")))
    sequences = [w for _, w in tool.phrases + tool.templates]
    for _ in range(200):
        words = [rng.choice([b"x", b"y", b"z"]) for _ in range(30)]
        lengths, states = tool.statistics([tool.ids[w] for w in words])
        assert lengths == [longest_ending(words, i, sequences) for i in range(30)]
        for i, (size, state) in enumerate(zip(lengths, states)):
            want = {(n, p) for n, s in enumerate(sequences) for p in range(size - 1, len(s)) if s[p + 1 - size : p + 1] == words[i + 1 - size : i + 1]}
            assert set(tool.places[state]) == want
        _, base, _ = tool.scan([words])
        text = b" " + b" ".join(words) + b" "
        assert len(base) == sum(
            words[i : i + len(p)] == p for _, p in tool.phrases for i in range(len(words))
        ), text


ROWS = [
    (1, "Use is granted UNDER the MIT-License, under the mit license; CC BY-NC 4.0"), (2, None), (3, ""), (4, "...\n"),
    (5, "Licensed under the Apache License, Version 2.0."), (6, "This work is licensed under the GNU General Public License, version 3."),
    (6, "This work is licensed under the GNU General Public License, version 3."), (None, "cc by nc"), (7, "the licence of the work is free"),
    (8, "café under the mit licenseé and cc by nc x"),
    (9, "word " * 30000 + "under the mit license " * 2000),
    (10, dict(licenses.TEMPLATES)["bsd"] + " and dict"),
    (11, " ".join(w for i, w in enumerate(dict(licenses.TEMPLATES)["isc"].split()) if i != 12)),
]


def test_base_places_against_regex(spark):
    frame = spark.createDataFrame([(d, t, "x", 0.5) for d, t in ROWS], SCHEMA)
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(frame).collect()}
    assert got == {(d, *brute_base(t)) for d, t in ROWS}
    assert licenses.scan(frame).count() == len(ROWS)


def test_labels_of_templates(spark):
    frame = spark.createDataFrame([(d, t, "x", 0.5) for d, t in ROWS], SCHEMA)
    rows = {r.doc_id: r for r in licenses.scan(frame).collect()}
    assert {d: rows[d].labels for d in (1, 2, 5, 6, 7, 10, 11)} == {
        1: "cc-by-nc,mit", 2: "", 5: "apache-2", 6: "gpl-3", 7: "", 10: "bsd", 11: "isc",
    }
    assert rows[7].score < 0.8 <= rows[11].score < 1.0 and rows[2].score == 0.0
    assert rows[10].spans == "bsd:0:21"


@pytest.mark.parametrize("piece", [1, 9, 64])
def test_long_texts_in_pieces(monkeypatch, piece):
    tool = licenses.automaton()
    texts = [t or "" for _, t in ROWS if len(t or "") < 1000]
    whole = [tool.scan(licenses.pieces_of(t)) for t in texts]
    monkeypatch.setattr(licenses, "PIECE", piece)
    assert [tool.scan(licenses.pieces_of(t)) for t in texts] == whole
    assert [n for n, _, _ in whole] == [brute_base(t)[0] for t in texts]


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def labels(text, tool=None):
    _, _, spans = (tool or licenses.automaton()).scan(licenses.pieces_of(text))
    return {s[2] for s in licenses.own_spans([s for s in spans if s[3] >= licenses.MIN_COVERAGE])}


def test_templates_that_share_words_each_get_their_match():
    text = "This work is licensed under a Creative Commons Attribution{} 4.0 International License"
    assert labels(text.format("-NonCommercial-ShareAlike")) == {"cc-by-nc-sa"}
    # Without a template of its own the one is found in parts as both.
    known = [t for t in licenses.TEMPLATES if t[0] in ("cc-by-nc", "cc-by-sa")]
    assert labels(text.format("-NonCommercial-ShareAlike"), licenses.automaton((), tuple(known))) == {"cc-by-nc", "cc-by-sa"}
    assert labels(text.format("-NonCommercial")) == {"cc-by-nc"}
    assert labels(text.format("")) == {"cc-by"}
    # The longer match goes on in another template where this one ends.
    tool = licenses.automaton((), (("a", "p q r s t u v w x y"), ("b", "p q r s t k l m n o")))
    assert labels("p q r s t k u v w x y", tool) == {"a"}


def test_matches_at_every_place_against_search():
    rng = random.Random(2)
    tool = licenses.automaton((), (("c", "x y z x x y x y z z y"), ("d", "z z x y y x y z"), ("e", "y x y z x y")))
    sequences = [w for _, w in tool.templates]
    for _ in range(100):
        words = [rng.choice([b"x", b"y", b"z"]) for _ in range(30)]
        lengths, states = tool.statistics([tool.ids[w] for w in words])
        for i, (size, state) in enumerate(zip(lengths, states)):
            got = {(n, p, length or size) for length, n, p, _ in tool.matches[state] if (length or size) >= licenses.MIN_MATCH}
            want = set()
            for n, s in enumerate(sequences):
                for p in range(len(s)):
                    k = 0
                    while k <= min(i, p) and words[i - k] == s[p - k]:
                        k += 1
                    want |= {(n, p, k)} if k >= licenses.MIN_MATCH else set()
            assert got == want


def test_every_template_has_its_own_label_and_no_other():
    tool = licenses.automaton()

    def labels(text):
        spans = tool.scan(licenses.pieces_of(text.encode()))[2]
        return {s[2] for s in licenses.own_spans([s for s in spans if s[3] >= licenses.MIN_COVERAGE])}

    for label, text in licenses.TEMPLATES:
        assert labels(text) == {label}, text
        assert labels(f"Some words before. {text.upper()}, and some after it.") == {label}, text
    licence = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    for kind, label in (("NoDerivatives", "cc-by-nd"), ("NonCommercial-NoDerivatives", "cc-by-nc-nd"), ("NonCommercial-ShareAlike", "cc-by-nc-sa")):
        assert labels(licence.format(kind)) == {label}
