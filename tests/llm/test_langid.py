import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopledger.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, at int"


def brute_counts(clean):
    """Bucket counts from whole n-grams, one at a time."""
    counts = {}
    for n in langid.NGRAMS:
        for i in range(len(clean) - n + 1):
            code = 0
            for c in clean[i : i + n]:
                code = (code * 0x01000193 + ord(c)) % 2**32
            bucket = ((code + n) * 0x9E3779B1) % 2**32 >> (32 - langid.BUCKET_BITS)
            counts[bucket] = counts.get(bucket, 0) + 1
    return counts


def brute_prediction(model, text):
    clean = langid.letters(None if text is None else text.encode())
    if not clean:
        return "und", 0.0
    weights = {b: (1 + math.log(c)) * model.idf[b] for b, c in brute_counts(clean).items()}
    size = math.sqrt(sum(w * w for w in weights.values()))
    logits = [sum(w / size * float(model.weights[b, k]) for b, w in weights.items()) for k in range(len(model.languages))]
    raised = [math.exp((x - max(logits)) / model.temperature) for x in logits]
    return model.languages[int(np.argmax(logits))], max(raised) / sum(raised)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return langid.train(langid.labelled_part(documents))


def test_held_out_accuracy_and_calibration(documents, model):
    found = langid.predict(documents, model).alias("p").join(documents.alias("d"), "doc_id").where("held_out")
    rows = found.select("doc_id", "lang", "lang_pred", "p.score").collect()
    right = [r.lang == r.lang_pred for r in rows]
    assert len(rows) > 200 and sum(right) >= 0.98 * len(right)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    loss = -sum(math.log(max(r.score if ok else 1 - r.score, 1e-9)) for r, ok in zip(rows, right)) / len(rows)
    assert loss < 0.2
    assert (model.weights == 0).mean() > 0.5


def test_predictions_against_brute_force(spark, documents, model):
    texts = [r.text for r in documents.limit(25).collect()] + ["", "12 34 ##", "½ ²", "É", "a" * 40000, "word " * 9000, None]
    frame = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], SCHEMA)
    for r in langid.predict(frame, model).collect():
        lang, score = brute_prediction(model, texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-5) and 0 <= r.score <= 1


@pytest.mark.parametrize("piece", [1, 3, 8, 1 << 20])
def test_counts_against_whole_ngrams(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    for clean in (" a ", " ab cd ", " été déjà vu ", " " + "xy " * 50):
        found = langid.counts(clean)
        assert {b: int(found[b]) for b in np.flatnonzero(found)} == brute_counts(clean)


def test_document_frequencies_count_all_rows(documents):
    some = documents.limit(60)
    want = np.zeros(langid.BUCKETS)
    for r in some.collect():
        for b in brute_counts(langid.letters(r.text.encode())):
            want[b] += 1
    assert np.array_equal(langid.document_frequencies(some), want)


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        label = int(rng.integers(3))
        at = np.unique(np.concatenate((rng.integers(100, 2000, 20), [label])))
        rows.append((label, at, np.full(len(at), 1 / math.sqrt(len(at)))))
    weights = langid.ftrl(rows, 3)
    assert all(weights[k].argmax() == k for k in range(3))
    assert (weights == 0).mean() > 0.9


def test_odd_rows_and_tables(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "the cat and the dog", "en"), (5, "le chat et le chien", "fr"), (None, "le chat", "fr")]
    rows += [(6, None, "en"), (7, "no label here", None), (8, "123 !!", "en"), (9, "", "fr"), (1, "the cat and the dog", "en")]
    frame = spark.createDataFrame([(d, t, lang, "x", 1) for d, t, lang in rows], SCHEMA)
    found = langid.predict(frame, langid.train(frame))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == len(rows)
    assert {(r.doc_id, r.lang_pred) for r in found.where("score = 0").collect()} == {(6, "und"), (8, "und"), (9, "und")}
    assert not found.where("doc_id is null and held_out").count()
    nothing = langid.train(frame.where(F.lit(False)))
    assert {(r.lang_pred, r.score) for r in langid.predict(frame, nothing).collect()} == {("und", 0.0)}
    kept = langid.identified(frame, langid.train(frame), 0.0)
    assert kept.columns == frame.columns and kept.count() == 6


def test_rare_labels_beyond_the_bound_are_not_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    texts = {"aa": "alma beta gamma", "bb": "kilo lima mike", "other": "xyz zyx", "dd": "qqq www", "ee": "rrr ttt"}
    rows = [(i, texts[k], k) for i, k in enumerate(["aa"] * 40 + ["bb"] * 30 + ["other"] * 9 + ["dd"] * 8 + ["ee"] * 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame)
    assert model.languages == ["aa", "bb", "other"]
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(frame, model).collect()}
    assert {(i, k) for i, _, k in rows if k in model.languages} <= got and {k for _, k in got} == {"aa", "bb", "other"}


@pytest.mark.parametrize("labels,group", [(12, 5), (12, 400)])
def test_labels_trained_in_groups(spark, monkeypatch, labels, group):
    monkeypatch.setattr(langid, "GROUP", group)
    words = {f"l{i:02}": [f"{chr(97 + i)}{chr(97 + (i * 7 + j) % 26)}{chr(97 + (i + j * 3) % 26)}" for j in range(6)] for i in range(labels)}
    rows = [(i, " ".join(words[k][(i + j) % 6] for j in range(4)), k) for i, k in enumerate([*words] * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame)
    assert model.languages == sorted(words)
    right = sum(r.lang_pred == rows[r.doc_id][2] for r in langid.predict(frame, model).collect())
    assert right / len(rows) > 0.97


def test_a_thousand_labels_under_their_names(spark, monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 1)
    names = [f"x{i:03}" for i in range(1000)]
    rows = [(i * 2 + j, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q{chr(97 + i // 100)} word", k) for i, k in enumerate(names) for j in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame, fit_rows=2000)
    assert model.languages == names
    assert {r.lang_pred for r in langid.predict(frame.limit(50), model).collect()} <= set(names)


def test_least_score_lies_above_chance():
    assert langid.least_score(0.3, 4) == pytest.approx(0.3)
    assert all(1 / n < langid.least_score(0.3, n) < 1 / n + 0.07 for n in range(2, 401)) and langid.least_score(0.3, 1) == 1.0
