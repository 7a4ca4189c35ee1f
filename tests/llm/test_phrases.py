import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from shopledger.llm import phrases, queries, sieve, tokens
from shopledger_checks.compare import duckdb_rows, spark_rows

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, n long, phrase string, words string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", lower(text)):
        yield [w for w in re.split("[ \t]+", piece) if w]


def brute(rows, min_count, top=2000, max_words=5):
    """Rows (lang, text) to the contract's rows, word by word."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            longer = [q for q, b in found.items() if len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not longer:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, text, lang, 0, "x", "y") for i, (lang, text) in enumerate(rows)], SCHEMA)


def found(frame, min_count, **kwargs):
    rows = phrases.collocations(frame, min_count=min_count, **kwargs).collect()
    return sorted(((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows), key=str)


def random_rows(seed, docs=60):
    rng = random.Random(seed)
    words = ["A", "a", "bé", "cc", "the", "The", "ÉT", "x\u00a0y", "\x01", "it's", "w" * 70]
    gaps = [" ", " ", " ", "  ", "\t", " \t ", ". ", ", ", "\n", "\r\n", "!?"]
    return [
        (rng.choice(["en", "fr", None, ""]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 120))))
        for _ in range(docs)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = random_rows(seed) + [(None, None), ("en", ""), ("und", "a cc a cc a cc"), ("en", " ,. \t")]
    rows += rows[:20]
    assert found(made(spark, rows), 4) == brute(rows, 4)
    assert found(made(spark, rows), 4, top=3) == [r for r in brute(rows, 4, top=3)]


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 64)
    rows = random_rows(3, 12) + [("en", "cc the " * 400), ("en", "w" * 500 + " cc the w. the w")]
    for text in (r[1].encode() for r in rows):
        parts = list(phrases.parts(text, 5))
        counted = sum(len(re.findall(rb"[^ \t.,;:!?\n-\r]+", p)) - again for p, again in parts)
        assert counted == len(re.findall(rb"[^ \t.,;:!?\n-\r]+", text))
    langs, texts = [b"en"] * len(rows), [r[1].encode() for r in rows]
    for n in (1, 2, 5):
        want = Counter(" ".join(w[i : i + n]) for _, t in rows for w in pieces(t) for i in range(len(w) - n + 1))
        got = Counter()
        for block, owners in phrases._blocks(langs, texts, n):
            for at in np.flatnonzero(block.new(n)):
                phrase = [block.text[block.starts[at + t] : block.ends[at + t]].tobytes().decode() for t in range(n)]
                got[" ".join(phrase)] += 1
                place = re.findall("[^ \t.,;:!?\n-\r]+", lower(rows[owners[block.part[at]]][1]))
                assert place[block.order[at] : block.order[at] + n] == phrase
        assert got == want


def test_colliding_phrases_are_told_apart(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words, langs = rng.integers(0, 4, (500, 3)), rng.integers(0, 2, 500)
    for bits in (0, 1, 7):
        keys = (words.sum(axis=1) & bits).astype(np.uint64)
        got = phrases.Found(keys, langs, words, np.full(500, 2), np.arange(500), np.arange(500)).merged()
        want = Counter((lang, *row) for lang, row in zip(langs.tolist(), words.tolist()))
        assert {(lang, *row): n // 2 for lang, row, n in zip(got.langs.tolist(), got.words.tolist(), got.counts)} == want
        assert len(got.keys) == len(want)
    # Tasks run in processes of their own, which copy the weakened function.
    rows = random_rows(5, 40)
    weak = lambda self, n, at: tokens.polynomials(self.values, at, at + n) & np.uint64(0xFF << 56 | 3)
    monkeypatch.setattr(phrases.Block, "fingerprints", weak)
    assert found(made(spark, rows), 3) == brute(rows, 3)


def test_little_memory_gives_the_same(spark, monkeypatch):
    rows = random_rows(6, 60)
    monkeypatch.setattr(tokens, "MERGE", 20)
    monkeypatch.setattr(tokens, "BLOCK", 128)
    assert found(made(spark, rows), 4) == brute(rows, 4)


def test_bitmap_holds_its_keys_and_little_else(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) as key")
    bits = sieve.bitmap(keys)
    held = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    assert sieve.may_hold(bits, held).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 100_000, np.uint64) * np.uint64(2)
    assert sieve.may_hold(bits, other).mean() < 1e-3
    assert not sieve.bitmap(keys.where("false")).any()


def test_scores_beyond_64_bits(spark):
    n, a, l, r = 9 * 10**17, 4 * 10**12, 5 * 10**12 + 1, 7 * 10**12 + 3
    rows = [("en", "", 0, n), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, n long")).collect()
    assert [(g.phrase, g.score) for g in got] == [("x y", 1000 * a * n // (l * r))]


def test_pointer_leads_to_the_phrase(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = phrases.collocations(docs).collect()
    assert len(rows) > 50
    for r in rows:
        words = [w for p in pieces(texts[r.first_doc]) for w in p]
        assert " ".join(words[r.first_word : r.first_word + len(r.phrase.split(" "))]) == r.phrase


def test_empty_table(spark):
    assert found(made(spark, []), 1) == []
    assert found(made(spark, [("en", None), (None, "one two")]), 2) == []


def test_whole_table_and_odd_rows_against_sql(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = made(spark, [(None, "New York City, new york. " * 120), ("", "a\tb  a\x0bb a b" * 150), ("en", None)])
    docs.unionByName(odd.select("doc_id", "text", "lang")).unionByName(docs.limit(300)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(queries.op11_collocations(spark, str(tmp_path)))
    assert got == duckdb_rows(con, queries.all_oracles()["op11_collocations"]) and len(got[1]) > 70
