import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from shopledger.llm import divergence, queries, tokens
from shopledger_checks.compare import duckdb_rows, spark_rows

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, term string, count long"


def brute(rows, min_docs, top=10):
    """Rows (lang, source, text) to the contract's rows, term by term."""
    docs, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for lang, source, text in rows:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        docs[lang or ""].update(set(found))
        groups[lang or ""][source or ""].update(found)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        all_counts = sum(sources.values(), Counter())

        def share(counts):
            below = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // below for t in kept}

        shares, whole = {s: share(c) for s, c in sources.items()}, share(all_counts)
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in shares.items():
            pair = [(-sum(f(p[t], q[t]) for t in kept), o.encode(), o) for o, q in shares.items() if o != s]
            term = [(-f(p[t], whole[t]), t.encode(), t) for t in kept if sources[s][t] and p[t] > whole[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, text, lang, source, "x", 1) for i, (lang, source, text) in enumerate(rows)], SCHEMA)


def found(frame, min_docs):
    return sorted(map(tuple, divergence.audit(frame, min_docs).collect()), key=str)


def found_with(spark, rows, min_docs):
    return found(made(spark, rows), min_docs)


def random_rows(seed, docs=80):
    rng = random.Random(seed)
    words = ["a", "A", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "é", "été", "x1y", "Zz", "l" * 40, "l" * 41, "don't", "日本"]
    return [
        (rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "", None]), " ".join(rng.choice(words) for _ in range(rng.randrange(9))))
        for _ in range(docs)
    ]


@pytest.mark.parametrize("seed,min_docs", [(1, 2), (2, 6)])
def test_against_brute_force(spark, seed, min_docs):
    rows = random_rows(seed) + [("en", "s9", None), ("de", "s1", "one"), ("de", "s2", ""), ("it", "s1", "1 2")]
    rows += rows[:10]
    assert found_with(spark, rows, min_docs) == brute(rows, min_docs)


def test_small_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 8)
    rows = random_rows(3, 120)
    assert found_with(spark, rows, 3) == brute(rows, 3)


def test_terms_that_leave_a_task_in_many_tables(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 16)
    monkeypatch.setattr(divergence, "HELD", 4)
    rows = random_rows(7) + [("en", "s1", "abc abcd " * 50 + "été")] * 3
    assert found_with(spark, rows, 3) == brute(rows, 3)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 16)
    text = b"Ab " * 30 + b"q" * 50 + b" ab1cd"
    assert b"".join(divergence._cut(text)) == text
    found = []
    for rows, held in divergence._blocks([b"", text, b"x y", b"z" * 40, b""]):
        row, number, words = divergence._terms_of(rows, held)
        found += [(r, words[n].as_py()) for r, n in zip(row.tolist(), number.tolist())]
    assert found == [(1, b"ab")] * 30 + [(1, b"q" * 50), (1, b"ab"), (1, b"cd"), (2, b"x"), (2, b"y"), (3, b"z" * 40)]
    rows = random_rows(4, 60) + [("en", "s1", "abc zz " * 40), ("fr", "s2", "zz " * 7 + "a" * 90 + " zz a " * 9)]
    assert found_with(spark, rows, 5) == brute(rows, 5)


def test_levels_keep_what_is_frequent_and_drop_prefixes(spark):
    rows = [("en", "s", f"prefix{'abcdefghij'[i % 10]} common prefixed{i}") for i in range(30)]
    names = {f"prefix{c}" for c in "abcdefghij"}
    kept = {r.term: r["count"] for r in divergence.kept_terms(made(spark, rows), 4).collect()}
    assert kept == {"common": 30, "prefixed": 30}
    assert {r.term for r in divergence.kept_terms(made(spark, rows), 3).collect()} == {"common", "prefixed"} | names


def test_empty_table(spark):
    assert found(made(spark, []), 1) == []


def test_whole_table_and_odd_rows_against_sql(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = made(spark, [(None, None, "Élan élan"), ("en", None, None), ("xx", "s", "1"), ("xx", "t", "one")] + [("yy", "s", "w" * 300)] * 12)
    docs.unionByName(odd.select(docs.columns)).unionByName(docs.limit(300)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(queries.op12_divergence(spark, str(tmp_path)))
    assert got == duckdb_rows(con, queries.all_oracles()["op12_divergence"]) and len(got[1]) > 2000
