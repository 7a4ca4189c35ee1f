import math

import numpy as np
import pytest

from shopledger.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<double>, node long, n_links int, kept string"


def brute(rows, least=0.9):
    """Links and components by all cosines."""
    count = len(rows)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.abs(v).max() if g else None for (_, v), g in zip(rows, good)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    links, root = [set() for _ in rows], list(range(count))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(count):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i].add(j)
                links[j].add(i)
                root[find(i)] = find(j)
    out = []
    for i, (vec, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(count) if find(j) == find(i) and rows[j][0] is not None]
        smallest = min(ids, default=None)
        out.append((vec, len(links[i]), smallest, vec is not None and vec == smallest))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def noisy(rng, centre, spread):
    return (centre + spread * rng.standard_normal(len(centre))).tolist()


def clear_rows():
    """Groups far inside the threshold, so that recall is one; and all odd kinds of rows."""
    rng, rows = np.random.default_rng(4), []
    for c in range(25):
        centre = rng.standard_normal(32)
        rows += [(100 * c + i, noisy(rng, centre, 0.05)) for i in range(int(rng.integers(1, 9)))]
    first = rows[0][1]
    nan, inf = float("nan"), float("inf")
    rows += [(7001, first), (7002, first), (7002, first), (7003, [2e200 * x for x in first]), (7004, [1e-200 * x for x in first]), (None, first)]
    rows += [(7005, None), (7006, []), (7007, [0.0] * 32), (7008, [nan] * 32), (7009, [1.0, None, 2.0]), (7010, [inf] + [0.0] * 31)]
    rows += [(7011, [1.0]), (7012, [2.0]), (7013, [-1.0]), (None, None), (None, [0.3, 0.4])]
    return rows


@pytest.mark.parametrize("block", [4, 1_024])
def test_groups_and_odd_rows_against_all_cosines(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = clear_rows()
    got = [tuple(r) for r in embeddings.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_recall_at_the_threshold(spark):
    rng, rows = np.random.default_rng(9), []
    for k in range(700):
        a = rng.standard_normal(48)
        a /= np.sqrt(a @ a)
        b = rng.standard_normal(48)
        b -= (a @ b) * a
        b /= np.sqrt(b @ b)
        cosine = 0.9 + 0.02 * (k % 2)
        rows += [(2 * k, a.tolist()), (2 * k + 1, ((cosine + 1e-9) * a + math.sqrt(1 - cosine**2) * b).tolist())]
    rows += [(10_000 + k, rng.standard_normal(48).tolist()) for k in range(3_000)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame(spark, rows)).collect()}
    found = sum(got[2 * k + 1].component_id == 2 * k for k in range(700))
    assert found >= 0.95 * 700
    assert all(got[10_000 + k].n_links == 0 for k in range(3_000))


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_whole_table_against_all_cosines(spark, folder):
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    rows += [(10_000 + i, (np.array(v) + 0.02 * np.random.default_rng(i).standard_normal(len(v))).tolist()) for i, v in rows[:60]]
    got = sorted(tuple(r) for r in embeddings.near_duplicates(frame(spark, rows)).collect())
    want = sorted(brute(rows))
    assert sum(w[1] for w in want) and sum(g == w for g, w in zip(got, want)) >= 0.99 * len(want)
    assert queries.op7_embeddings(spark, f"/root/testdata/{folder}").count() == len(rows) - 60


def test_lines_follow_the_recall_and_the_number_of_vectors():
    small, large = embeddings.lines_for(1_000), embeddings.lines_for(10_000_000)
    assert large.per_table > small.per_table and large.tables > small.tables
    assert embeddings.lines_for(10_000, recall=0.999).tables > embeddings.lines_for(10_000, recall=0.9).tables


def test_empty_table(spark):
    assert embeddings.near_duplicates(frame(spark, [])).count() == 0
