import hashlib
from collections import Counter

import pytest

from shopledger.llm import queries, sharding

SCHEMA = "doc_id long, slot string, shard string, text string"


def brute_table(shards, slots):
    """Every shard's whole order of preference written out; turns by name."""
    orders = {}
    for s in shards:
        offset, step = sharding.preference(s, slots)
        orders[s] = [(offset + i * step) % slots for i in range(slots)]
        assert sorted(orders[s]) == list(range(slots))
    held = {}
    while len(held) < slots:
        for s in sorted(shards):
            if len(held) < slots:
                held[next(x for x in orders[s] if x not in held)] = shards.index(s)
    return [held[i] for i in range(slots)]


@pytest.mark.parametrize("slots,count", [(2, 1), (7, 3), (13, 13), (101, 10), (251, 64)])
def test_table_against_written_out_orders(slots, count):
    shards = sharding.names(count)[::-1]
    assert sharding.lookup_table(shards, slots) == brute_table(shards, slots)


def test_even_and_little_moves_when_a_shard_leaves():
    shards = sharding.names(20)
    before = sharding.lookup_table(shards)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    left = shards[:7] + shards[8:]
    after = sharding.lookup_table(left)
    moved = sum(shards[a] != left[b] for a, b in zip(before, after))
    assert counts[7] <= moved < 2.5 * counts[7]


@pytest.mark.parametrize("slots,shards", [(10, ["a"]), (3, ["a", "a"]), (3, []), (2, ["a", "b", "c"])])
def test_bad_tables_are_refused(slots, shards):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def test_whole_table_against_brute_force(spark):
    shards = sharding.names()
    table = sharding.lookup_table(shards)
    rows = queries.op3_sharding(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert len(rows) == docs
    for r in rows:
        assert r.slot == int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert r.shard == table[r.slot]


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, "x", "y", None), (1, "x", "y", None), (None, "x", "y", ""), (2, None, None, "t" * 100000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    placed = sharding.place(frame, "doc_id", ["a", "b", "c"], 13)
    assert placed.columns == ["doc_id", "text", "slot", "shard"]
    found = {(r.doc_id, r.slot, r.shard) for r in placed.collect()}
    assert placed.count() == 4 and len(found) == 3
    by_text = sharding.place(frame, "text", ["a", "b", "c"], 13).collect()
    assert len({r.shard for r in by_text if not r.text}) == 1
    assert sharding.placements(spark.createDataFrame([], SCHEMA)).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write(docs, "doc_id", sharding.names(5), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and {r.shard for r in back.select("shard").distinct().collect()} == set(range(5))
