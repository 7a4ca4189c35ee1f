"""Published tables: what a version holds, what a broken or repeated write leaves, and which files an update touches."""

from pathlib import Path

import pytest
from conftest import at
from test_plans import plan_of

from shopledger.operators.keyfilter import may_match
from shopledger.operators.upsert import insert_published, update_published
from shopledger.sources.published import Conflict, Published

SCHEMA = "k bigint, v string, updated_at timestamp_ntz, month date"
NOW = at("2025-01-01 00:00:00")


def made(spark, ids, month="2024-01-01", v="old"):
    return spark.createDataFrame([(i,) for i in ids], "k bigint").selectExpr(
        "k", f"'{v}' as v", "timestamp_ntz'2024-01-01 00:00:00' as updated_at", f"date'{month}' as month"
    )


def rows(table, version=None):
    return sorted((r.k, r.v, str(r.month), r.updated_at == NOW) for r in table.read(version).collect())


def files(root):
    return {str(p.relative_to(root)): (p.read_bytes(), p.stat().st_mtime_ns) for p in Path(root).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), SCHEMA, ["month"])
    months = ["2024-01-01", "2024-02-01", "2024-03-01"]
    first = made(spark, range(10), months[0])
    for i, month in enumerate(months[1:], 1):
        first = first.unionByName(made(spark, range(i * 10, i * 10 + 10), month))
    table.replace(first)
    return table


def test_empty_before_the_first_version(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), SCHEMA)
    assert table.read().collect() == [] and table.version().number == 0
    table.append(made(spark, [1]))
    assert [r.k for r in table.read().collect()] == [1] and table.version().number == 1


def test_update_rewrites_the_touched_month_only(spark, table):
    before, old = files(table.root), table.version()
    updates = spark.sql("select 12L as k, 'new' as v union all select 99L, 'unknown'")
    new = update_published(table, updates, ["k"], NOW)
    after = files(table.root)
    assert all(after[name] == content for name, content in before.items())
    assert {name.split("/")[1] for name in set(after) - set(before)} == {"month=2024-02-01"}
    assert {d for d in new.directories if "2024-02" not in d} == {d for d in old.directories if "2024-02" not in d}
    got = rows(table)
    assert len(got) == 30 and [r for r in got if r[3]] == [(12, "new", "2024-02-01", True)]
    # The version before is still there as it was.
    assert rows(table, old) == [(k, "old", m, False) for k, _, m, _ in got]


def test_update_of_unknown_keys_publishes_nothing(spark, table):
    number = table.version().number
    assert update_published(table, spark.sql("select 77L as k, 'x' as v"), ["k"], NOW).number == number
    with pytest.raises(ValueError):
        update_published(table, spark.sql("select 1L as k, 'x' as misspelt"), ["k"], NOW)


def test_update_can_move_a_row_to_another_month(spark, table):
    update_published(table, spark.sql("select 5L as k, date'2024-03-01' as month"), ["k"], NOW)
    assert [r[2] for r in rows(table) if r[0] == 5] == ["2024-03-01"] and len(rows(table)) == 30


def test_a_write_that_ends_before_its_manifest_has_not_happened(spark, table, monkeypatch):
    before = rows(table)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Published, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            insert_published(table, made(spark, [100]), ["k"], job="load 7")
    assert len(files(table.root)) > 3 and rows(table) == before
    # The job runs again, twice: its rows are there once.
    insert_published(table, made(spark, [100]), ["k"], job="load 7")
    insert_published(table, made(spark, [100, 101]), ["k"], job="load 7")
    assert rows(table) == sorted([*before, (100, "old", "2024-01-01", False)])


def test_a_failed_task_leaves_no_rows_behind(spark, table):
    before = rows(table)
    with pytest.raises(Exception, match="broken"):
        table.append(made(spark, range(200, 300)).selectExpr("if(k = 250, raise_error('broken'), k) as k", "v", "updated_at", "month"))
    assert rows(table) == before


def test_second_of_two_writers_fails(spark, table):
    old = table.version()
    table.append(made(spark, [100]))
    with pytest.raises(Conflict):
        table._publish(old, old.directories, None)
    assert len(rows(table)) == 31 and not [p for p in Path(table.root, "manifests").iterdir() if p.name.startswith("_")]


def test_insert_writes_the_fresh_rows_only(spark, table):
    before = files(table.root)
    source = made(spark, [3, 50, 50], "2024-02-01", "fresh").unionByName(spark.sql("select cast(null as bigint) as k, 'n' as v, cast(null as timestamp_ntz) as updated_at, cast(null as date) as month"))
    insert_published(table, source, ["k"])
    after = files(table.root)
    assert all(after[name] == content for name, content in before.items())
    assert [r.v for r in table.read().where("k = 3").collect()] == ["old"]
    fresh = table.read().where("v <> 'old'").collect()
    assert sorted((r.k or 0, r.v) for r in fresh) == [(0, "n"), (50, "fresh")]


def test_filter_stands_between_scan_and_exchange(spark, table):
    wanted = spark.sql("select 5 as k")
    held = may_match(table.read().select("k"), ["k"], wanted)
    assert {r.k for r in held.collect()} >= {5} and held.count() < 5
    plan = plan_of(wanted.join(held, "k", "left_anti"))
    assert "getbit" in plan and "Subquery" in plan
    assert may_match(table.read().select("k"), ["k"], wanted.where("k is null")).count() == 0
    assert may_match(table.read().select("k"), ["k"], table.read().select("k"), words=1).count() == 30
