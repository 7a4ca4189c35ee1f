from conftest import at

from shopledger.operators.upsert import insert_if_absent, one_per_key, update_touch


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_existing_keys_win_and_copies_collapse(spark):
    target = spark.sql("select * from values (1, 'a', 'old') as t(id, k, v)")
    source = spark.sql("select * from values ('a', 'new'), ('b', 'z'), ('b', 'y') as t(k, v)")
    assert rows(insert_if_absent(target, source, ["k"])) == [(1, "a", "old"), (None, "b", "y")]


def test_null_keys_never_conflict(spark):
    target = spark.sql("select * from values (cast(null as string), 1) as t(k, v)")
    source = spark.sql("select * from values (cast(null as string), 2), (null, 2), ('x', 3) as t(k, v)")
    assert rows(insert_if_absent(target, source, ["k"])) == [("x", 3), (None, 1), (None, 2), (None, 2)]


def test_inserting_again_changes_nothing(spark):
    target = spark.sql("select 1 as k, 'a' as v")
    source = spark.sql("select 2 as k, 'b' as v")
    once = insert_if_absent(target, source, ["k"])
    assert rows(insert_if_absent(once, source, ["k"])) == rows(once)


def test_update_touches_matched_rows_only(spark):
    target = spark.sql(
        "select * from values ('a', false, timestamp_ntz'2024-01-01 00:00:00'), ('b', false, timestamp_ntz'2024-01-01 00:00:00')"
        " as t(k, enabled, updated_at)"
    )
    updates = spark.sql("select 'a' as k, true as enabled union all select 'zz', true")
    assert rows(update_touch(target, updates, ["k"], at("2025-01-01 00:00:00"))) == [
        ("a", True, at("2025-01-01 00:00:00")),
        ("b", False, at("2024-01-01 00:00:00")),
    ]


def test_update_can_set_null_and_repeated_updates_do_not_fan_out(spark):
    target = spark.sql("select 1 as k, 'x' as v, timestamp_ntz'2024-01-01 00:00:00' as updated_at")
    updates = spark.sql("select * from values (1, cast(null as string)), (1, 'q') as t(k, v)")
    assert rows(update_touch(target, updates, ["k"], at("2025-01-01"))) == [(1, None, at("2025-01-01"))]


def test_one_per_key_of_key_columns_only(spark):
    assert rows(one_per_key(spark.sql("select * from values (1), (1), (2) as t(k)"), ["k"])) == [(1,), (2,)]
