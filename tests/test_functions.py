"""Expressions on literals, one test per trap. The session zone has daylight saving."""

from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from shopledger.functions import amounts, calendar, flags, ratios
from shopledger.operators.documents import as_json, list_by
from shopledger.operators.ranking import largest_first, preview, top
from shopledger.operators.totals import few_in_order, top_with_totals
from shopledger.operators.weekdays import on_every_weekday, weekday_spine


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_name_with_a_missing_part_keeps_the_blank(spark):
    assert one(spark, flags.full_name(F.lit("Ann"), F.lit("Lee"))) == "Ann Lee"
    assert one(spark, flags.full_name(F.lit("Ann"), F.lit(None).cast("string"))) == "Ann "
    assert one(spark, flags.full_name(F.lit(None).cast("string"), F.lit(None).cast("string"))) == " "


def test_deletion_flags_differ_on_null(spark):
    unknown = F.lit(None).cast("boolean")
    assert one(spark, flags.live_unless_deleted(unknown)) is True
    assert one(spark, flags.known_live(unknown)) is None
    assert one(spark, flags.known_live(F.lit(False))) is True


def test_month_start_stays_zone_free(spark):
    month = calendar.month_start(ntz("2024-03-10 02:30:00"))
    assert one(spark, F.typeof(month)) == "timestamp_ntz"
    assert one(spark, month) == at("2024-03-01 00:00:00")


@pytest.mark.parametrize("day, number, name", [("2024-03-04", 1, "Mon"), ("2024-03-10", 7, "Sun")])
def test_weekdays(spark, day, number, name):
    ts = ntz(f"{day} 02:30:00")
    assert one(spark, calendar.iso_weekday(ts)) == number
    assert one(spark, calendar.weekday_name(calendar.iso_weekday(ts))) == name


def test_seconds_ignore_daylight_saving_and_keep_the_fraction(spark):
    gap = calendar.seconds_between(ntz("2024-03-10 01:30:00"), ntz("2024-03-10 04:30:00.25"))
    assert one(spark, gap) == Decimal("10800.25")


def test_text_of_a_moment(spark):
    ts = ntz("2024-03-10 02:30:00")
    assert one(spark, calendar.iso_text(ts)) == "2024-03-10T02:30:00"
    assert one(spark, calendar.month_name(ts)) == "Mar"
    assert one(spark, F.hour(ts)) == 2


def test_period_ends_are_included(spark):
    period = calendar.Period(at("2024-01-01 00:00:00"), at("2024-01-31 23:59:59"))
    assert one(spark, calendar.within(ntz("2024-01-31 23:59:59"), period)) is True
    assert one(spark, calendar.within(ntz("2024-01-31 23:59:59.5"), period)) is False


def test_signs(spark):
    frame = spark.sql(
        "select * from values ('SALES', 2.50BD), ('RETURNS', 2.50BD), ('QUOTE', 2.50BD), (null, 2.50BD), ('SALES', null)"
        " as t(invoice_type, x)"
    )
    x = F.col("x")
    assert [r[0] for r in frame.select(amounts.signed(x)).collect()] == [Decimal("2.50"), Decimal("-2.50"), 0, 0, None]
    assert [r[0] for r in frame.select(amounts.only_on("RETURNS", x)).collect()] == [0, Decimal("2.50"), 0, 0, 0]


def test_ratios_round_half_up_and_guard_zero(spark):
    def dec(text):
        return F.lit(text).cast("decimal(18,2)")

    assert one(spark, ratios.percent(dec("1"), dec("3"))) == Decimal("33.33")
    assert one(spark, ratios.percent(dec("1.005"), dec("100"))) == Decimal("1.01")
    assert one(spark, ratios.percent(dec("-12.345"), dec("100"))) == Decimal("-12.35")
    assert one(spark, ratios.percent(dec("1"), dec("0"))) is None
    assert one(spark, ratios.rate_or_zero(F.lit(3), F.lit(0))) == 0
    assert one(spark, ratios.average_or_zero(dec("10"), F.lit(3))) == Decimal("3.33")


def test_ratio_of_very_large_sums(spark):
    total = F.lit("1000000000000000000000.00").cast("decimal(38,2)")
    assert one(spark, ratios.percent(total / 8, total)) == Decimal("12.50")


def test_null_is_largest_in_descending_order(spark):
    frame = spark.sql("select * from values (1), (null), (3) as t(x)")
    assert [r.x for r in top(frame, 2, largest_first("x")).collect()] == [None, 3]


def test_preview_is_repeatable(spark):
    frame = spark.range(100).select((F.col("id") % 7).alias("a"), "id").repartition(5)
    assert [tuple(r) for r in preview(frame, 3).collect()] == [(0, 0), (0, 7), (0, 14)]


def test_totals_before_a_limit(spark):
    frame = spark.range(1, 11).select("id", (F.col("id") * 10).alias("v"))
    rows = top_with_totals(frame, 2, [largest_first("v")], {"s": "v", "ids": "id"}).collect()
    assert [tuple(r) for r in rows] == [(10, 100, 550, 55), (9, 90, 550, 55)]


def test_totals_of_nothing_and_of_null_keys(spark):
    frame = spark.sql("select * from values (cast(null as int), 5), (1, null) as t(id, v)")
    rows = top_with_totals(frame, 3, [largest_first("v")], {"s": "v"}).collect()
    assert [tuple(r) for r in rows] == [(1, None, 5), (None, 5, 5)]
    assert top_with_totals(frame.limit(0), 3, [largest_first("v")], {"s": "v"}).count() == 0


def test_few_rows_keep_the_order(spark):
    frame = spark.sql("select * from values (3, 'c', 1), (1, 'a', null), (2, 'b', 5) as t(k, name, v)")
    rows = few_in_order(frame, ["k"], s=F.sum("v")).collect()
    assert [tuple(r) for r in rows] == [(1, "a", None, 6), (2, "b", 5, 6), (3, "c", 1, 6)]


def test_weekday_spine(spark):
    assert [tuple(r) for r in weekday_spine(spark).collect()] == [
        (1, "Mon"), (2, "Tue"), (3, "Wed"), (4, "Thu"), (5, "Fri"), (6, "Sat"), (7, "Sun"),
    ]
    filled = on_every_weekday(spark.sql("select 3 as day_num, 9 as n")).orderBy("day_num")
    assert [r.n for r in filled.collect()] == [None, None, 9, None, None, None, None]


def test_json_keeps_nulls_trailing_zeros_and_order(spark):
    frame = spark.sql("select * from values (2, 12.30BD), (1, null) as t(k, v)")
    assert frame.agg(as_json(list_by(F.col("k"), "k", "v"))).first()[0] == '[{"k":1,"v":null},{"k":2,"v":12.30}]'
