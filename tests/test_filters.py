"""No list that a call asks for is ignored: it changes the rows, or the report refuses it."""

import pytest

from shopledger.operators.scope import OPTIONAL_LISTS
from shopledger.operators.upsert import insert_if_absent, update_touch
from shopledger_checks import params as P
from shopledger_checks.registry import REPORTS

# One value of each list that some rows of the test tables have and others have not.
ONE = {"legal_entity_ids": (2,), "store_ids": (7, 8, 9), "region_ids": (0,), "customer_class_ids": (1,), "driver_ids": (3, 4)}


# The scoped keys and their oracles already tell that legal entities and stores count.
NEW = ("region_ids", "customer_class_ids", "driver_ids")
# One key of each report function: its forms take the same lists.
DISTINCT = {getattr(report, "func", report): key for key, (report, _, _) in sorted(REPORTS.items())}


@pytest.mark.parametrize("key", sorted(DISTINCT.values()))
def test_each_list_counts_or_is_refused(small, key):
    report = REPORTS[key][0]
    taken = getattr(report, "func", report).takes
    counted = [name for name in NEW if name in taken]
    plain = sorted(report(small, P.SPLIT).collect(), key=str) if counted else None
    for name in OPTIONAL_LISTS:
        asked = P.SPLIT.but(**{name: ONE[name]})
        if name in counted:
            assert sorted(report(small, asked).collect(), key=str) != plain, name
        elif name not in taken:
            with pytest.raises(ValueError, match=name):
                report(small, asked)


def test_keyed_writes_refuse_unknown_columns(spark):
    table = spark.sql("select 1 as id, 'a' as name, timestamp_ntz'2024-01-01 00:00:00' as updated_at")
    misspelt = spark.sql("select 1 as id, 'b' as nmae")
    with pytest.raises(ValueError, match="nmae"):
        update_touch(table, misspelt, ["id"], P.TOUCHED)
    with pytest.raises(ValueError, match="nmae"):
        insert_if_absent(table, misspelt, ["id"])
