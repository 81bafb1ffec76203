"""Every registered query of the job against its SQL, and the counts the fixtures promise."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from duolect.checks.fixtures import dirty_outcomes
from duolect.checks.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_every_query_of_this_part_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "status" in rows.columns


def test_dirty_manifest_counts(spark):
    rows = dirty_outcomes(spark, "/root/testdata/sf0.01").select("status", "error", "row_no").collect()
    kinds = Counter(r.status if r.status != "error" else r.error.split("(")[1][:12] for r in rows)
    assert kinds == {"ok": 605, "skipped": 2, "'Audio file ": 14, '"Empty manif': 15, "'[chatterbox": 11}
    by_row = {r.row_no: r.status for r in rows}
    assert (by_row[355], by_row[356], by_row[852], by_row[853]) == ("ok", "skipped", "error", "ok")
