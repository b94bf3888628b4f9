import pytest

from driftgate.operators import drill, drop_column, retype_to_string
from driftgate.settings import DRILLS
from tests.test_queries import SMALL
from workload.tables import EVENTS, TABLE_DRILLS, events_unsafe, table


def test_corruption_has_the_expected_share_and_survives_repartitioning(spark):
    events = table(spark, "/root/testdata/sf0.01", "events")
    drifted = retype_to_string(events.repartition(3), "value", EVENTS.key, corrupt=True)
    counts = {r[0]: r[1] for r in drifted.filter("value IN ('N/A', 'ERROR')").groupBy("value").count().collect()}
    assert counts == {"N/A": 2975, "ERROR": 1452}


def test_missing_column_is_refused(spark):
    events = table(spark, SMALL, "events")
    with pytest.raises(ValueError):
        drop_column(events, "nothing")
    with pytest.raises(ValueError):
        retype_to_string(events, "nothing")


def test_corruption_needs_a_key(spark):
    with pytest.raises(ValueError):
        retype_to_string(table(spark, SMALL, "events"), "value", corrupt=True)


def test_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError):
        drill(table(spark, SMALL, "events"), TABLE_DRILLS["events"], "melted", EVENTS.key)


def test_drill_says_what_it_did(spark):
    events = table(spark, SMALL, "events")
    spec = TABLE_DRILLS["events"]
    added = drill(events, spec, "column_added", EVENTS.key)
    assert (added.column, added.critical) == ("loyalty_tier", False)
    removed = drill(events, spec, "column_removed", EVENTS.key, force_critical=True)
    assert (removed.column, removed.critical, "value" in removed.df.columns) == ("value", True, False)
    retyped = drill(events, spec, "type_changed", EVENTS.key)
    assert (retyped.column, retyped.critical) == ("value", True)


def test_every_entity_has_a_drill():
    assert list(DRILLS) == ["transactions", "accounts", "customers"]


def test_events_are_corrupted_the_same_way_twice(spark):
    first, second = events_unsafe(spark, SMALL), events_unsafe(spark, SMALL)
    assert first.exceptAll(second).count() == 0
