import datetime as dt
import random

from driftgate.operators import volume_by_day
from driftgate.settings import Limits

START = dt.date(2024, 1, 1)


def frame(spark, counts, group="g"):
    rows = [
        (dt.datetime.combine(START + dt.timedelta(days=i), dt.time(h % 24)), group)
        for i, n in enumerate(counts)
        for h in range(n)
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, g string")


def brute(counts, limits=Limits()):
    """The rules, day by day."""
    result = {}
    fell = [i > 0 and n <= (1 - limits.decline_rate) * counts[i - 1] for i, n in enumerate(counts)]
    for i in range(limits.trailing_days, len(counts)):
        mean = sum(counts[i - limits.trailing_days : i]) / limits.trailing_days
        n, flag = counts[i], None
        if n == 0:
            flag = "zero"
        elif n >= limits.volume_spike * mean:
            flag = "spike"
        elif n <= limits.volume_drop * mean:
            flag = "drop"
        result[i] = (n, flag, all(fell[i - limits.decline_days + 1 : i + 1]))
    return result


def ours(df, **kwargs):
    return {
        (r["day"] - START).days: (r["n_rows"], r["flag"], r["declining"])
        for r in volume_by_day(df, "ts", **kwargs).collect()
    }


def test_flags_against_brute_force(spark):
    random.seed(5)
    for _ in range(4):
        counts = [random.choice([0, 1, 5, 10, 12, 20]) for _ in range(25)]
        counts[0] = counts[-1] = 10
        assert ours(frame(spark, counts)) == brute(counts)


def test_decline(spark):
    counts = [50] * 7 + [45, 40, 36, 32, 28, 25, 24]
    found = ours(frame(spark, counts))
    assert found == brute(counts)
    assert [day for day, (_, _, declining) in found.items() if declining] == [11, 12]


def test_groups_are_judged_apart(spark):
    both = frame(spark, [10] * 9, "a").union(frame(spark, [10] * 8 + [30], "b"))
    flagged = [(r["g"], r["flag"]) for r in volume_by_day(both, "ts", by=["g"]).collect() if r["flag"]]
    assert flagged == [("b", "spike")]


def test_a_group_that_stops_is_judged_to_the_end(spark):
    both = frame(spark, [10] * 20, "a").union(frame(spark, [10] * 9, "b"))
    zero = [r for r in volume_by_day(both, "ts", by=["g"]).collect() if r["flag"] == "zero"]
    assert {r["g"] for r in zero} == {"b"}
    assert [(r["day"] - START).days for r in sorted(zero, key=lambda r: r["day"])] == list(range(9, 20))


def test_stray_and_missing_times_are_counted_apart(spark):
    stray = [(dt.datetime(9999, 12, 31), "g"), (dt.datetime(1, 1, 1), "g"), (None, "g"), (None, "g")]
    rows = frame(spark, [10] * 9).union(spark.createDataFrame(stray, "ts timestamp_ntz, g string"))
    found = volume_by_day(rows, "ts").collect()
    assert len(found) == 5
    odd = {(r["day"] and r["day"].year, r["n_rows"], r["flag"]) for r in found if r["flag"]}
    assert odd == {(9999, 1, "outside"), (1, 1, "outside"), (None, 2, "undated")}
    early = volume_by_day(frame(spark, [10] * 9), "ts", since="2024-01-02", until="2024-01-08").collect()
    assert {str(r["day"]) for r in early if r["flag"] == "outside"} == {"2024-01-01", "2024-01-09"}


def test_limits_apply(spark):
    counts = [10] * 8 + [12]
    assert ours(frame(spark, counts), limits=Limits(volume_spike=1.2))[8][1] == "spike"


def test_too_few_days(spark):
    assert ours(frame(spark, [1, 2, 3])) == {}


def test_rows_are_counted_before_any_window(spark):
    plan = volume_by_day(frame(spark, [1, 2]), "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_count")
