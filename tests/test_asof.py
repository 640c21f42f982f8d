import datetime as dt
import random

import pytest

from tallyline.operators.asof import asof_calendar, asof_merge

DAY0 = dt.date(2026, 1, 1)


def expected(left, right, fallback):
    """By definition: latest right row at or before, else the earliest of the key."""
    out = []
    for i, key, at in left:
        mine = sorted((t, v) for k, t, v in right if k == key and None not in (key, t))
        before = [p for p in mine if at is not None and p[0] <= at]
        if before:
            out.append((i, max(before)[1], max(before)[0], False))
        elif mine and fallback and at is not None:
            first = min(t for t, _ in mine)
            out.append((i, max(v for t, v in mine if t == first), first, True))
        else:
            out.append((i, None, None, None))
    return sorted(out)


def rows(df):
    return sorted((r["i"], r["v"], r["at_right"], r["is_estimated"]) for r in df.collect())


def data(instants, seed):
    rng = random.Random(seed)
    right = [(k, rng.choice(instants), float(rng.randint(1, 50))) for k in "abc" for _ in range(8)]
    right += [("a", right[0][1], 99.0), ("b", None, 1.0)]
    left = [(i, rng.choice(["a", "b", "c", "d", None]), rng.choice([*instants, None]))
            for i in range(120)]
    return left, right


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("limit", [0, 4, 1_000_000])
def test_calendar_equals_the_definition(spark, fallback, limit):
    days = [DAY0 + dt.timedelta(days=d) for d in range(40)]
    left, right = data(days, 3)
    right = [r for r in right if r[1] is None or 5 <= (r[1] - DAY0).days <= 30]
    got = asof_calendar(
        spark.createDataFrame(left, "i int, k string, at date"),
        spark.createDataFrame(right, "k string, at_right date, v double"),
        ["k"], "at", "at_right", ["v"], fallback=fallback, broadcast_rows=limit)
    assert rows(got) == expected(left, right, fallback)


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_merge_equals_the_definition(spark, fallback, ranges):
    start = dt.datetime(2026, 1, 1)
    instants = [start + dt.timedelta(minutes=17 * m) for m in range(60)]
    left, right = data(instants, 5)
    right += [(None, instants[0], 7.0)]
    df = spark.createDataFrame(left, "i int, k string, at timestamp_ntz")
    points = spark.createDataFrame(right, "k string, at_right timestamp_ntz, v double")
    got = asof_merge(df, points, ["k"], "at", "at_right", ["v"], fallback=fallback, ranges=ranges)
    assert rows(got) == expected(left, right, fallback)
    inner = asof_merge(df, points, ["k"], "at", "at_right", ["v"], fallback=fallback, how="inner", ranges=ranges)
    assert rows(inner) == [r for r in expected(left, right, fallback) if r[2] is not None]


def test_merge_carries_values_over_empty_and_crowded_ranges(spark):
    """One key with most rows, one instant with a third of them, and keys whose only right row lies ranges away."""
    start = dt.datetime(2026, 1, 1)
    left = [(i, "a", start + dt.timedelta(minutes=i % 300)) for i in range(600)] + [(600 + i, "a", start) for i in range(300)]
    left += [(900 + i, "b", start + dt.timedelta(minutes=i)) for i in range(200)]
    left += [(1100, "c", start), (1101, None, start), (1102, "d", None)]
    right = [("a", start + dt.timedelta(minutes=150), 1.0), ("b", start + dt.timedelta(minutes=500), 2.0), ("c", start, 3.0), ("d", start, 4.0)]
    df = spark.createDataFrame(left, "i int, k string, at timestamp_ntz").repartition(5)
    for fallback in (True, False):
        got = asof_merge(df, spark.createDataFrame(right, "k string, at_right timestamp_ntz, v double"),
                         ["k"], "at", "at_right", ["v"], fallback=fallback, ranges=12)
        assert rows(got) == expected(left, right, fallback)


def test_merge_of_nothing(spark):
    df = spark.createDataFrame([], "i int, k string, at timestamp_ntz")
    points = spark.createDataFrame([], "k string, at_right timestamp_ntz, v double")
    assert asof_merge(df, points, ["k"], "at", "at_right", ["v"]).count() == 0
    one = spark.createDataFrame([(1, "a", dt.datetime(2026, 1, 1))], df.schema)
    assert rows(asof_merge(one, points, ["k"], "at", "at_right", ["v"])) == [(1, None, None, None)]
