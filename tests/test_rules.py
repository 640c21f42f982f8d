from itertools import product

from pyspark.sql import functions as F

from tallyline.operators import rules as r
from tallyline.operators.dedup import flag_duplicates, keep_latest, latest_first
from tallyline.operators.skew import HeavyKeys, heavy_keys, lookup_join


def fired(frame, rule, rows, schema):
    df = frame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [x["why"] for x in df.select("i", rule.alias("why")).orderBy("i").collect()]


def test_each_rule_kind_on_a_good_a_bad_and_a_null_value(frame):
    text, num = "x string", "x double"
    assert fired(frame, r.required("x", "m"), [("a",), ("",), (None,)], text) == [None, "m", "m"]
    assert fired(frame, r.not_null("x", "m"), [("",), (None,)], text) == [None, "m"]
    assert fired(frame, r.any_of_required(["x", "y"], "m"),
                 [("a", None), (None, "b"), (None, None)], "x string, y string") == [None, None, "m"]
    assert fired(frame, r.parseable_if_present("x", "y", "bad: "),
                 [("q", None), ("q", 1), ("", None), (None, None)], "x string, y int") == [
        "bad: q", None, None, None]
    assert fired(frame, r.in_lookup("x", "y", "no: ", blank_ok=False),
                 [("", None), ("a", "b"), (None, None)], "x string, y string") == ["no: ", None, None]
    assert fired(frame, r.allowed_values("x", ["a"], "no: "), [("a",), ("b",), (None,)], text) == [
        None, "no: b", None]
    assert fired(frame, r.matches_regex("x", "^[0-9]+$", "no: "), [("1",), ("b",), (None,)], text) == [
        None, "no: b", None]
    assert fired(frame, r.positive("x", "p"), [(1.0,), (0.0,), (None,)], num) == [None, "p", None]
    assert fired(frame, r.missing_or_not_positive("x", "p"), [(1.0,), (0.0,), (None,)], num) == [
        None, "p", "p"]
    assert fired(frame, r.non_negative("x", "p"), [(0.0,), (-1.0,), (None,)], num) == [None, "p", "p"]
    assert fired(frame, r.non_zero("x", "z"), [(1.0,), (0.0,), (None,)], num) == [None, "z", None]
    assert fired(frame, r.conditional_required(F.col("x") < 0, "y", "c"),
                 [(-1.0, None), (-1.0, "r"), (1.0, None), (None, None)], "x double, y string") == [
        "c", None, None, None]


def checks(**more):
    return r.RecordChecks(
        key=("id",), duplicate_reason="duplicate",
        rules=(r.required("id", "missing id"), r.positive("amount", "not positive")),
        order_by=tuple(latest_first("day")), **more)


ROWS = [("a", 1, 5.0), ("a", 2, -1.0), ("b", 1, 2.0), ("b", 1, 2.0), ("c", None, 3.0), ("c", 1, 4.0),
        (None, 1, 1.0), (None, 2, 1.0), ("", 1, 0.0)]


def test_reasons_accumulate_and_the_newest_row_survives_even_if_invalid(frame):
    checked = r.validate(frame(ROWS, "id string, day int, amount double"), checks())
    got = sorted((x["id"] or "-", x["day"] or 0, x["is_quarantined"], tuple(x["all_reasons"]))
                 for x in checked.collect())
    assert got == sorted([
        ("a", 1, True, ("duplicate",)), ("a", 2, True, ("not positive",)),
        ("b", 1, False, ()), ("b", 1, True, ("duplicate",)),
        ("c", 0, True, ("duplicate",)), ("c", 1, False, ()),
        ("-", 1, True, ("missing id", "duplicate")), ("-", 2, True, ("missing id",)),
        ("-", 1, True, ("missing id", "not positive")),
    ])


def test_split_is_whole_and_counted_while_it_is_written(spark, frame, tmp_path):
    checked = r.validate(frame(ROWS, "id string, day int, amount double"), checks())
    rows, counts = r.observed(checked)
    rows.write.parquet(str(tmp_path / "checked"))
    summary = r.dq_summary(spark, {"s": counts}).first()
    assert r.dq_summary(spark, {"s": counts}, {"s": 12}).first().raw_count == 12
    assert (summary.raw_count, summary.passed_count, summary.quarantined_count) == (9, 2, 7)
    assert r.passed(checked).count() + r.quarantine(checked, ["id"]).count() == len(ROWS)
    reasons = {x["reason"]: x["row_count"] for x in r.reason_counts(checked).collect()}
    assert reasons == {"duplicate": 4, "missing id": 3, "not positive": 2}


def test_references_fail_on_unknown_parents_only(frame):
    child = frame([("1", 1, 1.0, "p"), ("2", 1, 1.0, "q"), ("3", 1, 1.0, None)],
                  "id string, day int, amount double, parent string")
    parent = frame([("p",)], "key string")
    spec = r.RecordChecks(
        key=("id",), duplicate_reason="duplicate",
        references=(r.References("parent", parent, "key", "parent_found"),),
        rules=(r.found_in_parent("parent", "parent_found", "no parent: "),))
    for options in ({}, {"min_rows": 1}):
        got = {x["id"]: x["all_reasons"] for x in r.validate(child, spec, **options).collect()}
        assert got == {"1": [], "2": ["no parent: q"], "3": []}


def hot_rows(spark):
    """Keys 0..199 with one row each; key -1 with 4,000 different rows; null with 3,000 copies."""
    return spark.range(7_200).select(
        F.when(F.col("id") < 200, F.col("id")).when(F.col("id") < 4_200, F.lit(-1)).alias("k"),
        F.when(F.col("id") < 4_200, F.col("id") % 50).otherwise(3).alias("day"),
        F.when(F.col("id") < 4_200, F.col("id")).otherwise(7).alias("payload"))


def test_heavy_keys_finds_all_heavy_keys_and_no_others(spark):
    (heavy,) = heavy_keys(hot_rows(spark), ["k"], min_rows=100)
    hashes = [x["h"] for x in hot_rows(spark).filter("k = -1 or k is null")
              .select(F.xxhash64("k").alias("h")).distinct().collect()]
    assert set(heavy.rows) == set(hashes) and heavy.largest == 4_000
    assert not heavy_keys(hot_rows(spark), ["k"])[0]


def test_sliced_ranking_equals_plain_ranking(spark):
    df = hot_rows(spark)
    (heavy,) = heavy_keys(df, ["k"], min_rows=100)
    plain = flag_duplicates(df, ["k"], latest_first("day"))
    sliced = flag_duplicates(df, ["k"], latest_first("day"), heavy)
    assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()
    kept = keep_latest(df, ["k"], latest_first("day"), heavy)
    assert kept.count() == 202
    assert kept.exceptAll(keep_latest(df, ["k"], latest_first("day"))).isEmpty()


def test_lookup_join_routes_heavy_rows_without_changing_the_result(spark):
    df = hot_rows(spark)
    side = spark.createDataFrame([(-1, "hot"), (5, "five"), (9_999, "none")], "k long, name string")
    (heavy,) = heavy_keys(df, ["k"], min_rows=100)
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = lookup_join(df, side, ["k"], how=how)
        routed = lookup_join(df, side, ["k"], heavy, how)
        assert plain.exceptAll(routed).isEmpty() and routed.exceptAll(plain).isEmpty(), how


def test_empty_heavy_keys_leave_the_plan_alone():
    assert not HeavyKeys(("k",))


def test_ties_split_the_same_way_however_the_rows_arrive(spark):
    rows = [(k, "same", v) for k, v in product("ab", range(20))]
    def survivors(data):
        df = spark.createDataFrame(data, "k string, day string, v int").repartition(7)
        return sorted(map(tuple, keep_latest(df, ["k"], latest_first("day")).collect()))
    assert survivors(rows) == survivors(rows[::-1]) == [("a", "same", 0), ("b", "same", 0)]
