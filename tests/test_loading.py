import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyline.operators import checks as c
from tallyline.operators import history as h
from tallyline.operators import reconcile as rec
from tallyline.operators.dedup import latest_first
from tallyline.operators.privacy import column_classes, drop_classes, guard_classified, tag_columns
from tallyline.operators.upsert import upsert_by_key
from tallyline.sources.contracts import Contract, union_versions
from tallyline.sources.merge import merge_load
from tallyline.sources.publish import publish_if
from tallyline.sources.store import BUCKET, SnapshotStore, bucket_of, scratch_root


def test_reconcile_keeps_null_keys_apart_and_judges_by_tolerance(spark):
    control = spark.createDataFrame(
        [("KE", "01", 1000, 5000.0), ("KE", "02", 10, 10.0), (None, "03", 7, 7.0), ("TD", "04", 400, 0.0)],
        "c string, m string, n long, amount double")
    loans = spark.createDataFrame(
        [("KE", "01", 1005), ("KE", "02", 12), (None, "03", 7), ("SS", "05", 1), ("RW", "06", 2)],
        "c string, m string, n long")
    paid = spark.createDataFrame(
        [("KE", "01", 5026.0), ("SS", "05", 0.5), ("TD", "04", 1.0)], "c string, m string, amount double")
    got = rec.reconcile(control, [loans, paid], ["c", "m"], ["n", "amount"])
    rows = {(r.c, r.m, r.control_n): r for r in got.collect()}
    assert len(rows) == got.count() == 7
    assert rows["KE", "01", 1000].n_pass and not rows["KE", "01", 1000].amount_pass
    assert not rows["KE", "02", 10].n_pass
    assert rows[None, "03", 7].computed_n is None and rows[None, "03", None].computed_n == 7
    # only computed: the floor of one unit still applies, and both computed sides met on the key
    only = rows["SS", "05", None]
    assert only.n_pass and only.amount_pass and (only.computed_n, only.computed_amount) == (1, 0.5)
    assert not rows["RW", "06", None].n_pass and rows["TD", "04", 400].amount_pass
    bad = {(r.c, r.m) for r in rec.failing(got, ["n", "amount"]).collect()}
    assert bad == {("KE", "01"), ("KE", "02"), (None, "03"), ("RW", "06"), ("TD", "04")}


LOAD = "id string, day int, v string"


def test_upsert_replaces_adds_and_repeats_without_effect(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), (None, 1, "bad")], LOAD)
    new = spark.createDataFrame(
        [("b", 2, "y"), ("b", 1, "z"), ("c", 1, "n"), (None, 1, "bad"), (None, 2, "worse")], LOAD)
    want = sorted([("a", 1, "x"), ("b", 2, "y"), ("c", 1, "n"), ("", 1, "bad"), ("", 2, "worse")])

    def rows(df):
        return sorted((r.id or "", r.day, r.v) for r in df.collect())

    for options in ({}, {"min_rows": 1}):
        once = upsert_by_key(old, new, ["id"], latest_first("day"), **options)
        assert rows(once) == want
        assert rows(upsert_by_key(once, new, ["id"], latest_first("day"), **options)) == want


def test_rows_repeated_in_a_file_stay_and_loading_it_again_changes_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    files = spark.createDataFrame(
        [("a", 1, "x", "f1"), ("a", 2, "y", "f1"), ("b", 1, "x", "f1"), ("b", 1, "z", "f2"), ("b", 1, "z", "f2"),
         (None, 1, "bad", "f1"), (None, 1, "bad", "f1")], LOAD + ", file string")
    want = sorted([("", 1, "bad"), ("", 1, "bad"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("b", 1, "z")])
    for _ in range(2):
        table = merge_load(store, "t", files, ["id"], ignore=("file",), file="file")
        assert sorted((r.id or "", r.day, r.v) for r in table.collect()) == want
    late = spark.createDataFrame([("a", 9, "new", "f3")], LOAD + ", file string")
    table = merge_load(store, "t", late, ["id"], ignore=("file",), file="file")
    assert [(r.day, r.v) for r in table.filter("id = 'a'").collect()] == [(9, "new")]


def test_ordered_merge_keeps_the_newer_stored_row(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    for rows in ([("a", 5, "new"), ("b", 1, "old")], [("a", 1, "late"), ("b", 2, "new"), ("c", 1, "n")]):
        table = merge_load(store, "t", spark.createDataFrame(rows, LOAD), ["id"], latest_first("day"), ordered=True)
    assert sorted(map(tuple, table.collect())) == [("a", 5, "new"), ("b", 2, "new"), ("c", 1, "n")]


def _sorted(df):
    return sorted((r.id or "", r.day, r.v) for r in df.collect())


def test_a_correction_reads_and_rewrites_one_bucket(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    rows = [(f"k{i}", 1, "x") for i in range(400)] + [(None, i, "bad") for i in range(40)]
    merge_load(store, "t", spark.createDataFrame(rows, LOAD), ["id"], buckets=16)
    before = store.current("t")
    assert before.buckets == 16 and sorted({bucket_of(p) for p in before.paths}) == list(range(16))
    merge_load(store, "t", spark.createDataFrame([("k7", 2, "corrected")], LOAD), ["id"])
    after = store.current("t")
    gone, new = set(before.paths) - set(after.paths), set(after.paths) - set(before.paths)
    (bucket,) = {bucket_of(p) for p in gone | new}  # the folder without the old row, and the one with the new
    assert len(gone) == 1 and len(new) == 2
    want = sorted([(i or "", 2, "corrected") if i == "k7" else (i or "", d, v) for i, d, v in rows])
    assert _sorted(store.read("t")) == want
    read = store.open(after.of_buckets({bucket}))
    assert all(f"{BUCKET}={bucket}/" in file for file in read.inputFiles()) and read.filter("id = 'k7'").count() == 1
    # the same again changes nothing
    merge_load(store, "t", spark.createDataFrame([("k7", 2, "corrected"), (None, 3, "bad")], LOAD), ["id"])
    assert _sorted(store.read("t")) == want


def test_new_keys_rewrite_nothing_until_a_bucket_has_many_folders(spark, tmp_path, monkeypatch):
    from tallyline.sources import merge

    monkeypatch.setattr(merge, "MOST_FOLDERS", 3)
    store = SnapshotStore(spark, str(tmp_path))
    sizes = []
    for night in range(5):
        seen = set(store.current("t").paths) if night else set()
        merge_load(store, "t", spark.createDataFrame([(f"{night}-{i}", night, "x") for i in range(20)], LOAD), ["id"], buckets=2)
        sizes.append((len(seen - set(store.current("t").paths)), len(store.current("t").paths)))
    assert sizes == [(0, 2), (0, 4), (0, 6), (6, 4), (0, 6)]
    assert store.read("t").count() == 100


def test_keys_match_whatever_type_they_arrive_in(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    merge_load(store, "t", spark.createDataFrame([(1, "a"), (2, "a")], "id long, v string"), ["id"])
    merge_load(store, "t", spark.createDataFrame([(2, "b"), (3, "b")], "id int, v string").select("id", "v"), ["id"])
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a"), (2, "b"), (3, "b")]


def test_a_load_with_a_column_more(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    merge_load(store, "t", spark.createDataFrame([("a", 1, "x"), (None, 1, "bad")], LOAD), ["id"])
    merge_load(store, "t", spark.createDataFrame([("d", 3, "x", "AG"), ("a", 2, "y", "AH")], f"{LOAD}, agent string"), ["id"])
    got = {r.id: (r.v, r.agent) for r in store.read("t").collect()}
    assert got == {"a": ("y", "AH"), "d": ("x", "AG"), None: ("bad", None)}
    merge_load(store, "t", spark.createDataFrame([], LOAD), ["id"])
    assert store.read("t").count() == 3


def test_logs_are_read_by_night(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    schema = "source string, status string, reason string, row_count long, night date"
    assert store.read_log("log", schema).count() == 0
    for day, rows in ((1, [("a", "PASS", "", 5), ("a", "PASS", "", 6)]), (2, [("a", "PASS", "", 5), ("a", "FAIL", "late", 1)]), (3, [("a", "FAIL", "gone", None)])):
        night = spark.createDataFrame(rows, "source string, status string, reason string, row_count long").withColumn(
            "night", F.lit(dt.date(2026, 1, day)))
        store.append_log(night, "log", ["night"])
    log = store.read_log("log", schema)
    got = sorted(tuple(r) for r in h.arrival_history(log).collect())
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    assert got == [(days[0], "a", "PASS", "", 11, days[0], 0), (days[1], "a", "FAIL", "late", 6, days[0], 1),
                   (days[2], "a", "FAIL", "gone", None, days[0], 2)]
    last = log.filter("night = date '2026-01-03'")
    assert len(last._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [isnotnull(night")) == 2 and last.count() == 1


def test_store_swaps_whole_versions_and_keeps_partition_types(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.read("t") is None
    first = spark.createDataFrame([(1, True), (2, False)], "id int, flag boolean")
    back = store.replace(first, "t", ["flag"])
    assert dict(back.dtypes) == {"id": "int", "flag": "boolean"} and back.filter("flag").count() == 1
    staged = store.stage(first.limit(0), "t")
    assert store.read("t").count() == 2, "a staged version is not visible"
    store.commit({"t": staged, "u": store.stage(first, "u")})
    assert store.read("t").count() == 0 and store.read("u").count() == 2
    # a table may be rewritten from its own rows
    store.replace(store.read("u").union(store.read("u")), "u")
    assert store.read("u").count() == 4


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_gate_publishes_all_or_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    good = c.run_checks({"empty": df.filter("k > 5"), "fine": df.filter("false")})
    bad = c.run_checks({"fine": df.filter("false"), "unique": c.check_unique(df, "k"),
                        "given": c.check_not_null(df, "k")})
    assert not publish_if(bad, {"mart": df}, store, dt.datetime(2026, 1, 1))
    assert store.read("mart") is None
    assert publish_if(good, {"mart": df, "report": df}, store, dt.datetime(2026, 1, 2))
    assert not publish_if(bad, {"mart": df.limit(1), "report": df}, store, dt.datetime(2026, 1, 3))
    assert store.read("mart").count() == 3 and "_published_at" in store.read("mart").columns
    log = store.read_log("publish_log", "run_at timestamp, status string, reason string")
    assert [(r.status, r.reason) for r in log.orderBy("run_at").collect()] == [
        ("BLOCKED", "failed checks: given, unique"), ("PUBLISHED", "all checks passed"),
        ("BLOCKED", "failed checks: given, unique")]


def test_assertions_on_good_and_bad_tables(spark):
    parent = spark.createDataFrame([("p",)], "id string")
    child = spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "pid string")
    assert [tuple(r) for r in c.check_relationship(child, "pid", parent, "id").collect()] == [("q", 2)]
    assert [tuple(r) for r in c.check_accepted_values(child, "pid", ["p"]).collect()] == [("q", 2)]
    assert [tuple(r) for r in c.check_unique(child, "pid").collect()] == [("q", 2)]
    assert c.check_not_null(child, "pid").count() == 1
    counted = c.column_checks(child, "t", ["pid"], {"pid": ["p"]})
    assert sorted(tuple(r) for r in c.run_checks({}, [counted]).collect()) == [
        ("accepted_values_pid", 2, False), ("not_null_t_pid", 1, False)]
    expected = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3")], "source_system string, source_id string")
    links = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("b", "9")],
                                  "source_system string, source_id string")
    got = sorted(tuple(r) for r in c.check_crosswalk(expected, links).collect())
    assert got == [("a", "2", 2), ("a", "3", 0)]
    totals = spark.createDataFrame([("s", 3, 2, 1), ("t", 3, 2, 2)],
                                   "source_name string, raw_count long, passed_count long, quarantined_count long")
    assert [r.source_name for r in c.check_rows_accounted(totals).collect()] == ["t"]


def test_classes_survive_projection_and_are_guarded(spark):
    classes = {"a": "internal", "secret": "excluded"}
    df = tag_columns(spark.createDataFrame([(1, 2, 3)], "a int, secret int, b int"), classes)
    renamed = df.select("a", F.col("secret").alias("s"))
    assert column_classes(renamed) == {"a": "internal", "s": "excluded"}
    assert drop_classes(df, classes).columns == ["a", "b"]
    found = guard_classified({"raw": {"t": df}, "marts": {"m": renamed, "ok": drop_classes(df, classes)}}, classes)
    assert sorted(tuple(r) for r in found.collect()) == [("marts", "m", "s"), ("raw", "t", "secret")]


def test_versions_load_together(spark):
    v1 = Contract("s", "*", ("id", "amount"))
    v2 = Contract("s", "*", ("id", "paid", "agent"), version=2, renames={"paid": "amount"}, optional=("agent",))
    one = spark.createDataFrame([("1", "5")], "id string, amount string")
    two = spark.createDataFrame([("2", "6", "AG")], "id string, paid string, agent string")
    got = union_versions([(v1, one), (v2, two)])
    assert sorted((r.id, r.amount, r.agent or "") for r in got.collect()) == [("1", "5", ""), ("2", "6", "AG")]
    assert "agent" in union_versions([(v1, one), (v2, two.limit(0))]).columns
    with pytest.raises(ValueError):
        union_versions([(v1, one), (Contract("s", "*", ("id",)), one.drop("amount"))])


def test_monitoring(spark):
    runs = spark.createDataFrame(
        [("k", d, ok, float(diff)) for d, (ok, diff) in enumerate(
            [(True, 0), (False, 5), (False, -4), (False, 9), (True, 1), (False, 3)])],
        "key string, run int, ok boolean, diff double")
    drift = {r.run: r.drift for r in h.recon_drift(runs, ["key"], "run", "ok", "diff").collect()}
    assert drift == {1: "newly failing", 3: "failing by more", 5: "newly failing"}
    counts = spark.createDataFrame([("s", d, n) for d, n in enumerate([2, 2, 9, 4, 3])], "s string, run int, n long")
    assert [r.run for r in h.quarantine_spike(counts, "s", "run", "n", window=2).collect()] == [2]
    assert [(r.run, r.growth) for r in h.queue_growth(counts, "s", "run", "n").collect()] == [(2, 7)]
    days = spark.createDataFrame(
        [(dt.date(2026, 1, 1), True), (dt.date(2026, 1, 1), False), (dt.date(2026, 1, 30), True),
         (dt.date(2026, 1, 31), True)], "day date, done boolean")
    got = {str(r.run_day): (r.run_count, r.completed_count, r.completion_rate)
           for r in h.run_reliability(days, "day", "done").collect()}
    assert got == {"2026-01-01": (2, 1, 0.5), "2026-01-30": (3, 2, 2 / 3), "2026-01-31": (2, 2, 1.0)}
