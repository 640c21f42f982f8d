"""What keeps the work of checks and loads in proportion to their rows."""

from pyspark.sql import functions as F

from catalog.inputs import raw, raw_dealt
from tallyline import functions as fn
from tallyline.operators import rules as r
from tallyline.operators.dedup import latest_first
from tallyline.operators.skew import heavy_keys
from tallyline.operators.upsert import last_file_rows
from tallyline.sources import arrival, merge
from tallyline.sources.store import SnapshotStore, bucket_of


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_profiled_without_sorting_their_lines(spark, tmp_path):
    (tmp_path / "paid_1.csv").write_text('id,amount\n1,"a\nb"\n')
    profiles = arrival.file_profiles(spark, str(tmp_path), "paid_*.csv")
    assert "Sort" not in final_plan(profiles)
    assert [(x.header, x.n_split > 0, x.row_count) for x in profiles.collect()] == [(["id", "amount"], True, 2)]


def test_records_over_lines_are_counted_in_runs_without_shuffling_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrival, "CHUNK", 3, raising=False)  # records begin in one run and end in another
    text = "id,amount\n" + "".join(f'{i},"one\n\ntwo ""x""\n{i}"\n' if i % 3 else f"{i},plain\n\n" for i in range(50))
    (tmp_path / "paid_1.csv").write_text(text)
    files = arrival.list_files(spark, str(tmp_path), "paid_*.csv")
    counts = arrival.spanning_counts(spark, str(tmp_path), "paid_*.csv", files)
    exchanges = [line for line in final_plan(counts).splitlines() if "Exchange" in line]
    assert exchanges and not any("position" in line for line in exchanges)
    assert [x.n for x in counts.collect()] == [50]


def test_quotes_of_broken_utf8_are_counted(spark):
    lines = spark.range(1).select(F.unhex(F.lit("E9222C22")).cast("string").alias("v"))
    assert lines.select(arrival._quotes(F.col("v"))).first()[0] == 2


def test_rows_of_files_that_share_no_key_are_loaded_without_a_join(spark):
    schema = "id string, v string, file string"
    apart = spark.createDataFrame([("a", "x", "f1"), ("a", "y", "f1"), ("b", "x", "f2"), (None, "x", "f2"), (None, "x", "f2")], schema)
    rows = last_file_rows(apart, ["id"], "file", ("file",))
    assert "Join" not in final_plan(rows) and sorted(map(str, rows.collect())) == sorted(map(str, apart.collect()))
    shared = apart.unionAll(spark.createDataFrame([("a", "z", "f2"), (None, "x", "f3")], schema))
    assert sorted((r.id or "", r.v, r.file) for r in last_file_rows(shared, ["id"], "file", ("file",)).collect()) == [
        ("", "x", "f3"), ("a", "z", "f2"), ("b", "x", "f2")]


def test_heavy_keys_are_counted_exactly_among_many_light_ones(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 40 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("one"))
    by_k, by_one = heavy_keys(rows, ["k"], ["one"], share=0.5, min_rows=1_000)
    assert list(by_k.rows.values()) == [1_000] and list(by_one.rows.values()) == [40_000]


def test_passed_rows_are_found_without_an_extra_sort_or_a_list_of_reasons(spark, frame):
    rows = frame([("a", 1, 5.0), ("a", 2, -1.0), ("b", 1, 2.0), (None, 1, 1.0)], "id string, day int, amount double")
    checked = r.validate(rows, r.RecordChecks(
        key=("id",), duplicate_reason="duplicate", order_by=tuple(latest_first("day")),
        rules=(r.required("id", "missing id"), r.positive("amount", "not positive"))))
    ok = r.passed(checked, ["id", "day"])
    assert "WindowGroupLimit" not in final_plan(ok) and "lambda" not in final_plan(ok)
    assert [tuple(x) for x in ok.collect()] == [("b", 1)]
    assert sorted((x.id or "", x.day, x.all_reasons) for x in checked.collect()) == [
        ("", 1, ["missing id"]), ("a", 1, ["duplicate"]), ("a", 2, ["not positive"]), ("b", 1, [])]


LOADED = "id string, v string, file string"


def load(spark, store, *rows):
    table = merge.merge_load(store, "t", spark.createDataFrame(rows, LOADED), ["id"], ignore=("file",), file="file", buckets=4)
    return sorted((x.id or "", x.v, x.file) for x in table.collect())


def test_the_same_load_again_leaves_stored_rows_unread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "without_matches", lambda *_: 1 / 0)
    store = SnapshotStore(spark, str(tmp_path))
    rows = [(f"k{i}", "x", f"f{i % 3}") for i in range(50)] + [("k7", "x", "f1"), (None, "bad", "f1"), (None, "bad", "f1")]
    want = sorted((i or "", v, f) for i, v, f in rows)
    assert load(spark, store, *rows) == load(spark, store, *rows) == want
    assert len({p.rsplit("/", 2)[1] for p in store.current("t").paths}) == 1, "the first load's folders are left out"


def test_only_buckets_with_a_key_of_several_files_are_written_again(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(merge, "last_file_rows", lambda rows, *more, **options: asked.append(rows) or last_file_rows(rows, *more, **options))
    store = SnapshotStore(spark, str(tmp_path))
    apart = [(f"k{i}", "x", f"f{i % 3}") for i in range(50)]
    load(spark, store, *apart)
    assert not asked
    got = load(spark, store, *apart, ("k7", "y", "f9"), ("k7", "z", "f9"))
    assert got == sorted([*(x for x in apart if x[0] != "k7"), ("k7", "y", "f9"), ("k7", "z", "f9")])
    (rows,) = asked
    assert len({bucket_of(f.rsplit("/", 1)[0]) for f in rows.inputFiles()}) == 1
    # a row without a key is known by its content, in whichever file it stands
    assert load(spark, store, (None, "bad", "f1"), (None, "bad", "f2"), (None, "bad", "f2"))[:3] == [
        ("", "bad", "f2"), ("", "bad", "f2"), ("k0", "x", "f0")]


def test_rows_that_stay_are_shuffled_once(spark, tmp_path, monkeypatch):
    written, stage = [], SnapshotStore.stage_buckets
    monkeypatch.setattr(SnapshotStore, "stage_buckets", lambda self, df, table, buckets, *more: (
        written.append((df, *more)), stage(self, df, table, buckets, *more))[1])
    store = SnapshotStore(spark, str(tmp_path))
    rows = [(f"k{i}", "x", "f1") for i in range(40)]
    load(spark, store, *rows)
    assert load(spark, store, *((i, "y", "f2") for i, _, _ in rows[:10])) == sorted(
        [(i, "y", "f2") for i, _, _ in rows[:10]] + rows[10:])
    assert [bool(more and more[0]) for _, *more in written] == [False, False, True], "two loads, and what stays of the first"


def test_an_extract_is_dealt_by_key_before_it_is_rendered(spark, tmp_path):
    lines = [(i % 40, 499 if i % 9 == 0 else 1 + i % 300, i % 60, i % 3, 10.0 + i, f"1996-01-{1 + i % 28:02d} 00:00:00") for i in range(300)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, day string").select(
        "*", F.col("day").cast("timestamp").alias("l_shipdate")).write.parquet(str(tmp_path / "lineitem.parquet"))
    dealt = raw_dealt(spark, str(tmp_path))
    shown = sorted(map(str, dealt.collect()))
    assert shown == sorted(map(str, raw(spark, str(tmp_path), "cbs_repayments").collect())) and len(shown) == 300
    tasks = dealt.withColumn("task", F.spark_partition_id()).groupBy("txn_id").agg(F.countDistinct("task").alias("n"))
    assert {x.n for x in tasks.collect()} == {1}
    exchanges = [line for line in final_plan(dealt).splitlines() if "REPARTITION_BY_COL" in line]
    assert exchanges and all("l_orderkey" in line for line in exchanges), "dealt by what the given rows hold"


def test_any_separator_is_trimmed_from_text_of_single_and_of_more_bytes(evaluate):
    values = ["a", " a b ", "\ta ", "\u00a0a\u2003", "é ", " \u202f", "", "  ", None, "\u3000x y\u00a0 "]
    assert evaluate(fn.trim_spaces("x"), values) == ["a", "a b", "\ta", "a", "é", "", "", "", None, "x y"]


def test_numbers_are_recognised_in_any_case(evaluate):
    values = ["NaN", "-iNf", "+Infinity", "infinit", "1E5", "1.e-2", ".5", "1d", "nan1", " 7\t"]
    got = evaluate(fn.parse_number("x"), values)
    assert [str(g) for g in got] == ["nan", "-inf", "inf", "None", "100000.0", "0.01", "0.5", "None", "None", "7.0"]
