import pytest

from tallyline.operators.privacy import column_classes
from tallyline.sources import arrival
from tallyline.sources.arrival import LOG_SCHEMA, arrival_check
from tallyline.sources.contracts import Contract

PEOPLE = Contract("people", "people.csv", ("id", "name", "print"), ("id",))
PAID = Contract("paid", "paid_*.csv", ("id", "amount"), ("id",))
CLASSES = {"people.csv": {"id": "internal", "name": "personal", "print": "excluded"},
           "paid_*.csv": {"id": "internal", "amount": "internal"}}


@pytest.fixture
def check(spark, tmp_path):
    def run(files, contracts, classes=CLASSES):
        for name, text in files.items():
            (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
        log, accepted = arrival_check(spark, str(tmp_path), contracts, classes)
        return {r.file: r for r in log.collect()}, accepted
    return run


def test_good_file_loses_its_excluded_column_and_keeps_quotes_and_line_breaks(check):
    text = '\ufeffid,print,name\n1,p,"O""Neil, Ann"\n2,q,"two\nlines"\n3,r,\n'
    log, accepted = check({"people.csv": text}, [PEOPLE])
    row = log["people.csv"]
    assert (row.status, row.row_count, row.columns_dropped_excluded, row.reason) == ("PASS", 3, 1, "")
    rows = accepted["people"]
    assert rows.columns == ["id", "name", "_source_file", "_loaded_at"]
    assert [(r.id, r.name, r._source_file) for r in rows.orderBy("id").collect()] == [
        ("1", 'O"Neil, Ann', "people.csv"), ("2", "two\nlines", "people.csv"), ("3", None, "people.csv")]


def test_files_of_one_source_are_judged_and_read_by_their_own_header(check):
    files = {
        "paid_1.csv": "id,amount\n1,10\n2,20\n",
        "paid_2.csv": "amount,id\n30,3\n",                      # other order: same contract
        "paid_3.csv": "id,amount_paid,agent\n4,40,x\n",         # renamed and extra
        "paid_4.csv": "id\n5\n6\n",                             # missing
        "paid_5.csv": "id,amount,amount\n7,1,2\n",              # repeated
        "paid_6.csv": "",                                       # empty
        "paid_7.csv": b"id,amount\n8,\xff\xfe\n",               # not UTF-8
        "paid_8.csv": '"id" , amount \n9,90\n',                  # padded and quoted names
        "paid_9.csv": "id,amount\n",                            # header only
    }
    log, accepted = check(files, [PAID])
    status = {f: (r.status, r.row_count) for f, r in log.items()}
    assert status == {
        "paid_1.csv": ("PASS", 2), "paid_2.csv": ("PASS", 1), "paid_3.csv": ("FAIL", 1),
        "paid_4.csv": ("FAIL", 2), "paid_5.csv": ("FAIL", 1), "paid_6.csv": ("FAIL", None),
        "paid_7.csv": ("FAIL", None), "paid_8.csv": ("PASS", 1), "paid_9.csv": ("PASS", 0)}
    assert log["paid_3.csv"].reason == (
        "header does not match contract v1: missing columns ['amount']; "
        "unexpected columns ['amount_paid', 'agent']")
    assert "missing columns ['amount']" in log["paid_4.csv"].reason
    assert log["paid_5.csv"].reason == "header repeats a column name"
    assert log["paid_6.csv"].reason == "could not read file: it is empty"
    assert log["paid_7.csv"].reason == "could not read file: invalid UTF-8"
    assert sorted((r.id, r.amount) for r in accepted["paid"].collect()) == [
        ("1", "10"), ("2", "20"), ("3", "30"), ("9", "90")]


def test_unclassified_columns_missing_files_and_missing_classification(check):
    log, accepted = check(
        {"people.csv": "id,name,print\n1,a,b\n"}, [PEOPLE, PAID],
        {"people.csv": {"id": "internal", "name": "personal"}})
    assert log["people.csv"].reason == "columns not classified: ['print']"
    assert log["people.csv"].row_count == 1
    assert log["paid_*.csv"].reason == "no file found matching this source's pattern"
    assert accepted == {}
    log, _ = check({"paid_1.csv": "id,amount\n"}, [PAID], {})
    assert log["paid_1.csv"].reason == "no classification entry found for 'paid_*.csv'"


def test_missing_folder_is_a_logged_failure(spark, tmp_path):
    log, accepted = arrival_check(spark, str(tmp_path / "nowhere"), [PAID], CLASSES)
    assert [r.status for r in log.collect()] == ["FAIL"] and accepted == {}


def test_log_has_its_declared_schema(spark, tmp_path):
    (tmp_path / "paid_1.csv").write_text("id,amount\n1,2\n")
    log, _ = arrival_check(spark, str(tmp_path), [PAID, PEOPLE], CLASSES)
    log.write.parquet(str(tmp_path / "log"))
    assert spark.read.schema(LOG_SCHEMA).parquet(str(tmp_path / "log")).count() == 2


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    for folder, rows in (("north", "1,10\n2,20\n"), ("south side+", "3,30\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "paid 1.csv").write_text("id,amount\n" + rows)
        (tmp_path / folder / "paid 2.csv").write_text("")
    paid = Contract("paid", "*/paid*.csv", ("id", "amount"), ("id",))
    log, accepted = arrival_check(spark, str(tmp_path), [paid], {"*/paid*.csv": CLASSES["paid_*.csv"]})
    assert sorted((r.file, r.status, r.row_count) for r in log.collect()) == [
        ("north/paid 1.csv", "PASS", 2), ("north/paid 2.csv", "FAIL", None),
        ("south side+/paid 1.csv", "PASS", 1), ("south side+/paid 2.csv", "FAIL", None)]
    assert sorted((r.id, r._source_file) for r in accepted["paid"].collect()) == [
        ("1", "north/paid 1.csv"), ("2", "north/paid 1.csv"), ("3", "south side+/paid 1.csv")]


@pytest.mark.parametrize("listed", [0, 10_000])
def test_records_over_lines_are_counted_in_split_files(spark, tmp_path, monkeypatch, listed):
    """Blocks of 200 bytes: records begin in one block and end in another; some hold blank lines."""
    monkeypatch.setattr(arrival, "LISTED", listed)  # with 0 the folder is read and other files are left out
    records = [f'{i},"line one\n\nline ""two"", {"x" * (i % 40)}\nend"\n' if i % 3 else f"{i},plain\n" for i in range(200)]
    (tmp_path / "paid_1.csv").write_text("id,amount\n" + "".join(records) + "\n\n")
    (tmp_path / "paid_2.csv").write_text("id,amount\n7,8\n")
    (tmp_path / "paid_3.csv").write_text("id,wrong\n7,8\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        log, accepted = arrival_check(spark, str(tmp_path), [PAID], CLASSES)
        assert {r.file: (r.status, r.row_count) for r in log.collect()} == {
            "paid_1.csv": ("PASS", 200), "paid_2.csv": ("PASS", 1), "paid_3.csv": ("FAIL", 1)}
        assert accepted["paid"].count() == 201
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_each_file_answers_to_the_version_it_comes_closest_to(check):
    v2 = Contract("paid", "paid_*.csv", ("id", "amount_paid", "agent"), ("id",), version=2,
                  renames={"amount_paid": "amount"}, optional=("agent",))
    classes = {"paid_*.csv": {**CLASSES["paid_*.csv"], "amount_paid": "personal", "agent": "internal"}}
    log, accepted = check({
        "paid_1.csv": "id,amount\n1,10\n", "paid_2.csv": "agent,id,amount_paid\nx,2,20\n", "paid_3.csv": "id,amount_paid\n3,30\n",
        "paid_4.csv": "", "paid_5.csv": "id,agent,amount_paid,more\n5,x,50,y\n"}, [PAID, v2], classes)
    got = {f: (r.contract_version, r.status, r.reason) for f, r in log.items()}
    assert got == {
        "paid_1.csv": (1, "PASS", ""), "paid_2.csv": (2, "PASS", ""),
        "paid_3.csv": (2, "FAIL", "header does not match contract v2: missing columns ['agent']"),
        "paid_4.csv": (1, "FAIL", "could not read file: it is empty"),
        "paid_5.csv": (2, "FAIL", "header does not match contract v2: unexpected columns ['more']")}
    rows = accepted["paid"]
    assert sorted((r.id, r.amount, r.agent) for r in rows.collect()) == [("1", "10", None), ("2", "20", "x")]
    assert column_classes(rows)["amount"] == "personal"  # the more protected of both names
    log, accepted = check({}, [PAID, v2], classes)
    assert "agent" in accepted["paid"].columns
