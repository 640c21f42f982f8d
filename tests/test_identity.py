import datetime as dt
import random
from itertools import product

from pyspark.sql import functions as F

from tallyline.operators import decisions as d
from tallyline.operators import identity as ident

SCHEMA = ("source_system string, source_id string, name_key string, date_of_birth date, country string, "
          "id_key string, phone_key string, gender_norm string, is_minor boolean")
BORN = dt.date(1990, 1, 2)


def party(system, number, name=None, born=None, country=None, doc=None, phone=None):
    return (system, number, name, born, country, doc, phone, None, False)


def test_match_key_takes_the_first_rule_that_applies(spark):
    rows = [
        party("ims", "1", "a b", BORN, "KE", "X1"), party("cbs", "2", "a b", BORN, "KE"),
        party("cbs", "3", "a b", None, "KE"), party("cbs", "4", None, BORN, "KE"),
    ]
    got = {r["source_id"]: (r["match_key"], r["match_tier"])
           for r in ident.add_match_key(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {
        "1": ("ID:X1", "id_number"), "2": ("NDC:a b|1990-01-02|KE", "name_dob_country"),
        "3": ("SINGLETON:cbs:3", "unmatched"), "4": ("SINGLETON:cbs:4", "unmatched"),
    }


def test_enterprise_id_is_a_function_of_the_key(evaluate):
    # md5('ID:X1') in hex, first ten digits
    import hashlib
    digest = hashlib.md5(b"ID:X1").hexdigest().upper()
    assert evaluate(ident.enterprise_id("x"), ["ID:X1"]) == [f"ECID-{digest[:10]}"]
    assert evaluate(ident.enterprise_id("x", 16), ["ID:X1"]) == [f"ECID-{digest[:16]}"]


def crowd(spark):
    rng = random.Random(11)
    rows = [
        party(rng.choice(["ims", "cbs"]), str(i), "n", BORN, rng.choice(["KE", "TD", None]),
              rng.choice([None, "D1", "D2", f"E{i}"]), rng.choice(["p1", "p1", "p2", f"q{i % 40}", None]))
        for i in range(260)
    ]
    return rows, ident.add_match_key(spark.createDataFrame(rows, SCHEMA))


def brute_force(matched):
    rows = matched.collect()
    return sorted(
        (a.source_system, a.source_id, a.match_key, b.source_system, b.source_id, b.match_key,
         a.phone_key, a.country)
        for a, b in product(rows, rows)
        if a.phone_key is not None and a.phone_key == b.phone_key and a.country is not None
        and a.country == b.country and a.source_system != b.source_system
        and a.match_key != b.match_key)


def test_review_queue_counts_every_partner(spark):
    _, matched = crowd(spark)
    want = brute_force(matched)
    counted = {}
    for p in want:
        counted[p[0], p[1]] = counted.get((p[0], p[1]), 0) + 1
    for options in ({}, {"min_rows": 20}):
        members = ident.review_queue(matched, **options).collect()
        assert {(m.source_system, m.source_id): m.partner_count for m in members} == counted
    assert ident.review_pair_count(matched).first()["pairs"] == len(want)
    assert ident.review_pair_count(matched, ordered=False).first()["pairs"] * 2 == len(want)
    for rows_per_salt in (10_000, 3):
        wanted = ident.review_queue(matched).filter("source_id like '%3'")
        opened = sorted(map(tuple, ident.review_partners(matched, wanted, rows_per_salt).collect()))
        assert opened == [p for p in want if p[1].endswith("3")]


def test_a_block_of_any_size_is_whole(spark):
    rows = [party(system, f"{system}{k}", phone="p", country="KE") for system in ("ims", "cbs") for k in range(60)]
    matched = ident.add_match_key(spark.createDataFrame(rows, SCHEMA))
    members = ident.review_queue(matched)
    assert members.count() == 120
    assert members.agg(F.sum("partner_count")).first()[0] == 7_200
    assert ident.review_partners(matched, members.filter("source_id = 'ims7'"), 7).count() == 60


def test_summary_and_conflicts(spark):
    rows = [
        party("ims", "1", "a", BORN, "KE", "D"), party("cbs", "2", "a", dt.date(1991, 1, 1), "KE", "D"),
        party("ims", "3", "b", BORN, "KE"), party("cbs", "4", "b", BORN, "KE"),
        party("ims", "5"), party("cbs", "6", phone="p", country="KE"),
        party("ims", "7", phone="p", country="KE"), party("ims", "8", "z", None, "TD", "D"),
    ]
    matched = ident.add_match_key(spark.createDataFrame(rows, SCHEMA))
    links = ident.crosswalk(matched)
    s = ident.identity_summary(links, matched).first().asDict()
    assert s == {
        "total_enterprise_clients": 5, "matched_across_systems": 2, "ims_only_unmatched": 2,
        "cbs_only_unmatched": 1, "matched_via_id_number": 1, "matched_via_name_dob_country": 1,
        "conflicting_attribute_ecids": 1, "review_queue_pairs": 2,
    }
    (conflict,) = ident.identity_conflicts(links).collect()
    assert tuple(conflict)[1:] == (2, 2, 1, 2, 2)
    assert ident.id_collisions(matched).isEmpty()


def test_overrides_export_and_quality(spark):
    links = ident.crosswalk(ident.add_match_key(spark.createDataFrame([
        party("ims", "1", "a", BORN, "KE", "D"), party("cbs", "2", "a", BORN, "KE", "D"),
        party("ims", "3", "b", BORN, "KE"), party("cbs", "4", "b", BORN, "KE"), party("cbs", "5"),
    ], SCHEMA)))
    manual = spark.createDataFrame([("cbs", "5", "ECID-M")],
                                   "source_system string, source_id string, enterprise_client_id string")
    after = d.apply_overrides(links, manual)
    assert after.filter("is_overridden").select("source_id", "enterprise_client_id").collect() == [("5", "ECID-M")]
    assert after.count() == 5
    confirmed = spark.createDataFrame([("cbs", "4")], "source_system string, source_id string")
    assert sorted(r.source_id for r in d.gated_export(links, confirmed).collect()) == ["1", "2", "4"]
    labelled = spark.createDataFrame(
        [("ims", "1", "cbs", "2", True), ("ims", "3", "cbs", "4", False), ("ims", "1", "cbs", "5", True),
         ("ims", "9", "cbs", "5", False)],
        "source_system_a string, source_id_a string, source_system_b string, source_id_b string, is_same boolean")
    for options in ({}, {"min_rows": 2}):
        q = d.match_quality(links, labelled, **options).first()
        assert tuple(q) == (1, 1, 1, 0.5, 0.5)
    none = d.match_quality(links, labelled.filter(F.lit(False))).first()
    assert none["precision"] is None and none["recall"] is None
