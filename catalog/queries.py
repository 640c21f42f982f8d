"""Registered queries over the lending sources derived from the given tables, with their oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalog import oracles as o
from catalog.inputs import raw, scratch, table
from tallyline import functions as fn
from tallyline.operators import checks, identity, reconcile
from tallyline.operators import rules as r
from tallyline.operators.asof import asof_merge
from tallyline.operators.dedup import flag_duplicates, latest_first
from tallyline.operators.skew import HeavyKeys, heavy_keys
from tallyline.plans import lending as plan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = o.statement(oracle)
        return query

    return add


def _joined(reasons: str) -> Column:
    return F.array_join(reasons, "; ").alias(reasons)


# ---- the lending sources at each stage -------------------------------------------------------


class Lending:
    """One run over one data folder.

    ``keep`` names the checked sources (or ``parties``) that a query reads more than once: they
    are written to the scratch folder once and read back from there, each row evaluated once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.keep = spark, sf_dir, keep
        self._built: dict[str, DataFrame] = {}
        self.counts: dict[str, Observation] = {}
        self._heavy_loans: list[HeavyKeys] | None = None

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            df = build()
            if name in self.keep and r.QUARANTINED in df.columns:
                df, self.counts[name] = r.observed(df)
            self._built[name] = stored(df) if name in self.keep else df
        return self._built[name]

    def raw(self, source: str) -> DataFrame:
        return self._once(f"raw {source}", lambda: raw(self.spark, self.sf_dir, source))

    def lookup(self) -> DataFrame:
        return self._once("lookup", lambda: plan.country_lookup(self.spark))

    def checked(self, source: str) -> DataFrame:
        build = {
            "ims_clients": lambda: plan.check_clients(self.raw(source), self.lookup()),
            "cbs_borrowers": lambda: plan.check_borrowers(self.raw(source)),
            "cbs_loans": lambda: plan.check_loans(
                self.raw(source), self.staged("cbs_borrowers"), self.heavy_loan_keys()),
            "cbs_repayments": lambda: plan.check_repayments(
                self.raw(source), self.staged("cbs_loans")),
            "fx_rates": lambda: plan.check_rates(self.raw(source)),
            "cbs_control_totals": lambda: plan.check_control_totals(
                self.raw(source), self.lookup()),
        }[source]
        return self._once(source, build)

    def heavy_loan_keys(self) -> list[HeavyKeys]:
        if self._heavy_loans is None:
            self._heavy_loans = plan.heavy_loan_keys(self.raw("cbs_loans"))
        return self._heavy_loans

    def staged(self, source: str) -> DataFrame:
        return plan.staged(source, self.checked(source))

    def quarantined(self, source: str) -> DataFrame:
        return plan.quarantined(source, self.checked(source), stamp=False)

    def matched(self) -> DataFrame:
        return self._once("parties", lambda: plan.matched_parties(
            self.staged("ims_clients"), self.staged("cbs_borrowers")))

    def links(self) -> DataFrame:
        return identity.crosswalk(self.matched())

    def mart(self) -> DataFrame:
        banking = identity.crosswalk(identity.add_match_key(
            plan.banking_parties(self.staged("cbs_borrowers"))))
        return plan.loan_mart(
            self.staged("cbs_loans"), banking, self.staged("fx_rates"), self.heavy_loan_keys()[1])

    def reconciliation(self, ordered: bool = False) -> DataFrame:
        return plan.reconciliation(
            self.staged("cbs_control_totals"), self.staged("cbs_loans"),
            r.passed(self.checked("cbs_repayments")), ordered=ordered)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# ---- validation ------------------------------------------------------------------------------

_STAGES = {
    "ims_clients": ("clients", "is_minor"),
    "cbs_borrowers": ("borrowers", None),
    "cbs_loans": ("loans", None),
    "cbs_repayments": ("repayments", None),
    "fx_rates": ("rates", None),
    "cbs_control_totals": ("totals", None),
}
_MINOR = "date_of_birth + interval 18 year > date '2026-09-25' as is_minor"


def _register_source(source: str, cte: str, extra: str | None) -> None:
    classes = plan.CLASSIFICATION[plan.SOURCE_FILES[source][0]]
    kept = [c for c in plan.CONTRACTS[source].columns if classes[c] != "excluded"]
    columns = ", ".join([*kept, *([_MINOR] if extra else [])])

    @register(f"stg_{source}", f"select {columns} from {cte} where not bad")
    def passed_rows(spark, sf_dir):
        return Lending(spark, sf_dir).staged(source)

    shown = ", ".join(plan.QUARANTINE_COLUMNS[source])

    @register(f"stg_{source}_quarantine",
              f"select {shown}, reasons as quarantine_reasons from {cte} where bad")
    def quarantined_rows(spark, sf_dir):
        rows = Lending(spark, sf_dir).quarantined(source)
        return rows.select(*plan.QUARANTINE_COLUMNS[source], _joined("quarantine_reasons"))


for _source, (_cte, _extra) in _STAGES.items():
    _register_source(_source, _cte, _extra)


@register("validate_reasons",
          "select loan_id, borrower_id, is_duplicate_key, bad as is_quarantined, reasons as all_reasons from loans")
def validate_reasons(spark, sf_dir):
    checked = Lending(spark, sf_dir).checked("cbs_loans")
    return checked.select(
        "loan_id", "borrower_id", "is_duplicate_key", "is_quarantined", _joined("all_reasons"))


@register("reason_counts", """
    select regexp_extract(reason, '^[^:]*') as reason, count(*) as row_count
    from (select unnest(string_split(reasons, '; ')) as reason from repayments where bad) group by 1""")
def reason_counts(spark, sf_dir):
    return r.reason_counts(Lending(spark, sf_dir).checked("cbs_repayments"))


@register("dq_summary", "select * from accounts")
def dq_summary(spark, sf_dir):
    """Counted while each checked source is written, once: whole where children are checked against it, and the verdicts alone of
    the others, in one job."""
    run = Lending(spark, sf_dir, keep=("cbs_borrowers", "cbs_loans"))
    counts, verdicts = {}, []
    for source in _STAGES:
        rows = run.checked(source)
        if source not in run.counts:
            rows, counts[source] = r.observed(rows.select(r.QUARANTINED))
            verdicts.append(rows)
    reduce(DataFrame.union, verdicts).write.format("noop").mode("overwrite").save()
    return r.dq_summary(spark, counts | run.counts)


_LINE_ORDER = ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey",
               "l_returnflag", "l_linestatus")


@register("dedup_latest", f"""
    select l_orderkey, l_linenumber, l_shipdate, {', '.join(_LINE_ORDER)}, row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc nulls last, {', '.join(f'{c} nulls first' for c in _LINE_ORDER)}) > 1 as is_duplicate_key
    from lineitem""")
def dedup_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", *_LINE_ORDER)
    key = ["l_orderkey", "l_linenumber"]
    (heavy,) = heavy_keys(lines, key)
    return flag_duplicates(
        lines, key, latest_first("l_shipdate"), heavy, tie_columns=_LINE_ORDER)


@register("dedup_latest_sliced", f"""
    select l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_shipdate, {', '.join(_LINE_ORDER[:6])}, row_number() over (
        partition by l_returnflag, l_linestatus
        order by l_shipdate desc nulls last, l_orderkey, l_linenumber, {', '.join(_LINE_ORDER[:6])}) > 1 as is_duplicate_key
    from lineitem""")
def dedup_latest_sliced(spark, sf_dir):
    """Six keys over the whole table: every key is heavy and is ranked in slices."""
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_returnflag", "l_linestatus"]
    ties = ["l_orderkey", "l_linenumber", *_LINE_ORDER[:6]]
    (heavy,) = heavy_keys(lines, key, min_rows=1_000)
    return flag_duplicates(
        lines.select(*key, "l_shipdate", *ties), key, latest_first("l_shipdate"), heavy,
        tie_columns=ties)


# ---- normalisation ---------------------------------------------------------------------------


@register("normalize_money", f"""
    select loan_id, principal, {o._num('principal')} as amount, {o._num('interest_rate_pct')} as rate,
        try_cast(term_months as integer) as months
    from raw_cbs_loans""")
def normalize_money(spark, sf_dir):
    return raw(spark, sf_dir, "cbs_loans").select(
        "loan_id", "principal",
        fn.parse_number("principal").alias("amount"),
        fn.parse_number("interest_rate_pct").alias("rate"),
        fn.parse_integer("term_months").alias("months"),
    )


@register("normalize_dates", """
    select 'client' as kind, date_of_birth as written,
        try_strptime(trim(date_of_birth), ['%Y-%m-%d', '%d/%m/%Y'])::date as day from raw_ims_clients
    union all select 'borrower', created_on, try_cast(created_on as date) from raw_cbs_borrowers
    union all select 'rate', rate_date, try_cast(rate_date as date) from raw_fx_rates""")
def normalize_dates(spark, sf_dir):
    client = raw(spark, sf_dir, "ims_clients").select(
        F.lit("client").alias("kind"), F.col("date_of_birth").alias("written"),
        fn.parse_date("date_of_birth", ("yyyy-M-d", "d/M/yyyy")).alias("day"))
    cast = [
        raw(spark, sf_dir, source).select(
            F.lit(kind).alias("kind"), F.col(column).alias("written"),
            fn.parse_cast_date(column).alias("day"))
        for kind, source, column in (
            ("borrower", "cbs_borrowers", "created_on"), ("rate", "fx_rates", "rate_date"))
    ]
    return client.unionByName(cast[0]).unionByName(cast[1])


@register("wall_clock_month", """
    select strftime(try_cast(paid_at as timestamp), '%Y-%m') as month, count(*) as n,
        count(try_cast(paid_at as timestamp)) as n_parsed
    from raw_cbs_repayments group by 1""")
def wall_clock_month(spark, sf_dir):
    paid = raw(spark, sf_dir, "cbs_repayments").select(fn.parse_timestamp("paid_at").alias("at"))
    return paid.groupBy(fn.month_of("at").alias("month")).agg(
        F.count("*").alias("n"), F.count("at").alias("n_parsed"))


@register("offset_aware_month", """
    select strftime(timezone('Africa/Nairobi', (case when paid_at similar to '.*(Z|[+-][0-9]{2}:[0-9]{2})'
            then paid_at else paid_at || '+00:00' end)::timestamptz), '%Y-%m') as month, count(*) as n
    from raw_cbs_repayments where try_cast(paid_at as timestamp) is not null group by 1""")
def offset_aware_month(spark, sf_dir):
    """The investigated alternative: month buckets in a named zone instead of written digits."""
    paid = raw(spark, sf_dir, "cbs_repayments").select(
        fn.parse_timestamp("paid_at", zone="Africa/Nairobi").alias("at"))
    return paid.filter("at is not null").groupBy(fn.month_of("at").alias("month")).agg(
        F.count("*").alias("n"))


@register("name_key", f"""
    select c_name as name, {o._name("c_name || '  ' || c_mktsegment")} as name_key from customer
    union all select p_name, {o._name("p_type || ' ' || p_name")} from part
    union all select first_name || ' ' || last_name, {o._name("first_name || ' ' || last_name")} from raw_ims_clients""")
def name_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        fn.name_key(F.concat_ws("  ", "c_name", "c_mktsegment")).alias("name_key"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        fn.name_key(F.concat_ws(" ", "p_type", "p_name")).alias("name_key"))
    full = F.concat("first_name", F.lit(" "), "last_name")
    clients = raw(spark, sf_dir, "ims_clients").select(
        full.alias("name"), fn.name_key(full).alias("name_key"))
    return customers.unionByName(parts).unionByName(clients)


@register("lookup_country", """
    select ims_client_id, country, iso as country_code from raw_ims_clients
    left join spellings on spelling = lower(trim(country))""")
def lookup_country(spark, sf_dir):
    clients = raw(spark, sf_dir, "ims_clients").select("ims_client_id", "country")
    return plan.with_country_code(clients, plan.country_lookup(spark))


@register("age_flag", """
    select o_orderkey, date_diff('year', b, date '2026-09-25')
            - (b + to_years(date_diff('year', b, date '2026-09-25')::integer) > date '2026-09-25')::integer as age,
        b + interval 18 year > date '2026-09-25' as is_minor
    from (select o_orderkey, (o_orderdate::date + (o_orderkey % 5000)::integer) as b from orders)""")
def age_flag(spark, sf_dir):
    born = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 5000).cast("int")).alias("b"))
    return born.select(
        "o_orderkey", fn.completed_years("b", plan.AS_OF).cast("long").alias("age"),
        fn.is_under_age("b", plan.AS_OF).alias("is_minor"))


@register("round_money", """
    select l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
        round(l_extendedprice / l_quantity, 2) as unit_price, round(l_extendedprice * 0.005::double, 2) as fee
    from lineitem""")
def round_money(spark, sf_dir):
    price = fn.safe_ratio("l_extendedprice", "l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        fn.round_half_away(price).alias("unit_price"),
        fn.round_half_away(F.col("l_extendedprice") * 0.005).alias("fee"))


# ---- identity --------------------------------------------------------------------------------


@register("party_matched", "select * exclude (enterprise_client_id) from parties")
def party_matched(spark, sf_dir):
    return Lending(spark, sf_dir).matched()


@register("crosswalk", """
    select enterprise_client_id, source_system, source_id, match_tier, name_key, date_of_birth, country,
        id_key, phone_key, gender_norm, is_minor from parties""")
def crosswalk(spark, sf_dir):
    return Lending(spark, sf_dir).links()


@register("id_collisions", """
    select 'ECID-' || left(upper(md5(match_key)), 4) as enterprise_client_id
    from parties group by 1 having count(distinct match_key) > 1""")
def id_collisions(spark, sf_dir):
    """At four hex digits collisions do occur; the crosswalk's ten have a check of their own."""
    return identity.id_collisions(Lending(spark, sf_dir).matched(), hex_digits=4)


@register("identity_conflicts", """
    select * exclude (match_tier) from per_identity where distinct_country_count > 1 or distinct_dob_count > 1""")
def identity_conflicts(spark, sf_dir):
    return identity.identity_conflicts(Lending(spark, sf_dir).links())


@register("identity_summary", """
    select sum(n)::bigint as total_enterprise_clients, sum(n * (systems = 2)::int)::bigint as matched_across_systems,
        sum(n * (systems = 1 and ims)::int)::bigint as ims_only_unmatched, sum(n * (systems = 1 and cbs)::int)::bigint as cbs_only_unmatched,
        sum(n * (tier = 'id_number')::int)::bigint as matched_via_id_number,
        sum(n * (tier = 'name_dob_country')::int)::bigint as matched_via_name_dob_country,
        sum(n * torn::int)::bigint as conflicting_attribute_ecids, (select count(*) from pairs) as review_queue_pairs
    from (select system_count as systems, ims_record_count > 0 as ims, cbs_record_count > 0 as cbs, match_tier as tier,
              greatest(distinct_country_count, distinct_dob_count) > 1 as torn, count(*) as n from per_identity group by all)""")
def identity_summary(spark, sf_dir):
    run = Lending(spark, sf_dir, keep=("parties",))
    return identity.identity_summary(run.links(), run.matched())


@register("review_pair_count", "select count(*) as pairs from pairs")
def review_pair_count(spark, sf_dir):
    return identity.review_pair_count(Lending(spark, sf_dir, keep=("parties",)).matched())


REVIEW_MEMBERS = """
    select a.source_system, a.source_id, a.match_key, a.phone_key, a.country,
        b.n - coalesce(g.n, 0) as partner_count
    from parties a
    join (select phone_key, country, source_system, count(*) as n from parties group by all) b
        on a.phone_key = b.phone_key and a.country = b.country and a.source_system <> b.source_system
    left join (select phone_key, country, match_key, source_system, count(*) as n from parties group by all) g
        on a.phone_key = g.phone_key and a.country = g.country and a.match_key = g.match_key
        and a.source_system <> g.source_system
    where b.n > coalesce(g.n, 0)"""


@register("review_members", REVIEW_MEMBERS)
def review_members(spark, sf_dir):
    """Every record with partners and their exact number, in blocks of any size."""
    return identity.review_queue(Lending(spark, sf_dir, keep=("parties",)).matched())


@register("review_members_heavy", REVIEW_MEMBERS)
def review_members_heavy(spark, sf_dir):
    """The same with blocks of twenty records treated as heavy."""
    return identity.review_queue(Lending(spark, sf_dir, keep=("parties",)).matched(), min_rows=20)


@register("review_partners",
          "select * from pairs where system_a = 'cbs' and source_id_a like 'B%1'")
def review_partners(spark, sf_dir):
    matched = Lending(spark, sf_dir, keep=("parties",)).matched()
    wanted = matched.filter("source_system = 'cbs' and source_id like 'B%1'")
    return identity.review_partners(matched, wanted)


# ---- conversion and marts --------------------------------------------------------------------


@register("loan_fx", "select * from loan_rates")
def loan_fx(spark, sf_dir):
    run = Lending(spark, sf_dir, keep=("fx_rates",))
    return plan.loan_fx(run.staged("cbs_loans"), run.staged("fx_rates"))


@register("loan_mart", "select * from mart")
def loan_mart(spark, sf_dir):
    return Lending(spark, sf_dir, keep=("cbs_borrowers", "fx_rates")).mart()


@register("period_summary", """
    select f.country, f.month, f.currency, len(here) as loans_disbursed_count, round(list_sum(here)::double, 2) as loans_disbursed_local,
        round(list_sum(usd)::double, 2) as loans_disbursed_usd, round(list_sum(usd)::double / len(usd), 2) as avg_loan_size_usd,
        ifnull(by_status['active'], 0)::bigint as active_loans_count, ifnull(by_status['closed'], 0)::bigint as closed_loans_count,
        n_clients as distinct_clients_count
    from period_lists f join period_clients c on f.country is not distinct from c.country and f.month is not distinct from c.month
        and f.currency is not distinct from c.currency""")
def period_summary(spark, sf_dir):
    return plan.period_summary(Lending(spark, sf_dir, keep=("cbs_borrowers", "fx_rates")).mart())


_VIEWS = "(select user_id, ts, max(value) as value from events where event_type = 'view' group by all)"


def _event_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select(
        "user_id", F.col("ts").alias("viewed_at"), F.col("value").alias("view_value"))
    return buys, views


@register("asof_backward", f"""
    select e.event_id, e.user_id, e.ts, v.value as view_value, v.ts as viewed_at, false as is_estimated
    from (from events where event_type = 'purchase') e asof join {_VIEWS} v
        on e.user_id = v.user_id and e.ts >= v.ts""")
def asof_backward(spark, sf_dir):
    buys, views = _event_sides(spark, sf_dir)
    return asof_merge(buys, views, ["user_id"], "ts", "viewed_at", ["view_value"],
                      fallback=False, how="inner")


@register("asof_fallback", f"""
    select e.event_id, e.user_id, e.ts, coalesce(v.value, f.value) as view_value, coalesce(v.ts, f.ts) as viewed_at,
        case when f.ts is not null then v.ts is null end as is_estimated
    from (from events where event_type = 'purchase') e asof left join {_VIEWS} v
        on e.user_id = v.user_id and e.ts >= v.ts
    left join (select user_id, min(ts) as ts, arg_min(value, ts) as value from {_VIEWS} group by user_id) f
        on f.user_id = e.user_id""")
def asof_fallback(spark, sf_dir):
    buys, views = _event_sides(spark, sf_dir)
    return asof_merge(buys, views, ["user_id"], "ts", "viewed_at", ["view_value"])


# ---- reconciliation --------------------------------------------------------------------------


@register("reconcile_totals", "select * from recon")
def reconcile_totals(spark, sf_dir):
    return Lending(spark, sf_dir, keep=("cbs_loans",)).reconciliation(ordered=True)


@register("referential_cascade", """
    select source, count(*) as n from (
        select 'loans' as source from loans where reasons like '%not found in valid%'
        union all select 'repayments' from repayments where reasons like '%not found in valid%') group by 1""")
def referential_cascade(spark, sf_dir):
    run = Lending(spark, sf_dir, keep=("cbs_loans",))
    lost = [
        run.checked(source).filter(f"not {flag} and {key} is not null")
        .groupBy(F.lit(name).alias("source")).agg(F.count("*").alias("n"))
        for name, source, flag, key in (
            ("loans", "cbs_loans", "borrower_found", "borrower_id"),
            ("repayments", "cbs_repayments", "loan_found", "loan_id"))
    ]
    return lost[0].unionByName(lost[1])


# ---- assertions: counts of offending rows ----------------------------------------------------


@register("check_unique", """
    select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null
    group by 1 having count(*) > 1""")
def check_unique(spark, sf_dir):
    return checks.check_unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("check_not_null", "select loan_id, country, currency from loans where not bad and currency is null")
def check_not_null(spark, sf_dir):
    loans = Lending(spark, sf_dir).staged("cbs_loans")
    return checks.check_not_null(loans, "currency").select("loan_id", "country", "currency")


@register("check_accepted", f"""
    select currency, count(*) as n_records from typed_loans where currency not in ({o._in(plan.CURRENCIES)})
    group by 1""")
def check_accepted(spark, sf_dir):
    typed = raw(spark, sf_dir, "cbs_loans").select(
        fn.upper_code("currency", plan.CURRENCY_ALIASES).alias("currency"))
    return checks.check_accepted_values(typed, "currency", plan.CURRENCIES)


@register("check_fk", """
    select borrower_id, count(*) as n_records from typed_loans
    where borrower_id is not null and borrower_id not in (select borrower_id from borrowers where not bad)
    group by 1""")
def check_fk(spark, sf_dir):
    loans = raw(spark, sf_dir, "cbs_loans").select(
        fn.trim_spaces("borrower_id").alias("borrower_id"))
    borrowers = Lending(spark, sf_dir).staged("cbs_borrowers")
    return checks.check_relationship(loans, "borrower_id", borrowers, "borrower_id")


@register("check_invariant", "select * from accounts where raw_count <> passed_count + quarantined_count")
def check_invariant(spark, sf_dir):
    run = Lending(spark, sf_dir, keep=tuple(_STAGES))
    summary = r.stored_dq_summary({
        source: (run.raw(source), run.staged(source), run.quarantined(source))
        for source in _STAGES
    })
    return checks.check_rows_accounted(summary)


@register("check_crosswalk", """
    select source_system, source_id, n as times_in_crosswalk from (
        select 'ims' as source_system, ims_client_id as source_id from typed_clients
        union select 'cbs', borrower_id from typed_borrowers) w
    left join (select source_system, source_id, count(*) as c from parties group by all) h
        using (source_system, source_id), lateral (select ifnull(c, 0) as n) where n <> 1 and source_id is not null""")
def check_crosswalk(spark, sf_dir):
    """All known ids, valid or not, against the crosswalk: the quarantined ones are missing."""
    run = Lending(spark, sf_dir)
    known = [
        run.raw(source).select(
            F.lit(system).alias("source_system"), fn.trim_spaces(key).alias("source_id"))
        for system, source, key in (
            ("ims", "ims_clients", "ims_client_id"), ("cbs", "cbs_borrowers", "borrower_id"))
    ]
    expected = known[0].unionByName(known[1]).filter("source_id is not null")
    return checks.check_crosswalk(expected, run.links())


@register("check_recon", """
    select country, month, currency from recon
    where not (loans_count_pass and loans_amount_pass and repayments_count_pass and repayments_amount_pass)""")
def check_recon(spark, sf_dir):
    verdicts = Lending(spark, sf_dir, keep=("cbs_loans",)).reconciliation()
    return reconcile.failing(verdicts, plan.MEASURES).select(*plan.PERIOD)
