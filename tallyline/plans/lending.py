"""The lending data set: contracts, clean-up, rules and the tables built from them.

Two source systems (``ims`` advisory, ``cbs`` banking), exchange rates and published control
totals. Every function maps DataFrames to a DataFrame; ``plans.nightly`` stores the results.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import functions as fn
from tallyline.operators import rules as r
from tallyline.operators.asof import asof_calendar
from tallyline.operators.dedup import latest_first
from tallyline.operators.identity import add_match_key
from tallyline.operators.reconcile import reconcile
from tallyline.operators.skew import HeavyKeys, heavy_keys, lookup_join
from tallyline.sources.contracts import Contract

AS_OF = dt.date(2026, 9, 25)
TOLERANCE = 0.005

# ---- Fixed values: must equal the reference's for right results ------------------------------
COUNTRIES = ("ET", "KE", "RW", "SS", "TD")
CURRENCIES = ("ETB", "KES", "RWF", "SSP", "XAF")
CURRENCY_ALIASES = {"KSH": "KES"}
RATE_TYPES = ("official", "parallel")
SEX = {"male": "male", "m": "male", "female": "female", "f": "female"}
LOAN_STATUS = {"active": "active", "closed": "closed"}
COUNTRY_NAMES = {
    "Chad": ("TD", ("chad", "tchad", "tcd", "td")),
    "Ethiopia": ("ET", ("ethiopia", "eth", "et")),
    "Kenya": ("KE", ("kenya", "ken", "ke")),
    "Rwanda": ("RW", ("rwanda", "rwa", "rw")),
    "South Sudan": ("SS", ("south sudan", "s. sudan", "ssd", "ss")),
}

CLASSIFICATION: dict[str, dict[str, str]] = {
    "ims_clients.csv": {
        "ims_client_id": "internal", "first_name": "personal", "middle_name": "personal",
        "last_name": "personal", "sex": "personal", "date_of_birth": "personal",
        "phone_1": "personal", "phone_2": "personal", "country": "internal",
        "location": "sensitive", "household_id": "internal", "relationship_to_head": "personal",
        "id_document_type": "sensitive", "id_document_number": "sensitive",
        "registration_date": "internal", "business_sector": "internal",
        "registered_by": "internal", "source_form": "internal", "updated_at": "internal",
        "notes": "restricted",
    },
    "cbs_borrowers.csv": {
        "borrower_id": "internal", "full_name": "personal", "gender": "personal",
        "date_of_birth": "personal", "mobile_no": "personal", "id_type": "sensitive",
        "id_number": "sensitive", "country": "internal", "branch": "sensitive",
        "office_id": "internal", "fingerprint_template_ref": "excluded", "created_on": "internal",
    },
    "cbs_loans.csv": {
        "loan_id": "internal", "borrower_id": "internal", "country": "internal",
        "branch": "sensitive", "product": "internal", "currency": "internal",
        "principal": "internal", "disbursed_at": "internal", "term_months": "internal",
        "interest_rate_pct": "internal", "status": "internal", "cbs_fx_rate": "internal",
        "principal_usd_cbs": "internal", "loan_officer": "internal",
    },
    "cbs_repayments_*.csv": {
        "txn_id": "internal", "loan_id": "internal", "paid_at": "internal", "amount": "internal",
        "currency": "internal", "channel": "internal", "reversal_of": "internal",
    },
    "fx_rates.csv": {
        "currency": "public", "rate_date": "public", "rate_type": "public",
        "units_per_usd": "public", "source": "public", "published_at": "public",
    },
    "cbs_control_totals.csv": {
        "country": "internal", "month": "internal", "currency": "internal",
        "loans_disbursed_count": "internal", "loans_disbursed_amount": "internal",
        "repayments_count": "internal", "repayments_amount": "internal",
    },
    "investment_screening.csv": {
        "applicant_name": "personal", "phone": "personal", "country": "internal",
        "location": "sensitive", "screened_on": "internal", "decision": "sensitive",
        "decline_reason": "sensitive", "screened_by": "internal",
    },
}
SOURCE_FILES = {  # source -> file pattern, natural key
    "ims_clients": ("ims_clients.csv", ("ims_client_id",)),
    "cbs_borrowers": ("cbs_borrowers.csv", ("borrower_id",)),
    "cbs_loans": ("cbs_loans.csv", ("loan_id",)),
    "cbs_repayments": ("cbs_repayments_*.csv", ("txn_id",)),
    "fx_rates": ("fx_rates.csv", ("currency", "rate_date", "rate_type")),
    "cbs_control_totals": ("cbs_control_totals.csv", ("country", "month", "currency")),
    "investment_screening": ("investment_screening.csv", ()),
}
# ---- end of fixed values ---------------------------------------------------------------------

CONTRACTS = {
    source: Contract(
        source, match, tuple(CLASSIFICATION[match]), key, incremental=source == "cbs_repayments")
    for source, (match, key) in SOURCE_FILES.items()
}
# the announced next shape of the repayments file, loadable next to the first one
REPAYMENTS_V2 = Contract(
    "cbs_repayments", "cbs_repayments_*.csv",
    ("txn_id", "loan_id", "paid_at", "amount_paid", "currency", "channel", "agent_code",
     "reversal_of"),
    ("txn_id",), version=2, renames={"amount_paid": "amount"}, optional=("agent_code",),
    incremental=True,
)


def country_lookup(spark: SparkSession) -> DataFrame:
    rows = [
        (spelling, iso2, name)
        for name, (iso2, spellings) in COUNTRY_NAMES.items() for spelling in spellings
    ]
    return spark.createDataFrame(
        rows, "lower_value string, country_iso2 string, country_name string"
    )


def with_country_code(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``country_code`` for any known spelling. The lookup is the fixed seed above: broadcast."""
    codes = F.broadcast(lookup.select(
        F.col("lower_value").alias("_spelling"), F.col("country_iso2").alias("country_code")
    ))
    spelling = F.lower(fn.trim_spaces("country"))
    return raw.join(codes, spelling == F.col("_spelling"), "left").drop("_spelling")


def _currency() -> Column:
    return fn.upper_code("currency", CURRENCY_ALIASES)


def _typed(raw: DataFrame, **columns: Column) -> DataFrame:
    return raw.select(*[c.alias(name) for name, c in columns.items()])


# ---- the six checked sources -----------------------------------------------------------------


def check_clients(raw: DataFrame, lookup: DataFrame, **heavy_options) -> DataFrame:
    typed = _typed(
        with_country_code(raw, lookup),
        ims_client_id=fn.trim_spaces("ims_client_id"),
        first_name=fn.blank_to_null("first_name"),
        middle_name=fn.blank_to_null("middle_name"),
        last_name=fn.blank_to_null("last_name"),
        sex=fn.fold_values("sex", SEX),
        date_of_birth_raw=fn.trim_spaces("date_of_birth"),
        date_of_birth=fn.parse_date("date_of_birth", ("yyyy-M-d", "d/M/yyyy")),
        phone_1=fn.phone_digits("phone_1"),
        phone_2=fn.phone_digits("phone_2"),
        country_raw=fn.trim_spaces("country"),
        country=F.col("country_code"),
        location=fn.blank_to_null("location"),
        household_id=fn.blank_to_null("household_id"),
        relationship_to_head=F.lower(fn.blank_to_null("relationship_to_head")),
        id_document_type=fn.blank_to_null("id_document_type"),
        id_document_number=fn.document_code("id_document_number"),
        registration_date=fn.parse_date("registration_date"),
        business_sector=fn.blank_to_null("business_sector"),
        registered_by=fn.blank_to_null("registered_by"),
        source_form=fn.blank_to_null("source_form"),
        updated_at=fn.parse_timestamp("updated_at"),
        notes=fn.blank_to_null("notes"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("ims_client_id",),
        order_by=tuple(latest_first("updated_at", "registration_date")),
        duplicate_reason="duplicate ims_client_id, kept most recently updated record",
        rules=(
            r.required("ims_client_id", "missing ims_client_id"),
            r.any_of_required(["first_name", "last_name"], "missing both first_name and last_name"),
            r.parseable_if_present("date_of_birth_raw", "date_of_birth",
                                   "date_of_birth present but unparseable: "),
            r.not_null("date_of_birth", "missing date_of_birth"),
            r.in_lookup("country_raw", "country", "unrecognized country value: "),
            r.required("country_raw", "missing country"),
        ),
    ), **heavy_options)


def check_borrowers(raw: DataFrame, **heavy_options) -> DataFrame:
    typed = _typed(
        raw,
        borrower_id=fn.trim_spaces("borrower_id"),
        full_name=fn.blank_to_null("full_name"),
        gender=fn.fold_values("gender", SEX),
        date_of_birth_raw=fn.trim_spaces("date_of_birth"),
        date_of_birth=fn.parse_date("date_of_birth"),
        mobile_no=fn.phone_digits("mobile_no"),
        id_type=fn.blank_to_null("id_type"),
        id_number=fn.document_code("id_number"),
        country=fn.upper_code("country"),
        branch=fn.blank_to_null("branch"),
        office_id=fn.blank_to_null("office_id"),
        created_on=fn.parse_cast_date("created_on"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("borrower_id",),
        order_by=tuple(latest_first("created_on")),
        duplicate_reason="duplicate borrower_id, kept most recently created record",
        rules=(
            r.required("borrower_id", "missing borrower_id"),
            r.not_null("full_name", "missing full_name"),
            r.allowed_values("country", COUNTRIES, "unrecognized country code: "),
            r.parseable_if_present("date_of_birth_raw", "date_of_birth",
                                   "date_of_birth unparseable: "),
        ),
    ), **heavy_options)


def heavy_loan_keys(raw: DataFrame, **heavy_options) -> list[HeavyKeys]:
    """Heavy loan ids and heavy borrowers of the raw loans, for the checks and for the mart."""
    keys = raw.select(*[fn.trim_spaces(c).alias(c) for c in ("loan_id", "borrower_id")])
    return heavy_keys(keys, ["loan_id"], ["borrower_id"], **heavy_options)


def check_loans(
    raw: DataFrame, borrowers: DataFrame, heavy: list[HeavyKeys] | None = None, **heavy_options
) -> DataFrame:
    """``borrowers`` are the passed ones: a loan of a quarantined borrower is quarantined too."""
    typed = _typed(
        raw,
        loan_id=fn.trim_spaces("loan_id"),
        borrower_id=fn.trim_spaces("borrower_id"),
        country=fn.upper_code("country"),
        branch=fn.blank_to_null("branch"),
        product=fn.blank_to_null("product"),
        currency=_currency(),
        principal=fn.parse_number("principal"),
        disbursed_at=fn.parse_timestamp("disbursed_at"),
        term_months=fn.parse_integer("term_months"),
        interest_rate_pct=fn.parse_number("interest_rate_pct"),
        status=fn.fold_prefix("status", LOAN_STATUS),
        cbs_fx_rate=fn.parse_number("cbs_fx_rate"),
        principal_usd_cbs=fn.parse_number("principal_usd_cbs"),
        loan_officer=fn.blank_to_null("loan_officer"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("loan_id",),
        order_by=tuple(latest_first("disbursed_at")),
        duplicate_reason="duplicate loan_id",
        references=(r.References("borrower_id", borrowers, "borrower_id", "borrower_found"),),
        rules=(
            r.required("loan_id", "missing loan_id"),
            r.required("borrower_id", "missing borrower_id"),
            r.found_in_parent(
                "borrower_id", "borrower_found",
                "borrower_id not found in valid cbs_borrowers (missing or quarantined upstream): "),
            r.allowed_values("country", COUNTRIES, "unrecognized country code: "),
            r.allowed_values("currency", CURRENCIES, "unrecognized currency: "),
            r.not_null("principal", "principal missing or unparseable"),
            r.positive("principal", "principal not positive"),
            r.not_null("disbursed_at", "disbursed_at missing or unparseable"),
            r.not_null("status", "unrecognized loan status"),
        ),
    ), heavy, **heavy_options)


def check_repayments(raw: DataFrame, loans: DataFrame, **heavy_options) -> DataFrame:
    """``loans`` are the passed ones; their country comes along as ``loan_country``."""
    typed = _typed(
        raw,
        txn_id=fn.trim_spaces("txn_id"),
        loan_id=fn.trim_spaces("loan_id"),
        paid_at=fn.parse_timestamp("paid_at"),
        amount=fn.parse_number("amount"),
        currency=_currency(),
        channel=fn.blank_to_null("channel"),
        reversal_of=fn.blank_to_null("reversal_of"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("txn_id",),
        order_by=tuple(latest_first("paid_at")),
        duplicate_reason="duplicate txn_id",
        references=(r.References("loan_id", loans, "loan_id", "loan_found", {"country": "loan_country"}),),
        rules=(
            r.required("txn_id", "missing txn_id"),
            r.required("loan_id", "missing loan_id"),
            r.found_in_parent(
                "loan_id", "loan_found",
                "loan_id not found in valid cbs_loans (missing or quarantined upstream): "),
            r.not_null("paid_at", "paid_at missing or unparseable"),
            r.not_null("amount", "amount missing or unparseable"),
            r.allowed_values("currency", CURRENCIES, "unrecognized currency: "),
            r.conditional_required(F.col("amount") < 0, "reversal_of",
                                   "negative amount without a reversal_of reference"),
            r.non_zero("amount", "zero amount transaction"),
        ),
    ), **heavy_options)


def check_rates(raw: DataFrame, **heavy_options) -> DataFrame:
    typed = _typed(
        raw,
        currency=_currency(),
        rate_date=fn.parse_cast_date("rate_date"),
        rate_type=F.lower(fn.trim_spaces("rate_type")),
        units_per_usd=fn.parse_number("units_per_usd"),
        source=fn.blank_to_null("source"),
        published_at=fn.parse_timestamp("published_at"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("currency", "rate_date", "rate_type"),
        order_by=tuple(latest_first("published_at")),
        duplicate_reason="duplicate (currency, rate_date, rate_type), kept latest published_at",
        rules=(
            r.allowed_values("currency", CURRENCIES, "unrecognized currency: "),
            r.not_null("rate_date", "rate_date missing or unparseable"),
            r.allowed_values("rate_type", RATE_TYPES, "unrecognized rate_type: "),
            r.missing_or_not_positive("units_per_usd", "units_per_usd missing or not positive"),
        ),
    ), **heavy_options)


def check_control_totals(raw: DataFrame, lookup: DataFrame, **heavy_options) -> DataFrame:
    """The reference names no order among duplicates; here the content decides."""
    typed = _typed(
        with_country_code(raw, lookup),
        country_raw=fn.trim_spaces("country"),
        country=F.col("country_code"),
        month=fn.trim_spaces("month"),
        currency=_currency(),
        loans_disbursed_count=fn.parse_integer("loans_disbursed_count"),
        loans_disbursed_amount=fn.parse_number("loans_disbursed_amount"),
        repayments_count=fn.parse_integer("repayments_count"),
        repayments_amount=fn.parse_number("repayments_amount"),
    )
    return r.validate(typed, r.RecordChecks(
        key=("country", "month", "currency"),
        duplicate_reason="duplicate (country, month, currency)",
        rules=(
            r.in_lookup("country_raw", "country", "unrecognized country: ", blank_ok=False),
            r.matches_regex("month", "^[0-9]{4}-[0-9]{2}$", "month not in YYYY-MM format: "),
            r.allowed_values("currency", CURRENCIES, "unrecognized currency: "),
            *[
                r.non_negative(measure, f"invalid {measure}")
                for measure in ("loans_disbursed_count", "loans_disbursed_amount",
                                "repayments_count", "repayments_amount")
            ],
        ),
    ), **heavy_options)


# ---- passed and quarantined rows -------------------------------------------------------------

QUARANTINE_COLUMNS = {
    "ims_clients": ("ims_client_id", "first_name", "last_name", "date_of_birth_raw", "country_raw"),
    "cbs_borrowers": ("borrower_id", "full_name", "country"),
    "cbs_loans": ("loan_id", "borrower_id", "country", "currency"),
    "cbs_repayments": ("txn_id", "loan_id", "currency"),
    "fx_rates": ("currency", "rate_date", "rate_type"),
    "cbs_control_totals": ("country_raw", "month", "currency"),
}


def staged(source: str, checked: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Passed rows under the contract's column names; excluded columns never got this far."""
    classes = CLASSIFICATION[SOURCE_FILES[source][0]]
    columns = [c for c in CONTRACTS[source].columns if classes[c] != "excluded"]
    rows = r.passed(checked, columns)
    if source == "ims_clients":
        rows = rows.withColumn("is_minor", fn.is_under_age("date_of_birth", as_of))
    return rows


def quarantined(source: str, checked: DataFrame, stamp: bool = True) -> DataFrame:
    return r.quarantine(checked, QUARANTINE_COLUMNS[source], stamp)


# ---- identity --------------------------------------------------------------------------------


def advisory_parties(clients: DataFrame) -> DataFrame:
    first_last = F.concat_ws(
        " ", F.coalesce("first_name", F.lit("")), F.coalesce("last_name", F.lit(""))
    )
    return clients.select(
        F.lit("ims").alias("source_system"), F.col("ims_client_id").alias("source_id"),
        fn.name_key(first_last).alias("name_key"), "date_of_birth", "country",
        F.col("id_document_number").alias("id_key"), F.col("phone_1").alias("phone_key"),
        F.col("sex").alias("gender_norm"), "is_minor",
    )


def banking_parties(borrowers: DataFrame) -> DataFrame:
    """Minors are only known to the advisory system."""
    return borrowers.select(
        F.lit("cbs").alias("source_system"), F.col("borrower_id").alias("source_id"),
        fn.name_key("full_name").alias("name_key"), "date_of_birth", "country",
        F.col("id_number").alias("id_key"), F.col("mobile_no").alias("phone_key"),
        F.col("gender").alias("gender_norm"), F.lit(False).alias("is_minor"),
    )


def matched_parties(clients: DataFrame, borrowers: DataFrame) -> DataFrame:
    """Both systems' passed records in one shape, with their match keys."""
    return add_match_key(advisory_parties(clients).unionByName(banking_parties(borrowers)))


# ---- conversion, marts, reconciliation -------------------------------------------------------


def official_rates(rates: DataFrame) -> DataFrame:
    return rates.filter((F.col("rate_type") == "official") & F.col("currency").isNotNull())


def convert_loans(loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Loans with the official rate of their disbursement day, or the earliest one, flagged."""
    dated = loans.withColumn("_disbursed_on", F.to_date("disbursed_at"))
    found = asof_calendar(
        dated, official_rates(rates), ["currency"], "_disbursed_on", "rate_date",
        ["units_per_usd"],
    )
    return found.drop("_disbursed_on").withColumnRenamed("is_estimated", "fx_rate_is_estimated")


def loan_fx(loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Which rate applies to each loan; loans in a currency without rates have no row."""
    return convert_loans(loans.select("loan_id", "currency", "disbursed_at"), rates).filter(
        F.col("rate_date").isNotNull()
    ).select("loan_id", "units_per_usd", "rate_date", "fx_rate_is_estimated")


def loan_mart(
    loans: DataFrame, links: DataFrame, rates: DataFrame, heavy: HeavyKeys | None = None
) -> DataFrame:
    """One row per loan with its identity and USD amount. ``heavy`` are heavy borrowers, measured
    here unless given."""
    if heavy is None:
        (heavy,) = heavy_keys(loans, ["borrower_id"])
    banking = links.filter(F.col("source_system") == "cbs").select(
        F.col("source_id").alias("borrower_id"), "enterprise_client_id", "is_minor"
    )
    linked = lookup_join(loans, banking, ["borrower_id"], heavy)
    usd = fn.round_half_away(fn.safe_ratio("principal", "units_per_usd"))
    return convert_loans(linked, rates).select(
        "loan_id", "enterprise_client_id", "borrower_id", "country", "branch", "product",
        "currency",
        F.col("principal").alias("principal_local"),
        F.col("units_per_usd").alias("fx_rate_used"),
        F.col("rate_date").alias("fx_rate_date"),
        "fx_rate_is_estimated",
        usd.alias("principal_usd"),
        "disbursed_at", "term_months", "interest_rate_pct", "status", "loan_officer",
        F.coalesce("is_minor", F.lit(False)).alias("borrower_linked_to_minor_record"),
    )


def period_summary(mart: DataFrame, ordered: bool = True) -> DataFrame:
    """Country, month and currency totals; no personal column. Amounts are rounded per loan first.

    Distinct clients are counted on (group, client) pairs, which combine before the shuffle.
    """
    month = fn.month_of("disbursed_at").alias("month")
    summary = mart.groupBy("country", month, "currency").agg(
        F.count("*").alias("loans_disbursed_count"),
        fn.round_half_away(fn.exact_sum("principal_local")).alias("loans_disbursed_local"),
        fn.round_half_away(fn.exact_sum("principal_usd")).alias("loans_disbursed_usd"),
        fn.round_half_away(fn.exact_avg("principal_usd")).alias("avg_loan_size_usd"),
        F.count_if(F.col("status") == "active").alias("active_loans_count"),
        F.count_if(F.col("status") == "closed").alias("closed_loans_count"),
        F.countDistinct("enterprise_client_id").alias("distinct_clients_count"),
    )
    return _by_period(summary) if ordered else summary


PERIOD = ("country", "month", "currency")


def _by_period(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in PERIOD])


MEASURES = ("loans_count", "loans_amount", "repayments_count", "repayments_amount")


def loan_totals(loans: DataFrame) -> DataFrame:
    return loans.groupBy("country", fn.month_of("disbursed_at").alias("month"), "currency").agg(
        F.count("*").alias("loans_count"), fn.exact_sum("principal").alias("loans_amount")
    )


def repayment_totals(repayments: DataFrame) -> DataFrame:
    """Totals by the loan's country, which passed repayments have from their check against the loans."""
    month = fn.month_of("paid_at").alias("month")
    return repayments.groupBy(F.col("loan_country").alias("country"), month, "currency").agg(
        F.count("*").alias("repayments_count"), fn.exact_sum("amount").alias("repayments_amount")
    )


def reconciliation(
    control: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    tolerance: float = TOLERANCE,
    ordered: bool = True,
) -> DataFrame:
    """``repayments`` are passed rows as ``check_repayments`` returns them, with the country of their loan."""
    published = control.withColumnsRenamed(
        {"loans_disbursed_count": "loans_count", "loans_disbursed_amount": "loans_amount"}
    )
    verdicts = reconcile(
        published, [loan_totals(loans), repayment_totals(repayments)], PERIOD, MEASURES,
        tolerance,
    )
    return _by_period(verdicts) if ordered else verdicts
