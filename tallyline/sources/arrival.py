"""Arrival gate: which incoming CSV files may be loaded, and their rows.

The files of a source are rows: the names in Spark's own file index, joined to what one splittable text pass finds
per file (the header line, the number of records and whether any quoted value spans lines). Grouping by file
combines on the map side, so one huge file costs no more than many small ones. Files are known by
their whole path. Verdicts are set operations on the header: each file is held against every version of its source's
contract and judged by the one it comes closest to. Accepted files are then read grouped by
header, because one CSV scan over files with different column orders would silently swap columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.operators.privacy import CLASSES, tag_columns
from tallyline.sources.contracts import Contract, union_versions
from tallyline.sources.store import scratch_root

LOG_SCHEMA = (
    "checked_at timestamp, source string, file string, contract_version int, status string, "
    "row_count long, columns_dropped_excluded int, reason string"
)
PROFILE = (
    ("uri", "string"), ("path", "string"), ("file", "string"), ("header", "array<string>"),
    ("header_split", "boolean"), ("n_split", "long"), ("n_bad", "long"), ("row_count", "long"),
)
LISTED = 10_000
CHUNK = 1 << 16
_COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_NO_FILE = "no file found matching this source's pattern"


def _place(folder: str, match: str) -> tuple[str, str, int]:
    """Folder (or glob of folders) to read, file pattern, and levels of the path that name a file."""
    above, _, pattern = match.rpartition("/")
    return (f"{folder}/{above}" if above else folder), pattern, match.count("/") + 1


def _uri(path: Column) -> Column:
    """A file's path as the metadata of a scan has it: without an empty authority."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/{3,}", "$1:/")


def _decoded(uri: Column) -> Column:
    """Most paths have nothing to decode, which is cheaper to see in every row."""
    return F.when(F.contains(uri, F.lit("%")), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def list_files(spark: SparkSession, folder: str, match: str) -> DataFrame:
    """(uri, path, file) of the files that match, empty ones included; no file is opened.

    ``file`` is the part of the path that ``match`` describes, so equal names in two subfolders differ.
    """
    where, pattern, levels = _place(folder, match)
    try:
        index = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(where)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        names = spark.createDataFrame([], "value string")
    else:  # a scan leaves out empty files, the index does not
        names = spark.createDataFrame(index.inputFiles(), "string")
    path = _decoded(F.col("uri"))
    return names.select(_uri(F.col("value")).alias("uri")).select(
        "uri", path.alias("path"), F.substring_index(path, "/", -levels).alias("file"))


def _quotes(line: Column) -> Column:
    """Number of quotes, counted in bytes: a line need not be valid UTF-8."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))


def _lines(reader: DataFrameReader, paths: str | list[str]) -> DataFrame:
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        "value",
        _quotes(F.col("value")).alias("quotes"),
    )


def _of_files(
    spark: SparkSession, folder: str, match: str, files: DataFrame,
    read: Callable[[DataFrameReader, str | list[str]], DataFrame],
) -> DataFrame:
    """``read`` of the given ``files`` (uri, path) alone; its rows have their ``uri``.

    Up to ``LISTED`` files are named to the reader. Beyond that the folder is read and rows of other files are left out.
    """
    where, pattern, _ = _place(folder, match)
    few = files.select("path").limit(LISTED + 1).collect()
    if len(few) <= LISTED:
        return read(spark.read, [row["path"] for row in few])
    rows = read(spark.read.option("pathGlobFilter", pattern), where)
    return rows.join(files.select("uri"), "uri", "left_semi")


def file_profiles(spark: SparkSession, folder: str, match: str) -> DataFrame:
    """Per file with any line: header names, records below the header, whether any line has odd quotes, bad characters.

    That some line has odd quotes is kept as a set, not as a number, because an aggregate with a collection hashes its files; without one
    Spark would sort all lines by file for the sake of the header's text.
    """
    where, pattern, _ = _place(folder, match)
    first_line = F.when(F.col("block") == 0, F.struct("position", "value"))
    per_file = _lines(spark.read.option("pathGlobFilter", pattern), where).groupBy("uri").agg(
        F.min(first_line).alias("first"),
        F.count_if(F.trim("value") != "").alias("n_lines"),
        F.size(F.collect_set(F.when(F.col("quotes") % 2 == 1, F.lit(True)))).cast("long").alias("n_split"),
        F.count_if(~F.is_valid_utf8("value")).alias("n_bad"),
    )
    header_line = F.regexp_replace("first.value", "^\\uFEFF", "")
    names = F.transform(
        F.split(header_line, _COMMA_OUTSIDE_QUOTES),
        lambda c: F.replace(F.regexp_replace(F.trim(c), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')),
    )
    return per_file.select(
        "uri",
        F.transform(names, lambda c: F.trim(c)).alias("header"),
        (_quotes(header_line) % 2 == 1).alias("header_split"),
        "n_split",
        "n_bad",
        (F.col("n_lines") - 1).alias("row_count"),
    )


def spanning_counts(
    spark: SparkSession, folder: str, match: str, files: DataFrame
) -> DataFrame:
    """(uri, n): records below the header of ``files`` with quoted values that span lines.

    A record ends on a line after which an even number of quotes has been seen. Each run of ``CHUNK`` lines counts its
    lines for both cases, and the quotes of the runs before it tell which one holds, so a file is split like any other. A line takes
    part as one number, its place in the run with whether its quotes are odd and whether it is blank.
    """
    lines = _of_files(spark, folder, match, files, _lines)
    mark = F.col("position") % CHUNK * 4 + F.col("quotes") % 2 * 2 + (F.trim("value") == "").cast("int")
    runs = lines.groupBy(F.floor(F.col("position") / CHUNK).alias("run"), "uri", "block").agg(
        F.sort_array(F.collect_list(mark.cast("int"))).alias("marks"))

    def step(seen: Column, line: Column) -> Column:
        before, blank = seen["turn"], line.bitwiseAND(F.lit(1))
        after = before.bitwiseXOR(F.shiftright(line, 1).bitwiseAND(F.lit(1)))
        # a blank line between two records ends none
        ends = 1 - F.when(before == after, blank).otherwise(F.lit(0))
        return F.struct(
            after.alias("turn"), (seen["even"] + ends * (1 - after)).alias("even"), (seen["odd"] + ends * after).alias("odd"))

    start = F.struct(*[F.lit(0).alias(c) for c in ("turn", "even", "odd")])
    counts = runs.select("uri", "block", "run", F.aggregate("marks", start, step).alias("c")).select("uri", "block", "run", "c.*")
    ahead = W.partitionBy("uri").orderBy("block", "run").rowsBetween(W.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turn").over(ahead), F.lit(0)) % 2
    counted = counts.withColumn("n", F.when(turned == 0, F.col("even")).otherwise(F.col("odd")))
    return counted.groupBy("uri").agg((F.sum("n") - 1).alias("n"))


def _read_csv(
    reader: DataFrameReader, paths: str | list[str], header: Sequence[str], multi_line: bool, keep: Sequence[str]
) -> DataFrame:
    reader = reader.options(header=True, escape='"', multiLine=multi_line, inferSchema=False)
    rows = reader.schema(", ".join(f"`{c}` string" for c in header)).csv(paths)
    return rows.select(*keep, F.col("_metadata.file_path").alias("uri"))


def _list_text(names: Column) -> Column:
    quoted = F.transform(names, lambda c: F.concat(F.lit("'"), c, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def _names(columns: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns]).cast("array<string>")


def _against(version: Contract, place: int) -> Column:
    """How many columns of a header differ from a version, and how."""
    header = F.col("header")
    missing, extra = F.array_except(_names(version.columns), header), F.array_except(header, _names(version.columns))
    lists = F.concat_ws(
        "; ",
        F.when(F.size(missing) > 0, F.concat(F.lit("missing columns "), _list_text(missing))),
        F.when(F.size(extra) > 0, F.concat(F.lit("unexpected columns "), _list_text(extra))),
    )
    text = F.concat(F.lit(f"header does not match contract v{version.version}: "), lists)
    return F.struct(
        (F.size(missing) + F.size(extra)).alias("differences"), F.lit(place).alias("place"),
        F.lit(version.version).alias("version"), F.when(lists != "", text).alias("mismatch"))


def judge(profiles: DataFrame, versions: Sequence[Contract], classes: Mapping[str, str] | None) -> DataFrame:
    """Verdict per file: ``contract_version``, ``status``, ``row_count``, ``columns_dropped_excluded``, ``reason``.

    ``profiles`` holds uri, path and file and, where the file has any line, header and counts. A file answers to the
    version whose columns its header comes closest to, of equally close ones the first. A row without uri stands for a source
    without files.
    """
    header = F.col("header")
    classified = _names(list(classes or {}))
    excluded = _names([c for c, cls in (classes or {}).items() if cls == "excluded"])
    unclassified = F.array_except(header, classified)
    nearest = F.array_min(F.array(*[_against(v, place) for place, v in enumerate(versions)]))
    judged = profiles.withColumn("_near", F.when(header.isNotNull(), nearest))
    absent = F.when(F.col("uri").isNull(), _NO_FILE)
    if classes is None:
        reason = F.coalesce(absent, F.lit(f"no classification entry found for '{versions[0].match}'"))
        counted = F.lit(False)
    else:
        unreadable = (
            F.when(header.isNull(), "could not read file: it is empty")
            .when(F.col("n_bad") > 0, "could not read file: invalid UTF-8")
            .when(F.col("header_split"), "could not read file: header spans lines")
        )
        repeated = F.when(F.size(F.array_distinct(header)) < F.size(header),
                          "header repeats a column name")
        unknown = F.when(F.size(unclassified) > 0,
                         F.concat(F.lit("columns not classified: "), _list_text(unclassified)))
        reason = F.coalesce(absent, unreadable, F.col("_near.mismatch"), repeated, unknown, F.lit(""))
        counted = unreadable.isNull()
    passed = reason == ""
    return judged.select(
        "uri",
        "path",
        "file",
        F.coalesce("_near.version", F.lit(versions[0].version)).alias("contract_version"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        F.when(counted, F.col("row_count")).alias("row_count"),
        F.when(passed, F.size(F.array_intersect(header, excluded))).otherwise(0)
        .alias("columns_dropped_excluded"),
        reason.alias("reason"),
        "header",
        (F.col("n_split") > 0).alias("multi_line"),
    )


def check_source(
    spark: SparkSession, folder: str, versions: Contract | Sequence[Contract], classes: Mapping[str, str] | None
) -> DataFrame:
    """Verdicts on the files of one source, by the versions of its contract; one row with the pattern for a file when
    no file matches.

    The profiles, one short row per file, are written once to the shared scratch folder: what looks at the verdicts does not
    scan the files again.
    """
    versions = [versions] if isinstance(versions, Contract) else list(versions)
    match = versions[0].match
    files = list_files(spark, folder, match)
    if files.isEmpty():
        return judge(spark.createDataFrame([(match,)], "file string").select(
            *[F.col(n) if n == "file" else F.lit(None).cast(kind).alias(n) for n, kind in PROFILE]), versions, classes)
    found = files.join(file_profiles(spark, folder, match), "uri", "left")
    kept = f"{scratch_root(spark)}/profiles"
    found.write.parquet(kept)
    profiles = spark.read.schema(found.schema).parquet(kept)
    spanning = profiles.filter("n_split > 0").select("uri", "path")
    if not spanning.isEmpty():
        exact = spanning_counts(spark, folder, match, spanning)
        profiles = profiles.join(exact, "uri", "left").withColumn("row_count", F.coalesce("n", "row_count")).drop("n")
    return judge(profiles, versions, classes)


def load_accepted(
    spark: SparkSession, folder: str, verdicts: DataFrame, versions: Contract | Sequence[Contract],
    classes: Mapping[str, str],
) -> DataFrame | None:
    """Rows of the accepted files: strings, excluded columns never read, plus file and load time.

    Rows of several versions stand under the names of the first one; a column that a version lacks is null. A renamed column
    has the more protected class of both names.
    """
    versions = [versions] if isinstance(versions, Contract) else list(versions)
    match = versions[0].match
    levels = match.count("/") + 1
    accepted = verdicts.filter("status = 'PASS'")
    # as many rows as there are different headers
    headers = accepted.groupBy("contract_version", "header", "multi_line").count().collect()
    parts = []
    for version in versions:
        keep = [c for c in version.columns if classes.get(c) != "excluded"]
        mine = [
            _of_files(
                spark, folder, match,
                accepted.filter((F.col("contract_version") == version.version) & (F.col("header") == _names(h["header"]))
                                & (F.col("multi_line") == h["multi_line"])),
                lambda reader, paths, h=h, keep=keep: _read_csv(reader, paths, h["header"], h["multi_line"], keep))
            for h in headers if h["contract_version"] == version.version
        ]
        if mine:
            parts.append((version, reduce(DataFrame.unionByName, mine)))
    if not parts:
        return None
    rows = union_versions(parts, {c for version in versions for c in version.optional})
    rows = rows.withColumn("_source_file", F.substring_index(_decoded(F.col("uri")), "/", -levels)).drop("uri")
    known = dict(classes)
    for old, new in (pair for version in versions for pair in version.renames.items()):
        known[new] = max(known.get(new, CLASSES[0]), known.get(old, CLASSES[0]), key=CLASSES.index)
    return tag_columns(rows.withColumn("_loaded_at", F.current_timestamp()), known)


def arrival_check(
    spark: SparkSession,
    folder: str,
    contracts: Sequence[Contract],
    classification: Mapping[str, Mapping[str, str]],
    checked_at: dt.datetime | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Check every source of ``folder``.

    Returns the log rows, one per file (or per source without a file), and the accepted rows per
    source. A source that fails has no entry: what was loaded before stays in service. Contracts of one source are its versions,
    the one whose names are used downstream first.
    ``classification`` is keyed by the contracts' ``match`` pattern.
    """
    stamp = F.lit(checked_at) if checked_at else F.current_timestamp()
    by_source: dict[str, list[Contract]] = {}
    for contract in contracts:
        by_source.setdefault(contract.source, []).append(contract)
    logs, accepted = [], {}
    for source, versions in by_source.items():
        classes = classification.get(versions[0].match)
        verdicts = check_source(spark, folder, versions, classes)
        if classes is not None:
            rows = load_accepted(spark, folder, verdicts, versions, classes)
            if rows is not None:
                accepted[source] = rows
        logs.append(
            verdicts.select(
                stamp.cast("timestamp").alias("checked_at"),
                F.lit(source).alias("source"),
                "file", "contract_version",
                "status", "row_count", "columns_dropped_excluded", "reason",
            )
        )
    return reduce(DataFrame.unionByName, logs), accepted
