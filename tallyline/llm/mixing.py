"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

The mix holds ``share`` times all words. Every source gets water in proportion to its weight; a source
that would pass ``epochs`` times its size is clamped there and its excess goes to the others by
weight, until none is above. A target of r times a source gives every document floor(r) whole
repetitions. The fractional repetition goes to documents in the order of a seeded hash, until the
target is met; the document at the edge gives the words still missing.

That order is never sorted as a whole: sizes are summed by source and hash bucket (``BUCKETS`` at most
a source), only the documents of the one bucket at the edge are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.order import running
from tallyline.llm.registry import query, table
from tallyline.llm.scratch import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 17
BUCKETS = 1 << 12
SALTS = 32
SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def _hash(doc_id: Column, seed: int) -> Column:
    """A number below 2**60 from an id; a null id has one of its own."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def fill(sources: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """``sources`` (_none, _name, source_size) with ``target``: rounds of clamping over one row a source."""
    spread = running(sources, [F.col("_none"), F.col("_name")], {"_rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table_ = stored(spread.withColumn("_weight", weight).withColumn("_cap", (F.col("source_size") * epochs).cast("double")))
    total = float(table_.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        over = F.col("_weight") * level > F.col("_cap")
        state = table_.agg(F.sum(F.when(over, F.col("_cap"))).alias("cap"), F.count(F.when(over, 1)).alias("n"),
                           F.sum(F.when(~over, F.col("_weight"))).alias("weight")).first()
        if state.n == clamped or not state.weight:
            break
        clamped = state.n
        level = (share * total - (state.cap or 0.0)) / state.weight
    return table_.select("_none", "_name", "source_size", F.least("_cap", F.col("_weight") * level).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED,
        text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """(row: all columns of ``docs``, size, source_size, target, whole, taken) for every row.

    ``taken`` counts the words the mix takes from the row, repeats included: ``whole`` times its size
    and what the fractional repetition adds. A null text has no words. A null source is a source, the
    last in order. Rows that share id and size share a fractional repetition evenly. Words of a source
    add up to its target but for less than a word a tied row. An empty table gives no rows.
    """
    def sized(df: DataFrame) -> DataFrame:
        h = _hash(F.col(doc_id), seed)
        return df.select(F.struct("*").alias("row"), F.col(source).isNull().alias("_none"),
                         F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_name"),
                         F.col(doc_id).alias("_id"), word_count(F.col(text)).alias("size"), h.alias("_h"))

    narrow = stored(sized(docs).drop("row"))
    bucket = F.shiftright("_h", 60 - (BUCKETS.bit_length() - 1))
    sums = stored(narrow.groupBy("_none", "_name", bucket.alias("_bucket")).agg(F.sum("size").alias("_sum")))
    targets = fill(sums.groupBy("_none", "_name").agg(F.sum("_sum").alias("source_size")), weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = (targets.withColumn("whole", whole)
               .withColumn("_extra", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")))
    before = Window.partitionBy("_none", "_name").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    edge = (reached.join(targets.select("_none", "_name", "_extra"), ["_none", "_name"])
            .where("_before < _extra and _before + _sum >= _extra")
            .select("_none", "_name", F.col("_bucket").alias("_edge"), (F.col("_extra") - F.col("_before")).alias("_rest")))
    plan = targets.join(edge, ["_none", "_name"], "left").withColumn("_edge", F.coalesce("_edge", F.lit(-1))).drop("_extra")
    plan = stored(plan)
    ties = (narrow.withColumn("_edge", bucket).join(plan.select("_none", "_name", "_edge", "_rest"), ["_none", "_name", "_edge"])
            .groupBy("_none", "_name", "_h", "_id", "size").agg(F.count("*").alias("_m"), F.max("_rest").alias("_rest")))
    line = Window.partitionBy("_none", "_name").orderBy("_h", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("_rest") - F.coalesce(F.sum(F.col("_m") * F.col("size")).over(line), F.lit(0))
    part = F.greatest(F.least(F.floor(missing / F.col("_m")), F.col("size")), F.lit(0)).cast("long")
    ties = stored(ties.select("_none", "_name", F.coalesce("_id", F.lit(-1)).alias("_k"), F.col("_id").isNull().alias("_n"),
                              "size", part.alias("_part")))
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = (sized(docs).withColumn("_salt", F.pmod("_h", F.lit(SALTS)).cast("int")).join(salted, ["_none", "_name", "_salt"])
           .withColumn("_k", F.coalesce("_id", F.lit(-1))).withColumn("_n", F.col("_id").isNull())
           .join(ties, ["_none", "_name", "_k", "_n", "size"], "left"))
    more = (F.when(bucket < F.col("_edge"), F.col("size")).when(bucket == F.col("_edge"), F.coalesce("_part", F.lit(0)))
            .otherwise(0))
    return out.select("row", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + more).alias("taken"))


def copies(mixed: DataFrame, columns: list[str], text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of a mix written out: one row a whole repetition, then the document at the edge cut to its words."""
    full = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.col("whole")).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    each = (mixed.withColumn("_rest", rest).withColumn("_copies", full + (rest > 0).cast("int")).where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))))
    words = F.regexp_extract_all(F.col(f"row.{text}"), F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    cut = (F.col("_copy") == F.col("_copies")) & (F.col("_rest") > 0)
    body = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.greatest("_rest", F.lit(1))), "")).otherwise(F.col(f"row.{text}"))
    kept = {text: body, n_chars: F.when(cut, F.length(body)).otherwise(F.col(f"row.{n_chars}")).cast("long")} if n_chars in columns else {text: body}
    return each.select(*[kept.get(c, F.col(f"row.{c}")).alias(c) for c in columns])


SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR || ':17'), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY source_size / w, source NULLS LAST) AS k,
         (1.5::DOUBLE * (SUM(source_size) OVER ())::DOUBLE
             - COALESCE(SUM(2 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / SUM(w) OVER (ORDER BY source_size / w, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
l AS (SELECT arg_min(level, k) AS level FROM r WHERE 2 * source_size >= w * level),
t AS (
  SELECT source, source_size, LEAST(2.0::DOUBLE * source_size, w * l.level)::DOUBLE AS target FROM s, l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole,
         floor(e.target - e.whole * e.source_size)::BIGINT
         - COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS missing
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (whole * size + GREATEST(0, LEAST(size, missing)))::BIGINT AS taken FROM o
"""


@query("op3_mixing", SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("row.doc_id", "size", "source_size", "target", "taken")
