"""The corpus pipeline: toxicity, near copies, repeated passages, source mix, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all rows that the
stage before it kept. ``run`` applies them to the documents of ``sf_dir``; each result is written as Parquet
in the session's checkpoint folder and read back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import mixing, pieces, signature_join, suffix_dedup, toxicity
from tallyline.llm.registry import table
from tallyline.llm.scratch import stored

#: No SQL states the stages; tests/llm holds them against plain versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model scores below one half; the model learns from the labels of ``sf_dir``.

    A null text counts as an empty one, which scores the model's bias; repeated rows are judged alike, and an empty table gives none.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, model).where(F.col("score") < 0.5)
    return scored.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents that five-word shingles link at a similarity of 0.8: that of the smallest id, of
    several rows with that id the one whose text has the smallest hash.

    A row that links with nothing stays, and so does a row with a null id. Rows are judged by id and text, so of rows
    that share an id each stands for itself; of rows that share id and text one stays.
    """
    ids = signature_join.groups(docs.select("doc_id", "text"), size=5, percent=80)
    linked = stored(ids.where("_id is not null and group is not null").select("group", F.struct("_id", "text_hash").alias("row")))
    first = linked.groupBy("group").agg(F.min("row").alias("first"))
    gone = stored(linked.join(first, "group").where("row <> first")
                  .select(F.col("row._id").alias("_gone"), F.col("row.text_hash").alias("_gone_hash")).distinct())
    same = (docs["doc_id"] == gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"])
    kept = docs.join(_small(gone), same, "left_anti")
    twice = stored(docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_twice")))
    again = kept["doc_id"] == twice["_twice"]
    alone = kept.join(_small(twice), again, "left_anti")
    return alone.unionByName(kept.join(_small(twice), again, "left_semi").dropDuplicates(["doc_id", "text"]))


def _small(ids: DataFrame) -> DataFrame:
    """Written ids, to be broadcast while they are few; beyond that the join shuffles."""
    return F.broadcast(ids) if ids.count() <= signature_join.BROADCAST_ROWS else ids


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that start earlier in the corpus; every document stays.

    What a cut leaves of a split character goes too. ``n_chars`` counts what is left.
    """
    marked = docs.withColumn("_no_text", F.col("text").isNull())
    others = [c for c in docs.columns if c != "text"]  # the text itself travels once, as bytes
    out = suffix_dedup.remove_repeats(marked, [*others, "_no_text"])
    left = F.col("kept").cast("string")
    valid = F.make_valid_utf8(left)
    whole = F.when(left.contains("\ufffd"), valid).otherwise(F.replace(valid, F.lit("\ufffd"), F.lit("")))
    out = out.withColumn("_text", F.when(F.col("row._no_text"), F.lit(None)).when(F.col("n_removed") == 0, left).otherwise(whole))
    new = {"text": F.col("_text")}
    if "n_chars" in others:
        new["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("_text")).cast("long")
    return out.select(*[new[c] if c in new else F.col(f"row.{c}") for c in docs.columns]).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a repetition that the mix takes; the document at the edge of a source is cut to its words.

    A null text or one without words goes as often as its source is repeated whole; a null source is a source of its own, the
    last one. Repeated rows are documents of their own, and an empty table gives no rows.
    """
    return mixing.copies(mixing.mix(docs), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best ids and N best paths of every text of the mix, a row each; a null text is empty, and an empty table gives no rows."""
    out = pieces.encode(docs, pieces.vocabulary_path(), keep=("doc_id", "source"))
    return out.select("row.doc_id", "row.source", "ids", "n_tokens", "score", "nbest", "decoded_equal")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
