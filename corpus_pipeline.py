"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and
returns a DataFrame; ``run`` writes each result as Parquet and reads it again for the next.
A stage takes NULLs in any column, empty and very long texts and rows that repeat; extra
columns of ``docs`` are left out, whatever their names. No documents: no rows.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.llm import mixing, near_dup, packing, quality, repeats
from millrace.llm.common import dropped, release, remove, saved, scratch_scope, tables_read


def _stage(function):
    """A stage that leaves no table in the shared folder but those its result reads.

    They are listed as the result's ``tables``, for whoever has written the result.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # the driver keeps the text of every plan and of each of its versions
        with scratch_scope() as made, session.conf_set(session.configure(spark), spark__sql__maxPlanStringLength="2000"):
            out = function(spark, docs, sf_dir)
        release()
        out.tables = tables_read(out, made)
        for path in made:
            if path not in out.tables and session.path_exists(spark, path):
                remove(spark, path)
        return out

    return run_stage


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@_stage
def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects.

    NULL and texts of fewer than 3 bytes stay; rows of equal text share their score.
    """
    scored = quality.score_quality(docs, carry=COLUMNS)
    return scored.where(F.col("_quality") >= quality.KEEP).select(*COLUMNS)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest id; documents without words stay.

    A document without an id gives way to any of its group that has one; of a group without
    ids one row for each text stays. Rows that repeat id and text are one document.
    """
    found = saved(near_dup.near_duplicates(docs), "pipeline-groups")
    # the document that names its component stands for it, not a copy without an id
    other = ~F.col("doc_id").eqNullSafe(F.col("_component"))
    kept = found.where("_n > 0 AND _component IS NOT NULL").groupBy("_component").agg(F.min_by("_th", F.struct(other, "_th")).alias("_kept_th"))
    # nameless components hold only rows without an id: one row for each text
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    docs = docs.select(*COLUMNS, F.xxhash64("text").alias("_th"), F.coalesce(worded, F.lit(False)).alias("_worded"))
    plain = docs.where("NOT _worded").select(*COLUMNS)
    stay = docs.where("_worded").join(kept, (docs["doc_id"] == kept["_component"]) & (docs["_th"] == kept["_kept_th"]))
    stay = stay.dropDuplicates(["doc_id", "_th"])  # of rows that repeat; the join has brought them together
    nameless = docs.where("_worded AND doc_id IS NULL")
    named = found.where("doc_id IS NULL AND _component IS NOT NULL").select(F.col("_th").alias("_named")).distinct()
    nameless = nameless.join(named, nameless["_th"] == named["_named"], "left_anti").dropDuplicates(["_th"])
    return stay.select(*COLUMNS).unionByName(nameless.select(*COLUMNS)).unionByName(plain)


@_stage
def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later copies of repeated byte strings; the first copy and whole characters stay.

    First is the smallest id, a document without one coming last. NULL stays NULL; rows that
    repeat id and text stay, each with what is left of the text.
    """
    cut = repeats.cut_repeats(docs, keep_first=True, characters=True)
    cut = saved(cut.select("id", "th", F.col("kept").cast("string").alias("_kept")), "pipeline-cut")
    whole = docs.select(*COLUMNS, *repeats.text_key()).join(cut, ["id", "th"], "left")
    text = F.coalesce("_kept", "text")
    n_chars = F.when(F.col("_kept").isNotNull(), F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return whole.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 times.

    NULL and texts without words are taken 0 times; a NULL source is a source; of rows that
    repeat each has its own copies.
    """
    mixed = mixing.mix(docs, carry=COLUMNS).where("_copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*COLUMNS)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, as placements of document pieces.

    NULL is an empty text: the end id alone; rows that repeat and rows without an id are packed
    each.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", reject_junk),
    ("near-duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeated_strings),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

# Classifier, registers and token ids have no SQL twin; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        past, docs = docs, saved(result, f"pipeline-{name.replace(' ', '-')}")
        for path in result.tables:
            remove(spark, path)
        if k:
            dropped(past)
    return docs
