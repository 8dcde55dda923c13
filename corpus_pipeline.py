"""The document pipeline: stages applied in turn, each to what the one before kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.llm import ship_package
from daymark.llm.catalog import tokenizer_file
from daymark.llm.jaccard import jaccard_components
from daymark.llm.key_filter import key_filter, split
from daymark.llm.labelled import labelled_sample
from daymark.llm.mix import mix_sources
from daymark.llm.sentencepiece import encode_documents, load_model
from daymark.llm.spans import remove_repeated_passages
from daymark.llm.toxicity import fit_toxicity, score_toxicity
from daymark.session import shared_dir

TOXIC_AT = 0.3
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC_AT``; the lexicon is learned from
    up to 5000 labelled documents of each class.

    Null and empty texts have the score of a text without a match and stay, whole texts of
    any length are scored, repeated rows are judged alike, null ids and sources do not
    matter.  Columns beyond the five of ``documents`` are left out here.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(labelled_sample(docs.select("doc_id", "text"), labels, "toxic", F.lit(True), 5000))
    return score_toxicity(docs, model, score_col="__toxicity").where(F.col("__toxicity") < TOXIC_AT).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the one with the smallest id (a null id
    is the last), then the smallest text hash, then the other columns.  Rows that share an
    id are told apart by their texts, equal rows are copies.  Texts without words have no
    near copies, and all stay."""
    root = shared_dir(spark, "near-copies")
    jaccard_components(docs, row_keys=True).where("n_shingles > 0").write.parquet(f"{root}/linked")
    linked = spark.read.parquet(f"{root}/linked")
    least = linked.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least"))
    keys = linked.groupBy("doc_id", "text_hash", "component").agg(F.count("*").alias("n")).join(least, "component")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    # Rows of these keys go; of those that stay, one of several equal rows is put back.
    keys.withColumn("stays", stays).where("not stays or n > 1").select("doc_id", "text_hash", "stays").write.parquet(f"{root}/marked")
    marked = spark.read.parquet(f"{root}/marked")
    # Only rows that may be marked move to meet the marks; the filter tells most others.
    row_key = lambda text_hash: F.xxhash64("doc_id", text_hash)
    key_filter(marked.select(row_key("text_hash")).distinct()).write.parquet(f"{root}/held")
    may, others = split(docs.select(*COLUMNS, F.xxhash64("text").alias("__text_hash")), row_key("__text_hash"), spark.read.parquet(f"{root}/held"))
    d, m = may.alias("d"), marked.alias("m")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.__text_hash") == F.col("m.text_hash"))
    kept = others.select(*COLUMNS).union(d.join(m, same, "left_anti").select(*COLUMNS))
    if not marked.where("stays").take(1):
        return kept
    equal = d.join(m.where("stays"), same).select(*[F.col(f"d.{c}") for c in COLUMNS], "text_hash")
    rest = F.struct(*[c for c in COLUMNS if c != "doc_id"])
    one = equal.groupBy("doc_id", "text_hash").agg(F.min(rest).alias("row"))
    return kept.union(one.select(*[c if c == "doc_id" else F.col(f"row.{c}") for c in COLUMNS]))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occurred before; a document of which nothing is left goes.

    Null and empty texts stay as they are, with their ``n_chars``; rows equal in id and
    text lose the same passages; texts of any length are read whole.
    """
    cut = remove_repeated_passages(docs, local_cuts=True, both_sides=True).where("n_removed = 0 or n_removed < n_sentences")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice.  Of rows equal in
    id, source and text, those first by the other columns are taken more often.  Null and
    empty texts weigh nothing and are taken as their place in the order says; a null source
    is one like others, the last."""
    path = shared_dir(spark, "mix-taken")
    key = ["doc_id", "source", "text_hash"]
    times = lambda n: F.count_if(F.col("copies") >= n)
    mix_sources(docs).documents.groupBy(*key).agg(F.count("*").alias("n"), times(1).alias("once"), times(2).alias("twice")).where("once > 0").write.parquet(path)
    taken = spark.read.parquet(path)
    d, t = docs.select(*COLUMNS, F.xxhash64("text").alias("__text_hash")).alias("d"), taken.alias("t")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.__text_hash") == F.col("t.text_hash"))
    own = [F.col(f"d.{c}") for c in COLUMNS]
    alike = (F.col("once") == F.col("n")) & F.col("twice").isin(F.lit(0), F.col("n"))
    met = d.join(t.where(alike), same).select(*own, F.when(F.col("twice") > 0, 2).otherwise(1).alias("copies"))
    # Only where the mix ends within equal rows do some of them have fewer copies.
    if taken.where(~alike).take(1):
        place = F.row_number().over(Window.partitionBy("t.doc_id", "t.source", "t.text_hash").orderBy(*[f"d.{c}" for c in COLUMNS if c != "text"]))
        parted = d.join(t.where(~alike), same).select(*own, "once", "twice", place.alias("place"))
        copies = (F.col("place") <= F.col("once")).cast("int") + (F.col("place") <= F.col("twice")).cast("int")
        met = met.union(parted.withColumn("copies", copies).where("copies > 0").select(*COLUMNS, "copies"))
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their piece ids: an empty list for null and empty texts, whole
    texts of any length, equal texts alike.  A table without rows gives one without rows at every stage."""
    return encode_documents(docs, load_model(tokenizer_file("piece_bpe_32k.model")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    """The stage, with the package's source on the executors."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _shipped(drop_toxic)),
    ("near_copies", _shipped(keep_one_of_near_copies)),
    ("repeated_passages", _shipped(drop_repeated_passages)),
    ("mix", _shipped(mix)),
    ("sentencepiece", _shipped(encode)),
]

# The toxicity lexicon is learned and the pieces come from a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = shared_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{root}/{i}-{name}")
        docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
