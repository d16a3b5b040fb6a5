"""A training-data pipeline over ``documents``: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brakelight.llm import contam, idfiles, langid, mixing, neardup
from brakelight.llm.common import scratch_path, table
from brakelight.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row under a name that no column has.

    Stages read written tables: the key is the row's file (as a 64-bit hash) and its place in it, so it is the same in
    every job however the files are split. Rows that come from no file, as in tests, are numbered.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    try:
        at = docs.metadataColumn("_metadata")
        return docs.withColumn(name, F.concat_ws(":", F.hex(F.xxhash64(at["file_path"])), at["row_index"].cast("string"))), name
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id().cast("string")), name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or less than half of the letters in words that fit a learned one.

    Documents may mix languages. The model learns from the labelled rows of ``docs`` itself; where there is none, nothing can
    be judged and all rows stay. Null and empty texts have no letters; rows that repeat are judged alike.
    """
    model = langid.train(docs)
    if model is None:
        return docs
    keyed, row = _keyed(docs)
    found = langid.identify(keyed, model, id_col=row)
    good = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("fit") >= 0.5)).select(row)
    return keyed.join(good, row, "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class one row stays, that with the smallest doc_id (null last; of equal ids the first row).

    Null and empty texts are classes of their own rows. Rows are told apart by their key, so other classes' rows with the
    same or no doc_id are not affected.
    """
    keyed, row = _keyed(docs)
    # ids of one length sort as text like the numbers; "~" comes after them
    number = F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~"))
    texts = keyed.select(F.concat_ws(":", number, row).alias("key"), "text")
    kept = neardup.near_duplicates(texts, id_col="key").filter("kept").select(F.regexp_replace("key", "^[^:]*:", "").alias(row))
    return keyed.join(kept, row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark passages make up a twentieth or more of the words.

    Null and empty texts have no words and stay; rows that repeat are judged alike; without benchmark rows all stay.
    """
    keyed, row = _keyed(docs)
    found = contam.decontaminate(keyed, table(spark, sf_dir, "benchmark"), id_col=row)
    return keyed.join(found.filter("contaminated").select(row), row, "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop whole documents so that sources come near their target weights.

    The one document per source that the mix takes in part stays whole when at least half of it is taken. Documents without
    words add nothing to a mix measured in words and go; null sources are a source; rows that repeat are drawn on their own.
    """
    keyed, row = _keyed(docs)
    draws = mixing.mix(keyed, id_col=row, permute_by="doc_id").filter("2 * words >= size and words > 0")
    return keyed.join(draws.select(F.col("id").alias(row)), row).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mixed documents as id files and describe every document from the files (null text: the end id alone)."""
    path = scratch_path(spark, "pipeline-ids")
    # workers live on after the stage, so they keep less than op3's do
    idfiles.write_ids(docs, path, tokenizer_path("byte_bpe_50k.json"), cached_chunks=200_000)
    return idfiles.read_documents(spark, path, docs.schema["doc_id"].dataType)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("token_ids", token_ids)]

#: language models, sampling, shuffles by hash and tokenizers have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage is written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
