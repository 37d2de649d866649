"""A training corpus from raw documents: language, exact and near copies, mixture, packing.

Every stage is (name, function of (spark, docs, sf_dir)); ``run`` writes what a stage returns and
reads it again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.llm.common import stored, table, tidy
from swipeline.llm.exact import exact_dedup, halves
from swipeline.llm.language import fit, reject_unknown
from swipeline.llm.minhash import similar_groups
from swipeline.llm.mixing import mix, words_in
from swipeline.llm.packing import pack
from swipeline.llm.queries import tokenizer_path

_SPACE = r"[\x20\x09-\x0D]+"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; what it rejects has no letter or no text.

    If no row is labelled, all texts with a letter stay. Repeated rows are judged alike.
    """
    return reject_unknown(docs, fit(docs))


def _sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _one_of_each(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``marks`` (text_sha256, keep_id, gone) rules out.

    Texts without a mark stay; of a text that is not gone one row with its ``keep_id``; of several such
    rows the least by all columns. Whole rows are held as one value, so no column of theirs can
    clash, and move once: they are joined with the narrow marks and stored.
    """
    row = F.struct(*docs.columns)
    whole = docs.select(row.alias("row"), _sha(F.col("text")).alias("text_sha256"))
    marked = whole.join(marks.withColumn("several", F.lit(True)), "text_sha256", "left")
    tidy(docs.sparkSession)
    stays = F.col("several").isNull() | (~F.col("gone") & F.col("row.doc_id").eqNullSafe(F.col("keep_id")))
    left = stored(marked.where(stays).select("row", "text_sha256", F.coalesce("several", F.lit(False)).alias("several")), "kept")
    least = left.where("several").groupBy("text_sha256").agg(F.min("row").alias("row"))
    return left.where("not several").select("row.*").union(least.select("row.*"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the largest doc_id; one without a doc_id only if all are.

    Null counts as the empty text. Rows that agree in text and doc_id leave the least of them by their
    other columns. An empty table stays empty; whole texts of any length are compared.
    """
    history, incoming = halves(docs)
    classes = exact_dedup(incoming, history).where("group_size > 1").select("text_sha256", "keep_id").distinct()
    return _one_of_each(docs, classes.withColumn("gone", F.lit(False)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose sets of five-word shingles are alike to 0.8 or more, one row, with the smallest
    doc_id; one without a doc_id only if all are. Rows are told apart by their text, not their doc_id.
    SimHash groups of the same shingles propose copies first, MinHash what lies beyond their four bits.

    Null counts as the empty text; equal rows are one; an empty table stays empty.
    """
    groups = stored(similar_groups(docs), "groups")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    first = groups.groupBy("part").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = groups.join(first, "part").where("digest <> first.digest").select(F.lower(F.hex("digest")).alias("text_sha256"))
    texts = docs.select("doc_id", _sha(F.col("text")).alias("text_sha256")).groupBy("text_sha256")
    again = texts.agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    marks = again.join(gone, "text_sha256", "left_anti").withColumn("gone", F.lit(False))
    return _one_of_each(docs, marks.union(gone.select("text_sha256", F.lit(None).cast("long"), F.lit(True))))


def first_words(text: Column, count: Column) -> Column:
    """``text`` up to its word number ``count``, which is less than it has."""
    body = F.regexp_replace(text, "^" + _SPACE, "")
    rest = F.element_at(F.split(body, _SPACE, count + 1), -1)
    return F.regexp_replace(F.left(body, F.length(body) - F.length(rest)), _SPACE + "$", "")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, and where it takes a part, the part's words.

    Rows are told apart by a hash of their doc_id, source and text, so null and repeated ids are as good
    as others; rows that agree in all three are taken alike.
    """
    key = F.xxhash64(F.struct("doc_id", "source", "text"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), key.alias("doc_id"), "source", "text")
    mixed = mix(keyed.drop("row"))
    taken = mixed.where("taken > 0").groupBy("doc_id", "size").agg(F.max("taken").alias("taken"))
    rows = (
        keyed.withColumn("size", words_in())
        .join(taken, ["doc_id", "size"])
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
        .withColumn("left", (F.col("taken") - (F.col("nth") - 1) * F.col("size")).cast("int"))
    )
    part = F.col("left") < F.col("size")
    text = F.when(part, first_words(F.col("text"), F.col("left"))).otherwise(F.col("text"))
    cut = rows.withColumn("text", text).withColumn("part", part)
    counted = F.when(F.col("part"), F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select(F.col("row").withField("text", F.col("text")).withField("n_chars", counted).alias("row")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as sequences of 4096 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing),
]

#: The stages use models and hashes that DuckDB lacks; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
