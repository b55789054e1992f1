"""From raw documents to token ids: five stages, each written before the next one reads it.

Every stage works on all that the one before it kept. All but the last return the columns of
``documents``. Rows that repeat a ``doc_id`` are one document and stay or go together; a NULL id is
never a copy of another. Columns beyond those of ``documents`` pass through the filters unchanged,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import bpe_table, contamination, language_id, ngram_join, substring_dedup
from ferryline.llm.queries import tokenizer_file
from ferryline.llm.registry import read
from ferryline.runtime import materialize


def _other_columns(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that their names clash with none."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")


def _as_before(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: list[str] | None = None) -> DataFrame:
    """Documents with letters, with the predicted language where theirs is NULL; texts without letters, empty and NULL ones go.

    ``wanted`` keeps only documents of these languages, stated or predicted. Where no document has a language, none is
    predicted and all texts with letters stay.
    """
    languages = language_id.prototypes(docs, "text", "lang")
    found = language_id.identify(_other_columns(docs), "text", languages, ["doc", "text"], "lettered").where("lettered")
    found = found.withColumn("doc", F.col("doc").withField("lang", F.coalesce("doc.lang", F.nullif("lang_pred", F.lit("und")))))
    if wanted is not None:
        found = found.where(F.col("doc.lang").isin(wanted))
    return _as_before(found, docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of exact or near copies."""
    found = ngram_join.near_copies(docs, "doc_id", "text")
    copies = materialize(found.where("class_id != doc_id").select("doc_id"), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; a text of which nothing is left goes."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    inner = docs.select(F.struct(*others).alias("doc"), "doc_id", "text")
    cut = substring_dedup.remove_repeats(inner, "doc_id", "text", ["doc"], spacing=True)
    left = cut.where("n_removed = 0 OR n_removed < n_words")
    new = left.select("doc.*", F.col("kept").alias("text"), F.length("kept").cast("long").alias("n_chars"))
    return new.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark passages."""
    items = read(spark, sf_dir, "benchmark")
    found = contamination.contaminated_words(_other_columns(docs), "text", ["doc", "text"], items, "item_id", "text")
    judged = found.select("doc", "text", "n_words", *contamination.figures())
    return _as_before(judged.where("NOT contaminated"), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to."""
    coded = bpe_table.encode_and_decode(docs, "doc_id", "text", tokenizer_file())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", known_language),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

#: No stage but the fourth has an equal in SQL; tests hold the operators against brute force, and the stages against sets of ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
