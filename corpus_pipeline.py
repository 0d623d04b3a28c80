"""From raw documents to packed training sequences, in five stages.

Each stage takes all rows that the one before it kept and returns the columns of ``documents``; the
last one returns the pieces of the sequences.  ``run`` writes what a stage returns and reads it back
for the next, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumstone.llm import language, mixing, packing, quality, similarity
from sumstone.llm.common import freeze
from sumstone.llm.queries import language_model, quality_model, table, vocabulary

#: Documents are near duplicates if they share this much of their runs of so many words.
SHINGLE_WORDS, SIMILAR, OUT_OF = 5, 80, 100


def by_place(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns renamed by place, and the new name of each.

    A stage may then add columns of any name; ``toDF(*docs.columns)`` gives the names back.
    """
    new = {name: f"_c{i}_" for i, name in enumerate(docs.columns)}
    return docs.toDF(*new.values()), new


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: those with no letter, null and empty texts.

    Where no row is labelled nothing can be learned, and every text with a letter stays.
    """
    model = language_model(docs)
    if not model["languages"]:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    plain, at = by_place(docs)
    found = language.identify(plain, at["text"], model)
    kept = found.filter(F.col("lang_pred") != language.UNDETERMINED)
    return kept.select(*plain.columns).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are hardly of good quality."""
    model = quality_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    plain, at = by_place(docs)
    scored = quality.score(plain, at["text"], model)
    kept = scored.filter(quality.accepted(F.col("score")) == 1)
    return kept.select(*plain.columns).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: the one with the smallest id.

    Rows with one id are told apart by a frozen row number, the smallest stays; a row without an id
    stays only if no row of its group has one.
    """
    plain, at = by_place(docs)
    rows = freeze(plain.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    id_ = F.col(at["doc_id"])
    order = F.struct(id_.isNull().alias("no_id"), id_.alias("id"), F.col("_row").alias("row"))
    keyed = rows.select(order.alias("_order"), F.col(at["text"]).alias("text"))
    groups = similarity.near_groups(keyed, "_order", "text", SHINGLE_WORDS, SIMILAR, OUT_OF)
    others = groups.filter("component_id.row <> _order.row").select(F.col("_order.row").alias("_row"))
    others = freeze(others, "near-copies")
    # Most documents are no near copy for certain and need not move to be told so.
    maybe = F.coalesce(similarity.key_filter(others)(F.xxhash64("_row")), F.lit(False))
    unsure = rows.filter(maybe).join(others, "_row", "left_anti")
    kept = rows.filter(~maybe).unionByName(unsure.select(*rows.columns))
    return kept.select(*plain.columns).toDF(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the weight of its source asks, none up to three times."""
    plain, at = by_place(docs)
    counted = mixing.mix(plain, at["doc_id"], at["source"], mixing.word_count(F.col(at["text"])))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    taken = counted.filter("copies > 0").withColumn("_copy", again)
    return taken.select(*plain.columns).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, cut and packed into sequences of 1024."""
    return packing.pack(docs, "doc_id", "text", vocabulary("byte_bpe_50k.json"), end=0)


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_sources),
    ("packing", packed),
]

#: SQL expresses none of the learned stages; the test follows the rows through the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = freeze(stage(spark, rows, sf_dir), f"stage-{number}")
    return rows
