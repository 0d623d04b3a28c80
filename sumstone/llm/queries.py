"""The operators of this package bound to the tables: ``opN_<name>``.

A ``None`` beside a query says that SQL cannot express it; its test compares with brute force.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm import (
    alignment,
    chat,
    fingerprint,
    language,
    mixing,
    neighbour_search,
    neighbours,
    packing,
    periodic,
    quality,
    sharding,
    similarity,
    token_counts,
    wavelet,
)
from sumstone.llm.common import held_out
from sumstone.llm.periodic import Run, collapse
from sumstone.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SHARDS = 24


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


@query
def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by the jump hash of ``doc_id`` (law ``key``)."""
    payload = {
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long"),
        "text_crc32": crc_of(F.col("text")),
        "law": F.lit("key"),
    }
    out = sharding.shard(table(spark, sf_dir, "documents"), "doc_id", SHARDS, payload)
    return out.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard",
    )


def language_model(docs: DataFrame) -> dict:
    """Learned from the rows that are not held out; their ids only choose the sample."""
    training = docs.filter(~held_out(F.col("doc_id")))
    return language.train(training, "text", "lang", F.struct("doc_id", "text"))


@query
def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by the shortest code of its whole text."""
    docs = table(spark, sf_dir, "documents")
    given = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return language.identify(given, "text", language_model(docs), ["doc_id", "held_out"])


def quality_model(docs: DataFrame, labels: DataFrame) -> dict:
    """Learned from labels of rows that are not held out."""
    training = labels.filter(~held_out(F.col("doc_id")))
    return quality.fit(docs, training, "text", "doc_id", "quality")


@query
def op4_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chance that each document is of good quality."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    given = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    scored = quality.score(given, "text", model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", quality.accepted(F.col("score")))


def vocabulary(name: str) -> str:
    """A public tokenizer file; every executor has the same installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    tokenizer = vocabulary("byte_bpe_50k.json")
    pieces = packing.pack(docs, "doc_id", "text", tokenizer, end=0, words=1_000_000)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query
def op8_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as wavelet matrix files in ascending id order, and read back."""
    folder = scratch_path(spark, "waves")
    docs = table(spark, sf_dir, "documents")
    tokenizer = vocabulary("word_bpe_49k.json")
    manifest = wavelet.write_shards(docs, "doc_id", "text", tokenizer, 2, folder)
    back = wavelet.read_shards(spark, manifest, folder, "doc_id")
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(sized, "doc_id", "source", F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op9_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles overlap by nine tenths."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity.near_groups(docs, "doc_id", "text", words=3, num=90, den=100)


ORACLES["op9_signature_trees"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM e a JOIN e b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(d, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.d, k.b FROM r JOIN both_ways k ON r.c = k.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id
FROM n JOIN r ON r.d = n.doc_id GROUP BY ALL
"""


@query
def op5_paragraph_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = neighbours.with_next(docs, "doc_id", "text")
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", 1, n - tail), F.substring("next_text", 1, tail))
    versions = paired.withColumns({"n_chars": n.cast("long"), "edited": edited})
    versions = versions.withColumn("edited_sha256", F.sha2("edited", 256))
    return fingerprint.compare_versions(
        versions,
        {"fingerprint": "text", "edited_fingerprint": "edited"},
        {"near_edited": ("text", "edited"), "near_next": ("text", "next_text")},
        ["doc_id", "n_chars", "edited_sha256"],
    )


@query
def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbour_search.search(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


@query
def op2_prefix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that speaks in control strings, read back from prefix trees."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    two = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")),
                            F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    extra = spark.range(1).select(F.lit(-1).alias("conv_id"), two.alias("t")).select(
        "conv_id", "t.turn", "t.role", F.lit(said).alias("text")
    )
    nodes, members = chat.format_trees(turns.unionByName(extra), "conv_id", "turn", "role", "text")
    back = chat.read_back(nodes, members, "conv_id")
    told = F.pandas_udf(chat.digests, chat.DIGESTS)
    return back.select("conv_id", told("formatted", "loss").alias("d")).select("conv_id", "d.*")


#: A document with more tokens is over the limit.
TOKEN_LIMIT = 4096


@query
def op13_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document by the compiled transducer."""
    docs = table(spark, sf_dir, "documents")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    given = docs.select("doc_id", "text", n_bytes)
    told = token_counts.count_tokens(
        given, "text", vocabulary("piece_bpe_32k.model"), ["doc_id", "n_bytes"]
    )
    return told.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def repeated_tail(key: tuple, words: list[bytes]) -> list[bytes]:
    """The words of a document, or of every tenth (by the crc32 of its id) with a periodic tail."""
    if key[0] is None or not words:
        return words
    h = zlib.crc32(str(key[0]).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]


RUN_DIGESTS = StructType()
for _name in ("n_runs", "start", "length", "period", "exponent_milli"):
    RUN_DIGESTS.add(_name, "long")
RUN_DIGESTS.add("runs_sha256", "string").add("collapsed_sha256", "string")


def run_digests(words: list[bytes], runs: list[Run]) -> tuple:
    """Number of runs, the run of the greatest exponent, digests of all runs and of what stays."""
    best: tuple = (None,) * 4
    if runs:
        start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = b" ".join(collapse(words, runs))
    digests = (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    return len(runs), *best, *digests


@query
def op11_periodic_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, and the document without its repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.with_runs(
        docs, "text", ["doc_id"], run_digests, RUN_DIGESTS, edit=repeated_tail
    )


@query
def op12_aligned_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over the same bytes, and how usual their links are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    _, counts = alignment.count_links(docs, "text", *files)
    return alignment.align(docs, "text", ["doc_id"], *files, counts, digest=True)
