"""The pipeline stage by stage on the smallest tables, against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from sumstone.llm import mixing, quality
from sumstone.llm.common import freeze
from sumstone.llm.queries import quality_model, table
from sumstone.llm.tokens import encode
from test_operators import slow_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What goes into each stage, and what the last one returns."""
    docs = table(spark, sf_dir, "documents")
    extra = docs.limit(1).selectExpr(
        "900001L AS doc_id", "'12 34 !!' AS text", "lang", "source", "n_chars"
    ).unionByName(docs.limit(1).selectExpr("900002L AS doc_id", "CAST(NULL AS string) AS text", "lang", "source", "n_chars"))
    rows = [freeze(docs.unionByName(extra), "input")]
    for name, stage in corpus_pipeline.STAGES:
        rows.append(freeze(stage(spark, rows[-1], sf_dir), "stage"))
    return rows


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_are_named_and_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_only_texts_without_letters_have_no_language(stages):
    wanted = [r.doc_id for r in stages[0].collect() if any(c.isalpha() for c in r.text or "")]
    assert ids(stages[1]) == sorted(wanted) and 900001 not in wanted


def test_texts_stay_where_no_language_can_be_learned(spark, sf_dir, odd_documents):
    docs = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, docs, sf_dir)
    wanted = [r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(wanted)


def test_quality_keeps_what_the_score_accepts(spark, stages, sf_dir):
    model = quality_model(stages[1].select("doc_id", "text"), table(spark, sf_dir, "labels"))
    kept = quality.score(stages[1], "text", model).filter(f"score >= {0.3}")
    assert ids(stages[2]) == ids(kept)
    bad = {r.doc_id for r in table(spark, sf_dir, "labels").filter("quality = 0").collect()}
    good = {r.doc_id for r in table(spark, sf_dir, "labels").filter("quality = 1").collect()}
    before, after = set(ids(stages[1])), set(ids(stages[2]))
    assert len(after & bad) <= 0.2 * len(before & bad)
    assert len(after & good) >= 0.97 * len(before & good)


def test_one_document_of_each_group_stays(stages):
    docs = [(r.doc_id, r.text) for r in stages[2].collect()]
    groups = slow_groups(docs, 5, 80, 100)
    assert ids(stages[3]) == sorted({component for _, _, component in groups})
    assert len(ids(stages[3])) < len(docs)


def test_one_row_of_each_group_stays(spark, sf_dir, odd_documents):
    base = odd_documents.filter("doc_id = 1").first().text
    other = " ".join(f"river{i} stone{i % 5}" for i in range(40))
    nameless = " ".join(f"cloud{i} rain{i % 5}" for i in range(40))
    rows = [
        (1, base, "en", "c", 1),  # repeated id and text
        (1, base, "en", "a", 1),
        (None, base, "en", "a", 1),  # a copy without an id
        (2, other, "en", "a", 1),  # a clean text under the id of a near copy
        (None, nameless, "en", "a", 1),  # copies that all lack an id
        (None, nameless, "en", "a", 1),
    ]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd_documents.select(*columns)
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()
    odd = [(r.doc_id, r.text) for r in odd_documents.collect() if r.doc_id not in (2, 3, 8)]
    wanted = Counter([*odd, (8, "two words"), (2, other), (None, nameless)])
    assert Counter((r.doc_id, r.text) for r in kept) == wanted


def test_sources_are_mixed_to_their_weights(stages):
    given = stages[3].withColumn("w", mixing.word_count(stages[3].text)).collect()
    taken = Counter(ids(stages[4]))
    sizes, words = Counter(), Counter()
    for r in given:
        sizes[r.source] += r.w
        words[r.source] += r.w * taken[r.doc_id]
    names = sorted(sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    level = sum(sizes.values())
    assert max(taken.values()) <= 3 and set(taken) <= {r.doc_id for r in given}
    shares = {s: level * weight[s] / sum(weight.values()) for s in names}
    if all(shares[s] <= 3 * sizes[s] for s in names):
        assert all(abs(words[s] - shares[s]) <= 0.05 * shares[s] + 50 for s in names)
    assert sum(words.values()) == pytest.approx(level, rel=0.03)


def test_every_token_is_packed_once(stages):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [r.text for r in stages[4].collect()]
    pieces = stages[5].collect()
    assert sum(p.length for p in pieces) == len(encode(path, texts, 0)[0])
    held = Counter()
    for p in pieces:
        held[p.sequence_id] += p.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in held.values())


def test_run_chains_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 100


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    """Names that stages use inside are carried with their values."""
    docs = table(spark, sf_dir, "documents")
    own = ["size", "score", "lang_pred", "_row", "_copy", "_source", "target", "copies", "taken", "_order", "_words"]
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in own])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and kept.count() > 0
        wrong = F.lit(False)
        for c in own:
            wrong = wrong | ~F.col(c).eqNullSafe(F.concat(F.lit(c), F.col("doc_id")))
        assert kept.filter(wrong).count() == 0
