"""The transducer against plain byte-pair merging and against the library."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from sumstone.llm import token_counts
from sumstone.llm.queries import op13_transducer_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def slow_count(text: str, pieces: dict[str, float]) -> int:
    symbols = list(text)
    while True:
        costs = [pieces.get(a + b, float("inf")) for a, b in zip(symbols, symbols[1:])]
        if not costs or min(costs) == float("inf"):
            break
        at = costs.index(min(costs))
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return sum(1 if s in pieces or len(s) > 1 else len(s.encode()) for s in symbols)


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("chunk", [1, 3, 96])
def test_random_vocabularies(seed, chunk, monkeypatch):
    """Any order of pieces, ties, pieces that are never reached, chunks of any length."""
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "AHEAD", min(chunk, 2))
    draw = random.Random(seed)
    letters = "abé" if seed % 2 else "ab"
    pieces = {c: 99.0 for c in letters if draw.random() < 0.7}
    for _ in range(draw.randrange(3, 30)):
        pieces["".join(draw.choice(letters) for _ in range(draw.randrange(2, 6)))] = draw.randrange(12)
    machine = token_counts.Transducer(pieces, marked_start=False)
    texts = ["".join(draw.choice(letters + "zß") if draw.random() < 0.03 else draw.choice(letters)
                     for _ in range(draw.randrange(0, 60))) for _ in range(120)]
    assert machine.count(texts).tolist() == [slow_count(t, pieces) for t in texts]


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(3)
    signs = "ab aaa \u2581<s></s>\n\t\r;()é中文\U0001f600inghe tr0123\0éﬁ"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(0, 300))) for _ in range(200)]
    texts += ["a" * n for n in (1, 15, 96, 97, 400)] + [" " * n for n in (1, 2, 15, 16, 17, 200)]
    return texts + ["</s>[INST] ok", "=-" * 300, "the " * 300, "中文" * 200]


def test_library(odd_texts):
    machine = token_counts.open_transducer(MODEL)
    wanted = [len(ids) for ids in SentencePieceProcessor(model_file=MODEL).encode(odd_texts)]
    assert machine.count(odd_texts).tolist() == wanted


@pytest.mark.parametrize("most", [400_000, 5])
def test_slices_carry_their_state(odd_texts, monkeypatch, most):
    """Slices end anywhere, and the machine may be compiled anew between them."""
    monkeypatch.setattr(token_counts, "SLICE", 37)
    monkeypatch.setattr(token_counts, "MOST_STATES", most)
    machine = token_counts.compile_pieces(MODEL)
    texts = [t for t in odd_texts if t]
    wanted = [len(ids) for ids in SentencePieceProcessor(model_file=MODEL).encode(texts)]
    assert [machine.count_long(t) for t in texts] == wanted


def test_other_files_are_refused():
    with pytest.raises((ValueError, OSError, RuntimeError)):
        token_counts.compile_pieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_odd_rows(odd_documents, no_documents):
    """Null and empty texts have no tokens, repeated rows stay, clashing names are carried."""
    told = token_counts.count_tokens(odd_documents, "text", MODEL, ["doc_id", "size", "score"], "tokens")
    assert told.columns == ["doc_id", "size", "score", "tokens"]
    library = SentencePieceProcessor(model_file=MODEL)
    wanted = Counter((r.doc_id, r["size"], len(library.encode(r.text or ""))) for r in odd_documents.collect())
    assert Counter((r.doc_id, r["size"], r.tokens) for r in told.collect()) == wanted
    assert token_counts.count_tokens(no_documents, "text", MODEL, ["doc_id"]).count() == 0


def test_query_counts_as_the_library_does(spark, sf_dir):
    library = SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    told = op13_transducer_counts(spark, sf_dir)
    assert dict(told.dtypes) == {
        "doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"
    }
    wanted = Counter()
    for r in docs:
        n = len(library.encode(r.text or ""))
        wanted[r.doc_id, len((r.text or "").encode()), n, n > 4096] += 1
    assert Counter(tuple(r) for r in told.collect()) == wanted
    assert told.filter(F.col("over_limit")).count() > 0
