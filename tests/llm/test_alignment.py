"""Alignment of two tokenizers against whole texts encoded by the libraries; pair tables by hand."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sumstone.llm import alignment, pair_table
from sumstone.llm.common import freeze
from sumstone.llm.queries import op12_aligned_tokenizers

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Slow:
    """Both tokenizers over whole texts, groups by byte offsets, counts over all texts."""

    def __init__(self) -> None:
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=FILES[1])
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        odd = [b for b in range(256) if b not in plain]
        self.letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        whole = (" " + text).encode()
        a_ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [bytes(self.letter[c] for c in self.a.id_to_token(i)) for i in a_ids]
        b_ids = self.b.encode(text)
        b = []
        for i in b_ids:
            piece = self.b.id_to_piece(i)
            b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode())
        if b"".join(a) != whole or b"".join(b) != whole:
            return []
        at_b = dict(zip(np.cumsum([len(x) for x in b]).tolist(), range(len(b))))
        out, end, first_a, first_b = [], 0, 0, 0
        for k, token in enumerate(a):
            end += len(token)
            if end in at_b:
                out.append((a_ids[first_a : k + 1], b_ids[first_b : at_b[end] + 1]))
                first_a, first_b = k + 1, at_b[end] + 1
        return out

    def rows(self, docs: list[tuple]) -> Counter:
        aligned = [(key, self.groups(text)) for key, text in docs]
        count = Counter((x[-1], y[-1]) for _, g in aligned for x, y in g)
        best: dict[int, int] = {}
        for (_, y), n in count.items():
            best[y] = max(best.get(y, 0), n)
        out = Counter()
        for key, g in aligned:
            links = [(x[-1], y[-1]) for x, y in g]
            told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            out[
                key, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links),
                sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), told,
            ] += 1
        return out


@pytest.fixture(scope="module")
def slow():
    return Slow()


def aligned(frame, carried, **options):
    _, counts = alignment.count_links(frame, "text", *FILES)
    return alignment.align(frame, "text", carried, *FILES, counts, **options)


def test_texts_of_all_kinds(spark, slow):
    draw = random.Random(4)
    signs = "ab the 's don't ▁ \n\n \t\r;()é中文\U0001f600ing 01 23\0\xa0\u3000\x1f.,"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(0, 60))) for _ in range(300)]
    texts += ["plain words, and more.\nA new line\nends", "ends \n", "\nstarts", " two  spaces ", " ", "\n",
              "</s><|endoftext|> said", "a\u2581b", "\u2581", "mark \u2581 x", "x\u00a0 y", "don't we'll"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    assert Counter(tuple(r) for r in aligned(frame, ["id"]).collect()) == slow.rows(list(enumerate(texts)))


def test_small_stores_and_parts(spark, slow, monkeypatch):
    """Units are forgotten and tallies added along the way; counts stay."""
    for name, value in (("KEPT", 3), ("_TEXT", 50), ("_PAIRS", 5)):
        monkeypatch.setattr(alignment, name, value)
    texts = [f"the word {i % 7} and word{i % 5} stand again" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(40)
    assert Counter(tuple(r) for r in aligned(frame, ["id"]).collect()) == slow.rows(list(enumerate(texts)))


def test_odd_rows(odd_documents, no_documents, slow):
    """Null and empty texts have no tokens, repeated rows count once each, names are carried."""
    told = aligned(odd_documents, ["doc_id", "size"])
    assert told.columns[:2] == ["doc_id", "size"]
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert Counter((r.doc_id, *tuple(r)[2:]) for r in told.collect()) == slow.rows(docs)
    assert aligned(no_documents, ["doc_id"]).count() == 0


def test_query_equals_brute_force(spark, sf_dir, slow):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = Counter()
    for key, *figures, text in slow.rows(docs):
        wanted[key, *figures, hashlib.sha256(text.encode()).hexdigest() if text else ""] += 1
    told = op12_aligned_tokenizers(spark, sf_dir)
    assert told.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ]
    assert Counter(tuple(r) for r in told.collect()) == wanted


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_minimal_perfect_hash(n):
    draw = np.random.default_rng(n)
    keys = np.unique(draw.integers(0, 1 << 62, n))
    found = pair_table.MinimalHash(pair_table.build(keys))
    assert sorted(found.places(keys).tolist()) == list(range(len(keys))) and found.size == len(keys)
    if n == 50_000:
        assert sum(64 * len(w) for w in found.levels) < 5 * n


def test_sums_and_unknown_keys(spark):
    """Tallies of many tasks are added exactly; keys that were not counted are told apart."""
    draw, wanted, rows = random.Random(2), Counter(), []
    for task in range(300):
        tally = {draw.randrange(500) * 2**32 + draw.randrange(64): draw.randrange(1, 1 << 40) for _ in range(40)}
        wanted.update(tally)
        for part in {k % 64 for k in tally}:
            some = sorted(k for k in tally if k % 64 == part)
            pack = lambda x: bytearray(np.array(x, np.int64).tobytes())
            rows.append((task, part, pack(some), pack([tally[k] for k in some])))
    frame = spark.createDataFrame(rows, "task long, part int, keys binary, counts binary").repartition(6)
    hashes, uri = pair_table.write_hashes(frame, "t-hashes")
    whole, address = pair_table.write_parts(pair_table.with_sums(frame, hashes, uri, "t-sums"), "t-table")
    assert whole.count() == 64
    files = pair_table.PartFiles(address, most=200)
    keys = np.array(sorted(wanted), np.int64)
    assert files.look_up(keys % 64, keys, ["sums"])[0].tolist() == [wanted[k] for k in keys.tolist()]
    assert sum(len(p.keys) for p in files.held.values()) <= 200
    assert files.look_up(np.array([0]), np.array([501 * 2**32]), ["sums"])[0].tolist() == [0]


def test_counts_of_other_texts_are_an_error(spark):
    frame = spark.createDataFrame([(1, "a b a")], "id long, text string")
    _, counts = alignment.count_links(frame, "text", *FILES)
    other = spark.createDataFrame([(1, "quite other words")], "id long, text string")
    with pytest.raises(Exception, match="without a count"):
        alignment.align(other, "text", ["id"], *FILES, counts).collect()


def test_linked_pairs(spark):
    frame = freeze(spark.createDataFrame([(1, "a b a"), (2, "a")], "id long, text string"), "t")
    table, _ = alignment.count_links(frame, "text", *FILES)
    assert sorted(r["count"] for r in alignment.linked_pairs(table).collect()) == [1, 3]
