"""Periodic runs against plain comparison of all words with all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql.types import StructType

from sumstone.llm import periodic
from sumstone.llm.queries import op11_periodic_tiles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = StructType().add("told", "string")


def telling():
    """A nested function goes to the workers by value; they cannot import this module."""

    def tell(words, runs):
        return (repr((len(words), runs)),)

    return tell


def slow_runs(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                end = i + q
                if end - start >= max(least, times * q):
                    found.setdefault((start, end), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


def texts_with_runs(seed: int) -> list[str]:
    draw = random.Random(seed)
    texts = []
    for _ in range(60):
        words: list[str] = []
        for _ in range(draw.randrange(1, 6)):
            words += [f"w{draw.randrange(draw.choice([2, 5, 1000]))}" for _ in range(draw.randrange(0, 40))]
            unit = [f"w{draw.randrange(draw.choice([2, 3, 50]))}" for _ in range(draw.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 33, 70]))]
            words += (unit * 9)[: draw.randrange(1, 9 * len(unit))]
        texts.append(" ".join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    square_free = "".join("abc"[bin(i).count("1") % 2 + (i % 7 == 0)] for i in range(300))
    return texts + [" ".join(t) for t in (fib[-1], square_free, "a" * 300, "ab" * 200, "a" * 23, "a" * 24)]


@pytest.mark.parametrize("seed", range(4))
def test_fragments_and_stitching_find_all_runs(spark, seed):
    texts = texts_with_runs(seed)
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    told = periodic.with_runs(frame, "text", ["id"], telling(), RUNS).collect()
    for r in told:
        words = texts[r.id].split()
        assert r.told == repr((len(words), slow_runs(words))), texts[r.id]


def test_tiles_that_were_not_joined_are_stitched(spark):
    """One long run as the fragments of single tiles, dealt over all partitions."""
    words = [f"u{i % 50}" for i in range(5000)]
    rows, step = [], 32
    for b in range(0, len(words), step):
        lo, hi = max(b - step, 0), min(b + 5 * step, len(words))
        for q, s, e in periodic.solve_tile(words[lo:hi], b - lo, step, list(range(step, 2 * step))):
            rows.append((1, q, s + lo, e + lo))
    assert len(rows) > 100
    rows += [(1, 50, 5010, 5180), (2, 7, 0, 21), (2, 7, 30, 60), (2, 14, 30, 60), (2, 7, 54, 100)]
    frame = spark.createDataFrame(rows, "row long, period long, start long, end long").repartition(7)
    told = {r.row: [tuple(x) for x in r.runs] for r in periodic.stitch(frame, "row", 24, 3).collect()}
    assert told == {1: [(0, 5000, 50), (5010, 170, 50)], 2: [(30, 30, 7), (54, 46, 7)]}


def test_z_function():
    draw = random.Random(1)
    for _ in range(200):
        s = [draw.randrange(2) for _ in range(draw.randrange(0, 30))]
        slow = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic.z_function(s) == slow


def test_odd_rows(odd_documents, no_documents):
    """Null and empty texts have no words, repeated rows stay, clashing names are carried."""
    carried = ["doc_id", "size", "score"]
    told = periodic.with_runs(odd_documents, "text", carried, telling(), RUNS)
    assert told.columns == [*carried, "told"]
    wanted = Counter()
    for r in odd_documents.collect():
        words = WORD.findall(r.text or "")
        runs = slow_runs(words) if len(words) < 5000 else []
        wanted[r.doc_id, r["size"], repr((len(words), runs))] += 1
    assert Counter((r.doc_id, r["size"], r.told) for r in told.collect()) == wanted
    assert periodic.with_runs(no_documents, "text", ["doc_id"], telling(), RUNS).count() == 0
    with pytest.raises(ValueError):
        periodic.with_runs(odd_documents, "text", ["doc_id"], telling(), RUNS, least=10)


def slow_query(doc_id: int, text: str | None) -> tuple:
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    best = (None,) * 4
    if runs:
        s, n_, q = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[0]
        best = (s, n_, q, 1000 * n_ // q)
    lines = "".join(f"{s},{n_},{q}\n" for s, n_, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    told = op11_periodic_tiles(spark, sf_dir)
    assert told.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    found = {r.doc_id: tuple(r) for r in told.collect()}
    assert len(found) == len(docs) and sum(r[1] for r in found.values()) > 10
    for r in docs:
        if len((r.text or "").split()) < 1500:
            assert found[r.doc_id] == slow_query(r.doc_id, r.text)
