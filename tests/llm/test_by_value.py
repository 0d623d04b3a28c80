"""Operators in a session whose workers cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

CODE = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
import public_tokenizers
from sumstone.llm import alignment, packing, periodic, queries, similarity, token_counts

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://" + os.getcwd() + "/s")
         .getOrCreate())

def importable(rows):
    try:
        import sumstone
        yield from ["yes"]
    except ModuleNotFoundError:
        yield from ["no"]

assert set(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect()) == {{"no"}}
texts = ["one two three four five six"] * 3 + ["quite another text of words " * 9]
docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
found = similarity.near_groups(docs, "doc_id", "text", 3, 90, 100).collect()
assert sorted(r.component_id for r in found) == [0, 0, 0, 3]
assert token_counts.count_tokens(docs, "text", b, ["doc_id"]).count() == 4
assert packing.pack(docs, "doc_id", "text", a, end=0).count() >= 4
runs = periodic.with_runs(docs, "text", ["doc_id"], queries.run_digests, queries.RUN_DIGESTS)
assert runs.agg(F.sum("n_runs")).first()[0] == 1
_, counts = alignment.count_links(docs, "text", a, b)
assert alignment.align(docs, "text", ["doc_id"], a, b, counts).count() == 4
print("all by value")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    (tmp_path / "run.py").write_text(CODE.format(root=str(ROOT)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    told = subprocess.run(
        [sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "all by value" in told.stdout, told.stderr[-3000:]
