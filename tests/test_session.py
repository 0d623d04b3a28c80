"""The shared scratch folder: where it may be, and that it can be removed."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from sumstone import session


class Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def fake(master: str, **settings):
    conf = Settings({k.replace("_", "."): v for k, v in settings.items()})
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_cluster_needs_a_shared_folder():
    shared = fake("yarn", spark_checkpoint_dir="hdfs://a/b/")
    assert session.scratch_root(shared) == "hdfs://a/b"
    with pytest.raises(ValueError, match="share"):
        session.scratch_root(fake("spark://x:7077", spark_sql_warehouse_dir="file:/tmp/w"))
    assert session.scratch_root(fake("yarn", spark_sql_warehouse_dir="s3a://w")) == "s3a://w/_scratch"
    assert session.scratch_root(fake("local[4]", spark_sql_warehouse_dir="file:/w")) == "file:/w/_scratch"


def test_scratch_goes_when_asked(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])
    path = session.scratch_path(spark, "kept")
    unused = session.scratch_path(spark, "never-written")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path.removeprefix("file:"))
    assert session.remove_scratch(spark) == 1 and session.remove_scratch(spark) == 0
    assert not os.path.exists(path.removeprefix("file:")) and not os.path.exists(unused)
