"""Names that several test modules use; nothing is imported from a ``conftest``."""

from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
