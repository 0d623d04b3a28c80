"""All registered queries; importing this module registers them."""

from sumstone.plans import (  # noqa: F401
    generator_queries,
    io_queries,
    operator_queries,
    report_queries,
)
from sumstone.plans.registry import COVERS, ORACLES, QUERIES

__all__ = ["COVERS", "ORACLES", "QUERIES"]
