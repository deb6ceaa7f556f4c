"""Registered queries over the given tables and their SQL twins."""

from workload import (  # noqa: F401
    cleaning_queries,
    dataset_queries,
    file_queries,
    io_queries,
    label_queries,
    mining_queries,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
