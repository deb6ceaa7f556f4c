"""Column helpers shared by the operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, outputs: list[str], inputs: list[str]) -> DataFrame:
    """Drop columns that outputs will replace. An output may not be an input."""
    lower = {c.lower() for c in outputs}
    if lower & {c.lower() for c in inputs}:
        raise ValueError(f"outputs {outputs} would replace an input of {inputs}")
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts, which sizes the buckets of a shuffle."""
    return df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}


def arrow_schema(columns: str) -> pa.Schema:
    """The Arrow schema of a column list."""
    return pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in columns.split(", ")])
