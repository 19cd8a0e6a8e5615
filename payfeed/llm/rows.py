"""Rows that pass through an operator with all their columns as they came, whatever these are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def as_struct(docs: DataFrame) -> Column:
    """The whole row as one struct, so that no column can clash with a result."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def from_struct(row: str, columns: list[str]) -> list[Column]:
    """The columns of the struct ``row`` again."""
    return [F.col(row)[c].alias(c) for c in columns]


def with_fields(schema: StructType, ddl: str) -> StructType:
    """``schema`` with more fields; unlike text, it may hold any names."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)
