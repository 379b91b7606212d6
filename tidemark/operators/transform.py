"""Post-read transformations: filter, select, rename, as ``DataFrame -> DataFrame`` callables."""

from __future__ import annotations

from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns with this prefix belong to the sync and stay through every transformation.
RESERVED = "_tm_"

Transform = Callable[[DataFrame], DataFrame]


def filter_rows(condition: str | Column) -> Transform:
    """Keep rows where the SQL condition (or Column) is true."""
    return lambda df: df.where(F.expr(condition) if isinstance(condition, str) else condition)


def select_columns(columns: Sequence[str]) -> Transform:
    """Keep the listed columns, in that order."""
    cols = list(columns)
    return lambda df: df.select(*cols, *[c for c in df.columns if c.startswith(RESERVED)])


def rename_columns(mapping: Mapping[str, str]) -> Transform:
    """Rename ``old -> new``; unknown names fail instead of being ignored."""
    mapping = dict(mapping)

    def apply(df: DataFrame) -> DataFrame:
        missing = [c for c in mapping if c not in df.columns]
        if missing:
            raise ValueError(f"rename: columns not found: {missing}")
        return df.withColumnsRenamed(mapping)

    return apply


def from_config(steps: Sequence[Mapping[str, Any]]) -> list[Transform]:
    """Build the chain from ``[{type: filter, condition: …}, {type: select, columns: […]}, {type: rename, mapping: {…}}]``."""
    chain: list[Transform] = []
    for step in steps:
        kind = step.get("type")
        if kind == "filter":
            chain.append(filter_rows(step["condition"]))
        elif kind == "select":
            chain.append(select_columns(step["columns"]))
        elif kind == "rename":
            chain.append(rename_columns(step["mapping"]))
        else:
            raise ValueError(f"unknown transformation type {kind!r}")
    return chain


def apply_all(df: DataFrame, chain: Sequence[Transform]) -> DataFrame:
    for t in chain:
        df = t(df)
    return df
