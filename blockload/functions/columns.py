"""Column handling: case-insensitive name matching, exclusion, request checks.

All of it works on ``df.schema``; no Spark job runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from blockload.config import DEFAULT_EXCLUDE, RESERVED_COLS

# Fixed value: the identifier pattern a block column name must match.
IDENTIFIER = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")


def _by_lower_name(schema: StructType) -> dict[str, list[str]]:
    names: dict[str, list[str]] = {}
    for f in schema.fields:
        names.setdefault(f.name.lower(), []).append(f.name)
    return names


def resolve_columns(df: DataFrame | StructType, names: Sequence[str]) -> StructType:
    """O2: the fields of ``df`` named by ``names`` ignoring case, in the order
    of ``names``. A missing or ambiguous name raises."""
    schema = df if isinstance(df, StructType) else df.schema
    index = _by_lower_name(schema)
    fields = []
    for n in names:
        found = index.get(n.lower(), [])
        if not found:
            raise ValueError(f"column {n!r} not found; available: {', '.join(schema.fieldNames())}")
        if len(found) > 1:
            raise ValueError(f"column {n!r} is ambiguous: {', '.join(found)}")
        fields.append(schema[found[0]])
    return StructType(fields)


def kept_columns(columns: Iterable[str], exclude: Iterable[str] = DEFAULT_EXCLUDE) -> list[str]:
    drop = {e.lower() for e in exclude}
    return [c for c in columns if c.lower() not in drop]


def exclude_columns(df: DataFrame, names: Iterable[str] = DEFAULT_EXCLUDE) -> DataFrame:
    """Drop columns by name ignoring case; unknown names are ignored."""
    return df.select(*[df[c] for c in kept_columns(df.columns, names)])


def check_block_column(schema: StructType, block_col: str) -> str:
    """The name of the block column as the source spells it."""
    if not IDENTIFIER.fullmatch(block_col or ""):
        raise ValueError(f"block column {block_col!r} is not a valid identifier")
    return resolve_columns(schema, [block_col]).fields[0].name


def check_names(schema: DataFrame | StructType, reserved: Iterable[str] = RESERVED_COLS) -> None:
    """Refuse columns that the library's own would overwrite, and columns whose
    names are equal but for case, which no target keeps apart."""
    schema = schema if isinstance(schema, StructType) else schema.schema
    names = _by_lower_name(schema)
    for own in reserved:
        if own.lower() in names:
            raise ValueError(f"column {names[own.lower()][0]!r} has a reserved name ({', '.join(reserved)}); rename it")
    alike = [", ".join(found) for found in names.values() if len(found) > 1]
    if alike:
        raise ValueError(f"columns whose names differ by case only: {'; '.join(alike)}")


def check_request(
    df: DataFrame | StructType | None = None,
    *,
    path: str | None = None,
    n_blocks: int | None = None,
    columns: Sequence[str] | None = None,
    block_col: str | None = None,
    uses_ledger: bool = False,
    process_name: str = "",
    scope: str = "",
    loads: DataFrame | StructType | None = None,
) -> None:
    """Preconditions, raised before any job runs. ``loads``: the columns
    that will be loaded."""
    if path is not None and not path:
        raise ValueError("a path is required")
    if n_blocks is not None and n_blocks <= 0:
        raise ValueError(f"block count must be > 0, got {n_blocks}")
    if columns is not None and len(columns) == 0:
        raise ValueError("the column list is empty")
    if uses_ledger and not (process_name and scope):
        raise ValueError("process_name and scope are required with a ledger")
    if loads is not None:
        check_names(loads)
    if df is not None:
        schema = df if isinstance(df, StructType) else df.schema
        if block_col is not None:
            check_block_column(schema, block_col)
        if columns:
            resolve_columns(schema, columns)
