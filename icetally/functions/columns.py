"""Column hygiene: flattening, renaming, alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to flat columns named by their path; arrays stay as they are."""

    def leaves(schema: T.StructType, parent: Column | None, prefix: str):
        for field in schema.fields:
            name = f"{prefix}{sep}{field.name}" if prefix else field.name
            here = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here, name)
            else:
                yield here.alias(name)

    return dedupe_columns(df.select(*leaves(df.schema, None, "")))


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Repeated names get ``_1``, ``_2``, ... in order of appearance."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        names.append(f"{c}_{seen[c]}" if c in seen else c)
        seen[c] = seen.get(c, 0) + 1
    return df.toDF(*names) if names != df.columns else df


def strip_prefixes(df: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Drops the given leading path parts from column names."""
    names = []
    for c in df.columns:
        hit = next((p for p in prefixes if c.startswith(p)), "")
        names.append(c[len(hit):])
    return dedupe_columns(df.toDF(*names))


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds missing columns as typed nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def first_present(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks column(s) {missing}")
