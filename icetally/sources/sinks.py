"""Writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (),
) -> None:
    """CSV, JSON or Parquet; CSV holds arrays, maps and structs as JSON text."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError("fmt must be csv, json or parquet")
    if fmt == "csv":
        nested = (T.ArrayType, T.MapType, T.StructType)
        df = df.select(*[
            (F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
        ])
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
