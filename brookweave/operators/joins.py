"""Joins and set operations with the golden tables. Physical strategy is left to the planner and adaptive execution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookweave.columns import col
from brookweave.registry import operator


@operator()
def left_join_with_golden_if_existed(
    df: DataFrame, tables: Mapping[str, DataFrame], golden_catalog: str, left_on: Sequence[str], right_on: Sequence[str],
    golden_subset_cols: Sequence[str] | None = None, golden_dedup_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Left equi join. Right-hand names that clash get ``_2`` first, so the parameters use the suffixed names."""
    golden = tables.get(golden_catalog)
    if golden is None or golden.isEmpty():
        return df
    golden = golden.withColumnsRenamed({c: f"{c}_2" for c in golden.columns if c in df.columns})
    if golden_subset_cols:
        golden = golden.select(*[col(c) for c in golden_subset_cols])
    if golden_dedup_keys:
        golden = golden.dropDuplicates(list(golden_dedup_keys))
    on = F.lit(True)
    for a, b in zip(left_on, right_on, strict=True):
        on = on & (df[a] == golden[b])
    return df.join(golden, on, "left")


@operator()
def union_with_golden_if_existed(
    df: DataFrame, tables: Mapping[str, DataFrame], golden_catalog: str, technical_columns: Sequence[str] = (),
    partition_column: str = "ds_partition_date", process_column: str = "process_date",
) -> DataFrame:
    golden = tables.get(golden_catalog)
    if golden is None or golden.isEmpty():
        return df
    golden = golden.drop(*technical_columns)
    if partition_column in golden.columns:
        golden = golden.withColumnRenamed(partition_column, process_column)
    return df.unionByName(golden)


def restrict_to_sources(current: DataFrame, snapshot: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Rows of the sources that the snapshot delivers."""
    return current.join(snapshot.select(*sources).distinct(), list(sources), "left_semi") if sources else current


def missing_keys(wanted: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.select(*keys).distinct().join(found.select(*keys), list(keys), "left_anti")
