"""Text, hash and identifier operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.columns import apply, col, pick, type_of
from brookweave.functions.ids import row_hash, uuid5
from brookweave.registry import operator

#: Vietnamese letters and their base letters, upper case, in natural order.
ACCENTED = "ÀÁÂÃẠẢẤẦẨẪẬẮẰẲẴẶĂÈÉÊẸẺẼẾỀỂỄỆÌÍĨỈỊÒÓÔÕỌỎỐỒỔỖỘƠỚỜỞỠỢÙÚŨỤỦƯỨỪỬỮỰÝỲỴỶỸĐ"
PLAIN = "AAAAAAAAAAAAAAAAAEEEEEEEEEEEIIIIIOOOOOOOOOOOOOOOOOUUUUUUUUUUUYYYYYD"


def each_text(df: DataFrame, name: str, build: Callable[[Column], Column]) -> Column:
    """``build`` on a text column, on every element of an array or on every value of a map."""
    kind = type_of(df, name)
    if kind == "array<string>":
        return F.transform(col(name), build)
    if kind.startswith("map<") and kind.endswith(",string>"):
        return F.transform_values(col(name), lambda _, v: build(v))
    if kind == "string":
        return build(col(name))
    raise TypeError(f"{name} is {kind}; text, an array or a map of text is needed")


def upper_text(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def plain_text(c: Column) -> Column:
    """Upper case without Vietnamese accents, composed or combining."""
    return F.translate(F.regexp_replace(upper_text(c), r"\p{M}", ""), ACCENTED, PLAIN)


@operator()
def trim_all_trailing_space(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    """Trims both ends."""
    return apply(df, column_patterns, F.trim)


@operator()
def sub_string(df: DataFrame, columns: Sequence[str], index: str) -> DataFrame:
    """``index`` is ``start:length``, counted from 1."""
    start, length = map(int, index.split(":"))
    return df.withColumns({c: F.substring(col(c), start, length) for c in columns})


@operator()
def split_string_get_element(df: DataFrame, source_column: str, target_column: str, split_pattern: str, extract_index: int) -> DataFrame:
    """Element from 1, or from the end if negative; null beyond."""
    return df.withColumn(target_column, F.try_element_at(F.split(col(source_column), split_pattern), F.lit(extract_index)))


@operator(synonyms={"exclusive_columns": "exclusive"})
def calculate_hash_index(df: DataFrame, column_name: str = "hash_index", exclusive: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(column_name, row_hash([col(c) for c in df.columns if c not in set(exclusive)]))


@operator(synonyms={"include_columns": "inclusive"})
def add_pk_from_columns(df: DataFrame, column_name: str, inclusive: Sequence[str]) -> DataFrame:
    """Hash of the listed columns in the order of the frame."""
    names = [c for c in df.columns if c in set(inclusive)]
    if not names:
        raise ValueError("no column to hash")
    return df.withColumn(column_name, row_hash([col(c) for c in names]))


@operator()
def add_ds_hash_index(df: DataFrame, column_name: str = "ds_hash_index", exclude_prefix: str = "ds_", exclusive: Sequence[str] = ()) -> DataFrame:
    """Hash of all data columns; maps, arrays and structs count as their JSON text."""
    names = [c for c in df.columns if not c.startswith(exclude_prefix) and c not in set(exclusive)]
    nested = ("map<", "array<", "struct<")
    return df.withColumn(column_name, row_hash([F.to_json(col(c)) if type_of(df, c).startswith(nested) else col(c) for c in names]))


@operator()
def create_uuid(df: DataFrame, column_name: str, source_column: str) -> DataFrame:
    return df.withColumn(column_name, uuid5(col(source_column)))


@operator()
def decode_base64_payload(df: DataFrame, column_patterns: str) -> DataFrame:
    """The named column decoded; text that is no base64 becomes null."""
    name = column_patterns if isinstance(column_patterns, str) else column_patterns[0]
    return df.withColumn(name, F.try_to_binary(col(name), F.lit("base64")).cast("string"))


@operator()
def da_text_with_unicode(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: each_text(df, c, upper_text) for c in pick(df, column_patterns)})


@operator()
def da_text_non_unicode(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: each_text(df, c, plain_text) for c in pick(df, column_patterns)})


@operator("transform_category_account_salary_hist__cob", "replace_values")
def replace_values(df: DataFrame, column_name: str = "category", mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Exact values replaced by a literal map; others stay."""
    found = col(column_name).cast("string")
    out = found
    for old, new in (mapping or {"1006": "1001"}).items():
        out = F.when(found == old, F.lit(new)).otherwise(out)
    return df.withColumn(column_name, out)


@operator()
def replace_value_in_map_type_column(df: DataFrame, column_name: str, replace_list: Sequence[Mapping[str, str]]) -> DataFrame:
    """Every rule ``{pattern, replacement}``, in order, on the values of a map."""

    def build(_: Column, v: Column) -> Column:
        for r in replace_list:
            v = F.regexp_replace(v, r["pattern"], r["replacement"])
        return v

    return df.withColumn(column_name, F.transform_values(col(column_name), build))


@operator(synonyms={"fields_lst": "column_patterns"})
def mark_by_substring(
    df: DataFrame, column_patterns: Sequence[str], start: int = 0, end: int | None = None, index: str | None = None
) -> DataFrame:
    """The slice ``start:end`` of text, counted from 0; negative places count from the end. ``index`` is ``"start:end"``."""
    if index is not None:
        first, _, last = index.partition(":")
        start, end = int(first or 0), int(last) if last else None

    def build(c: Column) -> Column:
        n = F.length(c)
        place = lambda i: F.lit(i) if i >= 0 else F.greatest(n + i, F.lit(0))
        first, last = place(start), n if end is None else place(end)
        return F.substring(c, first + 1, F.greatest(last - first, F.lit(0)))

    return df.withColumns({c: each_text(df, c, build) for c in pick(df, column_patterns)})


@operator(synonyms={"fields_lst": "column_patterns", "const_value": "const", "field_id": "id_column"})
def mark_by_combine_with_const(df: DataFrame, column_patterns: Sequence[str], const: str, id_column: str | None = None) -> DataFrame:
    """Elements of arrays and values of maps become the constant, followed by the row's id if one is named; nulls stay."""
    mark = F.concat_ws(" ", F.lit(const), col(id_column).cast("string")) if id_column else F.lit(const)
    names = [c for c in pick(df, column_patterns) if type_of(df, c) != "string"]
    return df.withColumns({c: each_text(df, c, lambda v: F.when(v.isNotNull(), mark)) for c in names})
