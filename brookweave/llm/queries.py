"""Queries of problems 7 to 9."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.llm import encoding, leakage, quality
from brookweave.session import table

#: The folder of public vocabularies; a parameter of the environment.
TOKENIZERS = os.environ.get("BROOKWEAVE_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    path = os.path.join(TOKENIZERS, name)
    if not os.path.exists(path) and (spec := importlib.util.find_spec("public_tokenizers")):
        path = os.path.join(os.path.dirname(spec.origin), name)
    return path


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf, "documents"), "doc_id", "text", vocabulary())


def spans(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_spans(
        table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_items"), "item_id", "text"
    )


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(spans(spark, sf))


def p8_spans(spark: SparkSession, sf: str) -> DataFrame:
    return spans(spark, sf)


def common_words(spark: SparkSession, sf: str) -> list[str]:
    """The function words: a fixed table of about a hundred rows; a larger one is refused."""
    rows = table(spark, sf, "common_words").select("word").where("word is not null").distinct().limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("common_words is meant to hold function words only")
    return sorted(r.word for r in rows)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    classes = quality.document_classes(table(spark, sf, "documents"), "doc_id", "text", common_words(spark, sf))
    return quality.not_prose(classes).select("doc_id").distinct()


def p9_stats(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_statistics(table(spark, sf, "documents"), "doc_id", "text", common_words(spark, sf))


def p9_classes(spark: SparkSession, sf: str) -> DataFrame:
    rounded = [F.round(f"{c}_share", 4).alias(f"{c}_share") for c in quality.CLASSES]
    classes = quality.document_classes(table(spark, sf, "documents"), "doc_id", "text", common_words(spark, sf))
    return classes.select("doc_id", "n_visible", *rounded)


QUERIES = {f.__name__: f for f in (p7_ids, p8_found, p8_spans, p9_found, p9_stats, p9_classes)}

_SPACE = r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Only the plain statistics have an SQL form; encoding, the index and the mixture are tested against brute force.
SQL: dict[str, str] = {
    "p9_stats": rf"""
with t as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}\p{{M}}]+') as w,
    list_filter(string_split_regex(t, '\r\n|[\n\r]'), lambda x: length(regexp_replace(x, '[{_SPACE}]', '', 'g')) > 0) as l,
    length(regexp_replace(t, '[{_SPACE}]', '', 'g')) as n_visible, length(regexp_replace(t, '[{_SPACE}\p{{L}}\p{{N}}\p{{M}}]', '', 'g')) as symbols from t),
c as (select list(distinct lower(word)) as known from common_words where word is not null)
select doc_id, len(w)::int as n_words, n_visible::int as n_visible, len(l)::int as n_lines,
  list_sum(list_transform(w, lambda x: length(x))) / nullif(len(w), 0) as mean_word_length, symbols / nullif(n_visible, 0) as symbol_share,
  len(list_filter(l, lambda x: regexp_matches(x, '[.!?:;\x{{2026}}]\s*$'))) / nullif(len(l), 0) as ended_lines_share,
  len(list_filter(w, lambda x: list_contains(known, x))) / nullif(len(w), 0) as common_share from w, c""",
}
