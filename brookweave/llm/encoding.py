"""Encoding of a corpus with a byte-level BPE vocabulary by Spark's higher-order functions.

A text is cut into words by the vocabulary's pattern. A word that is itself a piece needs no merging: its rank is its
id. Every other distinct word of the corpus is encoded once: its bytes become a marked string ``<b><b>...``; a fold
looks up the rank of every neighbouring pair, and merges all places of the pair of least rank, until no pair has one.
The ranks are one literal, an array of small maps addressed by a checksum of the piece, so that a lookup costs a few
comparisons.

Bytes are written as the Latin-1 characters of the same number, and the marks are two characters beyond them.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.session import persist_table, spread

#: Fixed value: the pattern that cuts words, as published with the vocabulary (Unicode classes and white space).
WORD_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OPEN, CLOSE = "Ā", "ā"
SLOTS = 8192


@lru_cache(maxsize=4)
def load_ranks(path: str) -> tuple[tuple[bytes, int], ...]:
    """Pieces and ranks of a file with one base64 piece and one rank per line."""
    with open(path, "rb") as f:
        return tuple((base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip()))


@lru_cache(maxsize=4)
def _rank_json(path: str) -> str:
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for piece, rank in load_ranks(path):
        key = piece.decode("latin-1")
        slots[zlib.crc32(key.encode()) % SLOTS][key] = rank
    return json.dumps(slots, ensure_ascii=False, separators=(",", ":"))


def rank_map(path: str) -> Column:
    """The literal: folded by the optimizer to one array of maps."""
    return F.from_json(F.lit(_rank_json(path)), "array<map<string,int>>")


def rank_of(ranks: Column, piece: Column) -> Column:
    slot = F.pmod(F.crc32(piece.cast("binary")), F.lit(SLOTS)).cast("int")
    return F.element_at(F.get(ranks, slot), piece)


def as_bytes(word: Column) -> Column:
    """One Latin-1 character per UTF-8 byte."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def merge_word(ranks: Column, word: Column) -> Column:
    """Ids of one word (bytes as Latin-1 characters) by ranked merges. The literal is bound once for all its uses."""
    return _merge(ranks, word)


def _merge(ranks: Column, word: Column) -> Column:
    marked = F.concat(F.lit(OPEN), F.array_join(F.split(word, ""), CLOSE + OPEN), F.lit(CLOSE))
    inner = lambda s: F.split(F.substring(s, F.lit(2), F.length(s) - 2), CLOSE + OPEN)

    def best(parts: Column) -> Column:
        """The neighbours of least rank, as ``{rank, left, right}``; null rank where none can be merged."""
        pairs = F.zip_with(
            F.slice(parts, F.lit(1), F.size(parts) - 1),
            F.slice(parts, F.lit(2), F.size(parts) - 1),
            lambda a, b: F.struct(rank_of(ranks, F.concat(a, b)).alias("r"), a.alias("a"), b.alias("b")),
        )
        return F.array_min(F.filter(pairs, lambda p: p["r"].isNotNull()))

    def step(state: Column, _: Column) -> Column:
        def merge(pair: Column) -> Column:
            old = F.concat(F.lit(OPEN), pair["a"], F.lit(CLOSE + OPEN), pair["b"], F.lit(CLOSE))
            new = F.concat(F.lit(OPEN), pair["a"], pair["b"], F.lit(CLOSE))
            return F.when(pair.isNull(), F.struct(state["s"].alias("s"), F.lit(True).alias("done"))).otherwise(
                F.struct(F.replace(state["s"], old, new).alias("s"), F.lit(False).alias("done"))
            )

        # a let-binding: the pair is computed once and used thrice
        merged = F.get(F.transform(F.array(best(inner(state["s"]))), merge), F.lit(0))
        return F.when(state["done"], state).otherwise(merged)

    rounds = F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1)))
    last = F.aggregate(rounds, F.struct(marked.alias("s"), (F.length(word) < 2).alias("done")), step)
    return F.transform(inner(last["s"]), lambda p: rank_of(ranks, p))


#: Most words whose ids every task holds, and the length of the longest of them; and the same for long ones, which are
#: rulers and the like: at most a few megabytes together.
HOT_WORDS, HOT_LENGTH = 20_000, 48
HOT_RULERS, RULER_LENGTH = 200, 4096
#: Bytes from which a word is merged by a queue of its pairs: the fold looks at all pairs in each of its rounds.
LONG_WORD = 512
GAP = "|"


def merged_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by ranked merges: the pair of least rank, leftmost first, from a queue that holds every pair once,
    so that a word of n bytes costs n log n steps."""
    n = len(word)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue: list[tuple[int, int, bytes, bytes]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(queue, (rank, i, parts[i], parts[j]))

    for i in range(n):
        offer(i)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue  # one of the two was merged meanwhile
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[p] for p in parts if p is not None]


def merge_long(vocabulary: str):
    """The text of the ids of long words (bytes as Latin-1 characters). They are few, and the fold's rounds grow with them."""

    def run(words: pd.Series) -> pd.Series:
        ranks = dict(load_ranks(vocabulary))
        return words.map(lambda w: " ".join(map(str, merged_bytes(w.encode("latin-1"), ranks)))).astype(object)

    return F.pandas_udf(run, "string")


def hot_map(words: list[tuple[str, str]]) -> Column:
    """A literal like the ranks', from words to the text of their ids."""
    slots: list[dict[str, str]] = [{} for _ in range(SLOTS)]
    for word, ids in words:
        slots[zlib.crc32(word.encode()) % SLOTS][word] = ids
    return F.from_json(F.lit(json.dumps(slots, ensure_ascii=False, separators=(",", ":"))), "array<map<string,string>>")


def encode_corpus(df: DataFrame, doc_id: str, text: str, vocabulary: str) -> DataFrame:
    """``doc_id, ids`` of every row: an empty list for null and empty texts. Rows map one to one, ids may repeat.

    Every text is cut once. Words that are pieces get their id in place; the others are counted (combined before the
    shuffle) and each distinct one is encoded once. The ``HOT_WORDS`` most frequent encodings are given to every task as
    a second literal and applied in place, so no hot word crosses the network. The rest meets its encoding by a hash
    join on the word and fills the gaps of its document, whose known ids travel as one text.
    """
    ranks = rank_map(vocabulary)
    docs = spread(df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t")))
    words = F.transform(F.regexp_extract_all("_t", F.lit(WORD_PATTERN), F.lit(0)), as_bytes)
    # the text of an id, or a marked word
    first = F.transform(words, lambda w: F.coalesce(rank_of(ranks, w).cast("string"), F.concat(F.lit(OPEN), w)))
    is_open = lambda w: F.startswith(w, F.lit(OPEN))
    cut = persist_table(docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), first.alias("_words")), "cut")
    counted = cut.select(F.explode(F.filter("_words", is_open)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # merging is work per word, not per byte: adaptive execution would join these small partitions into one
    counted = counted.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
    bare = F.substring("word", F.lit(2), F.length("word") - 1)
    short, long = counted.where(F.length("word") <= LONG_WORD), counted.where(F.length("word") > LONG_WORD)
    encoded = short.withColumn("ids", F.array_join(merge_word(ranks, bare), " ")).unionByName(long.withColumn("ids", merge_long(vocabulary)(bare)))
    dictionary = persist_table(encoded, "dictionary")
    first = lambda low, high, most: dictionary.where(F.length("word").between(low + 1, high)).orderBy(F.desc("n"), "word").limit(most)
    top = first(0, HOT_LENGTH, HOT_WORDS).unionByName(first(HOT_LENGTH, RULER_LENGTH, HOT_RULERS))
    hot = hot_map([(r.word, r.ids) for r in top.select("word", "ids").collect()])
    second = F.transform("_words", lambda w: F.when(is_open(w), F.coalesce(rank_of(hot, w), w)).otherwise(w))
    # written before it is split: a filter on it must not evaluate the lookups again
    rows = persist_table(cut.select("doc_id", "_row", second.alias("_words")), "rows")
    rows = rows.withColumn("_rare", F.filter("_words", is_open))
    number = lambda t: F.when(t == "", F.array().cast("array<int>")).otherwise(F.split(t, " ").cast("array<int>"))
    done = rows.where(F.size("_rare") == 0).select("doc_id", number(F.array_join("_words", " ")).alias("ids"))
    rest = rows.where(F.size("_rare") > 0)
    gaps = F.array_join(F.transform("_words", lambda w: F.when(is_open(w), F.lit(GAP)).otherwise(w)), " ")
    heads = rest.select("_row", "doc_id", gaps.alias("_known"), F.lit(None).cast("struct<k:int,ids:string>").alias("_fill"))
    asked = rest.select("_row", F.posexplode("_rare").alias("_k", "_w"))
    answers = asked.join(dictionary.select("word", "ids"), F.col("_w") == F.col("word")).select(
        "_row", F.lit(None).cast(dict(cut.dtypes)["doc_id"]).alias("doc_id"), F.lit(None).cast("string").alias("_known"),
        F.named_struct(F.lit("k"), F.col("_k"), F.lit("ids"), F.col("ids")).alias("_fill"),
    )
    grouped = heads.unionByName(answers).groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"), F.max("_known").alias("_known"), F.array_sort(F.collect_list("_fill")).alias("_fills")
    )
    filled = F.zip_with(F.split("_known", r"\|"), "_fills", lambda t, f: F.concat(t, F.coalesce(f["ids"], F.lit(""))))
    return done.unionByName(grouped.select("doc_id", number(F.array_join(filled, "")).alias("ids")))


def decode_ids(df: DataFrame, ids: str, vocabulary: str) -> DataFrame:
    """Adds ``decoded``: the pieces of the ids, as binary, concatenated and read as UTF-8. Unknown ids give nothing."""
    pieces = sorted(((r, p) for p, r in load_ranks(vocabulary)))
    top = pieces[-1][0] + 1 if pieces else 0
    table = [""] * top
    for r, p in pieces:
        table[r] = p.hex().upper()
    by_id = F.split(F.lit(",".join(table)), ",")
    text = F.array_join(F.transform(F.col(ids), lambda i: F.coalesce(F.get(by_id, i), F.lit(""))), "")
    return df.withColumn("decoded", F.decode(F.unhex(text), "UTF-8"))
