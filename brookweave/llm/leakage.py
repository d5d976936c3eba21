"""Evaluation texts inside training text, by an FM-index per shard of the corpus.

Both sides are folded to words as a reader sees them. The alphabet is the words of the evaluation texts; any run of
other words in a document is one separator, so the index of a shard covers every document at the price of the words
that could match. Test phrases (all runs of ``span`` consecutive words of an item) are searched backwards through the
ranks of a wavelet matrix over the Burrows-Wheeler transform, all phrases at once; occurrences are located by sampled
suffix positions and merged to spans per document and item.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookweave.llm.text import fold, readings_of, visible, words
from brookweave.session import spread
#: Characters of text held for each code of a shard.
CHARACTERS = 6


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; every separator (0) is a symbol of its own, ordered by position."""
    n = len(codes)
    zero = codes == 0
    rank = np.where(zero, np.cumsum(zero) - 1, codes.astype(np.int64) + int(zero.sum()))
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = fresh
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class FmIndex:
    """Counts and locations of phrases in one sequence of codes (0 separates)."""

    def __init__(self, codes: np.ndarray, sigma: int, sample: int = 8):
        codes = np.concatenate((codes, [0])).astype(np.int32)
        order = suffix_array(codes)
        self.n = len(codes)
        bwt = codes[order - 1]
        self.bwt = bwt
        self.first = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=sigma + 1))))[: sigma + 1].astype(np.int64)
        self.bits = max(1, int(sigma).bit_length())
        self.ones, self.zeros = [], []
        level = bwt
        for bit in range(self.bits - 1, -1, -1):
            b = (level >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(b))).astype(np.int32))
            self.zeros.append(int(len(b) - b.sum()))
            level = np.concatenate((level[b == 0], level[b == 1]))
        # positions after a separator are sampled too: a walk never has to cross a separator
        marked = (order % sample == 0) | (bwt == 0)
        self.marks = np.concatenate(([0], np.cumsum(marked))).astype(np.int32)
        self.samples = order[marked]
        self.marked = marked

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``upto`` entries of the transform."""
        low, high = np.zeros_like(upto), upto
        for ones, zeros, bit in zip(self.ones, self.zeros, range(self.bits - 1, -1, -1)):
            set_ = ((symbol >> bit) & 1).astype(bool)
            low1, high1 = ones[low].astype(np.int64), ones[high].astype(np.int64)
            low, high = np.where(set_, zeros + low1, low - low1), np.where(set_, zeros + high1, high - high1)
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the index per phrase (one phrase a row, all of one length)."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, j].astype(np.int64)
            low[alive] = self.first[c] + self.rank(c, low[alive])
            high[alive] = self.first[c] + self.rank(c, high[alive])
            dead = low[alive] >= high[alive]
            high[alive[dead]] = low[alive[dead]]
            alive = alive[~dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows, by walking back to a sampled one."""
        rows, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), dtype=np.int64)
        open_ = np.flatnonzero(~self.marked[rows])
        while len(open_):
            c = self.bwt[rows[open_]].astype(np.int64)
            rows[open_] = self.first[c] + self.rank(c, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.marked[rows[open_]]]
        return self.samples[self.marks[rows]] + steps


def phrases_of(items: Sequence[tuple[int, str]], span: int) -> tuple[dict[str, int], np.ndarray, list[list[int]]]:
    """Vocabulary, distinct phrases of ``span`` words as codes, and the items of every phrase."""
    vocabulary: dict[str, int] = {}
    owners: dict[tuple[int, ...], list[int]] = {}
    for item, text in items:
        codes = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text or "")]
        for i in range(len(codes) - span + 1):
            held = owners.setdefault(tuple(codes[i : i + span]), [])
            if item not in held:
                held.append(item)
    return vocabulary, np.array(list(owners), dtype=np.int32).reshape(-1, span), list(owners.values())


def leaked_spans(
    corpus: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str,
    *, span: int = 14, shard: int = 300_000, item_block: int = 20_000,
) -> DataFrame:
    """Spans of test items in the corpus: ``doc_id, item_id, start_word, end_word`` (word places, end exclusive).

    A span is a maximal stretch of a document covered by occurrences of an item's phrases. Items of fewer than ``span``
    words, null and empty texts on either side give nothing; repeated documents each give their own spans. A document
    with words broken at line ends is indexed in both readings, so it may give a span twice at shifted places. A shard is up
    to ``shard`` codes of one partition; longer documents are cut into pieces that overlap by ``span - 1`` words. Items are
    searched in blocks of ``item_block``, each with an index over its own words: a shard is read and folded once and then
    indexed for one block after the other, so the phrases in use are bounded whatever the number of items. Blocks travel as
    broadcasts of that size. Nothing of the corpus is shuffled but an even spread of a coarse scan.
    """
    rows = spread(corpus.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull()))
    kind, item_kind = dict(corpus.dtypes)[doc_id], dict(items.dtypes)[item_id]
    schema = f"doc_id {kind}, item_id {item_kind}, start_word int, end_word int"
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text")).where("item_text is not null")
    context = corpus.sparkSession.sparkContext
    blocks = [context.broadcast(phrases_of(block, span)) for block in _blocks(wanted, item_block)]
    return rows.mapInPandas(_searcher(blocks, span, shard), schema)


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    for row in items.orderBy("item_id").toLocalIterator():
        block.append((row.item_id, row.item_text))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _searcher(blocks: Sequence, span: int, shard: int):
    """``blocks``: broadcasts of :func:`phrases_of`."""

    def search(pieces: list[tuple[object, int, list[int]]], sigma: int, phrases: np.ndarray, owners: list[list[int]]) -> pd.DataFrame:
        codes, places, docs, names = [], [], [], []
        for doc, offset, piece in pieces:
            seq = np.asarray(piece, dtype=np.int32)
            # a run of separators is one separator
            keep = (seq != 0) | np.concatenate(([True], seq[:-1] != 0))
            seq, place = seq[keep], np.flatnonzero(keep) + offset
            codes += [seq, np.zeros(1, np.int32)]
            places += [place, np.zeros(1, np.int64)]
            docs.append(np.full(len(seq) + 1, len(names)))
            names.append(doc)
        index = FmIndex(np.concatenate(codes), sigma)
        low, high = index.search(phrases)
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        rows = np.repeat(low[hit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = index.locate(rows)
        doc, place = np.concatenate(docs)[at], np.concatenate(places)[at]
        out = [
            (d, item, p) for d, p, h in zip(doc.tolist(), place.tolist(), np.repeat(hit, counts).tolist()) for item in owners[h]
        ]
        spans: list[list] = []
        for d, item, p in sorted(out):
            if spans and spans[-1][0] == d and spans[-1][1] == item and p <= spans[-1][3]:
                spans[-1][3] = max(spans[-1][3], p + span)
            else:
                spans.append([d, item, p, p + span])
        frame = pd.DataFrame(spans, columns=["doc_id", "item_id", "start_word", "end_word"])
        frame["doc_id"] = pd.Series([names[s[0]] for s in spans], dtype=object)
        return frame

    def indexed(texts: list[tuple[object, str]], vocabulary: dict[str, int]) -> Iterator[list[tuple[object, int, list[int]]]]:
        """Pieces of folded texts as codes, in lots of about a shard."""
        pieces: list[tuple[object, int, list[int]]] = []
        size = 0
        for doc, text in texts:
            for reading in readings_of(text, vocabulary):
                seq = [vocabulary.get(w, 0) for w in reading]
                for start in range(0, max(1, len(seq) - span + 1), shard):
                    piece = seq[start : start + shard + span - 1]
                    pieces.append((doc, start, piece))
                    size += len(piece) + 1
                    if size >= shard:
                        yield pieces
                        pieces, size = [], 0
        if pieces:
            yield pieces

    def flush(texts: list[tuple[object, str]]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            vocabulary, phrases, owners = block.value
            if len(phrases):
                for pieces in indexed(texts, vocabulary):
                    yield search(pieces, len(vocabulary), phrases, owners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: list[tuple[object, str]] = []
        size = 0
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                shown = fold(visible(text))
                texts.append((doc, shown))
                size += len(shown)
                if size >= CHARACTERS * shard:
                    yield from flush(texts)
                    texts, size = [], 0
        if texts:
            yield from flush(texts)

    return run


def leaked_items(spans: DataFrame) -> DataFrame:
    """One row per document and item."""
    return spans.select("doc_id", "item_id").distinct()
