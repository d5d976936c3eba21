"""Units of texts (lines, wrapped ones joined again) and their statistics, for a whole batch at once.

A batch is one array of UTF-8 bytes. Every byte gets a class by table; counts per line are differences of running sums,
and a word is known by a hash of its bytes that is read off a running sum too. No text is handled on its own but those
with tags or entities. The same statistics as regular expressions of Spark cost 30 times the CPU seconds: each
pattern reads the text again at about 16 MB a second.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from brookweave.llm.text import BLOCK_TAG, INLINE_TAG, drop_comments, fold, replace_tags, unescaped

FEATURES = (
    "log_words", "common_share", "block_common", "symbol_share", "digit_share", "cells", "marker", "sentences", "ends_sentence",
    "repetition", "word_length", "vowel_share", "strange_share", "log_block_lines", "log_longest", "block_ends", "capital_share",
    "log_segment", "joints",
)
#: Bytes handled at once; a longer text is cut at a line end.
CHUNK = 1 << 20
#: Characters from which a line counts as full, so that the next one may continue it.
FULL = 24

SKIP, SPACE, LINE, LOWER, UPPER, DIGIT, END, CLOSE, PUNCT, CELL, COMMA, COLON, SYMBOL, STRANGE, LETTER = range(15)

_TABLE = np.full(256, SYMBOL, dtype=np.uint8)
_TABLE[0x80:0xC0] = SKIP  # continuation bytes
_TABLE[0xC0:] = LETTER  # lead bytes: refined by code point
for _chars, _class in (
    (" \x00", SPACE), ("\n", LINE), ("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("0123456789", DIGIT),
    (".!?", END), ("\"')]", CLOSE), ("(-/%&`_", PUNCT), ("|\t;{}=", CELL), (",", COMMA), (":", COLON),
):
    _TABLE[[ord(c) for c in _chars]] = _class
#: First code points of ranges beyond ASCII, and the class of each range.
_RANGES = [
    (0x80, STRANGE), (0xA0, SPACE), (0xA1, SYMBOL), (0xAA, LETTER), (0xAB, CLOSE), (0xAC, SYMBOL), (0xBB, CLOSE), (0xBC, SYMBOL), (0xC0, LETTER),
    (0xD7, SYMBOL), (0xD8, LETTER), (0xF7, SYMBOL), (0xF8, LETTER), (0x300, SKIP), (0x370, LETTER), (0x1AB0, SKIP), (0x1B00, LETTER), (0x1DC0, SKIP),
    (0x1E00, LETTER), (0x2000, SPACE), (0x200B, SKIP), (0x2010, PUNCT), (0x2018, CLOSE), (0x2020, SYMBOL), (0x2026, END), (0x2027, SYMBOL), (0x202A, SKIP),
    (0x202F, SPACE), (0x2030, SYMBOL), (0x2039, CLOSE), (0x203B, SYMBOL), (0x2060, SKIP), (0x2070, SYMBOL), (0x20D0, SKIP), (0x2100, SYMBOL),
    (0x2190, STRANGE), (0x2200, SYMBOL), (0x2500, STRANGE), (0x27C0, SYMBOL), (0x2B00, STRANGE), (0x2C00, LETTER), (0x3000, SPACE), (0x3001, PUNCT),
    (0x3002, END), (0x3003, PUNCT), (0x3040, LETTER), (0xE000, STRANGE), (0xF900, LETTER), (0xFE00, SKIP), (0xFE10, PUNCT), (0xFE20, SKIP), (0xFE30, PUNCT),
    (0xFE70, LETTER), (0xFEFF, SKIP), (0xFF00, LETTER), (0xFFF0, STRANGE), (0x10000, LETTER), (0x1F000, STRANGE), (0x20000, LETTER), (0xE0000, SKIP),
]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VOWELS = np.isin(np.arange(256), [ord(x) for x in "aeiouyAEIOUY"])
_STARTS, _CLASSES = np.array([r[0] for r in _RANGES]), np.array([r[1] for r in _RANGES], dtype=np.uint8)
_IN_WORD = np.isin(np.arange(15), (LOWER, UPPER, DIGIT, LETTER))
_TELLS = ~np.isin(np.arange(15), (SKIP, SPACE, LINE, CLOSE, STRANGE))
_BULLETS = np.array([ord(c) for c in "•·–▪‣◦●○■□"])

_LINES = r"\r\n|[\r\x0b\x0c\x{85}\x{2028}\x{2029}]"
#: UTF-8 read as Latin-1 or Windows-1252: a lead letter before what a continuation byte becomes.
_MISREAD = (
    r"[\x{C2}-\x{C6}\x{E1}\x{E2}][\x{80}-\x{BF}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17D}\x{17E}\x{192}\x{2C6}\x{2DC}\x{2013}-\x{203A}\x{20AC}\x{2122}]"
)
_CELL_TAG = re.compile(r"</?(?:td|th|tr|table|thead|tbody)\b[^<>]*>", re.I)
_ITEM_TAG = re.compile(r"<li\b[^<>]*>", re.I)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def plain(text: str) -> str:
    """A text with tags or entities as a reader sees it; the borders of table cells are kept as bars."""
    text = unescaped(text)
    if "<" in text:
        text = _ITEM_TAG.sub("\n- ", _CELL_TAG.sub("|", drop_comments(text)))
        text = replace_tags(INLINE_TAG, "", replace_tags(BLOCK_TAG, "\n", text))
    return text


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; kept, as every chunk needs them."""
    held = _KEPT.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 2 * CHUNK), base, dtype=np.uint64)
        held[0] = 1
        _KEPT[int(base)] = held = np.multiply.accumulate(held)
    return held[:n]


def word_hash(word: str) -> int:
    return int((np.frombuffer(word.encode(), np.uint8).astype(np.uint64) * _powers(_PRIME, len(word.encode()))).sum())


def common_hashes(common: Sequence[str]) -> np.ndarray:
    return np.unique(np.array([word_hash(w) for w in {fold(w) for w in common if w} if w], dtype=np.uint64))


def prepared(texts: pa.Array) -> pa.Array:
    """Without markup, with one kind of line end, marks of broken encoding as one sign, letters and accents apart; every
    text ends a line."""
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    marked = pc.or_(pc.match_substring(t, "<"), pc.match_substring(t, "&"))
    if pc.any(marked).as_py():
        t = pc.replace_with_mask(t, marked, pa.array([plain(x) for x in t.filter(marked).to_pylist()], pa.large_string()))
    t = pc.replace_substring_regex(t, _LINES, "\n")
    t = pc.replace_substring_regex(t, _MISREAD, "�")
    t = pc.utf8_normalize(t, "NFKD")
    t = pc.replace_substring(pc.replace_substring(t, "đ", "d"), "Đ", "D")
    # texts lie side by side in one array: none may run into the next
    return pc.binary_join_element_wise(t, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Prepared texts in chunks: the input row of every piece, and offsets and bytes as one array of pieces."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    rows: list[int] = []
    ends = [int(offsets[0])]
    for i in range(len(texts)):
        a, b = int(offsets[i]), int(offsets[i + 1])
        while a < b:
            cut = b
            if b - a > CHUNK:
                found = np.flatnonzero(data[a + CHUNK // 2 : a + CHUNK] == 10)
                cut = a + CHUNK // 2 + int(found[-1]) + 1 if len(found) else a + CHUNK
                while cut < b and data[cut] & 0xC0 == 0x80:
                    cut += 1
            rows.append(i)
            ends.append(cut)
            a = cut
            if cut - ends[0] >= CHUNK:
                yield np.array(rows), data[ends[0] : cut], np.array(ends) - ends[0]
                rows, ends = [], [cut]
    if rows:
        yield np.array(rows), data[ends[0] : ends[-1]], np.array(ends) - ends[0]


def _classes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class per byte, continuation bytes skipped; and the same with these in the class of their character."""
    c = _TABLE[b]
    whole = c
    lead = np.flatnonzero(b >= 0xC0)
    if len(lead):
        at = lambda k: np.where(lead + k < len(b), b[np.minimum(lead + k, len(b) - 1)], 0x80).astype(np.int64) & 0x3F
        x = b[lead].astype(np.int64)
        code = np.where(
            x < 0xE0, (x & 0x1F) << 6 | at(1), np.where(x < 0xF0, (x & 0xF) << 12 | at(1) << 6 | at(2), (x & 7) << 18 | at(1) << 12 | at(2) << 6 | at(3))
        )
        c[lead] = _CLASSES[np.maximum(np.searchsorted(_STARTS, code, side="right") - 1, 0)]
        c[lead[np.isin(code, _BULLETS)]] = SYMBOL
        whole = c.copy()
        for k, least in ((1, 0), (2, 0xE0), (3, 0xF0)):
            longer = lead[(x >= least) & (lead + k < len(b))]
            whole[longer + k] = c[longer]
    return c, whole


def unit_statistics(texts: pa.Array, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, visible characters and statistics (:data:`FEATURES`) of every unit of the texts, in order."""
    found = [_chunk(rows, data, ends, common) for rows, data, ends in _pieces(prepared(texts))]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(FEATURES)))
    return tuple(np.concatenate(part) for part in zip(*found))  # type: ignore[return-value]


def _chunk(rows: np.ndarray, b: np.ndarray, ends: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    # combining marks and invisible characters go, so that neighbours are neighbours
    c, whole = _classes(b)
    keep = whole != SKIP
    if not keep.all():
        ends = np.concatenate(([0], np.cumsum(keep)))[ends]
        b, c, whole = b[keep], c[keep], whole[keep]
    n = len(b)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(FEATURES)))
    # lines, cut at the ends of pieces too
    breaks = np.unique(np.concatenate((np.flatnonzero(c == LINE) + 1, ends[1:])))
    starts = np.concatenate(([0], breaks[:-1])) if len(breaks) else np.zeros(1, int)
    stops = breaks if len(breaks) else np.array([n])
    piece = np.searchsorted(ends, starts, side="right") - 1
    total = lambda mask: np.add.reduceat(mask.view(np.uint8), starts, dtype=np.int32)
    space = (c == SPACE) | (c == LINE) | (b == 9)
    shown = ~(space | (c == SKIP))
    size = total(shown)
    solid = np.append(np.flatnonzero(shown), n - 1)
    first = solid[np.searchsorted(solid, starts)] if n else starts
    last = solid[np.maximum(np.searchsorted(solid, stops) - 1, 0)]
    nxt = lambda a, k=1: np.concatenate((a[k:], np.zeros(min(k, n), a.dtype)))
    prv = lambda a, k=1: np.concatenate((np.zeros(k, a.dtype), a))[:n]
    at = lambda k: b[np.minimum(first + k, n - 1)]
    kind = lambda k: c[np.minimum(first + k, n - 1)]
    # list markers: a bullet and a space, or (1. 1) a) (a) and a space
    bracket = (at(0) == ord("(")).astype(int)
    p = lambda k: np.minimum(first + bracket + k, n - 1)
    closes = lambda k: ((b[p(k)] == ord(".")) | (b[p(k)] == ord(")"))) & space[p(k + 1)]
    digits = [c[p(k)] == DIGIT for k in range(3)]
    letter = (c[p(0)] == LOWER) | (c[p(0)] == UPPER)
    marker = (digits[0] & (closes(1) | digits[1] & (closes(2) | digits[2] & closes(3)))) | (letter & closes(1))
    marker |= np.isin(at(0), [ord(x) for x in "-*+"]) & space[np.minimum(first + 1, n - 1)]
    wide = np.flatnonzero((kind(0) == SYMBOL) & (at(0) >= 0xC0))
    if len(wide):
        width = np.where(at(0)[wide] >= 0xE0, 3, 2)
        marker[wide] |= space[np.minimum(first[wide] + width, n - 1)]
    marker &= size > 0
    # signs along the left edge of quoted or commented text
    bars = total(b == ord("|"))
    spaced = space[np.minimum(first + 1, n - 1)]
    edge = spaced & ((at(0) == ord(">")) | (at(0) == ord("#")) | ((at(0) == ord("|")) & (bars == 1)))
    slashes = (at(0) == ord("/")) & (at(1) == ord("/"))
    begin = np.minimum(first + np.where(slashes, 3, np.where(edge, 2, 0)), n - 1)
    # a line goes on in the next one
    full = (last - first + 1) >= FULL
    open_ = np.isin(c[last], (LOWER, UPPER, DIGIT, LETTER, COMMA, PUNCT))
    follows = np.zeros(len(starts), dtype=bool)
    if len(starts) > 1:
        plain_start = np.isin(c[begin], (LOWER, UPPER, DIGIT, LETTER, CLOSE, PUNCT)) & ~marker
        follows[1:] = full[:-1] & (size[1:] > 0) & plain_start[1:] & (open_[:-1] | (c[begin] == LOWER)[1:]) & (piece[1:] == piece[:-1]) & ((bars - edge)[1:] <= 0)
    held = size > 0
    line_unit = np.cumsum(~follows & held) - 1
    held_at = np.flatnonzero(held)
    if not len(held_at):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(FEATURES)))
    unit = line_unit[held_at]
    begins = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    summed = lambda mask: np.add.reduceat(total(mask)[held_at], begins).astype(float)
    units = len(begins)
    head_line = held_at[begins]
    tail_line = held_at[np.append(begins[1:], len(held_at)) - 1]
    # words
    word = _IN_WORD[whole]
    turns = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    w0, w1 = turns[::2], turns[1::2]
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[b] * _powers(_PRIME, n), dtype=np.uint64)))
    hashes = (run[w1] - run[w0]) * _powers(_BACK, n)[w0]
    line_of = np.searchsorted(starts, w0, side="right") - 1
    # a marker's number or letter is no word
    no_word = marker[line_of] & (w0 <= first[line_of] + 1) & (c[w0] != UPPER)
    w0, w1, hashes, line_of = (a[~no_word] for a in (w0, w1, hashes, line_of))
    word_unit = line_unit[line_of]
    known = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes if len(common) else np.zeros(len(hashes), bool)
    per = lambda weights=None: np.bincount(word_unit, weights, minlength=units).astype(float)
    words, commons, letters_in_words = per(), per(known), per(w1 - w0)
    longest = np.zeros(units)
    if len(w0):
        heads = np.flatnonzero(np.concatenate(([True], word_unit[1:] != word_unit[:-1])))
        longest[word_unit[heads]] = np.maximum.reduceat(w1 - w0, heads)
    # a unit's number and the upper bits of a word's hash in one key
    keys = np.sort(word_unit.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    fresh = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    distinct = np.bincount((fresh >> np.uint64(40)).astype(np.int64), minlength=units)
    # characters
    nspace = nxt(space)
    nspace[-1] = True
    gap = shown & prv(space) & prv(space, 2) & prv(space, 3)
    gap[first] = False
    between = prv(c == DIGIT) & nxt(c == DIGIT)
    cells = (c == CELL) | gap | ((c == COMMA) & ~nspace & ~between) | ((c == COLON) & (prv(b) == 34))
    cells |= (c == COLON) & nspace & (nxt(c == DIGIT, 2) | (nxt(b, 2) == ord("-")) | (nxt(b, 2) == ord("+")))
    # what stands between separators: a few words in an enumeration, a clause in a sentence
    parted = ((c == COMMA) | (c == END)) & nspace | (b == ord(";")) | ((b == ord("/")) & prv(space) & nspace)
    # signs and capitals inside of words, as machines write them
    letter = (c == LOWER) | (c == UPPER) | (c == LETTER)
    joints = ((c == END) | (c == COLON) | (b == ord("_")) | (b == ord("/"))) & prv(letter) & nxt(letter)
    joints |= (c == LOWER) & nxt(c == UPPER)
    sizes = summed(shown)
    some = np.maximum(sizes, 1)
    count = np.maximum(words, 1)
    telling = np.append(0, np.flatnonzero(_TELLS[c]))
    final = telling[np.searchsorted(telling, stops[tail_line]) - 1]
    ends_sentence = ((c[final] == END) & (final >= starts[head_line])).astype(float)
    letters = summed(letter)
    # blocks between blank lines
    blank_before = np.concatenate(([True], (np.diff(held_at[begins]) > 0) & (np.cumsum(~held)[held_at[begins][1:]] > np.cumsum(~held)[tail_line[:-1]])))
    blank_before |= np.concatenate(([True], piece[head_line][1:] != piece[head_line][:-1]))
    block = np.cumsum(blank_before) - 1
    in_block = lambda x: np.bincount(block, x)[block]
    in_lines = in_block(np.ones(units))
    stats = np.stack(
        [
            np.log1p(words), commons / count, in_block(commons) / np.maximum(in_block(words), 1), summed(c == SYMBOL) / some,
            summed(c == DIGIT) / some, np.minimum(summed(cells) / count, 3), marker[head_line].astype(float),
            np.minimum(summed((c == END) & (nspace | nxt(c == CLOSE))) / count * 10, 5), ends_sentence,
            np.where(words >= 6, 1 - distinct / count, 0), np.minimum(letters_in_words / count, 25), summed(_VOWELS[b]) / np.maximum(letters, 1),
            np.minimum(summed(c == STRANGE) / some, 1), np.log1p(in_lines), np.log1p(longest), in_block(ends_sentence) / in_lines,
            summed(c == UPPER) / some, np.log1p(words / (summed(parted) + 1)),
            np.minimum(summed(joints) / count, 2),
        ],
        axis=1,
    )
    return rows[piece[head_line]], sizes, stats
