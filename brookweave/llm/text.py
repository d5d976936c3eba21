"""Text as a reader sees it: markup, entities, character forms, invisible characters, letter case and accents."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Container

#: Characters that show nothing: soft hyphen, zero-width marks, joiners, direction marks, variation selectors.
INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff]")
#: Tags after which a reader sees a new line or cell; other tags leave the letters around them together.
BLOCK_TAG = re.compile(r"</?(?:p|br|div|li|ul|ol|tr|td|th|table|thead|tbody|h[1-6]|hr|blockquote|pre|section|article)\b(?![:_-])[^<>]*>", re.I)
INLINE_TAG = re.compile(r"</?[a-zA-Z][a-zA-Z0-9:_-]*(?:\s[^<>]*)?/?>")
#: A tag may have any length, but what is longer than ``BARE_TAG`` is a tag only if it gives an attribute a value: text
#: between two signs of comparison does not.
BARE_TAG = 220
ATTRIBUTE = re.compile(r"\w=\S|=\s*[\"']")
COMBINING = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
#: A word broken at the end of a line, before the sign that starts the next line of a quotation or comment.
BROKEN_WORD = re.compile(r"(?<=[^\W_])[-\u2010\u00ad][^\S\n]*(?:\r\n|[\n\r\x85\u2028])[^\S\n]*(?:(?:[|>#*]|//)+[^\S\n]*)*(?=[^\W_])")
SOFT_BREAK = re.compile(r"\u00ad[^\S\n]*(?:\r\n|[\n\r])[^\S\n]*")
JOIN = "\x00"
WORD = re.compile(r"[^\W_]+")
JOINED = re.compile(r"[^\W_]+(?:\x00[^\W_]+)*")


def drop_comments(text: str) -> str:
    """Without comments of any length; one that never ends is text. A comment may end in its opening, as in ``<!-->``."""
    kept, at = [], 0
    while (start := text.find("<!--", at)) >= 0 and (end := text.find("-->", start + 2)) >= 0:
        kept.append(text[at:start])
        at = end + 3
    return "".join(kept) + text[at:] if at else text


def replace_tags(pattern: re.Pattern[str], by: str, text: str) -> str:
    return pattern.sub(lambda m: by if len(m[0]) <= BARE_TAG or ATTRIBUTE.search(m[0]) else m[0], text)


def unescaped(text: str) -> str:
    """Without entities, however often they were escaped. Each pass makes the text shorter, so there is a last one."""
    while "&" in text and (shown := html.unescape(text)) != text:
        text = shown
    return text


def visible(text: str, tags: bool = True) -> str:
    """Entities resolved (again and again, for text escaped several times), tags removed, compatibility forms composed,
    invisibles gone."""
    text = unescaped(text)
    if tags and "<" in text:
        text = replace_tags(INLINE_TAG, "", replace_tags(BLOCK_TAG, "\n", drop_comments(text)))
    if not text.isascii():
        text = unicodedata.normalize("NFKC", INVISIBLE.sub("", SOFT_BREAK.sub("", text)))
    return text


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    text = COMBINING.sub("", unicodedata.normalize("NFKD", text.casefold()))
    return text.replace("đ", "d").replace("ð", "d").replace("ł", "l").replace("ø", "o")


def words(text: str) -> list[str]:
    """Folded runs of letters and digits of a raw text."""
    return WORD.findall(fold(visible(text)))


def readings(text: str, known: Container[str]) -> list[list[str]]:
    """The words of a raw text: one list, or two where words are broken at line ends. A hyphen there may belong to the
    word or to the layout: in the first reading the halves are one word where ``known`` holds it, in the second the
    hyphen separates."""
    return readings_of(fold(visible(text)), known)


def readings_of(shown: str, known: Container[str]) -> list[list[str]]:
    """:func:`readings` of a text that is folded already."""
    marked = BROKEN_WORD.sub(JOIN, shown.replace(JOIN, " ")) if "\n" in shown or "\r" in shown else shown
    if JOIN not in marked:
        return [WORD.findall(shown)]
    joined = []
    for run in JOINED.findall(marked):
        halves = run.split(JOIN)
        whole = "".join(halves)
        joined += [whole] if whole in known else halves
    apart = WORD.findall(marked.replace(JOIN, " "))
    return [joined] if joined == apart else [joined, apart]
