"""Masking of personal data by format-preserving encryption.

Every maximal run of one class of characters (digits, lower case, upper case) is permuted within its class and length
by an alternating Feistel network over its alphabet, keyed by HMAC-SHA256; other characters stay. Equal values give
equal masks under one key, and :func:`unmask` inverts them. It fails closed: without a key nothing is planned, and an
error in a value ends the job rather than letting the plain value through. The functions run as Arrow-batched UDFs;
a batch masks each distinct value once. Numbers are masked by whole batches, with the same result as one by one.
"""

from __future__ import annotations

import calendar
import datetime as dt
import hashlib
import hmac
import re
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.columns import col, pick, type_of
from brookweave.registry import operator

CLASSES = (("0", 10), ("a", 26), ("A", 26))
ROUNDS = 10
RUN = re.compile(r"[0-9]+|[a-z]+|[A-Z]+")


def _prf(key: bytes, tweak: str, modulus: int) -> int:
    need = (modulus.bit_length() + 71) // 8  # eight bytes more than the modulus keep the bias negligible
    out = hmac.digest(key, tweak.encode(), "sha256")
    while len(out) < need:
        out += hmac.digest(key, out[-32:] + tweak.encode(), "sha256")
    return int.from_bytes(out[:need], "big") % modulus


@lru_cache(maxsize=4096)
def _shuffle(key: bytes, label: str, n: int) -> tuple[int, ...]:
    return tuple(sorted(range(n), key=lambda i: hmac.new(key, f"{label}:{n}:{i}".encode(), hashlib.sha256).digest()))


def permute(key: bytes, values: Sequence[int], radix: int, back: bool = False) -> list[int]:
    """A keyed permutation of the digit strings of one length and radix."""
    n = len(values)
    if n == 1:
        table = _shuffle(key, f"digit{radix}", radix)
        return [table.index(values[0]) if back else table[values[0]]]
    u = n // 2
    a = b = 0
    for x in values[:u]:
        a = a * radix + x
    for x in values[u:]:
        b = b * radix + x
    sizes = (radix**u, radix ** (n - u))
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        tag = f"{radix}:{n}:{r}:"
        if r % 2 == 0:
            shift = _prf(key, tag + str(b), sizes[0])
            a = (a - shift if back else a + shift) % sizes[0]
        else:
            shift = _prf(key, tag + str(a), sizes[1])
            b = (b - shift if back else b + shift) % sizes[1]
    out = []
    for x, size in ((b, n - u), (a, u)):
        for _ in range(size):
            out.append(x % radix)
            x //= radix
    return out[::-1]


def mask_value(key: bytes, text: str | None, back: bool = False) -> str | None:
    """Masks a text run by run (``back``: restores it)."""

    def one(m: re.Match) -> str:
        run = m.group(0)
        base, radix = next((ord(b), n) for b, n in CLASSES if ord(b) <= ord(run[0]) < ord(b) + n)
        return "".join(chr(base + d) for d in permute(key, [ord(c) - base for c in run], radix, back))

    return None if text is None else RUN.sub(one, text)


def mask_number(key: bytes, number: int, top: int, back: bool = False) -> int:
    """A permutation of the numbers of one sign and count of digits up to ``top``: the digits are permuted again until
    they are such a number, so every number has a mask of its kind and can be restored."""
    size, digits = abs(number), str(abs(number))
    low = 10 ** (len(digits) - 1) if len(digits) > 1 else int(number < 0)
    high = min(10 ** len(digits) - 1, top + (number < 0))
    while True:
        size = int("".join(map(str, permute(key, [int(c) for c in str(size).zfill(len(digits))], 10, back))))
        if low <= size <= high:
            return -size if number < 0 else size


def _without_point(text: str) -> int:
    return int(f"{Decimal(text):f}".replace(".", ""))  # never in exponents


def _with_point(number: int, scale: int) -> str:
    digits = str(abs(number)).zfill(scale + 1)
    return ("-" if number < 0 else "") + (digits[:-scale] + "." + digits[-scale:] if scale else digits)


def mask_decimal(key: bytes, text: str, scale: int, back: bool = False) -> str:
    """As :func:`mask_number`, on the digits without the point."""
    return _with_point(mask_number(key, _without_point(text), 10**38, back), scale)


TOPS = {"int": 2**31 - 1, "bigint": 2**63 - 1}
POWERS = 10 ** np.arange(20, dtype=np.uint64)
#: Shifts by halves of up to this many values are kept in a table, 4 MB at most; EMPTY is one not made yet. All tables of
#: one key (numbers of up to 13 digits) take 90 MB when full.
TABLED, EMPTY = 10**6, 2**32 - 1


@lru_cache(maxsize=256)
def _table(key: bytes, tag: str, size: int) -> np.ndarray:
    return np.full(size, EMPTY, dtype=np.uint32)


@lru_cache(maxsize=256)
def _pads(key: bytes, tag: str):
    """The two hashes of an HMAC-SHA256, after the key and the tag."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return hashlib.sha256(bytes(c ^ 0x36 for c in block) + tag.encode()), hashlib.sha256(bytes(c ^ 0x5C for c in block))


def _prfs(key: bytes, tag: str, values: np.ndarray, modulus: int) -> np.ndarray:
    """:func:`_prf` of the tag followed by each value, for a modulus of at most 2^34, so that one digest is enough."""
    inner, outer = _pads(key, tag)
    digests = []
    for x in values.tolist():
        (i := inner.copy()).update(b"%d" % x)
        (o := outer.copy()).update(i.digest())
        digests.append(o.digest())
    need = (modulus.bit_length() + 71) // 8
    held = np.zeros((len(digests), need + need % 2), dtype=np.uint8)
    held[:, need % 2 :] = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)[:, :need]
    rest = np.zeros(len(digests), dtype=np.uint64)
    for pair in held.view(">u2").T:
        rest = ((rest << np.uint64(16)) | pair) % np.uint64(modulus)
    return rest


def _shifts(key: bytes, tag: str, halves: np.ndarray, size: int, modulus: int) -> np.ndarray:
    if size > TABLED:
        return _prfs(key, tag, halves, modulus).view(np.int64)
    table = _table(key, tag, size)
    out = table[halves]
    if (empty := out == EMPTY).any():
        new = np.unique(halves[empty])
        table[new] = _prfs(key, tag, new, modulus)
        out = table[halves]
    return out.astype(np.int64)


def _permute_all(key: bytes, numbers: np.ndarray, n: int, back: bool = False) -> np.ndarray:
    """:func:`permute` of the ``n`` decimal digits of each number."""
    if n == 1:
        table = np.array(_shuffle(key, "digit10", 10))
        return (np.argsort(table) if back else table)[numbers].astype(np.uint64)
    u = n // 2
    sizes = (10**u, 10 ** (n - u))
    upper = numbers // np.uint64(sizes[1])
    halves = [upper.view(np.int64), (numbers - upper * np.uint64(sizes[1])).view(np.int64)]
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        k = r % 2
        shift = _shifts(key, f"10:{n}:{r}:", halves[1 - k], sizes[1 - k], sizes[k])
        one, other = (halves[k] - shift, sizes[k]) if back else (halves[k] + shift, -sizes[k])
        # of the sum and the sum less its modulus, the one that is not negative: as it is less when read without a sign
        halves[k] = np.minimum(one.view(np.uint64), (one + other).view(np.uint64)).view(np.int64)
    return halves[0].view(np.uint64) * np.uint64(sizes[1]) + halves[1].view(np.uint64)


def mask_numbers(key: bytes, numbers: np.ndarray, top: int, back: bool = False) -> np.ndarray:
    """:func:`mask_number` of each of an array of 64-bit numbers."""
    negative = numbers < 0
    sizes = np.where(negative, -numbers, numbers).view(np.uint64)  # the least number keeps its bits
    digits = np.maximum(np.searchsorted(POWERS, sizes, side="right"), 1)
    out = np.empty_like(sizes)
    for n in np.unique(digits).tolist():
        left = np.flatnonzero(digits == n)
        x, below = sizes[left], negative[left].astype(np.uint64)
        low = np.full_like(below, 10 ** (n - 1)) if n > 1 else below
        high = np.minimum(np.uint64(10**n - 1), np.uint64(min(top, 10**19 - 1)) + below)
        while len(left):
            x = _permute_all(key, x, n, back)
            done = (low <= x) & (x <= high)
            out[left[done]] = x[done]
            left, x, low, high = (v[~done] for v in (left, x, low, high))
    return np.where(negative, -out.view(np.int64), out.view(np.int64))


#: Recognised shapes of phone numbers: the matched head stays, the rest is masked.
PHONE_HEADS = (
    re.compile(r"^\(\+[0-9]{2}\)\s?\([0-9]{2,3}\)"),
    re.compile(r"^\(\+[0-9]{2}\)\s?[0-9]{2}"),
    re.compile(r"^\([0-9]{2,3}\)"),
    re.compile(r"^\+[0-9]{2}\s?[0-9]{2}"),
)


def mask_phone_value(key: bytes, text: str | None) -> str | None:
    """Keeps the operator's prefix of a recognised shape; in any other shape all digits are masked."""
    if text is None:
        return None
    text = text.strip()
    head = next((m.end() for p in PHONE_HEADS if (m := p.match(text))), 0)
    if not head and text.isdigit() and len(text) in (10, 11):
        head = len(text) - 7
    return text[:head] + mask_value(key, text[head:])


def keep_first(key: bytes, text: str | None, pattern: str) -> str | None:
    """Where the text begins with the pattern, that part stays and the rest is masked; any other text is masked wholly."""
    if text is None:
        return None
    m = re.match(pattern, text)
    return text[: m.end()] + mask_value(key, text[m.end() :]) if m else mask_value(key, text)


def keep_last(key: bytes, text: str | None, pattern: str) -> str | None:
    """Where the text begins with the pattern, that part is masked and the rest stays; any other text is masked wholly."""
    if text is None:
        return None
    m = re.match(pattern, text)
    return mask_value(key, m.group(0)) + text[m.end() :] if m else mask_value(key, text)


def mask_words(key: bytes, text: str | None) -> str | None:
    """Word by word, with one blank between words."""
    return None if text is None else " ".join(mask_value(key, w) for w in text.split())


def mask_email_value(key: bytes, text: str | None) -> str | None:
    """Masks what stands before the first @ and keeps the rest; without @ all is masked."""
    if text is None:
        return None
    local, at, domain = text.partition("@")
    return mask_value(key, local) + at + domain


def mask_date_value(key: bytes, text: str | None, fmt: str) -> str | None:
    """Moves the month within the months of its length and the day within the month; text of another form is null."""
    if text is None:
        return None
    try:
        day = dt.datetime.strptime(text, fmt)
    except ValueError:
        return None
    size = calendar.monthrange(day.year, day.month)[1]
    months = [m for m in range(1, 13) if calendar.monthrange(day.year, m)[1] == size]
    month = months[_shuffle(key, "month", len(months))[months.index(day.month)]]
    return day.replace(month=month, day=_shuffle(key, "day", size)[day.day - 1] + 1).strftime(fmt)


def _udf(f: Callable[[str | None], str | None]):
    def run(values: pd.Series) -> pd.Series:
        known: dict = {None: None}
        out = []
        for v in values:
            v = None if v is None or v != v else v
            if v not in known:
                known[v] = f(v)
            out.append(known[v])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "string")


def _array_udf(f: Callable[[str | None], str | None]):
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else [f(x) for x in v] for v in values], dtype=object)

    return F.pandas_udf(run, "array<string>")


def _number_udf(key: bytes, back: bool, top: int):
    def run(values: pa.Array) -> pa.Array:
        found, at = np.unique(values.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True)
        return pa.array(mask_numbers(key, found, top, back)[at], mask=values.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(run, "bigint")


def _decimal_udf(key: bytes, back: bool, scale: int):
    """For decimals that may be longer than 18 digits; those that are not go by the batch."""

    def run(values: pd.Series) -> pd.Series:
        known = {v: _without_point(v) for v in values.dropna().unique()}
        short = [v for v, number in known.items() if abs(number) < 10**18]
        masks = mask_numbers(key, np.array([known[v] for v in short], dtype=np.int64), 10**18, back).tolist()
        out = {v: _with_point(m, scale) for v, m in zip(short, masks)}
        out |= {v: mask_decimal(key, v, scale, back) for v in known if v not in out}
        return pd.Series([out.get(v) for v in values], dtype=object)

    return F.pandas_udf(run, "string")


def _secret(key: str | bytes | None) -> bytes:
    if not key:
        raise ValueError("masking needs a key")
    return key.encode() if isinstance(key, str) else key


def _masked(df: DataFrame, names: Sequence[str], f: Callable[[str | None], str | None], numbers: tuple[bytes, bool] | None = None) -> DataFrame:
    """``numbers``: key and direction by which columns of numbers keep to their range; without it they go by their text."""
    text, items = _udf(f), _array_udf(f)
    out: dict[str, Column] = {}
    for name in names:
        kind = type_of(df, name)
        if numbers and kind in TOPS:
            out[name] = _number_udf(*numbers, TOPS[kind])(col(name).cast("bigint")).cast(kind)
        elif numbers and kind.startswith("decimal"):
            precision, scale = map(int, kind[8:-1].split(","))
            if precision <= 18:  # the digits without the point are a whole number
                whole = (col(name) * F.lit(Decimal(10**scale))).cast("bigint")
                out[name] = (_number_udf(*numbers, 10**18)(whole).cast("decimal(19,0)") * F.lit(Decimal((0, (1,), -scale)))).cast(kind)
            else:
                out[name] = _decimal_udf(*numbers, scale)(col(name).cast("string")).cast(kind)
        elif kind in ("string", "int", "bigint") or kind.startswith("decimal"):
            out[name] = text(col(name).cast("string")).try_cast(kind)
        elif kind == "array<string>":
            out[name] = items(col(name))
        elif kind.startswith("map<string,"):
            values = items(F.map_values(col(name)).cast("array<string>"))
            out[name] = F.when(col(name).isNotNull(), F.map_from_arrays(F.map_keys(col(name)), values)).cast(kind)
    return df.withColumns(out)


@operator("create_mask_pii_df")
def mask_pii(df: DataFrame, column_patterns: Sequence[str], key: str | bytes | None = None) -> DataFrame:
    """Masks text, whole numbers, decimals, arrays of text and maps with text keys; columns of other types are left.
    A number keeps its sign, its count of digits and its type's range."""
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_value(secret, v), (secret, False))


@operator("create_mask_pii_df_with_condition")
def mask_pii_with_condition(
    df: DataFrame, column_patterns: Sequence[str], filter_conditions: Mapping[str, Mapping[str, str]], key: str | bytes | None = None
) -> DataFrame:
    """Masks the matched columns of rows in which the source and destination columns differ; the others stay."""
    secret = _secret(key)
    pair = filter_conditions["not_equal"]
    differ = ~col(pair["source_column"]).eqNullSafe(col(pair["destination_column"]))
    names = [c for c in pick(df, column_patterns) if type_of(df, c) == "string"]
    f = _udf(lambda v: mask_value(secret, v))
    return df.withColumns({c: F.when(differ, f(col(c))).otherwise(col(c)) for c in names})


@operator()
def fpe_mask_phone_number(df: DataFrame, column_patterns: Sequence[str], key: str | bytes | None = None) -> DataFrame:
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_phone_value(secret, v))


@operator()
def fpe_mask_email(df: DataFrame, column_patterns: Sequence[str], key: str | bytes | None = None) -> DataFrame:
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_email_value(secret, v))


@operator("create_mask_pii_datetime_df")
def fpe_mask_datetime(df: DataFrame, column_patterns: Sequence[str], datetime_format: str = "%Y-%m-%d", key: str | bytes | None = None) -> DataFrame:
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_date_value(secret, v, datetime_format))


@operator()
def fpe_mask_pattern(
    df: DataFrame, column_patterns: Sequence[str], pattern: str, keep: str = "last", key: str | bytes | None = None
) -> DataFrame:
    """Masks what the pattern finds at the start (``keep="last"``) or what follows it (``keep="first"``)."""
    secret = _secret(key)
    if keep not in ("first", "last"):
        raise ValueError(f"keep is first or last, not {keep}")
    one = keep_first if keep == "first" else keep_last
    return _masked(df, pick(df, column_patterns), lambda v: one(secret, v, pattern))


@operator()
def fpe_mask_words(df: DataFrame, column_patterns: Sequence[str], key: str | bytes | None = None) -> DataFrame:
    """Masks texts word by word; outer and repeated white space goes."""
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_words(secret, v))


@operator()
def unmask_pii(df: DataFrame, column_patterns: Sequence[str], key: str | bytes | None = None) -> DataFrame:
    """Restores what :func:`mask_pii` made."""
    secret = _secret(key)
    return _masked(df, pick(df, column_patterns), lambda v: mask_value(secret, v, back=True), (secret, True))
