"""Identifiers and hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace for object identifiers (RFC 9562).
NAMESPACE_OID = "6ba7b8129dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE_OID) -> Column:
    """Name-based UUID (version 5) in native expressions: SHA-1 of namespace and name, version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name.cast("string"), "UTF-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((nibble.bitwiseAND(F.lit(3))).bitwiseOR(F.lit(8)).cast("bigint")))
    part = lambda start, size: F.substring(digest, start, size)
    return F.when(
        name.isNotNull(),
        F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12)),
    )


def row_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 of the texts joined by ``||``; nulls are skipped."""
    return F.sha2(F.concat_ws("||", *[c.cast("string") for c in columns]), 256)
