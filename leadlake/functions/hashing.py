"""Hashes, surrogate keys and keyed tokens, all with Spark's own digest functions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "~"


def canonical(column: Column, number: bool) -> Column:
    """One text per value, independent of the engine's float printing; NULL has its own mark."""
    text = column.cast("decimal(38,10)").cast("string") if number else column.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def record_hash(numbers: Sequence[str] = ("age", "balance", "day"), order: Sequence[str] | None = None) -> Column:
    """MD5 over the business columns age, job, balance, day, month."""
    columns = order or ("age", "job", "balance", "day", "month")
    return F.md5(F.concat_ws("_", *[canonical(F.col(c), c in numbers) for c in columns]))


def surrogate_id(prefix: str, columns: Sequence[str], numbers: Sequence[str] = ()) -> Column:
    """Id from the natural key: needs no global order and is the same on every re-run. The whole digest is kept, so that
    different keys have different ids at any number of rows."""
    text = F.concat_ws("|", *[canonical(F.col(c), c in numbers) for c in columns])
    return F.concat(F.lit(prefix), F.sha2(text, 256))


def hash_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5; equal keys always get equal numbers."""
    digest = F.md5(F.concat_ws("#", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hmac_sha256(message: Column, key: str) -> Column:
    """Hex HMAC-SHA256 (RFC 2104) from two nested digests; the pads come from the key on the driver."""
    raw = key.encode("utf-8")
    block = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)
    inner_digest = F.sha2(F.concat(F.lit(bytearray(inner)), message.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(bytearray(outer)), F.unhex(inner_digest)), 256)


def token(identifier: Column, salt: str) -> Column:
    """Stable pseudonym of an id. The salt is the caller's secret and has no default."""
    if not salt:
        raise ValueError("a salt is required")
    named = F.concat(F.lit("TOKEN_"), F.substring(hmac_sha256(identifier, salt), 1, 16))
    return F.when(F.length(identifier) > 0, named).otherwise(F.lit("ANONYMOUS"))
