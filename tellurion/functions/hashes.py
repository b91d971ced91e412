"""Hashes that other systems compute alike: FNV-1a of 64 bits, and one of a map whatever the order of its entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of FNV-1a with 64 bits: where it begins, and the low part of its prime 2^40 + 0x1B3.
FNV_BASIS, FNV_LOW = 14695981039346656037, 0x1B3
_MASK = (1 << 32) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fnv1a(text: str | Column, start: int | Column = FNV_BASIS) -> Column:
    """FNV-1a of a text's UTF-8 bytes, as a long (the unsigned value's bits); null for null. `start` may be another hash, which goes on.

    Spark's products raise an error where they overflow, so the product with the prime is made from halves of 32 bits: the prime is
    2^40 + 0x1B3, the first of which shifts the low half by 8 bits into the high one.
    """
    c = F.col(text) if isinstance(text, str) else text
    digits = F.hex(F.encode(c, "UTF-8"))
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("bigint")

    def step(h: Column, i: Column) -> Column:
        x = h.bitwiseXOR(byte(i))
        low, high = x.bitwiseAND(_MASK), F.shiftrightunsigned(x, 32)
        product = low * FNV_LOW
        top = (high * FNV_LOW + F.shiftrightunsigned(product, 32) + F.shiftleft(low, 8)).bitwiseAND(_MASK)
        return F.shiftleft(top, 32).bitwiseOR(product.bitwiseAND(_MASK))

    begin = F.lit(_signed(start)) if isinstance(start, int) else start
    places = F.when(c == "", F.slice(F.array(F.lit(0)), 1, 0)).otherwise(F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1))
    return F.when(c.isNotNull(), F.aggregate(places, begin.cast("bigint"), step))


def map_hash(m: str | Column) -> Column:
    """A long of a map of texts, the same for equal maps in any order: the first 128 bits of a SHA-256 of its entries in order, their
    halves folded by exclusive or. Null for null."""
    c = F.col(m) if isinstance(m, str) else m
    entries = F.to_json(F.array_sort(F.map_entries(c)), {"ignoreNullFields": "false"})
    half = lambda at: _unsigned_hex(F.substring(F.sha2(entries, 256), at, 16))
    return F.when(c.isNotNull(), half(1).bitwiseXOR(half(17)))


def _unsigned_hex(digits: Column) -> Column:
    """The bits of 16 hex digits as a long."""
    part = lambda at: F.conv(F.substring(digits, at, 8), 16, 10).cast("bigint")
    return F.shiftleft(part(1), 32).bitwiseOR(part(9))
