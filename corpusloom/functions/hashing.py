"""Deterministic numbers from strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _little_endian(n: Column, size: int) -> Column:
    parts = [F.lpad(F.hex(F.shiftright(n, 8 * i).bitwiseAND(255)), 2, "0") for i in range(size)]
    return F.concat(*parts)


def pickled(text: Column) -> Column:
    """The bytes of Python's pickle, protocol 4, of a string: framed under 64 KiB, bare beyond."""
    raw = F.hex(text.cast("binary"))
    n = F.octet_length(text).cast("long")
    body = F.when(n < 256, F.concat(F.lit("8C"), _little_endian(n, 1), raw)).otherwise(F.concat(F.lit("58"), _little_endian(n, 4), raw))
    payload = F.concat(body, F.lit("942E"))
    size = (F.length(payload) / 2).cast("long")
    framed = F.concat(F.lit("800495"), _little_endian(size, 8), payload)
    return F.unhex(F.when(n < 65_536, framed).otherwise(F.concat(F.lit("8004"), payload)))


def random01(value: Column) -> Column:
    """A number in [0, 1] from the low 204 bits of the SHA-256 of a value's pickled string, as a double."""
    digest = F.sha2(pickled(value.cast("string")), 256)
    return F.conv(F.substring(digest, 14, 13), 16, 10).cast("double") / F.lit(float(2**52))


def random_range(value: Column, low: int, high: int) -> Column:
    return F.bround(F.lit(low - 0.5) + random01(value) * F.lit(high + 1 - low), 0).cast("long")


def pick(choices: list[str], key: Column, salt: str) -> Column:
    """One of the choices, by the hash of a key and a salt."""
    at = F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(salt + ":"), key.cast("string")), 256), 1, 8), 16, 10).cast("long"), F.lit(len(choices)))
    return F.element_at(F.array(*map(F.lit, choices)), (at + 1).cast("int"))
