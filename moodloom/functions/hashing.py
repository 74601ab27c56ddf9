"""Murmur3 of a text, 32 bits, as Spark ML's hashed features use it (inventory ML-3).

``F.hash`` treats the up to three bytes after the last whole block in its own way; here they are one short block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodloom.functions import rules
from moodloom.functions.text import ColumnOrName, as_column

# Fixed values of the hash: multipliers of a block, of the end, what is added to a block's sum, and the seed.
BLOCK = (0xCC9E2D51, 0x1B873593)
END = (0x85EBCA6B, 0xC2B2AE35)
ADDED = 0xE6546B64
SEED = 42
MASK = 0xFFFFFFFF


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def times(x: Column, factor: int) -> Column:
    """The low 32 bits of a product; half of the factor at a time, so that no long overflows."""
    high = F.shiftleft((x * (factor >> 16)).bitwiseAND(0xFFFF), 16)
    return (high + x * (factor & 0xFFFF)).bitwiseAND(MASK)


def turned(x: Column, bits: int) -> Column:
    return let(x, lambda v: F.shiftleft(v, bits).bitwiseAND(MASK).bitwiseOR(F.shiftright(v, 32 - bits)))


def mixed(block: Column) -> Column:
    return times(turned(times(block, BLOCK[0]), 15), BLOCK[1])


def folded(x: Column, bits: int) -> Column:
    return let(x, lambda v: v.bitwiseXOR(F.shiftright(v, bits)))


def murmur3(text: ColumnOrName) -> Column:
    """The signed hash of the UTF-8 bytes; null of a null."""

    def number(digits: Column) -> Column:
        """Up to four bytes in hexadecimal, the first one lowest."""
        pairs = [F.substr(digits, F.lit(at), F.lit(2)) for at in (7, 5, 3, 1)]
        return F.coalesce(F.conv(F.concat(*pairs), 16, 10).cast("long"), F.lit(0).cast("long"))

    def of_bytes(data: Column) -> Column:
        length = F.octet_length(data)
        digits = F.hex(data)
        blocks = F.floor(length / 4).cast("int")
        places = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))

        def add(h: Column, block: Column) -> Column:
            k = number(F.substr(digits, block * 8 + 1, F.lit(8)))
            return (turned(h.bitwiseXOR(mixed(k)), 13) * 5 + ADDED).bitwiseAND(MASK)

        h = F.aggregate(places, F.lit(SEED).cast("long"), add)
        h = h.bitwiseXOR(mixed(number(F.substr(digits, blocks * 8 + 1, F.lit(8))))).bitwiseXOR(length.cast("long"))
        h = folded(times(folded(times(folded(h, 16), END[0]), 13), END[1]), 16)
        return let(h, lambda v: F.when(v > MASK >> 1, v - (MASK + 1)).otherwise(v).cast("int"))

    return let(as_column(text).cast("binary"), of_bytes)


def bucket(word: ColumnOrName, num_features: int = rules.HASHED_FEATURES) -> Column:
    """The hashed feature of a word, from 0."""
    return F.pmod(murmur3(word), F.lit(num_features))
