"""Partition functions as Column expressions.

All arithmetic is done on bigint with explicit 32-bit masks: under ANSI mode an int
overflow raises, and a product of two 32-bit values still fits 63 bits here.

These forms take any text. ``staged`` has faster ones for whole-number and short keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK32 = 0xFFFFFFFF
MASK31 = 0x7FFFFFFF

# The public Murmur2 multiplier and the seed its segment-store users agree on.
MURMUR2_MULTIPLIER = 0x5BD1E995
MURMUR2_SEED = 0x9747B28C

# First supplementary code point, surrogate bases.
FIRST_SUPPLEMENTARY = 0x10000
HIGH_SURROGATE = 0xD800
LOW_SURROGATE = 0xDC00

PartitionFunction = Callable[[Column, int], Column]


def _low32(value: Column) -> Column:
    return value.bitwiseAND(F.lit(MASK32))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def java_hash(key: Column) -> Column:
    """31-polynomial over the UTF-16 units of ``key``, as an unsigned 32-bit bigint."""

    def fold(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        offset = code - FIRST_SUPPLEMENTARY
        high = F.lit(HIGH_SURROGATE) + F.shiftright(offset, 10)
        low = F.lit(LOW_SURROGATE) + offset.bitwiseAND(F.lit(0x3FF))
        # Only characters outside the basic plane take four UTF-8 bytes.
        return _low32(
            F.when(F.octet_length(char) < 4, acc * 31 + code).otherwise(acc * 961 + high * 31 + low)
        )

    return F.aggregate(F.split(key, ""), F.lit(0).cast("long"), fold)


def _word(block: Column) -> Column:
    """Little-endian 32-bit value of up to four one-byte characters; missing ones count 0."""
    return (
        F.ascii(block).cast("long")
        + F.ascii(F.substring(block, 2, 1)) * F.lit(1 << 8).cast("long")
        + F.ascii(F.substring(block, 3, 1)) * F.lit(1 << 16).cast("long")
        + F.ascii(F.substring(block, 4, 1)) * F.lit(1 << 24).cast("long")
    )


def _times(value: Column) -> Column:
    return _low32(value * MURMUR2_MULTIPLIER)


def _xorshift(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftright(value, bits))


def murmur2(key: Column) -> Column:
    """Murmur2 over the UTF-8 bytes of ``key``, as an unsigned 32-bit bigint."""
    # Read as Latin-1, every byte becomes one character.
    by_byte = F.decode(F.encode(key, "UTF-8"), "ISO-8859-1")
    length = F.octet_length(key)
    odd = length % 4
    blocks = F.regexp_extract_all(by_byte, F.lit("(?s).{4}"), F.lit(0))
    words = F.transform(blocks, lambda block: _times(_word(block)))
    mixed = F.transform(words, lambda word: _times(_xorshift(word, 24)))
    start = F.lit(MURMUR2_SEED).bitwiseXOR(length.cast("long"))
    whole = F.aggregate(mixed, start, lambda acc, word: _times(acc).bitwiseXOR(word))
    tail = _word(F.substring(by_byte, length - odd + 1, odd))
    finished = F.when(odd > 0, _times(whole.bitwiseXOR(tail))).otherwise(whole)
    return _bind(_bind(finished, lambda h: _times(_xorshift(h, 13))), lambda h: _xorshift(h, 15))


def hashcode_id(raw: Column, partitions: int) -> Column:
    """``|h| % partitions`` of a value that agrees with the hash in its low 32 bits."""
    # Sign-extend the low 32 bits, then |h|; masking sends the one value without a
    # positive counterpart (-2**31) to 0.
    signed = F.shiftright(F.shiftleft(raw, 32), 32)
    return (F.abs(signed).bitwiseAND(F.lit(MASK31)) % partitions).cast("int")


def pid_hashcode(key: Column, partitions: int) -> Column:
    return hashcode_id(java_hash(key), partitions)


def murmur_id(raw: Column, partitions: int) -> Column:
    return (raw.bitwiseAND(F.lit(MASK31)) % partitions).cast("int")


def pid_murmur(key: Column, partitions: int) -> Column:
    return murmur_id(murmur2(key), partitions)


def pid_modulo(key: Column, partitions: int) -> Column:
    """Non-negative remainder of a whole-number key; any other key fails the query."""
    text = key.cast("string")
    number = F.coalesce(
        text.try_cast("long"),
        F.raise_error(F.concat(F.lit("modulo partitioning needs a whole number, got: "), text)).cast("long"),
    )
    return F.pmod(number, F.lit(partitions)).cast("int")


DEFAULT_FUNCTION = "hashcode"
PARTITION_FUNCTIONS: dict[str, PartitionFunction] = {
    "hashcode": pid_hashcode,
    "murmur": pid_murmur,
    "modulo": pid_modulo,
}


def partition_function_name(name: str | None) -> str:
    """Canonical name; null or blank means hashcode, unknown names fail."""
    if name is None or not name.strip():
        return DEFAULT_FUNCTION
    if name.lower() not in PARTITION_FUNCTIONS:
        raise ValueError(f"unknown partition function: {name}")
    return name.lower()


def resolve_partition_function(name: str | None) -> PartitionFunction:
    return PARTITION_FUNCTIONS[partition_function_name(name)]


def partition_id(key: Column, function: str | None, partitions: int) -> Column:
    """Partition id in ``[0, partitions)`` of a key text column."""
    return resolve_partition_function(function)(key, max(partitions, 1))
