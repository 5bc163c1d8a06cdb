"""Partition functions against published vectors and independent Python versions."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segloom.functions.hashing import (
    java_hash,
    murmur2,
    partition_function_name,
    partition_id,
    resolve_partition_function,
)
from segloom.operators.assign import with_partition_id

BIG = 2**31 - 1


def py_java_hash(text):
    h = 0
    raw = text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (31 * h + 256 * raw[i] + raw[i + 1]) % 2**32
    signed = h - 2**32 if h >= 2**31 else h
    return 0 if signed == -(2**31) else abs(signed)


def py_murmur2(text):
    data, mask, m = text.encode(), 2**32 - 1, 0x5BD1E995
    h = 0x9747B28C ^ len(data)
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        k = int.from_bytes(data[i : i + 4], "little") * m & mask
        h = (h * m & mask) ^ ((k ^ k >> 24) * m & mask)
    if len(data) > whole:
        h = (h ^ int.from_bytes(data[whole:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


@pytest.mark.parametrize(
    "value, partitions, expected",
    [
        ("maple", 5, 2),
        ("juniper", 7, 0),
        ("hazel", 3, 1),
        ("rowan", 10, 1),
        ("alder", 7, 1),
        ("polygenelubricants", 9, 0),  # fixed value: the well-known text whose hash is the least integer
        ("anything", 1, 0),
    ],
)
def test_hashcode_vectors(spark, value, partitions, expected):
    df = column(spark, [value], "string")
    assert df.select(partition_id(F.col("k"), "hashcode", partitions)).first()[0] == expected
    assert with_partition_id(df, "k", "hashcode", partitions).first().pid == expected


@pytest.mark.parametrize(
    "value, signed",
    [
        ("21", -973932308),
        ("foobar", -790332482),
        ("abc", 479470107),
        ("a-little-bit-long-string", -985981536),
        ("a-little-bit-longer-string", -1486304829),
    ],
)
def test_murmur2_vectors(spark, value, signed):
    df = column(spark, [value], "string")
    assert df.select(murmur2(F.col("k"))).first()[0] == signed % 2**32
    assert with_partition_id(df, "k", "murmur", BIG).first().pid == (signed & BIG) % BIG


@pytest.mark.parametrize("value, partitions, expected", [("12", 5, 2), ("10", 5, 0), ("8", 5, 3), ("0", 4, 0), ("42", 1, 0)])
def test_modulo_vectors(spark, value, partitions, expected):
    df = column(spark, [value], "string")
    assert with_partition_id(df, "k", "modulo", partitions).first().pid == expected
    numbers = column(spark, [int(value)], "long")
    assert with_partition_id(numbers, "k", "modulo", partitions).first().pid == expected


def test_modulo_negative_stays_in_range(spark):
    assert with_partition_id(column(spark, ["-7"], "string"), "k", "modulo", 5).first().pid == 3
    assert with_partition_id(column(spark, [-7], "int"), "k", "modulo", 5).first().pid == 3


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value, kind", [("notANumber", "string"), ("3.14", "string"), (None, "string"), (None, "long")])
def test_modulo_rejects_other_keys(spark, value, kind, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            with_partition_id(column(spark, [value], kind), "k", "modulo", 5).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def numbers():
    rng = random.Random(7)
    edge = [0, 2**63 - 1, -(2**63)]
    for p in range(19):
        edge += [10**p, -(10**p), 10**p - 1, 1 - 10**p]
    return edge + [rng.randrange(-(10 ** rng.randrange(1, 19)), 10 ** rng.randrange(1, 19)) for _ in range(1500)]


def texts():
    rng = random.Random(8)
    mixed = ["".join(rng.choice("abc-_ 019é中😀\n") for _ in range(rng.randrange(70))) for _ in range(800)]
    return [""] + ["x" * n for n in range(1, 70)] + mixed


@pytest.mark.parametrize("function, python", [("hashcode", py_java_hash), ("murmur", lambda t: py_murmur2(t) & BIG)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_every_form_equals_the_plain_definition(spark, function, python, kind):
    values = numbers() if kind == "long" else texts()
    rows = with_partition_id(column(spark, [None, *values], kind), "k", function, BIG).collect()
    assert len(rows) == len(values) + 1
    for row in rows:
        text = "" if row.k is None else str(row.k)
        assert row.pid == python(text) % BIG, row.k


def test_general_form_on_a_long_text(spark):
    text = "lorem é😀 " * 5000
    row = column(spark, [text], "string").select(java_hash(F.col("k")), murmur2(F.col("k"))).first()
    assert row[1] == py_murmur2(text)
    assert row[0] in (py_java_hash(text), 2**32 - py_java_hash(text))


@pytest.mark.parametrize("name, expected", [("hashcode", "hashcode"), ("HASHCODE", "hashcode"), (None, "hashcode"), ("  ", "hashcode"), ("Murmur", "murmur"), ("modulo", "modulo")])
def test_lookup(name, expected):
    assert partition_function_name(name) == expected
    assert callable(resolve_partition_function(name))


def test_lookup_rejects_unknown():
    with pytest.raises(ValueError, match="unknown partition function"):
        resolve_partition_function("unknown")


def test_functions_differ(spark):
    df = column(spark, [f"user-{i}-key" for i in range(200)], "string")
    hashed = [r.pid for r in with_partition_id(df, "k", "hashcode", 16).collect()]
    murmured = [r.pid for r in with_partition_id(df, "k", "murmur", 16).collect()]
    assert hashed != murmured and set(murmured) == set(range(16))


@pytest.mark.parametrize("function", ["hashcode", "murmur", "modulo"])
def test_wide_tables_route_alike(spark, function):
    narrow = spark.range(-50, 50).select(F.col("id").alias("k"))
    wide = narrow.select("k", *[F.lit(i).alias(f"c{i}") for i in range(80)])
    expected = {r.k: r.pid for r in with_partition_id(narrow, "k", function, 7).collect()}
    assert {r.k: r.pid for r in with_partition_id(wide, "k", function, 7).select("k", "pid").collect()} == expected
