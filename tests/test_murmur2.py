"""The producer's murmur2 placement against a plain-Python port of the
public algorithm and the known vectors of the Java client's tests."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidelog.functions import murmur2_hash, murmur2_partition

from conftest import SF_SMALL


def murmur2_py(data: bytes) -> int:
    length, m, mask = len(data), 0x5BD1E995, 0xFFFFFFFF
    h = (0x9747B28C ^ length) & mask
    for i in range(length // 4):
        k = int.from_bytes(data[4 * i:4 * i + 4], "little")
        k = (k * m) & mask
        k ^= k >> 24
        k = (k * m) & mask
        h = ((h * m) & mask) ^ k
    rem, base = length % 4, length & ~3
    if rem == 3:
        h ^= data[base + 2] << 16
    if rem >= 2:
        h ^= data[base + 1] << 8
    if rem >= 1:
        h ^= data[base]
        h = (h * m) & mask
    h ^= h >> 13
    h = (h * m) & mask
    return h ^ (h >> 15)


def _signed(x):
    return x - (1 << 32) if x >= 1 << 31 else x


def test_known_vectors_and_random_keys(spark):
    known = {b"21": -973932308, b"foobar": -790332482, b"a-little-bit-long-string": -985981536}
    random.seed(11)
    keys = [b"", b"a", b"ab", b"abc", b"abcd", "é".encode(), bytes(range(256)), None]
    keys += list(known) + [bytes(random.randrange(256) for _ in range(random.randrange(40)))
                           for _ in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k binary")
    for r in df.select("k", murmur2_hash(F.col("k")).alias("h"),
                       murmur2_partition(F.col("k"), 3).alias("p")).collect():
        if r.k is None:
            assert r.h is None
            continue
        want = murmur2_py(bytes(r.k))
        assert r.h == want
        assert r.p == (want & 0x7FFFFFFF) % 3
        if bytes(r.k) in known:
            assert _signed(r.h) == known[bytes(r.k)]


def test_producer_placement_query_matches_brute_force(spark):
    rows = E.queries()["assign_partition_producer"](spark, SF_SMALL).collect()
    assert len(rows) == 150
    for r in rows:
        assert r.partition == (murmur2_py(r.key.encode()) & 0x7FFFFFFF) % 3
