"""Ordered digests: order and content change them, partitioning doesn't."""

import hashlib
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kestrel.sources import merkle as MK

SCHEMA = "b string, o bigint, x int, s string"


def rows(seed=1, n=200):
    rng = random.Random(seed)
    return [(rng.choice("pq"), i * rng.choice([1, 7]) * 1000 + i, rng.randrange(3), rng.choice(["", "é", None, "a b"])) for i in range(n)]


def sums(spark, data, parts=3):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    return {r.b: (r.n_records, r.checksum) for r in MK.ordered_checksums(df, ["b"], "o", ["x", "s"]).collect()}


def brute(data):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {}
    for b in {r[0] for r in data}:
        nodes = {r[1]: sha(json.dumps({k: v for k, v in (("s", r[3]), ("x", r[2])) if v is not None}, separators=(",", ":"), ensure_ascii=False)) for r in data if r[0] == b}
        n = len(nodes)
        for _ in range(MK.HEIGHT):
            above = {}
            for place in sorted(nodes):
                above.setdefault(place // MK.FAN, []).append(f"{place % MK.FAN}:{nodes[place]}")
            nodes = {p: sha(";".join(c)) for p, c in above.items()}
        out[b] = (n, sha(f"{n}:{nodes[0]}"))
    return out


def test_digest_equals_brute_force_whatever_the_partitioning(spark):
    data = rows()
    assert sums(spark, data, 1) == sums(spark, list(reversed(data)), 7) == brute(data)


def test_order_and_content_change_it(spark):
    data = [("p", i, i % 5, "t") for i in range(50)]
    whole = sums(spark, data)
    swapped = [("p", {3: 4, 4: 3}.get(o, o), x, s) for _, o, x, s in data]
    changed = [(b, o, x + (o == 30), s) for b, o, x, s in data]
    assert len({whole["p"], sums(spark, swapped)["p"], sums(spark, changed)["p"], sums(spark, data[:-1])["p"]}) == 4


def test_changed_ranges_are_found_from_the_nodes(spark):
    df = spark.range(5000).select(F.lit("p").alias("b"), F.col("id").alias("o"), F.lit(1).alias("x"))
    new = df.withColumn("x", F.when(F.col("o").isin(7, 3000), 2).otherwise(1)).where("o < 4096")
    old, new = (MK.tree_level(d, ["b"], "o", ["x"], 1) for d in (df, new))
    assert sorted((r.first, r.last) for r in MK.changed_ranges(old, new, ["b"]).collect()) == [(0, 1023), (2048, 3071), (4096, 5119)]


def test_missing_and_repeated_ordinals_raise(spark):
    with pytest.raises(PySparkException):
        sums(spark, [("p", None, 1, "")])
    with pytest.raises(PySparkException):
        sums(spark, [("p", 5, 1, "")] * (MK.FAN + 1))
    assert sums(spark, []) == {}


def test_ordinals_are_dense_per_batch(spark):
    data = [(random.Random(i).choice("pqr"), i * 3, 0, "") for i in range(300)]
    got = MK.with_ordinals(spark.createDataFrame(data, SCHEMA).repartition(6), ["b"], ["o"]).collect()
    for b in "pqr":
        mine = sorted((r.o, r.ordinal) for r in got if r.b == b)
        assert [o for _, o in mine] == list(range(len(mine)))
