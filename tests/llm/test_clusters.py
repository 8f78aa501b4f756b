"""Clusters of whole-number vectors against plain Python on small tables."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def brute(rows, rounds=10):
    kept = []
    for vec_id, vector, *_ in rows:
        if vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, tuple(math.floor(1024 * x) for x in vector)))
    named = sorted(kept, key=lambda row: (hashlib.sha256(f"3:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]))
    centroids = [list(vector) for _, vector in named[:8]]

    def nearest(vector):
        return min((sum((a - b) ** 2 for a, b in zip(vector, c, strict=True)), at) for at, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, vector in kept:
            groups[nearest(vector)[1]].append(vector)
        centroids = [[sum(part) // len(group) for part in zip(*group, strict=True)] if group else old for group, old in zip(groups, centroids, strict=True)]
    found = [(vec_id, *nearest(vector)) for vec_id, vector in kept]
    inertia = [sum(distance for _, distance, at in found if at == cluster) for cluster in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is not None, i or 0), at, d, inertia[at], sum(inertia), digest[at]) for i, d, at in found)


def run(frame):
    return sorted(((r[0] is not None, r[0] or 0), *r[1:]) for r in map(tuple, clusters.vector_clusters(frame).collect()))


def vectors(count, spread, pick):
    return [[pick.choice(spread) + pick.gauss(0, 0.2) for _ in range(64)] for _ in range(count)]


def test_against_plain_python(spark):
    pick = random.Random(1)
    rows = [(at, vector, "x", 1) for at, vector in enumerate(vectors(150, [-1.0, 0.5, 3.0], pick))]
    rows += [rows[3], rows[3], (None, [0.25] * 64, "x", 1), (900, [0.0] * 63, "x", 1), (901, [0.0] * 65, "x", 1), (902, [], "x", 1)]
    rows += [(903, None, "x", 1), (904, [None] + [0.0] * 63, "x", 1), (905, [math.nan] + [0.0] * 63, "x", 1), (906, [math.inf] * 64, "x", 1)]
    rows += [(907, [-math.inf] + [1.0] * 63, "x", 1), (908, [-0.0001] * 64, "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert run(frame) == brute(rows)
    assert run(frame.repartition(13)) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(at, [float(at % 3)] * 64, None, None) for at in range(40)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_components_stay_exact(spark):
    pick = random.Random(2)
    rows = [(at, [pick.choice([1.0, -1.0]) * 2**19 + pick.random() for _ in range(64)], None, None) for at in range(60)]
    rows.append((99, [2.0**25] + [0.0] * 63, None, None))
    found, centroids = clusters.clustered(spark.createDataFrame(rows, SCHEMA))
    assert clusters.Block({"ids": [1], "occurring": [[2**35]] * 64, "places": bytes(128)}).assign([[0] * 64])[1][0] == 64 * 2**70
    exact = {row.vec_id: int(row.squared) for row in found.collect()}
    expected = {row[0][1]: row[2] for row in brute(rows)}
    assert exact == expected
    assert max(exact.values()) > 2**62
    assert all(row.distance is None or row.distance == exact[row.vec_id] for row in clusters.vector_clusters(spark.createDataFrame(rows, SCHEMA)).collect())


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, count):
    rows = [(at, [0.5 * at] * 64, "x", 1) for at in range(count)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_single_floats_count_as_doubles(spark):
    frame = spark.createDataFrame([(1, [0.1] * 64)], "vec_id long, embedding array<float>")
    expected = math.floor(1024 * frame.select(F.col("embedding")[0].cast("double")).first()[0])
    _, centroids = clusters.clustered(frame)
    assert centroids == [[expected] * 64]
