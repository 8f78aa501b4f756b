"""Clustering of whole-number vectors by centroids, with distances read from scalar tables.

A component x becomes the whole number floor(``scale`` * x). Vectors are stored once in blocks of at most ``BLOCK``: for each
dimension the values that occur in the block, and for each vector the place of its value among them. In a round the squared
difference of every occurring value and every centroid is tabulated for each dimension; the distances of a block are then
gathered from these tables and added up. Each round is one pass over the stored blocks; a task sends the sums and counts of
its clusters, so what reaches the driver is one row per cluster and what goes out are the centroids, both of a size that
``clusters`` and ``dimensions`` fix. All arithmetic is exact; numbers that 64 bits cannot hold are Python's own.

The first centroids are the vectors with the smallest hashes of ``seed:id``, in that order; fewer vectors make fewer
centroids. Ties go to the smaller number. A centroid without vectors stays as it is.

Edge cases: null vectors, vectors of another length and vectors with null, infinite or undefined components are left out,
and so are those with a component of 2^52 or more, whose squared distance no long holds. A distance or sum beyond a long is
null. A null id hashes as the empty text; equal ids are ordered by their vectors; repeated rows are vectors of their own.
An empty table gives an empty result. Other columns are not looked at, whatever their names."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import store

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
BLOCK = 4096
_LARGEST = float(1 << 52)
_LONG = (1 << 63) - 1

Centroids = list[list[int]]


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, v) of the vectors that count, with whole-number components."""
    vector, typed = F.col(f"`{vector_column}`"), "array<double>"
    usable = F.size(vector) == dimensions
    usable &= F.forall(vector.cast(typed), lambda x: F.coalesce(F.abs(x) < _LARGEST, F.lit(False)))
    scaled = F.transform(vector.cast(typed), lambda x: F.floor(x * scale).cast("long"))
    return vectors.filter(usable).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), scaled.alias("v"))


_BLOCK_FIELDS = "ids array<long>, occurring array<array<long>>, places binary"


def _blocks(dimensions: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                matrix = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dimensions)
                coded = [np.unique(matrix[:, at], return_inverse=True) for at in range(dimensions)]
                places = np.stack([place.astype("<u2") for _, place in coded])
                columns = {
                    "ids": pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                    "occurring": pa.array([[values for values, _ in coded]], pa.list_(pa.list_(pa.int64()))),
                    "places": pa.array([places.tobytes()], pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


class Block:
    """One stored block: occurring values by dimension, and the places of the vectors' values among them."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.occurring = [np.array(values, dtype=np.int64) for values in row["occurring"]]
        self.places = np.frombuffer(row["places"], dtype="<u2").reshape(len(self.occurring), len(self.ids))
        self.largest = max(max(abs(int(values[0])), abs(int(values[-1]))) for values in self.occurring)

    def _kind(self, bound: int) -> type:
        """Plain 64-bit numbers where no result passes ``bound``, else Python's."""
        return np.int64 if bound <= _LONG else object

    def assign(self, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid and its squared distance."""
        reach = self.largest + max(abs(value) for centroid in centroids for value in centroid)
        kind = self._kind(reach * reach * len(self.occurring))
        total = np.zeros((len(self.ids), len(centroids)), dtype=kind)
        for at, values in enumerate(self.occurring):
            table = (values.astype(kind)[:, None] - np.array([centroid[at] for centroid in centroids], dtype=kind)) ** 2
            total += table[self.places[at]]
        nearest = total.argmin(axis=1)
        return nearest, total[np.arange(len(nearest)), nearest]

    def sums(self, members: np.ndarray) -> list[int]:
        kind = self._kind(self.largest * len(self.ids))
        found = (values.astype(kind)[place[members]] for values, place in zip(self.occurring, self.places, strict=True))
        return [int(part.sum()) for part in found]


def _sum_clusters(centroids: Centroids) -> Callable:
    """Count and componentwise sums of each cluster, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        sums = [[0] * len(centroids[0]) for _ in centroids]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                nearest, _ = block.assign(centroids)
                for cluster in np.unique(nearest).tolist():
                    members = np.flatnonzero(nearest == cluster)
                    counts[cluster] += len(members)
                    sums[cluster] = [a + b for a, b in zip(sums[cluster], block.sums(members), strict=True)]
        columns = {
            "cluster": pa.array(range(len(centroids)), pa.int32()),
            "n": pa.array(counts, pa.int64()),
            "sums": pa.array([[str(value) for value in part] for part in sums], pa.list_(pa.string())),
        }
        yield pa.RecordBatch.from_pydict(columns)

    return run


def moved(blocks: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round."""
    parts = blocks.mapInArrow(_sum_clusters(centroids), "cluster int, n long, sums array<string>")
    whole = [F.sum(F.col("sums")[at].cast("decimal(38,0)")).alias(f"s{at}") for at in range(len(centroids[0]))]
    result = list(centroids)
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():  # one row per cluster
        if row["n"]:
            result[row["cluster"]] = [int(row[f"s{at}"]) // row["n"] for at in range(len(centroids[0]))]
    return result


def _assign(centroids: Centroids) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                nearest, distance = block.assign(centroids)
                columns = {
                    "vec_id": pa.array(block.ids, pa.int64()),
                    "cluster": pa.array(nearest, pa.int32()),
                    "squared": pa.array([str(value) for value in distance.tolist()], pa.string()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, squared decimal(38,0)) of every vector that counts, stored, and the final centroids."""
    counted = whole_numbers(vectors, id_column, vector_column, dimensions, scale)
    blocks = store(counted.mapInArrow(_blocks(dimensions), _BLOCK_FIELDS), "vector_blocks")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(row["v"]) for row in counted.orderBy(named, "v").limit(clusters).collect()]
    if not centroids:
        nothing = counted.select("vec_id", F.lit(0).alias("cluster"), F.lit(None).cast("decimal(38,0)").alias("squared"))
        return nothing.limit(0), centroids
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    found = blocks.mapInArrow(_assign(centroids), "vec_id long, cluster int, squared string")
    return store(found.withColumn("squared", F.col("squared").cast("decimal(38,0)")), "clustered"), centroids


def vector_clusters(vectors: DataFrame) -> DataFrame:
    """Every vector's cluster and distance, the inertia of its cluster and of all, and the digest of its centroid."""
    found, centroids = clustered(vectors)
    inertia = {row["cluster"]: row["squared"] for row in found.groupBy("cluster").agg(F.sum("squared").alias("squared")).collect()}
    rows = []
    for cluster, centroid in enumerate(centroids):  # one row per cluster
        digest = hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
        rows.append((cluster, _as_long(inertia.get(cluster, 0)), _as_long(sum(inertia.values())), digest))
    known = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    named = found.select("vec_id", "cluster", F.col("squared").try_cast("long").alias("distance"))
    return named.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _as_long(value: int) -> int | None:
    return int(value) if value <= _LONG else None


def clusters_sql() -> str:
    """The same in DuckDB, one pair of steps a round."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {DIMENSIONS}
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k, v
          FROM kept QUALIFY k < {CLUSTERS})""",
    ]
    for at in range(ROUNDS + 1):
        steps.append(
            f"""a{at} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, min(least_) AS least_ FROM (
              SELECT rid, vec_id, (list_sum(list_transform(list_zip(kept.v, c{at}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), k) AS least_
              FROM kept, c{at}) GROUP BY rid)"""
        )
        if at < ROUNDS:
            steps.append(
                f"""s{at} AS (SELECT least_[2] AS k, i, sum(v[i]) AS s, count(*) AS n
                  FROM a{at} JOIN kept USING (rid), range(1, {DIMENSIONS + 1}) AS dims(i) GROUP BY ALL)"""
            )
            steps.append(
                f"""c{at + 1} AS MATERIALIZED (SELECT k, coalesce(m.v, c{at}.v) AS v FROM c{at} LEFT JOIN (
                  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{at} GROUP BY k) m USING (k))"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(least_[1] AS BIGINT) AS distance,
          CAST(sum(least_[1]) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(least_[1]) OVER () AS BIGINT) AS inertia,
          sha256(array_to_string(v, ',')) AS centroid_sha256
        FROM a{ROUNDS} JOIN c{ROUNDS} ON k = least_[2]"""
