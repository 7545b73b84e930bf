"""Operator 13: centroid clustering with PCA-rotated filtering, exact in integers.

Vectors become integers once (floor(scale * x)) and are stored with a rotation of themselves: the leading coordinates in
the directions of largest variance, and the norm of the rest. For a vector v and a centroid c,

    |v - c|^2 >= |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2

because a rotation keeps distances and the norms of the rests differ by at most the distance of the rests. A round works
out this bound for all centroids, measures the most promising one in integers, and measures of the others only those whose
bound, less a margin for rounding, doesn't exceed it. So floating point only decides what is measured; distances, ties and
means are exact. A task returns one row of sums for each of its centroids, and k rows reach the driver in each round.

Rounds read the stored vectors, so a lost executor costs the tasks that it ran. The rotation comes from sums over all
vectors; another rotation would give the same result with more or fewer measurements.

Nulls, ties, empty input: vectors that are null, of another length, or hold a null or non-finite component are left out;
equal distances go to the smaller number; rows that repeat an id, or have none, are vectors of their own, and of equal
starting hashes the lexicographically smallest vector comes first; fewer than k vectors start as many centroids, which may
be none; an empty table gives an empty result. Components of 2**17 or more in size raise an error, as distances would
leave 64 bits. Columns of the input that are named like an output column are replaced; other names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, keep, table

OUTPUT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
#: Integer components stay below this, so that the squared distances of 64 components stay below 2**62.
LARGEST = 1 << 27
#: Share of the sums of squares by which rounding may move a bound; that of doubles is 1e-13 here.
MARGIN = 1e-9


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column, all of one width, without copying a row at a time."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def integers(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """(_row, _id, _q): the vectors that count, their components as integers; the row's other columns as one struct."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rest = [c for c in vectors.columns if c != "embedding" and c not in OUTPUT]
    kept = vectors.where(F.coalesce((F.size("embedding") == dimensions) & finite, F.lit(False)))
    scaled = F.transform(x, lambda e: e * scale)
    fits = F.forall(scaled, lambda e: F.abs(e) < LARGEST)
    whole = F.when(fits, F.transform(scaled, lambda e: F.floor(e).cast("int"))).otherwise(F.raise_error(F.lit(f"a component of {LARGEST // scale} or more")))
    return kept.select(F.struct(*rest).alias("_row"), F.col("vec_id").cast("string").alias("_id"), whole.alias("_q"))


def starting(rows: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids; each task sorts out its own k."""
    order = F.sha2(F.concat(F.lit("3:"), F.coalesce("_id", F.lit(""))), 256)
    return np.array([r._q for r in rows.orderBy(order, "_q").select("_q").limit(k).collect()], dtype=np.int64)


def summed(rows: DataFrame, names: list[str]) -> dict[tuple, float]:
    """Adds the values of rows (key columns and `sums` array) by place: one number for each key and place."""
    flat = rows.select(*names, F.posexplode("sums").alias("_at", "_value"))
    return {tuple(r)[:-1]: r[-1] for r in flat.groupBy(*names, "_at").agg(F.sum("_value").alias("total")).collect()}


def rotation(rows: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions by falling variance) of all vectors. Each task returns its sums; dimensions^2 numbers are collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0.0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
        for b in batches:
            x = matrix(b.column("_q"), dimensions).astype(np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        yield pa.RecordBatch.from_pydict({"sums": [[n, *first, *second.ravel()]]}, schema=pa.schema([("sums", pa.list_(pa.float64()))]))

    total = summed(rows.select("_q").mapInArrow(run, "sums array<double>"), [])
    sums = np.array([total.get((i,), 0.0) for i in range(1 + dimensions + dimensions**2)])
    mean = sums[1 : dimensions + 1] / max(sums[0], 1.0)
    spread = sums[dimensions + 1 :].reshape(dimensions, dimensions) / max(sums[0], 1.0) - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1]


def rotated(x: np.ndarray, mean: np.ndarray, directions: np.ndarray, leading: int) -> np.ndarray:
    """Leading coordinates and the norm of the others, which is taken from themselves, not as a difference of norms."""
    y = (x - mean) @ directions
    return np.column_stack([y[:, :leading], np.linalg.norm(y[:, leading:], axis=1)])


def stored(rows: DataFrame, mean: np.ndarray, directions: np.ndarray, leading: int) -> DataFrame:
    """rows with `_lead`: what rotated() gives, in doubles."""
    dimensions = len(mean)
    schema = T.StructType([*rows.schema.fields, T.StructField("_lead", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead = rotated(matrix(b.column("_q"), dimensions).astype(np.float64), mean, directions, leading)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, lead.size + 1, leading + 1, dtype=np.int32)), pa.array(lead.ravel()))
            yield b.append_column("_lead", lists)

    return rows.mapInArrow(run, schema)


def nearest(q: np.ndarray, lead: np.ndarray, centroids: np.ndarray, centroid_lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each vector, and how many distances were measured."""
    square = (lead**2).sum(axis=1)[:, None] + (centroid_lead**2).sum(axis=1)[None, :]
    bound = ((lead[:, None, :] - centroid_lead[None, :, :]) ** 2).sum(axis=2) - MARGIN * square

    def measured(at: np.ndarray, c: np.ndarray) -> np.ndarray:
        return ((q[at] - centroids[c]) ** 2).sum(axis=1)

    best = bound.argmin(axis=1)
    least, looked = measured(np.arange(len(q)), best), len(q)
    first = best.copy()
    for c in range(len(centroids)):
        at = np.flatnonzero((bound[:, c] <= least) & (first != c))
        d = measured(at, np.full(len(at), c))
        looked += len(at)
        better = (d < least[at]) | ((d == least[at]) & (c < best[at]))
        best[at[better]], least[at[better]] = c, d[better]
    return best, least, looked


def new_centroids(rows: DataFrame, centroids: np.ndarray, turn) -> np.ndarray:
    """One round: exact floors of the means of each centroid's vectors; a centroid without any stays."""
    k, dimensions = centroids.shape
    centroid_lead = turn(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dimensions + 1), dtype=np.int64)
        for b in batches:
            q = matrix(b.column("_q"), dimensions).astype(np.int64)
            best, _, _ = nearest(q, matrix(b.column("_lead"), centroid_lead.shape[1]), centroids, centroid_lead)
            for c in range(k):
                mine = q[best == c]
                sums[c, 0] += len(mine)
                sums[c, 1:] += mine.sum(axis=0)
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_pydict({"c": used, "sums": sums[used].tolist()}, schema=pa.schema([("c", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    parts = rows.select("_q", "_lead").mapInArrow(run, "c bigint, sums array<bigint>").select("c", F.expr("transform(sums, s -> cast(s AS decimal(38,0)))").alias("sums"))
    total = {key: int(v) for key, v in summed(parts, ["c"]).items()}
    return np.array([[total[c, i] // total[c, 0] for i in range(1, dimensions + 1)] if (c, 0) in total else centroids[c] for c in range(k)], dtype=np.int64)


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, leading: int = 16) -> DataFrame:
    """vectors (vec_id, embedding and any more) that count, without embedding, with cluster, distance, cluster_inertia,
    inertia and centroid_sha256. leading: coordinates that are stored, besides the norm of the rest."""
    leading = min(leading, dimensions)
    rows = integers(vectors, dimensions, scale)
    whole = keep(rows, "centroid-vectors")
    centroids = starting(whole, k)
    mean, directions = rotation(whole, dimensions)
    placed = keep(stored(whole, mean, directions, leading), "centroid-rotated")
    drop(whole)

    def turn(c: np.ndarray) -> np.ndarray:
        return rotated(c.astype(np.float64), mean, directions, leading)

    if len(centroids):
        for _ in range(rounds):
            centroids = new_centroids(placed, centroids, turn)
    centroid_lead = turn(centroids) if len(centroids) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                best, least, _ = nearest(matrix(b.column("_q"), dimensions).astype(np.int64), matrix(b.column("_lead"), leading + 1), centroids, centroid_lead)
                yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(best.astype(np.int32)), pa.array(least)], names=["_row", "cluster", "distance"])

    schema = T.StructType([placed.schema["_row"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    done = keep(placed.select("_row", "_q", "_lead").mapInArrow(run, schema), "centroid-clusters")
    drop(placed)
    inertia = {r.cluster: int(r.total) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    facts = pd.DataFrame({"_c": list(range(len(centroids))), "cluster_inertia": [inertia.get(c, 0) for c in range(len(centroids))], "inertia": sum(inertia.values()), "centroid_sha256": [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]})
    facts = vectors.sparkSession.createDataFrame([tuple(r) for r in facts.itertuples(index=False)], "_c int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows, whatever the number of vectors
    return done.join(F.broadcast(facts), done["cluster"] == facts["_c"]).select("_row.*", *OUTPUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding")).select("vec_id", *OUTPUT)


def _oracle(k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024) -> str:
    def distances(vectors: str, centroids: str) -> str:
        return f"SELECT vec_id, q, c, list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance FROM {vectors}, {centroids}"

    def assigned(centroids: str) -> str:
        return f"SELECT vec_id, q, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM ({distances('kept', centroids)}) GROUP BY vec_id, q"

    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q AS m FROM kept ORDER BY sha256('3:' || vec_id) LIMIT {k})"]
    for i in range(rounds):
        parts.append(f"a{i} AS MATERIALIZED ({assigned(f'c{i}')})")
        parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(list_transform(range(1, {dimensions + 1}), lambda i: s[i]), m) AS m FROM c{i} LEFT JOIN (
  SELECT c, list((t - ((t % n) + n) % n) // n ORDER BY i)::BIGINT[] AS s FROM (SELECT c, i, sum(q[i])::HUGEINT AS t, count(*)::HUGEINT AS n FROM a{i}, range(1, {dimensions + 1}) r(i) GROUP BY c, i) GROUP BY c) USING (c))""")
    parts.append(f"done AS MATERIALIZED ({assigned(f'c{rounds}')})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM done JOIN c{rounds} USING (c)"""  # fmt: skip


ORACLE = _oracle()
