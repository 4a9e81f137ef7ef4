"""Centroid clustering of integer vectors, exact and repeatable, over subvector dictionaries.

Method: blocks of dimensions are dictionary-encoded without loss.  A chunk of vectors
keeps, per block, its distinct subvectors once and a code per vector.  Each round
computes the squared distances of every distinct subvector to the centroids' blocks
once, and a vector's distance is the sum of its codes' entries.  Sums for the new
centroids come from counts per cluster and code, so they are exact too.

Chunks are encoded once and stored in the shared folder; a round reads them and sends
on one sum per cluster and dimension from each task.  Centroids, which are few, are
all that the driver sees.

Cases: vectors that are null, of another length, or with null or non-finite components
are left out; repeated ids are vectors of their own.  Fewer vectors than clusters give
fewer clusters; an empty table gives no rows.  Scaled components must lie within
2**27 either way, so that squared distances are exact 64-bit numbers; others raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanset.llm.tables import stored

BLOCK_DIMS = 8
# Vectors in a chunk: a row of about a megabyte at 64 dimensions.
CHUNK_ROWS = 4_096
LIMIT = 1 << 27

_ENCODED = "ids array<bigint>, books array<binary>, codes array<binary>"


def scaled(vector: Column, scale: int) -> Column:
    """Components as integers, floor(scale * x), worked out in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, all of them finite numbers."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def encode(vectors: np.ndarray, width: int) -> tuple[list[bytes], list[bytes]]:
    """Per block the distinct subvectors, and the code of each vector, as bytes."""
    books, codes = [], []
    for at in range(0, vectors.shape[1], width):
        block = np.ascontiguousarray(vectors[:, at : at + width], np.int32)
        whole = block.view(np.dtype((np.void, block.strides[0]))).ravel()
        _, first, code = np.unique(whole, return_index=True, return_inverse=True)
        books.append(block[first].tobytes())
        codes.append(code.astype(np.uint32).tobytes())
    return books, codes


@dataclass(frozen=True)
class Chunk:
    ids: pa.Array
    books: list[np.ndarray]
    codes: list[np.ndarray]

    def distances(self, centroids: np.ndarray, width: int) -> np.ndarray:
        """Squared distances, vectors times centroids."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        for b, (book, code) in enumerate(zip(self.books, self.codes, strict=True)):
            own = centroids[:, b * width : (b + 1) * width]
            apart = book[:, None, :] - own[None, :, :]
            total += np.einsum("ijk,ijk->ij", apart, apart)[code]
        return total

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Component sums per cluster, by counting codes."""
        parts = []
        for book, code in zip(self.books, self.codes, strict=True):
            held = np.bincount(cluster * len(book) + code, minlength=clusters * len(book))
            parts.append(held.reshape(clusters, len(book)) @ book)
        return np.concatenate(parts, axis=1)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, width: int) -> Iterator[Chunk]:
    widths = [min(width, dims - at) for at in range(0, dims, width)]
    for batch in batches:
        for row in range(batch.num_rows):
            books = [
                np.frombuffer(raw.as_py(), np.int32).reshape(-1, w).astype(np.int64)
                for raw, w in zip(batch.column("books")[row].values, widths, strict=True)
            ]
            codes = [np.frombuffer(raw.as_py(), np.uint32).astype(np.int64) for raw in batch.column("codes")[row].values]
            yield Chunk(batch.column("ids")[row].values, books, codes)


def encoded(frame: DataFrame, dims: int, width: int = BLOCK_DIMS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Stored chunks of a frame of ``id`` and ``vector``, whose vectors are integer arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(table: pa.RecordBatch) -> pa.RecordBatch:
            flat = np.asarray(table.column("vector").flatten()).reshape(-1, dims)
            if len(flat) and np.abs(flat).max() > LIMIT:
                raise ValueError(f"a scaled component lies beyond {LIMIT}")
            books, codes = encode(flat, width)
            made = [pa.array([one]) for one in (table.column("id").to_pylist(),)]
            return pa.RecordBatch.from_arrays(
                [made[0].cast(pa.list_(pa.int64())), pa.array([books], pa.list_(pa.binary())),
                 pa.array([codes], pa.list_(pa.binary()))], ["ids", "books", "codes"],
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = chunk_rows - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == chunk_rows:
                    yield rows(pa.concat_batches(held))
                    held = []
        if held:
            yield rows(pa.concat_batches(held))

    return stored(frame.select("id", "vector").mapInArrow(run, _ENCODED), "centroids-codes")


def _moved(chunks: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Centroids after one round; an empty cluster keeps its own."""
    clusters, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((clusters, dims + 1), np.int64)
        for chunk in _chunks(batches, dims, width):
            cluster = chunk.distances(centroids, width).argmin(1)
            sums[:, :dims] += chunk.sums(cluster, clusters)
            sums[:, dims] += np.bincount(cluster, minlength=clusters)
        c, d = np.divmod(np.arange(sums.size), dims + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(sums.ravel())], ["c", "d", "s"]
        )

    # Decimals, so that sums over any number of vectors are exact.
    told = chunks.mapInArrow(run, "c int, d int, s bigint").groupBy("c", "d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    sums = {(r["c"], r["d"]): int(r["s"]) for r in told.collect()}  # clusters times dimensions
    after = centroids.copy()
    for c in range(clusters):
        if count := sums.get((c, dims), 0):
            after[c] = [sums[c, d] // count for d in range(dims)]
    return after


def assigned(chunks: DataFrame, centroids: np.ndarray, width: int = BLOCK_DIMS) -> DataFrame:
    """``id, cluster, distance`` of every vector; of equally near centroids the first."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, dims, width):
            far = chunk.distances(centroids, width)
            cluster = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [chunk.ids, pa.array(cluster, pa.int32()), pa.array(far[np.arange(len(cluster)), cluster])],
                ["id", "cluster", "distance"],
            )

    return chunks.mapInArrow(run, "id bigint, cluster int, distance bigint")


def first_centroids(frame: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose ``seed`` and id have the least SHA-256; ties by components."""
    told = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    least = frame.select(F.sha2(told.cast("binary"), 256).alias("draw"), "vector").orderBy("draw", "vector")
    return np.array([r["vector"] for r in least.limit(clusters).collect()], np.int64)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    frame: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    dims: int = 64,
    scale: int = 1024,
    clusters: int = 8,
    rounds: int = 10,
    seed: str = "3:",
    width: int = BLOCK_DIMS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256`` of each usable vector."""
    kept = frame.where(usable(F.col(vector), dims)).select(
        F.col(key).cast("bigint").alias("id"), scaled(F.col(vector), scale).alias("vector")
    )
    centroids = first_centroids(kept, clusters, seed)
    schema = (
        f"{key} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
        "centroid array<bigint>, centroid_sha256 string"
    )
    if not len(centroids):
        return frame.sparkSession.createDataFrame([], schema)
    if np.abs(centroids).max() > LIMIT:
        raise ValueError(f"a scaled component lies beyond {LIMIT}")
    chunks = encoded(kept, dims, width, chunk_rows)
    for _ in range(rounds):
        after = _moved(chunks, centroids, width)
        if np.array_equal(after, centroids):
            break  # every further round would give the same
        centroids = after
    told = assigned(chunks, centroids, width)
    spent = {r["cluster"]: r["s"] for r in told.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = frame.sparkSession.createDataFrame(
        [(c, spent.get(c, 0), sum(spent.values()), centroids[c].tolist(), centroid_digest(centroids[c]))
         for c in range(len(centroids))],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>, centroid_sha256 string",
    )
    return told.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"
    )
