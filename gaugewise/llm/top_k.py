"""Exact top-k by inner product through distributed histogram selection.

Queries are taken in blocks of bounded size, each block against all rows. Every row is scored; per query a global
histogram of the scores is refined, pass by pass, into the one bin that holds the k-th greatest score, until bins are one
score wide. A last pass keeps the scores above that value and, of those equal to it, the smallest ids. No list of scores
is ever gathered: a task sends counts of a few bins, and in the last pass at most k rows for a query and batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugewise.llm.storage import shared_folder

K = 5
QUERY_STEP = 50
BLOCK = 4096
BINS = 512
CHUNK = 1024
SCALE = 256
NONE = np.iinfo(np.int64).min
LONGEST = np.iinfo(np.int64).max


def whole_vectors(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(256 * x) of the vectors that are whole: no NULL, no NULL or non-finite component."""
    rows = [(i, v) for i, v in zip(ids.to_pylist(), vectors.to_numpy(zero_copy_only=False), strict=True) if i is not None and v is not None]
    rows = [(i, np.asarray(v, np.float64)) for i, v in rows]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all()]
    width = max((len(v) for _, v in rows), default=0)
    out = np.zeros((len(rows), width))
    for k, (_, v) in enumerate(rows):
        out[k, : len(v)] = v
    return np.array([i for i, _ in rows], np.int64), np.floor(SCALE * out)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all rows of a and b; a missing component counts as 0; held to the range of a long."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return np.clip(exact, NONE + 1, LONGEST).astype(np.int64)


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row ids, scores against the queries) of each chunk; a query's own rows score NONE."""
    for batch in batches:
        own, vectors = whole_vectors(batch.column("vec_id"), batch.column("embedding"))
        for k in range(0, len(own), CHUNK):
            scores = inner_products(vectors[k : k + CHUNK], queries)
            scores[own[k : k + CHUNK, None] == ids[None, :]] = NONE
            yield own[k : k + CHUNK], scores


def _histogram(ids: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray, width: np.ndarray, need: np.ndarray):
    """Counts by (query, bin) of scores in [low, high); of a task's bins only those that can hold the wanted score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(ids)
        total = np.zeros(n * BINS, np.int64)
        first = np.arange(n, dtype=np.int64) * BINS
        for _, scores in _scored(batches, ids, queries):
            inside = (scores >= low) & (scores < high) & (scores > NONE)
            at = np.where(inside, scores - low, 0) // width
            total += np.bincount((at + first)[inside], minlength=n * BINS)
        counts = total.reshape(n, BINS)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        query, place = np.nonzero((counts > 0) & (above < need[:, None]))
        columns = [pa.array(query, pa.int32()), pa.array(place, pa.int32()), pa.array(counts[query, place], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "bin", "n"])

    return run


def _best(ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
    """Rows (query_id, vec_id, score) of scores above `least`, and of a chunk's rows equal to it the k smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, scores in _scored(batches, ids, queries):
            order = np.argsort(own, kind="stable")
            own, scores = own[order], scores[order]
            equal = (scores == least) & (scores > NONE)
            keep = (scores > least) | (equal & (equal.cumsum(axis=0) <= k))
            row, query = np.nonzero(keep)
            columns = [pa.array(ids[query]), pa.array(own[row]), pa.array(scores[row, query])]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def _kth_scores(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, longest: float, k: int) -> np.ndarray:
    """Each query's k-th greatest score over all rows; with fewer rows a value below all scores."""
    reach = np.minimum(np.sqrt((queries**2).sum(axis=1)) * longest + 2, 2.0**61).astype(np.int64)
    low, high = -reach, reach + 1
    need = np.full(len(ids), k, np.int64)
    found = np.zeros(len(ids), bool)
    while not found.all():
        width = np.maximum(1, -(-(high - low) // BINS))
        counts = vectors.mapInArrow(_histogram(ids, queries, low, high, width, need), "query int, bin int, n long")
        counts = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin"))) - F.col("n")
        wanted = vectors.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(need)], "query int, need long")
        bins = counts.withColumn("above", above).join(F.broadcast(wanted), "query")
        hits = {r["query"]: r for r in bins.filter("above < need and above + n >= need").collect()}  # one row a query
        for q in range(len(ids)):
            if found[q]:
                continue
            if q not in hits:
                low[q], high[q], found[q] = NONE + 1, NONE + 2, True
                continue
            low[q] += hits[q]["bin"] * width[q]
            high[q] = low[q] + width[q]
            need[q] -= hits[q]["above"]
            found[q] = width[q] == 1
    return low


def nearest(embeddings: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of greatest inner product for each query.

    `embeddings` holds vec_id and embedding; more columns are ignored. Queries are the rows whose vec_id is divisible by
    `query_step`; a query's candidates are all rows of another vec_id. Components become floor(256 * x). Ties go to the
    smaller vec_id; with fewer than k candidates all are returned. Rows without an id, and vectors that are NULL or hold
    NULL or non-finite components, take no part; of vectors of different length the missing components are 0. Rows that
    repeat a vec_id each count as candidates, and as a query the id counts once, with any of its equal vectors (of
    different ones the least). Empty input gives no rows.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = vectors.filter("vec_id is not null and embedding is not null")
    whole = whole.filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.floor(SCALE * x), 2))
    queries = whole.filter(F.col("vec_id") % query_step == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    longest = float(np.sqrt(whole.agg(F.max(square)).first()[0] or 0.0))
    blocks = -(-queries.count() // BLOCK)
    path = f"{shared_folder(spark)}/top-k-{uuid.uuid4().hex}"
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not len(own):
            continue
        ids, asked = whole_vectors(own.column("vec_id").combine_chunks(), own.column("embedding").combine_chunks())
        least = _kth_scores(vectors, ids, asked, longest, k)
        best = vectors.mapInArrow(_best(ids, asked, least, k), "query_id long, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        best = best.withColumn("rank", rank).filter(F.col("rank") <= k)
        best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
