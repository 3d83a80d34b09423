"""Ranked lexical search, reversed: the items' terms are the index, and the documents are streamed through it.

Items are taken in blocks of bounded size. A block's inverted index (term to items) is broadcast; one pass over the
documents keeps each text's length and its counts of the block's terms, from which the corpus statistics follow. A second
pass over those counts scores documents against all items of the block at once. Each task holds one heap of at most k
documents per item, however many documents it streams; the heaps are merged in two rounds, so no task sees them all.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gaugewise.llm.storage import shared_folder, stored

K = 10
BLOCK_BYTES = 8 << 20  # of the terms of one block of items, and so of what is broadcast
PIECE = 1 << 20
CELLS = 1 << 21  # scores held at once: documents by items
MERGERS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)  # letters lower-cased, digits and bytes of other characters kept, all else blank


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of a text; a long one is counted in pieces that end between terms."""
    text = text.translate(TERM_BYTES)
    if len(text) <= PIECE:
        return Counter(text.split())
    counts, start = Counter(), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        counts.update(text[start:end].split())
        start = end
    return counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _lists(parts: list[list[int]], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for p in parts for x in p], kind))


def _postings(index: Broadcast):
    """Per document with a term: doc_id, n of all its terms, and number and count of each term of the index it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = index.value
        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                found = term_counts(text or b"")
                if not found:
                    continue
                held = found.keys() & numbers.keys()
                ids.append(doc_id)
                lengths.append(found.total())
                terms.append([numbers[t] for t in held])
                counts.append([found[t] for t in held])
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), _lists(terms, pa.int32()), _lists(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


def _length_parts(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m = 100 - 90 + (90 * n * N) div L of each document."""
    if int(lengths.max(initial=0)) * 90 * documents < 2**63:
        return 10 + lengths * 90 * documents // total
    return np.array([10 + int(n) * 90 * documents // total for n in lengths], np.int64)


def _heaps(inverted: Broadcast, k: int):
    """At most k rows (item, doc_id, score) of an item and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, items, n_items, documents, total = inverted.value
        heaps: list[list[tuple]] = [[] for _ in range(n_items)]
        least = np.ones(n_items, np.int64)  # what a score must reach to enter the item's heap
        step = 4 * k
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            m = _length_parts(batch.column("n").to_numpy(), documents, total)
            terms = batch.column("terms")
            offsets = terms.offsets.to_numpy().astype(np.int64)
            offsets, base = offsets - offsets[0], int(offsets[0])
            term = terms.values.to_numpy()[base : base + offsets[-1]]
            count = batch.column("counts").values.to_numpy()[base : base + offsets[-1]]
            document = np.repeat(np.arange(len(ids)), np.diff(offsets))
            value = weights[term] * (1_000_000_000 * count // (1000 * count + 8 * m[document]))
            start = 0
            while start < len(ids):
                end = min(len(ids), start + max(1, min(step, CELLS // n_items)))
                step *= 2
                a, b = offsets[start], offsets[end]
                reach = first[term[a:b] + 1] - first[term[a:b]]
                place = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(first[term[a:b]], reach)
                scores = np.zeros((end - start) * n_items, np.int64)
                np.add.at(scores, np.repeat(document[a:b] - start, reach) * n_items + items[place], np.repeat(value[a:b], reach))
                scores = scores.reshape(end - start, n_items)
                for d, i in zip(*np.nonzero(scores >= least), strict=True):
                    doc_id, heap = ids[start + d], heaps[i]
                    entry = (int(scores[d, i]), doc_id is not None, -(doc_id or 0))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == k:
                        least[i] = heap[0][0]
                start = end
        rows = [(i, -d if known else None, s) for i, heap in enumerate(heaps) for s, known, d in heap]
        for a in range(0, len(rows), 10_000):
            item, doc_id, score = zip(*rows[a : a + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"]
            )

    return run


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The k best of each item with their rank: first of parts of its heaps, then of what those keep."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = heaps.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGERS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).filter(F.col("rank") <= k)
    whole = F.row_number().over(Window.partitionBy("item").orderBy(*best))
    return part.drop("part", "rank").withColumn("rank", whole).filter(F.col("rank") <= k)


def ranked_search(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item.

    `documents` holds doc_id and text, `items` item_id and text; more columns are ignored. Terms are runs of letters,
    digits and characters beyond ASCII, only A-Z lower-cased. With N documents that hold a term, L terms in them, n in
    one, df documents holding a term and tf its count in one, a term weighs floor(1000 ln((2N + 2) / (2 df + 1))), a
    document's m is 10 + 90 n N div L, and its score is the sum of weight * (10^9 tf div (1000 tf + 8 m)) over the
    item's different terms. Scores of 0 are left out; equal ones go by ascending doc_id, NULL last. Rows that repeat a
    doc_id are documents of their own; rows that repeat an item_id (NULL too) are one item with the terms of all. NULL
    or empty texts hold no term: such documents are not counted, such items return nothing. Empty tables give no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lower = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    terms = F.explode(F.regexp_extract_all(lower, F.lit(f"({TERM})")))
    asked = stored(items.select("item_id", terms.alias("term")).distinct(), "search-items")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    id_type = items.schema["item_id"].dataType
    schema = StructType([StructField("item", IntegerType()), StructField("item_id", id_type)])
    path = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], schema).selectExpr("item_id", "0 as rank", "0L as doc_id", "0L as score")
    empty = empty.selectExpr("item_id", "nullif(rank, -1) as rank", "nullif(doc_id, -1L) as doc_id", "nullif(score, -1L) as score")
    empty.write.parquet(path)
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        if not rows:
            continue
        numbers = {t.encode(): i for i, t in enumerate(sorted({r["term"] for r in rows}))}
        item_ids = list(dict.fromkeys(r["item_id"] for r in rows))
        item_of = {item: i for i, item in enumerate(item_ids)}
        postings = stored(docs.mapInArrow(_postings(spark.sparkContext.broadcast(numbers)), "doc_id long, n long, terms array<int>, counts array<long>"), "search-postings")
        n_documents, total = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_documents:
            break
        held = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # the block's terms
        weights = np.array([weight(n_documents, held.get(t, 0)) for t in range(len(numbers))], np.int64)
        pairs = np.array(sorted((numbers[r["term"].encode()], item_of[r["item_id"]]) for r in rows), np.int64).reshape(-1, 2)
        first = np.searchsorted(pairs[:, 0], np.arange(len(numbers) + 1))
        inverted = spark.sparkContext.broadcast((weights, first, pairs[:, 1].copy(), len(item_ids), n_documents, total))
        best = _merged(postings.mapInArrow(_heaps(inverted, k), "item int, doc_id long, score long"), k)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(item_ids)], schema)
        best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)
