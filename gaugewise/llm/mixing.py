"""Mixing sources to target weights.

A source's words, in a fixed order of its documents, are packed into blocks of `BLOCK_WORDS`. The mix is dealt out in
shards of `SHARD_SLOTS` block slots. Every shard draws how many of its slots each source fills: the whole part of its
expected number for sure, the rest of the slots by one multinomial draw, from a generator seeded by the shard. A source's
j-th slot in the whole mix reads block P(j): P runs through the source's blocks once per pass, each pass in a
pseudorandom order of its own, so block numbers are computed, never shuffled. Slots and blocks then meet in a join on
(source, block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugewise.llm.storage import stored

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
TASK_SHARDS = 64
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"
PART_DOCS = 5_000  # documents of one source that are numbered in one task


def targets(sizes: list[int], weights: list[float], total: float) -> list[float]:
    """Shares of `total` by weight; none above `MOST_PASSES` times its size, the excess reshared by weight."""
    out, capped = [0.0] * len(sizes), set()
    while True:
        rest = total - sum(out[k] for k in capped)
        open_weight = sum(w for k, w in enumerate(weights) if k not in capped)
        for k, w in enumerate(weights):
            if k not in capped:
                out[k] = rest * w / open_weight
        over = [k for k in range(len(sizes)) if k not in capped and out[k] > MOST_PASSES * sizes[k]]
        if not over:
            return out
        for k in over:
            out[k] = float(MOST_PASSES * sizes[k])
        capped.update(over)
        if len(capped) == len(sizes):
            return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at `index`: a four-round Feistel network, walked back into the range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([key, size]).integers(1, 1 << 63, 4, dtype=np.uint64) | np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            spread = (right + np.uint64(1)) * k
            spread ^= spread >> np.uint64(29)
            left, right = right, left ^ ((spread * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(size)
    return out.astype(np.int64)


def _counted(docs: DataFrame) -> DataFrame:
    """Each document's id, source, text hash and number of words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def plan_sources(rows: DataFrame, weights: tuple[float, ...], share: float) -> list[dict]:
    """Each source's number, name, size, documents, blocks and target. Sources are the mix's settings: few, and checked."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: a mix names a weight for each")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    wanted = targets(sizes, [weights[k % len(weights)] for k in range(len(found))], share * sum(sizes)) if found else []
    return [
        {"number": k, "source": r["source"], "size": r["size"], "docs": r["docs"], "blocks": -(-r["size"] // BLOCK_WORDS), "target": t}
        for k, (r, t) in enumerate(zip(found, wanted, strict=True))
    ]


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with the source's number and values, and `begin`: the words of the source before the document.

    Documents are ordered by (part, doc_id, text_hash), the part being a hash; parts are summed first, so that no task
    orders a whole source. `copy` counts rows equal in all of that.
    """
    rows = rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["name"])).drop("name")
    parts = F.greatest(F.floor(F.col("docs") / PART_DOCS), F.lit(1))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash"), parts))
    sums = rows.groupBy("number", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("part_begin"))
    order = Window.partitionBy("number", "part").orderBy("doc_id", "text_hash")
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("copy", F.row_number().over(order) - F.rank().over(order))
    begin = (F.col("part_begin") + F.col("inner")).alias("begin")
    own = ["doc_id", "source", "text_hash", "copy", "number", "size", "source_size", "target"]
    return rows.join(sums, ["number", "part"]).select(*own, begin)


def slots(spark: SparkSession, plan: list[dict], seed: int) -> DataFrame:
    """The mix: shard, slot, number (of the source), pass, block."""
    wanted = np.array([s["target"] * s["blocks"] / s["size"] if s["size"] else 0.0 for s in plan])
    blocks = np.array([s["blocks"] for s in plan], np.int64)
    total = int(round(wanted.sum()))
    shards = -(-total // SHARD_SLOTS)
    odds = wanted / wanted.sum() if total else wanted

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for shard in batch["id"]:
                room = min(SHARD_SLOTS, total - int(shard) * SHARD_SLOTS)
                sure = np.floor(odds * room + 1e-9).astype(np.int64)
                rest = np.clip(odds * room - sure, 0, None)
                left = room - int(sure.sum())
                if left > 0:
                    sure += np.random.default_rng([seed, int(shard)]).multinomial(left, rest / rest.sum())
                own = np.flatnonzero(sure)
                out.append(pd.DataFrame({"shard": int(shard), "number": own, "n": sure[own]}))
            if out:
                yield pd.concat(out)

    counts = spark.range(0, shards, 1, max(1, min(shards, 4 * spark.sparkContext.defaultParallelism)))
    counts = stored(counts.mapInPandas(draw, "shard long, number int, n long"), "shard-counts")
    # a source's slots before a shard: sums of runs of shards first, then inside each run
    run = F.floor(F.col("shard") / 4096)
    runs = counts.groupBy("number", run.alias("run")).agg(F.sum("n").alias("words"))
    before = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("number", "run", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("run_begin"))
    inside = Window.partitionBy("number", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("run", run).withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(runs, ["number", "run"]).select("shard", "number", "n", (F.col("run_begin") + F.col("inner")).alias("first"))

    def name_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, number, n, first in batch.itertuples(index=False):
                j = np.arange(first, first + n)
                j = j[j < MOST_PASSES * blocks[number]]  # a draw beyond the last pass stays empty
                turn, at = np.divmod(j, blocks[number])
                block = np.empty(len(j), np.int64)
                for t in np.unique(turn):
                    block[turn == t] = permuted(at[turn == t], int(blocks[number]), seed * 1_000_003 + int(number) * 101 + int(t))
                yield pd.DataFrame({"shard": shard, "slot": j - first, "number": number, "pass": turn, "block": block})

    # counts are few bytes and slots many: adaptive execution would take them for small, so the tasks' number is set here
    placed = placed.repartition(max(1, -(-shards // TASK_SHARDS)), "shard")
    return placed.mapInPandas(name_blocks, "shard long, slot long, number int, pass int, block long")


def _pieces(placed: DataFrame) -> DataFrame:
    """Each document's part of each block: begin and end in the document's words. Empty documents have none."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / BLOCK_WORDS)
    wide = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / BLOCK_WORDS), last)))
    first_word = F.greatest(F.col("block") * BLOCK_WORDS - F.col("begin"), F.lit(0))
    end_word = F.least((F.col("block") + 1) * BLOCK_WORDS - F.col("begin"), F.col("size"))
    return wide.select("number", "block", "begin", "doc_id", "text_hash", "copy", first_word.alias("from_word"), end_word.alias("to_word"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(documents, mixed).

    documents: a row per input row: doc_id, source, text_hash, copy, number (of the source), size (words), source_size,
    target (its source's words in the mix), begin. mixed: a row for each piece of a document in each slot: shard, slot,
    pass, number, begin, doc_id, text_hash, copy, from_word, to_word; (number, begin) names the document.

    `docs` holds doc_id, text and source; more columns are ignored. Sources stand in code point order, NULL (a source
    like any other) last, and weights repeat along them. NULL and empty texts have no words and are in no slot. Rows that
    repeat a doc_id are documents of their own. Empty input gives an empty mix. The same input and seed give the same mix.
    """
    spark = docs.sparkSession
    rows = stored(_counted(docs), "word-counts")
    plan = plan_sources(rows, weights, share)
    values = [(s["source"], s["number"], s["docs"], s["size"], s["target"]) for s in plan]
    sources = spark.createDataFrame(values, "name string, number int, docs long, source_size long, target double")
    placed = stored(_placed(rows, sources), "placed-documents")
    return placed, slots(spark, plan, seed).hint("merge").join(_pieces(placed), ["number", "block"])


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (its words in the mix, repeats counted)."""
    placed, mixed = mix(docs)
    words = mixed.groupBy("number", "begin").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    # an empty document shares its begin with the next one
    taken = F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken")
    return placed.join(words, ["number", "begin"], "left").select("doc_id", "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """`docs` as the mix takes them: a row per document and pass with the words taken in it, in their order.

    All columns stay; text is cut to the taken words with the white space that follows each, and n_chars, where there is
    one, is its length. A document of which no block is drawn is not in the mix. Nulls, repeated rows and empty input as
    in `mix`.
    """
    placed, mixed = mix(docs)
    spans = mixed.groupBy("number", "begin", "pass").agg(F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"))
    taken = spans.join(placed.filter("size > 0"), ["number", "begin"]).select(
        F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("text_hash").alias("hash"), F.col("copy").alias("turn"), "size", "spans"
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"),
    )
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "source", "text_hash").orderBy("text_hash")) - 1)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash"))
    # a difference, not an equation: the rows stay where the copies were counted
    met = rows.join(taken, same & (F.col("copy") - F.col("turn") == 0))
    said = F.regexp_extract_all("row.text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["to_word"] - x["from_word"])
    cut = F.flatten(F.transform("spans", lambda x: F.slice("said", (x["from_word"] + 1).cast("int"), (x["to_word"] - x["from_word"]).cast("int"))))
    met = met.withColumn("whole", words == F.col("size"))
    met = met.withColumn("said", F.when(~F.col("whole"), said)).withColumn("cut", F.when(F.col("whole"), F.col("row.text")).otherwise(F.array_join(cut, "")))
    columns = []
    for field in docs.schema.fields:
        value = F.col(f"row.`{field.name}`")
        if field.name == "text":
            value = F.col("cut")
        elif field.name == "n_chars":
            value = F.char_length("cut").cast(field.dataType)
        columns.append(value.alias(field.name))
    return met.select(*columns)
