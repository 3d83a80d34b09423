"""Near-duplicate groups by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so `PERMUTATIONS`
evaluations give twice as many values. Bands of three permutations (six values) name buckets; documents of one bucket
are candidates, and every link is confirmed on the full shingle sets.

Copies with equal sets become one class before any bucket is formed. In a bucket nobody is paired with everybody:
members meet the bucket's pivots, the members that share most buckets with others, and once a round has joined
components only members of different components meet again. What pivots leave apart is a crowd of texts that are alike,
mostly not alike enough; its sets are compared in blocks, so no colliding pair of two components stays unconfirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.hashing import mix, text_parts, word_hashes
from gaugewise.llm.storage import stored

SHINGLE = 5
SIMILAR = 75  # per cent
PERMUTATIONS = 126
PER_BAND = 3
PIVOT_ROUNDS = 2
CROWD_BLOCK = 256  # documents
CROWD_COLUMNS = 8192  # shingles at a time
BROADCAST_ROWS = 500_000
SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
SHINGLES = "doc_id long, shingles array<long>"

_rng = np.random.default_rng(20_240_601)
FACTORS = (_rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
SHIFTS = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)[:, None]
BAND_FACTORS = _rng.integers(1, 1 << 63, 2 * PER_BAND, dtype=np.uint64) | np.uint64(1)
WORD_FACTORS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
SET_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    for _, data, offsets in text_parts(column):
        words, at = word_hashes(data, offsets)
        n = len(words)
        rolled = np.zeros(n, np.uint64)
        if n >= SHINGLE:
            inner = words[: n - SHINGLE + 1] * WORD_FACTORS[0]
            for k in range(1, SHINGLE):
                inner += words[k : n - SHINGLE + 1 + k] * WORD_FACTORS[k]
            rolled[: n - SHINGLE + 1] = mix(inner)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= SHINGLE:
                yield np.unique(rolled[a : b - SHINGLE + 1])
            elif b > a:
                yield mix((words[a:b] * WORD_FACTORS[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """Bucket keys of one non-empty shingle set."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(folded), 2048):
        permuted = FACTORS * folded[None, k : k + 2048] + SHIFTS
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    values = np.concatenate([low.reshape(-1, PER_BAND), high.reshape(-1, PER_BAND)], axis=1).astype(np.uint64)
    return mix((values * BAND_FACTORS).sum(axis=1) + np.arange(1, len(values) + 1, dtype=np.uint64) * SET_SALT)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, a, b, bands = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            sizes.append(len(s))
            a.append(int(s.sum().view(np.int64)) if len(s) else 0)
            b.append(int(mix(s ^ SET_SALT).sum().view(np.int64)) if len(s) else 0)
            bands.append(band_keys(s).view(np.int64) if len(s) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), _lists(bands)],
            ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(rows)], ["doc_id", "shingles"])


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): for every end of `edges` (a, b) the smallest id that its links reach.

    Each round hooks every end to its least neighbour and that one's own, then moves the links to the new names and drops
    those inside one component, so later rounds read only the links that still matter.
    """
    links = stored(edges.select("a", "b").filter("a <> b").distinct(), "links")
    labels = None
    while True:
        ends = links.select("a", "b").union(links.select("b", "a"))
        hooks = ends.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp"))
        target = hooks.select(F.col("id").alias("comp"), F.col("comp").alias("jump"))
        hooks = stored(hooks.join(target, "comp").select("id", F.col("jump").alias("comp")), "hooks")
        if labels is None:
            labels = hooks
        else:
            moved = hooks.select(F.col("id").alias("comp"), F.col("comp").alias("new"))
            labels = stored(labels.join(moved, "comp", "left").select("id", F.coalesce("new", "comp").alias("comp")), "labels")
        x = hooks.select(F.col("id").alias("a"), F.col("comp").alias("x"))
        y = hooks.select(F.col("id").alias("b"), F.col("comp").alias("y"))
        left = links.join(x, "a").join(y, "b").filter("x <> y")
        links = stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose full shingle sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    near = pairs.join(left, "a").join(right, "b").filter(100 * small >= SIMILAR * large)
    both = near.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return both.filter(100 * F.col("common") >= SIMILAR * (F.col("n") - F.col("common"))).select("a", "b")


def _linked(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links (a, b) between the documents of two blocks that join different components; a spanning set of them."""
    ids, comps, sizes, said = [], [], [], []
    for side in (left, right):
        ids.append(side.column("id").to_pylist())
        comps.append(side.column("comp").to_pylist())
        sets = side.column("shingles").combine_chunks()
        sizes.append(np.diff(sets.offsets.to_numpy()))
        said.append(sets.flatten().to_numpy())
    common = np.intersect1d(said[0], said[1])
    counts = np.zeros((len(ids[0]), len(ids[1])), np.float32)
    for k in range(0, len(common), CROWD_COLUMNS):
        part = common[k : k + CROWD_COLUMNS]
        dense = []
        for side in (0, 1):
            at = np.minimum(np.searchsorted(part, said[side]), len(part) - 1)
            own = part[at] == said[side]
            holds = np.zeros((len(sizes[side]), len(part)), np.float32)
            holds[np.repeat(np.arange(len(sizes[side])), sizes[side])[own], at[own]] = 1
            dense.append(holds)
        counts += dense[0] @ dense[1].T
    near = 100 * counts >= SIMILAR * (sizes[0][:, None] + sizes[1][None, :] - counts)
    root = {c: c for c in (*comps[0], *comps[1])}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    out: tuple[list[int], list[int]] = ([], [])
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = find(comps[0][i]), find(comps[1][j])
        if x != y:
            root[max(x, y)] = min(x, y)
            out[0].append(ids[0][i])
            out[1].append(ids[1][j])
    return pa.table([pa.array(c, pa.int64()) for c in out], ["a", "b"])


def _crowd_links(active: DataFrame, sets: DataFrame) -> DataFrame:
    """Every link between components that meet in a bucket, where pivots found none.

    Such texts form crowds, alike but mostly not alike enough. A crowd's documents are dealt into blocks of about
    `CROWD_BLOCK`, and blocks meet in pairs: all sets are compared, in bounded pieces, and no pair of documents is a row.
    """
    hub = active.groupBy("key").agg(F.min("id").alias("hub"))
    crowds = components(active.join(hub, "key").filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")))
    crowds = crowds.withColumnRenamed("comp", "crowd")
    blocks = crowds.groupBy("crowd").agg(F.ceil(F.count("*") / CROWD_BLOCK).alias("blocks"))
    comps = active.select("id", "comp").distinct()
    docs = crowds.join(blocks, "crowd").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).join(comps, "id")
    docs = docs.join(sets.select(F.col("doc_id").alias("id"), "shingles"), "id")
    docs = stored(docs.select("crowd", "block", "blocks", "id", "comp", "shingles"), "crowds")
    i, j = F.sequence(F.lit(0).cast("long"), "block"), F.sequence("block", F.col("blocks") - 1)
    left = docs.select("crowd", F.col("block").alias("i"), F.explode(j).alias("j"), "id", "comp", "shingles")
    right = docs.select("crowd", F.explode(i).alias("i"), F.col("block").alias("j"), "id", "comp", "shingles")
    met = left.groupBy("crowd", "i", "j").cogroup(right.groupBy("crowd", "i", "j"))
    return met.applyInArrow(_linked, "a long, b long")


def groups(signatures: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, comp): for each class of equal shingle sets with a link, named by its smallest doc_id, its component.

    Links are confirmed until every similar pair of classes that share a bucket is in one component.
    """
    spark = docs.sparkSession
    classes = signatures.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles")
    classes = classes.agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands"))
    entries = stored(classes.select("id", F.explode("bands").alias("key")), "bands")
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = entries.join(shared, "key")
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    members = stored(members.select("key", "id").join(weight, "id").select("key", "id", "weight"), "members")
    ids = stored(members.select(F.col("id").alias("doc_id")).distinct(), "candidates")
    if ids.count() <= BROADCAST_ROWS:  # else both sides are shuffled
        ids = F.broadcast(ids)
    wanted = _docs(docs).join(ids, "doc_id")
    sets = wanted.mapInArrow(_shingles, SHINGLES).groupBy("doc_id").agg(F.min_by("shingles", F.size("shingles")).alias("shingles"))
    sets = stored(sets, "shingles")

    found = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "id long, comp long")
    used = spark.createDataFrame([], "key long, id long")
    for turn in range(PIVOT_ROUNDS + 1):
        placed = members.join(labels, "id", "left").select("key", "id", "weight", F.coalesce("comp", "id").alias("comp"))
        apart = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
        active = stored(placed.join(apart, "key"), "active")
        if active.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            free = active.join(used, ["key", "id"], "left_anti")
            pivots = free.groupBy("key").agg(F.max_by(F.struct("id", "comp", "weight"), F.struct("weight", -F.col("id"))).alias("p"))
            pivots = stored(pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.comp").alias("pivot_comp"), F.col("p.weight").alias("most")), "pivots")
            used = used.union(pivots.select("key", F.col("pivot").alias("id")))
            # each member meets one pivot, the best that its buckets offer
            met = active.join(pivots, "key").filter("comp <> pivot_comp").groupBy("id")
            met = met.agg(F.max_by("pivot", F.struct("most", -F.col("pivot"))).alias("pivot"))
            pairs = stored(met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(), "pairs")
            fresh = _confirmed(pairs, sets)
        else:
            fresh = _crowd_links(active, sets)
        fresh = stored(fresh, "confirmed")
        if not fresh.isEmpty():
            found = found.union(fresh)
            labels = components(found)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    `docs` holds doc_id and text; more columns are ignored. Words are runs without ASCII white space, A-Z lower-cased;
    a set holds the distinct 5-word shingles, or the whole sequence where there are fewer words. NULL and empty texts
    have an empty set, link with nothing and are kept. Rows that repeat a doc_id count as one document for linking and
    each get a row; a NULL doc_id links with nothing, has a NULL component and is kept. Empty input gives no rows.
    """
    signatures = stored(_docs(docs).mapInArrow(_signatures, SIGNATURE), "signatures")
    labels = groups(signatures, docs)
    rows = signatures.select("doc_id", "n_shingles", "set_a", "set_b")
    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles")
    classes = classes.agg(F.min("doc_id").alias("id"))
    placed = classes.join(labels, "id", "left")
    placed = placed.select("set_a", "set_b", "n_shingles", F.coalesce("comp", "id").alias("group_id"))
    out = rows.join(placed, ["set_a", "set_b", "n_shingles"], "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("group_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("group_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each group, its smallest doc_id; all columns as they are."""
    dropped = near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")

