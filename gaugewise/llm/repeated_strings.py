"""Removal of byte strings that start at two places, through suffix intervals of a Burrows-Wheeler transform.

Every start of a string of the least length is dealt to an anchor: of the shorter strings inside it, the one with the
least hash (the leftmost of equal ones). Equal strings have equal anchors, so all places of a string meet under one
anchor's hash, wherever they are. A run of starts with one anchor, and the bytes those strings cover, is a context.

1. Texts become contexts; of a text that repeats, and of a context that repeats, one copy goes on with its count.
2. Contexts whose anchor occurs once hold no repeated string. The others are dealt by anchor to shards of bounded size.
3. A shard sorts the suffixes of its contexts to the least length, takes their Burrows-Wheeler transform, and expands
   the intervals of strings breadth first by one byte to the left. The round of length l finds the places in suffix order
   whose common prefix is l - 1; after the least length, what is left between two such places is one repeated string.
4. Anchors with too many different contexts for a shard are dealt again by longer anchors; at the least length the
   anchor is the string itself, and its count is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.hashing import INVERSE, PRIME, _powers_of, mix, text_parts
from gaugewise.llm.storage import stored

LEAST = 400
ANCHORS = (0.32, 0.96, 1.0)  # of the least length: anchors of the first round, of hot ones, and the string itself
CROWD = 2048  # different contexts of one anchor that still go to one shard
SHARD_BYTES = 2 << 20
SLICE = 1 << 20
PLACE_BITS = 21  # more than a slice and the strings that begin in it
PRIME_2 = 0xD6E8FEB86659FD93
INVERSE_2 = pow(PRIME_2, -1, 1 << 64)
RUNS = "key binary, a array<int>, w array<int>, anchor array<long>, context array<long>"


def _sums(data: np.ndarray, prime: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers_of(prime, len(data)), out=out[1:])
    return out


def _least_inside(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` values in a row: of a block's rest and the next one's beginning."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def text_runs(data: np.ndarray, starts: np.ndarray, least: int, size: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with one anchor of `size` bytes: first start, number of starts, hashes of anchor and context.

    `starts` marks the bytes at which a string of `least` bytes may begin.
    """
    total = _sums(data, PRIME)
    hashes = mix((total[size:] - total[:-size]) * _powers_of(INVERSE, len(data))[: len(data) - size + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    placed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least_inside(placed, least - size + 1) & low).astype(np.int64)
    at = np.flatnonzero(starts[: len(anchor)])
    if not len(at):
        return at, at, hashes[:0], hashes[:0]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    a = at[first]
    w = np.diff(np.append(first, len(at)))
    total = _sums(data, PRIME_2)
    context = (total[a + w + least - 1] - total[a]) * _powers_of(INVERSE_2, len(data))[a]
    return a, w, hashes[anchor[a]], mix(context + w.astype(np.uint64))


def _marked(bounds: np.ndarray, least: int, n: int, ranges: list | None, first: int) -> np.ndarray:
    """Starts inside each row and, where ranges are given, inside them."""
    starts = np.zeros(n + 1, np.int32)
    for row in range(len(bounds) - 1):
        begin, end = bounds[row], bounds[row + 1] - least + 1
        for a, w in [(0, end - begin)] if ranges is None else ranges[first + row] or []:
            if w > 0:
                starts[begin + a] += 1
                starts[begin + a + w] -= 1
    return np.cumsum(starts[:-1]) > 0


def _runs(least: int, size: int):
    """Runs of each text: one row per text that has any; a text met before in this task is left out if `ranges` are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            ranges = None
            if "ranges" in batch.schema.names:
                keys = batch.column("key").to_pylist()
                fresh = np.array([not (k in met or met.add(k)) for k in keys], bool)
                batch = batch.filter(pa.array(fresh))
                ranges = [[(r["a"], r["w"]) for r in x] for x in batch.column("ranges").to_pylist()]
            keys = batch.column("key")
            for first, data, bounds in text_parts(batch.column("text")):
                starts = _marked(bounds, least, len(data), ranges, first)
                found = []
                for begin in range(0, len(data), SLICE):
                    part = data[begin : begin + SLICE + least - 1]
                    if len(part) >= least:
                        a, w, anchor, context = text_runs(part, starts[begin : begin + SLICE], least, size)
                        found.append((a + begin, w, anchor, context))
                if not found:
                    continue
                a, w, anchor, context = (np.concatenate(x) for x in zip(*found, strict=True))
                row = np.searchsorted(bounds, a, "right") - 1
                held, begin = np.unique(row, return_index=True)
                offsets = pa.array(np.append(begin, len(row)).astype(np.int32))
                columns = [keys.take(pa.array(first + held))]
                for x in ((a - bounds[row]).astype(np.int32), w.astype(np.int32), anchor.view(np.int64), context.view(np.int64)):
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(x)))
                yield pa.RecordBatch.from_arrays(columns, ["key", "a", "w", "anchor", "context"])

    return run


def _cut_contexts(least: int):
    """Bytes of the contexts that a text stands for; of copies of the text in a task the first gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for row, key in enumerate(batch.column("key").to_pylist()):
                if key in met:
                    continue
                met.add(key)
                text = texts[row].as_py()
                wanted = batch.column("wanted")[row].values
                a, w = (wanted.field(c).to_numpy() for c in ("a", "w"))
                cut = pa.array([text[i : i + n + least - 1] for i, n in zip(a, w, strict=True)], pa.binary())
                columns = [wanted.field("anchor"), wanted.field("context"), wanted.field("n"), cut]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", "n", "bytes"])

    return run


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first `depth` codes at least: prefix doubling, where only suffixes still equal are sorted on."""
    n = len(codes)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = codes
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    order = np.argsort(key, kind="stable").astype(np.int64)
    rank = np.zeros(n + depth * 2, np.int64)  # first place of a suffix's group, from 1; 0 beyond the end
    slots, sub, key, done = np.arange(n), order, key[order], 8
    while True:
        new = np.ones(len(sub), bool)
        new[1:] = key[1:] != key[:-1]
        rank[sub] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        open_ = ~new
        open_[:-1] |= ~new[1:]
        slots, sub = slots[open_], sub[open_]
        if done >= depth or not len(sub):
            return order
        key = rank[sub] << 32 | rank[sub + done]
        by = np.argsort(key, kind="stable")
        sub, key = sub[by], key[by]
        order[slots] = sub
        done *= 2


class Intervals:
    """Backward extension on a Burrows-Wheeler transform: a wavelet matrix gives the codes before each interval."""

    def __init__(self, transform: np.ndarray):
        n = len(transform)
        self.transform = transform
        self.step = np.empty(n, np.int32)  # where the suffix one longer stands
        self.step[np.argsort(transform, kind="stable")] = np.arange(n, dtype=np.int32)
        counts = np.bincount(transform, minlength=256)
        self.levels, row = [], transform
        for bit in reversed(range(max(1, int(transform.max(initial=0)).bit_length()))):
            one = (row >> bit) & 1 == 1
            zeros = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, zeros[n]))
            row = np.concatenate([row[~one], row[one]])
        base = np.zeros(256, np.int64)
        used, first = np.unique(row, return_index=True)
        base[used] = first
        self.shift = ((np.cumsum(counts) - counts) - base).astype(np.int32)

    def extended(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, start, end) of the interval of code + string for every code before a string's interval."""
        alone = end - start == 1
        one = start[alone]
        l, r = start[~alone], end[~alone]
        code = np.zeros(len(l), np.int32)
        for bit, zeros, total in self.levels:
            l0, r0 = zeros[l], zeros[r]
            l1, r1 = total + l - l0, total + r - r0
            left, right = l0 < r0, l1 < r1
            l, r = np.concatenate([l0[left], l1[right]]), np.concatenate([r0[left], r1[right]])
            code = np.concatenate([code[left], code[right] | (1 << bit)])
        move = self.shift[code]
        at = self.step[one]
        return np.concatenate([code, self.transform[one]]), np.concatenate([l + move, at]), np.concatenate([r + move, at + 1])


def prefixes_below(transform: np.ndarray, least: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in suffix order, by increasing value; -1 where `least` or more.

    Code 0 ends a context and is never extended to the left, so prefixes across an end are left out too.
    """
    n = len(transform)
    tree = Intervals(transform)
    common = np.full(n + 1, -1, np.int16)
    common[0] = common[n] = 0
    start, end = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for length in range(least):
        code, start, end = tree.extended(start, end)
        new = common[end] < 0
        if length:
            new &= code != 0
        start, end = start[new], end[new]
        if not len(start):
            break
        common[end] = length
    return common[:n]


def repeated_starts(contexts: list[bytes], counts: np.ndarray, least: int) -> list[np.ndarray]:
    """For each context, at which of its bytes a string of `least` bytes begins that begins elsewhere too.

    A context that stands for several copies repeats all its strings.
    """
    text = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    lengths = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    used = np.zeros(256, bool)
    used[text] = True
    used[0] = True
    code_of = np.cumsum(used).astype(np.uint8)  # UTF-8 uses fewer than 255 bytes; a NUL of a text is code 1
    codes = code_of[text]
    codes[ends] = 0
    order = suffix_order(codes, least)
    common = prefixes_below(codes[order - 1], least)
    owner = np.searchsorted(ends, order)
    starts = order + least <= ends[owner]
    strings = np.cumsum(common >= 0)
    weight = np.bincount(strings[starts], counts[owner[starts]], int(strings[-1]) + 1)
    many = np.zeros(len(text), bool)
    many[order] = starts & (weight[strings] >= 2)
    return [np.flatnonzero(many[e - n : e]) for e, n in zip(ends, lengths, strict=True)]


def _shard_rows(rows: list[tuple], least: int) -> pa.RecordBatch:
    anchors, contexts, counts, texts = zip(*rows, strict=True)
    a, w = [], []
    for at in repeated_starts(list(texts), np.array(counts), least):
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        a.append(at[first].tolist())
        w.append(np.diff(np.append(first, len(at))).tolist())
    lists = [pa.array(x, pa.list_(pa.int32())) for x in (a, w)]
    return pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(contexts, pa.int64()), *lists], ["anchor", "context", "a", "w"])


def _shards(least: int):
    """Runs of repeated starts of each context; rows come by anchor, and a shard ends between two anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "n", "bytes")), strict=True):
                if size >= SHARD_BYTES and row[0] != last:
                    yield _shard_rows(rows, least)
                    rows, size = [], 0
                if rows and rows[-1][:2] == row[:2]:  # one text read in two tasks
                    continue
                rows.append(row)
                size += len(row[3]) + 1
                last = row[0]
        if rows:
            yield _shard_rows(rows, least)

    return run


def _repeated_runs(texts: DataFrame, least: int) -> DataFrame:
    """(key, a, w): runs of starts of repeated strings by text."""
    spark = texts.sparkSession
    source, pieces = texts, []
    for share in ANCHORS:
        runs = source.mapInArrow(_runs(least, max(1, round(least * share))), RUNS)
        each = [F.first(c).alias(c) for c in ("a", "w", "anchor", "context")]
        if share == ANCHORS[0]:
            whole = stored(runs.groupBy("key").agg(F.count("*").alias("copies"), *each), "repeats-texts")
            copies = whole.select("key", "copies")
        else:
            whole = stored(runs.groupBy("key").agg(*each).join(copies, "key"), "repeats-texts")
        places = whole.select("key", "copies", F.inline(F.arrays_zip("a", "w", "anchor", "context")))
        # written, so that the join below has no aggregate between it and its shuffle and a hot anchor can be split
        often = stored(places.groupBy("anchor").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor"), "repeats-anchors")
        chosen = F.min(F.struct("key", "a", "w")).alias("one")
        contexts = places.join(often, "anchor").groupBy("anchor", "context").agg(F.sum("copies").alias("n"), chosen)
        contexts = stored(contexts, "repeats-contexts")
        crowds = contexts.groupBy("anchor").count().filter(F.col("count") > CROWD).select("anchor")
        hot = stored(crowds, "repeats-crowds")
        crowded = not hot.isEmpty() and share < 1
        fitting = contexts.join(hot, "anchor", "left_anti") if crowded else contexts
        size = fitting.agg(F.sum(F.col("one.w") + least)).first()[0] or 0
        wanted = F.collect_list(F.struct("one.a", "one.w", "anchor", "context", "n")).alias("wanted")  # at most a text's runs
        wanted = fitting.groupBy(F.col("one.key").alias("key")).agg(wanted)
        cut = texts.join(wanted, "key").mapInArrow(_cut_contexts(least), "anchor long, context long, n long, bytes binary")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (4 * SHARD_BYTES)))
        cut = cut.repartition(tasks, "anchor").sortWithinPartitions("anchor", "context")
        found = cut.mapInArrow(_shards(least), "anchor long, context long, a array<int>, w array<int>")
        found = stored(found.filter(F.size("a") > 0).withColumnsRenamed({"a": "from", "w": "many"}), "repeats-found")
        hits = places.join(found, ["anchor", "context"]).select("key", "a", F.inline(F.arrays_zip("from", "many")))
        pieces.append(hits.select("key", (F.col("a") + F.col("from")).alias("a"), F.col("many").alias("w")))
        if not crowded:
            break
        left = places.join(hot, "anchor").groupBy("key").agg(F.collect_list(F.struct("a", "w")).alias("ranges"))
        source = texts.join(left, "key")
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out


def _without(least: int):
    """Each text's bytes without the repeated strings, and the spans removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for r in sorted(runs or [], key=lambda r: r["a"]):
                    end = r["a"] + r["w"] + least - 1
                    if merged and r["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([r["a"], end])
                edges = [0, *[x for span in merged for x in span], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in merged])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [batch.column("doc_id"), pa.array([len(t) for t in kept], pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_kept", "kept", "spans"])

    return run


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def without_repeated_strings(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_bytes, kept (the bytes left), spans (start, end of the maximal removed runs) of every document.

    `documents` holds doc_id and text; more columns are ignored. Texts are UTF-8 bytes; a byte goes if a string of
    `least` bytes that covers it, whole inside its text, starts at any other place too: of another document, of a row
    that repeats this one, or of the same text. All is judged on the input, so every copy goes, the first included, and
    what is left may end inside a character. NULL and empty texts, and ones shorter than `least`, lose nothing (kept is
    empty for NULL). Rows that repeat a doc_id are texts of their own. An empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = docs.filter(F.octet_length("text") >= least).select(_text_key(F.col("text")).alias("key"), "text")
    runs = _repeated_runs(long, least).groupBy("key").agg(F.collect_list(F.struct("a", "w")).alias("runs"))
    joined = docs.withColumn("key", _text_key(F.col("text"))).join(runs, "key", "left").select("doc_id", "text", "runs")
    out = joined.mapInArrow(_without(least), "doc_id long, n_kept long, kept binary, spans array<struct<start: int, end: int>>")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", (F.col("n_kept") + removed).alias("n_bytes"), removed.alias("n_removed"), "kept", "spans")
