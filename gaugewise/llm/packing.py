"""Packing documents into training sequences by lexical retrieval.

Texts become token ids with a zero at their end. Whole windows of a long document are sequences of their own; what is
left of each document, less than a window, is a unit. Units are dealt into shards of about `SHARD_TOKENS`, like texts
near one another: all tokens have one order, drawn so that a token comes early in proportion to its squared inverse
document frequency, and a unit's place is its two earliest tokens. Two units agree in the first about as often as their
rare tokens do, whatever their doc_id. Each shard is an inverted index with BM25 weights from document frequencies over
all units, and a seed unit asks it with all its tokens and fills its window with its best unused neighbours; the
neighbour that does not fit is cut, and its rest is the next seed. A shard's last tokens become sequences of power-of-two
lengths, so no sequence needs padding.

A seed meets the units of its own shard only: to ask all shards with all units is work that grows with the square of
the corpus.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.hashing import mix
from gaugewise.llm.storage import stored

WINDOW = 1024
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
WEIGHT_STEPS = 256  # weights are whole numbers of that part, so that sums are exact in any order
FREQUENT = 8  # a token that one in so many units of a shard holds has a dense row
CLOSING = 0
VOCABULARY = 1 << 16  # ids are kept as unsigned 16-bit numbers
TOKENS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"

# the public pattern, and one that splits every text alike without going back over a run of characters
SAME_SPLIT = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s",
}
UNUSED = "\0unused\0"

_encoders: dict[tuple[str, str], object] = {}


def encoder(path: str, pattern: str):
    """The byte-level BPE of a rank file, one per process.

    The rank file and `byte_bpe_50k.json` hold the same vocabulary and merges, and give the same ids (a test compares
    them); this form of it takes a quarter of the time. It has one special token, which no call allows, so that the
    encoder looks for that string: without any, it looks for the empty one and stops at every character.
    """
    import tiktoken

    if (path, pattern) not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if max(ranks.values()) >= VOCABULARY:
            raise ValueError("token ids must be below 65536")
        special = {UNUSED: max(ranks.values()) + 1}
        _encoders[path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=SAME_SPLIT.get(pattern, pattern), mergeable_ranks=ranks, special_tokens=special
        )
    return _encoders[path, pattern]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [n for n, _ in schema])


def _schema(ddl: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return [(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))]


def _tokenise(path: str, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).encode_to_numpy
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or "", disallowed_special=()), np.uint32(0)).astype(np.uint32)
                n = len(ids)
                for start in range(0, n - WINDOW + 1, WINDOW):
                    own = ids[start : start + WINDOW]
                    rows.append((doc_id, start, WINDOW, crc(own), n, 2 * number + 1, own.astype("<u2").tobytes() if keep_ids else None))
                    number += 1
                if n % WINDOW:
                    own = ids[n - n % WINDOW :]
                    rows.append((doc_id, n - len(own), len(own), None, n, None, own.astype("<u2").tobytes()))
            for k in range(0, len(rows), 4096):
                yield _batch(rows[k : k + 4096], _schema(TOKENS))

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        for ids in batch.column("ids"):
            found[np.unique(np.frombuffer(ids.as_py(), "<u2"))] += 1
    seen = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(found[seen], pa.int64())], ["token", "n"])


def token_order(frequency: np.ndarray, count: int) -> np.ndarray:
    """Each token's place in one order: a draw by its hash, divided by its squared inverse document frequency.

    Tokens of one unit alone, of none, and the closing one tell nothing of likeness and come last.
    """
    idf = np.log(1 + (count - frequency + 0.5) / (frequency + 0.5))
    draw = -np.log((mix(np.arange(VOCABULARY, dtype=np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(float) / (1 << 53) + 1e-300)
    draw = np.where(frequency >= 2, draw / np.maximum(idf, 1e-9) ** 2, np.inf)
    draw[CLOSING] = np.inf
    place = np.empty(VOCABULARY, np.int64)
    place[np.argsort(draw, kind="stable")] = np.arange(VOCABULARY)
    place[np.isinf(draw)] = VOCABULARY - 1
    return place


def _near(place: np.ndarray):
    """`near` of each unit: the places of its two earliest tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch.column("ids").to_pylist()
            places = place[np.frombuffer(b"".join(held), "<u2")]
            lengths = np.array([len(x) // 2 for x in held])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            first = np.minimum.reduceat(places, starts)
            places[places == np.repeat(first, lengths)] = VOCABULARY - 1
            near = first << 16 | np.minimum.reduceat(places, starts)
            yield batch.append_column("near", pa.array(near))

    return run


class Index:
    """The BM25 inverted index of one shard's units: postings, and dense rows of the tokens that many units hold.

    The dense rows hold at most `FREQUENT` times as many numbers as there are postings.
    """

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(units)
        lengths = np.array([len(u) for u in units])
        codes = np.repeat(np.arange(self.n, dtype=np.int64) << 16, lengths) | np.concatenate(units).astype(np.int64)
        codes, tf = np.unique(codes[codes & 0xFFFF != CLOSING], return_counts=True)
        unit, term = codes >> 16, codes & 0xFFFF
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[unit] / mean))
        weight = np.maximum(np.rint(weight * WEIGHT_STEPS), 1)
        self.term, self.bounds = term, np.searchsorted(unit, np.arange(self.n + 1))
        order = np.argsort(term, kind="stable")
        self.posted, self.posted_weight = unit[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(VOCABULARY + 1))
        frequent = np.flatnonzero(np.diff(self.at) * FREQUENT > self.n)
        self.row = np.full(VOCABULARY, -1)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.n), np.float32)
        own = self.row[term] >= 0
        self.dense[self.row[term[own]], unit[own]] = weight[own]

    def scores(self, seed: int) -> np.ndarray:
        """Every unit's BM25 score for all the seed's tokens, in steps of weight."""
        terms = self.term[self.bounds[seed] : self.bounds[seed + 1]]
        rows = self.row[terms]
        asked = np.zeros(len(self.dense), np.float32)
        asked[rows[rows >= 0]] = 1
        rare = terms[rows < 0]
        starts, sizes = self.at[rare], self.at[rare + 1] - self.at[rare]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        return np.bincount(self.posted[at], self.posted_weight[at], self.n) + asked @ self.dense

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """The unused units that share most with the seed, as many as a window can hold; ties in their order."""
        scores = self.scores(seed)
        found = np.flatnonzero((scores > 0) & unused)
        worth = -scores[found]
        if len(found) > WINDOW:
            most = worth <= np.partition(worth, WINDOW - 1)[WINDOW - 1]
            found, worth = found[most], worth[most]
        return found[np.argsort(worth, kind="stable")][:WINDOW]


def pack_shard(units: list[np.ndarray], idf: np.ndarray, mean: float) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (unit, begin, end): every token of every unit once, all but the last ones full."""
    index, unused = Index(units, idf, mean), np.ones(len(units), bool)
    following, seed, begin = 0, None, 0
    window: list[tuple[int, int, int]] = []
    room = WINDOW
    while True:
        if seed is None:
            while following < len(units) and not unused[following]:
                following += 1
            if following == len(units):
                break
            seed, begin = following, 0
            unused[seed] = False
        queue = itertools.chain([(seed, begin)], ((int(u), 0) for u in index.neighbours(seed, unused)))
        seed = None
        for unit, start in queue:
            take = min(room, len(units[unit]) - start)
            unused[unit] = False
            window.append((unit, start, start + take))
            room -= take
            if not room:
                yield window
                window, room = [], WINDOW
                if start + take < len(units[unit]):
                    seed, begin = unit, start + take
                break
    yield from _powers(window)


def _powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The last tokens, cut into sequences of power-of-two lengths, the longest first."""
    left = sum(end - begin for _, begin, end in window)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            unit, begin, end = window[0]
            take = min(room, end - begin)
            out.append((unit, begin, begin + take))
            room -= take
            window = ([(unit, begin + take, end)] if begin + take < end else []) + window[1:]
        yield out


def _pack(idf: np.ndarray, mean: float, shard_tokens: int, keep_ids: bool):
    def shard(rows: list[tuple[int, int, int, np.ndarray]], number: int) -> tuple[list[tuple], int]:
        out = []
        for window in pack_shard([r[3] for r in rows], idf, mean):
            offset = 0
            for unit, begin, end in window:
                doc_id, start, doc_tokens, ids = rows[unit]
                own = ids[begin:end]
                out.append((doc_id, start + begin, end - begin, crc(own), doc_tokens, 2 * number, offset, own.tobytes() if keep_ids else None))
                offset += end - begin
            number += 1
        return out, number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, held = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
            for doc_id, start, doc_tokens, ids in zip(*columns, strict=True):
                rows.append((doc_id, start, doc_tokens, np.frombuffer(ids, "<u2")))
                held += len(rows[-1][3])
                if held >= 2 * shard_tokens:
                    out, number = shard(rows, number)
                    yield _batch(out, _schema(PIECES))
                    rows, held = [], 0
        if rows:
            yield _batch(shard(rows, number)[0], _schema(PIECES))

    return run


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (16-bit, if kept).

    `docs` holds doc_id and text; more columns are ignored. `vocabulary` is a rank file and `pattern` what splits a text
    before merges; both must be readable by the executors. NULL and empty texts are one token, the closing 0. Rows that
    repeat a doc_id, or have none, are documents of their own. A seed finds neighbours in its shard of about `shard_tokens`
    tokens; equal scores go by place in the shard. Empty input gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = stored(texts.mapInArrow(_tokenise(vocabulary, pattern, keep_ids), TOKENS), "tokens")
    units = tokens.filter("sequence_id is null")
    found = units.select("ids").mapInArrow(_frequencies, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    count, total = units.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = np.zeros(VOCABULARY)
    for token, n in found:  # at most one row per token id
        frequency[token] = n
    idf = np.log(1 + (count - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    shards = max(1, round(total / shard_tokens))
    places = units.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(
        _near(token_order(frequency, count)), "doc_id long, start long, doc_tokens long, ids binary, near long"
    )
    dealt = places.repartitionByRange(shards, "near", "doc_id", "start").sortWithinPartitions("near", "doc_id", "start", "ids")
    packed = dealt.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(_pack(idf, total / max(count, 1), shard_tokens, keep_ids), PIECES)
    whole = tokens.filter("sequence_id is not null").withColumn("offset", F.lit(0).cast("long")).select(*packed.columns)
    return whole.union(packed)
