"""Phrases that keep together, counted by multikey three-way quicksort of suffix pointers.

1. Texts become chunks of word numbers with a dictionary of their own; dictionaries are summed to global counts, and
   words that reach the least count get global numbers. All else is a gap, for no phrase across it can be frequent.
   A chunk is many short rows, a row for each word of its dictionary and one for every few hundred places: readers,
   sorts and Arrow batches take rows by the thousand, and long ones would all be in memory at once.
2. Every place in a text starts a suffix of at most four words, up to the next gap or end of a piece. Suffixes, equal
   ones of a chunk added up, are routed by their leading words: Spark deals ranges of them, so that a frequent first
   word or pair is spread over as many tasks as its suffixes need.
3. A task sorts its suffix pointers by multikey three-way quicksort. A partition of pointers equal in their first words
   has as size the count of those words; a partition too small to hold a frequent phrase is abandoned unsorted. Only
   the prefixes of a task's least and greatest suffix can go on in another task: their sizes are added up afterwards.
4. Scores of all cuts and the phrases inside longer ones are joins of that table of counts with itself.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugewise.llm.storage import stored

LEAST = 30
DEPTH = 4
TOP = 2000
NESTED_PERCENT = 80
CHUNK_WORDS = 1 << 19  # about
PENDING_WORDS = 1 << 21  # read before chunks are cut, of all languages
TEXTS = 64  # in Python at once
ROW_WORDS = 1 << 9  # starts of suffixes in a row
SMALL = 4096  # partitions of so many pointers are sorted outright
SUFFIXES = 1 << 20  # of one sorting task, about
PIECE = 1 << 20
END = 0  # number of a gap or an end
STOP = b"\xff"  # ends a piece; no byte of UTF-8
CHUNKS = ["chunk", "lang", "at", "word", "n", "ids"]
BYTES = bytes(b + 32 if 65 <= b <= 90 else STOP[0] if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


def _numbers() -> defaultdict[bytes, int]:
    """Words with their numbers, the next one given on first sight."""
    words: defaultdict[bytes, int] = defaultdict()
    words.default_factory = words.__len__
    words[STOP] = END
    return words


def _word_numbers(text: bytes, words: defaultdict[bytes, int]) -> Iterator[np.ndarray]:
    """Numbers of a text's words, END at ends of pieces; `words` grows by those not met before."""
    text, start = text.translate(BYTES), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        tokens = text[start:end].replace(STOP, b" " + STOP + b" ").split()
        yield np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
        start = end
    yield np.zeros(1, np.int32)


def _chunk_parts(words: dict[bytes, int], numbers: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, int, np.ndarray]]:
    """(words, how often each begins a suffix, starts, numbers into the words from 1) of parts of about CHUNK_WORDS starts.

    The numbers go on for a few words after the starts.
    """
    names = list(words)
    size = -(-len(numbers) // max(1, round(len(numbers) / CHUNK_WORDS)))
    for start in range(0, len(numbers), size):
        part = numbers[start : start + size + DEPTH - 1]
        starts = min(size, len(numbers) - start)
        used, local = np.unique(part, return_inverse=True)
        if used[0] != END:
            used, local = np.concatenate([np.zeros(1, used.dtype), used]), local + 1
        yield [names[u] for u in used[1:]], np.bincount(local[:starts], minlength=len(used))[1:], starts, local.astype(np.int32)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))


def _chunk_rows(chunk: int, lang: str, names: list[bytes], counts: np.ndarray, starts: int, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The words of a chunk, then its places: `n` starts in a row, and the few words after them."""
    size, at = len(names), range(0, starts, ROW_WORDS)
    if size:
        columns = [
            pa.array(np.full(size, chunk)),
            pa.array([lang] * size),
            pa.array(np.arange(1, size + 1, dtype=np.int32)),
            pa.array(names, pa.binary()).cast(pa.string()),
            pa.array(counts, pa.int64()),
            pa.nulls(size, pa.list_(pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, CHUNKS)
    columns = [
        pa.array(np.full(len(at), chunk)),
        pa.array([lang] * len(at)),
        pa.array(np.zeros(len(at), np.int32)),
        pa.nulls(len(at), pa.string()),
        pa.array([min(ROW_WORDS, starts - a) for a in at], pa.int64()),
        _lists([ids[a : a + ROW_WORDS + DEPTH - 1] for a in at]),
    ]
    yield pa.RecordBatch.from_arrays(columns, CHUNKS)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks of texts of one language: `n` of word number `at`, or `n` starts and `ids`, numbers into the words from 1."""
    made = TaskContext.get().partitionId() << 32
    pending: dict[str, tuple[dict, list]] = {}
    sizes: dict[str, int] = {}
    total = 0

    def flushed(langs: list[str]) -> Iterator[pa.RecordBatch]:
        nonlocal made, total
        for lang in langs:
            words, parts = pending.pop(lang)
            total -= sizes.pop(lang)
            words.default_factory = None  # it holds `words`, which only a rare search for cycles would free
            for part in _chunk_parts(words, np.concatenate(parts)):
                yield from _chunk_rows(made, lang, *part)
                made += 1

    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            some = batch.slice(start, TEXTS)
            for lang, text in zip(some.column("lang").to_pylist(), some.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if lang not in pending:
                    pending[lang], sizes[lang] = (_numbers(), []), 0
                words, parts = pending[lang]
                for numbers in _word_numbers(text or b"", words):
                    parts.append(numbers)
                    sizes[lang] += len(numbers)
                    total += len(numbers)
                if sizes[lang] >= CHUNK_WORDS:
                    yield from flushed([lang])
                elif total >= PENDING_WORDS:
                    yield from flushed([*pending])
    yield from flushed([*pending])


def _renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of places in global numbers; a word that has none becomes END, and a chunk without any goes.

    Rows are sorted by `key`, twice the chunk, plus 1 for places: the known words of a chunk come before its places.
    """
    chunk, table = None, None
    for batch in batches:
        key, at, n = (batch.column(c).to_numpy() for c in ("key", "at", "n"))
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if start == end:
                continue
            if int(key[start]) >> 1 != chunk:
                chunk, table = int(key[start]) >> 1, None
            if not key[start] & 1:
                table = _longer(table, int(at[start:end].max()))
                table[at[start:end]] = n[start:end]
            elif table is not None:
                rows = batch.column("ids").slice(start, end - start)
                ids, offsets = rows.flatten().to_numpy(), rows.offsets.to_numpy()
                table = _longer(table, int(ids.max(initial=0)))
                lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(table[ids]))
                yield pa.RecordBatch.from_arrays([pa.array(n[start:end], pa.int32()), lists], ["starts", "ids"])


def _longer(table: np.ndarray | None, last: int) -> np.ndarray:
    """`table` with a place for `last`; END where nothing was."""
    if table is None:
        return np.full(last + 1, END, np.int32)
    return table if last < len(table) else np.concatenate([table, np.full(last + 1 - len(table), END, np.int32)])


def _folded(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal suffixes as one row with the sum of their counts."""
    if not len(high):
        return high, low, n
    order = np.lexsort((low, high))
    high, low, n = high[order], low[order], n[order]
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(first)
    return high[at], low[at], np.add.reduceat(n, at)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of four words as two longs of two numbers each, with how often some rows of one chunk's size have them."""
    many = max(1, CHUNK_WORDS // ROW_WORDS)
    for batch in batches:
        for row in range(0, batch.num_rows, many):
            rows = batch.slice(row, many)
            lists, starts = rows.column("ids"), rows.column("starts").to_numpy()
            offsets = lists.offsets.to_numpy()
            ids = np.concatenate([lists.flatten().to_numpy(), np.full(DEPTH, END, np.int32)])
            begins = np.zeros(len(ids) + 1, np.int8)  # 1 at a row's first start, -1 behind its last
            np.add.at(begins, offsets[:-1] - offsets[0], 1)
            np.add.at(begins, offsets[:-1] - offsets[0] + starts, -1)
            at = np.flatnonzero((np.cumsum(begins[:-1], dtype=np.int8) > 0) & (ids != END))
            words = [ids[at]]
            for k in range(1, DEPTH):  # stays in its row: a row has all words that its starts need, or ends with a text
                words.append(np.where(words[-1] == END, END, ids[at + k]))
            high, low = (words[k].astype(np.int64) << 32 | words[k + 1] for k in (0, 2))
            high, low, n = _folded(high, low, np.ones(len(at), np.int64))
            for a in range(0, len(high), 1 << 16):
                columns = [pa.array(x[a : a + (1 << 16)]) for x in (high, low, n)]
                yield pa.RecordBatch.from_arrays(columns, ["high", "low", "n"])


def _small_sizes(words: list[np.ndarray], part: np.ndarray, n: np.ndarray, leading: tuple, least: int) -> Iterator[tuple]:
    """The same for few pointers: sorted by the words left, sizes are sums over runs of equal ones."""
    part = part[np.lexsort([w[part] for w in reversed(words)])]
    total = np.concatenate([np.zeros(1, n.dtype), np.cumsum(n[part])])
    new = np.zeros(len(part), bool)
    new[0] = True
    columns: list[np.ndarray] = []
    for column in words:
        keys = column[part]
        columns.append(keys)
        new[1:] |= keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        size = total[np.append(first[1:], len(part))] - total[first]
        often = np.flatnonzero((size >= least) & (keys[first] != END))
        if not len(often):
            return
        for row, prefix in zip(often, zip(*(c[first[often]].tolist() for c in columns), strict=True), strict=True):
            yield (*leading, *prefix), int(size[row])


def phrase_sizes(words: list[np.ndarray], n: np.ndarray, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """(leading words, size) of every partition of equal leading words whose size is at least `least`.

    Multikey three-way quicksort: pointers are parted by one word into less, equal and greater; less and greater are
    parted again by the same word, equal by the next one. A partition below `least` is left as it is, and one of at most
    SMALL pointers is sorted by all words left at once.
    """
    pointers = np.arange(len(n), dtype=np.int32)
    stack = [(0, len(n), ())]
    while stack:
        start, end, leading = stack.pop()
        part = pointers[start:end]
        if not len(part) or (end - start < least and n[part].sum() < least):
            continue
        if len(part) <= SMALL:
            yield from _small_sizes(words[len(leading) :], part, n, leading, least)
            continue
        keys = words[len(leading)][part]
        probe = sorted((keys[0], keys[len(keys) // 2], keys[-1]))
        pivot = probe[1]
        equal = keys == pivot
        same = part[equal]
        if len(same) < len(part):
            less, more = part[keys < pivot], part[keys > pivot]
            middle, upper = start + len(less), end - len(more)
            pointers[start:middle], pointers[middle:upper], pointers[upper:end] = less, same, more
            stack.append((start, middle, leading))
            stack.append((upper, end, leading))
        else:
            middle, upper = start, end
        if pivot != END:
            size = int(n[same].sum())
            if size >= least:
                prefix = (*leading, int(pivot))
                yield prefix, size
                if len(prefix) < len(words):
                    stack.append((middle, upper, prefix))


def _sorted_sizes(least: int):
    """(high, low, f) of the frequent phrases of a range of suffixes; sizes at its two ends are parts of a sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, fresh, kept = [], 0, 0
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("high", "low", "n")])
            fresh += batch.num_rows
            if fresh > max(SUFFIXES, kept):  # copies of one suffix from many chunks
                parts = [list(_folded(*(np.concatenate(x) for x in zip(*parts, strict=True))))]
                fresh, kept = 0, len(parts[0][0])
        if not fresh and not kept:
            return
        high, low, n = _folded(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        del parts
        words = [(x >> s & 0xFFFFFFFF).astype(np.uint32) for x in (high, low) for s in (32, 0)]
        ends: dict[tuple[int, ...], int] = {}
        for row in (0, len(n) - 1):
            inside, leading = np.ones(len(n), bool), ()
            for column in words[:-1]:
                if column[row] == END:
                    break
                inside &= column == column[row]
                leading = (*leading, int(column[row]))
                ends[leading] = int(n[inside].sum())
        order = np.random.default_rng(len(n)).permutation(len(n))  # pivots are read from sorted input otherwise
        found = dict(phrase_sizes([w[order] for w in words], n[order], least)) | ends
        rows = [(*p, *([END] * (DEPTH - len(p))), f) for p, f in found.items()]
        table = np.array(rows, np.int64).reshape(-1, DEPTH + 1)
        columns = [pa.array(table[:, 0] << 32 | table[:, 1]), pa.array(table[:, 2] << 32 | table[:, 3]), pa.array(table[:, 4])]
        yield pa.RecordBatch.from_arrays(columns, ["high", "low", "f"])

    return run


def _numbered(frequent: DataFrame) -> DataFrame:
    """`number` from 1 without gaps: the place inside a written part behind the sizes of the parts before it."""
    placed = stored(frequent.withColumn("_at", F.monotonically_increasing_id()), "phrase-words")
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("_part").count().orderBy("_part").collect()  # one row for each task of the write
    shifts = np.cumsum([1, *(row["count"] for row in sizes)], dtype=np.int64)
    if shifts[-1] >= 1 << 31:
        raise ValueError("more than 2^31 words reach the least count")
    columns = [pa.array([row["_part"] for row in sizes], pa.int64()), pa.array(shifts[:-1])]
    # a table, because rows of a list would start Python workers on every executor, which stay
    offsets = placed.sparkSession.createDataFrame(pa.table(columns, ["_part", "_shift"]))
    return placed.join(F.broadcast(offsets), "_part").withColumn("number", (F.col("_at") + F.col("_shift")).cast("int")).drop("_at", "_part", "_shift")


def phrase_counts(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, words, totals): phrase (array of word numbers) and f; lang, word, f, number; lang and n."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    chunks = stored(texts.mapInArrow(_chunks, "chunk long, lang string, at int, word string, n long, ids array<int>"), "phrase-chunks")
    local = chunks.filter("word is not null").drop("ids")
    totals = local.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(_numbered(local.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)), "phrase-numbers")
    known = local.drop("n").join(words.select("lang", "word", "number"), ["lang", "word"])
    # empty and not NULL: for every row, Spark's Arrow writer goes over all NULL lists that came last
    known = known.selectExpr("chunk", "chunk * 2 as key", "at", "number as n", "cast(array() as array<int>) as ids")
    rows = chunks.filter("word is null").selectExpr("chunk", "chunk * 2 + 1 as key", "at", "cast(n as int) as n", "ids")
    texts = known.unionAll(rows).repartition("chunk").sortWithinPartitions("key").drop("chunk")
    texts = stored(texts.mapInArrow(_renumbered, "starts int, ids array<int>"), "phrase-texts")
    places = texts.agg(F.sum("starts")).first()[0] or 0
    tasks = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-places // SUFFIXES))
    suffixes = texts.mapInArrow(_suffixes, "high long, low long, n long").repartitionByRange(tasks, "high", "low")
    sizes = suffixes.mapInArrow(_sorted_sizes(least), "high long, low long, f long")
    sizes = sizes.groupBy("high", "low").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    parts = F.array(*[F.shiftright(c, s).bitwiseAND(0xFFFFFFFF) for c in ("high", "low") for s in (32, 0)])
    return stored(sizes.select(F.filter(parts, lambda x: x > END).alias("phrase"), "f"), "phrase-counts"), words, totals


def _scored(counts: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their lowest-scoring cut."""
    cuts = counts.filter(F.size("phrase") > 1).select("phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("phrase", F.lit(1), F.col("k")).alias("first"), F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest")
    cuts = cuts.withColumn("score", F.expr("cast(a as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r)"))
    return cuts.groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("phrase", "a", "cut.l", "cut.r", "cut.score")


def _inside_longer(counts: DataFrame) -> DataFrame:
    """Greatest count of a longer candidate around each phrase."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("phrase") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.size("phrase") - size + 1), lambda at: F.slice("phrase", at, size)),
        )
    )
    longer = counts.filter(F.size("phrase") > 2).select(F.explode(inner).alias("phrase"), F.col("f").alias("around"))
    return longer.groupBy("phrase").agg(F.max("around").alias("around"))


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, nested_percent: int = NESTED_PERCENT) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the first `top` phrases of each language.

    `documents` holds text and lang; more columns are ignored. A-Z is lower-cased; `.,;:!?` and line ends end a piece,
    blanks and tabs part words; phrases lie inside pieces. a counts a phrase of 2 to 4 words (at least `least`), l and r
    the two parts of its lowest-scoring cut (ties to the first), score is floor(2000000 a / (l + r)), n counts all words
    of the language. A phrase inside a longer candidate with at least `nested_percent` percent of its count is dropped.
    Order: score and a descending, phrase by UTF-8 bytes. A NULL lang is `und`; a NULL or empty text has no words;
    repeated rows count each. A language without such phrases, and an empty table, give no rows.
    """
    counts, words, totals = phrase_counts(documents, least)
    kept = _scored(counts).join(_inside_longer(counts), "phrase", "left")
    kept = kept.filter(f"around is null or cast(around as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {nested_percent}").drop("around")
    kept = kept.join(words.select(F.col("number").alias("leading"), "lang"), F.col("leading") == F.col("phrase")[0])
    # the first by score and count, ties whole: their words decide only among those
    ties = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    kept = kept.drop("leading").withColumn("place", ties).filter(F.col("place") <= top)
    spelled = kept.select("phrase", F.posexplode("phrase").alias("at", "number")).join(words.select("number", "word"), "number")
    spelled = spelled.groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = kept.join(spelled, "phrase").withColumn("phrase", F.array_join("w.word", " ")).join(totals, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
