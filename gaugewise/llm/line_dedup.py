"""Removal of repeated passages by content-defined chunks of lines.

Units are lines; a line of `LONG_LINE` words or more stands apart from its neighbours and its sentences are its units, so
that a passage written as one line is cut like one of many lines. A rolling hash over the hashes of the last two units
ends a chunk where it falls into one of `SPREAD` residues, so chunks find the same ends again after lines put in or left
out before them. Chunks that occur again anywhere are removed, the first occurrence stays; equal hashes are followed by
a comparison of the bytes.

Passages that begin or end inside a unit are found by marks: of every `SPAN` runs of `MARK_WORDS` words in a row, the one
of least hash, so that any `PASSAGE_WORDS` words hold a mark wherever they stand. A mark that occurs again gives the shift
between its text and that of its first occurrence; along it the words of both are compared, `REACH` words beyond the
outer marks, and every run of `MARK_WORDS` equal words or more is removed. White space need not be equal.
"""

from __future__ import annotations

import itertools
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugewise.llm.hashing import INVERSE, PRIME, WHITE, _powers_of, mix, text_parts, word_hashes
from gaugewise.llm.storage import stored

LONG_LINE = 25
SPREAD = 3
LEAST_UNITS = 2
LEAST_WORDS = 10
MARK_WORDS = LONG_LINE
PASSAGE_WORDS = 50
SPAN = PASSAGE_WORDS - MARK_WORDS + 1
REACH = 64  # words; beyond it a passage has further marks
BLOCK = 1024  # words of the first text that one comparison takes, so that marks far apart are compared on their own
SENTENCE_END = re.compile(r"[.!?]+\s+")
NO_ID = (1 << 63) - 1
BROADCAST_ROWS = 500_000
CHUNKS = "id long, text_hash long, place int, key long"
ENTRIES = [("id", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int32()), ("key", pa.int64())]
MARK = "(key & 1) = 1"  # the last bit of a key: 1 of marks, 0 of chunks
FIRSTS = "first_id long, first_hash long, low int, high int, first_text string"
FIRST_TEXTS = [("first_id", pa.int64()), ("first_hash", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("first_text", pa.string())]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of units, as (begin, end); together they are the whole text."""
    begin, run = 0, []
    for line in text.split("\n"):
        end = min(begin + len(line) + 1, len(text))
        if len(line) >= 2 * LONG_LINE - 1 and len(line.split(None, LONG_LINE)) >= LONG_LINE:
            if run:
                yield run
            run = []
            cuts = [begin, *(begin + m.end() for m in SENTENCE_END.finditer(line) if m.end() < len(line)), end]
            yield list(zip(cuts[:-1], cuts[1:], strict=True))
        elif end > begin:
            run.append((begin, end))
        begin = end
    if run:
        yield run


def chunks(text: str) -> list[tuple[int, int]]:
    """The chunks that may be removed, as (begin, end): of two units and `LEAST_WORDS` words, or of one long line."""
    out = []
    for units in segments(text):
        found, first, last, filled = [], 0, 0, []
        for k, (a, b) in enumerate(units):
            unit = text[a:b].strip()
            filled.append(bool(unit))
            own = xxhash.xxh3_64_intdigest(unit)
            rolled = xxhash.xxh3_64_intdigest(own.to_bytes(8, "little"), seed=last)
            last = own
            if rolled % SPREAD == 0 and k + 1 - first >= LEAST_UNITS:
                found.append((first, k + 1))
                first = k + 1
        if first < len(units):
            if found and len(units) - first < LEAST_UNITS:
                found[-1] = (found[-1][0], len(units))
            else:
                found.append((first, len(units)))
        for i, j in found:
            words = len(text[units[i][0] : units[j - 1][1]].split(None, LONG_LINE))
            if (sum(filled[i:j]) >= LEAST_UNITS and words >= LEAST_WORDS) or words >= LONG_LINE:
                out.append((units[i][0], units[j - 1][1]))
    return out


def _sliding(x: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """The minimum or maximum of every n neighbours."""
    width = 1
    while 2 * width <= n:
        x = pick(x[:-width], x[width:])
        width *= 2
    rest = n - width
    return pick(x[:-rest], x[rest:]) if rest else x


def marks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, first word, key) of the marks: every `PASSAGE_WORDS` words of a row hold one, the same in any row.

    Of equal marks in one row that begin in the same `PASSAGE_WORDS` words only the first is given, so that a text that
    says one thing over and over has few.
    """
    for first_row, data, offsets in text_parts(texts):
        hashes, at = word_hashes(data, offsets, lower=False)
        n = len(hashes)
        if n < PASSAGE_WORDS:
            continue
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers_of(PRIME, n), out=sums[1:])
        runs = mix((sums[MARK_WORDS:] - sums[:-MARK_WORDS]) * _powers_of(INVERSE, n)[: n - MARK_WORDS + 1]) | np.uint64(1)
        least = _sliding(runs, SPAN, np.minimum)
        least[row[: len(least)] != row[PASSAGE_WORDS - 1 :]] = 0  # only windows inside one row count
        edge = np.zeros(SPAN - 1, np.uint64)
        chosen = np.flatnonzero(runs == _sliding(np.concatenate([edge, least, edge]), SPAN, np.maximum))
        key, row, word = runs[chosen].view(np.int64), row[chosen], chosen - at[row[chosen]]
        order = np.lexsort((word, key, row))
        key, row, word = key[order], row[order], word[order]
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (row[1:] == row[:-1]) & (word[1:] // PASSAGE_WORDS == word[:-1] // PASSAGE_WORDS)
        yield first_row + row[~again], word[~again], key[~again]


def _find(inline: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("id", "text_hash", "text")), strict=True):
                for place, (a, b) in enumerate(chunks(text or "")):
                    for column, value in zip(columns, (doc_id, text_hash, place, _signed(xxhash.xxh3_64_intdigest(text[a:b].strip()) & ~1)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, ENTRIES, strict=True)], [n for n, _ in ENTRIES])
            for row, word, key in marks(batch.column("text")) if inline else ():
                own = [batch.column(c).take(pa.array(row)) for c in ("id", "text_hash")]
                own += [pa.array(word.astype(np.int32)), pa.array(key)]
                yield pa.RecordBatch.from_arrays(own, [n for n, _ in ENTRIES])

    return run


def word_starts(text: str) -> list[int]:
    """Where each word begins, in characters."""
    data = np.frombuffer(text.encode(), np.uint8)
    white = WHITE[data]
    first = ~white
    first[1:] &= white[:-1]
    starts = np.flatnonzero(first)
    if len(data) > len(text):
        starts -= np.cumsum(data & 0xC0 == 0x80)[starts]
    return starts.tolist()


def _first_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts asked for in `firsts`: the chunk numbered `low` where `high` is below 0, else the words from low to high."""
    for batch in batches:
        rows = []
        for doc_id, text_hash, text, firsts in zip(*(batch.column(c).to_pylist() for c in ("id", "text_hash", "text", "firsts")), strict=True):
            at = chunks(text) if any(e["high"] < 0 for e in firsts) else []
            words = word_starts(text) if any(e["high"] >= 0 for e in firsts) else []
            for entry in firsts:
                low, high = entry["low"], entry["high"]
                a, b = at[low] if high < 0 else (words[low], words[high] if high < len(words) else len(text))
                rows.append((doc_id, text_hash, low, high, text[a:b].strip()))
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in FIRST_TEXTS]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIRST_TEXTS, strict=True)], [n for n, _ in FIRST_TEXTS])


def _equal_runs(said: list[bytes], other: list[bytes], begin: int) -> Iterator[tuple[int, int]]:
    """Runs of `MARK_WORDS` words or more, as (begin, end) in `said`, that equal those of `other`, put at `begin`."""
    low, high = max(0, begin), min(len(said), begin + len(other))
    unequal = map(operator.ne, said[low:high], other[low - begin : high - begin])
    start = low
    for k in itertools.chain(itertools.compress(range(low, high), unequal), [high]):
        if k - start >= MARK_WORDS:
            yield start, k
        start = k + 1


def _without(text: str, again: list[dict]) -> tuple[str, int, int]:
    """The text without what equals its first occurrence, byte for byte: chunks, and runs of words along a shift."""
    gone = []
    if any(e["high"] < 0 for e in again):
        at = chunks(text)
        gone += [at[e["place"]] for e in again if e["high"] < 0 and text[slice(*at[e["place"]])].strip() == e["first_text"]]
    if any(e["high"] >= 0 for e in again):
        # of bytes, split knows the six kinds of white space that part words, and no other
        said, starts = text.encode().split(), [*word_starts(text), len(text)]
        for e in again:
            if e["high"] >= 0:
                gone += [(starts[i], starts[j]) for i, j in _equal_runs(said, e["first_text"].encode().split(), e["place"])]
    kept, end, n, words = [], 0, 0, 0
    for a, b in sorted(gone):
        if b > end:
            a = max(a, end)
            kept.append(text[end:a])
            end, n, words = b, n + 1, words + len(text[a:b].split())
    return "".join([*kept, text[end:]]), n, words


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, again) to rows (row, n_removed, n_removed_words) with the row's text and n_chars made new."""
    for batch in batches:
        row, again = batch.column("row"), batch.column("again")
        names = [field.name for field in row.type]
        columns = dict(zip(names, row.flatten(), strict=True))
        texts, removed, words = columns["text"].to_pylist(), [0] * len(row), [0] * len(row)
        lengths = columns["n_chars"].to_pylist() if "n_chars" in names else None
        for k, entries in enumerate(again.to_pylist()):
            if entries:
                texts[k], removed[k], words[k] = _without(texts[k], entries)
                if lengths and removed[k]:
                    lengths[k] = len(texts[k])
        columns["text"] = pa.array(texts, row.type.field("text").type)
        if lengths:
            columns["n_chars"] = pa.array(lengths, row.type.field("n_chars").type)
        new = pa.StructArray.from_arrays([columns[n] for n in names], fields=list(row.type))
        yield pa.RecordBatch.from_arrays([new, pa.array(removed, pa.int64()), pa.array(words, pa.int64())], ["row", "n_removed", "n_removed_words"])


def _keyed(docs: DataFrame) -> DataFrame:
    """row (all columns), id (doc_id, with a stand-in for NULL that sorts last), text_hash, text ('' for NULL)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(F.struct("*").alias("row"), number.alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _without_repeats(docs: DataFrame, counts: bool, inline: bool) -> DataFrame:
    texts = _keyed(docs)
    entries = stored(texts.select("id", "text_hash", "text").mapInArrow(_find(inline), CHUNKS), "chunks")
    many = entries.groupBy("key").count().filter("count > 1").select("key")
    met = stored(entries.join(many, "key").distinct(), "repeated-chunks")  # rows equal in id and text are one document
    place = F.struct("id", "text_hash", "place")
    repeated = met.groupBy("key").agg(F.min(place).alias("first"))
    repeated = repeated.select("key", F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), F.col("first.place").alias("first_place"))
    own = (F.col("id") == F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    said = met.join(repeated, "key").filter(~(own & (F.col("place") == F.col("first_place"))))
    said = stored(said, "said-again") if inline else said
    pair = ("id", "text_hash", "first_id", "first_hash")
    wanted = said.filter(f"not ({MARK})").select(*pair, "place", F.col("first_place").alias("low"), F.lit(-1).alias("high"))
    if inline:
        # a mark met again inside itself is one passage, not two
        shifted = said.filter(MARK).filter(~(own & (F.col("place") - F.col("first_place") < MARK_WORDS)))
        shift, block = (F.col("place") - F.col("first_place")).alias("shift"), F.floor(F.col("first_place") / BLOCK).alias("block")
        spans = shifted.groupBy(*pair, shift, block).agg(F.min("first_place").alias("low"), F.max("first_place").alias("high"))
        spans = spans.withColumn("low", F.greatest(F.col("low") - REACH, F.lit(0))).withColumn("high", F.col("high") + MARK_WORDS + REACH)
        wanted = wanted.union(spans.select(*pair, F.expr("low + shift").alias("place"), "low", "high"))
    wanted = stored(wanted, "repeats")

    asked = wanted.select("first_id", "first_hash", "low", "high").distinct()
    firsts = stored(asked.groupBy("first_id", "first_hash").agg(F.collect_list(F.struct("low", "high")).alias("firsts")), "first-places")
    if firsts.count() <= BROADCAST_ROWS:  # else both sides are shuffled
        firsts = F.broadcast(firsts)
    holders = texts.select("id", "text_hash", "text").join(firsts, own).select("id", "text_hash", "text", "firsts")
    first_texts = holders.mapInArrow(_first_texts, FIRSTS)
    # a document in several equal rows names its passages as often
    asked_for = ["first_id", "first_hash", "low", "high"]
    first_texts = stored(first_texts.groupBy(*asked_for).agg(F.min("first_text").alias("first_text")), "first-chunks")

    again = wanted.join(first_texts, asked_for).groupBy("id", "text_hash").agg(F.collect_list(F.struct("place", "high", "first_text")).alias("again"))
    rows = texts.select("row", "id", "text_hash").join(again, ["id", "text_hash"], "left").select("row", "again")
    row = docs.select(F.struct("*").alias("row")).schema["row"]
    schema = T.StructType([row, T.StructField("n_removed", T.LongType()), T.StructField("n_removed_words", T.LongType())])
    out = rows.mapInArrow(_rewrite, schema)
    return out.select("row.*", "n_removed", "n_removed_words") if counts else out.select("row.*")


def without_repeated_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """`docs` with every repeated chunk but its first occurrence taken out of the texts.

    The first occurrence is the one of smallest doc_id (NULL last), then in the text. All rows and columns stay; a text
    without repeats is as it was (NULL stays NULL), one that only repeats becomes empty, and n_chars, where there is one,
    is the new length. Rows equal in doc_id and text are one document and are treated alike. `counts` adds n_removed
    (chunks) and n_removed_words. Empty input gives no rows.
    """
    return _without_repeats(docs, counts, inline=False)


def without_repeated_passages(docs: DataFrame, counts: bool = False) -> DataFrame:
    """As `without_repeated_lines`, and passages of `PASSAGE_WORDS` words or more are found wherever they begin and end.

    A mark is compared with its first occurrence only: where every mark of a passage occurs before in some other text,
    what the passage shares with that text goes, and the rest of it may stay. Words are what white space parts.
    """
    return _without_repeats(docs, counts, inline=True)
