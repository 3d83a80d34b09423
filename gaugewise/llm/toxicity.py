"""Toxicity by class-conditional Kneser-Ney models of character sequences.

Texts become symbols (letters without case, bytes of other scripts folded, runs of anything else one separator). From
the labelled rows, 5-grams are counted for toxic and for ordinary texts. The counts of both classes together give one
Kneser-Ney model, with continuation counts at each lower order; each class's own model interpolates with it, so an
expression that a class has seldom or never seen has the shared probability in both and says nothing. The two
log-likelihoods are compared word by word: a text's evidence is what its words' differences exceed a margin by, summed
and divided by the text's length, so that the many words that both models explain about equally add no noise. A logistic
curve fitted on labelled rows that were not counted turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.hashing import text_parts
from gaugewise.llm.storage import stored

ORDER = 5
BITS = 5
CODES = 1 << (ORDER * BITS)  # the model is one byte for each: 32 MB at any size of the corpus
DISCOUNT = 0.9
STEP = 1 / 12  # of the stored log ratios
MARGIN = 4.0  # of a word's log-likelihood difference
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
EVIDENCE_STEP = 0.0005
BROADCAST_LABELS = 2_000_000
PART = 1 << 23

SYMBOL = np.zeros(256, np.uint8)
SYMBOL[48:58] = 31
SYMBOL[65:91] = SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:] = 27 + np.arange(128) % 4


def symbol_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram code at every symbol of the rows, and the row offsets into them.

    A row begins after separators and ends with one; runs of separators are one symbol.
    """
    symbols = SYMBOL[data]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
    rows = len(offsets) - 1
    padded = np.zeros(int(ends[-1]) + ORDER * rows + 1, np.uint32)
    place = np.arange(int(ends[-1])) + np.repeat((ORDER - 1) + ORDER * np.arange(rows), np.diff(ends))
    padded[place] = symbols[keep]
    codes = padded[: len(padded) - ORDER] << np.uint32(BITS * (ORDER - 1)) if len(padded) > ORDER else np.zeros(0, np.uint32)
    for k in range(1, ORDER):
        codes |= padded[k : k + len(codes)] << np.uint32(BITS * (ORDER - 1 - k))
    starts = ends[:-1] + ORDER * np.arange(rows)
    wanted = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        wanted[starts[1:] - 1 - k] = False  # windows over the gap between rows
    lengths = np.diff(ends) + 1
    return codes[wanted], np.concatenate([[0], np.cumsum(lengths)])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.uint32)
        for row, data, offsets in text_parts(batch.column("text"), PART):
            codes, at = symbol_codes(data, offsets)
            classed = codes << np.uint32(1) | np.repeat(toxic[row : row + len(at) - 1], np.diff(at))
            found, n = np.unique(classed, return_counts=True)
            is_toxic = (found & 1).astype(bool)
            columns = [found >> 1, np.where(is_toxic, n, 0), np.where(is_toxic, 0, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["code", "toxic", "ordinary"])


def _evidence(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, data, offsets in text_parts(batch.column("text"), PART):
                codes, at = symbol_codes(data, offsets)
                ends = np.flatnonzero((codes & np.uint32((1 << BITS) - 1)) == 0)  # every row ends with one
                words = np.add.reduceat(ratios[codes].astype(np.int32), np.concatenate([[0], ends[:-1] + 1])) * STEP
                excess = np.concatenate([[0.0], np.cumsum(np.maximum(words - MARGIN, 0))])
                sums = np.diff(excess[np.searchsorted(ends, at)])
                out[row : row + len(at) - 1] = sums / np.diff(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "evidence"])

    return run


def log_ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(code, ratio) for the counted 5-grams and (context, ratio) for their contexts' other symbols."""
    below = lambda order: (1 << (BITS * order)) - 1
    # continuation counts: how many different symbols stand before an n-gram
    grams = {ORDER: counts.select("code", (F.col("toxic") + F.col("ordinary")).alias("n"))}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("code").bitwiseAND(F.lit(below(order))).alias("code")
        grams[order] = grams[order + 1].groupBy(shorter).agg(F.count("*").alias("n"))
    model = _unigrams(grams[1])
    for order in range(2, ORDER + 1):
        context = F.shiftright("code", BITS).alias("context")
        sums = grams[order].groupBy(context).agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        shorter = F.col("code").bitwiseAND(F.lit(below(order - 1)))
        rows = grams[order].withColumn("context", F.shiftright("code", BITS)).withColumn("shorter", shorter).join(sums, "context")
        rows = rows.join(model.select(F.col("code").alias("shorter"), F.col("p").alias("p_shorter")), "shorter")
        p = (F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("p_shorter")) / F.col("all")
        model = rows.select("code", p.alias("p"))
    rows = counts.join(model, "code").withColumn("context", F.shiftright("code", BITS))
    sums = rows.groupBy("context").agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("toxic", "ordinary")], *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in ("toxic", "ordinary")]
    )
    rest = lambda c: F.when(F.col(f"all_{c}") > 0, DISCOUNT * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0)
    own = lambda c: F.when(F.col(c) > 0, (F.col(c) - DISCOUNT) / F.col(f"all_{c}")).otherwise(0.0)
    p_of = lambda c: own(c) + rest(c) * F.col("p")
    ratios = rows.join(sums, "context").select("code", F.log(p_of("toxic") / p_of("ordinary")).alias("ratio"))
    return ratios, sums.select("context", F.log(rest("toxic") / rest("ordinary")).alias("ratio"))


def _unigrams(grams: DataFrame) -> DataFrame:
    """Symbol probabilities by continuation counts, a part for every symbol: at most 32 rows."""
    rows = {r["code"]: r["n"] for r in grams.collect()}
    total = sum(rows.values())
    values = [(code, (max(rows.get(code, 0) - DISCOUNT, 0) + DISCOUNT * len(rows) / (1 << BITS)) / max(total, 1)) for code in range(1 << BITS)]
    return F.broadcast(grams.sparkSession.createDataFrame(values, "code long, p double"))


def _packed(ratios: DataFrame, contexts: DataFrame) -> np.ndarray:
    """One byte for each possible 5-gram."""
    whole = lambda x: np.clip(np.rint(np.asarray(x) / STEP), -127, 127).astype(np.int8)
    out = np.zeros((CODES >> BITS, 1 << BITS), np.int8)
    table = contexts.toArrow()  # at most 2**20 rows
    out[table.column("context").to_numpy()] = whole(table.column("ratio").to_numpy())[:, None]
    table = ratios.toArrow()  # at most 2**25 rows; as many as there are different 5-grams
    out.reshape(-1)[table.column("code").to_numpy()] = whole(table.column("ratio").to_numpy())
    return out.reshape(-1)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a slight penalty on the slope."""
    if not (weight[toxic == 1].sum() and weight[toxic == 0].sum()):
        return 500.0, -2.0
    scale = 0.01
    x = np.stack([evidence / scale, np.ones_like(evidence)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + np.array([1e-2 * beta[0], 0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    `docs` holds doc_id and text, `labels` doc_id and toxic; more columns are ignored, and only the text makes a score.
    Rows of the fold 0 (crc32 of doc_id modulo 5) are held out from all learning, fold 1 fits the curve, the others are
    counted. NULL and empty texts are one separator and have a score too; a NULL doc_id is not labelled and not held
    out; a doc_id labelled both ways counts as toxic. Without labels of both classes a curve set beforehand is used. Empty input gives no
    rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic")).filter(fold != HELD_OUT)
    known = stored(known.withColumn("counted", fold != CALIBRATION), "labels")
    if known.count() <= BROADCAST_LABELS:  # else both sides are shuffled
        known = F.broadcast(known)
    counted = texts.join(known.filter("counted"), "doc_id").select("text", "toxic")
    counts = counted.mapInArrow(_counts, "code long, toxic long, ordinary long").groupBy("code")
    counts = stored(counts.agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "five-grams")
    model = spark.sparkContext.broadcast(_packed(*log_ratios(counts)))
    evidence = stored(texts.mapInArrow(_evidence(model), "doc_id long, evidence double"), "evidence")
    place = F.round(F.least(F.lit(5.0), F.col("evidence")) / EVIDENCE_STEP).alias("place")
    seen = evidence.join(known.filter("not counted"), "doc_id").groupBy(place, "toxic").agg(F.count("*").alias("n")).collect()
    slope, intercept = fit_curve(
        np.array([r["place"] for r in seen]) * EVIDENCE_STEP, np.array([r["toxic"] for r in seen]), np.array([float(r["n"]) for r in seen])
    )
    score = 1 / (1 + F.exp(-(F.col("evidence") * slope + intercept)))
    rows = evidence.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
