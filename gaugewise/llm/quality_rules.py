"""Quality rules as a learned decision list, with DataFrame functions only.

Texts are reduced to statistics. Sequential covering then learns from labelled rows which of them mark bad texts: a rule
is grown one threshold at a time by information gain on two thirds of the rows, cut back to the prefix that does best
on the rest, and kept if it is precise there; its rows are set aside and the next rule is learned. The list becomes one
ordered conditional expression. All counts are group-bys over every labelled row; the driver sees only bin counts, a
number set by the statistics and the bins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewise.llm.storage import stored

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEATURES = ("symbol_share", "repeat_share", "dup_line_share", "upper_share", "mark_share", "mean_word", "words")
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
LEAST_PRECISION = 0.95
LEAST_ROWS = 3


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def expression(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def rule_expression(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c.expression(), F.lit(False)) for c in rule])


def decision(rules: list[Rule]) -> Column:
    """True where no rule rejects: `CASE WHEN rule 1 THEN false WHEN rule 2 THEN false ... ELSE true END`."""
    if not rules:
        return F.lit(True)
    out = F.when(rule_expression(rules[0]), F.lit(False))
    for rule in rules[1:]:
        out = out.when(rule_expression(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and verdict, and the rules' statistics of each whole text (NULL: no words)."""
    rows = docs.select("doc_id", _text(F.col("text")).alias("t"))
    rows = rows.select("doc_id", "t", F.array_remove(F.split("t", WHITE), "").alias("w"))
    windows = F.when(F.size("w") >= WINDOW, F.sequence(F.lit(1), F.size("w") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    rows = rows.select("doc_id", "t", "w", windows.alias("at"))
    rows = rows.select("doc_id", "t", "w", "at", F.transform("at", lambda i: F.xxhash64(F.slice("w", i, WINDOW))).alias("h"))
    # only texts with a repeated window hash compare the windows' words
    some = F.size(F.array_distinct("h")) < F.size("h")
    said = F.transform("at", lambda i: F.struct(F.concat_ws(" ", F.slice("w", i, WINDOW)).alias("s"), i.alias("i")))
    rows = rows.select("doc_id", "t", "w", F.when(some, F.array_sort(said)).alias("s"))
    twice = F.filter(
        "s", lambda x, k: (x["s"] == F.get(F.col("s"), k - 1)["s"]) | (x["s"] == F.get(F.col("s"), k + 1)["s"])
    )
    rows = rows.select("doc_id", "t", "w", F.array_sort(F.transform(twice, lambda x: x["i"])).alias("r"))
    covered = F.transform("r", lambda p, k: F.least(F.lit(WINDOW), F.get(F.col("r"), k + 1) - p))
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("doc_id", "t", F.size("w").alias("n_words"), F.array_join("w", "").alias("solid"), n_repeat.alias("n_repeat_words"), lines.alias("lines"))
    counts = rows.select(
        "doc_id",
        F.xxhash64("t").alias("text_hash"),
        F.col("n_words").cast("long").alias("n_words"),
        F.char_length("solid").cast("long").alias("word_chars"),
        (F.char_length("solid") - F.char_length(F.translate("solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words").cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        (F.regexp_count("solid", F.lit(r"\p{Lu}"))).alias("n_upper"),
        (F.char_length("solid") - F.char_length(F.replace("solid", F.lit("!"), F.lit("")))).alias("n_marks"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b))
    return counts.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_marks", "word_chars").alias("mark_share"),
        share("word_chars", "n_words").alias("mean_word"),
        F.col("n_words").cast("double").alias("words"),
    )


def _cuts(labelled: DataFrame) -> dict[str, list[float]]:
    """Each statistic's candidate cuts: quantiles of all rows and of the bad rows."""
    probs = [k / BINS for k in range(1, BINS)]
    marks = lambda c: F.percentile_approx(c, probs, 2000)
    wanted = [marks(F.col(f)).alias(f"{f}_all") for f in FEATURES] + [marks(F.when(F.col("bad"), F.col(f))).alias(f"{f}_bad") for f in FEATURES]
    row = labelled.agg(*wanted).first()
    return {f: sorted({*(row[f"{f}_all"] or []), *(row[f"{f}_bad"] or [])}) for f in FEATURES}


def _bin(feature: str, cuts: list[float]) -> Column:
    """The number of cuts below the value."""
    out = F.when(F.col(feature).isNull(), F.lit(None).cast("int"))
    for k, cut in enumerate(cuts):
        out = out.when(F.col(feature) <= F.lit(cut), F.lit(k))
    return out.otherwise(F.lit(len(cuts)))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Add the condition of greatest gain until no good row is covered or nothing gains."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        covered = rows.filter(rule_expression(tuple(rule))) if rule else rows
        bins = covered.select("bad", *[_bin(f, cuts[f]).alias(f) for f in FEATURES if cuts[f]])
        long = bins.unpivot(["bad"], [f for f in FEATURES if cuts[f]], "feature", "bin").filter("bin is not null")
        counts = long.groupBy("feature", "bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        best: tuple[float, float, Condition] | None = None
        for f in FEATURES:
            have = {r["bin"]: (r["p"], r["n"]) for r in counts if r["feature"] == f}
            p0, n0 = sum(p for p, _ in have.values()), sum(n for _, n in have.values())
            if not p0 or not n0:
                continue
            p = n = 0
            for k, cut in enumerate(cuts[f]):
                p, n = p + have.get(k, (0, 0))[0], n + have.get(k, (0, 0))[1]
                for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    # of equal gains the stricter cut: it leaves more room for good texts unlike those labelled
                    found = (_gain(a, b, p0, n0), cut if above else -cut, Condition(f, above, float(cut)))
                    if a and found[0] > 0 and (best is None or found[:2] > best[:2]):
                        best = found
        if best is None:
            break
        rule.append(best[2])
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix with the best (p - n) / (p + n) on rows that did not grow it, and its bad and good rows."""
    wanted = []
    for k in range(1, len(rule) + 1):
        hit = rule_expression(rule[:k])
        wanted += [F.count_if(hit & F.col("bad")).alias(f"p{k}"), F.count_if(hit & ~F.col("bad")).alias(f"n{k}")]
    row = rows.agg(*wanted).first()
    worth = lambda k: (row[f"p{k}"] - row[f"n{k}"]) / (row[f"p{k}"] + row[f"n{k}"]) if row[f"p{k}"] + row[f"n{k}"] else -1.0
    best = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
    return rule[:best], row[f"p{best}"], row[f"n{best}"]


def learn_rules(statistics: DataFrame, labels: DataFrame) -> list[Rule]:
    """An ordered list of rules that reject, from `labels` (doc_id, quality) and `text_statistics` rows.

    Rows without a label or failed by the base rules take no part; a doc_id labelled both ways counts as good. No bad or
    no good rows, or none labelled: an empty list.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.select("doc_id", (F.col("quality") == 0).alias("bad"))
    rows = statistics.filter("not base_failed").select("doc_id", *FEATURES).join(known, "doc_id")
    rows = stored(rows.withColumn("grows", F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2), "labelled-statistics")
    cuts, rules = _cuts(rows), []
    while any(cuts.values()) and len(rules) < MAX_RULES:
        left = rows.filter(decision(rules)) if rules else rows
        rule = _grow(left.filter("grows"), cuts)
        if not rule:
            break
        rule, p, n = _prune(left.filter("not grows"), rule)
        if p < LEAST_ROWS or p < LEAST_PRECISION * (p + n):
            break
        rules.append(rule)
    return rules


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    `docs` holds doc_id and text; more columns are ignored. NULL and empty texts have no words, so they fail the base
    rules. Rows that repeat a doc_id, or have none, each get a row. Empty input gives no rows; without labels the base
    rules alone decide.
    """
    statistics = stored(text_statistics(docs), "statistics")
    rules = learn_rules(statistics, labels)
    return statistics.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & decision(rules)).alias("kept"),
    )


def without_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows that `quality_verdicts` rejects; all columns as they are.

    Verdicts meet their rows by doc_id (NULL matches NULL) and the text's hash, so each row is judged by its own text.
    """
    statistics = stored(text_statistics(docs), "statistics")
    bad = statistics.filter(F.col("base_failed") | ~decision(learn_rules(statistics, labels)))
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(_text(docs["text"])) == bad["bad_hash"])
    return docs.join(bad, same, "left_anti")


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))
