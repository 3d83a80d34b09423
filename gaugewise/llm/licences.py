"""Licence notices by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of a text is looked up in the k-grams of the template texts. A hit of text position p and
template position q lies on the diagonal p - q; hits are counted by diagonal, neighbouring diagonals (a few words put
in or left out) are merged into spans, and a span whose template words are matched closely enough is a licence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugewise.llm.storage import stored

GRAM = 3
MERGE = 3  # diagonals that far apart belong to one span
LEAST_SHARE = 0.7  # of a template's k-grams, for its label

# The base phrases and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Notices in common use, as words; their labels; and the phrases that tell them from their kin, each of
# which must be matched as a whole (a phrase is at most a k-gram long).
GPL_NOTICE = "this program is free software you can redistribute it and or modify it under the terms of the {} as published by the free software foundation either version {} of the license"
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ()),
    ("mit", "released under the mit license", ("the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ()),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", ()),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies", ("without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc0", "has waived all copyright and related or neighboring rights to", ("neighboring rights",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public", "2 0")),
    ("epl-2", "made available under the terms of the eclipse public license v 2 0", ("eclipse public", "2 0")),
    ("bsl-1", "distributed under the boost software license version 1 0", ("boost software", "version 1")),
    ("all-rights-reserved", "all rights reserved", ()),
)
# Label, the licence's short and full name, and its version.
GNU = (
    ("gpl-1", "gpl", "gnu general public license", "1"),
    ("gpl-2", "gpl", "gnu general public license", "2"),
    ("gpl-3", "gpl", "gnu general public license", "3"),
    ("lgpl-2", "lgpl", "gnu library general public license", "2"),
    ("lgpl-2.1", "lgpl", "gnu lesser general public license", "2 1"),
    ("lgpl-3", "lgpl", "gnu lesser general public license", "3"),
    ("agpl-3", "agpl", "gnu affero general public license", "3"),
)
# Label, and the terms as abbreviated and as written out.
CREATIVE_COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution sharealike"),
    ("cc-by-nd", "by nd", "attribution noderivatives"),
    ("cc-by-nc", "by nc", "attribution noncommercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution noncommercial sharealike"),
    ("cc-by-nc-nd", "by nc nd", "attribution noncommercial noderivatives"),
)
CC_VERSIONS = (("4 0", "international"), ("3 0", "unported"))
# Identifiers as words, and their labels.
IDENTIFIERS = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("apache-2", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("isc", "isc"),
    ("unlicense", "unlicense"), ("cc0", "cc0 1 0"), ("mpl-2", "mpl 2 0"), ("epl-2", "epl 2 0"), ("bsl-1", "bsl 1 0"),
)


def _last(words: str, n: int) -> str:
    return " ".join(words.split()[-n:])


def _templates() -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """All notices: label, words, the phrases that must be matched. The families differ in a word, which is in a phrase."""
    out = list(NOTICES)
    spdx = "spdx license identifier "
    for label, short, full, version in GNU:
        kind = " ".join(full.split()[:3]) if "general" not in full.split()[1] else "gnu general"
        out += [
            (label, f"licensed under the {full} version {version}", (kind, f"version {version}")),
            (label, GPL_NOTICE.format(full, version), (kind, f"version {version}")),
            (label, f"licensed under the gnu {short} version {version}", (f"{short} version {version.split()[0]}", f"version {version}")),
            (label, spdx + f"{short} {version if ' ' in version else version + ' 0'}", (f"identifier {short} {version.split()[0]}",)),
        ]
    for label, short, full in CREATIVE_COMMONS:
        for version, kind in CC_VERSIONS:
            number = version.split()[0]
            terms = tuple(" ".join(p) for p in zip(full.split(), full.split()[1:], strict=False))
            must = (f"commons {full.split()[0]}", *terms, f"{_last(full, 1)} {number}")
            out += [(label, f"licensed under {article} creative commons {full} {version} {kind} license", must) for article in ("a", "the")]
            out += [(label, f"{start} cc {short} {version}", ("cc by", f"{_last(short, 2)} {number}")) for start in ("licensed under", spdx.strip())]
    out += [(label, spdx + name, (f"identifier {' '.join(name.split()[:2])}", _last(name, 2))) for label, name in IDENTIFIERS]
    return tuple(out)


TEMPLATES = _templates()

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def licence_words(text: Column) -> Column:
    """Words between ASCII signs, A-Z lower-cased; NULL has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() and translate() agree on texts of ASCII alone, and lower() is faster
    low = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _grams(spark: SparkSession) -> DataFrame:
    """Template k-grams: gram text, its hash, template number, position. Fixed texts, so a few hundred rows."""
    rows = []
    for number, (_, text, *_) in enumerate((*PHRASES, *TEMPLATES)):
        words = text.split()
        rows += [(" ".join(words[q : q + GRAM]), number, q) for q in range(len(words) - GRAM + 1)]
    grams = spark.createDataFrame(rows, "template_gram string, template int, q int")
    return grams.withColumn("gram_hash", _gram_hash(F.split("template_gram", " "), F.lit(0)))


def _needs(words: list[str], must: tuple[str, ...]) -> list[tuple[int, int]]:
    """For each phrase the first and the last k-gram that holds it."""
    out = []
    for phrase in map(str.split, must):
        at = next(k for k in range(len(words)) if words[k : k + len(phrase)] == phrase)
        out.append((max(at + len(phrase) - GRAM, 0), min(at, len(words) - GRAM)))
    return out


def _notices(spark: SparkSession) -> DataFrame:
    """template, label, size (k-grams) and needs (ranges of k-grams, one of each must be matched), a row a notice."""
    rows = []
    for number, (label, text, must) in enumerate(TEMPLATES, len(PHRASES)):
        words = text.split()
        rows.append((number, label, len(words) - GRAM + 1, _needs(words, must)))
    return spark.createDataFrame(rows, "template int, label string, size int, needs array<struct<low: int, high: int>>")


def _gram_hash(words: Column, p: Column) -> Column:
    return F.xxhash64(*[F.get(words, p + k) for k in range(GRAM)])


def licence_hits(docs: DataFrame) -> DataFrame:
    """One row per text k-gram and template position it equals, and at least one row for each text.

    Columns: row_id (a number for the input row), doc_id, n_words, p, template, q and `next`, the word after the k-gram;
    template and q are NULL in a row that only stands for its text.
    """
    words = F.col("words")
    rows = docs.select("doc_id", licence_words(F.col("text")).alias("words"))
    positions = F.sequence(F.lit(0), F.greatest(F.size(words) - GRAM, F.lit(0)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        "words",
        F.transform(positions, lambda p: _gram_hash(words, p)).alias("hashes"),
    )
    wide = rows.select("row_id", "doc_id", "n_words", "words", F.posexplode("hashes").alias("p", "gram_hash"))
    hits = wide.join(F.broadcast(_grams(docs.sparkSession)), "gram_hash", "left")
    same = F.concat_ws(" ", F.slice(words, F.col("p") + 1, GRAM)) == F.col("template_gram")
    return hits.filter(F.coalesce(same, F.lit(False)) | (F.col("p") == 0)).select(
        "row_id", "doc_id", "n_words", "p", F.when(same, F.col("template")).alias("template"), F.when(same, F.col("q")).alias("q"),
        F.get(words, F.col("p") + GRAM).alias("next"),
    )


def _numbered(values: list, column: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), column + 1)


def licence_spans(hits: DataFrame) -> DataFrame:
    """Verified spans: row_id, template, label, start, stop (words, stop exclusive), n (k-grams matched), share of the template's.

    A span's hits are neighbouring diagonals of one template; a chain of diagonals is cut where it has drifted by twice
    the template's k-grams, so they are near one another in the text, however often it says the notice. Each template
    position counts once, and a span must match every phrase that tells the notice from its kin.
    """
    notices = F.broadcast(_notices(hits.sparkSession))
    votes = hits.filter(F.col("template") >= len(PHRASES)).withColumn("diagonal", F.col("p") - F.col("q"))
    voted = votes.groupBy("row_id", "template", "diagonal").agg(
        F.min("p").alias("first_p"), F.max("p").alias("last_p"), F.collect_set("q").alias("matched")
    )
    order = Window.partitionBy("row_id", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > MERGE).cast("int")
    chained = voted.withColumn("chain", F.sum(F.coalesce(apart, F.lit(0))).over(order)).join(notices, "template")
    drift = F.col("diagonal") - F.min("diagonal").over(Window.partitionBy("row_id", "template", "chain"))
    spans = chained.withColumn("part", F.floor(drift / (2 * F.col("size")))).groupBy("row_id", "template", "chain", "part")
    spans = spans.agg(
        F.first("label").alias("label"), F.first("size").alias("size"), F.first("needs").alias("needs"),
        F.min("first_p").alias("start"), (F.max("last_p") + GRAM).alias("stop"),
        F.array_distinct(F.flatten(F.collect_list("matched"))).alias("matched"),
    )
    said = F.forall("needs", lambda x: F.exists("matched", lambda q: (q >= x["low"]) & (q <= x["high"])))
    spans = spans.filter((F.size("matched") / F.col("size") >= LEAST_SHARE) & said)
    return spans.select(
        "row_id", "template", "label", "start", "stop", F.size("matched").alias("n"), (F.size("matched") / F.col("size")).alias("share")
    )


def _best(spans: DataFrame) -> DataFrame:
    """Spans that no better one overlaps: notices of one family differ in a word. Ties go to the longer notice, then to
    the smaller template number. A span's length is bounded by its template's, so only the spans near it are met.
    """
    reach = 4 * max(len(text.split()) for _, text, _ in TEMPLATES)
    near = Window.partitionBy("row_id").orderBy("start").rangeBetween(-reach, reach)
    spans = spans.withColumn("rank", F.struct("share", "n", -F.col("template")))
    met = spans.withColumn("near", F.collect_set(F.struct("start", "stop", "rank")).over(near))
    beaten = F.exists("near", lambda y: (y["start"] < F.col("stop")) & (F.col("start") < y["stop"]) & (y["rank"] > F.col("rank")))
    return met.filter(~beaten).select("row_id", "label", "share")


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    `docs` holds doc_id and text; more columns are ignored. NULL and empty texts have no words and no labels ('' and
    score 0). The score is 1 with a base phrase, else the greatest matched share of a template (0 if no span holds).
    Rows that repeat a doc_id each get a row. Empty input gives no rows.
    """
    hits = stored(licence_hits(docs), "licence-hits")
    # phrases longer than a k-gram are settled by the word that follows; none is longer than one word more
    tail = _numbered([(t.split()[GRAM] if len(t.split()) > GRAM else None) for _, t in PHRASES], F.least(F.col("template"), F.lit(len(PHRASES) - 1)))
    base = (F.col("template") < len(PHRASES)) & (F.col("q") == 0) & (tail.isNull() | (F.col("next") == tail))
    label = _numbered([k for k, _ in PHRASES], F.least(F.col("template"), F.lit(len(PHRASES) - 1)))
    rows = hits.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("p"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("p"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, label)).alias("base"),
    )
    spans = _best(licence_spans(hits)).groupBy("row_id").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    out = rows.join(spans, "row_id", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
