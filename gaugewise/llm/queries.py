"""The operators' queries over the driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewise.llm.html_text import extract_main_text
from gaugewise.llm.lexical_search import ranked_search
from gaugewise.llm.licences import scan_licences
from gaugewise.llm.line_dedup import without_repeated_passages
from gaugewise.llm.mixing import mix_report
from gaugewise.llm.near_dedup import near_duplicates
from gaugewise.llm.packing import pack_documents
from gaugewise.llm.personal_data import find_personal_data
from gaugewise.llm.phrases import collocations
from gaugewise.llm.quality_rules import quality_verdicts
from gaugewise.llm.repeated_strings import without_repeated_strings
from gaugewise.llm.shipping import ship_package
from gaugewise.llm.top_k import nearest
from gaugewise.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_license_scans")
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


@query("op1_source_mixing")
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of `docs` in the vocabulary of the driver's tokenizers, which are installed on every machine."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("ids")


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_passages(docs, counts=True)


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query("op5_exact_topk")
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query("op11_repeated_strings")
def op11_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), digest)


@query("op12_lexical_search")
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_collocations")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op5_exact_topk"] = """
with v as (
    select vec_id, [floor(256 * x::double) for x in embedding] as e from embeddings
    where vec_id is not null and embedding is not null and not list_contains([x is null or not isfinite(x) for x in embedding], true)
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scored qualify rank <= 5
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES["op12_lexical_search"] = f"""
with d as (
    select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as terms
    from documents
), held as (
    select * from d where len(terms) > 0
), totals as (
    select count(*)::bigint as docs, sum(len(terms))::bigint as words from held
), tf as (
    select row, doc_id, n, term, count(*)::bigint as tf
    from (select row, doc_id, len(terms)::bigint as n, unnest(terms) as term from held) group by all
), df as (
    select term, count(*)::bigint as df from tf group by term
), asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) as term from benchmark
), scores as (
    select item_id, row, doc_id, sum(
        floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint
        * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::bigint as score
    from asked join tf using (term) join df using (term), totals group by all
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::integer as rank, doc_id, score
from scores where score > 0 qualify rank <= 10
"""

ORACLES["op13_collocations"] = f"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), w as (
    select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from pieces
), grams as (
    select lang, words[i : i + size - 1] as gram
    from (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i from w, (values (1), (2), (3), (4)) as s (size) where len(words) >= size)
), f as (
    select lang, gram, count(*)::bigint as f from grams group by all having count(*) >= 30
), cut as (
    select c.lang, c.gram, c.f as a, k, x.f as l, y.f as r, ((2000000::hugeint * c.f) // (x.f + y.f))::bigint as score
    from (select *, unnest(range(1, len(gram))) as k from f where len(gram) > 1) c
    join f x on x.lang = c.lang and x.gram = c.gram[1 : k] join f y on y.lang = c.lang and y.gram = c.gram[k + 1 : len(c.gram)]
), lowest as (
    select * from cut qualify row_number() over (partition by lang, gram order by score, k) = 1
), around as (
    select lang, gram[i : i + size - 1] as gram, max(f)::bigint as around
    from (select lang, gram, f, size, unnest(range(1, len(gram) - size + 2)) as i from f, (values (2), (3)) as s (size) where len(gram) > size)
    group by all
), n as (
    select lang, sum(len(words))::bigint as n from w group by lang
)
select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(gram, ' '))::bigint as rank,
    array_to_string(gram, ' ') as phrase, a, l, r, n, score
from lowest left join around using (lang, gram) join n using (lang)
where around is null or 100::hugeint * around < 80::hugeint * a qualify rank <= 2000
"""
