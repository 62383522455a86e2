"""The registered queries of the operators in this folder, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.decontamination import contaminated
from tidewatch.llm.equal_average import vector_codes
from tidewatch.llm.jaccard_join import jaccard_components
from tidewatch.llm.language import fit, held_out, identify, learnable
from tidewatch.llm.line_frequency import quality_rules
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.sharding import shard_rows
from tidewatch.llm.style_tree import extract_text
from tidewatch.llm.token_files import token_output
from tidewatch.llm.url_filters import Rule, judge_urls, url_host, url_path
from tidewatch.llm.vantage_trees import simhash_components
from tidewatch.llm.warc import warc_round_trip
from tidewatch.llm.whitening import whitened

RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]

#: Hosts whose pages the key list of op9 holds.
UNWANTED = r"(^|[.-])(ads|adult|bets|casino|pills|porn|spam)([.-]|$)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_output(spark: SparkSession, sf: str) -> DataFrame:
    return token_output(table(spark, sf, "documents"), vocabulary(), end_id=2, special_tokens=True)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    texts = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(texts, fit(learnable(docs))).drop("text")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc_round_trip(table(spark, sf, "pages"))


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(table(spark, sf, "documents"), n=3, percent=90)


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages").select("page_id", "url", "html"))


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return pack_documents(docs, vocabulary(), capacity=2048, end_id=0, special_tokens=True)


def op9_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Rules, then a key list: host and path of the pages whose host has a word for spam or advertising in a label."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    host = url_host(F.col("url"))
    listed = pages.where(host.rlike(UNWANTED)).select(F.concat(host, url_path(F.col("url"))).alias("key"))
    return judge_urls(pages, RULES, listed.distinct(), by_path=True).drop("url")


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return shard_rows(docs, 16).withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


def op11_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(table(spark, sf, "documents"), n=4, limit=4)


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes(table(spark, sf, "embeddings"), parts=16, entries=64, rounds=2)


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """A deviation that doesn't fit a long, from some 40 million rows on, is null here."""
    rows = whitened(table(spark, sf, "embeddings"), components=32)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


REGISTERED = {
    "op1_token_output": op1_token_output,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_html_extraction": op7_html_extraction,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_filters": op9_url_filters,
    "op10_sharding": op10_sharding,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_embedding_whitening": op13_embedding_whitening,
}

HOST = (
    "translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP9 = f"""
with parts as (
    select page_id, {HOST} as host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), rules(rule_host, rule_path, rule_verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits as (
    select distinct host, path, rule_host || rule_path as rule, rule_verdict
    from parts join rules
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
), best as (
    select host, path, rule, rule_verdict
    from fits qualify row_number() over (partition by host, path order by length(rule) desc) = 1
)
select page_id, p.host, p.path, rule,
       coalesce(rule_verdict, case when regexp_matches(p.host, '{UNWANTED}') then 'block' else 'allow' end) as verdict
from parts p left join best b on p.host = b.host and p.path = b.path
"""



def _op12() -> str:
    """Rounds written out; each takes every distance, so that nothing depends on the search."""

    def assigned(k: int) -> str:
        return f"""
distances{k} as (
    select rid, c.p, e, sum((x - y) * (x - y)) as d
    from cells c join books{k} b on c.p = b.p and c.j = b.j group by rid, c.p, e
), nearest{k} as (
    select rid, p, e, d from distances{k}
    qualify row_number() over (partition by rid, p order by d, e) = 1
)"""

    def moved(k: int) -> str:
        return f"""
means{k} as (
    select c.p, e, j, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as y
    from cells c join nearest{k} n on c.rid = n.rid and c.p = n.p group by c.p, e, j
), books{k + 1} as (
    select b.p, b.e, b.j, coalesce(m.y, b.y) as y
    from books{k} b left join means{k} m on b.p = m.p and b.e = m.e and b.j = m.j
)"""

    return f"""
with kept as (
    select vec_id, label, embedding, row_number() over (order by vec_id nulls last, embedding) as rid
    from embeddings
    where len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), cells as (
    select rid, cast(k // (len(embedding) // 16) as bigint) as p, cast(k % (len(embedding) // 16) as bigint) as j,
           cast(floor(256 * cast(embedding[k + 1] as double)) as bigint) as x
    from (select rid, embedding, unnest(range(len(embedding))) as k from kept)
), books0 as (
    select p, rid - 1 as e, j, x as y from cells where rid <= 64
), {assigned(0)}, {moved(0)}, {assigned(1)}, {moved(1)}, {assigned(2)}, digest as (
    select sha256(string_agg(cast(y as varchar), ',' order by p, e, j)) as codebooks_sha256 from books2
), coded as (
    select rid, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error
    from nearest2 group by rid
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (rid) cross join digest
"""


ORACLE = {"op9_url_filters": OP9, "op12_vector_codes": _op12()}
