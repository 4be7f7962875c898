"""One query for each operator, over its whole tables with production parameters, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, minhash, neighbours, pieces, repeats, secrets, toxicity, urls, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the url query.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A conversation that the chat query adds: its texts hold control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), secrets.trained(spark)))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.Model.load())


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(words=3, percent=85))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(f"select -7L conv_id, turn, role, '{CONTROL_TEXT}' text from values (0L, 'user'), (1L, 'assistant') t(turn, role)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(rows.unionByName(extra)))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_warc, op2_neighbours, op3_repeats, op4_secrets, op5_pieces, op6_urls, op7_minhash, op8_toxicity, op9_chat,
    op10_decontaminate)}

_HOST = r"translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')"
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_MARKED = r"regexp_replace({}, '(\\|</s>|<s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|turn\|>|<\|text\|>|<\|also\|>)', 'x\1', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        with p as (select page_id, strlen(coalesce(html, '')) n, sha256(coalesce(html, '')) d from pages),
             q as (select *, case when n >= 100 then min(page_id) over (partition by d) end f from p)
        select page_id, n as payload_bytes, d as payload_digest,
               case when f <> page_id then 'revisit' else 'response' end as record_type,
               case when f <> page_id then f end as refers_to from q""",
    "op6_urls": f"""
        with u as (select page_id, {_HOST} as host, {_PATH} as path from pages),
             r(h, p, v) as (values {_RULES}),
             m as (select page_id, host, path, h || p as rule, v from u, r
                   where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)),
             b as (select page_id, max_by(rule, length(rule)) as rule, max_by(v, length(rule)) as v from m group by page_id)
        select u.page_id, u.host, u.path, b.rule, coalesce(b.v, 'allow') as verdict from u left join b using (page_id)""",
    "op9_chat": f"""
        with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all values (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
             w as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before from c)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length({_MARKED.format('text')}) + case when before = role then length('<|also|>')
                   else length('<|turn|><|text|></s>') + length({_MARKED.format('role')}) end)::bigint as formatted_chars
        from w group by conv_id""",
}
