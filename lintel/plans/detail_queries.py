"""Operators of single rows and small reports that the other modules do not reach: forms, lookups, labels, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields, text as tx
from ..operators import corrections as corr
from ..operators import dedupe, ingest, matching, quality, serve, snapshots, summaries
from ..sources import pages
from .common import table
from .summary_queries import AS_OF, buildings, listings

KEY = "c_custkey"


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are ids of buildings, of summaries, of both, of none, and no numbers at all."""
    c = table(spark, sf_dir, "customer")
    k = F.col(KEY)
    keys = c.select(F.when(k % 5 == 0, F.concat(F.lit("s"), k.cast("string"))).when(k % 5 == 1, F.concat(F.lit("0"), k.cast("string"))).otherwise(k.cast("string"))
        .alias("key"))
    known = c.where("c_custkey % 3 = 0").select(k.cast("long").alias("id"), F.col("c_name").alias("name"))
    rows = c.where("c_custkey % 2 = 0").select(F.when(k % 5 == 0, F.concat(F.lit("s"), k.cast("string"))).otherwise(k.cast("string")).alias("building_key"),
        F.col("c_mktsegment").alias("name"))
    found = serve.lookup(keys, known, rows)
    return found.select("key", "source", F.coalesce("building.name", "summary.name").alias("name"))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col(KEY)
    return c.select(
        k.cast("string").alias("building_key"), F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("name"),
            F.when(k % 3 > 0, F.concat(F.lit("A "), k.cast("string"))).alias("address"),
        (k % 5).alias("vacancy_count"), F.when(k % 6 > 0, k * 10).alias("rent_yen_min"), F.when(k % 2 == 0, "2001-01-02").otherwise("").alias("last_updated"),
            F.lit("1999-09-09").alias("updated_at"),
        F.when(k % 7 > 0, F.array(F.lit("1K"), F.col("c_mktsegment"))).alias("layout_types"),
            F.when(k % 8 == 0, '["2DK"]').when(k % 8 == 1, "x").alias("sale_layout_types_json"),
        F.when(k % 9 == 0, "RC").alias("building_structure"), F.when(k % 2 == 1, "S").alias("structure"), F.when(k % 10 == 0, 7).alias("derived_built_age_years"),
            (k % 40).alias("age_years"), F.when(k % 11 > 0, "chintai").otherwise("").alias("property_kind"),
    )


def payload_v2min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.contract_payload(_published(spark, sf_dir), "v2min")


def payload_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.contract_payload(_published(spark, sf_dir), "legacy")


def correction_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correction of the incomplete address waits unless it is allowed."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    c = s.select(k.alias("row_no"), F.lit("fix").alias("action"), F.lit("approved").alias("status"),
        F.when(k % 3 == 0, "building_name").otherwise("address").alias("field"), F.lit("new").alias("new_value"), F.lit("address_incomplete").alias("error_type"),
        F.when(k % 2 == 0, "枝番未確認").otherwise("").alias("note"), F.when(k % 5 > 0, "CITRUS TREE").otherwise(F.col("s_name")).alias("target_building_name"))
    return c.select("row_no", corr.hold_reason().alias("held"), corr.hold_reason(True).alias("allowed"))


def listed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 9 > 0, F.col("o_custkey").cast("string")).otherwise("").alias("building_key"))
    return snapshots.listed_counts(o, table(spark, sf_dir, "customer").where("c_custkey % 4 > 0").select(F.col(KEY).cast("string").alias("building_id")))


def seeded_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo rows where a table is empty, the table itself where it is not."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    demo = spark.range(1).select(F.lit("demo").alias("n_name"), F.lit(-1).cast(n.schema["n_nationkey"].dataType).alias("n_nationkey"))
    return serve.seeded(n, demo).unionByName(serve.seeded(n.where("n_nationkey < 0"), demo))


def display_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the page shows of a building: label, age, link to a map, file of its evidence."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(
        "p_partkey", F.when(k % 5 == 0, "入居").when(k % 5 == 1, "即入居").when(k % 5 == 2, "").when(k % 5 == 3, "3/1").alias("label"),
            F.when(k % 4 == 0, "bunjo").otherwise("chintai").alias("kind"),
        F.when(k % 6 > 1, F.concat((1990 + k % 15).cast("string"), F.lit("-0"), (1 + k % 9).cast("string"))).when(k % 6 == 1, "x").alias("building_built_year_month"),
            F.when(k % 7 > 0, F.col("p_size")).alias("building_built_age_years"),
        F.when(k % 8 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("place"),
            F.when(k % 3 == 0, F.concat(F.lit("pdf:f"), k.cast("string"), F.lit("#p=1"))).when(k % 3 == 1, "web:x").alias("evidence"),
    )
    aged = serve.guarded_age(rows, F.lit("2005-03-01").cast("date"))
    return aged.select("p_partkey", serve.display_label(F.col("label"), F.col("kind")).alias("label"), F.col("building_built_age_years").alias("age"),
        fields.maps_url(F.col("place")).alias("map"), fields.evidence_file(F.col("evidence")).alias("file"))


def summary_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of buildings without listings: all values are the building's own, labels are blank."""
    own = buildings(spark, sf_dir)
    s = summaries.building_summaries(listings(spark, sf_dir).where("id < 0"), own, F.lit(AS_OF).cast("date"))
    return s.select("building_key", "name", "rent_yen_min", "rent_yen_max", "structure", "building_structure", F.col("building_built_year_month").alias("built"),
        "building_built_age_years", "age_years", "building_availability_label", "vacancy_count")


def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ambiguous group stops all merges: listings before and after are the same, and the answer says so."""
    p = table(spark, sf_dir, "part")
    b = p.select(F.format_string("%09d", "p_partkey").alias("building_id"), F.col("p_name").alias("canonical_name"),
        F.concat_ws("/", "p_name", (F.col("p_size") % 3).cast("string")).alias("canonical_address"), F.lit("").alias("norm_name"), F.lit("").alias("norm_address"),
        F.lit("2000").alias("created_at"))
    counts = p.select(F.format_string("%09d", "p_partkey").alias("building_id"), F.lit(1).cast("long").alias("n_listings"))
    rows = table(spark, sf_dir, "lineitem").select(F.format_string("%09d", "l_partkey").alias("building_key"))
    left, moved, _, done = dedupe.apply_merges(dedupe.merge_plan(b, counts), b, rows, spark.createDataFrame([], "alias_key string, canonical_key string"))
    n = moved.groupBy("building_key").agg(F.count(F.lit(1)).alias("n"))
    return n.join(left.select(F.col("building_id").alias("building_key")), "building_key").select("building_key", "n", F.lit(done).alias("applied"))


def _runs_of_letters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Buildings and rows whose names and places are runs of one letter, so that likeness follows from lengths."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")

    def run(letter, size):
        return F.repeat(F.char(97 + letter), size.cast("int"))

    b = s.select(k.cast("string").alias("building_id"), run(k % 20, 3 + k % 9).alias("norm_name"), run(k % 3, 4 + k % 5).alias("norm_address"))
    rows = s.select(k.alias("row_no"), run(k % 23, 3 + k % 11).alias("norm_name"), run(k % 3, 4 + k % 7).alias("norm_address"))
    return b, rows


def close_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, rows = _runs_of_letters(spark, sf_dir)
    return matching.close_conflicts(rows, b)


def _addressed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Several buildings at an address, named by runs of letters; rows that spell addresses in several ways."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    place = F.concat(F.lit("北九州市小倉北区町"), F.floor(k / 12).cast("string"), F.lit("丁"), (1 + k % 4).cast("string"), F.lit("-"), (1 + F.floor(k / 4) % 2).cast("string"))

    def name(letter, size):
        return F.repeat(F.char(97 + letter), size.cast("int"))

    b = s.select(k.cast("string").alias("building_id"), name(k % 3, 5 + F.floor(k / 3) % 4).alias("norm_name"), place.alias("norm_address"))
    rows = s.select(
        k.alias("row_no"), F.when(k % 5 == 0, "zzzz").otherwise(name(k % 3, 5 + F.floor(k / 3) % 4 + F.when(k % 10 == 1, 1).otherwise(0))).alias("norm_name"),
        F.when(k % 7 == 1, F.concat(place, F.lit("、9"))).when(k % 7 == 2, F.regexp_replace(place, r"(\d)-(\d)$", "$1$2")).when(k % 7 == 3, F.lit("北九州市町"))
            .when(k % 7 == 4, F.lit("別市1-2-3")).otherwise(place).alias("norm_address"),
    )
    return b, rows


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, rows = _addressed(spark, sf_dir)
    sources = b.where("cast(building_id as int) % 10 = 6").select("building_id", "norm_name", "norm_address")
    return matching.match_rows(rows, b, sources)


def match_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _matched(spark, sf_dir)
    return m.select("row_no", "building_id", "reason", F.array_join("candidate_ids", "|").alias("candidate_ids"),
        F.round(F.aggregate("candidate_scores", F.lit(0.0), lambda s, x: s + x), 4).alias("scores"), "matched_variant")


def facts_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alias map is asked for unmatched rows and rows without digits only."""
    m = _matched(spark, sf_dir)
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    names = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("k"), k.cast("string")).alias("alias_key"), F.concat(F.lit("c"), k.cast("string")).alias("canonical_key"))
    out = matching.facts_match(m, s.select(k.alias("row_no"), F.concat(F.lit("k"), k.cast("string")).alias("alias_key")), names)
    return out.select("row_no", "building_id", "reason", "bucket")


def _listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of one building a nation, at three addresses each; names of one repeated sign have nothing in common."""
    s = table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = F.repeat(F.substring(F.lit("東西南北春夏秋冬山川海空月星花鳥風雪雨雲石竹松梅桜"), n + 1, F.lit(1)), 5)
    return s.select(
        k.alias("row_no"), F.when(k % 29 == 0, "seed").otherwise("ulucks").alias("category"), F.when(k % 13 == 0, "").otherwise(name).alias("building_name"),
        F.when(k % 13 == 0, "").when(k % 11 == 0, "小倉北区")
            .otherwise(F.concat(F.lit("北九州市小倉北区"), n.cast("string"), F.lit("町"), F.lit("1丁目-"), (1 + k % 3).cast("string"), F.lit("-5"))).alias("address"),
            F.concat(F.lit("e"), k.cast("string")).alias("evidence_id"),
    )


def _outcome(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = spark.createDataFrame([], "building_id string, norm_name string, norm_address string")
    a = spark.createDataFrame([], "alias_key string, canonical_key string")
    rows = ingest.kept(ingest.incoming(_listing_rows(spark, sf_dir)))
    return ingest.ingest(rows, b, b.select("building_id", "norm_name"), a, written=True), rows


def ingest_fixpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome(spark, sf_dir)[0].select("row_no", "building_id", "route", "reason")


def review_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.counters(_outcome(spark, sf_dir)[0])


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, rows = _outcome(spark, sf_dir)
    return ingest.review(out, rows, "weekly")


def renormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    b = s.select(k.alias("building_id"), F.when(k % 3 == 0, "").otherwise(F.concat("s_name", F.lit(" ＡＢ館 101号室"))).alias("canonical_name"),
        F.concat(F.lit("福岡県北九州市小倉北区 町"), (k % 9).cast("string"), F.lit("丁目二十"), (1 + k % 8).cast("string"), F.lit("番５号")).alias("canonical_address"),
        F.lit("old").alias("norm_name"), F.when(k % 2 == 0, F.concat(F.lit("北九州市小倉北区町"), (k % 9).cast("string"))).otherwise("").alias("norm_address"))
    return corr.renormalized(b).select("building_id", "norm_name", "norm_address", "renewed")


_NAMES = (
    "<article class='property-card'><h2>棟{0} 101号室</h2><a href='/mansion/{0}'>館{0}</a><a href='/mansion/{0}'>詳細</a>"
    '<dl><dt>賃料</dt><dd>{0}5万円</dd><dt>面積</dt><dd>2{0}.5㎡</dd></dl><div>間取り： 1K</div></article>'
    '<script>var d = {"list": [{"name": "庭{0}", "price": {0}}, {"name": "賃貸{0}"}],'
    ' "address": "町{0}", "pad": "------------------------------------------------------------"};</script>'
)


def _named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made of a head and one card each; their digit tells them apart."""
    p = table(spark, sf_dir, "pages")
    d = (F.col("page_id") % 10).cast("string")
    body = F.concat(F.lit("<html><head><title>館{0}｜x</title></head><body>"), F.lit(_NAMES), F.lit("</body></html>"))
    return pages.page_rows(p.select("page_id", F.replace(body, F.lit("{0}"), d).alias("html")))


def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.candidate_names(_named_pages(spark, sf_dir)).select("page_id", F.array_join("names", "|").alias("names"))


def page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_pages(spark, sf_dir).where("kind = 'json'").select("page_id", "row", "key", "value")


def page_card_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = pages.card_facts(_named_pages(spark, sf_dir))
    return f.select("page_id", "price_min", "price_max", "price_avg", "area_min", "area_max", F.array_join("layouts", "|").alias("layouts"))


def page_cards_of_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://site.example/mansion/"),
        (F.col("page_id") % 10 + F.when(F.col("page_id") % 4 == 0, 10).otherwise(0)).cast("string")).alias("url"))
    return pages.cards_of_urls(_named_pages(spark, sf_dir), wanted, F.lit("https://site.example"))


def free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and fields that a running text mentions."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = F.concat(F.col("p_name"), F.lit(" 住所 福岡県北九州市町"), F.when(k % 5 == 0, " 即入居可").when(k % 5 == 1, " 入居時期： 4月上旬、他").when(k % 5 == 2, " 相談 空室").otherwise(""),
        F.lit(" 徒歩 "), (k % 20).cast("string"), F.lit("分"))
    found = pages.free_text_fields(text)
    none = F.lit(None).cast("string")
    name = pages.best_name(F.when(k % 4 == 0, " 棟 "), none, F.when(k % 4 == 1, "alt"), none, F.when(k % 4 == 2, text).otherwise("築10年"),
        F.concat(F.lit("https://h/"), k.cast("string")))
    return p.select("p_partkey", found["availability"].alias("availability"), found["walk"].alias("walk"), name.alias("name"))


QUERIES = {f.__name__: f for f in (
    point_lookup, payload_v2min, payload_legacy, correction_switch, listed_counts, seeded_summaries, display_fields, summary_fallback, merge_gate, close_conflict,
        match_reasons, facts_match,
    ingest_fixpoint, review_routing, review_queue, renormalized, page_names, page_json, page_card_facts, page_cards_of_urls, free_text,
)}



def _json(pairs: dict[str, str]) -> str:
    """An expression that writes an object; the values are expressions of JSON texts."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs.items()) + " || '}'"


_V2MIN = {
    "id": "'\"' || k || '\"'", "name": "case when k % 4 = 0 then 'null' else '\"' || c_name || '\"' end",
        "address": "case when k % 3 > 0 then '\"A ' || k || '\"' else 'null' end", "vacancy_count": "(k % 5)::varchar",
    "rent_min": "case when k % 6 > 0 then (k * 10)::varchar else 'null' end",
        **dict.fromkeys(("rent_max", "sale_price_min", "sale_price_max", "sale_price_avg", "area_min", "area_max", "sale_area_min", "sale_area_max"), "'null'"),
    "updated_at": "case when k % 2 = 0 then '\"2001-01-02\"' else '\"1999-09-09\"' end", "updated_epoch": "'null'",
        "property_kind": "case when k % 11 > 0 then '\"chintai\"' else 'null' end", "sale_listing_count": "'null'",
    "building_structure": "case when k % 9 = 0 then '\"RC\"' when k % 2 = 1 then '\"S\"' else 'null' end", "building_availability_label": "'null'",
        "building_built_year_month": "'null'", "building_built_age_years": "case when k % 10 = 0 then '7' else (k % 40)::varchar end",
}
_LEGACY = {
    **{k: v for k, v in list(_V2MIN.items())[:15]},
    "google_maps_url": "case when k % 3 > 0 then '\"https://maps.google.com/?q=A+' || k || '\"' else 'null' end",
        "room_types": "case when k % 7 > 0 then '[\"1K\",\"' || c_mktsegment || '\"]' else '[]' end",
    "sale_layout_types": "case when k % 8 = 0 then '[\"2DK\"]' else '[]' end", "property_kind": _V2MIN["property_kind"], "sale_listing_count": "'null'",
        "structure": "case when k % 2 = 1 then '\"S\"' else 'null' end", "built_year": "(k % 40)::varchar",
    "building_structure": _V2MIN["building_structure"], "building_built_year_month": "'null'", "building_built_age_years": _V2MIN["building_built_age_years"],
        "building_availability_label": "'null'",
}
_UUID = """
    substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-5' || substr(u, 14, 3) || '-' || substr('89ab89ab89ab89ab', 1 + strpos('0123456789abcdef', substr(u, 17, 1))::int - 1, 1) || substr(u, 18, 3) || '-' || substr(u, 21, 12)"""
_MATCH = """
    p as (select s_suppkey as k, '北九州市小倉北区町' || (s_suppkey // 12) || '丁' || (1 + s_suppkey % 4) || '-' || (1 + (s_suppkey // 4) % 2) as v, s_suppkey % 3 as c,
        5 + (s_suppkey // 3) % 4 as n from supplier),
    d as (select k as row_no, k % 7 as m, case when k % 5 = 0 then -1 else c end as c, case when k % 5 = 0 then 4 else n + (k % 10 = 1)::int end as n, v,
        case when k % 7 = 2 then regexp_replace(v, '([0-9])-([0-9])$', '\\1\\2') else v end as base from p),
    t as (select row_no, c, n, 0 as pos, base as v from d where m not in (1, 3, 4) union all select row_no, c, n, 1, v from d where m = 2),
    h as (select row_no, pos, v, p.k::varchar as id, case when t.c = p.c then 2.0::double * least(t.n, p.n) / (t.n + p.n) else 0 end as s from t
        join p using (v) qualify pos = min(pos) over (partition by row_no)),
    a as (select row_no, list(distinct p.k::varchar order by p.k::varchar) as ids from t join p on p.v = t.v and p.c = t.c and p.n = t.n where p.k % 10 = 6
        group by row_no),
    g as (select row_no, min(pos) as pos, min(v) as v, count(*) as many, list(id order by s desc, id)[1:3] as ids, list(s order by s desc, id)[1:3] as ss from h
        group by row_no),
    j as (select d.row_no, m, a.ids as al, pos, g.v, many, g.ids, ss, ss[1] * 0.7::double + 0.3::double as t1, coalesce(ss[2] * 0.7::double + 0.3::double, 0) as t2 from d
        left join a using (row_no) left join g using (row_no)),
    w as (select *, case when m = 1 then 'address_multi_or_range' when len(al) = 1 then 'alias_exact' when len(al) > 1 then 'alias_ambiguous' when m = 3
        then 'address_without_digits' when many is null then 'unmatched'
                         when many = 1 and pos = 0 then 'address_exact' when many = 1 and ss[1] >= 0.88 then 'address_variant_exact' when many = 1 then 'address_name_low_confidence'
                         when ss[1] >= 0.88 and t1 >= 0.91 and t1 - t2 >= 0.02 then case when pos = 0 then 'address_exact' else 'address_variant_match' end
                             else 'address_candidates_low_confidence' end as reason from j),
    z as (select *, case when reason = 'alias_exact' then al[1] when reason in ('address_exact', 'address_variant_exact',
        'address_variant_match') then ids[1] end as building_id,
                 reason not in ('address_multi_or_range', 'alias_exact', 'alias_ambiguous', 'address_without_digits', 'unmatched') as scored from w)"""
_INGEST = f"""
    s as (select s_suppkey as k, s_nationkey as n, s_suppkey % 13 = 0 as blank, s_suppkey % 11 = 0 as coarse, 1 + s_suppkey % 3 as lot,
        repeat(substr('東西南北春夏秋冬山川海空月星花鳥風雪雨雲石竹松梅桜', s_nationkey::int + 1, 1), 5) as name from supplier where s_suppkey % 29 > 0),
    f as (select *, '北九州市小倉北区' || n || '町1-' || lot || '-5' as place, min(case when not blank and not coarse then k end) over (partition by n) as first from s),
    q as (select f.*, o.lot as own, o.u from f left join (select n, lot, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(name || '|' || place)) as u from f
        where k = first) o using (n)),
    o as (select *, case when not blank and not coarse and lot = own then {_UUID} end as building_id,
        case when blank then 'unmatched' when coarse then 'suspect' when k = first then 'seeded' when lot = own then 'attached' else 'unmatched' end as route,
                 case when blank then 'missing_name_and_address' when coarse then 'address_without_digits' when k = first then 'unmatched' when lot = own
                     then 'alias_exact' else 'unmatched_canonical_building:close_conflicting_candidate' end as reason from q)"""
_DIGIT = "(page_id % 10)"

ORACLE_SQL = {
    "point_lookup": """
        with q as (select distinct case c_custkey % 5 when 0 then 's' || c_custkey when 1 then '0' || c_custkey else c_custkey::varchar end as key
            from customer), n as (select key, case when regexp_matches(key, '^[0-9]+$') then key::bigint end as id from q),
             b as (select c_custkey as id, c_name from customer
                 where c_custkey % 3 = 0), s as (select case when c_custkey % 5 = 0 then 's' || c_custkey else c_custkey::varchar end as key, c_mktsegment from customer
                     where c_custkey % 2 = 0)
        select n.key, case when b.id is not null then 'building' else 'summary' end as source, coalesce(c_name, c_mktsegment) as name from n left join b using (id) left
            join s on s.key = n.key where b.id is not null or s.key is not null""",
    "payload_v2min": f"select k::varchar as id, {_json(_V2MIN)} as json from (select c_custkey as k, * from customer)",
    "payload_legacy": f"select k::varchar as id, {_json(_LEGACY)} as json from (select c_custkey as k, * from customer)",
    "correction_switch": "select s_suppkey as row_no, case when s_suppkey % 5 > 0 and s_suppkey % 3 > 0 and s_suppkey % 2 = 0 then 'hold_citrus_tree_incomplete_address' end as held, null::varchar as allowed from supplier",
    "listed_counts": "select (select count(*) from customer where c_custkey % 4 > 0) as buildings, count(*) as listings, count(distinct case when o_orderkey % 9 > 0 and o_custkey % 4 > 0 and o_custkey in (select c_custkey from customer) then o_custkey end) as with_listings from orders",
    "seeded_summaries": "select n_nationkey, n_name from nation union all select -1, 'demo'",
    "display_fields": """
        with p as (select p_partkey as k, *, 1990 + p_partkey % 15 as y, 1 + p_partkey % 9 as m from part)
        select p_partkey, case when k % 4 = 0 then null when k % 5 < 2 then '即入居' when k % 5 = 3 then '3/1' end as label,
            case when k % 6 > 1 then greatest((2005 * 12 + 3 - y * 12 - m) // 12, 0) when k % 7 > 0 then p_size end::bigint as age,
               case when k % 8 > 0 then 'https://maps.google.com/?q=' || replace(p_name, ' ', '+') end as map, case when k % 3 = 0 then 'f' || k end as file from p""",
    "summary_fallback": """
        with c as (select c_custkey as k, c_name as name, c_custkey % 6 = 0 as sale, case when c_custkey % 3 = 0 then c_mktsegment end as structure,
            case when c_custkey % 10 = 0 then '1985-07' when c_custkey % 5 = 0 then (1980 + c_custkey % 20) || '-01' end as built,
                case when c_custkey % 4 = 0 then c_custkey % 30 end as stored from customer where c_custkey % 7 <> 3),
             a as (select *, coalesce(case when built is not null then greatest((2002 * 12 + 3 - substr(built, 1, 4)::int * 12 - substr(built, 6, 2)::int) // 12, 0) end,
                 stored)::bigint as age from c)
        select k::varchar as building_key, name, case when not sale then 50000 + k end as rent_yen_min, case when not sale then 50000 + k end as rent_yen_max, structure,
            structure as building_structure, built, age as building_built_age_years, age as age_years, null::varchar as building_availability_label,
                0::bigint as vacancy_count from a""",
    "merge_gate": "select printf('%09d', l_partkey) as building_key, count(*) as n, false as applied from lineitem group by 1",
    "close_conflict": """
        with s as (select s_suppkey as k from supplier), l as (
            select r.k as row_no, 0.65::double * case when r.k % 23 = b.k % 20 then 2.0::double * least(3 + r.k % 11, 3 + b.k % 9) / (6 + r.k % 11 + b.k % 9) else 0 end
                                  + 0.35::double * case when r.k % 3 = b.k % 3 then 2.0::double * least(4 + r.k % 7,
                                      4 + b.k % 5) / (8 + r.k % 7 + b.k % 5) else 0 end as score from s r, s b),
             q as (select row_no, list(score order by score desc) as t from l where score >= 0.82 group by row_no)
        select row_no from q where t[1] >= 0.9 or (len(t) > 1 and t[1] - t[2] < 0.03)""",
    "match_reasons": f"""
        with {_MATCH}
        select row_no, building_id, reason, case when starts_with(reason, 'alias_') then array_to_string(al[1:3], '|') when scored then array_to_string(ids,
            '|') else '' end as candidate_ids,
               round(case when starts_with(reason, 'alias_') then least(len(al), 3) when scored then list_sum(list_transform(ss,
                   lambda x: round(case when many = 1 then x else x * 0.7::double + 0.3::double end, 4))) else 0 end::double, 4) as scores,
               case when scored and not (many > 1 and pos = 0) then v else '' end as matched_variant from z""",
    "facts_match": f"""
        with {_MATCH}, x as (select *, coalesce(building_id, case when reason in ('unmatched',
            'address_without_digits') and row_no % 2 = 0 then 'c' || row_no end) as found from z)
        select row_no, found as building_id, reason, case when found is not null then 'attached' when reason = 'unmatched' then 'unmatched' else 'suspects' end as bucket
            from x""",
    "ingest_fixpoint": f"with {_INGEST} select k as row_no, building_id, route, reason from o",
    "review_routing": f"""
        with {_INGEST} select count(*) filter (route in ('attached', 'seeded')) as attached, count(*) filter (route = 'seeded') as auto_seeded,
            count(*) filter (starts_with(reason, 'unmatched_canonical_building:')) as auto_seed_blocked,
               count(*) filter (route = 'suspect') as suspects, count(*) filter (building_id is null) as unresolved from o""",
    "review_queue": f"""
        with {_INGEST}, b as (select *, case when blank then '' else name end as raw,
            case when blank then '' when coarse then '小倉北区' else '北九州市小倉北区' || n || '町1丁目-' || lot || '-5' end as spot,
                case when blank then '' when coarse then '小倉北区' else place end as norm from o where building_id is null),
             u as (select 'unmatched' as queue, *, case when route = 'suspect' then 'building_id_unresolved' else reason end as why from b union all
                 select 'suspects', *, reason from b where route = 'suspect')
        select queue, 'weekly' as source_kind, 'e' || k as source_id, raw as name, spot as address, raw as normalized_name, norm as normalized_address, why as reason,
            '' as candidate_building_ids, '' as candidate_scores from u""",
    "renormalized": "select s_suppkey as building_id, case when s_suppkey % 3 = 0 then 'old' else s_name || ' AB館' end as norm_name, '北九州市小倉北区町' || (s_suppkey % 9) || '-二十' || (1 + s_suppkey % 8) || '-5' as norm_address, true as renewed from supplier",
    "page_names": f"select page_id, '館' || {_DIGIT} || '|棟' || {_DIGIT} || '|庭' || {_DIGIT} as names from pages",
    "page_json": f"""
        select page_id, r::int as "row", case r when 0 then 'address' when 1 then 'pad' when 2 then 'name' when 3 then 'price' else 'name' end as key,
               case r when 0 then '町' || {_DIGIT} when 1 then repeat('-', 60) when 2 then '庭' || {_DIGIT} when 3 then {_DIGIT}::varchar else '賃貸' || {_DIGIT} end as value
                   from pages, range(5) t(r)""",
    "page_card_facts": f"select page_id, ({_DIGIT} * 10 + 5)::bigint * 10000 as price_min, ({_DIGIT} * 10 + 5)::bigint * 10000 as price_max, ({_DIGIT} * 10 + 5)::bigint * 10000 as price_avg, 20.5::double + {_DIGIT} as area_min, 20.5::double + {_DIGIT} as area_max, '1K' as layouts from pages",
    "page_cards_of_urls": f"select page_id, 'https://site.example/mansion/' || ({_DIGIT} + case when page_id % 4 = 0 then 10 else 0 end) as url, case when page_id % 4 > 0 then 0 end as block from pages",
    "free_text": """
        select p_partkey, case p_partkey % 5 when 0 then '即入居' when 1 then '4月上旬' when 2 then '空室' end as availability, (p_partkey % 20)::varchar as walk,
               case p_partkey % 4 when 0 then '棟' when 1 then 'alt' when 2 then p_name else 'https://h/' || p_partkey end as name from part""",
}
