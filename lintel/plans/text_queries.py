"""Parsing of texts, pages and document lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields, text as tx
from ..operators import corrections, quality
from ..sources import pages, text_rows
from .common import table


def parse_money_area_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts made of numbers, read back by the expressions of each source."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("n"), (F.col("p_partkey") % 4).alias("m"))
    money = F.when(F.col("m") == 0, F.concat("n", F.lit("万5000円"))).when(F.col("m") == 1, F.concat(F.lit("1,"), F.lpad("n", 3, "0"), F.lit("円"))).when(F.col("m") == 2,
        F.concat("n", F.lit(".5万円"))).otherwise("なし")
    area = F.concat("n", F.when(F.col("m") == 0, ".25㎡").when(F.col("m") == 1, " m2").otherwise("坪"))
    return p.select(
        "p_partkey", fields.yen_from_text(money).alias("yen"), fields.yen_from_list(money).alias("list_yen"), fields.fee_yen(money).alias("fee"),
            fields.yen_from_man(F.concat("n", F.lit(".35"))).alias("strict_yen"), fields.man_from_page(money).alias("man"),
        fields.yen_from_sheet(F.concat(F.lit(" "), F.col("n"), F.lit("万円"))).alias("sheet_yen"), fields.area_sqm(area).alias("area"),
            fields.area_any_unit(area).alias("any_area"), fields.age_years(F.concat(F.when(F.col("m") == 3, "-").otherwise(""), F.col("n"), F.lit(".7"))).alias("age"),
        fields.built_year(F.concat(F.lit(" 19"), F.lpad("n", 2, "0"), F.lit("年"))).alias("built_year"), fields.format_yen(F.col("p_partkey") * 1234).alias("shown"),
            fields.built(F.concat(F.lit("20"), F.lpad("n", 2, "0"), F.lit("年 "), (F.col("m") * 5).cast("string"), F.lit("月 ("), F.col("n"), F.lit("年)")))
            .getField("year_month").alias("built_ym"),
    )


def built_age_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ym = F.when(F.col("o_orderkey") % 7 == 0, "1999-13").when(F.col("o_orderkey") % 7 == 1, "x").otherwise(F.date_format("o_orderdate", "yyyy-M"))
    return o.select("o_orderkey", ym.alias("built"), fields.built_age(ym, F.lit("2000-03-01").cast("date")).alias("age"))


def availability_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    raw = F.when(k % 9 == 0, "即入居可").when(k % 9 == 1, "").when(k % 9 == 2, "相談").when(k % 9 == 3,
        "2月30日").otherwise(F.concat((1 + k % 12).cast("string"), F.lit("月"), (1 + k % 28).cast("string"), F.lit("日 退去予定")))
    ref = F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("2026/"), F.lpad((1 + k % 11).cast("string"), 2, "0"), F.lit("/15 10:00")))
    return e.select("event_id", fields.availability(raw, ref, F.when(k % 2 == 0, "ulucks").otherwise("realpro")).alias("a")).select("event_id", "a.immediate", "a.label",
        "a.date")


def sanitize_and_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 3 == 0, F.concat((k % 500).cast("string"), F.lit(": "))).otherwise(""), F.col("p_name"),
        F.when(k % 2 == 0, F.concat(F.lit(" "), (100 + k % 300).cast("string"), F.lit("号室"))).otherwise("   end"))
    plain = tx.without_list_number(name)
    room = tx.split_room(F.concat("p_name", F.when(k % 2 == 0, F.concat(F.lit(" "), (100 + k % 300).cast("string"), F.lit("号室"))).otherwise("")))
    return p.select("p_partkey", tx.without_room(name).alias("public"), plain.alias("plain"), room["building"].alias("building"), room["room"].alias("room"),
        tx.forbidden_content(name).alias("forbidden"))


def normalize_text_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts between wide and half-width signs, a name with a room number, an address in words."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    wide = F.concat(F.lit("ＡＢ１　ｶﾅ "), F.coalesce("text", F.lit("")), F.lit("　㎡"))
    name = F.concat(F.lit("メゾン　"), F.col("lang"), F.lit("‐Ａ "), F.when(k % 2 == 0, F.concat((100 + k % 300).cast("string"), F.lit("号室"))).otherwise("棟"))
    place = F.concat(F.lit("北九州市 三丁目二十"), (k % 9).cast("string"), F.lit("番５号"))
    return d.select("doc_id", F.sha2(tx.normalize_text(wide).cast("binary"), 256).alias("normal"), tx.normalize_building_name(name).alias("name"),
        tx.normalize_address(place).alias("address"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.page_rows(table(spark, sf_dir, "pages"))
    return pages.links(rows, F.lit("https://site.example")).groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.max("url").alias("greatest"))


_TABLE = "<table><tr><th>物件名</th><th>号室</th><th>所在地</th><th>家賃(万円)</th></tr><tr><td>棟{0}</td><td>{0}</td><td>町{0}-1</td><td>5.{0}</td></tr><tr><td>棟{0}b</td><td>2</td><td>町{0}-2</td><td>6</td></tr></table>"
_CARD = "<article class='property-card'><h2>棟{0}</h2><dl><dt>所在地</dt><dd>町{0}</dd><dt>賃料</dt><dd>{0}万円</dd></dl><div>間取り： 1K</div></article>"


def _with_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a card and a header table, with the table only, or as they are."""
    def with_id(html: str):
        return F.replace(F.lit(html), F.lit("{0}"), (F.col("page_id") % 10).cast("string"))

    k = F.col("page_id") % 3
    return table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.when(k == 0, F.concat(with_id(_CARD), with_id(_TABLE))).when(k == 1, with_id(_TABLE))
        .otherwise("")).alias("html"))


def page_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards where there are any, else the table's rows."""
    return pages.listings(pages.page_rows(_with_listings(spark, sf_dir))).select("page_id", "kind", "row", "name", "room", "address", "rent", "layout")


def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.groupBy("event_type").agg(F.sum(k).alias("total"), F.max(k).alias("most"), F.count_if(k.isNull()).alias("missing"))


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("context"))
    return text_rows.carried_forward(e, ["user_id"], ["event_id"], "context")


def words_to_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as words on a page: their number says how far down, their role where from the left."""
    c = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") * 1.9).cast("double").alias("top"), (F.length("role") * 10 + F.col("turn")).alias("x0"),
        F.concat("role", F.col("turn").cast("string")).alias("word"))
    return text_rows.lines(c, ["conv_id"], "top", "x0", "word")


def document_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    kind = text_rows.document_kind(F.lower("text"), {"en": (" the ", " and ", " of ", " to "), "fr": (" le ", " la ", " de ", " et ")})
    return d.groupBy("lang", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def backfill_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    b = table(spark, sf_dir, "part").select(k.alias("building_id"), F.when(k % 5 == 0, " ").when(k % 5 == 1, "199x")
        .otherwise(F.concat((1990 + k % 15).cast("string"), F.lit("-"), (1 + k % 12).cast("string"))).alias("built_year_month"),
        F.when(k % 4 > 0, F.col("p_size") % 20).alias("age_years"))
    return corrections.backfilled_ages(b, F.lit("2010-06-15").cast("date")).select("building_id", "age_years", "old_age", "outcome")


def line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of a report are: noise, structure, address, name."""
    k = F.col("event_id")
    line = F.when(k % 6 == 0, "TEL: 1").when(k % 6 == 1, F.concat(F.lit("RC 築"), (k % 40).cast("string"), F.lit("年"))).when(k % 6 == 2,
        F.concat(F.lit("小倉北区町"), (k % 9).cast("string"), F.lit("-1"))).when(k % 6 == 3,
        F.concat((k % 9).cast("string"), F.lit("/9頁"))).otherwise(F.concat(F.lit("棟"), F.col("event_type")))
    return table(spark, sf_dir, "events").groupBy("event_type", text_rows.line_kind(line).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return quality.drop_reasons(p, {"ring": F.contains("p_name", F.lit("ring")), "large": F.col("p_size") > 40, "none": F.lit(None).cast("boolean")})


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_counts(pages.page_rows(_with_listings(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (parse_money_area_dates, built_age_as_of, availability_rollover, sanitize_and_split, normalize_text_nfkc, page_links, page_listings,
    embedded_json, carry_forward, words_to_lines, document_kinds, backfill_ages, line_kinds, drop_reasons, page_counts)}

_LINKS = r"""
    c as (select page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)[^>]*>.*?</(script|style)[^>]*>', '', 'gsi') as h from pages),
    l as (select page_id, unnest(regexp_extract_all(h, '(?i)<a\s+[^>]*?href\s*=\s*["'']?([^"''\s>]*)', 1)) as u from c)"""
_D = "(page_id % 10)"

ORACLE_SQL = {
    "normalize_text_nfkc": r"""
        select doc_id, sha256('AB1 カナ ' || ltrim(trim(regexp_replace(coalesce(text, '') || ' m2', '\s+', ' ', 'g')))) as normal,
            'メゾン ' || lang || '-A' || case when doc_id % 2 = 0 then '' else ' 棟' end as name,
               '福岡県北九州市3-二十' || (doc_id % 9) || '-5' as address from documents""",
    "page_links": f"""
        with {_LINKS}, a as (select page_id, case when regexp_matches(u, '^https?://') then u when starts_with(u,
            '/') then 'https://site.example' || u else 'https://site.example/' || u end as url from l where u <> '')
        select page_id, count(*) as links, max(url) as greatest from a group by page_id""",
    "page_listings": f"""
        select page_id, 'field' as kind, 0 as "row", null::varchar as name, null::varchar as room, '町' || {_D} as address, {_D} || '万円' as rent, '1K' as layout from pages
            where page_id % 3 = 0
        union all select page_id, 'cell', 0, '棟' || {_D}, {_D}::varchar, '町' || {_D} || '-1', '5.' || {_D}, null from pages where page_id % 3 = 1
        union all select page_id, 'cell', 1, '棟' || {_D} || 'b', '2', '町' || {_D} || '-2', '6', null from pages where page_id % 3 = 1""",
    "page_counts": f"""
        with {_LINKS}, n as (select page_id, count(*) as links from l group by page_id)
        select page_id, (page_id % 3 = 0)::bigint as cards, case when page_id % 3 = 0 then 3 else 0 end::bigint as fields,
            case when page_id % 3 < 2 then 8 else 0 end::bigint as cells, links from n""",
    "parse_money_area_dates": """
        with p as (select p_partkey, p_size as n, p_partkey % 4 as m from part)
        select p_partkey, case m when 0 then n * 10000 + 5000 when 1 then case when true then (1000 + n) end when 2 then n * 10000 + 5000 end::bigint as yen,
            case m when 0 then 5000 when 1 then 1000 + n when 2 then n * 10000 + 5000 end::bigint as list_yen,
               case m when 0 then 5000 when 1 then 1000 + n when 2 then n * 10000 + 5000 else 0 end::bigint as fee,
                   trunc((n || '.35')::double * 10000)::bigint as strict_yen,
                       case m when 0 then n::double when 1 then (1000 + n) / 10000.0::double when 2 then n + 0.5::double end as man,
               (n * 10000)::bigint as sheet_yen, case m when 0 then n + 0.25::double when 1 then n::double end as area,
                   case m when 0 then n + 0.25::double else n::double end as any_area, case when m <> 3 then n end::int as age,
               (1900 + n)::int as built_year, format('{:,}', p_partkey * 1234) as shown, case when m in (1, 2) then '20' || lpad(n::varchar, 2,
                   '0') || '-' || lpad((m * 5)::varchar, 2, '0') end as built_ym from p""",
    "built_age_as_of": """
        with o as (select o_orderkey, case o_orderkey % 7 when 0 then '1999-13' when 1 then 'x' else year(o_orderdate) || '-' || month(o_orderdate) end as built,
            case when o_orderkey % 7 > 1 then greatest(floor((2000 * 12 + 3 - year(o_orderdate) * 12 - month(o_orderdate)) / 12)::int, 0) end as age from orders)
        select * from o""",
    "availability_rollover": """
        with e as (select event_id as k, 1 + event_id % 12 as m, 1 + event_id % 28 as d, 1 + event_id % 11 as r, event_id % 9 as c from events),
             x as (select *, c > 3 and k % 10 > 0 as dated, case when m < r then 2027 else 2026 end as y,
                 case c when 0 then '即入居可' when 1 then '' when 2 then '相談' when 3 then '2月30日' else m || '月' || d || '日 退去予定' end as raw from e)
        select k as event_id, c = 0 or (c = 1 and k % 2 = 0) as immediate,
            case when c = 0 then '即入居' when c = 1 then case when k % 2 = 0 then '入居' end when dated then m || '/' || d else raw end as label,
                case when dated then y || '-' || lpad(m::varchar, 2, '0') || '-' || lpad(d::varchar, 2, '0') end as date from x""",
    "sanitize_and_split": """
        with p as (select p_partkey as k, p_name as n, case when p_partkey % 3 = 0 then (p_partkey % 500) || ': ' else '' end as pre,
            case when p_partkey % 2 = 0 then ' ' || (100 + p_partkey % 300) || '号室' else '   end' end as post from part)
        select k as p_partkey, pre || n || case when k % 2 = 0 then '' else ' end' end as public, n || post as plain, n as building,
            case when k % 2 = 0 then (100 + k % 300)::varchar end as room, k % 2 = 0 as forbidden from p""",
    "embedded_json": "select event_type, sum(json_extract(props, '$.k')::int)::bigint as total, max(json_extract(props, '$.k')::int) as most, count(*) filter (json_extract(props, '$.k') is null) as missing from events group by event_type",
    "carry_forward": "select event_id, user_id, last_value(case when event_id % 4 = 0 then event_type end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) as context from events",
    "words_to_lines": "select conv_id, round_even(turn * 1.9::double / 4, 0)::bigint as line, string_agg(role || turn, ' ' order by length(role) * 10 + turn, role || turn) as text from conversations group by 1, 2",
    "document_kinds": """
        with d as (select lang, contains(lower(text), ' the ') and contains(lower(text), ' and ') and contains(lower(text), ' of ') and contains(lower(text),
            ' to ') as e, contains(lower(text), ' le ') and contains(lower(text), ' la ') and contains(lower(text), ' de ') and contains(lower(text), ' et ') as f
                from documents)
        select lang, case when e and f then 'ambiguous' when e then 'en' when f then 'fr' else 'other' end as kind, count(*) as n from d group by 1, 2""",
    "backfill_ages": """
        with p as (select p_partkey as k, case when p_partkey % 4 > 0 then p_size % 20 end as a,
            case when p_partkey % 5 > 1 then greatest(((2010 * 12 + 6 - (1990 + p_partkey % 15) * 12 - 1 - p_partkey % 12) // 12)::int, 0) end as n from part)
        select k as building_id, coalesce(n, a) as age_years, a as old_age, case when k % 5 = 0 then 'none' when n is null then 'invalid' when n is not distinct
            from a then 'same' else 'updated' end as outcome from p""",
    "line_kinds": "select event_type, case event_id % 6 when 0 then 'noise' when 1 then 'structure' when 2 then 'address' when 3 then 'noise' else 'name' end as kind, count(*) as n from events group by 1, 2",
    "drop_reasons": "select 'ring:' || count(*) filter (contains(p_name, 'ring')) || ',large:' || count(*) filter (p_size > 40) || ',none:0' as reasons from part",
}
