"""Expressions on cases with stored results, and operators on files and stores.

Each row of a table takes one of the cases of a form by its key; the SQL twin takes the stored result of that case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields, text as tx
from ..operators import quality, serve, snapshots
from ..sources import store, text_rows
from .common import scratch, table

_GARBLED = "賃料一覧".encode("cp932").decode("latin-1")
_CITIES = {"1616": "門司区", "1619": "小倉北区"}


def _named(name: Column) -> Column:
    return F.concat_ws("|", *[tx.split_document_room(name, F.lit(""))[k] for k in ("building", "room")])


def _place(url: Column) -> Column:
    return F.concat_ws("|", *[tx.place_of_url(url, _CITIES)[k] for k in ("city", "ward")])


def _cell(text: Column) -> Column:
    pair = F.split(text, "=")
    return text_rows.cell_by_header(F.array(F.struct(F.lit("備考").alias("key"), F.lit("none").alias("value")), F.struct(pair[0].alias("key"), pair[1].alias("value"))),
        "賃料", "家賃")


#: column -> (expression, {text: result})
FORMS = {
    "compact": (tx.compact_for_key, {"Ａ－b、ｃ。": "abc", "Ｘ　１": "x1", "": "", "ー塔-A": "塔a"}),
    "number": (tx.kanji_number, {"十": "10", "百": "100", "三百二十一": "321", "百五": "105", "二三": "二三", "x": "x"}),
    "ward": (tx.ward, {"福岡県北九州市八幡西区x": "八幡西区", "福岡市中央区1": "福岡市中央区", "別": ""}),
    "completed": (lambda c: tx.with_ward(c, F.lit("小倉北区")), {"町1": "北九州市小倉北区町1", "北九州市小倉北区町1": "北九州市小倉北区町1", "小倉北区町1": "北九州市小倉北区町1", "": ""}),
    "named": (_named, {"棟名 101号室": "棟名|101", "棟名-12号": "棟名|12", "棟名 1-02": "棟名|102", "棟名(203)": "棟名|203", "棟名 304": "棟名|304", "A棟": "A棟|", "東棟": "東棟|", "棟名": "棟名|"}),
    "place": (_place, {"http://h/l?sub_city[]=9&sub_city[]=1616": "北九州市|門司区", "http://h/city/400001.html": "北九州市|", "http://h/": "|"}),
    "document": (tx.document_text, {_GARBLED + "　（１）【—】": _GARBLED + " (1)[-]", " a　b ": "a b", "": ""}),
    "repaired": (tx.repaired, {_GARBLED: "賃料一覧", "賃料": "賃料", "abc": "abc"}),
    "garbled": (lambda c: tx.mojibake(c).cast("string"), {_GARBLED: "true", "賃料é": "false", "": "false", "賃料����": "true"}),
    "day": (fields.updated_day, {"更新 2026年01月02日": "2026-01-02", "2026/01/02 10:00": "2026-01-02", "x": ""}),
    "stamp": (lambda c: F.date_format(fields.summary_date(c), "yyyy-MM-dd HH:mm"),
        {"2026-01-02": "2026-01-02 00:00", "2026/1/2 3:04": "2026-01-02 03:04", "2026年1月2日": "2026-01-02 00:00", "2026/01": "2026-01-01 00:00",
        "am 2026-01-02!": "2026-01-02 00:00", "2026-02-30": None}),
    "cell_area": (lambda c: fields.area_of_cell(c).cast("string"), {"25.5㎡": "25.5", "約 30 m2": "30.0", "": None}),
    "strict_area": (lambda c: fields.area_strict(c).cast("string"), {"25.5": "25.5", " 7 ": "7.0", "": None}),
    "digit": (lambda c: tx.has_digit(c).cast("string"), {"町1": "true", "町": "false", "町１": "true"}),
    "lots": (lambda c: tx.several_lots(c).cast("string"), {"町1、2": "true", "町1〜2": "true", "町1-2": "false"}),
    "unit": (lambda c: tx.unit_like_name(c).cast("string"), {"room 1": "true", "ab": "true", "abc": "false", "号室x": "true"}),
    "granular": (lambda c: tx.granular_address(c).cast("string"), {"北九州市小倉町1-1-1": "true", "北九州市小倉町8-3": "false", "北九州市小倉町1-1、2": "false", "a1-1-1": "false"}),
    "house": (lambda c: tx.detached_house(c).cast("string"), {"貸家 1": "true", "一戸建": "true", "棟": "false"}),
    "cell": (_cell, {"賃料(円)=5": "5", "家賃=6": "6", "面積=7": ""}),
    "name": (tx.normalize_building_name, {"メゾン　１２３号室": "メゾン", "サンライフ恒見２": "サンライフ恒見", "A･B": "A・B", "ビル‐５０１": "ビル", "ー塔ー": "塔", "Tower 12A": "Tower"}),
    "address": (tx.normalize_address, {"北九州市小倉北区片野一丁目２番３号": "福岡県北九州市小倉北区片野1-2-3", "東京都千代田区二十三番地": "東京都千代田区23", "百二十番": "120", "二三番": "二三", "十丁目": "10"}),
}


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k, *[F.array(*map(F.lit, cases))[(k % len(cases)).cast("int")].alias(name) for name, (_, cases) in FORMS.items()])
    return p.select("p_partkey", *[form(F.col(name)).alias(name) for name, (form, _) in FORMS.items()])


def csv_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing file with marks, quotes and line breaks, written, accepted by its header, read and numbered."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit('棟 "'), F.col("n_name"), F.lit('",\n'), F.col("n_nationkey").cast("string")).alias("building_name"),
        F.concat(F.lit("e"), F.col("n_nationkey").cast("string")).alias("evidence_id"), F.col("n_nationkey").alias("at"))
    path = scratch(spark, "listings")
    store.write_csv(n.repartition(1).sortWithinPartitions("at"), path, store.MASTER)
    read = store.read_listings(spark, path)
    store.required_header(read.columns, ("building_name", "evidence_id"))
    return store.numbered(read).select("row_no", "building_name", "evidence_id")


def store_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables published together, one of them again; what is read is the newest of both."""
    s = store.Store(spark, scratch(spark, "store"))
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    s.publish({"nation": n.limit(3), "region": r})
    s.publish({"nation": n}, not_empty=["nation"])
    try:
        s.publish({"nation": n.where("n_nationkey < 0"), "region": r.limit(0)}, not_empty=["nation"])
    except ValueError:
        pass  # an empty table is refused, and nothing changes
    return s.read("nation").join(s.read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as a manifest sees them: here one, made of the regions, and the newest of them."""
    path = scratch(spark, "files")
    table(spark, sf_dir, "region").orderBy("r_regionkey").select(F.concat(F.lit("%PDF /Type /Page "), F.col("r_name"), F.lit(" /Type /Pages"))
        .alias("value")).repartition(1).sortWithinPartitions("value").write.option("lineSep", "\n").text(path)
    files = store.file_manifest(spark, path, "*.txt")
    return files.select("size", "sha256", "pages", (F.col("path") == F.lit(store.latest_file(files))).alias("latest"))


def page_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    cache = p.where("page_id % 2 = 0 and url is not null").groupBy(F.sha1(F.encode("url", "UTF-8")).alias("key")).agg(F.min("html").alias("html"))
    return store.cached_pages(p.select("page_id", "url"), cache).select("page_id", F.length("html").alias("n"))


def schema_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older table in a newer form, and one with columns that are missing and further ones."""
    n = table(spark, sf_dir, "nation")
    want = spark.createDataFrame([], "id long, name string, note string").schema
    moved = store.migrated(n.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("title"), "n_regionkey"), {"key": "id", "title": "name"}, want)
    kept = store.conform(n.select(F.col("n_nationkey").cast("string").alias("id"), F.lit("x").alias("more")), want, ["id"])
    first = store.first_name(n, "nation_name", "n_name")
    return moved.withColumn("more", F.lit(first)).unionByName(kept)


def current_run_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is started, finished and made current."""
    o = table(spark, sf_dir, "orders")
    runs = o.groupBy(F.col("o_orderpriority").alias("source")).agg(F.max(F.year("o_orderdate")).cast("long").alias("id")).select("id", "source",
        F.lit("s").alias("snapshot_key"), F.lit("completed").alias("status"))
    runs, number = snapshots.started(runs.where("source <> '1-URGENT'"), "1-URGENT", "new")
    current = runs.where("status = 'completed'").select("source", F.col("id").alias("ingest_run_id"))
    return snapshots.switched(current, snapshots.finished(runs, number), "1-URGENT", number)


def build_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    a = c.agg(F.count(F.lit(1)).alias("buildings"), F.max("c_custkey").alias("latest"), F.lit("x").alias("commit"))
    b = c.where("c_custkey % 2 = 0").agg(F.count(F.lit(1)).alias("buildings"), F.lit("x").alias("commit"), F.lit(1).alias("other"))
    return quality.same_build(a, b)


def forbidden_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(k % 5 == 0, F.concat("p_name", F.lit(" 101号室"))).otherwise(F.col("p_name")).alias("name"),
        F.when(k % 7 == 0, "MAIL=x").when(k % 7 == 1, None).otherwise("-").alias("note"))
    return serve.leaks(p, "name", "note").select("p_partkey")


def raw_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.raw_sources(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "click", "event_type", "event_id")


def legacy_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(k % 3 == 0, F.col("p_size")).alias("age_years"), F.when(k % 2 == 0, F.col("p_size") + 100).alias("years"),
        F.when(k % 5 == 0, "s").alias("structure"))
    return store.backfilled(p, {"age_years": "years", "structure": "structure_old"}).drop("years")


def latest_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))).otherwise("").alias("raw"))
    return quality.latest_texts(o, "raw", "day")


def geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of districts from the cache; addresses with a lot number keep what they have."""
    s = table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    places = s.select("s_suppkey", F.concat(F.lit("町"), n.cast("string"), F.when(k % 3 == 0, "-1").otherwise("")).alias("address"), F.when(k % 4 == 0, 1.0).alias("lat"),
        F.when(k % 4 == 0, 2.0).alias("lng"))
    cache = table(spark, sf_dir, "nation").select(F.concat(F.lit("町"), F.col("n_nationkey").cast("string")).alias("query"),
        (F.col("n_nationkey") + 30.5).cast("double").alias("lat"), (F.col("n_nationkey") + 130.5).cast("double").alias("lng"))
    return store.geocoded(places, cache).select("s_suppkey", "lat", "lng")


def line_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines before a table say: the last name, address and structure of each user."""
    k = F.col("event_id")
    text = F.when(k % 4 == 0, F.concat(F.lit("棟"), k.cast("string"))).when(k % 4 == 1, F.concat(F.lit("小倉北区町"), k.cast("string"), F.lit("-1／3F"))).when(k % 4 == 2,
        F.concat(F.lit("RC 築"), k.cast("string"), F.lit("年"))).otherwise("TEL: 1")
    return text_rows.context(table(spark, sf_dir, "events").select("user_id", "event_id", text.alias("text")), ["user_id"], "event_id", "text")


QUERIES = {f.__name__: f for f in (
    text_forms, csv_contract, store_published, file_list, page_cache, schema_forms, current_run_pointer, build_differences, forbidden_rows, raw_sources, legacy_backfill,
        latest_availability, geocode_cache, line_context,
)}


def _stored(name: str) -> str:
    results = ["null" if v is None else "'" + v.replace("'", "''") + "'" for v in FORMS[name][1].values()]
    return f"([{', '.join(results)}])[1 + p_partkey % {len(results)}] as \"{name}\""


ORACLE_SQL = {
    "text_forms": f"select p_partkey, {', '.join(map(_stored, FORMS))} from part",
    "csv_contract": "select n_nationkey::bigint + 2 as row_no, '棟 \"' || n_name || '\",' || chr(10) || n_nationkey as building_name, 'e' || n_nationkey as evidence_id from nation",
    "store_published": "select n_name, r_name from nation join region on n_regionkey = r_regionkey",
    "file_list": "select strlen(t)::bigint as size, sha256(t) as sha256, 5 as pages, true as latest from (select string_agg('%PDF /Type /Page ' || r_name || ' /Type /Pages' || chr(10), '' order by r_name) as t from region)",
    "page_cache": "with c as (select url, min(html) as h from pages where page_id % 2 = 0 group by url) select page_id, length(h)::int as n from pages left join c using (url)",
    "schema_forms": "select n_nationkey::bigint as id, n_name as name, null::varchar as note, 'n_name' as more from nation union all select n_nationkey, null, null, 'x' from nation",
    "current_run_pointer": """
        with r as (select o_orderpriority as source, max(year(o_orderdate)) as id from orders group by 1)
        select source, id::bigint as ingest_run_id from r where source <> '1-URGENT' union all select '1-URGENT', (select max(id) + 1 from r
            where source <> '1-URGENT')""",
    "build_differences": "select 'buildings' as key, count(*)::varchar as \"left\", (count(*) filter (c_custkey % 2 = 0))::varchar as \"right\" from customer having count(*) <> count(*) filter (c_custkey % 2 = 0)",
    "forbidden_rows": "select p_partkey from part where p_partkey % 5 = 0 or p_partkey % 7 = 0",
    "raw_sources": "select event_id, event_type, user_id from events where event_type = 'click' order by event_id",
    "legacy_backfill": "select p_partkey, case when p_partkey % 3 = 0 then p_size when p_partkey % 2 = 0 then p_size + 100 end as age_years, case when p_partkey % 5 = 0 then 's' end as structure from part",
    "latest_availability": "with o as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, 't' || o_orderkey as raw from orders where o_orderkey % 3 > 0) select * from o order by day desc, raw limit 20",
    "geocode_cache": "select s_suppkey, case when s_suppkey % 4 = 0 then 1.0::double when s_suppkey % 3 > 0 then s_nationkey + 30.5::double end as lat, case when s_suppkey % 4 = 0 then 2.0::double when s_suppkey % 3 > 0 then s_nationkey + 130.5::double end as lng from supplier",
    "line_context": """
        select user_id, '棟' || max(event_id) filter (event_id % 4 = 0) as name, '小倉北区町' || max(event_id) filter (event_id % 4 = 1) || '-1' as address,
            'RC 築' || max(event_id) filter (event_id % 4 = 2) || '年' as structure from events group by user_id""",
}
