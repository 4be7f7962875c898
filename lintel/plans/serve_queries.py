"""Read model, search, sort orders, payloads and filters: customers and parts stand for buildings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores
from ..operators import serve
from .common import table

AS_OF_YM = 2002 * 12 + 3
NOW_EPOCH = 1_015_000_000


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders of the last years."""
    o = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01' and o_custkey % 9 > 0")
    return o.groupBy(F.col("o_custkey").alias("building_key")).agg(F.count(F.lit(1)).alias("vacancy_count"),
        F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_updated"), F.lit("n").alias("name"), F.lit("a").alias("address"))


def _buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 8 <> 5").select(F.col("c_custkey").alias("building_id"), F.col("c_name").alias("canonical_name"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("canonical_address"), F.when(F.col("c_custkey") % 2 == 0, "2000-01-01").alias("updated_at"),
        F.when(F.col("c_custkey") % 10 == 0, 1).when(F.col("c_custkey") % 10 < 5, 0).alias("hidden_from_public"))


def read_model_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.newest_first(serve.read_model(_summaries(spark, sf_dir), _buildings(spark, sf_dir)))


def search_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.concat_ws(" ", "p_type", "p_brand").alias("address"))
    return serve.searched(p, " Small ").select("p_partkey", "name", "score")


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as cards: sizes stand for ages, prices for rents."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("id"), F.col("p_name").alias("name"), F.when(k % 7 > 0, F.col("p_brand")).alias("address"),
            F.when(k % 5 > 0, "chintai").when(k % 3 > 0, "bunjo").alias("property_kind"),
        F.when(k % 4 > 0, F.concat((1999 + k % 4).cast("string"), F.lit("-"), (1 + k % 12).cast("string"))).alias("built_year_month"),
        F.when(k % 6 > 0, F.col("p_size") % 5).alias("built_age"), F.when(k % 8 > 0, (k % 4).cast("long")).alias("vacancy_count"),
            F.when(k % 9 > 0, (F.col("p_retailprice") * 40).cast("long")).alias("rent_min"),
        F.when(k % 10 > 0, F.col("p_size").cast("double")).alias("area_min"), F.when(k % 11 > 0, F.lit("RC")).alias("structure"),
            F.when(k % 12 > 0, F.lit(NOW_EPOCH).cast("long") - k * 3600).otherwise(F.lit(-1).cast("long")).alias("updated_epoch"), k.alias("original_index"),
    )


def _ranked(df: DataFrame, sort: list) -> DataFrame:
    """The first 200 rows of a sort with their place."""
    from pyspark.sql import Window

    top = serve.page(df, sort, pages=20, searching=True)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*sort)).cast("long"))


def sort_built_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.order_by("built_age_asc", AS_OF_YM)).select("place", "id")


def sort_rent_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.order_by("rent_min_asc", AS_OF_YM)).select("place", "id")


def sort_rent_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.order_by("rent_min_desc", AS_OF_YM)).select("place", "id")


def sort_vacancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.order_by("vacancy_desc", AS_OF_YM)).select("place", "id")


def sort_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.order_by("updated_desc", AS_OF_YM)).select("place", "id")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cards(spark, sf_dir)
    rent = F.when(F.coalesce("property_kind", F.lit("")) != "bunjo", F.col("rent_min"))
    score = scores.recommended(F.col("vacancy_count"), rent, F.col("area_min"), F.col("built_age"), F.col("structure"), F.lower("name"),
        F.lower(F.coalesce("address", F.lit(""))), F.col("updated_epoch"), F.lit(NOW_EPOCH))
    return c.withColumn("recommended_score", score)


def recommended_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("id", F.round("recommended_score", 6).alias("score"))


def sort_recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _scored(spark, sf_dir).withColumn("recommended_score", F.round("recommended_score", 6))
    return _ranked(c, serve.order_by("recommended", AS_OF_YM)).select("place", "id")


def sort_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_cards(spark, sf_dir), serve.sentinel_order("rent_min_asc")).select("place", "id")


def export_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("name"), F.col("c_nationkey").alias("vacancy_count"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("address"))
    return serve.payload(c, ["id", "name", "vacancy_count", "address"])


def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("embedding")[0] * 1000).cast("double").alias("lat"),
        (F.col("embedding")[1] * 1000).cast("double").alias("lng"))
    return serve.rest_filter(serve.valid_places(e)[0], box=(-50, 60, -20, None)).select("vec_id")


def like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("name"), F.col("p_brand").alias("address"))
    return serve.rest_filter(p, q="ring").unionByName(serve.rest_filter(p, q="bRAND#1")).distinct()


def rest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("updated_at"))
    return serve.rest_page(o, limit=100, offset=40)


def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.kpis(serve.read_model(_summaries(spark, sf_dir), _buildings(spark, sf_dir)))


def shown_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.shown_counts(_cards(spark, sf_dir), serve.order_by("vacancy_desc", AS_OF_YM), 48)


QUERIES = {f.__name__: f for f in (read_model_union, search_relevance, sort_built_age, sort_rent_asc, sort_rent_desc, sort_vacancy, sort_updated, recommended_score,
    sort_recommended, sort_sentinel, export_payload, bounding_box, like_filter, rest_page, kpi_totals, shown_counts)}

_MODEL = """
    s as (select o_custkey as k, count(*) as vacancy_count, max(strftime(o_orderdate, '%Y-%m-%d')) as last_updated from orders
        where o_orderdate >= '2001-01-01' and o_custkey % 9 > 0 group by 1),
    b as (select c_custkey as k, c_name as name, case when c_custkey % 3 > 0 then c_mktsegment end as address,
        case when c_custkey % 2 = 0 then '2000-01-01' end as updated_at, case when c_custkey % 10 = 0 then 1 else 0 end as hidden from customer where c_custkey % 8 <> 5),
    m as (select s.k as building_key, coalesce(b.name, 'n') as name, coalesce(b.address, 'a') as address, coalesce(s.last_updated, b.updated_at) as updated_at,
        s.vacancy_count from s left join b using (k) where coalesce(hidden, 0) = 0
          union all select k, name, address, updated_at, null from b where hidden = 0 and k not in (select k from s))"""
_CARDS = f"""
    c as (select p_partkey as id, p_name as name, case when p_partkey % 7 > 0 then p_brand end as address,
        case when p_partkey % 5 > 0 then 'chintai' when p_partkey % 3 > 0 then 'bunjo' end as kind,
                 case when p_partkey % 4 > 0 then (1999 + p_partkey % 4) * 12 + 1 + p_partkey % 12 end as ym, case when p_partkey % 6 > 0 then p_size % 5 end as age,
                     case when p_partkey % 8 > 0 then p_partkey % 4 end as vac,
                 case when p_partkey % 9 > 0 then trunc(p_retailprice * 40)::bigint end as rent, case when p_partkey % 10 > 0 then p_size::double end as area,
                     case when p_partkey % 11 > 0 then 'RC' end as structure,
                 case when p_partkey % 12 > 0 then {NOW_EPOCH} - p_partkey * 3600 else -1 end as updated from part)"""


def _sorted(order: str) -> str:
    return f"with {_CARDS}, r as (select row_number() over (order by {order}, id) as place, id from c) select place, id from r where place <= 200"


_SCORE = f"""
    n as (select *, case when vac > 0 then vac end as v, case when coalesce(kind, '') <> 'bunjo' and rent > 0 then rent end as r, case when area > 0 then area end as a,
        coalesce(age, 0) as g from c),
    t as (select id, round(case when v is not null then 40 else 0 end + case when r is not null then 26 else -36 end + case when a is not null then 20 else -26 end + 18 +
        case when address is not null then 18 else -24 end
                 + 6.0 * ((r is not null)::int + (a is not null)::int + (structure is not null)::int + (address is not null)::int + 2)
                 + case when v is not null then 2.0 * least(v, 20) else -44.0 end + case when r is not null then least(r / 15000.0::double, 16) else 0 end + greatest(0,
                     18 - least(g, 40) * 0.45::double)
                 + case when updated > 0 then greatest(0, 8 - least(({NOW_EPOCH} - updated) / 86400.0::double, 120) * 0.06::double) else 0 end, 6) as score from n)"""

ORACLE_SQL = {
    "read_model_union": f"with {_MODEL} select * from m",
    "search_relevance": """
        with p as (select p_partkey, p_name as name, lower(p_name) as n, lower(p_type || ' ' || p_brand) as a from part),
             s as (select *, (case when starts_with(n, 'small') then 300 when contains(n, 'small') then 200 else 0 end + case when starts_with(a,
                 'small') then 120 when contains(a, 'small') then 80 else 0 end + case when contains(n || ' ' || a, 'small') then 20 else 0 end)::int as score from p)
        select p_partkey, name, score from s where score > 0""",
    "sort_built_age": _sorted(f"case when ym is null then 3 when ym > {AS_OF_YM} then 0 when age = 0 then 1 else 2 end, ym desc nulls last, case when ym is not null then case kind when 'chintai' then 0 when 'bunjo' then 1 else 2 end end nulls last, age nulls last"),
    "sort_rent_asc": _sorted("case when coalesce(kind, '') <> 'bunjo' and rent > 0 then rent end nulls last"),
    "sort_rent_desc": _sorted("case when coalesce(kind, '') <> 'bunjo' and rent > 0 then rent end desc nulls last"),
    "sort_vacancy": _sorted("case when vac > 0 then vac end desc nulls last"),
    "sort_updated": _sorted("case when updated > 0 then updated end desc nulls last"),
    "recommended_score": f"with {_CARDS}, {_SCORE} select id, score from t",
    "sort_recommended": f"with {_CARDS}, {_SCORE}, r as (select row_number() over (order by score desc nulls last, id) as place, id from t) select place, id from r where place <= 200",
    "sort_sentinel": _sorted("coalesce(case when rent > 0 then rent end, 999999999), name"),
    "export_payload": """
        select c_custkey::varchar as id, '{"id":' || c_custkey || ',"name":' || case when c_custkey % 4 = 0 then 'null' else '"' || c_name || '"' end || ',"vacancy_count":' || c_nationkey || ',"address":' || case when c_custkey % 3 = 0 then '"' || c_mktsegment || '"' else 'null' end || '}' as json from customer""",
    "bounding_box": "with e as (select vec_id, (embedding[1] * 1000::float)::double as lat, (embedding[2] * 1000::float)::double as lng from embeddings) select vec_id from e where lat between -90 and 90 and lng between -180 and 180 and lat >= -50 and lat <= 60 and lng >= -20",
    "like_filter": "select p_partkey, upper(p_name) as name, p_brand as address from part where p_name ilike '%ring%' or p_brand ilike '%ring%' or p_name ilike '%brand#1%' or p_brand ilike '%brand#1%'",
    "rest_page": "select o_orderkey, case when o_orderkey % 3 > 0 then strftime(o_orderdate, '%Y-%m-%d') end as updated_at from orders order by updated_at desc nulls last, o_orderkey limit 100 offset 40",
    "kpi_totals": f"with {_MODEL} select count(*) as total, coalesce(sum(vacancy_count), 0)::bigint as vacant, max(updated_at) as latest from m",
    "shown_counts": f"with {_CARDS}, r as (select * from c order by case when vac > 0 then vac end desc nulls last, id limit 48) select count(*) as shown, coalesce(sum(greatest(vac, 0)), 0)::bigint as shown_vacant from r",
}
