"""Summary, snapshot and gate queries: customers stand for buildings, orders for their listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, snapshots, summaries
from .common import table

#: Every age is counted up to this day.
AS_OF = "2002-03-01"

_LISTINGS = """
    select o_orderkey as id, cast(o_custkey as {string}) as building_key, concat('L', cast(o_orderkey as {string})) as name, concat('A',
        cast(o_custkey as {string})) as address,
           cast(floor(o_totalprice) as bigint) as rent_yen, (o_orderkey % 80) + 0.5e0 as area_sqm, o_orderpriority as layout,
           case when o_orderkey % 5 = 0 then concat('m', cast(o_orderkey % 9 as {string})) end as move_in_date, {day} as updated_at,
           case when o_orderkey % 3 > 0 then cast(o_orderkey % 6 as int) end as age_years, case when o_orderkey % 4 > 0 then o_orderstatus end as structure,
           case when o_orderkey % 11 = 0 then '即入居可' when o_orderkey % 7 = 0 then concat('退去予定',
               cast(o_orderkey % 13 as {string})) when o_orderkey % 2 = 0 then '-' else 'x' end as availability_raw,
           case when o_orderkey % 8 = 0 then o_orderpriority end as structure_raw, case when o_orderkey % 6 = 0 then concat(cast(1990 + o_custkey % 9 as {string}), '-0',
               cast(1 + o_orderkey % 9 as {string})) end as built_year_month,
           case when o_orderkey % 10 = 0 then cast(o_orderkey % 7 as int) end as built_age_years,
               case when o_orderkey % 9 = 0 then {day} when o_orderkey % 9 = 1 then 'soon' end as availability_date,
           case when o_orderkey % 17 = 0 then 1 else 0 end as availability_flag_immediate, o_orderpriority as source, cast(year(o_orderdate) as int) as ingest_run_id
    from orders"""
_BUILDINGS = """
    select cast(c_custkey as {string}) as building_id, c_name as canonical_name, concat('A', cast(c_custkey as {string})) as canonical_address,
        case when c_custkey % 3 = 0 then c_mktsegment end as structure,
           case when c_custkey % 4 = 0 then cast(c_custkey % 30 as int) end as age_years,
               case when c_custkey % 5 = 0 then cast(1980 + c_custkey % 20 as int) end as built_year, case when c_custkey % 10 = 0 then '1985-07' end as built_year_month,
           case when c_custkey % 2 = 0 then 'call' end as availability_label,
               case when c_custkey % 6 = 0 then 'bunjo' when c_custkey % 6 = 1 then 'chintai' end as property_kind,
           c_custkey * 1000 as sale_price_yen_min, c_custkey * 2000 as sale_price_yen_max, c_custkey * 1500 as sale_price_yen_avg,
               cast(c_custkey % 4 as int) as sale_listing_count, 50000 + c_custkey as avg_rent_yen
    from customer where c_custkey % 7 <> 3"""
_DUCK = {"string": "varchar", "day": "strftime(o_orderdate, '%Y-%m-%d')"}
_SPARK = {"string": "string", "day": "date_format(o_orderdate, 'yyyy-MM-dd')"}


def _sql(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    """A SELECT over one table, bound to the files without a named view."""
    return spark.sql(text.format(**_SPARK).replace(f"from {name}", f"from {{{name}}}"), **{name: table(spark, sf_dir, name)})


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, _LISTINGS, "orders")


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, _BUILDINGS, "customer")


def current_runs(rows: DataFrame) -> DataFrame:
    """(source, ingest_run_id): the latest run of each source, with the run made unique to the source."""
    return rows.groupBy("source").agg(F.max("ingest_run_id").alias("ingest_run_id"))


def _current(rows: DataFrame) -> DataFrame:
    """Rows of the current run of their own source."""
    run = F.concat_ws("@", "source", F.col("ingest_run_id").cast("string"))
    keyed = rows.withColumn("run", run)
    return snapshots.in_current_runs(keyed, current_runs(rows).select(run.alias("ingest_run_id")), "run").drop("run")


def building_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = summaries.building_summaries(_current(listings(spark, sf_dir)), buildings(spark, sf_dir), F.lit(AS_OF).cast("date"))
    return s.withColumns({"layout_types": F.array_join("layout_types", ","), "move_in_dates": F.array_join("move_in_dates", ",")})


def _mode(col: str, out: str) -> str:
    return f"{out} as (select building_key, v as {out} from (select building_key, {col} as v, row_number() over (partition by building_key order by count(*) desc, {col}) as r from cur where coalesce({col}, '') <> '' group by building_key, {col}) where r = 1)"


def _age(col: str, out: str) -> str:
    return f"""{out}_c as (select building_key, {col} as v, count(*) as n, max(count(*)) over (partition by building_key) as top from cur where {col} is not null
        group by building_key, {col}),
         {out} as (select building_key, case when count(*) filter (n = top) = 1 then max(v) filter (n = top) else any_value(med) end::bigint as {out}
                   from {out}_c join (select building_key, trunc(median({col}))::bigint as med from cur where {col} is not null
                       group by building_key) using (building_key) group by building_key)"""


def _years(col: str) -> str:
    return f"case when {col} is not null then greatest(((2002 * 12 + 3 - (substr({col}, 1, 4)::int * 12 + substr({col}, 6)::int)) // 12)::int, 0) end"


BUILDING_SUMMARY_SQL = f"""
    with listings as ({_LISTINGS.format(**_DUCK)}), b as ({_BUILDINGS.format(**_DUCK)}),
         cur as (select l.* from listings l join (select source, max(ingest_run_id) as ingest_run_id from listings group by source) using (source, ingest_run_id)),
         {_mode('structure', 'l_structure')}, {_mode('structure_raw', 'l_structure_raw')}, {_mode('built_year_month', 'l_built')},
         {_age('age_years', 'l_age')}, {_age('built_age_years', 'l_built_age')},
         g as (select building_key, count(*) as n, min(rent_yen) as rent_min, max(rent_yen) as rent_max, min(area_sqm) as area_sqm_min, max(area_sqm) as area_sqm_max,
                      array_to_string(list_sort(list(distinct layout)), ',') as layout_types,
                          array_to_string(list_sort(coalesce(list(distinct move_in_date) filter (move_in_date is not null), [])), ',') as move_in_dates,
                      max(updated_at) as last_updated, max_by(name, id) as f_name, max_by(address, id) as f_address,
                      coalesce(case when bool_or(availability_flag_immediate = 1 or contains(availability_raw, '即入')) then '入居' end,
                          strftime(min(try_cast(availability_date as date)), '%Y-%m-%d'), min(move_in_date),
                               max_by(availability_raw, id) filter (contains(availability_raw, '退去予定')), max_by(availability_raw, id) filter (availability_raw not in ('',
                                   '-', '--', '- -', 'なし')), '') as label
               from cur group by building_key),
         j as (select coalesce(g.building_key, b.building_id) as building_key, * exclude (building_key), coalesce(b.built_year_month, b.built_year || '-01') as b_built,
             coalesce(property_kind, '') as kind, coalesce(n, 0) as vacancies
               from g full join b on g.building_key = b.building_id left join l_structure using (building_key) left join l_structure_raw using (building_key) left
                   join l_built using (building_key) left join l_age using (building_key) left join l_built_age using (building_key)),
         k as (select *, coalesce({_years('l_built')}, l_built_age, {_years('b_built')}, age_years)::bigint as age from j)
    select building_key, case when building_id is not null then canonical_name else f_name end as name,
        case when building_id is not null then canonical_address else f_address end as address, kind as property_kind,
           coalesce(rent_min, case when kind <> 'bunjo' then avg_rent_yen end) as rent_yen_min, coalesce(rent_max,
               case when kind <> 'bunjo' then avg_rent_yen end) as rent_yen_max, area_sqm_min, area_sqm_max,
           coalesce(layout_types, '') as layout_types, coalesce(move_in_dates, '') as move_in_dates, coalesce(age, l_age) as age_years, coalesce(l_structure,
               structure) as structure,
           coalesce(l_built, b_built) as building_built_year_month, age as building_built_age_years, coalesce(l_structure_raw, l_structure,
               structure) as building_structure,
           case when kind <> 'bunjo' and vacancies > 0 then coalesce(nullif(label, ''), nullif(availability_label, '')) end as building_availability_label,
               vacancies::bigint as vacancy_count,
           sale_price_yen_min, sale_price_yen_max, sale_price_yen_avg, sale_listing_count, last_updated
    from k"""


def summary_mode_median_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("int").alias("quantity"))
    return summaries.mode_or_median(rows, ["l_partkey"], "quantity", "pick")


def summary_mode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(summaries.mode_text(F.col("o_orderpriority")).alias("priority"))


def summary_distinct_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("v"))
    return rows.groupBy("l_suppkey").agg(F.array_join(summaries.sorted_set(F.col("v")), ",").alias("values"))


def summary_priority_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    label = summaries.availability_label(F.lit(0), F.replace("availability_raw", F.lit("即入"), F.lit("")), F.col("availability_date"), F.col("move_in_date"), F.col("id"))
    return rows.groupBy("building_key").agg(label.alias("label"))


def current_snapshot_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(listings(spark, sf_dir)).select("id", "source", "ingest_run_id")


def rows_without_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No pointer at all: rows that belong to no run are the ones that count."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.year("o_orderdate")).alias("ingest_run_id"))
    none = spark.createDataFrame([], "source string, ingest_run_id int")
    return snapshots.in_current_runs(rows, none).select("o_orderkey")


def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = table(spark, sf_dir, "customer").where("c_custkey % 4 = 1").select(F.col("c_custkey").alias("alias_key"), (F.col("c_custkey") - 1).alias("canonical_key"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("building_key"))
    return snapshots.resolved(rows, aliases).groupBy("building_key").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("latest"))


def orphan_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 3").select(F.col("c_custkey").alias("building_id"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("building_key"), "o_orderkey")
    return snapshots.orphans(rows, known).select("o_orderkey", "building_key")


def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(table(spark, sf_dir, "part"), "p_name", "p_brand")


def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    date = F.when(F.col("event_id") % 4 == 0, F.col("ts"))
    return quality.availability_counts(rows, F.col("event_type"), F.when(F.col("event_id") % 3 > 0, F.col("props")), F.col("value") > 100, date)


def top_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_partkey") % 5 == 0, " ").otherwise(F.col("p_type")))
    return quality.top_values(rows, ["p_name", "p_brand", "p_type"], 5)


def run_drop_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.orderBy("day"))  # one row a day
    return days.withColumn("before", before).withColumn("drop_percent", quality.drop_percent(F.col("before"), F.col("n"))).select("day", "n", "before", "drop_percent")


def doctor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    b = p.select(F.col("p_partkey").cast("string").alias("building_id"), F.col("p_name").alias("norm_name"),
        F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).otherwise("").alias("norm_address"),
        F.concat_ws("-", "p_brand", "p_type", F.col("p_size").cast("string")).alias("canonical_address"))
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).cast("string").alias("building_key"))
    return quality.doctor(b, rows, unmatched=3)


def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of files (their sources, and one file without rows); texts of pages stand for names."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    name = F.when(k % 9 == 0, "12").when(k % 9 == 1, "").when(k % 9 == 2, "A》").when(k % 9 == 3, "3号").when(k % 9 == 4, "3号棟").when(k % 9 == 5,
        F.concat(F.lit("NEW "), F.col("lang"))).otherwise(F.col("text"))
    category = F.when(F.col("lang") == "en", "ulucks").otherwise("realpro")
    rows = d.select(
        "source", category.alias("category"), name.alias("name"), F.when(k % 40 == 0, "1,500円").when(k % 30 == 0, "").otherwise(F.col("lang")).alias("address"),
        F.when(k % 20 < 11, "").otherwise("101").alias("room"),
    )
    files = d.select("source").unionByName(spark.range(1).select(F.lit("none").alias("source")))
    q = quality.qc(rows, "source", F.col("category"), F.col("name"), F.col("address"), F.col("room"), files)
    return q.select("source", "rows", F.array_join("reasons", ",").alias("reasons"))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "part", "supplier", "events")})


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_pairs(table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_partkey") % 9 > 0, F.col("p_type"))), "p_brand", "p_type")


QUERIES = {f.__name__: f for f in (building_summary, summary_mode_median_age, summary_mode_text, summary_distinct_sets, summary_priority_label, current_snapshot_filter,
    rows_without_run, alias_resolution, orphan_listings, duplicate_groups, conditional_counts, top_value_counts, run_drop_ratio, doctor_report, qc_report, table_counts,
    distinct_pairs)}

_TOP = "union all select '{0}' as c, coalesce(nullif(trim({1}), ''), '<empty>') as v from part"
_COUNT = " union all ".join(f"select '{n}' as \"table\", count(*) as rows from {n}" for n in ("customer", "orders", "lineitem", "part", "supplier", "events"))
_LABEL = """coalesce(strftime(min(try_cast(availability_date as date)), '%Y-%m-%d'), min(move_in_date), max_by(a, id) filter (contains(a, '退去予定')), max_by(a, id) filter (a not in ('', '-', '--', '- -', 'なし')), '')"""

ORACLE_SQL = {
    "building_summary": BUILDING_SUMMARY_SQL,
    "summary_mode_median_age": """
        with q as (select l_partkey, l_quantity::int as v from lineitem), c as (select l_partkey, v, count(*) as n, max(count(*)) over (partition by l_partkey) as top
            from q group by l_partkey, v),
             m as (select l_partkey, trunc(median(v))::bigint as med from q group by l_partkey)
        select l_partkey, case when count(*) filter (n = top) = 1 then max(v) filter (n = top) else any_value(med) end::bigint as pick from c join m using (l_partkey)
            group by l_partkey""",
    "summary_mode_text": """
        select o_custkey, o_orderpriority as priority
            from (select o_custkey, o_orderpriority, row_number() over (partition by o_custkey order by count(*) desc, o_orderpriority) as r from orders
                group by o_custkey, o_orderpriority) where r = 1""",
    "summary_distinct_sets": "select l_suppkey, array_to_string(list_sort(list(distinct l_returnflag || l_linestatus)), ',') as \"values\" from lineitem group by l_suppkey",
    "summary_priority_label": f"with l as (select *, replace(availability_raw, '即入', '') as a from ({_LISTINGS.format(**_DUCK)})) select building_key, {_LABEL} as label from l group by building_key",
    "current_snapshot_filter": f"with l as ({_LISTINGS.format(**_DUCK)}) select id, source, ingest_run_id from l join (select source, max(ingest_run_id) as ingest_run_id from l group by source) using (source, ingest_run_id)",
    "rows_without_run": "select o_orderkey from orders where o_orderkey % 3 = 0",
    "alias_resolution": "select case when o_custkey % 4 = 1 and o_custkey in (select c_custkey from customer) then o_custkey - 1 else o_custkey end as building_key, count(*) as n, max(o_orderkey) as latest from orders group by 1",
    "orphan_listings": "select o_orderkey, o_custkey as building_key from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_custkey % 7 <> 3)",
    "duplicate_groups": "select p_name, p_brand, count(*) as n from part group by p_name, p_brand having count(*) > 1",
    "conditional_counts": "select event_type as category, count(*) as rows, count(*) filter (event_id % 3 > 0 and props <> '') as filled, count(*) filter (value > 100) as immediate, count(*) filter (event_id % 4 = 0) as dated from events group by event_type",
    "top_value_counts": f"""
        with v as (select 'p_name' as c, coalesce(nullif(trim(p_name), ''), '<empty>') as v
            from part {_TOP.format('p_brand', 'p_brand')} {_TOP.format('p_type', "case when p_partkey % 5 = 0 then ' ' else p_type end")})
        select c as "column", v as value, n from (select c, v, count(*) as n, row_number() over (partition by c order by count(*) desc, v) as r from v group by c, v)
            where r <= 5""",
    "run_drop_ratio": """
        with d as (select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1), b as (select *, lag(n) over (order by day) as before from d)
        select day, n, before, case when before > 0 then round_even((before - n) * 100.0 / before, 0)::int end as drop_percent from b""",
    "doctor_report": """
        with b as (select p_name, case when p_partkey % 3 > 0 then p_brand else '' end as a, concat_ws('-', p_brand, p_type, p_size) as place from part)
        select 'duplicate_name_address' as "check", count(*) as value, case when count(*) > 0 then 'NG' else 'OK' end as level from (select 1 from b where a <> ''
            group by p_name, a having count(*) > 1)
        union all select 'duplicate_address', count(*), case when count(*) > 0 then 'NG' else 'OK' end from (select 1 from b group by place having count(*) > 1)
        union all select 'orphan_listings', count(*), case when count(*) > 0 then 'NG' else 'OK' end from lineitem where l_partkey * 2 not in (select p_partkey from part)
        union all select 'unmatched_facts', 3, 'WARN'""",
    "qc_report": r"""
        with r as (select source, case when lang = 'en' then 'ulucks' else 'realpro' end as category,
            case doc_id % 9 when 0 then '12' when 1 then '' when 2 then 'A》' when 3 then '3号' when 4 then '3号棟' when 5 then 'NEW ' || lang else text end as name,
                          case when doc_id % 40 = 0 then '1,500円' when doc_id % 30 = 0 then '' else lang end as address,
                              case when doc_id % 20 < 11 then '' else '101' end as room from documents),
             g as (select source, count(*) as n, avg((length(coalesce(name, '')) <= 2 or regexp_full_match(name, '[0-9]{2,4}') or contains(name, '》') or (contains(name,
                 '号') and not contains(name, '棟')) or contains(name, 'NEW'))::int) as bad,
                          bool_or(category = 'realpro' and regexp_matches(name, 'TEL|FAX|^[0-9]+/[0-9]+頁$')) as noise, bool_or(regexp_matches(address,
                              '[0-9]{1,3}(,[0-9]{3})+|円|万')) as money, bool_or(address = '') as blank,
                          avg((room = '')::int) as no_room, bool_or(category = 'realpro' and room <> '' and name = '') as nameless from r group by source)
        select source, n as rows, concat_ws(',', case when bad >= 0.2 then 'building_name_bad_ratio=' || format('{:.2f}', bad) end,
            case when noise then 'building_name_contains_noise' end, case when money then 'address_looks_like_money' end,
               case when blank then 'address_empty' end, case when no_room >= 0.5 then 'room_empty_ratio=' || format('{:.2f}', no_room) end,
                   case when nameless then 'building_name_missing_with_room' end) as reasons from g
        union all select 'none', 0, 'extracted_rows=0'""",
    "table_counts": _COUNT,
    "distinct_pairs": """
        select count(*) as rows, count(distinct case when p_partkey % 9 > 0 then p_brand || '|' || p_type else p_brand end) as pairs, 0::bigint as no_a,
            count(*) filter (p_partkey % 9 = 0) as no_b from part""",
}
