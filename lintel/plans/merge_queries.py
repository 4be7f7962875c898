"""Upserts, de-duplication, matching, routing and corrections on the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import corrections as corr
from ..operators import dedupe, ingest, matching, upsert
from .common import table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.floor("o_totalprice").cast("long").alias("price"))


def upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of each customer replaces the stored one; the status stays as stored."""
    o = _orders(spark, sf_dir)
    old = upsert.keep_first(o.where("o_orderkey % 3 = 0"), ["o_custkey"], F.col("o_orderkey"))
    return upsert.overwrite(old, o.where("o_orderkey % 3 > 0").withColumn("seq", F.col("o_orderkey")), ["o_custkey"], "seq", keep=("o_orderstatus",))


def upsert_coalesce_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).otherwise("").alias("event_type"),
        F.when(F.col("event_id") % 4 > 0, F.col("event_id")).alias("last_id"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("stamp"), F.col("event_id").alias("seq"))
    old = e.where("user_id % 2 = 0 and seq < 50").groupBy("user_id").agg(F.lit("old").alias("event_type"), F.lit(-1).cast("long").alias("last_id"),
        F.lit("2024/12/31").alias("stamp"))
    return upsert.coalesce_newest(old, e, ["user_id"], "seq", stamp="stamp")


def _part_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    old = table(spark, sf_dir, "part").select("p_partkey", F.when(k % 3 > 0, F.col("p_brand")).otherwise("").alias("structure"),
        F.when(k % 4 > 0, F.col("p_size")).alias("age_years"), F.when(k % 2 > 0, F.col("p_type")).alias("built_year_month"), F.col("p_name").alias("name"))
    new = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.when(F.col("p_partkey") % 5 > 0, F.max("l_returnflag")).otherwise("")
        .alias("structure"), F.min("l_linenumber").alias("age_years"), F.max("l_linestatus").alias("built_year_month"), F.lit("N").alias("name"))
    return old, new


def update_fill_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.fill_only(*_part_facts(spark, sf_dir), ["p_partkey"], derived="age_years")


def update_overwrite_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.overwrite_present(*_part_facts(spark, sf_dir), ["p_partkey"], protected=("name",))


def facts_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _part_facts(spark, sf_dir)
    k = F.col("p_partkey")
    facts = new.withColumns({"source": F.when(k % 2 == 0, "mansion_review_list").otherwise("orient"), "property_kind": F.when(k % 3 == 0, "bunjo").otherwise("chintai")})
    return upsert.apply_facts(old.withColumn("property_kind", F.lit("")), facts, "p_partkey", overwrite=True)


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings without repeats of their nine describing columns; missing values are equal."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("row"), "l_returnflag", "l_linestatus",
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("tax"), (F.col("l_partkey") % 50).alias("p"))
    return upsert.keep_first(rows, ["l_returnflag", "l_linestatus", "tax", "p"], "file", "row")


def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.keep_last(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "props"), ["user_id", "event_type"], "event_id")


def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share a balance step or a block of keys in a nation, transitively."""
    s = table(spark, sf_dir, "supplier")
    return dedupe.components(s, "s_suppkey", [F.when(F.col("s_suppkey") % 3 > 0, F.floor(F.col("s_acctbal") / 40)),
        F.concat_ws("|", "s_nationkey", F.floor(F.col("s_suppkey") / 9).cast("string"))])


def _merge_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    b = p.select(F.format_string("%09d", "p_partkey").alias("building_id"), F.col("p_name").alias("canonical_name"),
        F.concat_ws("/", "p_name", "p_brand", (F.col("p_size") % 10).cast("string")).alias("canonical_address"), F.col("p_name").alias("norm_name"),
        F.lit("").alias("norm_address"), F.concat("p_type", F.format_string("%09d", "p_partkey")).alias("created_at"))
    counts = p.where("p_partkey % 3 = 0").select(F.format_string("%09d", "p_partkey").alias("building_id"), (F.col("p_partkey") % 6).cast("long").alias("n_listings"))
    return b, counts


def safe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.merge_plan(*_merge_input(spark, sf_dir)).select("component", F.col("size").cast("long").alias("size"), "keep", "drop", "decision", "why")


def merge_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings per building after the merges that a group of only safe pairs allows."""
    b, counts = _merge_input(spark, sf_dir)
    plan = dedupe.merge_plan(b, counts).where("decision = 'merge'")
    rows = table(spark, sf_dir, "lineitem").select(F.format_string("%09d", "l_partkey").alias("building_key"))
    none = spark.createDataFrame([], "alias_key string, canonical_key string")
    _, moved, _, _ = dedupe.apply_merges(plan, b, rows, none)
    return moved.groupBy("building_key").agg(F.count(F.lit(1)).alias("n"))


def _addresses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Buildings at addresses with a lot number; rows that spell them in several ways."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    place = F.concat(F.lit("北九州市小倉北区町"), F.floor(k / 20).cast("string"), F.lit("丁"), (1 + k % 9).cast("string"), F.lit("-"), (1 + F.floor(k / 2) % 9).cast("string"))
    b = s.select(k.cast("string").alias("building_id"), F.lower("s_name").alias("norm_name"), place.alias("norm_address"))
    fused = F.regexp_replace(place, r"(\d)-(\d)$", "$1$2")
    rows = s.select(
        k.alias("row_no"), F.when(k % 5 == 0, F.lit("other tower")).otherwise(F.lower("s_name")).alias("norm_name"),
        F.when(k % 7 == 1, F.concat(place, F.lit("、9"))).when(k % 7 == 2, fused).when(k % 7 == 3, F.lit("北九州市町")).when(k % 7 == 4, F.lit("別市1-2-3")).otherwise(place)
            .alias("norm_address"),
    )
    return b, rows


def address_variant_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first spelling that a building has, and how many have it."""
    b, rows = _addresses(spark, sf_dir)
    t = matching.address_tier(rows.where("not norm_address rlike '、'"), b, "row_no")
    return t.groupBy("row_no").agg(F.min("pos").cast("int").alias("pos"), F.min("variant").alias("variant"), F.count(F.lit(1)).alias("n"))


def source_alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name, place = F.concat(F.lit("n"), (F.col("c_custkey") % 40).cast("string")), F.concat(F.lit("町"), (F.col("c_custkey") % 120).cast("string"), F.lit("-1"))
    sources = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("building_id"), name.alias("norm_name"), place.alias("norm_address"))
    rows = c.select(F.col("c_custkey").alias("row_no"), name.alias("norm_name"), place.alias("norm_address"))
    hits = matching.alias_hits(rows, sources, "row_no")
    return hits.select("row_no", F.size("ids").alias("n"), F.array_join("ids", "|").alias("ids"))


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of suppliers: by name, by name and address, by a shared address, or of nothing."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    place = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit("-"), (k % 5).cast("string"))
    b = s.select(k.cast("string").alias("building_id"), F.col("s_name").alias("canonical_name"), place.alias("canonical_address"), F.lower("s_name").alias("norm_name"),
        place.alias("norm_address"))
    c = s.select(
        k.alias("row_no"), F.when(k % 9 == 0, "odd").otherwise("approved").alias("status"),
            F.when(k % 8 == 0, "drop_duplicate_loser").when(k % 8 == 7, None).otherwise("fix").alias("action"),
        F.when(k % 4 > 0, F.col("s_name")).otherwise("").alias("target_building_name"),
            F.when(k % 4 == 2, place).when(k % 4 == 0, F.concat(place, F.when(k % 3 == 0, "?").otherwise(""))).otherwise("").alias("target_address"),
        F.when(k % 5 == 0, "area").otherwise("address").alias("field"), F.when(k % 6 == 0, "elsewhere").when(k % 6 == 1, place).otherwise("").alias("old_value"),
            F.when(k % 10 == 3, "").otherwise("新住所").alias("new_value"), F.lit("").alias("note"), F.lit("").alias("error_type"),
    )
    return corr.corrected(c, b)


def _parts_as_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("building_id"), F.concat("p_name", "p_brand").alias("norm_name"),
        F.when(F.col("p_partkey") % 3 > 0, F.concat("p_brand", "p_type", F.col("p_size").cast("string"))).otherwise("").alias("norm_address"))


def possible_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corr.possible_duplicates(_parts_as_buildings(spark, sf_dir))


def seed_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    sources = s.select(F.concat(F.lit("e"), F.floor(k / 3).cast("string")).alias("evidence_id"),
        F.when(k % 9 < 6, F.lit("b0")).otherwise(F.concat(F.lit("b"), k.cast("string"))).alias("building_id"))
    rows = s.select(k.alias("row_no"), F.when(k % 4 == 0, F.concat(F.lit("b"), k.cast("string"))).when(k % 4 == 1, None).otherwise(F.concat(F.lit("e"), k.cast("string")))
        .alias("merge_to"))
    return matching.winners(rows, sources)


def keys_sha1_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", keys.sha1_key(F.col("c_name"), F.col("c_mktsegment")).alias("sha1_key"),
        keys.legacy_key(F.col("c_name"), F.col("c_mktsegment")).alias("legacy_key"), keys.building_key(F.col("c_name"), F.col("c_mktsegment")).alias("uuid_key"),
        keys.evidence_key(F.when(F.col("c_custkey") % 2 == 0, " "), F.lit("u"), F.col("c_name")).alias("evidence"))


QUERIES = {f.__name__: f for f in (upsert_overwrite, upsert_coalesce_newest, update_fill_only, update_overwrite_present, facts_by_policy, keep_first, keep_last,
    connected_components, safe_merge, merge_applied, address_variant_match, source_alias_match, corrections, possible_duplicates, seed_winners, keys_sha1_uuid5)}

_FACTS = """
    o as (select p_partkey, case when p_partkey % 3 > 0 then p_brand else '' end as structure, case when p_partkey % 4 > 0 then p_size end as age_years,
        case when p_partkey % 2 > 0 then p_type end as built_year_month, p_name as name from part),
    f as (select l_partkey as p_partkey, case when l_partkey % 5 > 0 then max(l_returnflag) else '' end as structure, min(l_linenumber) as age_years,
        max(l_linestatus) as built_year_month, 'N' as name from lineitem group by l_partkey)"""
_PLAN = """
    b as (select printf('%09d', p_partkey) as id, p_name as name, p_name || '/' || p_brand || '/' || (p_size % 10) as place, p_type || printf('%09d', p_partkey) as made,
        case when p_partkey % 3 = 0 then p_partkey % 6 else 0 end as n from part),
    g as (select min(id) as component, count(*) as size, list(struct_pack(id := id, n := n, made := made) order by id) as bs from b group by place having count(*) > 1),
    q as (select *, bs[1] as x, bs[2] as y from g),
    plan as (select component, size, case when size = 2 then case when x.n > 0 and y.n = 0 then x.id when y.n > 0 and x.n = 0 then y.id when x.n = 0 and y.n = 0 then case
        when x.made < y.made then x.id else y.id end end end as keep,
                    case when size <> 2 then 'size' when x.n > 0 and y.n > 0 then 'both_listed' when x.n = 0 and y.n = 0 then 'same_unlisted'
                        else 'one_listed' end as why, x.id as xi, y.id as yi from q)"""
_PLACE = "'北九州市小倉北区町' || (s_suppkey // 20) || '丁' || (1 + s_suppkey % 9) || '-' || (1 + (s_suppkey // 2) % 9)"

ORACLE_SQL = {
    "upsert_overwrite": """
        with o as (select o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') as day, floor(o_totalprice)::bigint as price from orders),
             old as (select * from o where o_orderkey % 3 = 0 qualify row_number() over (partition by o_custkey order by o_orderkey) = 1), new as (select * from o
                 where o_orderkey % 3 > 0 qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
        select * from old where o_custkey not in (select o_custkey from new)
        union all select new.o_orderkey, new.o_custkey, coalesce(old.o_orderstatus, new.o_orderstatus), new.day, new.price from new left join old using (o_custkey)""",
    "upsert_coalesce_newest": """
        with e as (select user_id, case when event_id % 3 > 0 then event_type end as t, case when event_id % 4 > 0 then event_id end as i, strftime(ts,
            '%Y-%m-%d %H:%M') as s, event_id as q from events),
             a as (select * from e union all select distinct user_id, 'old', -1, '2024/12/31', -1 from e where user_id % 2 = 0 and q < 50)
        select user_id, max_by(t, q) filter (t is not null) as event_type, max_by(i, q) filter (i is not null) as last_id, max(s) as stamp from a group by user_id""",
    "update_fill_only": f"""
        with {_FACTS} select p_partkey, coalesce(nullif(o.structure, ''), f.structure, o.structure) as structure, coalesce(f.age_years, o.age_years) as age_years,
            coalesce(nullif(o.built_year_month, ''), f.built_year_month) as built_year_month, o.name from o left join f using (p_partkey)""",
    "update_overwrite_present": f"""
        with {_FACTS} select p_partkey, coalesce(nullif(f.structure, ''), o.structure) as structure, coalesce(f.age_years, o.age_years) as age_years,
            coalesce(f.built_year_month, o.built_year_month) as built_year_month, o.name from o left join f using (p_partkey)""",
    "facts_by_policy": f"""
        with {_FACTS}, j as (select o.*, f.structure as fs, f.age_years as fa, f.built_year_month as fb, f.name as fn, f.p_partkey is not null as hit,
            p_partkey % 2 = 1 as ow, p_partkey % 2 = 1 or p_partkey % 3 = 0 as al from o left join f using (p_partkey))
        select p_partkey, case when hit and ow then coalesce(nullif(fs, ''), structure) else coalesce(nullif(structure, ''), fs, structure) end as structure,
            case when hit and ow then coalesce(fa, age_years) else coalesce(age_years, fa) end as age_years,
               case when hit and ow then coalesce(fb, built_year_month) else coalesce(built_year_month, fb) end as built_year_month,
                   case when hit and ow and al then fn else name end as name,
               case when hit then case when p_partkey % 3 = 0 then 'bunjo' else 'chintai' end else '' end as property_kind from j""",
    "keep_first": """
        select l_orderkey as file, l_linenumber as "row", l_returnflag, l_linestatus, case when l_tax > 0.02 then l_tax end as tax, l_partkey % 50 as p from lineitem
        qualify row_number() over (partition by l_returnflag, l_linestatus, case when l_tax > 0.02 then l_tax end, l_partkey % 50 order by l_orderkey,
            l_linenumber) = 1""",
    "keep_last": "select user_id, event_type, event_id, props from events qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1",
    "connected_components": """
        with recursive k as (select s_suppkey as n, '0:' || floor(s_acctbal / 40)::bigint as key from supplier where s_suppkey % 3 > 0 union all
            select s_suppkey, '1:' || s_nationkey || '|' || (s_suppkey // 9) from supplier),
             e as (select distinct a.n as a, b.n as b from k a join k b using (key)), r(n, m) as (select n, n from k union select e.b, r.m from r join e on e.a = r.n)
        select n as node, min(m) as component from r group by n""",
    "safe_merge": f"with {_PLAN} select component, size, keep, case when keep = xi then yi when keep = yi then xi end as \"drop\", case when keep is null then 'ambiguous' else 'merge' end as decision, why from plan",
    "merge_applied": f"with {_PLAN}, d as (select case when keep = xi then yi else xi end as old, keep from plan where keep is not null) select coalesce(keep, printf('%09d', l_partkey)) as building_key, count(*) as n from lineitem left join d on old = printf('%09d', l_partkey) group by 1",
    "address_variant_match": f"""
        with b as (select {_PLACE} as v from supplier), r as (select s_suppkey as row_no, s_suppkey % 7 as m, {_PLACE} as p from supplier
            where s_suppkey % 7 not in (1, 3, 4)),
             d as (select row_no, case when m = 2 then regexp_replace(p, '([0-9])-([0-9])$', '\\1\\2') else p end as base, p from r),
             t as (select row_no, 0 as pos, base as v from d union all select row_no, 1, p from d where base <> p), h as (select row_no, pos, v, count(*) as n from t
                 join b using (v) group by all)
        select row_no, pos::int as pos, v as variant, n from h qualify pos = min(pos) over (partition by row_no)""",
    "source_alias_match": """
        with c as (select c_custkey as k, c_custkey % 40 as n, c_custkey % 120 as p from customer), s as (select * from c where k % 3 = 0), r as (select * from c),
             h as (select r.k as row_no, s.k::varchar as id from r join s using (n, p))
        select row_no, count(distinct id)::int as n, array_to_string(list_sort(list(distinct id)), '|') as ids from h group by row_no""",
    "corrections": """
        with s as (select s_suppkey as k, s_name as n, 'N' || s_nationkey || '-' || (s_suppkey % 5) as p from supplier),
             c as (select k as row_no, case when k % 9 = 0 then 'odd' else 'approved' end as status,
                 case when k % 8 = 0 then 'drop_duplicate_loser' when k % 8 = 7 then '' else 'fix' end as action, case when k % 4 > 0 then n else '' end as tn,
                          case when k % 4 = 2 then p when k % 4 = 0 then p || case when k % 3 = 0 then '?' else '' end else '' end as ta,
                              case when k % 5 = 0 then 'area' else 'address' end as field, case when k % 6 = 0 then 'elsewhere' when k % 6 = 1 then p else '' end as old,
                                  case when k % 10 = 3 then '' else '新住所' end as new from s),
             h as (select *, case when action = '' then 'unsupported_action:empty' when status = 'odd' then 'unsupported_status:odd' when action = 'drop_duplicate_loser'
                 then null when field = 'area' then 'unsupported_field:area' when new = '' then 'missing_new_value' end as held from c),
             x as (select row_no, s.k, n, p, 1 as tier from h join s on (tn = '' or n = tn) and (ta = '' or p = ta) and (tn <> '' or ta <> '') where held is null
                   union all select row_no, s.k, n, p, 2 from h join s on n = tn or p = ta or n = old or p = old where held is null),
             y as (select *, count(*) over (partition by row_no) as cnt from (select distinct row_no, k, n, p, tier
                 from x qualify tier = min(tier) over (partition by row_no))),
             j as (select h.*, z.cnt, o.k, o.n, o.p from h left join (select distinct row_no, cnt from y) z using (row_no) left join (select * from y
                 where cnt = 1) o using (row_no)),
             w as (select *, coalesce(held, case when cnt is null then 'not_found' when cnt > 1 then 'ambiguous:' || cnt end,
                 case when action = 'fix' and old <> '' and p <> old then 'old_value_mismatch' end) as why, held is null and cnt = 1 as known from j)
        select row_no, status, case when known then k::varchar else '' end as matched_building_id,
            case when known then case when action = 'fix' then p else '0' end else '' end as before_value,
                case when known then case when action = 'fix' then new else '1' end else '' end as after_value,
               case when why is null then 'applied' else 'held' end as outcome, coalesce(why, case when action = 'fix' then 'ok' else 'hidden_from_public' end) as reason
                   from w""",
    "possible_duplicates": """
        with p as (select p_partkey as k, p_name || p_brand as n, case when p_partkey % 3 > 0 then p_brand || p_type || p_size else '' end as a from part),
             g as (select k as building_id, 'norm_name' as kind, count(*) over w as members, min(k) over w as least from p window w as (partition by n) union all
                 select k, 'norm_address', count(*) over w, min(k) over w from p where a <> '' window w as (partition by a))
        select * from g where members > 1""",
    "seed_winners": """
        with s as (select 'e' || (s_suppkey // 3) as e, case when s_suppkey % 9 < 6 then 'b0' else 'b' || s_suppkey end as b
            from supplier), r as (select s_suppkey as row_no, case s_suppkey % 4 when 0 then 'b' || s_suppkey when 1 then null else 'e' || s_suppkey end as m
                from supplier),
             v as (select e, count(distinct b) as n, min(b) as b from s group by e)
        select row_no, case when n = 1 then v.b when n is null and m in (select b
            from s) then m end as building_id, case when n > 1 then 'ambiguous' when n = 1 or m in (select b from s) then 'resolved' else 'unresolved' end as outcome
                from r left join v on v.e = r.m where m is not null""",
    "keys_sha1_uuid5": """
        with c as (select c_custkey, sha1(c_name || '|' || c_mktsegment) as h,
            sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(c_name || '|' || c_mktsegment)) as u, c_name from customer)
        select c_custkey, h as sha1_key, substr(h, 1, 32) as legacy_key, substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-5' || substr(u, 14,
            3) || '-' || substr('89ab89ab89ab89ab', 1 + strpos('0123456789abcdef', substr(u, 17, 1))::int - 1, 1) || substr(u, 18, 3) || '-' || substr(u, 21,
                12) as uuid_key, 'u#r=' || substr(sha1(c_name), 1, 16) as evidence from c""",
}
