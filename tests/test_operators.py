"""Operators against plain loops on random rows, and on literal cases."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from lintel.operators import corrections, dedupe, ingest, matching, quality, serve, snapshots, summaries, upsert

LISTING = "id long, building_key string, name string, address string, rent_yen long, area_sqm double, layout string, move_in_date string, updated_at string, age_years int, structure string, availability_raw string, structure_raw string, built_year_month string, built_age_years int, availability_date string, availability_flag_immediate int, ingest_run_id long"
BUILDING = "building_id string, canonical_name string, canonical_address string, structure string, age_years int, built_year int, built_year_month string, availability_label string, property_kind string, sale_price_yen_min long, sale_price_yen_max long, sale_price_yen_avg long, sale_listing_count int, avg_rent_yen long"


def listing(i, key="b", **more):
    base = dict.fromkeys([c.split()[0] for c in LISTING.split(", ")])
    return {**base, "id": i, "building_key": key, **more}


def frame(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def summary(spark, rows, buildings=()):
    s = summaries.building_summaries(summaries.prepared_listings(frame(spark, rows, LISTING)), frame(spark, buildings, BUILDING), F.lit("2026-03-01").cast("date"))
    return {r["building_key"]: r for r in s.collect()}


def test_mode_or_median(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([None, 1, 2, 3, 10, 11])) for k in range(60) for _ in range(rng.randint(1, 7))]
    got = {r["k"]: r["x"] for r in summaries.mode_or_median(spark.createDataFrame(rows, "k int, v int"), ["k"], "v", "x").collect()}
    for k in range(60):
        vs = [v for j, v in rows if j == k and v is not None]
        if vs:
            top = max(Counter(vs).values())
            modes = [v for v, n in Counter(vs).items() if n == top]
            assert got[k] == (modes[0] if len(modes) == 1 else int(median(vs)))
        else:
            assert k not in got
    tie = spark.createDataFrame([(1, v) for v in (10, 12, 10, 12)], "k int, v int")
    assert summaries.mode_or_median(tie, ["k"], "v", "x").first()["x"] == 11


def test_summary_labels(spark):
    label = lambda *rows: summary(spark, [listing(i, **r) for i, r in enumerate(rows)])["b"]["building_availability_label"]
    assert label({"availability_raw": "即入居"}, {"availability_date": "2026-05-01"}) == "入居"
    assert label({"availability_date": "2026-05-01"}, {"availability_date": "2026-04-09"}, {"availability_date": "bad"}) == "2026-04-09"
    assert label({"move_in_date": "5月"}, {"move_in_date": "4月"}, {"availability_raw": "退去予定"}) == "4月"
    assert label({"availability_raw": "a 退去予定"}, {"availability_raw": "b 退去予定"}, {"availability_raw": "相談"}) == "b 退去予定"
    assert label({"availability_raw": "-"}, {"availability_raw": "相談"}, {"availability_raw": "なし"}) == "相談"
    assert label({"availability_raw": "なし"}) is None


def test_summary_fallbacks(spark):
    b = [{"building_id": "b", "canonical_name": "N", "canonical_address": "A", "structure": "RC", "age_years": 9, "built_year": 2016, "avg_rent_yen": 5,
        "availability_label": "x"},
         {"building_id": "sale", "property_kind": "bunjo", "avg_rent_yen": 7, "availability_label": "y"}]
    got = summary(spark, [listing(1, "b", rent_yen=10, layout="1K", area_sqm=20.0, updated_at="2026/01/01"),
        listing(2, "b", rent_yen=8, layout=" ", updated_at="2026-12-31"), listing(3, "new", name="first", structure=" ＲＣ "), listing(4, "new", name="last"),
        listing(5, "sale"), listing(6, "")], b)
    assert set(got) == {"b", "sale", "new"}
    r = got["b"]
    assert (r["name"], r["rent_yen_min"], r["rent_yen_max"], r["layout_types"], r["structure"], r["building_built_year_month"], r["age_years"], r["vacancy_count"],
        r["last_updated"]) == ("N", 8, 10, ["", "1K"], "RC", "2016-01", 10, 2, "2026/01/01")
    assert (got["new"]["name"], got["new"]["structure"], got["sale"]["rent_yen_min"], got["sale"]["building_availability_label"]) == ("last", "RC", None, None)
    empty = summary(spark, [], b)
    assert (empty["b"]["vacancy_count"], empty["b"]["rent_yen_max"], empty["b"]["building_availability_label"]) == (0, 5, None)


def test_snapshots(spark):
    rows = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, ingest_run_id long")
    current = spark.createDataFrame([("a", 11)], "source string, ingest_run_id long")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(snapshots.in_current_runs(rows, current)) == [2]
    assert ids(snapshots.in_current_runs(rows, current.limit(0))) == [3]
    runs = spark.createDataFrame([(10, "a", "k", "running")], "id long, source string, snapshot_key string, status string")
    runs, same = snapshots.started(runs, "a", "k")
    runs, new = snapshots.started(runs, "a", "k2")
    assert (same, new) == (10, 11)
    with pytest.raises(ValueError, match="not completed"):
        snapshots.switched(current, runs, "a", 10)
    moved = snapshots.switched(current, snapshots.finished(runs, 10), "a", 10)
    assert [tuple(r) for r in moved.collect()] == [("a", 10)]


def test_resolved_is_one_hop(spark):
    rows = spark.createDataFrame([(1, "a", "l1"), (2, "z", "l2"), (3, "q", "l3")], "id int, building_key string, legacy string")
    aliases = spark.createDataFrame([("a", "b"), ("b", "c"), ("l2", "y")], "alias_key string, canonical_key string")
    got = {r["id"]: r["building_key"] for r in snapshots.resolved(rows, aliases, legacy="legacy").collect()}
    assert got == {1: "b", 2: "y", 3: "q"}


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", None, "2026/01/01"), (2, "", 5, "2026-01-01")], "k int, s string, n int, t string")
    new = spark.createDataFrame([(1, "", 7, "2026-12-31", 1), (1, "c", None, "", 2), (3, "d", 1, "x", 3)], "k int, s string, n int, t string, seq long")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(upsert.overwrite(old, new, ["k"], "seq")) == [(1, "c", None, ""), (2, "", 5, "2026-01-01"), (3, "d", 1, "x")]
    assert rows(upsert.overwrite(old, new, ["k"], "seq", keep=("s",)))[0] == (1, "a", None, "")
    assert rows(upsert.coalesce_newest(old, new, ["k"], "seq", stamp="t"))[0] == (1, "c", 7, "2026/01/01")
    one = spark.createDataFrame([(1, "z", 9, "t"), (2, "y", 8, "")], "k int, s string, n int, t string")
    assert rows(upsert.fill_only(old, one, ["k"])) == [(1, "a", 9, "2026/01/01"), (2, "y", 5, "2026-01-01")]
    assert rows(upsert.overwrite_present(old, one, ["k"], protected=("s",))) == [(1, "a", 9, "t"), (2, "y", 8, "2026-01-01")]


def test_components_against_union_find(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, *"abcdefghijklmnop"]), rng.choice([None, *range(25)])) for i in range(60)] + [(100 + i, f"x{i}", 1000 + (i + 1) // 2) for i
        in range(30)] + [(200 + i, f"y{(i + 1) // 2}", 2000 + i // 2) for i in range(40)]
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a, b in rows:
        for j, c, d in rows:
            if (a is not None and a == c) or (b is not None and b == d):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    df = spark.createDataFrame(rows, "id long, a string, b long").repartition(3)
    got = {r["node"]: r["component"] for r in dedupe.components(df, "id", [F.col("a"), F.col("b")]).collect()}
    assert got == {i: find(i) for i in root}


def test_merges(spark):
    schema = "building_id string, canonical_name string, canonical_address string, norm_name string, norm_address string, created_at string"
    rows = [("a1", "N", "A", "n", "a", "2"), ("a2", "N", "A", "n", "a", "1"), ("b1", "Ｘ y", "B", "x", "b", "1"), ("b2", "ｘY", "B", "x", "b", "0"),
        ("c", "C", "C", "c", "c", "1")]
    b, counts = spark.createDataFrame(rows, schema), spark.createDataFrame([("a1", 3)], "building_id string, n_listings long")
    plan = dedupe.merge_plan(b, counts)
    got = {r["component"]: (r["keep"], r["drop"], r["decision"]) for r in plan.collect()}
    assert got["a1"] == ("a1", "a2", "merge") and got["b1"][2] in ("merge", "ambiguous")
    rows = spark.createDataFrame([("a2", 1), ("c", 2)], "building_key string, id int")
    none = spark.createDataFrame([], "alias_key string, canonical_key string")
    left, moved, aliases, done = dedupe.apply_merges(plan.where("component = 'a1'"), b, rows, none)
    assert done and left.count() == 4 and {r["building_key"] for r in moved.collect()} == {"a1", "c"} and [tuple(r) for r in aliases.collect()] == [("a2", "a1")]
    third = b.unionByName(spark.createDataFrame([("a3", "N", "A", "n", "a", "2")], schema))
    assert dedupe.apply_merges(dedupe.merge_plan(third, counts), third, rows, none)[3] is False


def match_one(buildings, sources, name, place):
    """The rules of the matcher for one row, by loops."""
    from difflib import SequenceMatcher

    ratio = lambda a, b: SequenceMatcher(None, a, b).ratio()
    if "、" in place or "〜" in place:
        return None, "address_multi_or_range"
    forms = [place]
    head = place.rstrip("0123456789")
    digits = place[len(head):]
    if len(digits) in (2, 4):
        forms.append(head + digits[: len(digits) // 2] + "-" + digits[len(digits) // 2 :])
    homes = {b[0]: b for b in buildings}
    hits = sorted({s[0] for s in sources if s[0] in homes and s[1] == name and name and homes[s[0]][2] in forms})
    if hits:
        return (hits[0], "alias_exact") if len(hits) == 1 else (None, "alias_ambiguous")
    if not any(c.isdigit() for c in place):
        return None, "address_without_digits"
    for k, form in enumerate(forms):
        found = [b for b in buildings if b[2] == form]
        if len(found) == 1:
            if k == 0:
                return found[0][0], "address_exact"
            return (found[0][0], "address_variant_exact") if ratio(name, found[0][1]) >= 0.88 else (None, "address_name_low_confidence")
        if found:
            best = sorted(((ratio(name, b[1]) * 0.7 + 0.3, ratio(name, b[1]), b[0]) for b in found), key=lambda x: (-x[0], x[2]))
            if best[0][1] >= 0.88 and best[0][0] >= 0.91 and best[0][0] - best[1][0] >= 0.02:
                return best[0][2], "address_variant_match" if k else "address_exact"
            return None, "address_candidates_low_confidence"
    return None, "unmatched"


def test_matcher_against_loops(spark):
    rng = random.Random(5)
    names, places = ["メゾン", "メゾンA", "メゾンAB", "ハイツ", "ハイツ北九州館", "ハイツ北九州舘"], ["町83", "町8-3", "町1234", "町12-34", "町5", "町", "町1、2", "町1〜2"]
    buildings = [(f"b{i:02}", rng.choice(names), rng.choice(places[:6])) for i in range(14)]
    sources = [(f"b{rng.randrange(16):02}", rng.choice(names)) for _ in range(6)]
    rows = [(i, rng.choice(names), rng.choice(places)) for i in range(120)]
    b = spark.createDataFrame(buildings, "building_id string, norm_name string, norm_address string")
    s = spark.createDataFrame(sources, "building_id string, norm_name string").join(b.select("building_id", "norm_address"), "building_id")
    got = {r["row_no"]: (r["building_id"], r["reason"]) for r in matching.match_rows(spark.createDataFrame(rows, "row_no long, norm_name string, norm_address string"), b,
        s).collect()}
    assert got == {i: match_one(buildings, sources, n, p) for i, n, p in rows}


def close(buildings, name, place):
    from difflib import SequenceMatcher

    found = sorted((s for b in buildings if (s := SequenceMatcher(None, name, b[1]).ratio() * 0.65 + SequenceMatcher(None, place, b[2]).ratio() * 0.35) >= 0.82),
        reverse=True)
    return bool(found) and (found[0] >= 0.9 or (len(found) > 1 and found[0] - found[1] < 0.03))


def test_close_conflicts_against_loops(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    buildings = [(f"b{i}", word(rng.randint(1, 9)), word(rng.randint(0, 8))) for i in range(40)]
    rows = [(i, *(rng.choice(buildings)[1:] if rng.random() < 0.3 else (word(rng.randint(1, 9)), word(rng.randint(0, 8))))) for i in range(80)]
    rows = [(i, n if rng.random() < 0.6 else n + "b", p) for i, n, p in rows]
    got = {r["row_no"] for r in matching.close_conflicts(spark.createDataFrame(rows, "row_no long, norm_name string, norm_address string"),
        spark.createDataFrame(buildings, "building_id string, norm_name string, norm_address string")).collect()}
    assert got == {i for i, n, p in rows if close(buildings, n, p)}


def test_ingest_equals_reading_row_by_row(spark):
    import uuid

    rng = random.Random(11)
    names, places = ["メゾン北", "メゾン北九", "ハイツ南館", "ハイツ東館", "棟"], [f"北九州市小倉北区町{a}-{b}-1" for a in (1, 2) for b in (3, 4)] + ["北九州市小倉北区町1-31", "小倉"]
    raw = [(i, "ulucks", rng.choice(names), rng.choice(places), f"e{i}") for i in range(45)] + [(45, "seed", "x", "y", "e"), (46, "ulucks", "", " ", "e46")]
    buildings, sources, aliases, want = [("old", "ハイツ南館", places[0])], [], {}, {}
    for i, category, name, place, _ in raw:
        if category == "seed":
            continue
        if not name.strip() and not place.strip():
            want[i] = (None, "unmatched", "missing_name_and_address")
            continue
        key = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}|{place}"))
        matched, reason = match_one(buildings, sources, name, place)
        bid, route = aliases.get(key) or matched, "attached"
        if not bid:
            parts = [p for p in place.split("-") if p.isdigit()]
            block = "name_looks_like_unit" if len(name) <= 2 else "address_not_granular" if len(parts) < 2 or len(place) < 10 else "close_conflicting_candidate" if close(buildings, name, place) else None
            if reason != "unmatched":
                want[i] = (None, "suspect", reason)
                continue
            if block:
                want[i] = (None, "unmatched", f"unmatched_canonical_building:{block}")
                continue
            bid, route = key, "seeded"
            buildings.append((key, name, place))
        aliases[key] = bid
        sources.append((bid, name))
        want[i] = (bid, route, reason)
    rows = ingest.incoming(spark.createDataFrame(raw, "row_no long, category string, building_name string, address string, evidence_id string"))
    b = spark.createDataFrame([("old", "ハイツ南館", places[0])], "building_id string, norm_name string, norm_address string")
    out = ingest.ingest(rows, b, b.select("building_id", "norm_name").limit(0), spark.createDataFrame([], "alias_key string, canonical_key string")).cache()
    assert {r["row_no"]: (r["building_id"], r["route"], r["reason"]) for r in out.collect()} == want
    c = ingest.counters(out).first()
    assert c["auto_seeded"] == sum(r == "seeded" for _, r, _ in want.values()) and c["unresolved"] == sum(b is None for b, _, _ in want.values())
    q = ingest.review(out, rows, "s").groupBy("queue").count().collect()
    assert {r["queue"]: r["count"] for r in q} == {k: v for k, v in {"suspects": c["suspects"], "unmatched": c["unresolved"]}.items() if v}


def test_rounds_of_ingest_do_not_grow_with_the_rows_of_a_building(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(ingest, "match_rows", lambda *a, f=ingest.match_rows, **b: calls.append(1) or f(*a, **b))
    raw = [(i, "ulucks", "東東東東東", f"北九州市小倉北区町1-{1 + (i > 0)}-5", f"e{i}") for i in range(13)]
    rows = ingest.incoming(spark.createDataFrame(raw, "row_no long, category string, building_name string, address string, evidence_id string"))
    b = spark.createDataFrame([], "building_id string, norm_name string, norm_address string")
    out = ingest.ingest(rows, b, b.select("building_id", "norm_name"), spark.createDataFrame([], "alias_key string, canonical_key string"))
    got = {r["row_no"]: (r["route"], r["reason"]) for r in out.collect()}
    assert got == {0: ("seeded", "unmatched"), **dict.fromkeys(range(1, 13), ("unmatched", "unmatched_canonical_building:close_conflicting_candidate"))}
    assert len(calls) <= 4


def one_building(spark, monkeypatch):
    """Outcome and rows of a building whose first row alone has another address, and the rounds it took."""
    calls = []
    monkeypatch.setattr(ingest, "match_rows", lambda *a, f=ingest.match_rows, **b: calls.append(1) or f(*a, **b))
    raw = [(i, "ulucks", "西西西西西", f"北九州市小倉北区町1-{1 + (i > 0)}-5", f"e{i}") for i in range(9)]
    rows = ingest.incoming(spark.createDataFrame(raw, "row_no long, category string, building_name string, address string, evidence_id string"))
    b = spark.createDataFrame([], "building_id string, norm_name string, norm_address string")
    return ingest.ingest(rows, b, b.select("building_id", "norm_name"), spark.createDataFrame([], "alias_key string, canonical_key string")), rows, len(calls)


def test_review_of_one_building_in_few_rounds(spark, monkeypatch):
    out, rows, rounds = one_building(spark, monkeypatch)
    q = ingest.review(out, rows, "s").collect()
    assert sorted(r["source_id"] for r in q) == [f"e{i}" for i in range(1, 9)] and {r["queue"] for r in q} == {"unmatched"}
    assert rounds <= 4


def test_counters_of_one_building_in_few_rounds(spark, monkeypatch):
    out, _, rounds = one_building(spark, monkeypatch)
    assert ingest.counters(out).first().asDict() == {"attached": 1, "auto_seeded": 1, "auto_seed_blocked": 8, "suspects": 0, "unresolved": 8}
    assert rounds <= 4


def test_review_reads_kept_rows(spark, tmp_path):
    raw = [(i, "ulucks", "西西西西西", f"北九州市小倉北区町1-{1 + (i > 0)}-5", f"e{i}") for i in range(3)]
    spark.createDataFrame(raw, "row_no long, category string, building_name string, address string, evidence_id string").write.parquet(f"{tmp_path}/raw")
    rows = ingest.kept(ingest.incoming(spark.read.parquet(f"{tmp_path}/raw")))
    b = spark.createDataFrame([], "building_id string, norm_name string, norm_address string")
    out = ingest.ingest(rows, b, b.select("building_id", "norm_name"), spark.createDataFrame([], "alias_key string, canonical_key string"), written=True)
    q = ingest.review(out, rows, "s")
    assert [r["source_id"] for r in q.orderBy("source_id").collect()] == ["e1", "e2"]
    assert q.inputFiles() and not any(f"{tmp_path}/raw" in f for f in q.inputFiles())


def test_steps_of_ingest_release_what_was_run(spark, monkeypatch):
    written, released = [], []
    monkeypatch.setattr(ingest._Steps, "kept", lambda s, df, f=ingest._Steps.kept: written.append(1) or f(s, df))
    monkeypatch.setattr(ingest._Steps, "release", lambda s, f=ingest._Steps.release: released.append(len(written)) or f(s))
    out, _, _ = one_building(spark, monkeypatch)
    assert ingest.counters(out).first()["attached"] == 1
    assert set(released) == set(range(1, len(written) + 1))


def test_corrections(spark):
    schema = "row_no long, status string, action string, target_building_name string, target_address string, field string, old_value string, new_value string, note string, error_type string"
    b = spark.createDataFrame([("1", "A", "町1", "a", "町1", 0), ("2", "B", "町2", "b", "町2", 0), ("3", "B", "町3", "b", "町3", 0)],
        "building_id string, canonical_name string, canonical_address string, norm_name string, norm_address string, hidden_from_public int")
    rows = [(2, "approved", "fix", "A", "", "address", "町1", "福岡県 町９", "", ""), (3, "approved", "fix", "B", "", "address", "", "x", "", ""),
        (4, "approved", "drop_duplicate_loser", "B", "町3", "", "", "", "", ""), (5, "approved", "fix", "Z", "", "building_name", "B", "x", "", ""),
            (6, "approved", "fix", "A", "", "address", "else", "x", "", ""), (7, "new", "fix", "A", "", "address", "", "x", "", ""),
                (8, "pending", None, "", "", "", "", "", "", ""), (9, "pending", "fix", "CITRUS TREE", "", "address", "", "x", "枝番未確認", "address_incomplete"),
                (10, "pending", "fix", "Q", "", "building_name", "町2", "C", "", "")]
    c = spark.createDataFrame(rows, schema)
    res = corrections.corrected(c, b)
    assert {r["row_no"]: (r["outcome"], r["reason"], r["matched_building_id"]) for r in res.collect()} == {
        2: ("applied", "ok", "1"), 3: ("held", "ambiguous:2", ""), 4: ("applied", "hidden_from_public", "3"), 5: ("held", "ambiguous:2", ""),
            6: ("held", "old_value_mismatch", "1"), 7: ("held", "unsupported_status:new", ""),
        8: ("held", "unsupported_action:empty", ""), 9: ("held", "hold_citrus_tree_incomplete_address", ""), 10: ("held", "old_value_mismatch", "2")}
    after = {r["building_id"]: r for r in corrections.applied(res, c, b).collect()}
    assert after["1"]["canonical_address"] == "福岡県町9" and after["1"]["norm_address"] == "町9" and after["3"]["hidden_from_public"] == 1
    assert {r["outcome"] for r in corrections.corrected(c, b, apply=False).collect()} == {"held", "dry_run"}


def test_gates(spark):
    assert quality.weekly_gate(0, 201, 100, 0) == ["nothing_attached", "too_many_unresolved", "collapsed", "dropped"]
    assert quality.weekly_gate(5, 200, 100, 41) == []
    rep = spark.createDataFrame([("f", ["room_empty_ratio=0.60"])], "file string, reasons array<string>")
    assert quality.qc_stops(rep, "strict") and not quality.qc_stops(rep, "strict", ("room_empty_ratio",)) and not quality.qc_stops(rep, "warn")
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 3)], "x int, y int")
    assert [tuple(r) for r in quality.same_build(a, b).collect()] == [("y", "2", "3")]


def test_serving(spark):
    df = spark.createDataFrame([("b", " 棟 101号室", ["x 2号室"], None), ("a", "", [], 3)], "id string, name string, tags array<string>, n int")
    clean = serve.sanitized(df)
    assert sorted((r["id"], r["name"], r["tags"]) for r in clean.collect()) == [("a", "", []), ("b", "棟", ["x"])]
    assert [r["json"] for r in serve.payload(clean, ["id", "name", "n"]).collect()] == ['{"id":"a","name":null,"n":3}', '{"id":"b","name":"棟","n":null}']
    assert serve.leaks(df, "name").count() == 1
    with pytest.raises(ValueError, match="limit"):
        serve.rest_page(df, limit=101)
    with pytest.raises(ValueError, match="unknown sort"):
        serve.order_by("x", 1)
    js = spark.createDataFrame([('["a"]',), ("bad",), (None,)], "j string").select(serve.list_or_empty(F.col("j")).alias("l")).collect()
    assert [r["l"] for r in js] == [["a"], [], []]
