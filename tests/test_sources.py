"""Sources and sinks: headers, files, pages, document lines, versioned stores, streams."""

import pytest
from pyspark.sql import functions as F

from lintel.sources import pages, store, text_rows
from lintel.streaming.upserts import upsert_stream


def test_headers(tmp_path, spark):
    p = tmp_path / "a.csv"
    p.write_text("﻿" + ",".join(store.CLASSIC) + "\r\n" + ",".join(["1", "ulucks", "2026/01/01 10:00", '"a ""b"""', "", "x", "5.3", "", "", "1K", "20", "", "RC",
        '"two\nlines"', "e"]) + "\r\n", encoding="utf-8")
    df = store.read_listings(spark, str(p))
    row = df.first()
    assert df.columns == [*store.MASTER, "file"] and row["building_name"] == 'a "b"' and row["raw_block"] == "two\nlines" and row["built_raw"] is None and row["page"] == "1"
    assert len(store.DIALECTS) == 8
    p.write_text("page,category\n1,2\n")
    with pytest.raises(store.HeaderError):
        store.read_listings(spark, str(p))
    store.required_header(["a", "b"], ["a"])
    with pytest.raises(store.HeaderError, match="evidence_id"):
        store.required_header(["building_name", "address"], store.FACTS_REQUIRED)
    assert store.first_name(df, "nope", "room") == "room"


def test_row_numbers(spark):
    df = spark.range(40).repartition(1).orderBy("id").select(F.col("id").cast("string").alias("v"))
    assert [(r["v"], r["row_no"]) for r in store.numbered(df).collect()] == [(str(i), i + 2) for i in range(40)]


def test_csv_sink(tmp_path, spark):
    store.write_csv(spark.createDataFrame([("a", None)], "x string, y string").coalesce(1), str(tmp_path / "o"), ["x", "z", "y"])
    (part,) = (tmp_path / "o").glob("part-*")
    assert part.read_bytes() == b'\xef\xbb\xbf"x","z","y"\r\n"a","",""\r\n'


def test_files(tmp_path, spark):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.html").write_text("<p>a\nb</p>")
    (tmp_path / "in" / "deep" / "b.html").write_text("x")
    (tmp_path / "in" / "c.txt").write_text("y")
    assert sorted(r["html"] for r in store.read_pages(spark, str(tmp_path / "in")).collect()) == ["<p>a\nb</p>", "x"]
    files = store.file_manifest(spark, str(tmp_path / "in"), "*.html")
    assert sorted(r["size"] for r in files.collect()) == [1, 10] and store.latest_file(files).endswith(".html")


def test_lookups(spark):
    cache = spark.createDataFrame([("0beec7b5ea3f0fdbc95d0dd47f3c5bc275da8a33", "<p>")], "key string, html string")
    assert {r["url"]: r["html"] for r in store.cached_pages(spark.createDataFrame([("foo",), ("bar",)], "url string"), cache).collect()} == {"foo": "<p>", "bar": None}
    places = spark.createDataFrame([("町", None, None), ("町1-2", None, None), ("別", 1.0, 2.0)], "address string, lat double, lng double")
    geo = spark.createDataFrame([("町", 3.0, 4.0), ("町1-2", 5.0, 6.0), ("別", 7.0, 8.0)], "query string, lat double, lng double")
    assert {r["address"]: (r["lat"], r["lng"]) for r in store.geocoded(places, geo).collect()} == {"町": (3.0, 4.0), "町1-2": (None, None), "別": (1.0, 2.0)}


def test_store(tmp_path, spark):
    s = store.Store(spark, f"file://{tmp_path}/db")
    assert s.current() == {}
    s.publish({"a": spark.range(3), "b": spark.range(1)})
    first = s.current()
    with pytest.raises(ValueError, match="no rows"):
        s.publish({"a": spark.range(0)}, not_empty=["a"])
    assert s.current() == first and s.read("a").count() == 3
    s.publish({"a": spark.range(5)})
    assert s.read("a").count() == 5 and s.current()["b"] == first["b"]


def test_schema_evolution(spark):
    want = spark.createDataFrame([], "a int, b string").schema
    got = store.conform(spark.createDataFrame([("1", 2)], "a string, x int"), want)
    assert got.dtypes == [("a", "int"), ("b", "string"), ("x", "int")] and got.first() == (1, None, 2)
    assert store.migrated(spark.createDataFrame([("1",)], "old string"), {"old": "b"}, want).first() == (None, "1")


def test_stream_upsert(tmp_path, spark):
    s = store.Store(spark, f"file://{tmp_path}/db")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, seq long").coalesce(1).write.parquet(str(tmp_path / "in"))

    def run():
        rows = spark.readStream.schema("k int, v string, seq long").parquet(str(tmp_path / "in"))
        q = upsert_stream(rows, s, "t", ["k"], "seq", str(tmp_path / "cp"))
        q.awaitTermination(120)
        return {r["k"]: r["v"] for r in s.read("t").collect()}

    assert run() == {1: "b", 2: "c"}
    before = s.parts("t")
    spark.createDataFrame([(1, "z", 9)], "k int, v string, seq long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == {1: "z", 2: "c"}
    after = s.parts("t")
    assert len(before) == 2 and set(before) == set(after) and sum(before[b] != after[b] for b in before) == 1  # one bucket was rewritten


HTML = """<html><head><title>棟 A | site</title><link rel=canonical href=/x></head><script>var s = {"list": [{"name": "n1", "price": 5, "address": "町1", "pad": "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"}], "k": true}; t = "</p>";</script>
<article class="property-card x"><h2>棟 A</h2><dl><dt>所在地</dt><dd>町1<br>2</dd><dt>賃料</dt><dd>5万円</dd></dl><div>間取り：1K</div><a href="d/1?page=3">詳細</a></article>
<article class="property-card"><table><tr><th>住所</th><td>町9</td></tr><tr><th>専有面積</th><td>20㎡</td></tr></table></article>
<table><tr><th>無関係</th></tr><tr><td>x</td></tr></table><a href="/p?page=7">7</a></html>"""
TABLE = "<table><tr><th>物件名</th><th>住所</th><th>家賃(万円)</th></tr><tr><td>棟</td><td>町1</td><td>5</td></tr><tr><td>棟2</td><td>町2</td></tr></table>"


def test_pages(spark):
    df = spark.createDataFrame([(1, HTML), (2, TABLE), (3, None), (4, ""), (5, "<p>broken <td></div>")], "page_id long, html string")
    rows = pages.page_rows(df).cache()
    got = sorted((r["page_id"], r["address"], r["rent"], r["layout"], r["area"], r["name"]) for r in pages.listings(rows).collect())
    assert got == [(1, "町1 2", "5万円", "1K", None, None), (1, "町9", None, None, "20㎡", None), (2, "町1", "5", None, None, "棟"), (2, "町2", None, None, None, "棟2")]
    assert sorted(r["url"] for r in pages.links(rows, F.lit("http://h")).collect()) == ["http://h/d/1?page=3", "http://h/p?page=7"]
    assert {r["page_id"]: r["last_page"] for r in pages.last_page(rows).collect()}[1] == 7
    assert pages.candidate_names(rows).first()["names"] == ["棟 A", "n1"]
    assert {(r["key"], r["value"]) for r in rows.where("kind = 'json'").collect()} >= {("name", "n1"), ("price", "5"), ("address", "町1")}
    assert rows.where("kind = 'canonical'").first()["value"] == "/x"


def test_free_text(spark):
    t = spark.createDataFrame([("福岡県北九州市小倉 築12年 RC 3階建 2LDK 55.5㎡ 6.5万円 徒歩 8分 総戸数：30",)], "t string")
    r = t.select(*[c.alias(n) for n, c in pages.free_text_fields(F.col("t")).items()]).first()
    assert (r["address"], r["age"], r["structure"], r["floor"], r["layout"], r["area"], r["price"], r["walk"], r["units"]) == ("福岡県北九州市小倉", "12", "RC", "3", "2LDK",
        "55.5", "6.5万円", "8", "30")


def test_document_lines(spark):
    words = spark.createDataFrame([(1, 10.2, 5.0, "b"), (1, 10.9, 1.0, "a"), (1, 30.0, 0.0, "c")], "page int, top double, x double, w string")
    assert sorted((r["line"], r["text"]) for r in text_rows.lines(words, ["page"], "top", "x", "w").collect()) == [(3, "a b"), (8, "c")]
    ctx = spark.createDataFrame([(1, 1, "空室一覧表"), (1, 2, "1/3頁"), (1, 3, "メゾン"), (1, 4, "北九州市小倉北区1番2号／管理"), (1, 5, "RC 築3年")], "page int, n int, t string")
    r = text_rows.context(ctx, ["page"], "n", "t").first()
    assert (r["name"], r["address"], r["structure"]) == ("メゾン", "北九州市小倉北区1番2号", "RC 築3年")
    carried = text_rows.carried_forward(spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, None), (2, 1, None)], "p int, n int, c string"), ["p"], ["n"], "c")
    assert sorted((r["p"], r["n"], r["c"]) for r in carried.collect() if r["c"]) == [(1, 2, "a"), (1, 3, "a")]
    kinds = spark.createDataFrame([("a b c d",), ("a b c d w x y z",), ("q",)],
        "t string").select(text_rows.document_kind(F.col("t"), {"one": tuple("abcd"), "two": tuple("wxyz")}).alias("k")).collect()
    assert [r["k"] for r in kinds] == ["one", "ambiguous", "other"]
    cells = spark.createDataFrame([([("賃料", "5"), ("面積㎡", "20")],)], "c array<struct<key:string,value:string>>")
    assert cells.select(text_rows.cell_by_header(F.col("c"), "面積").alias("x"), text_rows.cell_by_header(F.col("c"), "階").alias("y")).first() == ("20", "")
