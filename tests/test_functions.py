"""Column expressions on literal cases."""

import datetime
import uuid
import hashlib

import pytest
from pyspark.sql import functions as F

from lintel.functions import fields, keys, scores, text as tx


def values(spark, rows, expr, kinds="string"):
    """expr over one column, in the order of rows."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kinds}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normal_text(spark):
    assert values(spark, [None, "", "　Ａ　ｂ\t c ", "ｶﾅ"], tx.normalize_text) == ["", "", "A b c", "カナ"]
    assert values(spark, ["Ａ－b、ｃ。"], tx.compact_for_key) == ["abc"]


def test_building_names(spark):
    got = values(spark, ["メゾン　１２３号室", "サンライフ恒見２", "A･B", "ビル‐５０１", "ー塔ー", None, "Tower 12A"], tx.normalize_building_name)
    assert got == ["メゾン", "サンライフ恒見", "A・B", "ビル", "塔", "", "Tower"]


def test_addresses_in_one_form(spark):
    same = ["北九州市小倉北区片野一丁目２番３号", "福岡県北九州市小倉北区片野1丁目2-3", "福岡県北九州市小倉北区片野１－２－３", "北九州市小倉北区 片野 1丁目 2番地3", "福岡県北九州市北九州市小倉北区片野1-2-3"]
    assert set(values(spark, same, tx.normalize_address)) == {"福岡県北九州市小倉北区片野1-2-3"}
    assert values(spark, same[:1], tx.address_for_matching) == ["北九州市小倉北区片野1-2-3"]
    assert values(spark, ["東京都千代田区二十三番地", "百二十番", "二三番", "十丁目", None], tx.normalize_address) == ["東京都千代田区23", "120", "二三", "10", ""]


def test_number_words(spark):
    assert values(spark, ["十", "百", "三百二十一", "二十", "百五", "二三", "〇", "x", ""], tx.kanji_number) == ["10", "100", "321", "20", "105", "二三", "0", "x", ""]


def test_variants_and_predicates(spark):
    got = values(spark, ["町83", "町8-3", "町1234", "町123", "町1-2、3", "町1〜5", "町", ""], tx.address_variants)
    assert got == [["町83", "町8-3"], ["町8-3"], ["町1234", "町12-34"], ["町123"], ["町1-2、3", "町1-2"], ["町1〜5", "町1"], ["町"], []]
    assert values(spark, ["北九州市小倉町1-1-1", "北九州市小倉町8-3", "北九州市小倉町1-1、2", "a1-1-1"], tx.granular_address) == [True, False, False, False]
    assert values(spark, ["room 1", "ab", "abc", "号室x", None], tx.unit_like_name) == [True, True, False, True, True]
    assert values(spark, ["福岡県北九州市八幡西区x", "福岡市中央区1", "別"], tx.ward) == ["八幡西区", "福岡市中央区", ""]


def test_public_text(spark):
    assert values(spark, ["棟 １２３号室 a", "x  y", "12号室"], tx.without_room) == ["棟 a", "x y", ""]
    assert values(spark, [" 12: 棟", "１２３：棟", "12345: x"], tx.without_list_number) == ["棟", "棟", "12345: x"]
    assert values(spark, ["a MAIL=x", "号室", "棟"], tx.forbidden_content) == [True, True, False]


def test_repair(spark):
    bad = "賃料一覧".encode("cp932").decode("latin-1")
    assert values(spark, [bad, "賃料", "abc", None], tx.repaired) == ["賃料一覧", "賃料", "abc", None]
    assert values(spark, [bad, "賃料é", "", "賃料����"], tx.mojibake) == [True, False, False, True]
    assert values(spark, [bad + "　（１）【—】", None], tx.document_text) == [bad + " (1)[-]", ""]


def test_document_names(spark):
    assert values(spark, ["町1", "北九州市小倉北区町1", "小倉北区町1", ""], lambda c: tx.with_ward(c, F.lit("小倉北区"))) == ["北九州市小倉北区町1", "北九州市小倉北区町1", "北九州市小倉北区町1", ""]
    got = values(spark, ["棟名 101号室", "棟名-12号", "棟名 1-02", "棟名(203)", "棟名 304", "A棟", "東棟", "棟名"], lambda c: tx.split_document_room(c, F.lit("")))
    assert [tuple(r) for r in got] == [("棟名", "101"), ("棟名", "12"), ("棟名", "102"), ("棟名", "203"), ("棟名", "304"), ("A棟", ""), ("東棟", ""), ("棟名", "")]
    assert values(spark, ["貸家 1", "棟"], tx.detached_house) == [True, False]
    got = values(spark, ["http://h/l?sub_city[]=9&sub_city[]=1616", "http://h/city/400001.html", None], lambda c: tx.place_of_url(c, {"1616": "門司区"}))
    assert [tuple(r) for r in got] == [("北九州市", "門司区"), ("北九州市", ""), ("", "")]
    assert values(spark, ["更新 2026年01月02日", "2026/01/02 10:00", "x"], fields.updated_day) == ["2026-01-02", "2026-01-02", ""]
    assert values(spark, ["25.5㎡", "約 30 m2", ""], fields.area_of_cell) == [25.5, 30.0, None]


def test_money(spark):
    assert values(spark, ["6万5000", "6.2万円", "65,000円", "999円", None], fields.yen_from_text) == [65000, 62000, 65000, None, None]
    assert values(spark, ["5.35", " ", None], fields.yen_from_man) == [53500, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["x"], fields.yen_from_man)
    assert values(spark, ["6.2万円", "x", ""], fields.yen_from_sheet) == [62000, None, None]
    assert values(spark, ["6.2万円", "62,000円(税込)", "62000", "無", "なし", "", "-"], fields.man_from_page) == [6.2, 6.2, 6.2, None, None, None, None]
    assert values(spark, ["なし", "3,000円", "0.5万円", ""], fields.fee_yen) == [0, 3000, 5000, None]
    assert values(spark, ["1234567", "x", None], fields.format_yen) == ["1,234,567", "—", "—"]


def test_areas_and_ages(spark):
    assert values(spark, ["25.5㎡", "25 m2", "25", None], fields.area_sqm) == [25.5, 25.0, None, None]
    assert values(spark, ["12.7", "-1", "x", "", "0"], fields.age_years) == [12, None, None, None, 0]
    assert values(spark, ["1999-03", "199", None], fields.built_year) == [1999, None, None]


def test_built_age(spark):
    day = F.lit("2026-03-01").cast("date")
    got = values(spark, ["2026-03", "2025-04", "2025-03", "2030-01", "2020/3", "2020-13", "x", None], lambda c: fields.built_age(c, day))
    assert got == [0, 0, 1, 0, 6, None, None, None]
    assert [tuple(r) for r in values(spark, ["2023年1月\n(3年)", "2023年13月", "(5年)", None], fields.built)] == [("2023-01", 3), (None, None), (None, 5), (None, None)]


def test_availability(spark):
    def one(ref, category="realpro"):
        return lambda c: fields.availability(c, F.lit(ref), F.lit(category))

    assert [tuple(r) for r in values(spark, ["1月5日", "12月28日", "即入居可", "即 入居", "2月30日", "相談", None], one("2026-12-28"))] == [
        (False, "1/5", "2027-01-05"), (False, "12/28", "2026-12-28"), (True, "即入居", None), (True, "即入居", None), (False, "2月30日", None), (False, "相談", None),
            (False, None, None)]
    assert [tuple(r) for r in values(spark, ["", "1月5日"], one("", "ulucks"))] == [(True, "入居", None), (False, "1月5日", None)]


def test_dates(spark):
    got = values(spark, ["2026-01-02", "2026/1/2 3:04", "2026年1月2日", "2026/01", "am 2026-01-02!", "2026-02-30", "x", None], fields.summary_date)
    day = datetime.datetime(2026, 1, 2)
    assert got == [day, datetime.datetime(2026, 1, 2, 3, 4), day, datetime.datetime(2026, 1, 1), day, None, None, None]


def test_keys(spark):
    assert values(spark, ["x|y", "é"], keys.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, v)) for v in ("x|y", "é")]
    assert values(spark, ["a"], lambda c: keys.sha1_key(c, F.lit(None).cast("string"))) == [hashlib.sha1(b"a|").hexdigest()]
    assert values(spark, ["a"], lambda c: keys.legacy_key(c, c)) == [hashlib.sha1(b"a|a").hexdigest()[:32]]
    assert values(spark, [" e ", None], lambda c: keys.evidence_key(c, F.lit("u"), F.lit("r"))) == ["e", "u#r=" + hashlib.sha1(b"r").hexdigest()[:16]]


def test_similarity_bound_holds(spark):
    import random

    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(list(zip(words, words[7:] + words[:7])), "a string, b string")
    got = df.select(scores.similarity("a", "b").alias("s"), scores.similarity_bound(F.col("a"), F.col("b")).alias("u")).collect()
    assert all(r["s"] <= r["u"] + 1e-12 for r in got)


def test_built_age_order(spark):
    rows = [("future", "2030-01", 0, "bunjo"), ("new_rent", "2026-02", 0, "chintai"), ("new_sale", "2026-02", 0, "bunjo"), ("old", "2001-05", 25, "chintai"),
        ("older", "1990-01", 36, None), ("unknown", None, 3, "chintai"), ("unknown_older", "x", 9, "chintai")]
    df = spark.createDataFrame(rows[::-1], "id string, built string, age int, kind string")
    got = [r["id"] for r in df.orderBy(*scores.built_age_order(F.col("built"), F.col("age"), F.col("kind"), F.lit(2026 * 12 + 3))).collect()]
    assert got == [r[0] for r in rows]
