"""Rows out of saved pages: cards, key-value pairs, tables, links, embedded JSON.

One pass of the standard library's parser turns a page into generic rows (kind, block, row, key,
value); what a field means is decided by native expressions on those rows. Pages are parsed by
mapInArrow, a page at a time, so memory is bounded by a batch of pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.fields import area_any_unit, yen_from_list

#: Tags without an end.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: Classes of elements that hold one property, in order of preference.
CARD_CLASSES = ("property-card", "listing_card", "property", "card", "item")
# Members that name a building, links to a building's page, what is no name, what follows a name.
NAME_MEMBER = re.compile(r'"name"\s*:\s*"([^"]{2,120})"')
BUILDING_LINK = r"/(mansion|chintai)/\d+"
LINK_WORDS = ("詳細", "詳しく見る")
STOP_WORDS = "マンションレビュー|賃貸|検索|ページ"
AFTER_NAME = "福岡県|住所|交通|築|地上|総戸数|口コミ"
AVAILABILITY = ("空室", "相談", "退去予定")
ROWS = "page_id long, kind string, block int, row int, key string, value string"


class Node:
    """An element with its text in reading order."""

    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def text(self) -> str:
        out: list[str] = []
        todo = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in ("script", "style"):
                todo.extend(reversed(x.children))
        return " ".join(" ".join(out).split())

    def all(self, *tags: str) -> Iterator[Node]:
        """Elements of the given tags below this one, in reading order."""
        todo = [c for c in reversed(self.children) if not isinstance(c, str)]
        while todo:
            x = todo.pop()
            if x.tag in tags:
                yield x
            todo.extend(c for c in reversed(x.children) if not isinstance(c, str))

    def is_in(self, other: Node) -> bool:
        x = self.parent
        while x is not None and x is not other:
            x = x.parent
        return x is other


class Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        x = self.at
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None and x.parent is not None:
            self.at = x.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _pairs(block: Node) -> Iterator[tuple[str, str]]:
    """dt with its dd, th with its td, and lines `label: value`."""
    for dl in block.all("dl"):
        key = None
        for c in dl.all("dt", "dd"):
            if c.tag == "dt":
                key = c.text()
            elif key:
                yield key, c.text()
                key = None
    for tr in block.all("tr"):
        cells = [c for c in tr.children if not isinstance(c, str) and c.tag in ("th", "td")]
        for a, b in zip(cells, cells[1:]):
            if a.tag == "th" and b.tag == "td":
                yield a.text(), b.text()
    for x in block.all("div", "p", "li", "span"):
        if not any(True for _ in x.all("div", "p", "li", "dl", "table")):
            m = re.match(r"^([^:：]{1,12})\s*[:：]\s*(.+)$", x.text())
            if m and "//" not in m[2][:3]:
                yield m[1].strip(), m[2].strip()


def parse(html: str) -> Iterator[tuple[str, int, int, str, str]]:
    """(kind, block, row, key, value) of one page."""
    root = Tree(html).root
    cards: list[Node] = []
    for name in CARD_CLASSES:
        cards = [x for x in root.all("article", "section", "div", "li", "table") if name in x.attrs.get("class", "").split()]
        if cards:
            break
    cards = [c for c in cards if not any(c is not d and c.is_in(d) for d in cards)]
    for b, card in enumerate(cards):
        yield "card", b, 0, "", card.text()
        for r, (k, v) in enumerate(_pairs(card)):
            yield "field", b, r, k, v
        for r, a in enumerate(card.all("a")):
            yield "card_link", b, r, a.text(), a.attrs.get("href", "")
    for b, t in enumerate(root.all("table")):
        head: list[str] = []
        r = 0
        for tr in t.all("tr"):
            cells = [c for c in tr.children if not isinstance(c, str) and c.tag in ("th", "td")]
            if cells and not head and all(c.tag == "th" for c in cells):
                head = [c.text() for c in cells]
            elif head and cells:
                for k, c in zip(head, cells):
                    yield "cell", b, r, k, c.text()
                r += 1
    for r, a in enumerate(root.all("a")):
        yield "link", 0, r, a.text(), a.attrs.get("href", "")
    for r, x in enumerate(root.all("title", "h1", "h2")):
        yield "heading", 0, r, x.tag, x.text()
    for r, x in enumerate(root.all("link")):
        if x.attrs.get("rel") == "canonical":
            yield "canonical", 0, r, "", x.attrs.get("href", "")
    for r, m in enumerate(NAME_MEMBER.finditer(html)):
        yield "name", 0, r, "", m[1]
    for b, s in enumerate(root.all("script")):
        raw = "".join(c for c in s.children if isinstance(c, str))
        for r, (k, v) in enumerate(x for node in embedded(raw) for x in node):
            yield "json", b, r, k, v


def embedded(script: str, least: int = 80, words: tuple[str, ...] = ("address", "price", "rent", "name")) -> Iterator[list[tuple[str, str]]]:
    """Scalar members of every object inside JSON texts of a script that mention one of the words."""
    for start in (m.start() for m in re.finditer(r"\{", script)):
        try:
            found, end = json.JSONDecoder().raw_decode(script, start)
        except ValueError:
            continue
        if end - start < least or not any(w in script[start:end] for w in words):
            continue
        todo = [found]
        while todo:
            x = todo.pop(0)
            if isinstance(x, dict):
                yield [(k, str(v)) for k, v in x.items() if isinstance(v, (str, int, float)) and not isinstance(v, bool)]
                todo.extend(x.values())
            elif isinstance(x, list):
                todo.extend(x)
        return


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, html) -> generic rows; null pages give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ROWS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(i, *r) for r in parse(html)] if html else []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, ROWS)


# What the labels of a field look like.
LABELS = {
    "name": "物件名|建物名|マンション名", "room": "号室|部屋", "address": "所在地|住所", "rent": "賃料|家賃|価格", "fee": "管理費|共益費", "layout": "間取",
    "area": "面積", "updated": "更新", "move_in": "入居", "structure": "構造", "built": "築年",
}


def field_of(label: Column) -> Column:
    """The field that a label or header stands for, the first that fits."""
    out = F.lit(None).cast("string")
    for field, pattern in reversed(LABELS.items()):
        out = F.when(label.rlike(pattern), field).otherwise(out)
    return out


def listings(rows: DataFrame) -> DataFrame:
    """(page_id, tier, block, row, fields...) of the cards of a page; of its header tables if it has no cards."""
    f = rows.withColumn("field", field_of(F.col("key"))).where("field is not null and kind in ('field', 'cell')")
    card = F.col("kind") == "field"
    wide = f.groupBy("page_id", "kind", "block", F.when(card, 0).otherwise(F.col("row")).alias("row")).pivot("field", list(LABELS)).agg(F.min_by("value", "row"))
    wide = wide.where("address is not null")
    with_cards = wide.where("kind = 'field'").select("page_id").distinct()
    tables = wide.where("kind = 'cell'").join(with_cards, "page_id", "left_anti")
    return wide.where("kind = 'field'").unionByName(tables)


def links(rows: DataFrame, base: Column | None = None) -> DataFrame:
    """(page_id, url) of a page's links, made absolute where `base` (scheme and host) is given."""
    href = F.col("value")
    url = href if base is None else F.when(href.rlike("^https?://"), href).when(F.startswith(href, F.lit("/")),
        F.concat(base, href)).otherwise(F.concat(base, F.lit("/"), href))
    return rows.where("kind = 'link' and value <> ''").select("page_id", F.col("key").alias("text"), url.alias("url"))


def cards_of_urls(rows: DataFrame, wanted: DataFrame, base: Column) -> DataFrame:
    """(page_id, url, block): the card of each wanted (page_id, url), that around the first link to it on the page.

    A link leads there if it is the url once made absolute, or a link to a building that holds the url's path.
    Urls without such a link have a null block."""
    href = F.col("value")
    whole = F.when(href.rlike("^https?://"), href).when(F.startswith(href, F.lit("/")), F.concat(base, href)).otherwise(F.concat(base, F.lit("/"), href))
    a = rows.where("kind = 'card_link' and value <> ''").select("page_id", "block", "row", href.alias("href"), whole.alias("whole"))
    path = F.regexp_replace("url", "^https?://[^/]+", "")
    leads = (F.col("whole") == F.col("url")) | (F.col("href").rlike(r"/mansion/\d+") & F.contains("href", path))
    first = wanted.join(a, "page_id").where(leads).groupBy("page_id", "url").agg(F.min(F.struct("block", "row")).alias("at"))
    return wanted.join(first, ["page_id", "url"], "left").select("page_id", "url", "at.block")


def last_page(rows: DataFrame, pattern: str = r"[?&]page=(\d+)") -> DataFrame:
    """(page_id, last_page): the highest page number among a page's links, 1 without any."""
    n = F.regexp_extract("value", pattern, 1).try_cast("int")
    return rows.groupBy("page_id").agg(F.coalesce(F.max(F.when(F.col("kind") == "link", n)), F.lit(1)).alias("last_page"))


def candidate_names(rows: DataFrame) -> DataFrame:
    """(page_id, names): what may be a building's name, cleaned, distinct, in this order: the title up to a bar, the
    headings h1 and h2, texts of links to a building's page, members `name` of JSON. Room numbers are cut from the title
    and headings; what is shorter than two characters or holds a stop word is left out."""
    kind, key, value = F.col("kind"), F.col("key"), F.col("value")
    title, heading = (kind == "heading") & (key == "title"), (kind == "heading") & (key != "title")
    place = F.when(title, 0).when(heading, 1).when((kind == "link") & value.rlike(BUILDING_LINK) & ~key.isin(*LINK_WORDS), 2).when(kind == "name", 3)
    text = F.when(title, F.regexp_extract(value, r"(?s)^[^|｜]*", 0)).when(kind == "link", key).otherwise(value)
    name = tx.spaced(F.when(kind == "heading", F.regexp_replace(text, r"(?U)\d+号室", "")).otherwise(text))
    found = rows.withColumns({"place": place, "name": name}).where("place is not null and length(name) >= 2").where(~F.col("name").rlike(STOP_WORDS))
    first = found.where(~title | (F.col("row") == 0)).groupBy("page_id", "name").agg(F.min(F.struct("place", "row")).alias("at"))
    return first.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"))


def free_text_fields(text: Column) -> dict[str, Column]:
    """Fields that a running text mentions."""
    def one(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    return {
        "address": one(r"((?:北海道|東京都|(?:京都|大阪)府|[^\s都道府県]{2,3}県)[^\s]{2,30})"), "price": one(r"(\d[\d,.]*\s*(?:万円|円))"), "layout": one(r"(\d(?:S?LDK|DK|K|R))"),
        "area": one(r"(\d+(?:\.\d+)?)\s*(?:㎡|m2)"), "floor": one(r"(\d+)\s*階建?"), "structure": one(r"(SRC|RC|鉄骨鉄筋コンクリート|鉄筋コンクリート|鉄骨造|木造)"),
        "availability": F.when(F.contains(text, F.lit("即入居")), "即入居")
            .otherwise(F.coalesce(one(r"(?:入居(?:可能|可)?(?:時期)?|空室情報)\s*[:：]?\s*([^\s、,]{1,20})"), *[F.when(F.contains(text, F.lit(w)), w) for w in AVAILABILITY])),
        "age": one(r"築\s*(\d+)\s*年"), "built": one(r"(\d{4}年\s*\d{1,2}月)"), "units": one(r"総戸数\s*[:：]?\s*(\d+)"), "walk": one(r"徒歩\s*(\d+)\s*分"),
    }


def page_counts(rows: DataFrame) -> DataFrame:
    """(page_id, cards, fields, cells, links): what a parse found, to look into pages that give no rows."""
    def n(kind: str, name: str) -> Column:
        return F.count_if(F.col("kind") == kind).alias(name)

    return rows.groupBy("page_id").agg(n("card", "cards"), n("field", "fields"), n("cell", "cells"), n("link", "links"))


def card_facts(rows: DataFrame) -> DataFrame:
    """(page_id, block, ...): least, greatest and mean price, areas, layouts and rows of a table inside a card."""
    f = rows.where("kind in ('field', 'cell')").withColumn("field", field_of(F.col("key")))
    price = F.when(F.col("field") == "rent", yen_from_list(F.col("value")))
    area = F.when(F.col("field") == "area", area_any_unit(F.col("value")))
    layout = F.when(F.col("field") == "layout", F.nullif(F.trim("value"), F.lit("")))
    return f.groupBy("page_id", "kind", "block").agg(
        F.min(price).alias("price_min"), F.max(price).alias("price_max"), F.avg(price).cast("long").alias("price_avg"), F.min(area).alias("area_min"),
            F.max(area).alias("area_max"),
        F.array_sort(F.collect_set(layout)).alias("layouts"), F.count_distinct("row").alias("rows"),
    )


def best_name(anchor: Column, title: Column, alt: Column, heading: Column, text: Column, url: Column) -> Column:
    """The first of several places where a name may stand; then the head of the text, up to a word that follows names,
    if it is no longer than a name is; the url at last, so that no row is lost."""
    def some(c: Column) -> Column:
        return F.nullif(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")), F.lit(""))

    head = F.regexp_replace(F.regexp_extract(some(text), f"(?s)^(.*?)(?:{AFTER_NAME}|$)", 1), r"(?U)^[\s\-–—|｜]+|[\s\-–—|｜]+$", "")
    return F.coalesce(some(anchor), some(title), some(alt), some(heading), F.when(F.length(head).between(1, 80), head), F.coalesce(url, F.lit("")))
