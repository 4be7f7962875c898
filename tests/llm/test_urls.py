"""URL rules against a plain loop over all rules."""

import random

from pyspark.sql import functions as F

from lintel.llm import urls

SCHEMA = "host string, path string, verdict string"


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(h + p, v, len(h)) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: (len(r[0]), r[2]), default=(None, "allow", 0))
    return host, path, best[0], best[1]


def test_against_all_rules(spark):
    rng = random.Random(7)
    hosts = ["net", "org", "a.net", "b.a.net", "xa.net", "c.org", "a.c.org", "com"]
    paths = ["/", "/en/", "/en/x", "/e", "/en", "", "/fr/é", "/en/x/y"]
    rules = [(h, p, "block" if (len(h) + len(p)) % 2 else "allow") for h in hosts[:6] for p in paths if rng.random() < 0.5]
    pages = [(i, f"{rng.choice(['http', 'https'])}://{rng.choice(['', 'www.', 'B.', 'x-'])}{rng.choice(hosts).upper() if rng.random() < 0.3 else rng.choice(hosts)}{rng.choice([*paths, '/en/x?q=/en/', '#/en/', '?x'])}") for i in range(400)]
    pages += [(500, None), (501, ""), (502, "no scheme"), (503, "://"), (504, "http://"), (505, "http://net"), (506, "http://net\n/en/"), (507, "a://b://c/en/"),
        (None, "http://a.net/"), (508, "http://a.net/en/" + "z" * 60_000)]
    pages += [pages[3]] * 3
    df = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in pages], "page_id long, url string, host string, path string, rule string").repartition(3)
    got = urls.judge_urls(df, spark.createDataFrame(rules, SCHEMA)).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=key) == sorted(((i, *brute(u, rules)) for i, u in pages), key=key)


def test_nested_rules_in_several_sweeps(spark, monkeypatch):
    """Rules inside rules, closed in the other order, with a hot host dealt into sweeps that all hold its rules."""
    monkeypatch.setattr(urls, "SWEEP_ROWS", 40)
    rng = random.Random(9)
    rules = [("net", "/" + "".join(rng.choice("ab") for _ in range(n)), rng.choice(["allow", "block"])) for n in (0, 1, 1, 2, 2, 3, 3, 4, 6, 6)]
    rules = [(h, p, v) for (h, p), v in {(h, p): v for h, p, v in rules}.items()] + [(f"h{k}.com", "/", "block") for k in range(50)]
    pages = [(i, f"http://{rng.choice(['net', 'x.net', 'h7.com', 'other.org'])}/{''.join(rng.choice('abc') for _ in range(rng.randint(0, 8)))}") for i in range(900)]
    got = urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, SCHEMA)).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in got) == sorted((i, h, p, r or "", v) for i, u in pages for h, p, r, v
        in [brute(u, rules)])


def test_many_copies_of_a_row(spark):
    pages = spark.range(10_000).selectExpr("7L as page_id", "'http://hot.net/x' as url")
    assert urls.judge_urls(pages, spark.createDataFrame([("net", "/", "block")], SCHEMA)).where("rule = 'net/'").count() == 10_000


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in urls.judge_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")]
    assert urls.judge_urls(pages.limit(0), spark.createDataFrame([("net", "/", "block")], SCHEMA)).collect() == []
    doubled = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block"), (None, "/", "block"), ("net", None, None)], SCHEMA)
    assert [r["verdict"] for r in urls.judge_urls(pages, doubled).collect()] == ["block"]


def test_a_hot_host_is_spread(spark):
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://hot.net/"), F.col("id")).alias("url"))
    out = urls.judge_urls(pages, spark.createDataFrame([("net", "/", "block")], SCHEMA))
    assert out.where("verdict = 'block' and rule = 'net/'").count() == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
