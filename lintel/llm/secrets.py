"""Secret scan with a random forest that removes false positives, in DataFrame expressions only.

A broad pattern proposes candidates. Each is described by its length, its character transitions, the
share of it that dictionary words cover, the path of its document and the words around it. A random
forest, trained from labelled findings, decides which candidates are secrets. Its trees become one
SQL expression, so that a scan is a projection: no join, no shuffle, no Python on the executors.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Beginnings of keys that say whose they are.
KEY_PREFIXES = "AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk[_-]|pk[_-]|AIza|ya29|glpat-|eyJ"
KNOWN = KEY_PREFIXES + "|-----BEGIN "
#: What may be a secret. No part of the pattern repeats a group without a bound, which would overflow the matcher's stack.
#: A private key with its frame (or, where its end is missing, up to the next run of hyphens) ...
_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----[^-]*+(?:-(?!----)[^-]*+){0,64}+(?:-----END [A-Z0-9 ]{0,40}-----)?"
#: ... 8 characters assigned in quotes, up to a quote or a blank (the first lookbehind is a cheap test for the second) ...
_QUOTED = r"""(?<=["'])(?<=[:=][ \t]{0,16}["'])[^\s"']{8,}+"""
#: ... 8 assigned without quotes (further symbols only inside; the next parameter of a query string is another value) ...
_PLAIN = r"[A-Za-z0-9+/_~@$^-]"
_ASSIGNED = (
    r"(?<=[:= \t])(?<=[:=][ \t]{0,16})(?=%s[A-Za-z0-9+/_~@$^!#%%*&?.|\\-]{6,32}?%s)%s++"
    r"(?:(?!&[A-Za-z_]{1,40}=)[!#%%*&?.|\\]++%s++){0,256}+={0,2}"
) % ((_PLAIN,) * 4)
#: ... or 12 characters with a digit or after a known beginning.
_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|(?:%s))[A-Za-z0-9+/_-]{12,}+={0,2}" % KEY_PREFIXES
CANDIDATE = f"{_BLOCK}|{_QUOTED}|{_ASSIGNED}|{_RUN}"
#: Characters around a candidate that are looked at, and candidates (of 8 characters at least) that can lie in them.
CONTEXT = 48
EARLIER = CONTEXT // 8
#: Fixed word lists of the features.
KEY_WORDS = "password|passwd|pwd|passphrase|secret|token|api[_ -]?key|apikey|access[_ -]?key|auth|bearer|credential|private"
OTHER_WORDS = "commit|sha1|sha256|sha512|md5|hash|checksum|digest|etag|uuid|guid|revision|build|version|order|invoice|phone|card|isbn|page|file|image|id"
DICTIONARY = ("about", "access", "account", "address", "admin", "after", "archive", "article", "before", "build", "button", "change", "class", "client", "code", "config",
    "content", "create", "data", "date", "default", "demo", "document", "download", "example", "file", "first", "form", "from", "function", "getting", "group", "handler",
    "here", "home", "html", "image", "index", "info", "insert", "item", "last", "list", "local", "main", "manager", "message", "module", "name", "news", "null", "number",
    "object", "order", "page", "parent", "path", "placeholder", "post", "product", "public", "query", "request", "response", "sample", "select", "server", "service",
    "session", "size", "state", "string", "style", "system", "table", "test", "text", "this", "time", "title", "type", "undefined", "update", "user", "value", "version",
    "view", "width", "window", "with", "your")
TEST_PATHS = "test|example|sample|mock|fixture|demo|docs?/"
CONFIG_PATHS = r"\.env|config|settings|secret|credential|deploy|prod|\.ya?ml|\.ini"

FEATURES = ("length", "digits", "uppers", "symbols", "entropy", "distinct", "class_changes", "digit_to_letter", "letter_to_digit", "hex", "vowel_steps", "repeats",
    "covered", "known_prefix", "assigned", "quoted", "key_word", "other_word", "test_path", "config_path")
TREES, DEPTH, SEED = 40, 7, 17
#: Labelled findings that are made when none are given.
MADE_FINDINGS = 9000
THRESHOLD = 0.5
MASK = "[SECRET]"


def features(candidate: Column, before: Column, after: Column, path: Column) -> list[Column]:
    """The values of FEATURES, as doubles. before and after: at most CONTEXT characters."""
    size = F.length(candidate)
    low, near, place = F.lower(candidate), F.lower(before), F.lower(F.coalesce(path, F.lit("")))

    def share(pattern: str, of: Column = candidate) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / size

    chars = F.array_distinct(F.split(candidate, ""))
    parts = F.transform(chars, lambda c: (size - F.length(F.replace(candidate, c, F.lit("")))) / size)
    entropy = F.aggregate(parts, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(candidate, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "B")
    values = [
        size,
        share("[0-9]"),
        share("[A-Z]"),
        share("[^A-Za-z0-9]"),
        entropy,
        F.size(chars) / size,
        (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / size,
        share("[0-9](?=[A-Za-z])"),
        share("[A-Za-z](?=[0-9])"),
        share("[0-9a-f]", low),
        share("[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])", low),
        share(r"(.)(?=\1)", low),
        1 - F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / size,
        candidate.rlike(f"^(?:{KNOWN})").cast("double"),
        near.rlike(r"""[:=]\s*["']?$""").cast("double"),
        (near.rlike("""["']$""") & after.rlike("""^["']""")).cast("double"),
        near.rlike(rf"({KEY_WORDS})[^\n]{{0,16}}$").cast("double"),
        near.rlike(rf"\b({OTHER_WORDS})\b[^\n]{{0,12}}$").cast("double"),
        place.rlike(TEST_PATHS).cast("double"),
        place.rlike(CONFIG_PATHS).cast("double"),
    ]
    return [v.cast("double") for v in values]


def made_findings(spark: SparkSession, n: int = MADE_FINDINGS) -> DataFrame:
    """Labelled findings (path, before, candidate, after, label) by rule: every third is a secret.

    Random strings come from hashes of a row number; the words before them are made likewise, so that
    no language is learnt."""
    h = [F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"#{k}")), 256) for k in range(6)]

    def pick(h: Column, *of: str) -> Column:
        return F.element_at(F.array(*map(F.lit, of)), (F.conv(F.substring(h, 1, 6), 16, 10).cast("int") % len(of)) + 1)

    def letters(h: Column, size: int) -> Column:
        return F.translate(F.substring(h, 9, size), "0123456789abcdef", "aeioutnrslhdmpcg")

    mixed = F.translate(F.base64(F.unhex(F.concat(h[0], h[1]))), "+/=", "xYz")
    upper = F.upper(F.substring(F.translate(mixed, "abcdefghijklm", "ABCDEFGHIJKLM"), 1, 16))
    dict_name = F.concat(F.initcap(pick(h[0], "update", "example", "manager", "content", "session")),
        F.initcap(pick(h[1], "window", "account", "query", "system", "image")), F.initcap(pick(h[2], "handler", "config", "number", "page", "value")),
        F.substring(F.conv(F.substring(h[3], 1, 4), 16, 10), 1, 2))
    number = F.substring(F.translate(h[4], "abcdef", "012345"), 1, 16)
    assign = pick(h[2], "=", " = ", ": ", "=\"", " = \"", ": '")
    key = pick(h[3], "password", "token", "secret", "api_key", "PASSWORD", "Token", "auth_token", "access_key", "client_secret")
    value = pick(h[4], "commit ", "sha1 ", "checksum: ", "md5=", "revision ", "etag: \"", "build ")
    quoted = assign.rlike("[\"']$")
    word = F.concat(letters(h[5], 6), F.lit(" "))
    cases = [
        ("1", word, F.concat(F.lit("AKIA"), upper), F.lit(" ")),
        ("1", word, F.concat(F.lit("AKIA"), F.translate(upper, "0123456789", "QWERTZUIOP")), F.lit(" ")),
        ("1", F.concat(word, key, assign), F.substring(h[0], 1, 18), F.when(quoted, F.substring(assign, -1, 1)).otherwise(" ")),
        ("1", F.concat(word, key, assign), F.substring(h[0], 1, 40), F.when(quoted, F.substring(assign, -1, 1)).otherwise(" ")),
        ("1", F.concat(word, key, assign), F.substring(mixed, 1, 24), F.when(quoted, F.substring(assign, -1, 1)).otherwise(" ")),
        ("1", word, F.concat(pick(h[1], "ghp_", "sk_live_", "xoxb-", "glpat-"), F.substring(mixed, 1, 30)), F.lit(" ")),
        ("1", F.concat(word, key, assign), F.upper(F.substring(h[0], 1, 24)), F.lit("!! ")),
        ("0", word, number, F.lit(" ")),
        ("0", word, number, F.lit("!! ")),
        ("0", F.concat(word, value), F.substring(h[0], 1, 40), F.lit(" ")),
        ("0", F.concat(word, value), F.substring(h[0], 1, 32), F.lit("\"")),
        ("0", word, dict_name, F.lit("(")),
        ("0", F.concat(word, key, assign), pick(h[0], "your_password_here1", "example_token_0000", "xxxxxxxxxxxxxxxx", "placeholder123", "test_value_1234", "undefined",
            "password1234", "changeme_default"), F.lit(" ")),
        ("0", F.concat(F.lit("/"), letters(h[1], 5), F.lit("/")), F.concat(letters(h[2], 7), F.lit("-"), letters(h[3], 6), F.lit("-"), F.substring(number, 1, 4)),
            F.lit("/")),
        ("0", word, F.concat_ws("-", F.substring(h[0], 1, 8), F.substring(h[0], 9, 4), F.substring(h[0], 13, 4), F.substring(h[0], 17, 4), F.substring(h[0], 21, 12)),
            F.lit(" ")),
        ("0", word, F.concat(F.lit("+1"), F.substring(number, 1, 10)), F.lit(" ")),
        ("0", word, F.concat(letters(h[0], 9), letters(h[1], 8), F.substring(number, 1, 1)), F.lit(", ")),
        ("0", F.concat(word, F.lit(":")), F.concat(letters(h[0], 9), letters(h[1], 8)), F.lit(" ")),
        ("0", F.concat(word, F.lit("=")), letters(h[0], 10), F.lit(" ")),
    ]
    neutral = F.concat(word, pick(h[3], "url", "href", "src", "host", "path", "email", "name", "class", "version", "date", "file"), assign)
    closing = F.when(quoted, F.substring(assign, -1, 1)).otherwise(" ")
    host = F.concat(letters(h[0], 7), F.lit("."), letters(h[1], 5), pick(h[2], ".com", ".org", ".example.net"))
    symbols = F.concat(F.substring(mixed, 1, 5), pick(h[0], "&", "!", "#", "%", "@", "$"), F.substring(mixed, 6, 3), pick(h[1], "!", "?", "*", ".", "&", "^"),
        F.substring(mixed, 9, 4))
    block = F.concat(pick(h[1], "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "-----BEGIN OPENSSH PRIVATE KEY-----"), F.lit("\n"), mixed, F.lit("\n"),
        mixed, F.lit("\n-----END PRIVATE KEY-----"))
    when = F.concat(F.lit("20"), F.substring(number, 1, 2), F.lit("-0"), F.substring(number, 3, 1), F.lit("-1"), F.substring(number, 4, 1), F.lit("T1"),
        F.substring(number, 5, 1))
    cases += [
        ("1", F.concat(word, key, assign), symbols, closing),
        ("1", F.concat(word, key, assign), F.concat(F.initcap(letters(h[0], 4)), F.substring(number, 1, 3), F.lit("!"), letters(h[1], 4)), closing),
        ("1", word, block, F.lit("\n")),
        ("0", neutral, F.concat(F.lit("https://"), host, F.lit("/"), letters(h[3], 6), F.lit("/"), letters(h[4], 7), F.lit(".html")), closing),
        ("0", neutral, host, closing),
        ("0", neutral, F.concat(letters(h[3], 6), F.lit("."), F.substring(number, 1, 2), F.lit("@"), host), closing),
        ("0", neutral, when, F.lit(":")),
        ("0", neutral, F.concat(F.lit("/"), letters(h[0], 4), F.lit("/"), letters(h[1], 6), F.lit("/"), letters(h[4], 8)), closing),
        ("0", neutral, F.concat(letters(h[0], 7), F.substring(number, 1, 2), pick(h[1], ".tar.gz", ".png", ".json", ".txt", ".min.js")), closing),
        ("0", neutral, F.concat(pick(h[0], "com.example.", "org.sample."), letters(h[1], 6), F.lit("."), F.initcap(letters(h[4], 7)), F.substring(number, 1, 1)),
            closing),
        ("0", neutral, F.concat_ws(".", F.substring(number, 1, 3), F.substring(number, 4, 2), F.substring(number, 6, 2), F.substring(number, 8, 3)), closing),
        ("0", neutral, F.concat(letters(h[0], 6), F.lit("-"), letters(h[1], 7)), closing),
    ]
    path = pick(h[5], "src0", "src7", "web/page", "app/config.yml", "repo/tests/test_api.py", "docs/readme", ".env")

    def made(i: int) -> DataFrame:
        """The rows of one case; one expression over all cases would be too long to be compiled."""
        label, before, candidate, after = cases[i]
        rows = spark.range(i, n, len(cases), numPartitions=1)
        return rows.select(path.alias("path"), F.substring(before, -CONTEXT, CONTEXT).alias("before"), candidate.alias("candidate"), after.alias("after"), F.lit(float(label)).alias("label"))

    return reduce(DataFrame.unionByName, map(made, range(len(cases)))).coalesce(2)


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """The forest, from labelled findings (path, before, candidate, after, label of 0 or 1)."""
    rows = findings.where("length(candidate) > 0 and label is not null").select(
        F.array(*features(F.col("candidate"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")), F.col("path"))).alias("x"),
            F.col("label").cast("double").alias("label")
    )
    rows = rows.select("label", *[F.col("x")[i].alias(n) for i, n in enumerate(FEATURES)])
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))


_forests: dict[str, RandomForestClassificationModel] = {}


def trained(spark: SparkSession) -> RandomForestClassificationModel:
    """The forest of the made findings; trained once in a session."""
    session = spark.sparkContext.applicationId
    if session not in _forests:
        _forests.clear()
        _forests[session] = train(made_findings(spark))
    return _forests[session]


def vote(model: RandomForestClassificationModel, x: Column) -> Column:
    """The share of trees that say secret, as an expression over the array x of features."""

    def node(lines: list[str], depth: int) -> Column:
        line = lines.pop(0).strip()
        if line.startswith("Predict:"):
            return F.lit(int(float(line.split()[1])))
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        if not m:
            raise ValueError(f"unknown node: {line}")
        left = node(lines, depth + 1)
        lines.pop(0)  # Else
        right = node(lines, depth + 1)
        return F.when(x[int(m[1])] <= float(m[2]), left).otherwise(right)

    trees = [node([y for y in t.toDebugString.split("\n")[1:] if y.strip()], 0) for t in model.trees]
    return sum(trees[1:], trees[0]) / len(trees)


def scan(docs: DataFrame, model: RandomForestClassificationModel, path_col: str = "source") -> DataFrame:
    """All columns of docs and `_parts`, `_tail`: the text is the texts of parts one after another, and tail.
    Columns of these names in docs are replaced.

    A part is (before, candidate, score): a candidate with what lies between it and the one before.
    Null texts and texts without candidates have no parts, and the text (null: empty) as their tail."""
    text = F.coalesce("text", F.lit(""))
    pattern = F.lit(CANDIDATE)
    found, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, CANDIDATE, -1)
    zipped = F.arrays_zip(found.alias("candidate"), F.slice(pieces, 1, F.size(found)).alias("before"), F.slice(pieces, 2, F.size(found)).alias("after"))

    def context(z: Column, p: Column, i: Column) -> Column:
        """The text before the candidate, earlier candidates included."""
        earlier = F.transform(F.slice(z, F.greatest(i - EARLIER, F.lit(0)) + 1, F.least(i, F.lit(EARLIER))),
            lambda q: F.concat(F.substring(q["before"], -CONTEXT, CONTEXT), q["candidate"]))
        return F.substring(F.concat(F.array_join(earlier, ""), F.substring(p["before"], -CONTEXT, CONTEXT)), -CONTEXT, CONTEXT)

    # z: as a variable, the candidates are searched for once, not once a candidate
    near = F.transform(F.array(zipped), lambda z: F.transform(z, lambda p, i: F.struct(p["before"].alias("before"), p["candidate"].alias("candidate"), context(z, p, i)
        .alias("near"), F.substring(p["after"], 1, CONTEXT).alias("after"))))[0]
    described = F.transform(
        near,
        lambda p: F.struct(
            p["before"].alias("before"), p["candidate"].alias("candidate"),
            F.array(*features(p["candidate"], p["near"], p["after"], F.col(path_col))).alias("x"),
        ),
    )
    scored = F.transform(described, lambda p: F.struct(p["before"].alias("before"), p["candidate"].alias("candidate"), vote(model, p["x"]).alias("score")))
    some = text.rlike(CANDIDATE)
    return docs.withColumns({"_parts": F.when(some, scored).otherwise(F.array().cast("array<struct<before:string,candidate:string,score:double>>")),
        "_tail": F.when(some, F.element_at(pieces, -1)).otherwise(text)})


def _starts(sizes: Column) -> Column:
    """For each of the sizes the sum of those before it, with some n * sqrt(n) steps: sums of stretches of about
    sqrt(n) sizes first, then within a stretch. Longer ways would be quadratic in the candidates of a document."""

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0), lambda s, x: s + x)

    def inside(n: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(n))).cast("int")
        count = F.ceil(F.size(n) / step).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count - 1), lambda k: total(F.slice(n, k * step + 1, step)))
        begins = F.transform(F.array(sums), lambda s: F.transform(s, lambda x, k: total(F.slice(s, 1, k))))[0]
        return F.transform(F.array(begins), lambda b: F.transform(n, lambda x,
            i: F.get(b, F.floor(i / step).cast("int")) + total(F.slice(n, (F.floor(i / step) * step + 1).cast("int"), i % step))))[0]

    return F.transform(F.array(sizes), inside)[0]


def findings(scanned: DataFrame) -> DataFrame:
    """One row for each candidate: doc_id, start and end (code points), finding, score, secret."""
    starts = _starts(F.transform("_parts", lambda p: F.length(p["before"]) + F.length(p["candidate"])))
    placed = F.zip_with("_parts", starts, lambda p, s: F.struct((s + F.length(p["before"])).cast("long").alias("start"), p["candidate"].alias("finding"),
        p["score"].alias("score")))
    rows = scanned.where(F.size("_parts") > 0).select("doc_id", F.explode(placed).alias("p"))
    return rows.select("doc_id", "p.start", (F.col("p.start") + F.length("p.finding")).alias("end"), "p.finding", "p.score",
        (F.col("p.score") >= THRESHOLD).alias("secret"))


def redacted(scanned: DataFrame) -> DataFrame:
    """The columns of the scanned table with secrets masked in text, and n_chars following the text if it is there."""
    parts = F.transform("_parts", lambda p: F.concat(p["before"], F.when(p["score"] >= THRESHOLD, F.lit(MASK)).otherwise(p["candidate"])))
    hit = F.exists("_parts", lambda p: p["score"] >= THRESHOLD)
    text = F.when(hit, F.concat(F.array_join(parts, ""), F.col("_tail"))).otherwise(F.col("text"))
    out = scanned.withColumn("_text", text)
    if "n_chars" in scanned.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("_text").cast(scanned.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("_text")).drop("_parts", "_tail", "_text")
