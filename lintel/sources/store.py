"""CSV with header contracts, versioned stores, sinks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The headers that listing files come with.
MASTER = ("page", "category", "updated_at", "building_name", "room", "address", "rent_man", "fee_man", "floor", "layout", "area_sqm", "availability_raw", "built_raw",
    "age_years", "structure", "built_year_month", "built_age_years", "availability_date", "availability_flag_immediate", "structure_raw", "raw_block", "evidence_id")
CLASSIC = ("page", "category", "updated_at", "building_name", "room", "address", "rent_man", "fee_man", "floor", "layout", "area_sqm", "age_years", "structure",
    "raw_block", "evidence_id")
WITH_FILE = ("category", "updated_at", "building_name", "room", "address", "rent_man", "fee_man", "layout", "floor", "area_sqm", "age_years", "structure", "file", "page",
    "raw_block", "evidence_id")
FACTS_REQUIRED = ("building_name", "address", "evidence_id")
RELOAD_REQUIRED = ("page", "category", "updated_at", "building_name", "room", "address", "rent_man", "fee_man", "floor", "layout", "area_sqm", "raw_block")


def _without(cols: tuple[str, ...], *gone: str) -> tuple[str, ...]:
    return tuple(c for c in cols if c not in gone)


#: All accepted headers of listing files, as exact tuples.
DIALECTS = frozenset(
    d for base in (MASTER, _without(MASTER, "evidence_id"), CLASSIC, WITH_FILE) for d in (base, _without(base, "age_years", "structure"))
)


class HeaderError(ValueError):
    """A file's header is not one that is accepted."""


def header(spark: SparkSession, path: str) -> list[str]:
    """The first line's columns, without a byte order mark."""
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    return [n.lstrip("﻿").strip() for n in names]


def read_csv(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """All columns as text, quoted line breaks allowed; columns: those wanted, absent ones null."""
    names = header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', enforceSchema=True).csv(path)
    return df if columns is None else with_columns(df, columns)


def with_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def exact_header(names: Iterable[str]) -> None:
    if tuple(names) not in DIALECTS:
        raise HeaderError(f"unknown header: {list(names)}")


def required_header(names: Iterable[str], required: Iterable[str]) -> None:
    if missing := sorted(set(required) - set(names)):
        raise HeaderError(f"missing columns: {missing}")


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """A listing file of any accepted dialect in the full set of columns."""
    exact_header(header(spark, path))
    return read_csv(spark, path, [*MASTER, "file"])


def numbered(df: DataFrame, start: int = 2, name: str = "row_no") -> DataFrame:
    """Rows numbered in reading order, from the line after the header. Each partition numbers its own rows, after the
    rows of the partitions before it, which are counted first: one small row for each partition is joined."""
    at = F.monotonically_increasing_id()
    part, place = F.shiftright(at, 33), at.bitwiseAND(F.lit((1 << 33) - 1))
    counts = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    placed = df.withColumns({"_part": part, "_place": place})
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_place") + start).drop("_part", "_place", "_before")


def csv_line(columns: Iterable[Column]) -> Column:
    """Values as one line, each in quotes, quotes doubled, null as empty."""
    return F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in columns])


def write_csv(df: DataFrame, path: str, columns: Iterable[str]) -> None:
    """Files that each begin with a byte order mark and the header; every value quoted, CRLF, missing columns and values empty."""
    columns = list(columns)
    head = "\ufeff" + ",".join('"' + c.replace('"', '""') + '"' for c in columns)
    lines = with_columns(df, columns).select(csv_line(map(F.col, columns)).alias("value"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [head]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

    lines.mapInArrow(headed, "value string").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html): every HTML file below a folder, as a whole."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html").select(F.input_file_name().alias("path"),
        F.col("value").alias("html"))


def file_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, sha256, modified, pages) of files, for manifests and to choose the latest. pages: of a PDF the page
    objects that stand in it uncompressed, null for other files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"),
        pdf_pages(F.col("content")).alias("pages"))


def pdf_pages(content: Column) -> Column:
    """The page objects of a PDF file; null for other bytes."""
    text = F.decode(content, "ISO-8859-1")
    return F.when(F.startswith(text, F.lit("%PDF")), F.regexp_count(text, F.lit(r"/Type\s*/Page\b")))


def raw_sources(rows: DataFrame, kind: str, column: str = "source_kind", order: str = "id") -> DataFrame:
    """The rows of one kind of source in the order of their ids."""
    return rows.where(F.col(column) == kind).orderBy(order)


def backfilled(df: DataFrame, legacy: dict[str, str]) -> DataFrame:
    """Each new column where it has a value, else the older column that it replaces (new -> old), where the table has that."""
    return df.withColumns({new: F.coalesce(new, old) for new, old in legacy.items() if old in df.columns})


def latest_file(files: DataFrame) -> str | None:
    row = files.agg(F.max_by("path", "modified").alias("path")).first()
    return row["path"]


def cached_pages(urls: DataFrame, cache: DataFrame) -> DataFrame:
    """Fetched pages by the hash of their url; those that are not there have null html."""
    return urls.withColumn("key", F.sha1(F.encode("url", "UTF-8"))).join(cache.select("key", "html"), "key", "left").drop("key")


def geocoded(places: DataFrame, cache: DataFrame) -> DataFrame:
    """Coordinates from the cache, only for addresses without lot numbers; others keep what they have."""
    c = cache.select(F.col("query").alias("address"), F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    coarse = ~F.contains(F.coalesce("address", F.lit("")), F.lit("-"))
    j = places.join(c, "address", "left")
    return j.withColumns({x: F.when(coarse & F.col(x).isNull(), F.col(f"c_{x}")).otherwise(F.col(x)) for x in ("lat", "lng")}).drop("c_lat",
        "c_lng").select(*places.columns)


# stores ---------------------------------------------------------------------------------------


def conform(df: DataFrame, schema: T.StructType, required: Iterable[str] = ()) -> DataFrame:
    """Additive evolution: missing columns as null, further ones kept; required ones must be there."""
    required_header(df.columns, required)
    known = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*known, *[c for c in df.columns if c not in schema.names])


def migrated(df: DataFrame, renames: dict[str, str], schema: T.StructType) -> DataFrame:
    """An older table in the new form."""
    return conform(df.withColumnsRenamed(renames), schema).select(*schema.names)


def first_name(df: DataFrame, *names: str) -> str:
    """The first of several names of a column that the table has."""
    for n in names:
        if n in df.columns:
            return n
    raise HeaderError(f"none of {names} in {df.columns}")


def table_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


class Store:
    """Named tables under a folder, each write a new version, one pointer file to all current ones.

    Readers see the old versions until the pointer is replaced; a failed write leaves it as it was."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self) -> DataFrame | None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/current")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema("generation long, name string, path string").json(f"{self.root}/current")

    def current(self) -> dict[str, str]:
        """Table name -> folder of its current version."""
        pointer = self._pointer()
        if pointer is None:
            return {}
        rows = pointer.where(F.col("generation") == pointer.agg(F.max("generation")).first()[0]).collect()
        return {r["name"]: r["path"] for r in rows}

    def parts(self, name: str) -> dict[int | None, str]:
        """Folders of a table by bucket; the only one is None where it was written as a whole."""
        found = {n.partition("#")[::2]: p for n, p in self.current().items()}
        return {int(b) if b else None: p for (n, b), p in found.items() if n == name}

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or those of its buckets that it has; KeyError if there is nothing to read."""
        parts = self.parts(name)
        paths = list(parts.values()) if buckets is None else [parts[b] for b in buckets if b in parts]
        if not paths:
            raise KeyError(name)
        return self.spark.read.parquet(*paths)

    def publish(self, tables: dict[str, DataFrame], not_empty: Iterable[str] = (), buckets: dict[str, tuple[DataFrame, str, list[int]]] | None = None) -> None:
        """Write all tables, check them, then move the pointer to them together.

        buckets: name -> (rows, column with the bucket, buckets that are replaced); other buckets stay as they are."""
        import uuid

        paths = {n: f"{self.root}/{n}/{uuid.uuid4().hex}" for n in tables}
        for n, df in tables.items():
            df.write.parquet(paths[n])
        for n, (df, column, numbers) in (buckets or {}).items():
            folder = f"{self.root}/{n}/{uuid.uuid4().hex}"
            df.repartition(column).write.partitionBy(column).parquet(folder)
            paths.update({f"{n}#{b}": f"{folder}/{column}={b}" for b in numbers})
        for n in not_empty:
            if not self.spark.read.parquet(paths[n]).head(1):
                raise ValueError(f"{n} has no rows; nothing was published")
        pointer = self._pointer()
        last = pointer.agg(F.max("generation")).first()[0] if pointer is not None else 0
        now = {**self.current(), **paths}
        rows = [(last + 1, n, p) for n, p in sorted(now.items())]
        self.spark.createDataFrame(rows, "generation long, name string, path string").coalesce(1).write.mode("append").json(f"{self.root}/current")
