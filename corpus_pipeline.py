"""The corpus pipeline: documents in, piece ids of the documents that stay out.

Each stage takes all that the one before it kept. Cases that hold for all stages: an empty table gives an empty
table; further columns, whatever their names, are dropped by the first stage and do no harm; a null or empty text
is a document like any other; repeated rows and ties are decided by values, never by the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel import ship
from lintel.llm import decontaminate, minhash, pieces, secrets, toxicity
from lintel.llm.common import discard, scratch, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold stay; the model learns from the labels of the whole table.

    Null and empty texts have the score of a document without sentences and stay. Rows with a null doc_id are scored
    like others and learnt from never. Repeated rows have one score. A very long text is read sentence by sentence.
    Without labels, or with those of one kind only, all scores are the share of toxic labels."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id: five words, similarity 0.8.

    Rows without words, and rows with a null doc_id, are linked with nothing and all stay. Of linked rows that repeat
    the smallest doc_id that with the least text stays; rows that repeat a doc_id with unlike texts all stay. A very
    long text is one set of shingles."""
    return minhash.kept_rows(docs, minhash.Settings(words=5, percent=80)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts stay. Rows go by doc_id (null included) and text, so that of rows which repeat a doc_id only
    those with a passage go. Items that are null or empty match nothing; items of under 16 characters only exactly, as
    whole words. A very long text is searched in blocks. An empty benchmark drops nothing."""
    return decontaminate.clean_rows(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked and n_chars follows; no document goes.

    Null and empty texts stay as they are, a null source is a path without words, repeated rows are masked alike."""
    return secrets.redacted(secrets.scan(docs.select(*COLUMNS), secrets.trained(spark))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left, one row for each row.

    Null and empty texts have no ids; null ids of documents and repeated rows are kept; a very long word is encoded
    character by character."""
    return pieces.encode(docs, pieces.Model.load())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("pieces", tokenize)]

#: The stages are models and sketches, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before it wrote. Tables that a stage needs are deleted at its end,
    what it was handed likewise; the last stage is not written, so that its input stays."""
    ship(spark)
    docs, handed_on = table(spark, sf_dir, "documents"), None
    *first, (_, last) = STAGES
    for name, stage in first:
        with scratch(spark) as keep:
            docs = keep(written(stage(spark, docs, sf_dir), name))
        if handed_on is not None:
            discard(handed_on)
        handed_on = docs
    return last(spark, docs, sf_dir)
