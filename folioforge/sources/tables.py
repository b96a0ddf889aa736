"""Tables, and documents seen as the pages of books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pages in a book at most, so that no window over a book grows with the collection.
BOOK_PAGES = 1000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def books(docs: DataFrame, pages: int = BOOK_PAGES) -> DataFrame:
    """Adds book (a source's run of doc_ids) and page."""
    book = F.concat_ws("/", F.coalesce("source", F.lit("")), F.floor(F.col("doc_id") / pages).cast("string"))
    return docs.withColumn("book", book).withColumn("page", F.col("doc_id").cast("bigint"))


def lines(docs: DataFrame) -> DataFrame:
    """book, page, line_no (from 0) and line."""
    keep = [c for c in ("book", "page", "doc_id", "source") if c in docs.columns]
    return docs.select(*keep, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("bigint"))
