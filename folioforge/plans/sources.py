"""Queries over sources, sinks and streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import pages as pg
from ..sources.tables import books, lines, load
from ..streaming import watch as wt
from .registry import BOOKS, query


def _shared(spark: SparkSession) -> str:
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    return (found or f"file://{tempfile.mkdtemp(prefix='streams-')}").rstrip("/") + f"/stream-{uuid.uuid4().hex}"


@query("SRC-2", sql=r"SELECT doc_id, sha256(regexp_replace(regexp_replace(array_to_string(list_transform(string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, '[ \t]+$', '')), chr(10)), '^\n+', ''), '\n+$', '')) AS text_sha256 FROM documents")
def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id", F.sha2(pg.clean_text(T.text_of()), 256).alias("text_sha256"))


def _manifest_pages(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.element_at(F.array(F.lit("blank"), F.lit("duplicate"), F.lit("page"), F.lit("page"), F.lit("page")), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = load(spark, sf, "documents").select(F.floor(F.col("doc_id") / 2).alias("scan_page"), "doc_id", kinds.alias("content"))
    # each manifest lists a thousand pages
    manifests = rows.groupBy(F.floor(F.col("scan_page") / 1000).alias("m")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "scan_page", "content"))).alias("pages"))
    return pg.manifest_pages(manifests)


@query("SRC-4", "SRC-6", "WN-12", sql="WITH p AS (SELECT doc_id // 2 AS scan_page, CASE doc_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'duplicate' ELSE 'page' END AS content, row_number() OVER (PARTITION BY doc_id // 2 ORDER BY doc_id) AS k FROM documents) SELECT scan_page, content FROM p WHERE k = 1 AND content = 'page' AND (scan_page BETWEEN 3 AND 90 OR scan_page = 120)")
def manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Listed pages: the first of each number, without blanks and duplicates, of the selection 3-90,120."""
    return _manifest_pages(spark, sf).join(pg.selected(spark, "3-90,120").withColumnRenamed("page", "scan_page"), "scan_page", "left_semi")


@query("SRC-4", "WN-12", sql="WITH p AS (SELECT doc_id // 2 AS scan_page, CASE doc_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'duplicate' ELSE 'page' END AS content, row_number() OVER (PARTITION BY doc_id // 2 ORDER BY doc_id) AS k FROM documents) SELECT scan_page, content FROM p WHERE k = 1 AND content = 'page'")
def manifest_scan_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Listed pages of all manifests, without a selection."""
    return _manifest_pages(spark, sf)


@query("SRC-5", "SNK-2", "SNK-4", sql=f"WITH {BOOKS} SELECT book, page, sha256(coalesce(text, '')) AS text_sha256 FROM books")
def book_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Pages composed to annotated books and split again: byte for byte the same."""
    whole = pg.compose(books(load(spark, sf, "documents")).select("book", "page", T.text_of().alias("text")))
    return pg.annotated_pages(lines(whole)).select("book", "page", F.sha2("text", 256).alias("text_sha256"))


@query("SNK-3", "JN-2", "JN-3", sql=f"WITH {BOOKS}, t AS (SELECT page, text FROM books WHERE page % 11 <> 3), d AS (SELECT page, text FROM books WHERE page % 4 = 0) SELECT b.book, count(*) AS pages, count(*) FILTER (t.text IS NULL AND d.text IS NULL) AS gaps, sha256(string_agg(coalesce(t.text, d.text, '[page ' || b.page || ' missing]'), chr(10) ORDER BY b.page)) AS text_sha256 FROM books b LEFT JOIN t USING (page) LEFT JOIN d USING (page) GROUP BY 1")
def draft_books(spark: SparkSession, sf: str) -> DataFrame:
    """A book from sealed texts, else drafts, else a line that shows the gap."""
    pages = books(load(spark, sf, "documents")).select("book", "page", "text")
    sealed, draft = pages.where("page % 11 <> 3").select("page", F.col("text").alias("s")), pages.where("page % 4 = 0").select("page", F.col("text").alias("d"))
    j = pages.select("book", "page").join(sealed, "page", "left").join(draft, "page", "left")
    line = F.coalesce("s", "d", F.concat(F.lit("[page "), F.col("page").cast("string"), F.lit(" missing]")))
    out = j.groupBy("book").agg(F.count("*").alias("pages"), F.count_if(F.col("s").isNull() & F.col("d").isNull()).alias("gaps"), F.array_sort(F.collect_list(F.struct("page", line.alias("t")))).alias("l"))
    return out.select("book", "pages", "gaps", F.sha2(F.array_join(F.transform("l", lambda x: x["t"]), "\n"), 256).alias("text_sha256"))


@query("SRC-8", "SM-4", sql="SELECT user_id % 50 AS key, min(event_id) AS seq FROM events WHERE event_id % 7 <> 3 GROUP BY 1")
def sealed_store(spark: SparkSession, sf: str) -> DataFrame:
    """A store of sealed lines: broken seals are passed over, the first record of a key stands."""
    e = load(spark, sf, "events").select("event_id", (F.col("user_id") % 50).alias("key"))
    payload = F.concat(F.lit('{"key":"'), F.col("key").cast("string"), F.lit('","id":'), F.col("event_id").cast("string"), F.lit("}"))
    seal = F.when(F.col("event_id") % 7 == 3, F.sha2(F.lit("broken"), 256)).otherwise(F.sha2(payload, 256))
    rows = e.select(F.col("event_id").alias("seq"), F.concat(F.lit('{"payload":'), payload, F.lit(',"sha256":"'), seal, F.lit('"}')).alias("value"))
    return pg.sealed_records(rows).select(F.col("key").cast("bigint").alias("key"), "seq")


@query("PRJ-8", "SC-13", sql="SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) IS NOT NULL AS has_first FROM events WHERE props IS NOT NULL")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").where("props IS NOT NULL")
    return e.select("event_id", F.expr("get_json_object(props, concat('$.', element_at(json_object_keys(props), 1)))").isNotNull().alias("has_first"))


@query("SRC-3", "HX-10", "SC-13")
def strict_records(spark: SparkSession, sf: str) -> DataFrame:
    """Problems of JSON records against a closed set of fields, and their canonical hash."""
    e = load(spark, sf, "events")
    return e.select("event_id", F.size(pg.strict_json(F.col("props"), ["page", "ref"])).alias("problems"), F.sha2(pg.canonical_json(F.col("props")), 256).alias("canonical_sha256"))


@query("SM-3", sql="SELECT event_type, count(*) AS events, max(event_id) AS last_id FROM events GROUP BY 1")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Counts kept by a stream over the events, read when it has caught up."""
    schema = load(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    name = f"progress_{uuid.uuid4().hex}"
    q = wt.progress(stream).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", _shared(spark)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@query("SM-1", "SC-8")
def stream_loop_watch(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of a conversation as pieces of one text, repeated: the first loop of each stream."""
    schema = load(spark, sf, "conversations").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/conversations.parquet*")
    pieces = stream.select(F.col("conv_id").alias("stream"), F.col("turn").alias("seq"), F.repeat("text", F.lit(12)).alias("piece"))
    name = f"loops_{uuid.uuid4().hex}"
    q = wt.watch_loops(pieces).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", _shared(spark)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
