"""Sources and sinks of pages: files, manifests, annotated books, selections, stores."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """page and text of files named page-NNNN.*, one row a file."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    return raw.select(F.regexp_extract("file", r"page-([0-9]+)", 1).try_cast("bigint").alias("page"), F.col("value").alias("text")).where("page IS NOT NULL")


def clean_text(c: Column) -> Column:
    """One kind of line end, no white space at line ends, no blank lines at the edges."""
    lines = F.transform(F.split(F.regexp_replace(c, "\r\n?", "\n"), "\n", -1), lambda x: F.regexp_replace(x, r"[ \t]+$", ""))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "^\n+", ""), "\n+$", "")


def manifest_pages(manifest: DataFrame) -> DataFrame:
    """Pages of a manifest (pages: array of scan_page, content): skipped ones out, the first of each number."""
    rows = manifest.select(F.posexplode("pages").alias("at", "p")).select("at", "p.*")
    first = F.row_number().over(Window.partitionBy("scan_page").orderBy("at"))
    return rows.withColumn("k", first).where("k = 1 AND coalesce(content, 'page') NOT IN ('blank', 'duplicate')").select("scan_page", "content")


def annotated_pages(lines: DataFrame, marker: str = r"^<!-- page_([0-9]+) -->$") -> DataFrame:
    """book, page and text from lines of annotated books: a page runs from its marker to the next (page 0: before any)."""
    own = F.regexp_extract("line", marker, 1)
    w = Window.partitionBy("book").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("m", F.when(own != "", own.cast("bigint"))).withColumn("page", F.coalesce(F.last("m", ignorenulls=True).over(w), F.lit(0)))
    body = marked.where("m IS NULL").groupBy("book", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return body.select("book", "page", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def compose(pages: DataFrame) -> DataFrame:
    """book and text: pages in order, each after its marker."""
    body = F.concat(F.lit("<!-- page_"), F.col("page").cast("string"), F.lit(" -->\n"), F.col("text"))
    rows = pages.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("page", body.alias("body")))).alias("l"))
    return rows.select("book", F.array_join(F.transform("l", lambda x: x["body"]), "\n").alias("text"))


def selected(spark: SparkSession, selection: str) -> DataFrame:
    """page: the numbers of a selection such as 1,3-5."""
    part = spark.range(1).select(F.explode(F.split(F.lit(selection), " *, *")).alias("s"))
    low, high = F.regexp_extract("s", "^ *([0-9]+)", 1).try_cast("bigint"), F.regexp_extract("s", "([0-9]+) *$", 1).try_cast("bigint")
    return part.select(F.explode(F.sequence(low, high)).alias("page")).distinct()


def sealed_records(lines: DataFrame) -> DataFrame:
    """Payloads of JSON lines {"payload": ..., "sha256": ...} whose seal holds, the first of each key."""
    body = F.regexp_extract("value", r'^\{"payload":(.*),"sha256":"[0-9a-f]{64}"\}$', 1)
    seal = F.regexp_extract("value", r'"sha256":"([0-9a-f]{64})"\}$', 1)
    good = lines.withColumn("payload", body).where((body != "") & (F.sha2(body, 256) == seal))
    key = F.get_json_object("payload", "$.key")
    return good.withColumn("key", key).withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("seq"))).where("k = 1").select("seq", "key", "payload")


def strict_json(c: Column, fields: list[str]) -> Column:
    """Problems of a JSON object: duplicate keys, unknown and missing fields, or no object at all."""

    def problems(text: str | None) -> list[str]:
        found: list[str] = []

        def pairs(items: list[tuple[str, object]]) -> dict[str, object]:
            names = [k for k, _ in items]
            found.extend(f"duplicate {k}" for k in sorted({k for k in names if names.count(k) > 1}))
            return dict(items)

        try:
            got = json.loads(text or "", object_pairs_hook=pairs)
        except ValueError:
            return ["not JSON"]
        if not isinstance(got, dict):
            return ["not an object"]
        return found + [f"unknown {k}" for k in sorted(set(got) - set(fields))] + [f"missing {k}" for k in fields if k not in got]

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series([problems(t) for t in x], dtype=object)

    return run(c)


def canonical_json(c: Column) -> Column:
    """JSON with sorted keys and no spaces, null for what is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return json.dumps(json.loads(text or ""), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in x], dtype=object)

    return run(c)
