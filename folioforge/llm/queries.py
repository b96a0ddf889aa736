"""The registered queries of the ten operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .gif import media_digest
from .interpolation import deleted_interpolation
from .licenses import license_labels
from .minhash import near_classes
from .naming import exact_groups
from .packing import pack
from .pieces import encode_pieces
from .seeds import repeat_digest
from .sharding import histogram_shards
from .toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interpolation(_documents(spark, sf_dir))


def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(_documents(spark, sf_dir), width=5, threshold=85)


def op4_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(_documents(spark, sf_dir), window=20)


def op5_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir))


def op6_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), length=1024)


def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards(_documents(spark, sf_dir), shards=40)


def op8_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(_documents(spark, sf_dir))


def op9_batched_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_deleted_interpolation, op2_toxic_segments, op3_circulant_minhash, op4_seed_extend, op5_block_naming, op6_shortest_pack_first, op7_histogram_sort, op8_diagonal_voting, op9_batched_viterbi, op10_gif)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_circulant_minhash": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
             s AS (SELECT DISTINCT doc_id, sh FROM (
                     SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
                     UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS nb FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
             l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * nb >= 85 * (x.n + y.n - nb)),
             e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
             c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
        FROM w JOIN c ON c.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
    """,
    "op4_seed_extend": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20),
             k AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS h FROM p),
             r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM k),
             c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r WHERE n > 1),
             x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
             k2 AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS kept, count(*) AS n_kept
                    FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i WHERE c.i IS NULL GROUP BY x.doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k2 ON k2.doc_id = w.doc_id
    """,
    "op5_block_naming": f"""
        WITH t AS (SELECT doc_id, {_LOWER} AS x FROM documents),
             g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.x) AS text_sha256
        FROM t JOIN g ON t.x = g.x
    """,
}
