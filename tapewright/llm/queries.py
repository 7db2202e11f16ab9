"""The registered queries of the corpus operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroid_clustering import cluster_vectors
from .decontamination import find_leaks
from .hard_negatives import mine_hard_negatives
from .line_dedup import dedup_lines
from .minhash_dedup import near_duplicates
from .packing import pack_documents
from .passage_dedup import find_passages
from .piece_codec import encode_decode
from .pseudonyms import pseudonymize_documents
from .quality_rules import BOILERPLATE, clean_lines
from .sharding import kd_shards
from .shared import sha256_hex, table
from .suffix_dedup import remove_repeats
from .warc import archive_and_read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_hex(listed).alias("ids_sha256"), sha256_hex(F.col("decoded")).alias("decoded_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_and_read(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with personal data. A production run passes its own secret; this one is for tests."""
    return pseudonymize_documents(table(spark, sf_dir, "documents"), b"a key for tests only").filter("n_values > 0")


def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), sha256_hex(F.col("kept")).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: 16 leaves of near equal bytes, cut along text length, language, source and id."""
    dims = {"bytes": F.octet_length("text"), "lang": F.crc32(F.col("lang").cast("binary")), "source": F.crc32(F.col("source").cast("binary"))}
    placed = kd_shards(table(spark, sf_dir, "documents"), "doc_id", "text", dims, n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = sha256_hex(F.array_join(F.col("centroid").cast("array<string>"), ","))
    total = centroids.agg(F.sum("inertia").alias("whole"))
    named = centroids.crossJoin(F.broadcast(total)).select("cluster", F.col("inertia").alias("cluster_inertia"), F.col("whole").alias("inertia"), digest.alias("centroid_sha256"))  # 40 rows and one
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_piece_codec": op3_piece_codec,
    "op4_warc": op4_warc,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_passage_dedup": op7_passage_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_packing": op12_packing,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, l.n, l.line, translate(regexp_replace(l.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'n': i, 'line': x})) AS l FROM documents)
), firsts AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT l.doc_id, l.n, l.line, f.k IS NOT NULL AND l.doc_id > f.first AS gone FROM lines l LEFT JOIN firsts f ON l.k = f.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP4_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, ((k // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM m
"""

_OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY doc_id
), item AS (
  SELECT doc_id, l, list_transform(l, lambda x: len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) <= 3 AND length(x) <= 60
    AND NOT regexp_matches(x, '[.!?:;,…。！？]["''”’»)\]\x20\x09-\x0D]*$')) AS f FROM d
), line AS (
  SELECT DISTINCT doc_id, l[i] AS x, regexp_replace(l[i], '[\x20\x09-\x0D]+', '', 'g') AS bare FROM (SELECT doc_id, l, f, unnest(range(1, len(l) + 1)) AS i FROM item)
  WHERE NOT (f[i] AND ((i > 1 AND f[i - 1] AND ((i > 2 AND f[i - 2]) OR coalesce(f[i + 1], false))) OR (coalesce(f[i + 1], false) AND coalesce(f[i + 2], false))))
), counted AS (
  SELECT doc_id, x, bare, len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS words, len(regexp_extract_all(bare, '[|»›•·]')) AS separators FROM line
), stay AS (
  SELECT doc_id, count(*) AS n, sum(words) AS words FROM counted WHERE NOT (
    len(regexp_extract_all(bare, '[#*$%&|<>{{}}\[\]=~^`\\]')) > 0.1 * length(bare)
    OR (len(regexp_extract_all(bare, '[!?]')) - len(regexp_extract_all(bare, '[!?]+'))) * 12 > 0.3 * length(bare)
    OR (separators >= 3 AND separators * 60 >= length(bare))
    OR (words <= 12 AND length(x) <= 240 AND regexp_matches(x, '(?i)©|\(c\) ?\d{{4}}|\b(?:{'|'.join(BOILERPLATE)})\b'))) GROUP BY doc_id
), base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words, (len(l) - coalesce(s.n, 0))::BIGINT AS n_failed_lines, coalesce(s.words, 0)::BIGINT AS kept_words
  FROM d LEFT JOIN again a USING (doc_id) LEFT JOIN stay s USING (doc_id)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND kept_words >= 0.5 * n_words AS kept FROM judged
"""



def _op11_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Plain full scans: one common table expression for each assignment and each set of centroids."""
    apart = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    near = f"SELECT v.vec_id, v.n, v.x, arg_min(c.cluster, ({apart}) * {k} + c.cluster) AS cluster, min({apart}) AS distance FROM v CROSS JOIN {{c}} AS c GROUP BY v.vec_id, v.n, v.x"
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster, x FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k})",
    ]
    for r in range(rounds):
        steps += [
            f"a{r} AS MATERIALIZED ({near.format(c=f'c{r}')})",
            f"m{r} AS (SELECT cluster, list(floor_mean ORDER BY d) AS x FROM (SELECT cluster, d, (s - ((s % n) + n) % n) // n AS floor_mean FROM (SELECT cluster, d, sum(x[d])::BIGINT AS s, count(*) AS n FROM a{r} CROSS JOIN (SELECT unnest(range(1, {dims + 1})) AS d) GROUP BY cluster, d)) GROUP BY cluster)",
            f"c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} AS c LEFT JOIN m{r} AS m USING (cluster))",
        ]
    last = f"a{rounds} AS MATERIALIZED ({near.format(c=f'c{rounds}')})"
    return f"""WITH {', '.join([*steps, last])}
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c USING (cluster)"""


_OP13_SQL = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""

LLM_SQL: dict[str, str] = {
    "op1_line_dedup": _OP1_SQL,
    "op4_warc": _OP4_SQL,
    "op9_quality_rules": _OP9_SQL,
    "op11_centroid_clustering": _op11_sql(),
    "op13_hard_negatives": _OP13_SQL,
}
