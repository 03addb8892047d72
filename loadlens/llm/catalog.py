"""One query per operator over its whole table, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import (
    bpe,
    cover_tree,
    extraction,
    mixing,
    negatives,
    packing,
    pivots,
    quality,
    repeats,
    simhash,
    spelling,
    token_counts,
    url_rules,
)
from loadlens.llm.shared import ready

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def unigram_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _table(spark, sf_dir, "documents").select("doc_id", token_counts.count(F.col("text"), RANKS).alias("c"))
    return counted.select("doc_id", "c.n_tokens", "c.n_pretokens")


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), RANKS).alias("ids"))
    raw = ids.withColumn("raw", bpe.decode(F.col("ids"), RANKS))
    return raw.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(documents, _table(spark, sf_dir, "labels"))
    return quality.score(documents, model).select(
        "row.doc_id",
        quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.taken(pieces).select("doc_id", "size", "source_size", "target", "taken", "shards")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.filter_pages(spark, _table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(_table(spark, sf_dir, "embeddings"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = repeats.mark(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    ends = F.filter("spans", lambda _, i: i % 2 == 1)
    begins = F.filter("spans", lambda _, i: i % 2 == 0)
    total = lambda places: F.aggregate(places, F.lit(0).cast("long"), lambda n, x: n + x)
    removed = total(ends) - total(begins)
    # texts that stay or go as a whole need not be cut in Python
    cut = F.when((removed > 0) & (removed < size), F.col("text"))
    left = F.when(removed == 0, F.coalesce(F.col("text").cast("binary"), F.lit(b""))).when(removed == size, F.lit(b"")).otherwise(repeats.kept_bytes(cut, "spans"))
    return marked.select(
        "doc_id",
        size.alias("n_bytes"),
        removed.alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2(left, 256).alias("kept_sha256"),
    )


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_table(spark, sf_dir, "documents")))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": simhash_near_dedup,
    "op2_unigram_token_counts": unigram_token_counts,
    "op3_exact_top_k": exact_top_k,
    "op4_byte_bpe": byte_bpe,
    "op5_quality_classifier": quality_classifier,
    "op6_html_extraction": html_extraction,
    "op7_source_mixing": source_mixing,
    "op8_url_filter": url_filter,
    "op9_embedding_near_dedup": embedding_near_dedup,
    "op10_repeated_bytes": repeated_bytes,
    "op11_best_fit_packing": best_fit_packing,
    "op12_spelling_variants": spelling_variants,
    "op13_hard_negatives": hard_negatives,
}

SQL: dict[str, str] = {
    "op3_exact_top_k": r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.w, v.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.w) = len(v.w)),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5""",
    "op7_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
total AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM total),
levels AS (
  SELECT *, 3 * source_size / weight AS height,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
  FROM weighed
  WINDOW f AS (ORDER BY 3 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
  SELECT level AS share FROM levels WHERE level < height ORDER BY height, place LIMIT 1),
aims AS (
  SELECT source, source_size, place,
         least((3 * source_size)::DOUBLE, coalesce((SELECT share FROM shared) * weight, (3 * source_size)::DOUBLE)) AS target FROM levels),
lines AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws('|', '20', doc_id::VARCHAR, source)), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sized),
drawn AS (
  SELECT source, place, floor(target)::HUGEINT AS drawn, sum(floor(target)) OVER ()::HUGEINT AS everything,
         greatest(0, 1024 - count(*) OVER ())::HUGEINT AS free FROM aims WHERE floor(target) > 0),
rests AS (
  SELECT *, drawn * free // everything AS whole, row_number() OVER (ORDER BY drawn * free % everything DESC, place) AS turn FROM drawn),
quotas AS (
  SELECT source, place, drawn, (1 + whole + CASE WHEN turn <= free - sum(whole) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM rests),
unit AS (
  SELECT source, drawn, quota, place, unnest(range(quota)) AS block, 0 AS shard FROM quotas),
cut16 AS (
  SELECT source, drawn, quota, place, block,
         shard + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', '20', '16', place::VARCHAR, block::VARCHAR)), place, block)
                           > count(*) OVER (PARTITION BY shard) / 2 THEN 8 ELSE 0 END AS shard FROM unit),
cut8 AS (
  SELECT source, drawn, quota, place, block,
         shard + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', '20', '8', place::VARCHAR, block::VARCHAR)), place, block)
                           > count(*) OVER (PARTITION BY shard) / 2 THEN 4 ELSE 0 END AS shard FROM cut16),
cut4 AS (
  SELECT source, drawn, quota, place, block,
         shard + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', '20', '4', place::VARCHAR, block::VARCHAR)), place, block)
                           > count(*) OVER (PARTITION BY shard) / 2 THEN 2 ELSE 0 END AS shard FROM cut8),
cut2 AS (
  SELECT source, drawn, quota, place, block,
         shard + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', '20', '2', place::VARCHAR, block::VARCHAR)), place, block)
                           > count(*) OVER (PARTITION BY shard) / 2 THEN 1 ELSE 0 END AS shard FROM cut4),
blocks AS (
  SELECT source, drawn * block // quota AS b, drawn * (block + 1) // quota AS e, shard FROM cut2),
placed AS (
  SELECT lines.*, source_size, target, row_number() OVER () AS row
  FROM lines JOIN aims ON lines.source IS NOT DISTINCT FROM aims.source),
met AS (
  SELECT row, array_to_string(list_sort(list_distinct(list(shard))), ',') AS shards
  FROM placed CROSS JOIN range(3) AS passes(pass) JOIN blocks ON placed.source IS NOT DISTINCT FROM blocks.source
   AND b < pass * source_size + start + size AND e > pass * source_size + start AND e > b
  WHERE size > 0 GROUP BY row)
SELECT doc_id, size, source_size, target,
       (size * (floor(target)::BIGINT // greatest(source_size, 1))
        + greatest(0, least(start + size, floor(target)::BIGINT % greatest(source_size, 1)) - start))::BIGINT AS taken,
       coalesce(shards, '') AS shards
FROM placed LEFT JOIN met USING (row)""",
    "op8_url_filter": r"""
WITH parts AS (
  SELECT page_id, url, row_number() OVER () AS row,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT row, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (row)""",
    "op9_embedding_near_dedup": r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS good FROM embeddings),
links AS (
  SELECT a.row AS a, b.row AS b FROM v AS a JOIN v AS b ON a.row <> b.row AND a.good AND b.good AND len(a.e) = len(b.e)
  WHERE CASE WHEN a.good AND b.good AND len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.9),
reach AS (
  SELECT row AS a, row AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (
  SELECT reach.a AS row, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.row GROUP BY reach.a),
degrees AS (
  SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, component_id IS NULL) AS kept
FROM v JOIN classes USING (row) LEFT JOIN degrees USING (row)""",
    "op10_repeated_bytes": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
chunks AS (
  SELECT row, k, n, substr(h, 512 * k + 1, 910) AS c
  FROM (SELECT row, h, n, unnest(range((n - 200) // 256 + 1)) AS k FROM docs WHERE n >= 200)),
starts AS (
  SELECT row, 256 * k + j AS i, md5(substr(c, 2 * j + 1, 400)) AS w
  FROM (SELECT row, k, c, unnest(range(least(256, n - 199 - 256 * k))) AS j FROM chunks)),
twice AS (
  SELECT w FROM starts GROUP BY w HAVING count(*) > 1),
marked AS (
  SELECT row, i, CASE WHEN i > lag(i) OVER (PARTITION BY row ORDER BY i) + 200 THEN 1 ELSE 0 END AS gap
  FROM starts WHERE w IN (SELECT w FROM twice)),
spans AS (
  SELECT row, min(i) AS b, max(i) + 200 AS e
  FROM (SELECT row, i, sum(gap) OVER (PARTITION BY row ORDER BY i) AS run FROM marked) GROUP BY row, run),
pieces AS (
  SELECT row, b, e, lag(e, 1, 0) OVER (PARTITION BY row ORDER BY b) AS since FROM spans),
cut AS (
  SELECT row, sum(e - b) AS removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (b - since)), '' ORDER BY b) AS head
  FROM pieces JOIN docs USING (row) GROUP BY row)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (row)""",
    "op12_spelling_variants": r"""
WITH RECURSIVE ascii AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
runs AS (
  SELECT doc_id, r, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(t, '[A-Za-zÀ-ÿ]+')) AS r FROM ascii) GROUP BY doc_id, r),
bits(b, step, x) AS (
  SELECT range, 0, range FROM range(256) UNION ALL
  SELECT b, step + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM bits WHERE step < 8),
steps AS (
  SELECT list(x ORDER BY b) AS t FROM bits WHERE step = 8),
keyed AS (
  SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS k FROM runs),
hashed AS (
  SELECT r, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(k), 2), lambda i: ('0x' || substr(k, i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps.t[(xor(c, b) & 255) + 1]))) AS h FROM keyed, steps),
shown AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM shown WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM places),
gaps AS (
  SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k FROM places),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps AS a JOIN gaps AS b ON a.k = b.k AND a.word <> b.word UNION ALL
  SELECT a.word, a.n, b.word, b.n FROM cut AS a JOIN words AS b ON a.k = b.word UNION ALL
  SELECT b.word, b.n, a.word, a.n FROM cut AS a JOIN words AS b ON a.k = b.word),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN near_n >= 2 * words.n THEN near END AS form, CASE WHEN near_n >= 2 * words.n THEN near_n END::BIGINT AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1),
chains AS (
  SELECT word, word AS at FROM forms UNION ALL
  SELECT chains.word, forms.form FROM chains JOIN forms ON chains.at = forms.word WHERE forms.form IS NOT NULL),
ends AS (
  SELECT chains.word, chains.at AS root FROM chains JOIN forms ON chains.at = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)""",
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.w, b.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.row <> b.row AND len(a.w) = len(b.w)),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS nth FROM scored WHERE same) WHERE nth <= 5),
mined AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.vec_id, n.row))::INTEGER AS rank
  FROM positives AS p JOIN scored AS n ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT * FROM mined WHERE rank <= 5""",
}
