"""One query per operator, over its whole table, and the SQL that must give the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.llm import (
    chat_format, decontamination, exact_dedup, hard_negatives, line_dedup, near_dedup, packing, quality, revisits, simhash,
    substring_dedup, toxicity, whitening,
)
from delayscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The ranks of the vocabulary byte_bpe_50k.json, which give the same ids.
VOCABULARY = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


SQL["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""

#: Fixed value: both turns of the conversation that the contract adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op10_chat_format(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return chat_format.read_back(chat_format.format_chats(turns.unionByName(added)))


SQL["op10_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
  SELECT *, coalesce(role, '') AS who, coalesce(text, '') AS said, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM t),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(who || chr(10) || said || chr(10), '' ORDER BY place) AS whole,
    coalesce(string_agg(said, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(13 + length(regexp_replace(who, '([\\<\[\n])', 'xx', 'g')) + length(regexp_replace(said, '([\\<\[])', 'xx', 'g'))) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""


@query
def op6_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


SQL["op6_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.y FROM reached r JOIN both_ways e ON e.x = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op3_line_dedup(spark, sf):
    return line_dedup.line_decisions(table(spark, sf, "documents")).drop("doc_key")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@query
def op5_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), vocabulary())


@query
def op9_toxicity(spark, sf):
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op2_decontamination(spark, sf):
    return decontamination.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL["op2_decontamination"] = r"""
WITH words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
shingles AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
  FROM words WHERE len(w) > 4),
sizes AS (SELECT id, count(*) AS n_item FROM shingles WHERE kind = 'b' GROUP BY id)
SELECT b.id AS item_id, d.id AS doc_id, any_value(n_item) AS n_item, count(*) AS n_shared
FROM shingles b JOIN shingles d ON d.s = b.s AND d.kind = 'd' JOIN sizes ON sizes.id = b.id
WHERE b.kind = 'b' GROUP BY b.id, d.id HAVING 100 * count(*) >= 75 * any_value(n_item)
UNION ALL
SELECT b.id, d.id, 1, 1 FROM words b JOIN words d ON contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(b.w, ' ') || ' ')
WHERE b.kind = 'b' AND d.kind = 'd' AND len(b.w) BETWEEN 1 AND 4
"""


@query
def op7_substring_dedup(spark, sf):
    return substring_dedup.repeated_bytes(table(spark, sf, "documents"))


SQL["op7_substring_dedup"] = r"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS body, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, unnest(range(n - 399)) AS i FROM t WHERE n >= 400),
prints AS (SELECT doc_id, i, md5(array_slice(body, i + 1, i + 400)) AS h FROM starts JOIN t USING (doc_id)),
found AS (SELECT doc_id, i FROM prints WHERE h IN (SELECT h FROM prints GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT *, CASE WHEN lag(i) OVER w + 400 >= i THEN 0 ELSE 1 END AS begins FROM found WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS z FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, a AS z FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT t.doc_id, coalesce(max(s.z), 0), any_value(t.n) FROM t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id),
left_over AS (
  SELECT g.doc_id, string_agg(CASE WHEN g.z > g.a THEN hex(array_slice(body, g.a + 1, g.z)) ELSE '' END, '' ORDER BY g.a) AS kept FROM gaps g JOIN t ON t.doc_id = g.doc_id GROUP BY g.doc_id),
removals AS (SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256,
  coalesce(n_removed, 0) > 0 AS removed
FROM t JOIN left_over l ON l.doc_id = t.doc_id LEFT JOIN removals r ON r.doc_id = t.doc_id
"""


@query
def op4_quality(spark, sf):
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def archive_records(pages):
    """Two archive records per page: a capture, and a later check that found it not modified.

    One capture in seven is an error page; one check in five names another entity tag, one
    in four of the rest only a date.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (page % 1000).cast("string"))
    capture = F.map_from_arrays(
        F.array(*map(F.lit, ("content-length", "content-type", "etag", "last-modified", "server"))),
        F.array(F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("text/html"), tag, day, F.lit("a")),
    )
    check = F.map_from_arrays(
        F.array(*map(F.lit, ("cache-control", "content-length", "etag", "last-modified"))),
        F.array(
            F.concat(F.lit("max-age="), (page % 100).cast("string")), F.lit("0"),
            F.when(page % 5 == 0, F.lit('"other"')).when(page % 4 != 0, F.concat(F.lit("W/"), tag)), day,
        ),
    )
    both = F.array(
        F.struct((2 * page).alias("record_id"), F.lit("response").alias("kind"), (3 * page).alias("at"), F.when(page % 7 == 3, 404).otherwise(200).alias("status"), capture.alias("headers"), digest.alias("payload_digest")),
        F.struct((2 * page + 1).alias("record_id"), F.lit("revisit").alias("kind"), (3 * page + 4).alias("at"), F.lit(304).alias("status"), check.alias("headers"), F.lit(None).cast("string").alias("payload_digest")),
    )
    return pages.select("url", F.explode(both).alias("r")).select("url", "r.*")


@query
def op8_revisits(spark, sf):
    found = revisits.resolve_revisits(archive_records(table(spark, sf, "pages")))
    lines = F.transform("headers", lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


SQL["op8_revisits"] = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
    regexp_extract(trim(coalesce(url, '')), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)[?]?([^#]*)', ['host', 'path', 'query']) AS u
  FROM pages),
k AS (
  SELECT *, '"' || substr(digest, 1, 16) || '"' AS tag, 'day ' || (page_id % 1000) AS day,
    regexp_replace(regexp_replace(lower(u.host), '^www[0-9]*[.]', ''), ':(80|443)$', '') || regexp_replace(u.path, '/+$', '') AS base,
    array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|sessionid)(=|$)'))), '&') AS q
  FROM p),
c AS (SELECT *, base || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS key FROM k),
full_ones AS (SELECT key, 3 * page_id AS at, 2 * page_id AS id, digest, tag, day, octet_length(encode(html)) AS size FROM c WHERE page_id % 7 <> 3),
checks AS (
  SELECT key, 3 * page_id + 4 AS at, 2 * page_id + 1 AS id, page_id, day,
    CASE WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 4 <> 0 THEN tag END AS tag FROM c),
j AS (
  SELECT r.*, f.id AS response_id, f.digest, f.tag AS f_tag, f.day AS f_day, f.size,
    row_number() OVER (PARTITION BY r.id ORDER BY f.at DESC, f.id DESC) AS i
  FROM checks r LEFT JOIN full_ones f ON f.key = r.key AND (f.at, f.id) < (r.at, r.id)),
o AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
    WHEN CASE WHEN tag IS NOT NULL THEN tag = f_tag ELSE day = f_day END THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM j WHERE i = 1)
SELECT id AS record_id, key AS canonical_url, response_id, outcome,
  CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || (page_id % 100), 'content-length: ' || size, 'content-type: text/html',
    'etag: ' || CASE WHEN tag IS NULL THEN f_tag ELSE 'W/' || tag END, 'last-modified: ' || day, 'server: a') END AS headers
FROM o
"""


@query
def op11_hard_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings")
    given = F.col("label").cast("long")
    flipped = F.when(F.col("vec_id") % 7 == 0, (given + 1) % 10).otherwise(given)
    return hard_negatives.hard_negatives(vectors.withColumn("label", flipped), F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""


@query
def op12_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_simhash(spark, sf):
    return simhash.simhash_duplicates(table(spark, sf, "documents"))
