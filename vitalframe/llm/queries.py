"""Registered queries of the subpackage, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm.chat import link_calls
from vitalframe.llm.decontaminate import find_leaks
from vitalframe.llm.importance import resample
from vitalframe.llm.jaccard import near_copies
from vitalframe.llm.langid import identify, learn_filter
from vitalframe.llm.mixing import mix
from vitalframe.llm.ppm import score_texts
from vitalframe.llm.rpforest import near_vectors
from vitalframe.llm.sharding import reshard
from vitalframe.llm.substrings import remove_repeats
from vitalframe.llm.toxicity import score_toxicity
from vitalframe.llm.trie import conversation_trie
from vitalframe.llm.warc import read_records, write_archives
from vitalframe.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LEAKS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
t AS (
  SELECT DISTINCT id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS said
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
p AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM d, (SELECT DISTINCT n FROM t) AS s, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
h AS (SELECT doc_id, id, i, t.n FROM p JOIN t ON p.said = t.said AND p.n = t.n),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, unnest(range(i, i + n)) AS u(j) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM h) GROUP BY 1)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query(LEAKS_SQL)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS said FROM d, unnest(range(1, len(w) - 11)) AS u(i)),
m AS (SELECT said, min(doc_id) AS first_id FROM p GROUP BY 1),
g AS (SELECT DISTINCT p.doc_id, j FROM p JOIN m USING (said), unnest(range(i, i + 13)) AS u(j) WHERE p.doc_id > first_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM x ANTI JOIN g USING (doc_id, j) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query(REPEATS_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS key FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY 1),
r AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS stop,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0)) / sum(weight) OVER f AS level
  FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    f AS (ORDER BY 2.0::DOUBLE * source_size / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT source, source_size,
    CASE WHEN level > stop THEN cap ELSE least(cap, weight * (SELECT level FROM r WHERE level <= stop ORDER BY stop, i LIMIT 1)) END AS target FROM r),
p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, round(target)::BIGINT - start)) + greatest(0, least(size, round(target)::BIGINT - source_size - start)))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""


@query(MIX_SQL)
def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    first = F.get("passes", F.lit(0))["position"]
    return mixed.orderBy(first.asc_nulls_last(), "doc_id").select("doc_id", "size", "source_size", "target", "taken")


#: Shards that the documents lie in before: by a hash of the text.
OLD_SHARDS = 6


@query()
def op9_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash")
    )
    old = F.pmod("text_hash", F.lit(OLD_SHARDS))
    out = reshard(docs, size=F.col("size"), group=F.col("text_hash"), old=old)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS x
  FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s AS a JOIN s AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n AS na ON a = na.doc_id JOIN n AS nb ON b = nb.doc_id WHERE 100 * common >= 90 * (na.n + nb.n - common)),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.m = e.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(m) FROM r WHERE r.doc_id = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""


@query(JACCARD_SQL)
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(_table(spark, sf_dir, "documents"), k=3, percent=90)


def id_remainder(n: int):
    """crc32 of the document id as text, modulo n."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


@query()
def op7_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"), held_out=id_remainder(5) == 1)


@query()
def op2_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    bloom = learn_filter(docs, learn=id_remainder(3) != 1)
    named = identify(docs.select("doc_id", "text"), bloom)
    return named.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query()
def op4_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, _table(spark, sf_dir, "labels"), fit=id_remainder(5).isin(1, 2, 3), calibrate=id_remainder(5) == 4)
    return scored.select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


NEAR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id, vec_id AS m FROM embeddings UNION SELECT r.vec_id, p.b FROM r JOIN p ON r.m = p.a),
c AS (SELECT vec_id, min(m) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


@query(NEAR_SQL)
def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), least=0.9)


#: The tool that conversations are read as calls of: every question asks it, every answer is its result.
ASK = {"ask": {"question": ("string", True, 1), "turn": ("integer", True, 0), "words": ("integer", True, 2)}}

CHAT_SQL = r"""
WITH RECURSIVE q AS (
  SELECT conv_id || '-' || turn AS call_id, conv_id || '-' || (turn - 2) AS parent, text,  turn,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id || '-' || (turn - 1) AS call_id, min(text) AS result FROM conversations WHERE role = 'assistant' GROUP BY 1),
o AS (SELECT call_id, 0::BIGINT AS position FROM q WHERE parent NOT IN (SELECT call_id FROM q)
  UNION ALL SELECT q.call_id, position + 1 FROM q JOIN o ON q.parent = o.call_id),
e AS (
  SELECT *, array_to_string(list_filter([CASE WHEN text IS NULL THEN 'question: missing' WHEN length(text) < 1 THEN 'question: below 1' END,
    CASE WHEN words IS NULL THEN 'words: missing' WHEN words < 2 THEN 'words: below 2' END], lambda x: x IS NOT NULL), '; ') AS errors FROM q)
SELECT coalesce(e.call_id, a.call_id) AS call_id, position,
  CASE WHEN e.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'unanswered' WHEN errors <> '' THEN 'invalid' ELSE 'ok' END AS status,
  coalesce(errors, '') AS errors,
  '{"arguments":' || CASE WHEN e.call_id IS NULL THEN 'null' ELSE '{"question":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '}' END
    || ',"id":"' || coalesce(e.call_id, a.call_id) || '","name":' || CASE WHEN e.call_id IS NULL THEN 'null' ELSE '"ask"' END
    || ',"result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}' AS json
FROM e FULL JOIN a ON e.call_id = a.call_id LEFT JOIN o ON o.call_id = e.call_id
"""


@query(CHAT_SQL)
def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    at = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    calls = turns.where("role = 'user'").select(
        at(0).alias("call_id"),
        at(2).alias("parent"),
        F.lit("ask").alias("name"),
        F.to_json(F.struct(words.alias("words"), "turn", F.col("text").alias("question"))).alias("arguments"),
    )
    results = turns.where("role = 'assistant'").select(at(1).alias("call_id"), F.col("text").alias("content"))
    return link_calls(calls, results, ASK)


#: The table of CRC-32.
CRC_SQL = """b8(i, k, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) AS r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM b8 WHERE k < 8),
tab AS (SELECT i::UBIGINT AS i, c AS v FROM b8 WHERE k = 8),"""

RESAMPLE_SQL = r"""
WITH RECURSIVE """ + CRC_SQL + r"""
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (
  SELECT side, id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM texts),
f AS MATERIALIZED (
  SELECT side, id, array_to_string(w[i:i + n - 1], ' ') AS said, count(*) AS n
  FROM w, (SELECT unnest([1, 2, 3]) AS n) AS s, unnest(range(1, len(w) - n + 2)) AS u(i) GROUP BY ALL),
x AS MATERIALIZED (SELECT said, hex(encode(said)) AS h FROM (SELECT DISTINCT said FROM f)),
step(said, h, j, c) AS (
  SELECT said, h, 0, 4294967295::UBIGINT FROM x
  UNION ALL SELECT said, h, j + 1, xor(c >> 8, v)
  FROM step JOIN tab ON tab.i = xor(c & 255, ('0x' || h[2 * j + 1:2 * j + 2])::UBIGINT) WHERE 2 * j < length(h)),
crc AS (SELECT said, (xor(c, 4294967295::UBIGINT) % 10000)::BIGINT AS bucket FROM step WHERE 2 * j = length(h)),
k AS MATERIALIZED (SELECT side, id, bucket, sum(n)::BIGINT AS n FROM f JOIN crc USING (said) GROUP BY ALL),
every AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM k GROUP BY 1),
total AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM every),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1) * (ss + 10000)) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM every, total),
docs AS (SELECT id, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS weight FROM k JOIN gain USING (bucket) WHERE side = 'd' GROUP BY 1),
scored AS (
  SELECT w.id AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || w.id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN docs USING (id) WHERE side = 'd'),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * total // 100 THEN rank END AS rank FROM scored LEFT JOIN ranks USING (doc_id)
"""


@query(RESAMPLE_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


TRIE_SQL = r"""
WITH RECURSIVE """ + CRC_SQL + r"""
t AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS pos,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) AS said, octet_length(encode(coalesce(text, ''))) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
step(c, s, j, r) AS (
  SELECT DISTINCT c, c::VARCHAR, 1, 4294967295::UBIGINT FROM t
  UNION ALL SELECT step.c, s, j + 1, xor(r >> 8, v) FROM step JOIN tab ON tab.i = xor(r & 255, ascii(s[j])::UBIGINT) WHERE j <= length(s)),
own AS (SELECT c, count(*) AS own FROM t GROUP BY 1),
h AS MATERIALIZED (
  SELECT step.c, (xor(r, 4294967295::UBIGINT) % 9)::BIGINT AS h, o.own, least((xor(r, 4294967295::UBIGINT) % 9)::BIGINT, coalesce(p.own, 0)) AS taken
  FROM step JOIN own AS o USING (c) LEFT JOIN own AS p ON p.c = step.c - step.c % 5 WHERE j > length(s)),
m AS (
  SELECT h.c, pos AS depth, said, bytes FROM h JOIN t ON t.c = h.c - h.c % 5 AND pos <= h
  UNION ALL SELECT h.c, taken + pos - h, said, bytes FROM h JOIN t ON t.c = h.c AND pos > h),
n AS (SELECT c, taken + greatest(own - h, 0) AS size FROM h),
p AS MATERIALIZED (
  SELECT c, depth, bytes, string_agg(said, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth) AS path FROM m
  UNION ALL SELECT c, 0, 0, '' FROM h),
k AS MATERIALIZED (SELECT path, min(c) AS conv_id, any_value(depth) AS depth, any_value(bytes) AS bytes, count(*) AS n_convs FROM p GROUP BY 1),
ch AS (SELECT path[:-65] AS path, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY 1),
v AS MATERIALIZED (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN ch USING (path)),
a AS (
  SELECT v.path[:64 * d] AS path, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM v, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1),
e AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM p JOIN n USING (c) WHERE depth = size GROUP BY 1)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM v JOIN a USING (path) LEFT JOIN e USING (path) LEFT JOIN v AS q ON v.depth > 0 AND q.path = v.path[:-65]
"""


@query(TRIE_SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS i, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN i > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN i > 1 AND payload_bytes >= 100 THEN first_id END AS refers_to
FROM f
"""


@query(WARC_SQL)
def op13_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    index = write_archives(_table(spark, sf_dir, "pages"), folder, date="2024-01-01T00:00:00Z")
    back = read_records(index, folder, payloads=False)
    number = lambda c: F.expr(f"try_cast({c} AS long)")
    return back.select(
        number("key").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
