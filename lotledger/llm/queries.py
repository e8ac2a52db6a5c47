"""The registered queries of this package: operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.llm import bpe, chat, decontaminate, fingerprint, jaccard_join, ranked_search, recompression, secret_scan, sharding, suffix_dedup, toxicity, vector_code, warc
from lotledger.llm.arrays import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def codec() -> bpe.Codec:
    import public_tokenizers

    return bpe.read_codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), 16)


@query(
    "op2_perspectives",
    """
    WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k FROM t),
    p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
    v AS (SELECT n.conv_id, speaker, CAST(k // 64 AS INTEGER) AS part, k, role = speaker AS own,
                 '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
                   ELSE 'user name=' || regexp_replace(role, '[^0-9A-Za-z_-]', '_', 'g') END || chr(10) AS head,
                 replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
          FROM n JOIN p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
    o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY k) - length(body) AS off FROM v)
    SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS rendered,
           coalesce(string_agg(CAST(CAST(off AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(off + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY k) FILTER (WHERE own), '') AS mask
    FROM o GROUP BY conv_id, speaker, part
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(read(spark, sf_dir, "conversations"))


@query(
    "op3_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM g
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op4_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
    b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
    p AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
          FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT m FROM p),
    c AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
          FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
    o AS (SELECT doc_id, i, c.m, item_id FROM c JOIN p ON c.m = p.m AND c.s = p.s),
    h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM o) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digested(read(spark, sf_dir, "documents"), codec(), ["doc_id"])


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secret_scan.reported(secret_scan.find(docs, secret_scan.fit(docs), ["doc_id"]), ["doc_id"])


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query(
    "op6_jaccard_components",
    """
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
          FROM (SELECT *, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
    m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
    FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read(spark, sf_dir, "documents"), 3, 90)


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(read(spark, sf_dir, "documents"))


def _sql_op11(rounds: int = 6) -> str:
    """Component rows; a round is three tables: entries, distances, and the nearest entry per part."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    d{r} AS MATERIALIZED (SELECT vec_id, q.part, entry, sum((z - c) * (z - c)) AS d FROM q JOIN b{r} AS b ON b.part = q.part AND b.pos = q.pos GROUP BY ALL),
    a{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            steps.append(f"""
    m{r} AS MATERIALIZED (SELECT q.part, entry, pos, CAST(sum(z) AS BIGINT) AS s, count(*) AS n FROM q JOIN a{r} AS a ON a.vec_id = q.vec_id AND a.part = q.part GROUP BY ALL),
    b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
          FROM b{r} AS b LEFT JOIN m{r} AS m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    return f"""
    WITH v AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings WHERE embedding IS NOT NULL),
    k AS MATERIALIZED (SELECT vec_id, label FROM v GROUP BY ALL HAVING bool_and(coalesce(isfinite(x), false))),
    q AS MATERIALIZED (SELECT vec_id, CAST(i // 8 AS INTEGER) AS part, CAST(i % 8 AS INTEGER) AS pos, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS z FROM v JOIN k USING (vec_id)),
    b0 AS MATERIALIZED (SELECT part, entry, pos, z AS c FROM q JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k) USING (vec_id) WHERE entry < 16),{",".join(steps)},
    e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
    FROM e JOIN k USING (vec_id)
    """


@query("op11_vector_codes", _sql_op11())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_code.encode(read(spark, sf_dir, "embeddings"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_ranked_search",
    f"""
    WITH t AS (SELECT doc_id, unnest({_TERMS.format("text")}) AS t FROM documents),
    f AS MATERIALIZED (SELECT doc_id, t, count(*) AS tf FROM t GROUP BY ALL),
    n AS MATERIALIZED (SELECT doc_id, sum(tf) AS n FROM f GROUP BY doc_id),
    c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
    q AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS t FROM benchmark),
    w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
          FROM f, c WHERE t IN (SELECT t FROM q) GROUP BY t),
    s AS (SELECT item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * CAST(n AS BIGINT) * n_docs) // n_terms))))) AS BIGINT) AS score
          FROM q JOIN w USING (t) JOIN f USING (t) JOIN n ON n.doc_id = f.doc_id, c GROUP BY ALL),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query(
    "op13_recompression",
    r"""
    WITH w AS MATERIALIZED (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    c AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
    m AS (SELECT s, min(doc_id) AS least FROM c GROUP BY s HAVING count(*) > 1),
    h AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM c JOIN m USING (s) WHERE doc_id > least),
    u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM w),
    r AS (SELECT u.doc_id, count(h.k) AS n_removed, string_agg(x, ' ' ORDER BY u.k) FILTER (WHERE h.k IS NULL) AS kept
          FROM u LEFT JOIN h ON h.doc_id = u.doc_id AND h.k = u.k GROUP BY u.doc_id)
    SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN r ON r.doc_id = w.doc_id
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.dedup(read(spark, sf_dir, "documents"))
