"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    ann, bpe, exact_topk, filter_audit, html_text, language_id, mixing, near_dup, quality, resharding, spelling, suffix_dedup, url_filter,
)
from claimloom.llm.common import fresh_workspace, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


ORACLE["op7_url_filter"] = r"""
WITH u AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u
), rules(verdict, r_host, r_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
    SELECT page_id, host, path, r_host || r_path AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) DESC NULLS LAST, length(r_path) DESC) AS place
    FROM h LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""


@query
def op8_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), fresh_workspace(spark, "op8"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op8_mixing"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT source, source_size, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS w,
        (3 * source_size)::DOUBLE AS cap
    FROM s
), levels(n, level) AS (
    SELECT 0, 0.0::DOUBLE
    UNION ALL
    SELECT n + 1, l2 FROM (
        SELECT n, level, (
            SELECT (sum(source_size) - coalesce(sum(cap) FILTER (WHERE cap <= level * w), 0))
                / nullif(sum(w.w) FILTER (WHERE cap > level * w.w), 0)
            FROM w) AS l2
        FROM levels)
    WHERE l2 > level
), t AS (
    SELECT source, source_size, least(cap, (SELECT max(level) FROM levels) * w) AS target FROM w
), b AS (
    SELECT *, least(floor(target + 0.5)::BIGINT, 3 * source_size) AS budget,
        CASE WHEN source_size > 0 THEN least(floor(target + 0.5)::BIGINT, 3 * source_size) // source_size ELSE 0 END AS whole
    FROM t
), p AS (
    SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d
)
SELECT doc_id, size, source_size, target,
    (whole * size + least(greatest(budget - whole * source_size - before, 0), size))::BIGINT AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""

OLD_SHARDS, SHARDS = 6, 8


@query
def op9_resharding(spark, sf_dir):
    plan = resharding.reshard(table(spark, sf_dir, "documents"), fresh_workspace(spark, "op9"), SHARDS, OLD_SHARDS)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


def _vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query
def op6_byte_bpe(spark, sf_dir):
    ranks, pattern = _vocabulary()
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern, keep=["doc_id"], decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_quality(spark, sf_dir):
    scored, _ = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op5_suffix_dedup(spark, sf_dir):
    done = suffix_dedup.dedup(table(spark, sf_dir, "documents"), fresh_workspace(spark, "op5"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_order_minhash(spark, sf_dir):
    classes, _ = near_dup.near_duplicates(table(spark, sf_dir, "documents"), fresh_workspace(spark, "op10"))
    return classes


@query
def op1_collision_ann(spark, sf_dir):
    return ann.neighbours(table(spark, sf_dir, "embeddings"), fresh_workspace(spark, "op1"))


@query
def op4_exact_topk(spark, sf_dir):
    return exact_topk.top_products(table(spark, sf_dir, "embeddings"), fresh_workspace(spark, "op4"))


ORACLE["op4_exact_topk"] = r"""
WITH e AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query
def op2_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    texts = html_text.extract(pages, html_text.train(pages), ["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


FILTERS = "ABCDE"


@query
def op11_filter_audit(spark, sf_dir):
    rows = filter_audit.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fresh_workspace(spark, "op11"))
    return filter_audit.audit(rows, "part", list(FILTERS), ["good", "toxic"])


ORACLE["op11_filter_audit"] = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), l AS (
    SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), j AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
    FROM d LEFT JOIN l USING (doc_id)
), c AS (
    SELECT part, fails, good, toxic, count(*) AS n FROM j GROUP BY ALL
), f(x) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), o AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM f p, f q, f r, f s, f t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS filter, left(filter_order, step - 1) AS earlier
    FROM o, range(1, 6) r(step)
), outcomes AS (
    SELECT part, filter_order, step, filter, n, good, toxic, fails,
        contains(fails, filter) AS failing, translate(fails, earlier, '') <> fails AS gone
    FROM c, steps
), counts AS (
    SELECT part, filter_order, step, filter,
        coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE failing AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE fails = filter), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (WHERE failing AND NOT gone AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (WHERE failing AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
    FROM outcomes GROUP BY ALL
)
SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM counts
"""


@query
def op12_spelling_variants(spark, sf_dir):
    ws = fresh_workspace(spark, "op12")
    return spelling.variants(spelling.words_of(table(spark, sf_dir, "documents")), ws)


ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE crc(i, n, v) AS (
    SELECT i, 0, i::BIGINT FROM range(256) r(i)
    UNION ALL
    SELECT i, n + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE n < 8
), crc_table AS (
    SELECT list(v ORDER BY i) AS steps FROM crc WHERE n = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS marked, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(marked)), '..'), lambda b: ('0x' || b)::BIGINT)),
        lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) AS h
    FROM counted, crc_table
), spelled AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM spelled GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6
), cuts AS (
    SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words
), skipped AS (
    SELECT word, n, left(word, i) || '?' || substr(word, i + 2) AS k, left(word, i) || substr(word, i + 2) AS shorter FROM cuts WHERE i < length(word)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM skipped a JOIN skipped b ON a.k = b.k AND a.word <> b.word
    UNION
    SELECT s.word, w.word, w.n FROM skipped s JOIN words w ON s.shorter = w.word
    UNION
    SELECT w.word, s.word, s.n FROM skipped s JOIN words w ON s.shorter = w.word
), best AS (
    SELECT word, count(*)::BIGINT AS n_near, max(n) AS near_n FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN near_n >= 5 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.n = near_n) END AS form,
        CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), chains(word, root, depth) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL
    SELECT c.word, f.form, depth + 1 FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
), ends AS (
    SELECT word, arg_max(root, depth) AS root FROM chains GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


@query
def op13_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.where(~out))
    found = language_id.identify(docs, model, ["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
