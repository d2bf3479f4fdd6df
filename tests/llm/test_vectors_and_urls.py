import math
import random

import duckdb
import numpy as np
from check_oracle import compare
from pyspark.sql import functions as F

from claimloom.llm import ann, exact_topk, url_filter
from claimloom.llm.queries import ORACLE, QUERIES, URL_RULES

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, v string"


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(size=dim)], None, "clash", "clash") for i in range(n)]


def awkward():
    return [
        (7, None, 1, "x", ""),
        (8, [float("nan"), 1.0], 1, "x", ""),
        (9, [float("inf"), 1.0], 1, "x", ""),
        (10, [None, 1.0], 1, "x", ""),
        (None, [1.0, 1.0], 1, "x", ""),
        (11, [], 1, "x", ""),
        (12, [0.0, 0.0], 1, "x", ""),
        (100, [1.0, 0.0], 1, "x", ""),
        (100, [1.0, 0.0], 1, "x", ""),
        (3, [1.0, 0.0], 1, "x", ""),
        (2, [1.0, 0.0], 1, "x", ""),
        (4, [-1.0, 0.5], 1, "x", ""),
        (5, [1.0, 2.0, 3.0], 1, "x", ""),
    ]


def test_nearest_neighbours_reach_brute_force_over_several_shards_and_blocks(spark, ws):
    data = vectors(600, 12)
    df = spark.createDataFrame(data, SCHEMA)
    got = {}
    for r in ann.neighbours(df, ws, every=20, shard_rows=150, query_rows=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([d[1] for d in data])
    hits = 0
    for q in range(0, 600, 20):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        distance[q] = math.inf
        best = set(np.lexsort((np.arange(600), distance))[:10].tolist())
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(abs(f[2] - distance[f[1]]) < 1e-12 for f in found)
        hits += len(best & {f[1] for f in found})
    assert hits >= 0.95 * 300


def test_neighbours_of_awkward_vectors(spark, ws):
    found = ann.neighbours(spark.createDataFrame(awkward(), SCHEMA), ws).collect()
    # Both rows of id 100 ask, and each finds the other.
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(found)] == [(100, n, i) for n, i in enumerate((2, 3, 100, 4), 1) for _ in "ab"]
    assert ann.neighbours(spark.createDataFrame([], SCHEMA), ws).collect() == []


def test_ties_of_many_equal_vectors_go_to_the_smaller_ids(spark, ws):
    data = [(i, [1.0, 2.0], None, "", "") for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    for found in (ann.neighbours(df, ws, shard_rows=64), exact_topk.top_products(df, ws, shard_rows=64)):
        rows = sorted((r.query_id, r.rank, r.vec_id) for r in found.collect())
        assert rows[:10] == [(0, i + 1, i + 1) for i in range(10)]


def test_top_products_equal_brute_force(spark, ws):
    data = vectors(500, 20, 3)
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_products(df, ws, every=50, shard_rows=130, query_rows=4).collect())
    x = [[math.floor(1024 * c) for c in d[1]] for d in data]
    want = []
    for q in range(0, 500, 50):
        scored = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in range(500) if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == want


def test_top_products_of_awkward_and_huge_vectors(spark, ws):
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_products(spark.createDataFrame(awkward(), SCHEMA), ws).collect())
    want = [(100, 1, 2, 1 << 20), (100, 2, 3, 1 << 20), (100, 3, 100, 1 << 20), (100, 4, 12, 0), (100, 5, 4, -(1 << 20))]
    assert found == [w for w in want for _ in "ab"]
    huge = [(0, [3e38, 1.0], 0, "", ""), (1, [3e38, -1.0], 0, "", ""), (2, [-1.0, 5.0], 0, "", "")]
    scores = [(r.vec_id, r.score) for r in exact_topk.top_products(spark.createDataFrame(huge, SCHEMA), ws).orderBy("rank").collect()]
    assert scores == [(1, (1 << 63) - 1), (2, -(1 << 63))]
    assert exact_topk.top_products(spark.createDataFrame([], SCHEMA), ws).collect() == []


def test_url_parts_and_verdicts(spark):
    urls = [
        ("http://Sub.EXAMPLE.com/en/x?y#z", "sub.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://www.example.com/en", "www.example.com", "/en", "com/", "allow"),
        ("https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        ("https://a.net/de/1", "a.net", "/de/1", None, "allow"),
        ("https://dotcom/en/", "dotcom", "/en/", None, "allow"),
        ("x://a.com", "a.com", "", None, "allow"),
        ("x://a.com?/b", "a.com", "", None, "allow"),
        ("no scheme.com/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a\n://É.com/\n/x://y", "É.com", "/\n/x://y", "com/", "allow"),
        ("http://a.com/" + "p/" * 50_000, "a.com", "/" + "p/" * 50_000, "com/", "allow"),
    ]
    df = spark.createDataFrame([(i, u[0], "clash", "clash") for i, u in enumerate(urls)], "page_id int, url string, host string, rule string")
    got = url_filter.judge(df, URL_RULES, keep=["page_id"]).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [u[1:] for u in urls]
    assert url_filter.judge(df.limit(0), URL_RULES, keep=["page_id"]).collect() == []


def test_longest_match_equals_trying_every_rule():
    rng = random.Random(2)
    labels, segments = ["a", "b", "com", "net"], ["x", "xy", "", "y"]
    rules = list({
        (h, p): url_filter.Rule(rng.choice(["allow", "block"]), h, p)
        for h, p in ((".".join(rng.choices(labels, k=rng.randint(1, 3))), "/" + "/".join(rng.choices(segments, k=rng.randint(0, 3)))) for _ in range(60))
    }.values())
    trie = url_filter.build_trie(rules)
    for _ in range(500):
        host, path = ".".join(rng.choices(labels, k=rng.randint(1, 4))), "/" + "/".join(rng.choices(segments, k=rng.randint(0, 4)))
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (r.host.count("."), len(r.path)), default=None)
        assert url_filter.longest_match(trie, host, path) == (best and (best.text, best.verdict))


def test_registered_searches_of_tiny_repeated_and_equal_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(100 * i, [1.0, 1.0, 0.5]) for i in range(3)] + [(1, [-1e-20, 1.0, 0.0]), (2, [0.5, -1e-30, 0.0]), (3, [-0.0, 0.0, 1.0])]
    rows += [(1, [-1e-20, 1.0, 0.0]), (100, [0.0, -5e-20, 2.0]), (4, [1.0, None, 1.0]), (None, [1.0, 1.0, 1.0]), (5, None), (6, [])]
    rows += [(10 + i, rng.normal(size=3).tolist()) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    ok, note = compare(spark, con, str(tmp_path), "op4_exact_topk", QUERIES["op4_exact_topk"], ORACLE["op4_exact_topk"])
    assert ok, note
    fit = [(i, v) for i, v in rows if i is not None and v and None not in v]
    products, distances = [], []
    for q, (i, x) in enumerate(fit):
        if i % 100:
            continue
        others = [(j, y) for n, (j, y) in enumerate(fit) if n != q]
        scored = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(x, y)), j) for j, y in others)[:10]
        products += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
        near = sorted((math.dist(x, y), j) for j, y in others)[:10]
        distances += [(i, n, j, d) for n, (d, j) in enumerate(near, 1)]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op4_exact_topk"](spark, str(tmp_path)).collect())
    assert got == sorted(products)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op1_collision_ann"](spark, str(tmp_path)).collect())
    same = sum(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, sorted(distances)))
    assert len(got) == len(distances) and same >= 0.9 * len(distances)


def test_floor_of_small_negative_and_huge_components(spark):
    values = [-1e-20, -5e-324, -0.0, 0.0, 1e-30, -1 / 1024, 0.5 / 1024, -0.5 / 1024, 2.0**43, -(2.0**43) - 0.5, 1e300, -1e300]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(exact_topk.floored(F.col("x"))).collect()]
    assert got == [float(math.floor(1024 * v)) for v in values]


def test_registered_neighbours_reach_brute_force(spark):
    x = {r.vec_id: r.embedding for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()}
    ids = np.array(sorted(x))
    m = np.array([x[i] for i in ids.tolist()], np.float64)
    got = {}
    for r in QUERIES["op1_collision_ann"](spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for q in ids[ids % 100 == 0].tolist():
        distance = np.sqrt(((m - np.array(x[q])) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((ids, distance)) if ids[i] != q][:10]
        hits += sum(int(ids[i]) in got[q] and abs(got[q][int(ids[i])] - distance[i]) < 1e-12 for i in best)
        total += len(best)
    assert total and hits >= 0.9 * total
