import hashlib
import html
import random
import re
import zlib
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from check_oracle import compare, connect
from test_text_operators import plain_distance, prose, repeats

import __spark_entry__ as entry
import corpus_pipeline
from claimloom.llm import bpe
from claimloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def own_tokenizer():
    ranks = bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    ok, note = compare(spark, connect(SF), SF, name, QUERIES[name], ORACLE[name])
    assert ok, note


def test_repeated_strings_of_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    for r, (n, removed, spans, kept) in zip(docs, repeats([d.text for d in docs], 200)):
        assert got[r.doc_id] == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_tokens_of_the_documents_table(spark):
    own = own_tokenizer()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_byte_bpe"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids, data = own.encode_ordinary(r.text or ""), (r.text or "").encode()
        digests = (hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), data))
        assert got[r.doc_id] == (len(ids), *digests)


def test_main_texts_of_the_pages_table(spark):
    """Pages of the table hold one article each, whose blocks can be cut out by pattern."""
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op2_html_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article[^>]*>(.*?)(</article>|<aside|<div class=.comment|<footer|\Z)", r.html or "", re.S)
        blocks = re.split(r"</?(?:h\d|p|div|ul|li|blockquote|section)\b[^>]*>", article[1]) if article else []
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks]
        want = "\n".join(b for b in plain if b)
        assert got[r.page_id] == (want, len(want)), r.page_id


def test_quality_of_the_documents_table(spark):
    rows = QUERIES["op3_quality"](spark, SF).collect()
    docs = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = ([r.score for r in rows if r.held_out and label.get(r.doc_id) == q] for q in (1, 0))
    assert good and bad and sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_shards_of_the_documents_table(spark):
    rows = QUERIES["op9_resharding"](spark, SF).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()} and len(rows) == len(texts)
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    # No assignment to the same capacities leaves more bytes where they were.
    old = [sum(r.size for r in rows if r.old_shard == s) for s in range(6)]
    moved = sum(r.size for r in rows if r.shard != r.old_shard)
    least = sum(max(0, o - n) for o, n in zip(old, sizes))
    assert least <= moved <= least + 16 * max(r.size for r in rows)


def test_classes_of_the_documents_table(spark):
    docs = [(r.doc_id, (r.text or "").lower().split()) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op10_order_minhash"](spark, SF).collect()}
    assert len(got) == len(docs)
    pairs = 0
    for a, x in docs:
        assert got[a].n_copies == sum(x == y for _, y in docs)
        for b, y in docs:
            longer = max(len(x), len(y))
            if a < b and abs(len(x) - len(y)) <= 0.2 * longer and (Counter(x) & Counter(y)).total() >= 0.8 * longer - 1e-9:
                if plain_distance(x, y) <= 0.2 * longer + 1e-9:
                    pairs += 1
                    assert got[a].class_id == got[b].class_id
    classes = {r.class_id for r in got.values()}
    assert pairs >= len(docs) - len(classes) > 0 and all(got[c].class_id == c for c in classes)


def test_every_stage_against_brute_force(spark, tmp_path):
    rng = random.Random(21)
    passage = prose(rng, 60)
    rows = []
    for i in range(90):
        text = prose(rng, rng.randint(40, 120)) + "."
        if i % 6 == 0:
            text = " | ".join(prose(rng, 1) for _ in range(50))
        elif i % 9 == 1:
            words = text.split()
            text = " ".join(words[:20] + passage.split() + words[20:])
        rows.append([i, text, "en", rng.choice(["a", "a", "a", "b", None]), len(text)])
    rows += [[100 + i, rows[i][1].replace(" ", "  ", 3) + " more", "en", "c", 0] for i in (1, 2, 3)] + [[200, None, "en", "a", 0], [201, "", "fr", "b", 0]]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 6 != 0), 0) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [docs.collect()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{n}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{n}"))
        seen.append(docs.collect())
    raw, good, single, clean, mixed, coded = seen
    assert all(set(s[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for s in seen[:5])
    assert {r.doc_id for r in good if r.doc_id < 90} == {i for i in range(90) if i % 6}
    # One document of each group: those closer than the threshold, joined transitively.
    parent = {r.doc_id: r.doc_id for r in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    words = {r.doc_id: (r.text or "").split() for r in good}
    for a in words:
        for b in words:
            longer = max(len(words[a]), len(words[b]))
            if a < b and abs(len(words[a]) - len(words[b])) <= 0.2 * longer and plain_distance(words[a], words[b]) <= 0.2 * longer:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert sorted(r.doc_id for r in single) == sorted({root(x) for x in words})
    kept = {r.doc_id: k.decode("utf-8", "ignore") for r, (_, _, _, k) in zip(single, repeats([r.text for r in single], 200))}
    assert {r.doc_id: r.text or "" for r in clean} == kept and sum(len(r.text or "") for r in clean) < sum(len(r.text or "") for r in single)
    sizes, taken = {}, {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    from test_mixing_sharding_pages import plain_targets

    want = plain_targets(sizes)
    assert all(abs(taken.get(s, 0) - want[s]) <= 0.5 + 1e-6 for s in sizes)
    own = own_tokenizer()
    assert all(r.lossless for r in coded)
    assert sorted((r.doc_id, r.ids) for r in coded) == sorted((r.doc_id, own.encode_ordinary(r.text)) for r in mixed)
