import hashlib
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from claimloom.llm import bpe, near_dup, quality, suffix_dedup
from claimloom.llm.suffix_dedup import Surroundings
from claimloom.operators.joins import HotKeys

DOC = "doc_id long, text string, lang string, source string, n_chars int, size int, shard int"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or ""), 1, 1) for i, t in enumerate(texts)], DOC)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


# Repeated strings


def repeats(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        spans = sum(c and (not i or not covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(b), sum(covered), spans, bytes(x for x, c in zip(b, covered) if not c)))
    return out


@pytest.mark.parametrize("max_group", [10_000, 3])
def test_repeated_strings_equal_brute_force(spark, ws, max_group):
    rng = random.Random(4)
    shared = [prose(rng, 15) for _ in range(4)]
    texts = [prose(rng, 10) + rng.choice(["", rng.choice(shared)]) + prose(rng, 12) + rng.choice(shared)[rng.randint(0, 40) :] for _ in range(60)]
    base = prose(rng, 60)
    texts += [base, base, base[:150] + "X" + base[151:], base[7:], "a" * 300, "ab" * 90, None, "", None, "é" * 80, shared[0]]
    df = docs_of(spark, texts)
    rows, found = suffix_dedup.repeated_strings(df, ws, 50, 12, max_group)
    got = {r.doc_id: (r.n, r.n_removed, len(r.spans), bytes(r.kept)) for r in rows.join(found, "sha").collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, 50)


def test_repeated_rows_ids_and_empty_tables(spark, ws):
    long = "x" + "0123456789" * 30
    df = spark.createDataFrame([(1, long), (1, long), (None, "short"), (None, None), (2, "y" * 199)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(df, ws).collect())
    assert got == [(-1, 0, 0), (-1, 5, 0), (1, 301, 301), (1, 301, 301), (2, 199, 0)]
    assert suffix_dedup.dedup(df.limit(0), ws).collect() == []


def test_texts_under_one_id_or_none_stay_apart(spark, ws):
    # Two texts of equal crc32.
    same_crc = ["plumless" * 30, "buckeroo" * 30]
    long = "x" + "0123456789" * 30
    texts = [(None, same_crc[0]), (None, same_crc[1]), (None, long), (None, long + "y"), (7, long + "z"), (7, "other"), (7, "other")]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, mark int")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(df, ws).collect())
    want = sorted((i or -1, n, gone) for (i, _), (n, gone, _, _) in zip(texts, repeats([t for _, t in texts], 200)))
    assert got == want
    ws.close()
    assert not [t for t in spark.catalog.listTables() if not t.isTemporary]


def test_workers_hold_little_while_they_look_for_anchors_and_less_after(spark):
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 2_000).astype(np.uint8).tobytes() for _ in range(2_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    suffix_dedup.rolling.cache_clear()
    tracemalloc.start()
    for part in suffix_dedup._slices(batch, 0):
        suffix_dedup.find_anchors(*suffix_dedup._joined(part.column(0)), 200, 40)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
    hashes = suffix_dedup.Rolling(1)
    long, short = rng.integers(0, 256, 6_000_000), rng.integers(0, 256, 1_000)
    before = hashes.prefix(short)
    hashes.prefix(long)
    assert (hashes.prefix(short) == before).all()
    assert hashes._powers.nbytes + hashes._inverse.nbytes < 16 << 20


def test_open_runs_leave_no_entry_in_the_catalog(spark, tmp_path):
    from claimloom.workspace import Workspace

    run = Workspace(spark, str(tmp_path))
    table = run.keep_bucketed(spark.range(100), "ids", 4, ["id"])
    assert not [t for t in spark.catalog.listTables() if not t.isTemporary]
    joined = table.hint("merge").join(run.keep_bucketed(spark.range(50, 150), "ids", 4, ["id"]), "id")
    assert joined.count() == 50 and "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    run.close()


def test_characters_that_lose_bytes_go_whole_and_others_stay(spark, tmp_path):
    import corpus_pipeline

    passage = prose(random.Random(6), 80)[:220]
    # Each pair shares the passage and one or more bytes of the characters beside it.
    texts = ["\ufffd A" + passage + "éB \ufffd", "C" + passage + "àD", "x\u0449" + passage + "\U0001f600y", "\ufffdz\u0409" + passage + "\U0001f601\ufffd", "\ufffd", None]
    df = docs_of(spark, texts)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeated_strings(spark, df, str(tmp_path)).collect()}
    want = ["\ufffd AB \ufffd", "CD", "xy", "\ufffdz\ufffd", "\ufffd", None]
    assert got == {i: (t, len(t or "")) for i, t in enumerate(want)}


def test_rows_travel_with_their_text_once(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rng = random.Random(12)
    passage, once, twice = (prose(rng, 90)[:260] for _ in range(3))
    rows = [(1, "a " + passage + " b", "x"), (2, passage + "c", "y"), (3, once, "z"), (4, twice, "x"), (4, twice, "y"), (None, twice, "z"), (None, None, "n"), (5, "", "e")]
    rows += [(6, "y" * 150, "s"), (6, "y" * 150, "s"), (None, "w" * 300, "r"), (7, once + "!", "row")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    monkeypatch.setattr("claimloom.operators.joins.SMALL_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.cut_repeated_strings(spark, df, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(i, None if t is None else kept.decode(), r) for (i, t, r), (*_, kept) in zip(rows, repeats([t for _, t, _ in rows], 200))]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want)) and out.columns == df.columns
    # The written texts stay where they are; anchors and what was found are dealt by gram, group and the texts' key.
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) <= {"gram", "grp", "doc"}


def test_anchors_of_frequent_grams_are_the_same(spark, ws, monkeypatch):
    rng = random.Random(13)
    shared = [prose(rng, 30) for _ in range(3)]
    texts = [prose(rng, 10) + rng.choice(shared) + prose(rng, 10) for _ in range(30)]
    _, pool = suffix_dedup._pool(docs_of(spark, texts), ws, None)
    plain = sorted(map(tuple, suffix_dedup._shared(pool, ws, 50, 12).collect()))
    some = sorted({r[0] for r in plain})[::2]
    hashes = [r[0] for r in spark.createDataFrame([(g,) for g in some], "gram long").select(F.xxhash64("gram")).collect()]
    monkeypatch.setattr(suffix_dedup, "hot_keys", lambda *a, **b: HotKeys(hashes, False))
    assert plain and sorted(map(tuple, suffix_dedup._shared(pool, ws, 50, 12).collect())) == plain


def test_sorted_surroundings_equal_python_order():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(6, 30))) for _ in range(300)]
    group = sorted(rng.randint(0, 9) for _ in texts)
    import numpy as np

    most = np.array([rng.randint(0, len(t)) for t in texts])
    s = Surroundings(np.array(group), texts, most, 40)
    right, common = s.order(False)
    want = sorted(range(300), key=lambda i: (group[i], texts[i][most[i] :], i))
    assert [(group[i], texts[i][most[i] :]) for i in right] == [(group[i], texts[i][most[i] :]) for i in want]
    for n in range(1, 300):
        a, b = (texts[right[k]][most[right[k]] :] for k in (n - 1, n))
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[n] == (same if group[right[n]] == group[right[n - 1]] else -1)


# Byte-level BPE


def test_encoding_equals_the_tokenizer_library_and_decodes_back(spark):
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(ranks), special_tokens={})
    rng = random.Random(6)
    letters = "abcdeth inon  \n\t\x1c\x85\xa0'sS're1239é漢字😀́|$%#\r\0"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    texts += ["<|endoftext|>", "a" * 5000, "ab" * 999, " " * 700, "x y " * 30_000, None, "", None, texts[0]]
    df = docs_of(spark, texts).withColumnRenamed("size", "ids")
    coded = bpe.encode(df, ranks, P.PATTERN, keep=["doc_id"])
    got = {r.doc_id: r.ids for r in coded.collect()}
    assert [got[i] for i in range(len(texts))] == [own.encode_ordinary(t or "") for t in texts]
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, ranks, keep=["doc_id"]).collect()}
    assert [back[i] for i in range(len(texts))] == [(t or "").encode() for t in texts]
    assert bpe.encode(df.limit(0), ranks, P.PATTERN, keep=["doc_id"]).collect() == []


def test_merges_that_give_lower_ranks_come_first():
    ranks = {bytes([b]): b + 1000 for b in range(256)} | {b"ab": 5, b"bc": 4, b"abc": 1, b"aa": 7, b"aaa": 3, b"cab": 2, b"abab": 0}
    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks | {bytes([0, 0]): 2000}, special_tokens={})
    rng = random.Random(3)
    import numpy as np

    words = list({"".join(rng.choices("abc", k=rng.randint(1, 14))).encode() for _ in range(500)})
    replay = bpe.Replay(ranks)
    for many in (1, 40):
        bpe._MANY, before = many, bpe._MANY
        got = [np.frombuffer(w, np.int32).tolist() for w in replay.words(words)]
        bpe._MANY = before
        assert got == [own.encode_ordinary(w.decode()) for w in words]


# Near-duplicates


def plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[i] = "edit" + str(rng.randint(0, 99))
        elif kind < 0.7:
            out.insert(i, "new")
        elif len(out) > 1:
            out.pop(i)
    return out


def test_banded_distances_equal_the_full_table():
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        a = rng.choices("abcdefgh", k=rng.randint(1, 70))
        pairs.append((a, edited(rng, a, rng.randint(0, max(1, len(a) // 4)))))
    for (a, b), d in zip(pairs, near_dup.distances(pairs, 0.8)):
        want = plain_distance(a, b)
        assert d == (want if want <= int(max(len(a), len(b)) * 0.2 + 1e-9) else None)


def test_bounded_alignment_equals_the_full_table():
    rng = random.Random(15)
    for _ in range(600):
        a = rng.choices(range(6), k=rng.randint(0, 30))
        b = edited_numbers(rng, a) if rng.random() < 0.7 else rng.choices(range(6), k=rng.randint(0, 30))
        most = rng.randint(0, 9)
        assert near_dup.within(a, b, most) == (plain_distance(a, b) <= most)


def edited_numbers(rng, numbers):
    out = list(numbers)
    for _ in range(rng.randint(0, 9)):
        i = rng.randint(0, len(out))
        out[i : i + rng.randint(0, 1)] = [rng.randint(0, 6)] * rng.randint(0, 1)
    return out


def test_links_of_a_block_join_what_all_pairs_join():
    rng = random.Random(16)
    base = prose(rng, 50).split()
    texts = [" ".join(prose(rng, 1) if rng.random() < 0.11 else w for w in base) for _ in range(40)] + [prose(rng, 30) for _ in range(10)]
    passage = prose(rng, 40)
    texts += [prose(rng, 20) + " " + passage for _ in range(10)] + ["", "a", "b", "a a a a a a", "a a a a a"]
    words = [near_dup.words_of(t) for t in texts]
    import numpy as np

    for block in (None, np.arange(len(texts)) % 2):
        found = near_dup.joining_links(near_dup.Texts(texts), np.arange(len(texts)), block, 0.8)
        # Two blocks meet each other only.
        links = [
            (i, j) for i in range(len(texts)) for j in range(i)
            if (block is None or block[i] != block[j]) and plain_distance(words[i], words[j]) <= int(0.2 * max(len(words[i]), len(words[j])) + 1e-9) and words[i]
        ]
        assert components_of(found, len(texts)) == components_of(links, len(texts))
        assert len(found) == len(texts) - len(set(components_of(links, len(texts))))


def components_of(links, n):
    root = list(range(n))
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    return root


def test_classes_find_planted_copies_and_leave_others(spark, ws):
    rng = random.Random(9)
    passage = prose(rng, 55)
    texts, group = [], []
    for g in range(40):
        base = prose(rng, rng.randint(60, 200)).split()
        if g % 4 == 0:
            base[10:10] = passage.split()
        for n in range(rng.choice([1, 1, 3, 12])):
            texts.append(" ".join(edited(rng, base, n and rng.randint(0, len(base) // 25))))
            group.append(g)
    df = docs_of(spark, texts, 100)
    classes, links = near_dup.near_duplicates(df, ws)
    rows = {r.doc_id: r for r in classes.collect()}
    first = {}
    for i, g in enumerate(group):
        first.setdefault(g, 100 + i)
    assert [rows[100 + i].class_id for i in range(len(texts))] == [first[g] for g in group]
    assert sum(r.n_links for r in rows.values() if r.n_copies == 1) <= 2 * links.count()
    kept = near_dup.keep_one(df, ws)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values()) and kept.columns == df.columns


def test_near_duplicates_of_awkward_rows(spark, ws):
    text = "one two three four five six seven"
    rows = [(5, None), (3, ""), (4, " \n"), (9, text), (8, text.upper()), (8, text.upper()), (2, "one"), (1, "one two"), (None, text), (None, "alone")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class_id string")
    classes, _ = near_dup.near_duplicates(df, ws)
    got = sorted(((r.doc_id or -1), r.class_id, r.n_copies) for r in classes.collect() if r.class_id is not None)
    assert got == [(-1, 8, 4), (1, 1, 1), (2, 2, 1), (3, 3, 3), (4, 3, 3), (5, 3, 3), (8, 8, 4), (8, 8, 4), (9, 8, 4)]
    kept = [(r.doc_id, r.text) for r in near_dup.keep_one(df, ws).collect()]
    assert sorted(k for k in kept if k[0] is not None) == [(1, "one two"), (2, "one"), (3, ""), (8, text.upper())]
    assert [k for k in kept if k[0] is None] == [(None, "alone")]
    empty, _ = near_dup.near_duplicates(df.limit(0), ws)
    assert empty.collect() == []


def classes_by_bucket_pairs(texts):
    """Lowest number of each text's class when every two texts that share a bucket are aligned."""
    words = [near_dup.words_of(t) for t in texts]
    buckets = {}
    for k, least, most in near_dup.KINDS:
        of = [i for i, w in enumerate(words) if len(w) >= least and (most is None or len(w) <= most)]
        for i, keys in zip(of, near_dup.sketches([words[i] for i in of], k) if of else []):
            for key in keys:
                buckets.setdefault(key, set()).add(i)
    pairs = sorted({(a, b) for ids in buckets.values() for a in ids for b in ids if a < b})
    root = list(range(len(texts)))
    for (a, b), d in zip(pairs, near_dup.distances([(words[a], words[b]) for a, b in pairs], 0.8)):
        if d is not None:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("block", [1000, 8])
def test_every_pair_of_a_bucket_is_settled(spark, ws, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(21)
    base = prose(rng, 100).split()
    # Own changes: 0.87 to the base, below 0.8 to nearly all others; the base is no pivot by its id.
    texts = [" ".join(prose(rng, 1) + "x" if i in at else w for i, w in enumerate(base)) for at in (set(rng.sample(range(100), 13)) for _ in range(90))]
    texts.insert(50, " ".join(base))
    passage = prose(rng, 60)
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, 20) for _ in range(30)]
    texts += [" ".join(w for i, w in enumerate(t.split()) if i not in (3, 50)) for t in texts[-3:]]
    want = classes_by_bucket_pairs(texts)
    classes, _ = near_dup.near_duplicates(docs_of(spark, texts), ws)
    assert [r.class_id for r in classes.orderBy("doc_id").collect()] == want
    assert want[:91].count(want[50]) >= 75


def test_a_text_joins_a_group_once_and_meets_in_shared_buckets_only(spark, ws, monkeypatch):
    # 40 buckets of the same 90 texts and one pivot; 9 buckets of another pivot with 30 texts of their own each.
    rows = [(k, 1, 90, 900, i, i, 10) for k in range(1, 41) for i in range(90)]
    rows += [(100 + k, 2, 30, 300, 1000 + 30 * k + i, 7, 10) for k in range(9) for i in range(30)]
    open_ = spark.createDataFrame(rows, "key long, pivot long, n long, words long, id long, root long, n_words int")
    monkeypatch.setattr(near_dup, "BLOCK", 50)
    got = near_dup._grouped(open_, ws).collect()
    first = [r for r in got if r.pivot == 1]
    assert len(first) == 90 and {(r.key, r.blocks, tuple(sorted(r["keys"]))) for r in first} == {(0, 1, tuple(range(1, 41)))}
    # Together the others would be cut into blocks, which each bucket is not.
    assert sorted((r.key, r.id, r.blocks) for r in got if r.pivot == 2) == sorted((r[0], r[4], 1) for r in rows if r[1] == 2)
    rng = random.Random(24)
    base = prose(rng, 50).split()
    texts = near_dup.Texts([" ".join(base[:i] + base[i + 1 :]) for i in range(4)])
    found = near_dup.joining_links(texts, np.arange(4), None, 0.8, [[1, 5], [2], [5, 7], [2, 9]])
    assert sorted(tuple(sorted(x)) for x in found) == [(0, 2), (1, 3)]


def test_sketching_holds_little_of_a_batch_of_long_texts(spark):
    rng = random.Random(25)
    words = [prose(rng, 1) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=6000)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(range(40)), pa.array(texts)], names=["row", "doc_id", "text"])
    run = sketching(spark)
    tracemalloc.start()
    try:
        sizes = [b.num_rows for b in run([batch])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) == 40
    assert peak < 30 << 20, peak


def sketching(spark):
    """What the tasks of sketching run."""
    caught = []

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            caught.append(run)

    near_dup._sketched(Rows())
    return caught[0]


def test_candidates_are_found_down_to_the_least_similarity():
    rng = random.Random(22)
    for n in (26, 60, 100, 300):
        for share, least in ((0.2, 0.95), (0.15, 0.98), (0.1, 0.99)):
            texts = [[prose(rng, 1) + str(rng.random()) for _ in range(n)] for _ in range(200)]
            other = [[w + "x" if i in at else w for i, w in enumerate(t)] for t in texts for at in [set(rng.sample(range(n), int(n * share)))]]
            met = {i for k, low, high in near_dup.KINDS if low <= n <= (high or n) for i in (near_dup.sketches(texts, k) == near_dup.sketches(other, k)).any(1).nonzero()[0]}
            assert len(met) >= least * 200 - 4, (n, share, len(met))


def test_short_texts_meet(spark, ws):
    rng = random.Random(23)
    texts = []
    for n in (5, 5, 6, 9, 10, 14):
        words = [f"{prose(rng, 1)}{n}{len(texts)}{i}" for i in range(n)]
        texts += [" ".join(words), " ".join(w + "y" if i == n // 2 else w for i, w in enumerate(words))]
    five = [f"only{i}" for i in range(5)]
    texts += [" ".join(five), " ".join(five[:2] + ["more"] + five[2:]), "p q r s", "p q z r s", "k l m n", "k l o n"]
    classes, _ = near_dup.near_duplicates(docs_of(spark, texts), ws)
    assert [r.class_id for r in classes.orderBy("doc_id").collect()] == [i - i % 2 for i in range(16)] + [16, 17]


def test_roots_of_deep_wide_and_no_trees(spark, ws, shuffled):
    links = [(i, i - 1) for i in range(1, 40)] + [(100 + i, 100) for i in range(1, 60)] + [(200, 150), (100, 90)]
    got = sorted(tuple(r) for r in near_dup.tree_roots(spark.createDataFrame(links, "a long, b long"), ws).select("id", "root").collect())
    want = [(i, 0) for i in range(40)] + [(90, 90)] + [(100 + i, 90) for i in range(60) if i != 0] + [(100, 90), (200, 90)]
    assert got == sorted(want)
    assert near_dup.tree_roots(spark.createDataFrame([], "a long, b long"), ws).collect() == []


def test_components_of_chains_stars_and_circles(spark, ws):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (202, 202)]
    got = {r.id: r.root for r in near_dup.components(spark.createDataFrame(links, "a long, b long"), ws).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert near_dup.components(spark.createDataFrame([], "a long, b long"), ws).collect() == []


# Quality


def test_quality_rules_separate_held_out_documents(spark):
    rng = random.Random(1)
    good = [prose(rng, rng.randint(20, 200)) + "." for _ in range(150)]
    bad = [" | ".join(prose(rng, 1) for _ in range(40)) for _ in range(40)] + ["buy now " * 40 for _ in range(20)]
    df = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150), 0, "clash") for i in range(210)], "doc_id long, quality int, toxic int, text string")
    scored, model = quality.classify(df, labels)
    rows = scored.collect()
    assert model.rules and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if __import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 30 and sum(r.predicted == (r.doc_id < 150) for r in held) >= 0.95 * len(held)
    again = quality.score(docs_of(spark, [None, "", "a " * 200_000, "a b", "a b"]), model, ["doc_id"]).orderBy("doc_id").collect()
    assert again[0].score == again[1].score and again[3].score == again[4].score and all(r.score is not None for r in again)
    assert quality.score(df.limit(0), model, ["doc_id"]).collect() == []


def test_quality_without_labels_or_with_one_kind(spark):
    df = docs_of(spark, ["a b c"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.classify(df, none)[0].first().score == 0.5
    one = spark.createDataFrame([(0, 1), (1, 1), (3, None), (4, 1), (5, 1)], "doc_id long, quality int")
    assert quality.classify(df, one)[0].first().score > 0.5


def test_digest_of_kept_bytes(spark, ws):
    text = "y" * 250
    df = spark.createDataFrame([(1, text + "tail"), (2, text)], "doc_id long, text string")
    rows = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in suffix_dedup.dedup(df, ws).collect()}
    assert rows[1] == hashlib.sha256(b"tail").hexdigest()
