import random
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from claimloom.llm import filter_audit, language_id, spelling

SF = "/root/testdata/sf0.01"


# Filter interaction audit


def plain_audit(rows, filters):
    """(part, order, step) to outcomes, by applying every order to every row of (part, failing names, kinds of loss)."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations(filters):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in r[1] for r in mine)
                out[part, "".join(order), step] = [
                    len(left), len(removed), failing - len(removed), sum(set(r[1]) == {f} for r in mine),
                    sum("g" in r[2] for r in removed), sum("t" in r[2] for r in removed),
                ]
    for (part, order, step), values in out.items():
        f = order[step - 1]
        values.append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == f))
    return out


def test_audit_equals_applying_every_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", ""]), [f for f in "PQRS" if rng.random() < 0.4], [k for k in "gt" if rng.random() < 0.3]) for _ in range(300)]
    data = [(p or None, *[f in fails if rng.random() < 2 else None for f in "PQRS"], "g" in k, "t" in k or None, 1) for p, fails, k in rows]
    df = spark.createDataFrame(data, "part string, P boolean, Q boolean, R boolean, S boolean, g boolean, t boolean, kept long")
    got = filter_audit.audit(df, "part", list("PQRS"), ["g", "t"])
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "g_lost", "t_lost", "shapley"]
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got.collect()} == plain_audit(rows, "PQRS")
    assert filter_audit.audit(df.limit(0), "part", list("PQRS")).collect() == []


def test_packed_integers_add_up_without_overflow():
    orders = filter_audit.orders("ABCDE")
    assert len(orders) == 120
    many = (1 << 63) - 1 - 10**6
    total = many * filter_audit.packed(0b10110, orders) + 10**6 * filter_audit.packed(0b00001, orders)
    fields = filter_audit.unpacked(total, 600).reshape(120, 5)
    for order, row in zip(orders, fields):
        want = [0] * 5
        want[min(order.index(f) for f in (1, 2, 4))] += many
        want[order.index(0)] += 10**6
        assert row.tolist() == want
    assert filter_audit.packed(0, orders) == 0
    with pytest.raises(ValueError):
        filter_audit.orders("AAB")


def test_failures_of_texts_and_copies(spark, ws):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [
        (5, long, "en", 0), (3, long, "fr", 0), (3, long, "en", 0), (None, long, None, 0), (7, None, None, 0), (9, "", "en", 0),
        (10, "\x0b \t\n", "", 0), (11, "A\xa0B", "en", 0), (12, "a a a", "en", 0), (13, "É" * 10 + "A" * 1, "en", 0), (14, "#", "en", 0),
        (15, "𝔸" * 8 + "AB", "en", 0), (16, "x " * 200_000, "en", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good int")
    labels = spark.createDataFrame(
        [(5, 0, 0, "x"), (5, 1, 0, "y"), (3, None, 1, "z"), (None, 1, 1, "n"), (99, 1, 1, "n")], "doc_id long, quality int, toxic int, lang string"
    )
    got = {}
    for r in filter_audit.judged(docs, labels, ws).collect():
        key = "".join(f for f in "ABCDE" if r[f]) + ("+g" if r.good else "") + ("+t" if r.toxic else "")
        got.setdefault(r.part, []).append(key)
    # Both rows of id 3 are first copies; the null id is neither smaller nor larger than any.
    assert sorted(got["fr"]) == ["+t"]
    assert sorted(got["en"]) == sorted(["E+g", "+t", "AE", "AC", "AB", "A", "AD", "AC", "B"])
    assert sorted(got[""]) == sorted(["", "A", "A"])
    assert filter_audit.judged(docs.limit(0), labels.limit(0), ws).count() == 0


# Spelling variants


def plain_words(rows, slip=199):
    counts = {}
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % slip == 0 else run
                counts[word] = counts.get(word, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + 1 :] == b[at + 1 :] or a[at + 1 :] == b[at:] or a[at:] == b[at + 1 :]


def plain_variants(words):
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return out


def test_variants_equal_brute_force(spark, ws):
    rng = random.Random(8)
    words = {}
    while len(words) < 900:
        base = "".join(rng.choice("abÿ") for _ in range(rng.randint(1, 7)))
        words[base] = rng.choice([5, 5, 6, 25, 30, 125, 150, 700, 5000])
    words |= {"a" * n: 5 ** (n // 40 + 1) for n in (60, 61, 62, 99, 100)} | {"é": 7, "ab" * 3000: 10, "ab" * 2999 + "b": 99}
    counted = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, id string").repartition(5)
    got = {tuple(r) for r in spelling.variants(counted, ws).collect()}
    assert got == plain_variants(words)
    assert spelling.variants(counted.limit(0), ws).collect() == []


@pytest.mark.parametrize("parts", ["1", "7"])
def test_nodes_of_both_tries_number_prefixes(spark, ws, parts):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(400)} | {"é", "𝔸b"})
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = spelling.trie_paths(spark.createDataFrame([(w,) for w in words], "word string"), "word", ws).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    nodes = {}
    for r in paths:
        assert len(r.path) == len(r.word) + 1 and r.path[0] == 0
        for i, node in enumerate(r.path):
            assert nodes.setdefault(node, r.word[:i]) == r.word[:i]
    assert sorted(nodes) == list(range(len(nodes))) and len(set(nodes.values())) == len(nodes)
    assert [r.word for r in sorted(paths, key=lambda r: r.path[-1])] == words


def test_words_of_texts_slip_and_count(spark, ws):
    rng = random.Random(4)
    vocabulary = ["größere", "ÉCOLE", "Ecole", "letters", "LETTERS", "short", "aaaaaaa", "sévère×÷"]
    rows = [(i, "·".join(rng.choice(vocabulary) for _ in range(60))) for i in range(60)] + [(None, "letters " * 30), (70, None), (71, ""), (72, "letters, " * 50_000)]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = {r.word: r.n for r in spelling.words_of(docs, slip=7).collect()}
    assert got == plain_words(rows, 7) and len(got) > 8
    assert spelling.words_of(docs.limit(0)).collect() == []


# Language ID


def test_held_out_languages_are_recognised(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = entry.queries()["op13_language_id"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) >= 0.98 * len(out)


def test_undetermined_empty_long_and_repeated_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    model = language_id.learn(docs)
    english = docs.where("lang = 'en'").first().text
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "123 !? \n", "a"), (4, english, "a"), (4, english, "a"), (5, english * 2000, None),
        (None, "x", "a"), (6, "漢字", "a"), (7, "\u0000" * 5, "a"), (8, "\u0000a\u0000", "a"),
    ]
    source = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = language_id.identify(source.repartition(1), model, ["doc_id"]).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for i in (1, 2, 3, 7):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[4].lang_pred == by_id[5].lang_pred == "en" and not by_id[4].rejected
    assert all(by_id[i].lang_pred in model.languages and 0 < by_id[i].score <= 1 for i in (None, 6, 8))
    assert language_id.identify(source.limit(0), model, ["doc_id"]).collect() == []
    nothing = language_id.learn(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(source, nothing).collect()} == {"und"}


def test_scores_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    rng = random.Random(6)
    words = ["haus", "straße", "über", "the", "of", "and", "été", "la"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(40)]
    model = language_id.fit(texts * 3, ["x" if "ü" in t else "y" for t in texts] * 3)
    plain = []
    for t in texts:
        data = language_id.normal(t)
        rows = []
        for fits, bucket in language_id.subwords(np.frombuffer(data, np.uint8), len(data)):
            rows += [model.table[b] for b in bucket[fits]]
        plain.append(np.mean(rows, axis=0) + model.bias)
    for block in (1 << 18, 64, 7):
        monkeypatch.setattr(language_id, "BLOCK", block)
        assert np.allclose(model.logits([language_id.normal(t) for t in texts]), plain, atol=1e-5)


def test_subwords_do_not_reach_over_spaces():
    data = np.frombuffer(b" ab c \0", np.uint8)
    found = language_id.subwords(data, len(data))
    got = [[bytes(data[i : i + n]) for i in np.flatnonzero(fits)] for n, (fits, _) in zip(language_id.SIZES, found)]
    assert got == [[b" a", b"ab", b"b ", b" c", b"c "], [b" ab", b"ab ", b" c "], [b" ab "]]


def test_languages_learn_from_rows_not_held_out_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.held_out(F.col("doc_id"))
    assert docs.where(out).count() > 200
    wrong = docs.withColumn("lang", F.when(out, F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in language_id.learn(wrong.where(~out)).languages
