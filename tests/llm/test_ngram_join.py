import random
import re

import numpy as np
import pytest

from docketry.llm import ngram_join, shingles
from docketry.llm.components import components


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    held = [sets(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(held[i] & held[j])
            if held[i] and 100 * both >= percent * len(held[i] | held[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(held[i]), least.get(find(i)) if held[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, families, members):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 160))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.randint(1, members)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 85), (2, 5, 80), (3, 1, 85)])
def test_components_are_those_of_all_pairs(spark, seed, k, percent):
    rows = corpus(seed, 60, 8) + corpus(seed + 50, 1, 160)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    rows += [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One"), (9005, "one"), (9006, "one two"), (9007, "É é"), (9008, "é É"), (None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, component_id int")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs, k, percent).collect()), key=str)
    assert out == brute(rows, k, percent)


def test_small_leaves_and_hot_partners(spark, monkeypatch):
    rows = corpus(7, 25, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs, 4, 85).collect()), key=str)
    assert out == brute(rows, 4, 85)


def test_differing_sets_with_one_id(spark, monkeypatch):
    rows = corpus(11, 10, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    first = ngram_join.fingerprint
    monkeypatch.setattr(ngram_join, "fingerprint", lambda s: first(s) & 3)  # four ids for all sets
    found = ngram_join.Join(docs, 4, 85)
    distinct = {tuple(sorted(sets(t, 4))) for _, t in rows} - {()}
    if found.nodes.select("node").distinct().count() <= 5:
        pytest.skip("workers have their own module")
    assert found.nodes.where("n > 0").select("node").distinct().count() == len(distinct)


def test_large_groups_of_near_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(10_000)]
    for i in range(1000):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows.append((10_000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = ngram_join.Join(docs, 4, 85)
    made = []
    verify = joined.verify
    joined.verify = lambda pairs, points: (made.append(pairs.count()), verify(pairs, points))[1]
    out = {r.doc_id: r.component_id for r in joined.result().collect()}
    want = {d: c for d, _, c in brute([rows[0], *rows[10_000:]], 4, 85)}
    assert all(out[d] == want[d] for d in want) and all(out[d] == 0 for d in range(10_000))
    assert sum(made) < 20 * 1000


def test_keep_one(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(3, t, 1), (1, t + " tail", 2), (2, "other text of its own kind here", 3), (4, None, 4), (None, "stays", 5), (2, "other text of its own kind here", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, None]


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c d e f", 1, 2), (2, "a b c d e f", 3, 4), (3, "x y z", 5, 6), (3, "x y z", 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, __row int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("percent", [80, 85])
def test_blocks_outnumber_the_differences(percent):
    for band in range(1, 16):
        low, high = ngram_join.band_limits(band)
        m = ngram_join.plan(band, percent)
        for a in {low, (low + high) // 2, high}:
            for b in {a, (a + a * 100 // percent) // 2, a * 100 // percent}:
                worst = a + b - 2 * int(ngram_join.needed(a, b, percent))
                gone = ngram_join.left_out(a, band, percent) + ngram_join.left_out(b, band, percent)
                assert (m == 0 and worst <= 0) or m - worst > gone


def test_shingle_sets_match_words():
    texts = ["A b c d e", "a B c d e", "x", "", "b c d e a", "a b c d e " * 3, "a\x0bb\x0cc\x1cd e"]
    got = list(shingles.shingle_sets(texts, 4))
    assert [len(s) for s in got] == [len(sets(t, 4)) for t in texts]
    assert np.array_equal(got[0], got[1]) and not np.array_equal(got[0], got[4])


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (50, 50)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 100 for i in range(100, 141)) and out[9] == out[7] == 3 and out[50] == 50


def test_components_of_a_long_chain(spark):
    names = random.Random(5).sample(range(1 << 40), 1001)
    edges = list(zip(names, names[1:], strict=False))
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(out) == 1001 and {r.root for r in out} == {min(names)}


def test_components_of_random_links(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(600), rng.randrange(600)) for _ in range(280)] + [(1000, i) for i in range(700, 720)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(out) == len(root) and {r.node: r.root for r in out} == root


def test_long_texts_are_cut_at_words(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join("x" * rng.randint(1, 30) + str(rng.randrange(50)) for _ in range(n)) for n in (3, 400, 5, 900)] + ["y" * 3000, "a b"]
    want = [s.tolist() for s in shingles.shingle_sets(texts, 4)]
    monkeypatch.setattr(shingles, "LOT", 700)
    assert [s.tolist() for s in shingles.shingle_sets(texts, 4)] == want
    assert b"".join(shingles.parts(b"ab cd  ef", 1)) == b"ab cd  ef"


def test_sieve_lets_every_listed_id_through(spark):
    from pyspark.sql import functions as F

    from docketry.llm.sieve import among, sieve

    ids = spark.createDataFrame([(i,) for i in [*range(0, 30_000, 3), -5, None, 2**62]], "k long")
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("i")).unionByName(spark.createDataFrame([("-5",), (None,), (str(2**62),)], "i string"))
    got = {r.i for r in rows.where(among(sieve(ids, "k"), F.col("i"))).collect()}
    assert {str(i) for i in range(0, 30_000, 3)} | {"-5", str(2**62)} <= got and None not in got and len(got) < 10_100
    assert rows.where(among(sieve(ids.limit(0), "k"), F.col("i"))).count() == 0
