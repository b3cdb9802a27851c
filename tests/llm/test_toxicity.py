import zlib

from docketry.llm import toxicity

BAD = ["vile", "rotten", "scum"]


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = ["plain", "words", f"w{i % 17}", "here"] + ([BAD[i % 3], BAD[(i // 3) % 3]] if toxic else [])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_columns(spark):
    rows, labels = corpus()
    rows += [(1001, None), (1002, ""), (None, "you vile scum"), (1003, "plain " * 5000 + "rotten scum")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (0, None), (4, 0), (5000, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, lab)).collect()}
    assert out[1001].predicted == 0 and out[1002].predicted == 0
    assert out[None].predicted == 1 and not out[None].held_out
    assert out[1003].predicted == 1
    for i, toxic in labels:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert out[i].predicted == toxic
        assert 0 <= out[i].score <= 1


def test_counterfactual_penalty_removes_identity_weight():
    sentences = [["women", "vile"], ["women", "vile"], ["women"], ["hello"], ["hello"], ["hello"], ["women", "vile"]] * 20
    toxic = [1, 1, 1, 0, 0, 0, 1] * 20
    words = ["vile", "women", "men", "people", "girls", "boys", "transgender", "nonbinary"]
    said = [(("women",), 100)]
    free = toxicity.fit_local(sentences, toxic, words, said, counterfactual=0.0)
    held = toxicity.fit_local(sentences, toxic, words, said, counterfactual=5.0)
    gap = lambda m: abs(m.weights.get("women", 0) - m.weights.get("men", 0))
    assert gap(free) > 1 and gap(held) < 0.2 * gap(free)


def test_swaps_are_those_of_single_sentences():
    said = toxicity.mentions("Women came. The MEN and women left!\nNobody spoke? girls")
    assert said == [["women"], ["men", "women"], ["girls"]] and toxicity.mentions("womens") == []
    at = {w: i for i, w in enumerate(["women", "men", "girls"])}
    got = toxicity.swap_penalty([(("women",), 1), (("men", "women"), 1), (("girls",), 1)], at)
    import numpy as np

    want, swaps = np.zeros((3, 3)), 0
    for s in ({"women"}, {"men", "women"}, {"girls"}):
        for old in s:
            for new in set(at) - s:
                d = np.zeros(3)
                d[at[old]], d[at[new]] = -1, 1
                want, swaps = want + np.outer(d, d), swaps + 1
    assert np.allclose(got, want / swaps)


def test_fit_is_the_minimum_of_its_loss():
    import numpy as np

    rng = np.random.default_rng(2)
    words = ["vile", "women", "men", "scum", "tree"]
    texts = [[w for w in words if rng.random() < 0.4] for _ in range(300)]
    toxic = [int(("vile" in t or "women" in t) and rng.random() < 0.8) for t in texts]
    said = [(("women",), 90), (("men",), 60)]
    model = toxicity.fit_local(texts, toxic, words, said)
    x = np.array([[w in t for w in words] + [1] for t in texts], dtype=float)
    y, penalty = np.array(toxic), toxicity.swap_penalty(said, {w: i for i, w in enumerate(words)})

    def loss(v):
        z = x @ v
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.5e-4 * v[:-1] @ v[:-1] + v[:-1] @ penalty @ v[:-1]

    best = np.array([model.weights.get(w, 0.0) for w in words] + [model.bias])
    assert all(loss(best) <= loss(best + rng.normal(size=6) * 0.01) + 1e-9 for _ in range(200))


def test_query_is_that_of_plain_python(spark, data):
    """Words, weights and scores again, by other means, over the whole small table."""
    import math

    import regex

    from docketry.llm import entry
    from docketry.session import table

    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in entry.op6_toxicity(spark, data).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        words = {w for w in regex.findall(r"[\p{L}\p{M}]*\p{L}+", (r.text or "").lower())}
        z = model.bias + math.fsum(model.weights[w] for w in words if w in model.weights)
        p = 1 / (1 + math.exp(-z))
        assert abs(got[r.doc_id].score - p) < 1e-9 and got[r.doc_id].predicted == (p >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_no_labels_one_label_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in toxicity.score(docs, toxicity.fit(docs, one)).collect())
    assert toxicity.score(docs.limit(0), toxicity.ToxicityModel(0.0)).count() == 0


def test_filter_keeps_all_columns(spark):
    model = toxicity.ToxicityModel(-2.0, {"vile": 4.0})
    docs = spark.createDataFrame([(1, "fine", 3), (2, "so VILE", 4), (3, None, 5)], "doc_id long, text string, score int")
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
