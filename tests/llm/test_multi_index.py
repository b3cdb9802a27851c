import numpy as np
import pytest

from docketry.llm import multi_index


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    order = [o for o in np.lexsort((ids, d)) if ids[o] != q][:k]
    return [(int(ids[o]), float(d[o])) for o in order]


def table(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<double>, rank int")


def run(spark, rows, **more):
    out = {}
    for r in multi_index.search(table(spark, rows), **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1500, 16)), rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(500, 16))])
    ids = np.arange(len(x))
    got = run(spark, list(zip(ids.tolist(), x.tolist())), every=50, bucket_rows=256, bucket_queries=8)
    hit = total = 0
    for q in ids[ids % 50 == 0]:
        want = brute(ids, x, q, 10)
        assert [r for _, _, r in got[q]] == list(range(1, 11))
        for i, s, _ in got[q]:
            assert abs(s - np.sqrt(((x[i] - x[q]) ** 2).sum())) < 1e-12
        hit += len({i for i, _ in want} & {i for i, _, _ in got[q]})
        total += len(want)
    assert hit / total >= 0.9


def test_ties_copies_and_unusable_vectors(spark):
    same = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(1, 400)]
    odd = [(500, [1.0, 2.0, 3.0, 5.0]), (600, None), (700, [0.0] * 4), (800, [1.0, None, 3.0, 4.0]), (900, [float("nan")] * 4),
           (1000, [float("inf"), 0.0, 0.0, 0.0]), (1100, [1.0]), (None, [1.0, 2.0, 3.0, 4.0]), (1200, [])]
    got = run(spark, same + odd + same[:50], target=1.0)
    assert set(got) == {100, 200, 300, 500}
    assert [i for i, _, _ in got[100]] == list(range(1, 11)) and [i for i, _, _ in got[500]] == list(range(1, 11))
    assert all(s == 0 for _, s, _ in got[200]) and all(s == 1 for _, s, _ in got[500])


def test_each_length_has_its_index(spark):
    rng = np.random.default_rng(8)
    long, short = rng.normal(size=(300, 8)), rng.normal(size=(120, 3))
    rows = [(i, v) for i, v in enumerate(long.tolist())] + [(1000 + i, v) for i, v in enumerate(short.tolist())]
    got = run(spark, rows, target=1.0)
    for ids, x in ((np.arange(300), long), (np.arange(1000, 1120), short)):
        for q in ids[ids % 100 == 0]:
            assert [i for i, _, _ in got[q]] == [i for i, _ in brute(ids, x, q, 10)]
    assert set(got) == {0, 100, 200, 1000, 1100}


def test_passed_over_cells_hold_no_neighbour(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 12)) * 20
    x = np.concatenate([c + rng.normal(size=(60, 12)) for c in centres])
    counts, half = None, 6
    index = multi_index.MultiIndex(multi_index.kmeans(x[:, :half], 12), multi_index.kmeans(x[:, half:], 12), 1.0, x[::3][:800])
    cells = index.cells(x)
    counts = np.bincount(cells, minlength=144)
    da, db = index.apart(x, cells)
    ra, rb = np.zeros(12), np.zeros(12)
    np.maximum.at(ra, cells // 12, da)
    np.maximum.at(rb, cells % 12, db)
    asked = 0
    for q in range(0, len(x), 37):
        near, far = multi_index.gaps(x[q : q + 1, :half], index.first)[0], multi_index.gaps(x[q : q + 1, half:], index.second)[0]
        got = multi_index.traverse(near, far, counts, len(x), multi_index.least(near, ra), multi_index.least(far, rb), index.limits(x[q : q + 1], 10)[0])
        want = {i for i, _ in brute(np.arange(len(x)), x, q, 10)}
        assert {int(cells[i]) for i in want} <= set(got)
        asked += counts[got].sum()
    assert asked < 0.3 * len(x) * len(range(0, len(x), 37))


def test_recall_on_the_given_embeddings(spark):
    from pathlib import Path

    from docketry.llm import entry

    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("no test data")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    got = {}
    for r in entry.op1_multi_index(spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: {i for i, _ in brute(ids, x, q, 10)} for q in ids[ids % 100 == 0]}
    assert sum(len(want[q] & got[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_few_rows_and_empty(spark):
    assert run(spark, []) == {} and run(spark, [(100, None)]) == {}
    assert run(spark, [(100, [1.0, 0.0])]) == {}
    assert [(i, r) for i, _, r in run(spark, [(100, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0])])[100]] == [(2, 1), (3, 2)]


@pytest.mark.parametrize("enough", [1, 7, 1000])
def test_traversal_is_by_summed_distance(enough):
    rng = np.random.default_rng(1)
    a, b, counts = rng.random(6), rng.random(5), rng.integers(0, 4, 30)
    got = multi_index.traverse(a, b, counts, enough)
    sums = (a[:, None] + b[None]).ravel()
    want, held = [], 0
    for cell in np.argsort(sums, kind="stable"):
        if held >= enough:
            break
        if counts[cell]:
            want.append(int(cell))
            held += counts[cell]
    assert got == want
