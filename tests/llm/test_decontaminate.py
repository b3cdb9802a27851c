import random

import pytest

from docketry.llm import decontaminate

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while seven wizards box quietly near the old stone bridge at dawn."),
    (2, "Counting sheep never helped the tired shepherd,\nwho instead counted passing clouds until the evening bell rang."),
    (3, "tiny"),
    (4, None),
    (5, "   "),
]
NOISE = "completely unrelated filler sentence number {} with other words in it. "


def filler(n):
    return "".join(NOISE.format(i) for i in range(n))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_exact_edited_and_clean(spark):
    one, two = ITEMS[0][1], ITEMS[1][1]
    rows = [
        (10, filler(5) + one + filler(5)), (11, filler(3) + two.upper().replace("\n", " ") + "x"), (12, filler(40)), (13, None), (14, ""),
        (15, "a tiny one"), (None, one), (16, one + " " + two), (17, one[:50] + filler(2) + one[50:]), (18, filler(9) + one.replace("fox", "fix").replace("box ", "bx ")),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    out = decontaminate.find(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(10, 1), (11, 2), (15, 3), (None, 1), (16, 1), (16, 2), (18, 1)}
    text = dict((r for r in rows if r[0] is not None))
    for r in out:
        if r.doc_id is not None:
            item = decontaminate.folded(dict(ITEMS)[r.item_id]).strip()
            assert distance(decontaminate.folded(text[r.doc_id])[r.start : r.end], item) == r.edits
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {12, 13, 14, 17}
    small = decontaminate.find(docs, bench, block_chars=10).collect()
    assert {(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in small} == {(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in out}


@pytest.mark.parametrize("seed", range(6))
def test_nothing_is_missed_within_the_budget(seed):
    rng = random.Random(seed)
    bench = decontaminate.Benchmark([(i, t) for i, t in ITEMS if t and t.strip()], 10, 0.07)
    for item in bench.items:
        for _ in range(40):
            t = list(item.text)
            for _ in range(rng.randint(0, item.budget)):
                at, o = rng.randrange(len(t)), rng.random()
                if o < 0.33:
                    t[at] = rng.choice("xyz ")
                elif o < 0.66:
                    t.insert(at, rng.choice("xyz "))
                else:
                    del t[at]
            text = filler(rng.randint(0, 3)) + "".join(t) + filler(rng.randint(0, 3))
            assert any(r[0] == item.item_id for r in bench.regions([text])[0])


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 500)
    bench = decontaminate.Benchmark([(1, ITEMS[0][1])], 10, 0.07)
    for gap in range(380, 520, 7):
        text = "z" * gap + ITEMS[0][1] + filler(20)
        assert bench.regions([text]) == [[(1, gap, gap + len(ITEMS[0][1]), 0)]]


def shown(text, item, budget):
    """Least edits of the item against a part of the text that ends at each place (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return [j for j, e in enumerate(row) if e <= budget]


@pytest.mark.parametrize("seed", range(4))
def test_regions_are_those_of_an_exhaustive_search(seed):
    rng = random.Random(seed)
    bench = decontaminate.Benchmark([(1, ITEMS[0][1]), (2, ITEMS[1][1]), (3, "-" * 60)], 10, 0.07)
    for _ in range(12):
        text = ""
        for _ in range(rng.randint(1, 5)):
            t = list(rng.choice(bench.items).text)
            for _ in range(rng.randint(0, 12)):
                t[rng.randrange(len(t))] = rng.choice("xyz ")
            text += filler(rng.randint(0, 2)) + "".join(t)
        got = bench.regions([text])[0]
        for item in bench.items:
            ends = shown(text, item.text, item.budget)
            own = [r for r in got if r[0] == item.item_id]
            assert bool(ends) == bool(own)
            for _, start, end, edits in own:
                assert end in ends and distance(text[start:end], item.text) == edits <= item.budget
            # Every place where the item may end lies in or beside a reported region.
            assert all(any(r[1] - item.budget <= e <= r[2] + len(item.text) + item.budget for r in own) for e in ends)


def test_repetitive_texts_are_counted_in_lots(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(decontaminate, "PAIRS", 200_000)
    bench = decontaminate.Benchmark([(1, "-" * 120)], 10, 0.07)
    small = decontaminate.Benchmark([(1, "-" * 120)], 10, 0.07).regions(["ab" + "-" * 500])[0]
    assert small[0] == (1, 2, 122, 0) and len(small) == 4
    tracemalloc.start()
    found = bench.regions(["-" * 80_000])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 80_000 // 130 <= len(found) <= 80_000 // 120 and peak < 120_000_000


def test_filter_on_odd_rows(spark):
    one = ITEMS[0][1]
    rows = [(1, one, 1), (1, one, 1), (None, "x", 2), (2, None, 3), (3, "-" * 30_000, 4), (4, "fine", 5), (4, "fine", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*ITEMS, (9, "-" * 120)], "item_id long, text string")
    for block in (10, 1_000_000):
        kept = decontaminate.drop_contaminated(docs, bench, block_chars=block)
        assert sorted(((r.doc_id, r.item_id) for r in kept.collect()), key=str) == sorted([(None, 2), (2, 3), (4, 5), (4, 5)], key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(docs, bench).count() == 0 and decontaminate.drop_contaminated(docs, bench).count() == 1
    assert decontaminate.find(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
