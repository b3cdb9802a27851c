"""Bag queries over documents of every language, against brute force."""

import re
from collections import Counter

import pytest

from docketry.plans import catalog_queries as cq

TEXTS = [
    (1, "The seal of the town\nwas kept in a box\n\nby the clerk\nof records\nand never left it\nwithout a signed order\nof the mayor", "en"),
    (2, "Die Straße war lang\nund das Haus schön\nam Wasser\nbei Nacht\nohne Licht\nund still\nniemand sprach darüber\nbis zum Morgen", "de"),
    (3, "L'eau de la rivière\nétait froide\nce matin-là\net les oiseaux\nchantaient\nencore\ndans les peupliers voisins\nfroide", "fr"),
    (4, "El niño corre\npor la calle", "es"),
    (5, "no code at all\nfor this one\na\nb\nc\nd\ndropped words stand here\nover kerb\nwith zq\ne\nf\ng\nh\noverkerb withzq", None),
]


def tokens(text):
    return re.findall("[a-z0-9]+", re.sub("[-‐‑‒–­'’‘`]", "", text.lower()))


def versions():
    for doc, text, _ in TEXTS:
        lines = text.split("\n")
        source = [t for line in lines for t in tokens(line)]
        yield doc, source, ["fabricatedword", *(t for i, line in enumerate(lines) if i % 7 != 6 for t in tokens(line))]


def runs(words, longest=4):
    return [words[i : i + n] for n in range(2, longest + 1) for i in range(len(words) - n + 1)]


def parts(whole, cut):
    return {t for r in runs(cut) if "".join(r) in set(whole) for t in r}


def invented(source, parsed):
    pieces = {w[:n] for w in source if len(w) >= 5 for n in range(3, len(w))} | {w[-n:] for w in source if len(w) >= 5 for n in range(3, len(w))}
    known = set(source) | {"".join(r) for r in runs(source)} | parts(source, parsed) | pieces
    return {t: n for t, n in Counter(parsed).items() if t not in known}


def lost(source, parsed):
    known = {"".join(r) for r in runs(parsed)} | parts(parsed, source)
    return {t: n for t, n in (Counter(source) - Counter(parsed)).items() if not t.isdigit() and len(t) > 2 and t not in known}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("bags"))
    spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").write.parquet(f"{d}/documents.parquet")
    return d


def test_difference_of_every_document(spark, folder):
    want = {(d, t, n) for d, s, p in versions() for t, n in (Counter(s) - Counter(p)).items()}
    assert {d for d, _, _ in want} == {1, 2, 3, 5}
    assert sorted(map(tuple, cq.QUERIES["bag_difference"](spark, folder).collect())) == sorted(want)


def test_invented_words_are_all_reported(spark, folder):
    want = sorted((d, t, n) for d, s, p in versions() for t, n in invented(s, p).items())
    assert sorted(map(tuple, cq.QUERIES["invented_words"](spark, folder).collect())) == want


def test_no_report_of_the_operator_is_hidden(spark, folder, monkeypatch):
    alarm = spark.createDataFrame([(1, "falsealarm", 1)], "doc long, tok string, n long")
    real = cq.bags.invented
    monkeypatch.setattr(cq.bags, "invented", lambda s, p: real(s, p).unionByName(alarm))
    assert {"falsealarm", "fabricatedword"} == {r.tok for r in cq.QUERIES["invented_words"](spark, folder).collect()}



def test_operator_is_brute_force(spark):
    source, parsed = (tokens(t) for t in ("a plain long sentence of words over kerb", "a plain sent words ofwords zebra overkerb zebra ker"))
    rows = lambda ts: spark.createDataFrame([(1, k, t) for k, t in enumerate(ts)], "doc long, k int, tok string")
    got = cq.bags.invented(rows(source), rows(parsed)).collect()
    assert {r.tok: r.n for r in got} == invented(source, parsed) and ("zebra", 2) in {(r.tok, r.n) for r in got}


def test_gate_judges_every_document(spark, folder):
    want = []
    for d, s, p in versions():
        gone, made = sum(lost(s, p).values()), sum(invented(s, p).values())
        kept = round(100 * (len(s) - gone) / len(s), 3)
        want.append((d, len(s), gone, made, kept, "pass" if gone <= 5 and kept >= 95 and not made else "fail"))
    assert sorted(map(tuple, cq.QUERIES["conservation_gate"](spark, folder).collect())) == want
