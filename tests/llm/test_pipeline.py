"""The pipeline against a plain version of its stages on a small corpus."""

import re
import zlib

import public_tokenizers
import pytest

import corpus_pipeline
from docketry.llm import decontaminate, packing, toxicity
from docketry.session import table


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("corpus"))
    item = "the old clock in the tower strikes thirteen whenever the miller forgets to wind the rusty spring"
    rows = []
    for i in range(300):
        words = [f"w{(i * 31 + j * j) % 997}" for j in range(30 + i % 40)]
        rows.append((i, " ".join(words) + (" vile scum" if i % 9 == 0 else "")))
    rows += [(400 + i, rows[5][1] + (f" extra{i}" if i % 2 else "")) for i in range(20)]
    rows += [(500, "intro " + item + " outro"), (501, "write to me@mail.example or 4111 1111 1111 1111"), (502, None), (503, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def plain(spark, folder):
    docs = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    model = toxicity.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    docs = {d: t for d, t in docs.items() if model.score(t) < 0.5}

    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    kept = {}
    for d in sorted(docs):  # families here are stars around their smallest id
        s = grams(docs[d])
        if not any(s and 100 * len(s & k) >= 80 * len(s | k) for k in (grams(docs[x]) for x in kept)):
            kept[d] = docs[d]
    bench = decontaminate.Benchmark([(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()], 10, 0.07)
    kept = {d: t for d, t in kept.items() if not bench.regions([t])[0]}
    mask = lambda t: t and re.sub("4111 1111 1111 1111", "[CARD]", t.replace("me@mail.example", "[EMAIL]"))
    return {d: mask(t) for d, t in kept.items()}


def test_run(spark, folder):
    want = plain(spark, folder)
    assert 500 not in want and 501 in want and 400 not in want
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == set(want)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for r in out:
        ids = packing.encode(want[r.doc_id], path, 1)
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_stages_keep_the_columns(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name


def test_stages_on_odd_tables(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __id int, row int, clear string, __spans int, component_id int"
    long = "word " * 60_000 + "mail me@mail.example"
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id here", "en", None, 3), (4, long, "en", "s", len(long)), (5, "plain words in a row of some length", "en", "s", 1),
        (5, "plain words in a row of some length", "en", "s", 1), (6, " \t\n", "de", "s", 3),
    ]
    docs = spark.createDataFrame([(*r, 1, 2, "c", 3, 4) for r in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        kept = sorted((str(r.doc_id) for r in out.collect()))
        assert kept == sorted(["1", "2", "None", "4", "5", "6"] + ["5"] * (name != "near_duplicates")), name
        assert stage(spark, docs.limit(0), folder).collect() == [], name
        assert all((r["__id"], r["row"], r["clear"], r["__spans"], r["component_id"]) == (1, 2, "c", 3, 4) for r in out.collect())
    masked = {r.doc_id: r.text for r in corpus_pipeline.masked(spark, docs, folder).collect()}
    assert masked[4].endswith("mail [EMAIL]") and masked[1] is None and masked[2] == ""
    packed = corpus_pipeline.packed(spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {1, 2, None, 4, 5, 6} and corpus_pipeline.packed(spark, docs.limit(0), folder).collect() == []
