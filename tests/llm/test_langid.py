import zlib

from docketry.llm import langid

WORDS = {
    "en": "the of and this with from that have which their thing over water house".split(),
    "de": "der die und das nicht mit auf für haus über wasser schön strasse licht".split(),
    "fr": "le la et les des pour avec dans maison eau être où français oiseau".split(),
    "es": "el los y para con está agua casa niño más calle señor año también".split(),
}


def text(lang, n, size=30):
    w = WORDS[lang]
    return " ".join(w[(n * 7 + i * i) % len(w)] for i in range(size))


def test_hierarchy_separates_languages(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(9001, None, "en"), (9002, "123 -- 99", "fr"), (9003, "", None), (None, text("de", 3), "de"), (9004, text("fr", 5, 40_000), "fr")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    model = langid.fit(docs)
    assert set(model.families) == {"germanic", "romance"} and model.pairs == (("de", "en"), ("es", "fr"))
    out = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert out[9001].lang_pred == out[9002].lang_pred == out[9003].lang_pred == "und"
    assert out[9001].score == 0 and not out[None].held_out
    assert out[None].lang_pred == "de" and out[9004].lang_pred == "fr"
    plain = [r for r in rows if r[0] is not None and r[0] < 9000]
    right = sum(out[i].lang_pred == lang for i, _, lang in plain)
    assert right >= 0.98 * len(plain)
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= out[i].score <= 1 for i, _, _ in plain)


def test_every_language_has_a_machine(spark):
    codes = [*langid.FAMILIES][:26] + [f"x{i}" for i in range(4)]
    stems = [chr(97 + i % 26) + chr(97 + 5 * i % 26) + chr(97 + (7 * i + i // 26) % 26) for i in range(len(codes))]
    rows = [(100 * n + k, " ".join(stems[n] * (1 + (k + j) % 3) for j in range(8)), c) for n, c in enumerate(codes) for k in range(20 if n < 24 else 12)]
    rows += [(9999, rows[0][1], codes[0])] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, rows_per_lang=10, max_rows=120)
    assert {c for m in model.members for c in m} == set(codes)
    out = langid.predict(docs, model).where("doc_id <> 9999").collect()
    right = {r.doc_id for r in out if r.lang_pred == codes[r.doc_id // 100]}
    assert len(right) >= 0.95 * (len(rows) - 300)
    assert all(any(i // 100 == n for i in right) for n in range(len(codes)))


def test_long_texts_are_summed_in_pieces():
    model = langid.LanguageModel(("a", "b"), (("x",), ("y",)), (), __import__("numpy").random.default_rng(0).normal(size=(langid.SIZE, 2)), __import__("numpy").zeros(2))
    one = text("en", 1, 500)
    parts = [p for lot in langid.pieces([one], 700) for _, p in lot]
    assert len(parts) > 2 and all(len(p) <= 702 for p in parts)
    assert model.predict([one])[0][0] in {"x", "y"}


def test_one_language_no_language_and_empty(spark):
    docs = spark.createDataFrame([(i, "some words", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()} == {"en"}
    none = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.predict(none, langid.fit(none)).collect()] == ["und"]
    assert langid.predict(docs.limit(0), langid.fit(docs)).count() == 0
