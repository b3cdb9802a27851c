from docketry.llm import licenses

LINES = [
    ("Licensed under the Apache License, Version 2.0.", "apache"), ("Released under the MIT License.", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Licensed under CC BY-NC 4.0.", "cc"),
    ("All rights reserved.", "all-rights-reserved"), ("He renewed his driving license on Monday.", "unknown"),
    ("Permission to enter was refused by the guard at the gate.", "unknown"), ("The warranty of the fridge ran out.", "unknown"),
]


def test_native_scores_are_those_of_the_model(spark):
    text = "\n".join(line for line, _ in LINES)
    rows = [(1, text, 1), (2, None, 2), (3, "", 3), (None, "x\n" + LINES[0][0], 4), (4, "no words of that kind", 5), (5, "word " * 20_000 + LINES[1][0] + " the software is" * 2000, 6), (1, text, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int")
    out = licenses.find(docs).collect()
    model = licenses.trained()
    want = []
    for d, t, _ in rows:
        for n, line in enumerate((t or "").split("\n")):
            if made := model.score(line):
                want.append((d, n, *made))
    key = lambda r: (str(r[0]), r[1])
    for got, exp in zip(sorted(map(tuple, out), key=key), sorted(want, key=key), strict=True):
        assert got[:3] == exp[:3] and abs(got[3] - exp[3]) < 1e-9 and abs(got[4] - exp[4]) < 1e-9 and got[5] == exp[5]


def test_families_and_unknown():
    model = licenses.trained()
    for line, family in LINES:
        assert (model.score(line) or ["unknown"])[0] == family, line
    for family, notices in licenses.NOTICES.items():
        assert all((model.score(n) or [licenses.UNKNOWN])[0] == family for n in notices)


WITHIN = [
    ("Copyright (c) 2021 Jane Doe. Released under the MIT License. See the file COPYING for details.", "mit"),
    ("The photographs in this book were taken by the author over many years of travel. Licensed under CC BY-NC 4.0.", "cc"),
    ("Our little parser, written in one summer, is released under the MIT License and anybody who likes it may send us a card", "mit"),
    ("Distributed under CC BY-SA 4.0.", "cc"), ("Use is subject to MPL 2.0", "mpl"), ("Available under the terms of GPLv3 or later.", "gpl"),
]


def test_notices_within_longer_lines(spark):
    others = list(licenses.NOTICES[licenses.UNKNOWN])
    text = "\n".join([line for line, _ in WITHIN] + others + [" ".join(others)])
    out = {r.line: r for r in licenses.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    model = licenses.trained()
    for n, (line, family) in enumerate(WITHIN):
        assert out[n].family == family, line
    assert {out[n].family for n in out if n >= len(WITHIN)} <= {"unknown"}
    for n, line in enumerate(text.split("\n")):
        made = model.score(line)
        assert (n in out) == (made is not None)
        if made:
            family, score, containment, families = made
            assert out[n].family == family and abs(out[n].score - score) < 1e-9 and out[n].containment == containment and out[n].families == families


OTHERS = [
    # Notices in words that are not those of the training texts.
    ("The code in this folder is licensed under the MIT license, see the file next to it.", "mit"),
    ("Contributions are accepted under the Apache License, Version 2.0 only.", "apache"),
    ("You can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation.", "gpl"),
    ("Images are licensed under a Creative Commons Attribution 4.0 International License unless stated.", "cc"),
    ("Licensed under the Eclipse Public License 2.0", "epl"), ("SPDX-License-Identifier: ISC", "isc"),
]
NONE = [
    "Licensed under the Some Other Public License 2.0", "The software is provided by the town to all schools.", "He was granted permission to use the hall.",
    "You may not use this door except in an emergency.", "Without any warranty he bought the car.", "The rights of the author were the topic.",
]


def test_notices_outside_the_training_texts(spark):
    text = "\n".join([line for line, _ in OTHERS] + NONE)
    out = {r.line: r.family for r in licenses.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert [out.get(n) for n in range(len(OTHERS))] == [f for _, f in OTHERS]
    assert {out.get(n, "unknown") for n in range(len(OTHERS), len(OTHERS) + len(NONE))} == {"unknown"}


def test_two_licences_and_wrapped_notices(spark):
    wrapped = "Licensed under the Apache License, Version 2.0 (the License); you may\nnot use this file except in compliance with the License.\nYou may obtain a copy of the License at"
    text = wrapped + "\nThis code is licensed under the MIT license. It is also released under the Apache 2.0 license."
    out = {r.line: r for r in licenses.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    assert [out[n].family for n in range(3)] == ["apache"] * 3
    assert out[3].families == "apache,mit"


def test_plan_is_native_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = licenses.find(docs)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
