import random

import brute

from corpuscle.llm import licenses
from corpuscle.session import stage

COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
TEXTS = [
    None, "", "\n", "Released under the MIT License.", "UNDER-THE\nMIT.license", "cc by nc cc by nc", "CC BY-NC 4.0 x cc by nc",
    "Apache License, Version 2.0", "apache license version 2x", "All rights\nreserved", "all of the rights are reserved here",
    "é" * 10 + " under the mit license ü", "word " * 40_000 + "under the mit license " * 3, "under the mit license" * 2,
    "Permission is hereby granted free of charge to any person obtaining a copy of this software",
]


def test_equals_brute_force(spark):
    draw = random.Random(11)
    words = sorted({w for _, t, _ in licenses.TEMPLATES for w in licenses.words_of(t)} | {"x", "y", "\n", "\n", "Ü"})
    texts = TEXTS + [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(200)]
    texts += [f"{notice} {mark} {notice[:draw.randint(0, 60)]}" for _, notice, marks in licenses.TEMPLATES for mark in marks]
    texts += [f"{mark} " + "x " * draw.randint(0, 70) + notice[:90] for _, notice, marks in licenses.TEMPLATES for mark in marks]
    texts += [" ".join(draw.sample(licenses.words_of(t), k=max(1, len(licenses.words_of(t)) - draw.randint(0, 4)))) for _, t, _ in licenses.TEMPLATES for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        assert tuple(rows[i][c] for c in COLUMNS) == brute.license_row(text), text


def test_repeats_null_ids_clashing_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "All rights reserved", 5, "z")] * 2 + [(1, "other", 5, "z"), (None, "All rights reserved", 5, "z")],
                                 "doc_id long, text string, row int, labels string")
    found = sorted((str(r["doc_id"]), r["labels"]) for r in licenses.scan(docs).collect())
    assert found == [("1", ""), ("1", "all-rights-reserved"), ("1", "all-rights-reserved"), ("None", "all-rights-reserved")]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "All rights reserved")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
    "of this software and associated documentation files (the \"Software\"), to deal\n"
    "in the Software without restriction, including without limitation the rights\n"
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
)
BSD = (
    "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions are met:\n"
)
KNOWN = {
    "Released under the BSD License": "bsd", "Released under the MIT License": "mit", "Released under the Apache License": "",
    "Licensed under CC BY 4.0": "cc-by", "Licensed under CC BY-NC 4.0": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "This work is licensed under the GNU General Public License, version 2": "gpl-2",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3",
    "SPDX-License-Identifier: MIT": "mit", MIT: "mit", BSD: "bsd", "All rights\nreserved": "all-rights-reserved",
    "rights of all are reserved": "",
}


def test_known_notices_wherever_they_stand(spark):
    texts = {before + notice + after: label for notice, label in KNOWN.items()
             for before in ("", "word " * 15, "line\n" * 63, "word " * 1_001) for after in ("", " and more" * 40)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert got == {i: label for i, label in enumerate(texts.values())}


def test_long_lines_of_common_words_carry_nothing(spark):
    draw = random.Random(5)
    words = sorted({w for _, t, _ in licenses.TEMPLATES for w in licenses.words_of(t)})
    docs = spark.createDataFrame([(i, " ".join(draw.choices(words, k=3_000))) for i in range(20)], "doc_id long, text string")
    assert {(r["labels"], r["score"]) for r in licenses.scan(docs).collect()} == {("", 0.0)}


def test_blocks_without_a_phrase_are_counted_and_joined(spark, monkeypatch):
    """The telling phrase is looked for in pairs that pass the join; it chooses no blocks beforehand."""
    written = {}
    monkeypatch.setattr(licenses, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    texts = ["rights of all are reserved", "nothing of the kind " * 20, "zzz", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["labels"] for r in licenses.scan(docs).collect()} == {""}
    blocks = written["license-words"].selectExpr("doc_id", "inline(__blocks)").where("size = 16").collect()
    assert [(b["block"], sorted(b["words"]), b["marks"]) for b in blocks if b["doc_id"] == 0] == [(0, ["all", "reserved", "rights"], [])]
    assert sorted(b["block"] for b in blocks if b["doc_id"] == 1) == [0, 1, 2, 3] and {b["doc_id"] for b in blocks} == {0, 1}
