import re

from corpus import frame

from surveyloom.llm.licenses import BASE, license_places, license_scan

_LOWER = {c: c + 32 for c in range(65, 91)}

TEXTS = [
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0. And CC BY-NC 4.0, cc/by/nc",
    "under the mit; license under the MIT licence under the mit license under the mit license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted, free of charge, to any kind person obtaining a copy of this software and"
    " associated documentation files",
    "Permission is hereby granted and nothing else of this software",
    "", None, "...", "cc by n c", "ÀCC by nc", "cc by nc",
]


def base_places(text):
    own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_LOWER))
    found = []
    for phrase, label in BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i : i + len(p)] == p]
    return own, sorted(found)


def check(got, text):
    own, found = base_places(text)
    assert (got.n_words, got.n_base) == (len(own), len(found))
    assert got.base_labels == ",".join(sorted({n for _, n in found}))
    assert (got.first_word, got.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
    assert set(filter(None, got.base_labels.split(","))) <= set(got.labels.split(","))
    assert 0 <= got.score <= 1 and (got.score > 0) == (got.labels != "")


def test_base_and_more(spark):
    df = frame(spark, [(i, t, "en", "s", 1, 1, "x", 1) for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in license_scan(df).collect()}
    for i, t in enumerate(TEXTS):
        check(got[i], t)
    assert got[3].labels == "gpl-3" and got[3].base_labels == ""
    # one word put in moves the rest to the next diagonal; most grams still vote
    assert got[4].labels == "mit" and 0.75 <= got[4].score < 1
    assert got[5].labels == ""
    long = [r for r in license_places(df).collect() if r.doc_id == 4]
    assert [(r.first_word, r.last_word) for r in long] == [(0, 20)]


def test_spans_are_verified(spark):
    texts = [
        "creative commons attribution commons attribution sharealike",
        "creative commons attribution sharealike",
        # all grams of a long wording, but in another order
        "any person obtaining a copy of this software and associated documentation files permission is hereby granted free of charge to any person",
        # and with a long insertion
        "permission is hereby granted free of charge to any " + "person obtaining x " * 9 + "person obtaining a copy of this software and associated documentation files",
        "gnu general public license version 2",
    ]
    got = license_scan(frame(spark, [(i, t, "en", "s", 1, 1, "x", 1) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.labels for r in got} == {0: "", 1: "cc-by-sa", 2: "", 3: "", 4: "gpl-2"}


def test_a_very_long_text(spark):
    text = "word " * 400_000 + "under the MIT license " + "cc by nc " * 3000
    got = license_scan(frame(spark, [(1, text, "en", "s", 1, 1, "x", 1)])).collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.labels) for r in got] == [
        (409_004, 3001, 400_000, 409_001, "cc-by-nc,mit")
    ]


def test_on_prose(docs, rows):
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    for r in rows:
        check(got[r[0]], r[1])


def test_odd_rows(spark, odd, empty):
    assert len(license_scan(odd).collect()) == 7
    assert license_scan(empty).collect() == []
    twice = frame(spark, [(None, "cc by nc", "en", "s", 1, 1, "x", 1)] * 2)
    assert [(r.doc_id, r.n_base, r.labels) for r in license_scan(twice).collect()] == [(None, 1, "cc-by-nc")] * 2


def test_plan_has_no_python(docs):
    plan = license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "BroadcastHashJoin" in plan
