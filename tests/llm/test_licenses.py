import random

from corpusflow.llm import licenses as L
from corpusflow.llm.decontaminate import words_of
from tests.llm.data import ODD, documents, words


def cases():
    rng = random.Random(6)
    names, rows = list(L.TEMPLATES), []
    for i in range(150):
        w = words(rng, rng.randint(0, 200))
        if i % 2:
            t = L.TEMPLATES[rng.choice(names)].split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                t[rng.randrange(len(t))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = t
        rows.append((i, " ".join(w)))
    return rows


def test_against_all_windows(spark):
    """Retrieval by bands finds what exact containment over every window finds."""
    rows = cases() + ODD
    lib, hashes = L.Library(L.TEMPLATES), L._Hashes()
    text, got = dict(rows), L.scan(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    n = 0
    for r in got:
        w = words_of((text[r.doc_id] or "").encode())
        count, found = lib.scan(L.shingles(w, hashes), retrieve=False)
        assert (r.n_words, r.n_windows) == (len(w), count)
        assert {m.license: (m.shared, m.of) for m in r.matches} == {k: v[:2] for k, v in found.items()}, r.doc_id
        n += len(found)
    assert n > 40


def test_every_template_is_found_wherever_it_stands(spark):
    rng = random.Random(2)
    rows = [(i * 100 + k, " ".join([*words(rng, k), t.upper(), *words(rng, 30)])) for i, t in enumerate(L.TEMPLATES.values()) for k in range(0, 40, 7)]
    names = list(L.TEMPLATES)
    for r in L.scan(documents(spark, rows)).collect():
        m = {x.license: x for x in r.matches}[names[r.doc_id // 100]]
        assert m.shared == m.of and m.start == r.doc_id % 100 and m.end == m.start + len(words_of(L.TEMPLATES[m.license].encode()))


def test_clean_texts_and_empty_table(spark):
    rows = [(1, "we talk about the license of the driver and the permission he had"), (2, " ".join(words(random.Random(1), 500)))]
    assert all(not r.matches for r in L.scan(documents(spark, rows)).collect())
    assert L.scan(documents(spark, [])).count() == 0


def matches(text):
    return L.Library(L.TEMPLATES).places(L.shingles(words_of(text.encode()), L._Hashes()))[1]


def test_like_templates_are_told_apart():
    for name, text in L.TEMPLATES.items():
        got = [m[0] for m in matches(f"one two three {text} four five six")]
        same = name.removesuffix("-text")
        assert name in got and all(g.removesuffix("-text") == same or name.endswith("-text") for g in got), (name, got)
    gpl2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")
    assert [m[0] for m in matches(gpl2)] == ["GPL-2.0"]
    assert [m[0] for m in matches(L.TEMPLATES["BSD"])] == ["BSD"]


def test_every_place_is_reported():
    rng = random.Random(4)
    for name in ("MIT-notice", "MIT", "GPL-3.0", "ISC", "MPL-2.0-text"):
        t = L.TEMPLATES[name]
        for gap in (0, 1, 7, 400):
            w = " ".join(words(rng, gap))
            got = [m for m in matches(f"{t} {w} {t} {w} {t}") if m[0] == name]
            assert len(got) == 3 and all(m[1] == m[2] for m in got), (name, gap, [m[:2] for m in got])
