import random
import re

import regex

from ledger.llm import licenses


def test_words_follow_the_pattern():
    rng = random.Random(1)
    letters = "aZ09 _{~}\x7f\x80é@/:.漢\n"
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(30))
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert [w.decode() for w in licenses.words_of(text)] == re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def test_seeds_lose_nothing_against_searching_everywhere():
    """The pigeonhole windows find the same notices as the fuzzy pattern over the whole text."""
    finder, rng = licenses.NoticeFinder(licenses.NOTICES), random.Random(5)
    for _ in range(60):
        notice = rng.choice(list(licenses.NOTICES))
        y = list(notice)
        for _ in range(rng.randint(0, 6)):
            p = rng.randrange(len(y))
            y[p:p + rng.randint(0, 1)] = rng.choice(["", "a", "q", " "])
        text = b" ".join(licenses.words_of("the of " * rng.randint(0, 9) + "".join(y) + " and" * 5 + rng.choice(["", " " + notice]))).decode()
        got = {(x, n) for x, _, _, n, _ in finder.find(text)}
        want = {(label, sum(m.fuzzy_counts)) for label, _, _, r in finder.notices for m in r.finditer(text)}
        assert {g[0] for g in got} == {w[0] for w in want}
        for label, a, b, n, like in finder.find(text):
            target = [t for t, x in licenses.NOTICES.items() if x == label]
            assert any(regex.fullmatch(f"(?:{regex.escape(t)}){{e<={n}}}", text[a:b]) for t in target) and 0 <= like <= 1


def test_base_places():
    words = licenses.words_of("MIT license mit-license MIT  License x apache License; General public\nlicense")
    assert sorted(licenses.phrase_places(words, licenses.PHRASES)) == [("apache", 7), ("gpl", 9), ("mit", 0), ("mit", 2), ("mit", 4)]


def test_table(make, odd, empty, odd_rows):
    got = licenses.scan_licenses(odd).collect()
    assert len(got) == len(odd_rows) and all(not r.phrases and not r.spans for r in got)
    assert [r.n_words for r in got if r.doc_id in (3, 4, 5)] == [0, 0, 0]
    rows = make([(1, "x\nLicensd under the Apache License, Version 2.0."), (2, "Released under the MIT Licence.")])
    found = {r.doc_id: r for r in licenses.scan_licenses(rows).collect()}
    assert [(p.label, p.word) for p in found[1].phrases] == [("apache", 4)]
    assert found[1].spans[0].label == "apache" and found[1].spans[0].edits == 1 and found[1].spans[0].first_word == 1
    assert not found[2].phrases and found[2].spans[0].label == "mit"
    assert licenses.scan_licenses(empty).count() == 0
