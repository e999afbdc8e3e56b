import random
import re
from collections import Counter

import pytest

from ledger.llm import rules, sharding


def brute(text):
    text = text or ""
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", text) if x]
    runs = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen, n = Counter(runs), set()
    for i, r in enumerate(runs):
        if seen[r] > 1:
            n |= {i, i + 1, i + 2}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^ \t\n\x0b\f\r]", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(n)


def test_statistics_equal_brute_force(make, odd, odd_rows):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab #|\n\t\x0b\U0001f600é ") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    got = {r.doc_id: r for r in rules.text_stats(make([(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == brute(t)
    for r, row in zip(rules.text_stats(odd).collect(), odd_rows):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(row[1])


def labelled(make, spark, n=300):
    """Good prose and two kinds of junk: symbols, and few distinct words."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        w = [word() for _ in range(70)]
        if not good:
            w = [x + "###" for x in w] if i % 2 else [rng.choice(w[:8]) for _ in range(70)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, n_words int"), {i: y for i, y, _ in labels}


def test_learned_list_separates_and_is_an_ordered_case(make, spark):
    docs, labels, truth = labelled(make, spark)
    got, learned = rules.judged(docs, labels)
    assert 1 <= len(learned) <= rules.MAX_RULES and all(1 <= len(r) <= rules.MAX_CONDITIONS for r in learned)
    wrong = [r.doc_id for r in got.collect() if (r.rule is None) != bool(truth[r.doc_id])]
    assert len(wrong) <= 0.05 * len(truth)
    assert "CASE WHEN" in rules.fired(learned)._jc.toString()


@pytest.mark.parametrize("kind", ["none", "one class", "nulls"])
def test_labels_that_teach_nothing_keep_everything(make, spark, odd, kind):
    labels = {"none": [], "one class": [(1, 1), (2, 1)], "nulls": [(1, None), (None, 0)]}[kind]
    got, learned = rules.judged(odd, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = got.collect()
    assert not learned and len(rows) == 13
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_rules_of_an_empty_table(empty, spark):
    got, learned = rules.judged(empty, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert got.count() == 0 and not learned


def spread(got, shards):
    size, slots = Counter({s: 0 for s in range(shards)}), {}
    for r in got:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return size


def test_shards_are_even_where_a_third_of_the_rows_are_copies(make):
    import zlib

    rng = random.Random(1)
    rows = [(i, "same text for all " * 4) for i in range(400)] + [(1000 + i, "t" * rng.randint(0, 200) + str(i)) for i in range(800)]
    got = sharding.even_shards(make(rows), 7).collect()
    texts = dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    size = spread(got, 7)
    mean = sum(size.values()) / 7
    # A splitter lies within one row of its place.
    assert max(abs(v - mean) for v in size.values()) <= 220


def test_copies_lie_side_by_side(make):
    got = sharding.even_shards(make([(i, f"text {i % 40}") for i in range(400)]), 4).collect()
    shards = {}
    for r in got:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 3


def test_shards_of_odd_rows(odd, empty, make):
    got = sharding.even_shards(odd, 24).collect()
    assert len(got) == 13 and sorted(r.size for r in got)[:4] == [8, 8, 8, 12]
    spread(got, 24)
    assert sharding.even_shards(empty, 24).count() == 0
    spread(sharding.even_shards(make([(1, "x")] * 50), 3).collect(), 3)
