import random
import re

import pytest

from ledger.llm import decontaminate


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def tiling(test, text, least):
    """Greedy string tiling as defined: the longest unmarked match first, then the next."""
    a, b, covered, tiles = [True] * len(test), [True] * len(text), 0, 0
    while True:
        best = (0, 0, 0)
        for i in range(len(test)):
            for j in range(len(text)):
                n = 0
                while i + n < len(test) and j + n < len(text) and a[i + n] and b[j + n] and test[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least or not n:
            return tiles, covered
        a[i:i + n], b[j:j + n] = [False] * n, [False] * n
        covered, tiles = covered + n, tiles + 1


def brute(docs, items):
    out = {}
    for i, t in {i: t for i, t in docs if i is not None}.items():
        for k, q in items:
            test = words(q)
            if test:
                tiles, covered = tiling(test, words(t), min(5, len(test)))
                if covered >= decontaminate.COVERAGE * len(test):
                    out[i, k] = (tiles, covered, len(test))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randint(12, 40)))) for k in range(12)]
    items += [(50, "Too short"), (51, None), (52, ""), (53, "!!"), (54, "one two three four five")]
    docs = []
    noise = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(n)]
    for i in range(60):
        w = words(items[rng.randrange(12)][1])
        kind = rng.randrange(5)
        cut = rng.randrange(1, len(w))
        body = {0: w, 1: w[cut:] + noise(3) + w[:cut], 2: w[:cut], 3: noise(len(w)), 4: w[cut:] + w[:cut] + w}[kind]
        docs.append((i, " ".join(noise(rng.randrange(20)) + body + noise(rng.randrange(20))).upper().replace(" ", ", ")))
    docs += [(70, "this is too short"), (71, "One-two three FOUR five!")]
    return docs, items


def test_equals_brute_force_with_reordered_passages(spark, make, case):
    docs, items = case
    got = decontaminate.contamination(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.n_tiles, r.covered, r.item_words) for r in got} == brute(docs, items)


def test_a_line_of_many_items_and_documents_makes_no_pairs(spark, make):
    line = [f"instruction{k}" for k in range(8)]
    own = [[f"w{i}x{k}" for k in range(20)] for i in range(30)]
    items = [(i, " ".join(line + own[i])) for i in range(30)] + [(90, " ".join(line + own[0][:3])), (91, " ".join(line + line))]
    docs = [(i, " ".join(line + [f"d{i}n{k}" for k in range(9)])) for i in range(100)]
    docs += [(200 + i, " ".join(own[i][9:] + ["x"] + own[i][:9])) for i in range(0, 30, 3)]
    docs += [(300 + i, " ".join(line + ["x"] + own[i][:6])) for i in range(0, 30, 3)] + [(400, " ".join(line + ["x"] + own[7][:10]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(make(docs), table).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.n_tiles, r.covered, r.item_words) for r in got} == want
    assert {(200, 0), (400, 7), (0, 90)} <= set(want) and not {(300, 0), (0, 91)} & set(want)
    # The line's seeds decide for the two items that mostly consist of it and for no other.
    seeds = decontaminate.item_seeds(table, "item_id", "text")
    held = {}
    for i, t in docs:
        for s in {tuple(words(t)[k:k + 5]) for k in range(len(words(t)) - 4)}:
            held[s] = held.get(s, 0) + 1
    places = {(r["item"]["id"], r["place"]): r["seed"] for r in seeds.collect()}
    counts = {places[i, k]: held[tuple(words(t)[k:k + 5])] for i, t in items for k in range(len(words(t)) - 4) if tuple(words(t)[k:k + 5]) in held}
    decide = decontaminate.deciding_seeds(seeds, spark.createDataFrame(list(counts.items()), "seed long, c long")).collect()
    common = {places[0, k] for k in range(4)}
    assert {r["item"]["id"] for r in decide if r["seed"] in common} == {90, 91}
    assert {r["item"]["id"] for r in decide} >= {0, 3, 7}


def test_odd_rows_and_empty_tables(spark, odd, empty, odd_rows):
    items = spark.createDataFrame([(1, odd_rows[0][1], "x"), (None, "a b c d e f", "y"), (2, None, "z")], "item_id long, text string, doc string")
    got = decontaminate.contamination(odd, items).collect()
    assert {r.doc_id for r in got} == {1, 2, 8}
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).count() == 0


def test_all_planted_passages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    planted = {(d.doc_id, b.item_id) for d in docs.collect() for b in items.collect() if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, items).collect()}
    assert planted and planted <= got


def test_equals_brute_force_with_overlapping_passages(spark, make):
    """Passages of one item that overlap in it: what a longer tile leaves of a match counts."""
    rng = random.Random(12)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(20 + k))) for k in range(6)]
    docs = [(0, " ".join([*(f"i0x{j}" for j in range(8, 17)), *(f"other{j}" for j in range(15)), *(f"i0x{j}" for j in range(2, 10))]))]
    for i in range(1, 60):
        w, body = items[rng.randrange(6)][1].split(), []
        for p in range(rng.randint(2, 4)):
            a = rng.randrange(len(w) - 6)
            body += [*w[a:a + rng.randint(6, 14)], f"n{i}x{p}"]
        docs.append((i, " ".join(body)))
    got = decontaminate.contamination(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.n_tiles, r.covered, r.item_words) for r in got} == brute(docs, items)
    assert (0, 0) in {(r.doc_id, r.item_id) for r in got}


def test_the_pipeline_keeps_documents_that_hold_short_items_only(spark, make, tmp_path):
    import corpus_pipeline

    items = [(1, "Paris"), (2, "yes of course"), (3, "one two three four five")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make([(1, "We went to Paris in May"), (2, "yes, of course"), (3, "count one two three four five in Paris"), (4, "nothing")])
    assert sorted(r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()) == [1, 2, 4]


def test_texts_that_repeat_an_id_are_judged_each_by_itself(spark, make, tmp_path):
    import corpus_pipeline

    item = " ".join(f"q{k}" for k in range(12))
    items = spark.createDataFrame([(1, item), (1, " ".join(f"z{k}" for k in range(9)))], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for parts in (1, 6):
        docs = make([(1, "clean words only here"), (1, f"before {item} after"), (2, " ".join(f"z{k}" for k in range(9))), (1, "clean words only here")]).repartition(parts)
        got = decontaminate.contamination(docs, items).collect()
        assert sorted((r.doc_id, r.item_id, r.item_words) for r in got) == [(1, 1, 12), (2, 1, 9)]
        assert [(r.doc_id, r.text) for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()] == [(1, "clean words only here")] * 2
