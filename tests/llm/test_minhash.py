import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from ledger.llm import minhash


FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", (text or "").translate(FOLD)) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def check(got, rows):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_equals_brute_force_with_a_large_group_of_near_copies(make):
    """One text with up to ten edits each (links run in chains), its exact copies, and others."""
    rng = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 10)))) for i in range(1, 140)]
    rows += [(i, " ".join(base)) for i in range(200, 230)]
    rows += [(i, " ".join(f"x{rng.randrange(60)}" for _ in range(rng.randint(1, 60)))) for i in range(300, 340)]
    shared = [f"s{k}" for k in range(60)]
    rows += [(i, " ".join([f"u{i}x{k}" for k in range(30)] + shared)) for i in range(400, 460)]
    check(minhash.near_duplicates(make(rows)).collect(), rows)


def test_all_pairs_of_small_buckets_and_prefixes_agree(make, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 6)))) for i in range(1, 60)]
    check(minhash.near_duplicates(make(rows)).collect(), rows)


def test_odd_rows(odd, empty, odd_rows):
    got, n = minhash.near_duplicates(odd).collect(), len(shingle_set(odd_rows[0][1]))
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got if r.doc_id in (1, 2, 3, 4, 5, 6)) == [
        (1, n, 1), (1, n, 1), (2, n, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6)]
    assert all(r.component_id is None for r in got if r.doc_id is None) and len(got) == 13
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 10]


def test_estimate_is_corrected_for_chance(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    rows = []
    for share in (0.0, 0.5, 0.85, 1.0):
        for _ in range(40):
            a = rng.integers(0, 1 << 63, 400, np.uint64)
            b = a.copy()
            keep = int(round(2 * 400 * share / (1 + share)))
            b[keep:] = rng.integers(0, 1 << 63, 400 - keep, np.uint64)
            rows.append((share, *(minhash.signature(minhash.minima(np.unique(x))).view(np.int64).tolist() for x in (a, b))))
    got = spark.createDataFrame(rows, "share double, a array<long>, b array<long>").groupBy("share").agg(
        F.avg(minhash.estimate(F.col("a"), F.col("b"))).alias("e")).collect()
    assert all(abs(r.e - r.share) < 0.03 for r in got)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(3, 2), (1, 3)]
    got = {r.id: r.comp for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 560)} == {500} and got[2] == got[3] == got[1] == 1


def test_sets_of_hashes_have_the_sizes_of_sets_of_words():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("aA bB\tc") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "é" * 300_0]
    for text, own in zip(texts, minhash.shingle_sets(pa.array(texts))):
        assert len(own) == len(shingle_set(text))


def test_pairs_that_just_reach_the_similarity_share_a_band():
    """Sets of 37 with 34 in common (0.85) and of 36 with 32 in common (0.80)."""
    rng = np.random.default_rng(3)
    for least, shared, own in ((85, 34, 3), (80, 32, 4)):
        for _ in range(12_000):
            x = rng.integers(0, 1 << 63, shared + 2 * own, np.uint64)
            a, b = (minhash.minima(s, least) for s in (x[own:], x[:-own]))
            assert (minhash.band_keys(a, least) == minhash.band_keys(b, least)).any()


def repeated_ids(rng):
    """Ids that stand for several texts: unrelated ones, near copies, equal rows."""
    text = lambda t: " ".join(f"{t}w{k}" for k in range(60))
    near = lambda t, j: " ".join(f"x{j}" if k == 30 else f"{t}w{k}" for k in range(60))
    rows = [(1, text("a")), (1, text("b")), (1, text("a")), (2, near("b", 1)), (3, text("c")), (3, near("c", 2)), (4, near("c", 3)), (5, text("d")), (5, ""),
            (5, ""), (5, None), (6, near("a", 4)), (6, text("e")), (7, text("e") + " ")]
    rng.shuffle(rows)
    return rows


def test_no_text_is_lost_where_an_id_repeats(make):
    rng = random.Random(5)
    for parts in (1, 7):
        rows = repeated_ids(rng)
        docs = make(rows).repartition(parts)
        got = {}
        for r in minhash.near_duplicates(docs, least=80).collect():
            got.setdefault(r.doc_id, set()).add(r.component_id)
        assert got == {1: {1}, 2: {1}, 3: {3}, 4: {3}, 5: {5}, 6: {1, 6}, 7: {6}}
        kept = sorted((r.doc_id, (r.text or "")[:2]) for r in minhash.without_copies(docs).collect())
        assert [(i, t) for i, t in kept if i not in (3, 6)] == [(1, "aw"), (1, "bw"), (5, ""), (5, ""), (5, "dw")]
        assert [i for i, _ in kept if i == 3] == [3] and [t for i, t in kept if i == 6] == ["ew"]


def test_the_pipeline_drops_copies_from_0_80_on(spark, make):
    """Two of 100 words changed leave 86 of 106 shingles (0.81); three leave 81 of 111 (0.73)."""
    import corpus_pipeline

    rows = []
    for i in range(300):
        words = [f"d{i}w{k}" for k in range(100)]
        rows.append((3 * i, " ".join(words)))
        for j, places in enumerate(((30, 60), (20, 50, 80)), 1):
            rows.append((3 * i + j, " ".join(f"new{i}x{j}" if k in places else w for k, w in enumerate(words))))
    got = corpus_pipeline.distinct_texts(spark, make(rows), "")
    assert sorted(r.doc_id for r in got.collect()) == [i for i in range(900) if i % 3 != 1]


def shuffled_rows(df):
    """Rows that the exchanges of a collected DataFrame wrote."""
    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        children = plan.children()
        return own + sum(walk(children.apply(k)) for k in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_texts_that_stay_are_not_shuffled(spark, make):
    """2000 texts, 50 of them with a copy and 20 rows twice, where no table is small enough to be broadcast."""
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(12))) for i in range(2000)]
    rows += [(5000 + i, t) for i, t in rows[:50]] + rows[100:120]
    with_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = minhash.without_copies(make(rows))
        assert sorted(r.doc_id for r in got.collect()) == list(range(2000))
        assert 70 <= shuffled_rows(got) < 1000  # the copies and repeats at least
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)


def test_more_ids_than_may_be_broadcast_give_the_same(make, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0)
    rng = random.Random(13)
    base = [f"b{k}" for k in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 6)))) for i in range(1, 60)]
    rows += [(i, " ".join(f"x{i}w{k}" for k in range(30))) for i in range(100, 200)]
    check(minhash.near_duplicates(make(rows)).collect(), rows)
