import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledger.llm import bits, phrases, queries
from ledger.llm.automata import Automaton, in_order

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least=30, top=2000):
    """``(lang, rank, phrase, a, l, r, n, score)`` from dictionaries of all phrases."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand, out = [k for k, c in f.items() if len(k) > 2 and c >= least], []
    gone = {(c[0], *c[i:j]) for c in cand for i in range(1, len(c)) for j in range(i + 2, len(c) + 1) if j - i < len(c) - 1
            and 100 * f[c] >= 80 * f[(c[0], *c[i:j])]}
    for c in cand:
        if c not in gone:
            cuts = [(f[c[:k]], f[(c[0], *c[k:])]) for k in range(2, len(c))]
            score, left, right = min(((2_000_000 * f[c] // (x + y), k, x, y) for k, (x, y) in enumerate(cuts)))[0:1] + min(
                ((2_000_000 * f[c] // (x + y), k, x, y) for k, (x, y) in enumerate(cuts)))[2:]
            out.append((c[0], -score, -f[c], " ".join(c[1:]), left, right))
    got, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out, key=lambda x: (x[0], x[1], x[2], x[3].encode())):
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase, -a, left, right, n[lang], -score))
    return got


def items(rng, n, letters="abcd", most=5):
    return sorted({tuple(rng.choice(letters) for _ in range(rng.randint(1, 5))): rng.randint(1, most) for _ in range(n)}.items())


def built(own):
    """The automaton of sorted ``(labels, count)`` items."""
    labels = sorted({x for key, _ in own for x in key})
    depth = max((len(key) for key, _ in own), default=1)
    rows = np.array([[*(labels.index(x) for x in key), *[-1] * (depth - len(key))] for key, _ in own], np.int32).reshape(-1, depth)
    return Automaton.of_sorted(labels, rows, np.array([c for _, c in own], np.int64))


def test_automata_keep_and_add_counts():
    rng = random.Random(1)
    for _ in range(40):
        own = [items(rng, rng.choice([0, 1, 5, 200])) for _ in range(rng.randint(1, 5))]
        parts = [Automaton.loads(built(x).dumps()) for x in own]
        assert [list(p.items()) for p in parts] == own
        total = Counter()
        for x in own:
            total.update(dict(x))
        whole = Automaton.union(parts)
        assert list(whole.items()) == sorted(total.items())
        assert list(Automaton.union(parts, 4).items()) == sorted((k, c) for k, c in total.items() if c >= 4 or len(k) == 1)
        asked = built(items(rng, 60, "abcdé"))
        assert list(whole.compose(asked).items()) == [(k, total[k]) for k, _ in asked.items() if k in total]
    assert list(Automaton.union([]).items()) == []


def test_many_labels_are_ordered_too():
    rng = np.random.default_rng(4)
    rows = rng.integers(-1, 1 << 22, (3000, 3)).astype(np.int32)
    assert rows[in_order(rows)].tolist() == sorted(rows.tolist())


def test_equal_states_are_shared():
    a = built(sorted(((x, y, z), 7) for x in "abcdefgh" for y in "mn" for z in "pqr"))
    assert len(a.first) - 1 == 4  # the end, one state for each length


def test_words_and_blocks(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB é\t.\n\x0b\x1f,漢") for _ in range(rng.randint(0, 80))) for _ in range(200)] + [None, "", "x" * 500, ". . ", "a b" * 200]
    for block in (1 << 22, 64, 1):
        monkeypatch.setattr(phrases, "BLOCK", block)
        got = {}
        for b, (w, first) in enumerate(phrases.blocks(pa.array(texts))):
            for k in range(len(w.starts)):
                got.setdefault(first + int(w.texts[k]), []).append(((b, int(w.pieces[k])), bytes(w.data[w.starts[k]:w.ends[k]]).decode(), int(w.hashes[k])))
        hashes = {}
        for k, t in enumerate(texts):
            want = [p for p in pieces(t) if p]
            own, last = [], None
            for piece, word, h in got.get(k, []):
                assert hashes.setdefault(word, h) == h
                own += [[word]] if piece != last else []
                if piece == last:
                    own[-1].append(word)
                last = piece
            assert own == want
        assert len(set(hashes.values())) == len(hashes)


def test_a_bit_table_misses_nothing(spark):
    h = np.random.default_rng(1).integers(-1 << 63, 1 << 63, 70_000)
    df = spark.createDataFrame([(int(x),) for x in h[:60_000]], "h long")
    table, size = bits.bit_table(df, "h", 60_000)
    got = bits.held(table, size, h.view(np.uint64))
    assert got[:60_000].all() and got[60_000:].mean() < 0.15
    table, size = bits.bit_table(df.limit(0), "h", 0)
    assert not bits.held(table, size, h.view(np.uint64)).any()


def corpus(rng):
    words = [f"w{k}" for k in range(12)] + ["The", "of", "é", "漢字"]
    weights = [1] * 12 + [60, 20, 5, 5]
    fixed = ["New York city hall", "of the One Two", "a rare pair", "tie one", "tie two"]
    rows = []
    for k in range(400):
        body = "".join((rng.choice(fixed) if rng.random() < 0.3 else rng.choices(words, weights)[0]) + rng.choice([" ", " ", "\t ", ". ", "\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((body, rng.choice(["en", "en", "en", "de", None, "x\ny"])))
    return rows + [(None, "en"), ("", None), ("The " * 500, "en"), (" . ! \n", "fr"), (rows[0][0], rows[0][1])]


def listed(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("parts", [(1_500_000, 200_000, 8, 1), (300, 20, 2, 6)])
def test_equals_brute_force(spark, monkeypatch, parts):
    """With one shard and one range, and with many shards, ranges and words of ranges of their own."""
    for name, value in zip(("SHARD", "RANGE", "TOGETHER"), parts):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus(random.Random(3))
    docs = spark.createDataFrame([(t, lang, 1, "r", "k") for t, lang in rows], "text string, lang string, range int, blob string, phrase string").repartition(parts[3])
    want = brute(rows)
    assert len(want) > 50 and listed(phrases.collocations(docs)) == want
    assert listed(phrases.collocations(docs, least=5, top=7)) == brute(rows, 5, 7)


def test_words_with_ranges_of_their_own_are_found(spark):
    frequent = spark.createDataFrame([(1, 900), (2, 50), (3, 50)], "h long, c long")
    ranges = phrases.plan_ranges(frequent, 10, 4)
    assert ranges == phrases.Ranges(4, {1: (4, 4)})


def test_query_and_empty_table(spark, empty, tmp_path):
    import duckdb

    assert phrases.collocations(empty).collect() == []
    rows = corpus(random.Random(4))
    spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = listed(queries.op11_phrase_mining(spark, str(tmp_path)))
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE["op11_phrase_mining"]).df()
    assert sorted(sql[["lang", "rank", "phrase", "a", "l", "r", "n", "score"]].itertuples(index=False, name=None)) == got
