import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledger.llm import quality, secrets


def corpus(make, spark, n=400):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        host = f"h{i % 8}"
        good = rng.random() < (0.2 if i % 8 == 0 else 0.9)
        w = [word() if good else word().upper() + "!!" for _ in range(60)]
        rows.append((i, " ".join(w), "en", host))
        if i % 2:
            labels.append((i, int(good)))
        elif i % 8 == 0:
            labels.append((i, int(good)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int"), {r[0]: not r[1].isupper() for r in rows}


def test_classifier_tells_junk_from_prose_and_learns_hosts(make, spark):
    docs, labels, truth = corpus(make, spark)
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(truth)
    assert sum(r.kept != truth[r.doc_id] for r in got) <= 0.02 * len(truth)
    by_host = {r.doc_id % 8: r.host_prior for r in got}
    assert by_host[0] < min(v for h, v in by_host.items() if h)
    assert all(0 <= r.score <= 1 for r in got)


def test_sparse_sites_shrink_to_what_lies_above(make, spark):
    rows = [(i, f"text {i}", "en", "big") for i in range(200)] + [(300, "text", "en", "tiny"), (301, "text", "en", "none")]
    labels = [(i, int(i % 10 != 0)) for i in range(200)] + [(300, 0)]
    got = {r.doc_id: r for r in quality.classify(make(rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert abs(got[0].host_prior - 0.9) < 0.02
    assert got[300].host_prior < got[301].host_prior and got[300].host_prior > 0.0
    assert abs(got[301].host_prior - 0.895) < 0.02 and got[301].path_prior == got[301].host_prior


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None), (None, 0)], [(1, 0), (1, 1), (2, 1), (8, 1)]])
def test_quality_of_odd_rows(odd, empty, spark, labels):
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.classify(odd, given).collect()
    assert len(got) == 13 and all(r.score is not None and r.kept is not None for r in got)
    assert quality.classify(empty, given).count() == 0
    kept = quality.without_rejected(odd, given)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)


def test_prior_strength_follows_the_spread_of_the_groups(spark):
    groups = lambda rows: spark.createDataFrame(rows, "n long, good long")
    even = quality.prior(groups([(100, 50), (100, 51), (100, 49)]), F.lit(0.5))
    apart = quality.prior(groups([(100, 5), (100, 95), (100, 50)]), F.lit(0.5))
    assert even == quality.STRONGEST and quality.WEAKEST <= apart < 10


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def test_secrets_are_told_from_long_words_and_numbers(make):
    rng, rows, want = random.Random(6), [], set()
    for i in range(120):
        kind = i % 4
        value = [hexes(rng, 40), "word" * 6, str(10**15 + i) + "9", "verylongordinaryword" + "abc" * 3][kind]
        text = f'text before token = "{value}" after' if kind == 0 else f"text before {value} after"
        rows.append((i, text))
        if kind == 0:
            want.add((i, text.index(value), hashlib.sha256(value.encode()).hexdigest()))
    got = secrets.scan_secrets(make(rows)).collect()
    assert len(got) == 120
    assert {(r.doc_id, r.start, r.sha256) for r in got if r.is_secret} == want


def test_given_findings_train_the_forest(make, spark):
    rng = random.Random(8)
    rows = [(i, f"key: {hexes(rng, 24)} end" if i % 2 else f"hash {hexes(rng, 24)} end") for i in range(80)]
    docs = make(rows)
    findings = spark.createDataFrame([(i, 5, int(i % 2)) for i in range(60)], "id long, start long, label int")
    got = {r.doc_id: r.is_secret for r in secrets.scan_secrets(docs, findings).collect()}
    assert sum(got[i] == bool(i % 2) for i in range(60, 80)) >= 18


def test_secrets_of_odd_rows(odd, empty):
    assert secrets.scan_secrets(empty).count() == 0
    assert all(r.end > r.start for r in secrets.scan_secrets(odd).collect())


def test_the_secret_is_not_returned(make):
    value = "0123456789abcdef" * 2
    got = secrets.scan_secrets(make([(1, f'token = "{value}"')]))
    assert got.collect()[0].is_secret and value not in str(got.collect())


def test_candidates_have_no_upper_length_and_assigned_values_no_lower(make):
    rng = random.Random(14)
    long = "".join(rng.choice("abcdefXYZ0123456789+/") for _ in range(5000))
    texts = [(f"blob {long} end", long), (f"API_KEY={long}==", long + "=="), ('db_password = "hunter2"', "hunter2"), ("PWD: p@ss.w0rd!", "p@ss.w0rd!"),
             ("my_service_access_token_value=abc.", "abc"), ("config['auth'] = 'x9/z'", "x9/z"), ("?auth=token=q1&n=1", "q1"),
             ("Authorization: Bearer abc123def", "abc123def"), ("password : short", "short"), ("a" * 201, "a" * 201)]
    got = {r.doc_id: r for r in secrets.scan_secrets(make([(i, t) for i, (t, _) in enumerate(texts)])).collect()
           if not texts[r.doc_id][0][r.start:r.end].startswith("my_service")}
    for i, (text, value) in enumerate(texts):
        assert text[got[i].start:got[i].end] == value
        assert got[i].sha256 == hashlib.sha256(value.encode()).hexdigest()


def test_keys_glued_to_a_name_and_keys_in_prose_are_secrets(make):
    """The forest learns from quoted digests and plain words only."""
    rng = random.Random(15)
    rows = [(i, f'text before token = "{hexes(rng, 40)}" after' if i % 2 else "text before verylongordinaryword after") for i in range(120)]
    hub, aws, digest = "ghp_" + "aB3dE6" * 6, "AKIA" + "Q7Z4" * 4, hexes(rng, 40)
    texts = {200: (f"API_KEY={hub}", hub), 201: (f"token={digest}", digest), 202: (f"https://x.org/a?access_key={aws}&v=1", aws),
             203: (f"please use {hub} for this", hub), 204: (f"the one we had was {aws}.", aws), 205: (f"some_long_name_of_an_api_key={hub}", hub)}
    got = secrets.scan_secrets(make(rows + [(i, t) for i, (t, _) in texts.items()])).collect()
    found = {(r.doc_id, r.start, r.end, r.sha256, r.detector) for r in got if r.is_secret and r.doc_id >= 200}
    assert {(i, t.index(v), t.index(v) + len(v), hashlib.sha256(v.encode()).hexdigest(), "provider-form") for i, (t, v) in texts.items()} == found
    assert not any(r.is_secret for r in got if r.doc_id < 200 and r.doc_id % 2 == 0)


def test_dictionary_is_learned_and_held_out_findings_are_told_apart(make, spark):
    rng = random.Random(31)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(60)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, findings = [], []
    for i in range(240):
        secret = i % 3 == 0
        token = "".join(rng.choice(letters) for _ in range(24)) if secret else rng.choice(["_", "/", "-"]).join(rng.choice(vocabulary) for _ in range(5))
        before = " ".join(rng.choice(vocabulary) for _ in range(30)) + " "
        rows.append((i, before + token + " " + " ".join(rng.choice(vocabulary) for _ in range(10))))
        if len(token) >= secrets.LONG:
            findings.append((i, len(before), int(secret)))
    docs = make(rows)
    cover = secrets.with_word_cover(secrets.find_candidates(docs), docs).collect()
    assert len(cover) == len(findings)
    by_kind = [[r.word_cover for r in cover if (r.id % 3 == 0) == kind] for kind in (False, True)]
    assert min(by_kind[0]) > 0.6 and max(by_kind[1]) < 0.2
    labelled = spark.createDataFrame(findings, "id long, start long, label int")
    train, held_out = labelled.where("id % 2 = 0"), labelled.where("id % 2 = 1")
    got = secrets.precision_recall(secrets.scan_secrets(docs, train), held_out).first()
    assert got.precision >= 0.95 and got.recall >= 0.95
    assert got.hits + got.missed == sum(y for i, _, y in findings if i % 2)
    missing = spark.createDataFrame([(0, 999_999, 1)], "id long, start long, label int")
    none = secrets.precision_recall(secrets.scan_secrets(docs, train), missing).first()
    assert (none.hits, none.missed, none.precision, none.recall) == (0, 1, None, 0.0)
