import random
import re
import time

from pyspark.sql import functions as F

from ledger.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(q) <= 255 for q in m[0].split(".")),
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def base(row):
    return [(pii.KINDS[x.k], x.s, x.e) for x in row.spans if x.base]


def test_base_spans_equal_the_plain_patterns(make):
    rng = random.Random(4)
    texts = ["a@b.c@d.e x@y.z.w+q@r.s", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111--1111",
             "+1 (415) 555-2671+44 20 7946 0958", "\U0001f600 a@b.co é 4111111111111111\U0001f600", "a" * 30_000 + "@", "1" * 30_000, "1 " * 9000, "+" * 5000]
    texts += ["".join(rng.choice("0123456789.@+- ()abz,é\U0001f600") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(rng.randint(10, 80))) for _ in range(500)]
    got = {r.doc_id: r for r in pii.find_pii(make([(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert base(got[i]) == brute(t), t[:80]


def test_odd_rows(odd, empty):
    got = pii.find_pii(odd).collect()
    assert len(got) == 13 and [base(r) for r in got if r.doc_id == 9] == [[("email", 2, 8)]]
    assert pii.find_pii(empty).count() == 0
    clean = pii.redact(odd)
    assert clean.columns == odd.columns and clean.schema["text"].dataType.simpleString() == "string"
    assert [r.text for r in clean.where("doc_id = 9").collect()] == ["\U0001f600 <EMAIL> \U0001f600"]
    assert clean.where("text is null").count() == 2


def test_redacted_text_holds_no_base_span(make):
    texts = ["mail a@b.co, +1 415 555 2671 and 4111111111111111 at 10.1.2.3", "10.1.2.3@x.org", None, "", "plain"]
    got = {r.doc_id: r.text for r in pii.redact(make([(i, t) for i, t in enumerate(texts)])).collect()}
    assert got[0] == "mail <EMAIL>, <PHONE> and <CARD> at <IP>"
    assert got[2] is None and got[3] == "" and got[4] == "plain"
    assert all(not brute(t) for t in got.values())


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = random.Random(3)
    right = [0.95, 0.9, 0.6, 0.8]
    counts = {}
    for _ in range(4000):
        y = rng.random() < 0.4
        votes = tuple((1 if y else -1) if rng.random() < r else (-1 if y else 1) for r in right)
        key = (0, votes)
        counts.setdefault(key, [0, 0])[y] += 1
    patterns = [(k, v, sum(n)) for (k, v), n in counts.items()]
    belief = pii.expectation_maximisation(patterns)
    wrong = sum(n[belief[p] < 0.5] for p, n in counts.items())
    assert wrong < 0.08 * 4000


def test_classifier_adds_likely_spans_only(make):
    rows = [(i, f"mail me at user{i}@mail.com or call +1 415 555 {1000 + i} now") for i in range(60)]
    rows += [(100 + i, f"version 300.1.2.{i} build") for i in range(30)]
    rows += [(200, "phone (415) 555-1234 please")]
    got = {r.doc_id: r.spans for r in pii.find_pii(make(rows)).collect()}
    assert all(not got[100 + i] for i in range(30))
    assert all(x.base for i in range(60) for x in got[i])


def test_classifier_learns_the_shape_and_can_overrule_the_votes(make):
    """Numbers that are built like the known phones count, others with the same votes do not."""
    rows = [(i, f"call +1 415 555 {1000 + i} now") for i in range(200)] + [(1000 + i, f"release 4.{i}.3.9 of 300.1.{i}.999 build") for i in range(200)]
    found = make(rows).select("doc_id", pii.candidates(F.col("text")).alias("found"))
    model = pii.learn(found)
    x = found.select(F.explode("found").alias("x")).select("x.k", "x.size", model.shape_odds(lambda n: F.col(f"x.{n}")).alias("z")).collect()
    assert min(r.z for r in x if r.k == pii.KINDS.index("phone")) > max(r.z for r in x if r.k == pii.KINDS.index("ip") and r.size > 2)


def test_zero_parts_of_an_address(make):
    parts = ["0", "00", "000", "255", "256", "0255", "0256", "1" * 400, "0" * 400, "0" * 400 + "7", "9", "099"]
    texts = ["host 127.0.0.1 up", "v 0.1.2.3", "1.2.3.00", "0.0.0.0", *(f"a {p}.1.2.3 b" for p in parts), *(f"a 1.2.3.{p} b" for p in parts)]
    rows = make([(i, t) for i, t in enumerate(texts)])
    for r in pii.find_pii(rows).collect():
        assert base(r) == brute(texts[r.doc_id]), texts[r.doc_id][:40]
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert [clean[i] for i in range(4)] == ["host <IP> up", "v <IP>", "<IP>", "<IP>"]


def cleaned(text, spans):
    """The text with spans ``(s, kind order, e)`` replaced, the first of overlapping ones."""
    out, at = "", 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += text[at:s] + f"<{pii.KINDS[k].upper()}>"
        at = max(at, e)
    return out + text[at:]


def test_many_matches_in_one_text_take_linear_time(make):
    """50,000 addresses in one text, more than one chunk and one block, and texts at their edges."""
    rng = random.Random(9)
    word = lambda: rng.choice(["10.0.0.1", "a@b.co", "+1 415 555 2671", "(415) 555-1234", "x", "\U0001f600 né", "4111111111111111", "me [at] b.org"])
    texts = [" ".join(f"10.{i % 256}.{i // 256}.7" for i in range(50_000)), " ".join(word() for _ in range(6_000))]
    texts += [" ".join(word() for _ in range(n)) for n in (1, 63, 64, 65, 128, 129, 700)] + ["x" * n + " a@b.co " + "y" * 9000 for n in (4085, 4090, 4095, 8188)]
    began = time.time()
    rows = make([(i, t) for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in pii.find_pii(rows).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert time.time() - began < 90
    for i, t in enumerate(texts):
        assert base(found[i]) == brute(t)
        assert clean[i] == cleaned(t, [(x.s, x.k, x.e) for x in found[i].spans])


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "0", "18", "79927398713"]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select(pii.luhn(F.col("n")).alias("ok")).collect()
    assert [r.ok for r in got] == [luhn(n) for n in numbers]
