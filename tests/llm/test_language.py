from collections import Counter

from pyspark.sql import functions as F

from ledger.llm import language

TEXTS = {
    "en": "the weather of this morning was nothing that they would have thought with their own eyes",
    "de": "das wetter heute morgen war nicht so wie sie es sich gedacht hatten und ich auch nicht",
    "fr": "le temps de ce matin n'était pas du tout ce que nous avions pensé et vous aussi peut-être",
}


def test_ngrams_equal_plain_python():
    for text in ["", "a", "It's él-2x", "ab  cd\n", "Ünï 漢字"]:
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        line = " " + " ".join(words) + " " if words else ""
        want = Counter(c for c in line if c != " ")
        want.update(line[i:i + 2] for i in range(len(line) - 1))
        want.update(line[i:i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
        code = lambda g: sum((1 if c == " " else ord(c)) << (21 * k) for k, c in enumerate(g))
        grams, counts = language.counted(text)
        assert dict(zip(grams.tolist(), counts.tolist())) == {code(g): n for g, n in want.items()}


def test_predicts_languages_and_gives_und(make, odd, empty):
    train = make([(i, t, x) for i, (x, t) in enumerate(TEXTS.items())] + [(9, None, "en"), (10, "zzz", None)])
    profiles = language.learn_profiles(train)
    assert sorted(profiles) == ["de", "en", "fr"]
    asked = make([(1, "they thought of this weather"), (2, "ich war heute nicht so"), (3, "vous avez pensé du temps"), (4, None), (5, "12 !!"), (6, "")])
    got = {r.doc_id: r for r in language.identify(asked, profiles).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "fr", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(odd, profiles).count() == 13 and language.identify(empty, profiles).count() == 0
    assert language.learn_profiles(empty) == {}
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}


def test_out_of_place_distance_by_hand():
    scorer = language.Scorer({"x": [ord("a"), ord("b")], "y": [ord("b"), ord("a")]}, size=2)
    # "b bb" has b three times, then "b_" and "_b" pairs: its two most frequent n-grams.
    mine = language.top(*language.counted("b bb"), 2).tolist()
    away = lambda profile: sum(abs(profile.index(g) - k) if g in profile else 2 for k, g in enumerate(mine))
    lang, score = scorer.predict("b bb")
    want = min((away([97, 98]), "x"), (away([98, 97]), "y"))
    assert (lang, score) == (want[1], 1 - want[0] / 4)


def test_held_out_split(spark):
    import zlib

    got = spark.range(300).select("id", language.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.identify(docs.where(language.held_out()), language.learn_profiles(docs.where(~language.held_out())))
    right = got.join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
