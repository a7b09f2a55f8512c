import random
import zlib

import pytest

from dialtone.llm import toxicity as T
from dialtone.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(3)
    for _ in range(60):
        terms = ["".join(r.choice("abc") for _ in range(r.randint(5, 8))) for _ in range(10)]
        lexicon = T.Lexicon(dict.fromkeys(terms, 1.0), {}, terms)
        for _ in range(40):
            word = list(r.choice(terms))
            for _ in range(r.randrange(3)):
                k = r.randrange(len(word) + 1)
                word[k:k + r.randrange(2)] = r.choice(["", "a", "d"])
            word = "".join(word)
            assert (lexicon.lookup(word) is not None) == (min(distance(word, t) for t in terms) <= 1)


def test_lookups_equal_brute_force():
    """Words and stems as they are, then both within one edit; a stem is near to any beginning of the word."""
    r = random.Random(17)
    make = lambda a, b: "".join(r.choice("abc") for _ in range(r.randint(a, b)))
    for _ in range(60):
        words, stems = {make(4, 8) for _ in range(6)}, {make(4, 6) for _ in range(4)}
        lexicon = T.Lexicon(dict.fromkeys(words, 1.0), dict.fromkeys(stems, 2.0), sorted(words))
        for _ in range(60):
            word = list(r.choice([make(3, 10), r.choice(sorted(words)), r.choice(sorted(stems)) + make(0, 4)]))
            for _ in range(r.randrange(2)):
                k = r.randrange(len(word) + 1)
                word[k:k + r.randrange(2)] = r.choice(["", "a", "d"])
            word = "".join(word)
            begun = [x for x in stems if word.startswith(x)]
            near = [x for x in words if len(x) >= 5 and distance(word, x) <= 1]
            near_stem = [x for x in stems if len(x) >= 5 and min(distance(word[:k], x) for k in range(len(word) + 1)) <= 1]
            got = lexicon.lookup(word)
            if word in words:
                assert got == (word, 1.0, False)
            elif begun:
                assert got == (min(begun, key=len), 2.0, False)
            elif near:
                assert got[0] in near and got[1:] == (1.0, True)
            elif near_stem:
                assert got[0] in near_stem and got[1:] == (2.0, True)
            else:
                assert got is None


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    plain = ["".join(r.choice("lmnoprst") for _ in range(6)) for _ in range(200)]
    bad = ["verynasty", "awfulness", "horridone"]
    docs, labels = [], []
    for k in range(500):
        words = [r.choice(plain) for _ in range(40)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words[r.randrange(40)] = r.choice(bad)
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_learned_scores(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    labels = spark.createDataFrame(corpus[1] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = T.learn(docs, labels)
    rows = {r["doc_id"]: r["toxic_score"] for r in T.score(docs, model).collect()}
    assert len(rows) == 500
    for k, _, toxic in corpus[1]:
        assert 0 <= rows[k] <= 1 and (rows[k] >= 0.5) == bool(toxic)
    plain = corpus[0][1][1]
    assert model.score(plain + " verynosty") > model.score(plain)
    quoted = plain + ' she said "verynasty" and left'
    assert model.score(quoted) < model.score(plain + " verynasty")


def test_held_out_rows_are_not_learned(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in corpus[1]]
    schema = "doc_id long, quality int, toxic int"
    a = T.learn(docs, spark.createDataFrame(corpus[1], schema))
    b = T.learn(docs, spark.createDataFrame(flipped, schema))
    assert a.weights == b.weights and a.lexicon.words == b.lexicon.words


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null")
    rows = QUERIES["op7_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] == 1 for r in rows if r["toxic"] == 1) / sum(r["toxic"] == 1 for r in rows)
    false = sum(r["predicted"] == 1 for r in rows if r["toxic"] == 0) / sum(r["toxic"] == 0 for r in rows)
    assert hit >= 0.9 and false <= 0.02


def test_odd_rows(spark, corpus):
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "a", 1), (None, "verynasty", "a", 1), (3, "x " * 300_000, "a", 1), (2, "", "a", 1)],
        "doc_id long, text string, toxic_score_2 string, k0 int")
    model = T.Model(T.Lexicon({"verynasty": 5.0}, {}, ["verynasty"]), [-1.0, 2, 2, 0, 1, 0, 0])
    got = [(r["doc_id"], r["toxic_score"] >= 0.5) for r in T.score(docs, model, keep=docs.columns).collect()]
    assert sorted(got, key=str) == [(1, False), (2, False), (2, False), (3, False), (None, True)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    untrained = T.learn(docs, labels)
    assert {r["toxic_score"] for r in T.score(docs, untrained).collect()} == {0.0}
    assert T.score(docs.where("false"), model).count() == 0


def test_every_word_is_met_misspelled():
    r = random.Random(6)
    words = sorted({"".join(r.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(400)})
    lexicon = T._lexicon({w: (4 + k, 30.0) for k, w in enumerate(words)}, {})
    for w in words:
        assert lexicon.lookup(w[:4] + "#" + w[5:]) is not None


def test_empty_lexicon_scores_zero(spark):
    rows = [(k, f"plain text number {k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    model = T.learn(docs, labels)
    assert not model.lexicon.words and not model.lexicon.stems and not model.trained
    assert {x["toxic_score"] for x in T.score(docs, model).collect()} == {0.0}
