import random
import re
from collections import defaultdict

import numpy as np

from dialtone.llm import ngram_join as G
from dialtone.llm.queries import QUERIES


def brute(rows, percent=75):
    """{id: (n_shingles, component, n_links)} by comparing every pair."""
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = defaultdict(int)
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: (len(sets[i]), top(i), links[i]) for i in ids}


def answer(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in df.collect()}


def copies(seed, groups, each, words=60):
    """Groups of near copies that also share a passage over all groups."""
    r = random.Random(seed)
    passage = [f"p{k}" for k in range(25)]
    rows, doc = [], 0
    for g in range(groups):
        base = [f"g{g}w{r.randrange(40)}" for _ in range(words)] + passage
        for _ in range(each):
            text = list(base)
            for _ in range(r.randrange(4)):
                text[r.randrange(len(text))] = f"x{r.randrange(9)}"
            rows.append((doc, " ".join(text)))
            doc += 1
    r.shuffle(rows)
    return rows


def test_fixture_equals_brute_force(spark):
    rows = copies(1, 8, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(G.ngram_join(df)) == brute(rows)


def test_small_tiles_give_the_same(spark):
    rows = copies(2, 2, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(G.ngram_join(df, tile=4)) == brute(rows)


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert answer(QUERIES["op2_ngram_join"](spark, sf_dir)) == brute([tuple(r) for r in docs])


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\x0btwo"), (6, "one two three"),
            (7, "a b c d e"), (8, "A b  c\td e"), (9, long), (10, long + " tail"), (None, "a b c d e")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id long, text string, cls string, id int")
    got = answer(G.ngram_join(df))
    assert got == brute([r for r in rows if r[0] is not None])
    assert got[1] == (0, 1, 0) and got[5][1] == 4 and got[10][1] == 9


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert answer(G.ngram_join(df)) == {1: (2, 1, 1), 2: (2, 1, 1)}
    assert G.ngram_join(df.where("false")).count() == 0


def test_tree_finds_what_pairs_show():
    r = random.Random(4)
    for _ in range(40):
        sets = [np.array(sorted(r.sample(range(30), r.randrange(1, 25)))) for _ in range(20)]
        sets += [s.copy() for s in sets[:3]]
        extra = [r.randrange(4) for _ in sets]  # members that no other set has
        sizes = np.array([len(s) + e for s, e in zip(sets, extra)])
        tree = G.PrefixTree(sets, sizes)
        marks = np.zeros(30, dtype=bool)
        for i, s in enumerate(sets):
            got = sorted(tree.linked(s, int(sizes[i]), marks, 75).tolist())
            want = []
            for j, t in enumerate(sets):
                common = len(set(s.tolist()) & set(t.tolist()))
                if 100 * common >= 75 * (sizes[i] + sizes[j] - common):
                    want.append(j)
            assert got == want and not marks.any()
