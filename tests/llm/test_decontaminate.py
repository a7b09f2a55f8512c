import random

from dialtone.llm import decontaminate as D


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string, codes string, at string"),
            spark.createDataFrame(items, "item_id long, text string"))


def found(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def case(seed=1):
    r = random.Random(seed)
    item = [f"i{k}" for k in range(30)]
    noise = lambda n: [f"n{r.randrange(500)}" for _ in range(n)]
    swapped = list(item)
    for k in range(5, 30, 7):
        swapped[k] = "changed"
    half = [w if k % 2 else "other" for k, w in enumerate(item)]
    texts = {1: noise(50) + item + noise(50), 2: noise(20) + swapped, 3: noise(90), 4: item[:8] + noise(40),
             5: noise(10) + half + noise(10), 6: [w.upper() + "," for w in item], 7: item[10:28] + noise(5)}
    return [(k, " ".join(t), "x", "y") for k, t in texts.items()], [(0, " ".join(item)), (1, "too short")]


def test_exact_and_substituted_passages(spark):
    docs, items = frames(spark, *case())
    assert found(D.find_overlaps(docs, items)) == {(1, 0), (2, 0), (6, 0), (7, 0)}


def test_joins_of_either_kind_give_the_same(spark, sf_dir):
    docs, items = frames(spark, *case(2))
    key, rows = "spark.sql.autoBroadcastJoinThreshold", lambda: sorted(map(tuple, D.find_overlaps(docs, items).collect()))
    before = spark.conf.get(key)
    want = rows()
    spark.conf.set(key, "-1")
    try:
        assert rows() == want != []
    finally:
        spark.conf.set(key, before)


def test_any_twelve_words_of_an_item_are_found(spark):
    r = random.Random(3)
    items = {k: [f"i{k}x{j}" for j in range(30)] for k in range(8)}
    docs, want = [], set()
    for n in (12, 13, 14):
        for k, item in items.items():
            at = r.randrange(1, 30 - n)
            docs.append((100 * n + k, " ".join([f"n{r.randrange(999)}" for _ in range(40)] + item[at:at + n] + ["end"] * 3), "x", "y"))
            want.add((100 * n + k, k))
            docs.append((100 * n + 50 + k, " ".join(["start"] * 20 + item[at:at + 11] + [f"n{r.randrange(999)}" for _ in range(20)]), "x", "y"))
    got = found(D.find_overlaps(*frames(spark, docs, [(k, " ".join(w)) for k, w in items.items()])))
    assert got == want  # eleven words are too few


def brute(text, item, flank=10, span=10):
    """Whether any stretch of an alignment has 12 words that agree, at least 75 of a hundred, around any window of it."""
    for shift in range(-len(item) + 12, len(text) - 11):
        flags = [0 <= k + shift < len(text) and text[k + shift] == w for k, w in enumerate(item)]
        inside = [0 <= k + shift < len(text) for k in range(len(item))]
        for a in range(len(item)):
            for b in range(a + 12, min(len(item), a + span + 2 * flank) + 1):
                if inside[a] and inside[b - 1] and sum(flags[a:b]) >= 12 and 100 * sum(flags[a:b]) >= 75 * (b - a):
                    return True
    return False


def test_recall_of_substituted_items(spark):
    r = random.Random(6)
    docs, items, cases = [], [], {}
    for n, subs in ((15, 2), (15, 3), (18, 3), (18, 4), (20, 4), (25, 6)):
        for k in range(60):
            key = len(items)
            item = [f"w{r.randrange(5000)}" for _ in range(n)]
            items.append((key, " ".join(item)))
            changed = list(item)
            for at in r.sample(range(n), subs):
                changed[at] = "changed"
            words = [f"n{r.randrange(999)}" for _ in range(15)] + changed + [f"n{r.randrange(999)}" for _ in range(15)]
            docs.append((key, " ".join(words), "x", "y"))
            if brute(words, item):
                cases.setdefault((n, subs), []).append(key)
    got = {d for d, i in found(D.find_overlaps(*frames(spark, docs, items))) if d == i}
    assert got <= {k for v in cases.values() for k in v}
    for case_, keys in cases.items():
        assert len(got & set(keys)) >= 0.93 * len(keys), (case_, len(got & set(keys)), len(keys))


def test_odd_rows(spark):
    item = " ".join(f"i{k}" for k in range(20))
    docs = [(1, None, "", ""), (2, "", "", ""), (None, item, "", ""), (3, item, "", ""), (3, item, "", ""),
            (4, "w " * 100_000 + item, "", "")]
    docs, items = frames(spark, docs, [(0, item), (0, item), (1, None), (2, ""), (None, item)])
    assert found(D.find_overlaps(docs, items)) == {(3, 0), (4, 0)}
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2]
    assert D.find_overlaps(docs.where("false"), items).count() == 0
    assert D.drop_contaminated(docs, items.where("false")).count() == docs.count()


def test_main_path_is_native(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = D.find_overlaps(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
