from collections import defaultdict

from pyspark.sql import functions as F

from dialtone.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, row string, epoch string, leaf int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)


def used(df):
    out = defaultdict(int)
    for r in df.select("mix.*").collect():
        out[(r["domain"], r["lang"], r["source"])] += r["tokens"]
    return dict(out)


def test_shortage_goes_to_siblings_first(spark):
    # domain a: en short (10 tokens), de long; domain b long
    rows = [(k, "w", "en", "s") for k in range(10)] + [(100 + k, "w", "de", "s") for k in range(300)]
    rows += [(1000 + k, "w", "en", "t") for k in range(390)]
    domain = F.when(F.col("source") == "s", "a").otherwise("b")
    got = used(M.mix(frame(spark, rows), domain, M.Weights(), budget_share=400 / 700, max_epochs=1))
    # 200 for each domain; in a, en takes its 10 and de the other 190
    assert got == {("a", "en", "s"): 10, ("a", "de", "s"): 190, ("b", "en", "t"): 200}


def test_shortage_goes_to_ancestors_last_and_epochs_repeat(spark):
    rows = [(k, "w w", "en", "s") for k in range(10)] + [(100 + k, "w", "en", "t") for k in range(980)]
    domain = F.when(F.col("source") == "s", "a").otherwise("b")
    df = M.mix(frame(spark, rows), domain, M.Weights(), budget_share=0.5, max_epochs=2)
    assert used(df) == {("a", "en", "s"): 40, ("b", "en", "t"): 460}
    epochs = defaultdict(set)
    for r in df.where("mix.domain = 'a'").select("doc_id", "mix.epoch").collect():
        epochs[r["doc_id"]].add(r["epoch"])
    assert len(epochs) == 10 and all(x == {0, 1} for x in epochs.values())
    assert df.columns[:7] == ["doc_id", "text", "lang", "source", "row", "epoch", "leaf"]


def test_weights_and_zero_weight(spark):
    rows = [(k, "w", "en", f"s{k % 2}") for k in range(1000)]
    got = used(M.mix(frame(spark, rows), F.lit("d"), M.Weights(source={"s0": 3}), budget_share=0.4, max_epochs=1))
    assert got == {("d", "en", "s0"): 300, ("d", "en", "s1"): 100}
    got = used(M.mix(frame(spark, rows), F.lit("d"), M.Weights(source={"s0": 0}), budget_share=0.4, max_epochs=1))
    assert got == {("d", "en", "s1"): 400}


def test_same_seed_same_choice(spark):
    rows = [(k, "w " * (k % 7), "en", "s") for k in range(300)]
    pick = lambda seed: sorted(map(tuple, M.mix(
        frame(spark, rows), F.lit("d"), M.Weights(), budget_share=0.3, seed=seed).select("doc_id", "mix.epoch").collect()))
    assert pick(1) == pick(1) != pick(2)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (None, "a b", "en", "s"), (3, "a b", "en", "s"),
            (3, "a b", "en", "s"), (4, "x " * 100_000, "en", "s")]
    df = M.mix(frame(spark, rows), F.lit(None).cast("string"), M.Weights(), budget_share=1.0, max_epochs=1)
    got = sorted((r["doc_id"] or 0, r["tokens"]) for r in df.select("doc_id", "mix.tokens").collect())
    assert got == [(0, 2), (2, 0), (3, 2), (3, 2), (4, 100_000)] or got == [(0, 2), (3, 2), (3, 2), (4, 100_000)]
    assert M.mix(frame(spark, rows).where("false"), F.lit("d"), M.Weights()).count() == 0


def test_main_path_is_native(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = M.mix(docs, F.lit("d"), M.Weights())._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
