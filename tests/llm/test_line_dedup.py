import random
from collections import defaultdict

from pyspark.sql import functions as F

from dialtone.llm import line_dedup as L
from dialtone.llm.common import _table_name, scratch, stored, stored_by
from dialtone.llm.queries import QUERIES

BLANKS = " \t\n\v\f\r"


def brute(rows, percent=80, k=6):
    """{doc: numbers of the lines that go}, every pair of different lines compared."""
    seen = defaultdict(list)
    for doc, text in sorted(rows):
        for at, line in enumerate((text or "").split("\n")):
            if line.strip(BLANKS):
                seen[line.strip(BLANKS)].append((doc, at))
    lines = list(seen)
    sets = [{x[i:i + k] for i in range(max(1, len(x) - k + 1))} for x in lines]
    by = defaultdict(list)
    up = list(range(len(lines)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in by[x]:
                shared[j] += 1
            by[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[top(i)] = top(j)
    groups = defaultdict(list)
    for i, line in enumerate(lines):
        groups[top(i)] += seen[line]
    out = defaultdict(set)
    for places in groups.values():
        for doc, at in places:
            if (doc, at) != min(places):
                out[doc].add(at)
    return dict(out)


def answer(df):
    return {r["doc_id"]: set(r["dropped"]) for r in df.collect()}


def test_exact_and_fuzzy_lines(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcdefgh ") for _ in range(120)) for _ in range(12)]
    rows = []
    for doc in range(60):
        own = "".join(r.choice("ijklmnop ") for _ in range(90))
        line = list(r.choice(base))
        for _ in range(r.randrange(2)):
            line[r.randrange(len(line))] = "#"
        rows.append((doc, "\n".join([own, "".join(line), "", "  " + own + "\t", r.choice(base)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # enough bands that no pair is missed
    assert answer(L.dropped_lines(df, bands=24)) == brute(rows)


def test_table_against_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_line_dedup"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    got = {(r["doc_id"], int(x)) for r in got if r["dropped"] for x in r["dropped"].split(",")}
    want = {(d, x) for d, places in brute(rows).items() for x in places}
    # a bucket may be missed with small probability, a line that stands alone never goes
    assert len(want - got) <= 0.01 * len(want) and len(got - want) <= 0.01 * len(want)


def test_odd_rows(spark):
    rows = [(1, "one line here\n\n \none line here"), (2, None), (3, ""), (None, "one line here"),
            (4, "x"), (5, "x\ny"), (6, "one line here"), (7, "z" * 200_000 + "\nlast")]
    df = spark.createDataFrame([(*r, "h1", 5, "doc") for r in rows],
                               "doc_id long, text string, h1 string, at int, doc string")
    assert answer(L.dropped_lines(df)) == {1: {3}, 5: {0}, 6: {0}}
    kept = L.drop_lines(df)
    assert kept.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == {1: "one line here\n\n ", 2: None, 3: "", None: "one line here", 4: "x", 5: "y", 7: rows[7][1]}
    assert L.drop_lines(df.where("false")).count() == 0


def test_repeated_rule_lines(spark):
    rules = [x * (80 // len(x)) for x in ("-", "*", "_", "~", "=", "#", ".", "- ", "* ", "+-")] + ["ha " * 30]
    rows = [(doc, "\n".join(rules)) for doc in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = answer(L.dropped_lines(df))
    assert all(gone[doc] == set(range(len(rules))) for doc in (1, 2))


def test_pairs_across_lengths_with_the_defaults(spark):
    r = random.Random(8)
    rows = []
    for i in range(200):  # 68 characters beside 69: 63 shingles beside 64
        line = "".join(r.choice("abcdefghijklmnop ") for _ in range(66))
        near = line[:r.randrange(1, 65)] + "#"
        rows += [(2 * i, f"<{line}>"), (2 * i + 1, f"<{near}{line[len(near) - 1:]}>")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = brute(rows), answer(L.dropped_lines(df))
    assert len(want) > 150 and set(got) <= set(want)
    assert len(got) >= 0.9 * len(want)


def test_every_pair_of_crowded_buckets(spark):
    r = random.Random(4)
    rows = []
    for i in range(150):  # pairs with a common template, alike within a pair alone
        line = "the quick brown fox jumps over the lazy dog " + "".join(r.choice("abcdefghijklmnop") for _ in range(22))
        at = r.randrange(46, 62)
        rows += [(2 * i, line), (2 * i + 1, f"{line[:at]}#{line[at + 1:]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = L._signatures(L._lines(df, "doc_id", "text"), 6, 1, 1).collect()
    bucket = {x["doc"]: x["bands"][0] for x in signed}
    # of one band, those pairs that share its bucket
    want = {d for d in brute(rows) if bucket[d] == bucket[d - 1]}
    assert len(want) > 90
    assert set(answer(L.dropped_lines(df, bands=1, rows=1, tile=32))) == want


def test_main_path_is_native(spark, sf_dir):
    plan = L.drop_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_intermediate_tables_go(spark, sf_dir):
    import os

    from dialtone.session import shared_folder
    folder = f"{shared_folder(spark)}/corpus"
    left = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = left()
    gone = L.dropped_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert {x.rsplit("-", 1)[0] for x in left() - before} == {"line-decisions"} and gone.count() > 0
    before = left()
    kept = L.drop_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert {x.rsplit("-", 1)[0] for x in left() - before} == {"lines-dropped"} and kept.count() > 0


def test_texts_of_all_lines_are_shuffled_once(spark, monkeypatch):
    plans = {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(L, "stored", watched)
    df = spark.createDataFrame([(i, f"a line that is met in many documents, number {i // 3} of them") for i in range(30)],
                               "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.line_components(df).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == 10
    exchanged = [x for x in plans["line-texts"].split("\n") if "Exchange" in x]
    assert "Bucketed: true" in plans["line-texts"] and len(exchanged) == 1, plans["line-texts"]


def test_tables_in_buckets_go_with_their_scope(spark):
    with scratch(spark):
        table = stored_by(spark.range(100).selectExpr("id", "id % 7 as k"), "bucketed", "k")
        assert table.groupBy("k").count().count() == 7
        name = _table_name(table.stored_at)
        assert spark.catalog.tableExists(name)
    assert not spark.catalog.tableExists(name)


def test_every_shingle_of_a_line_is_signed(spark):
    lines = ["x" * n + "end" for n in range(1, 40)] + ["short", "s", "äöü€😀" * 5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r["line"]: r["bands"] for r in L._signatures(L._lines(df, "doc_id", "text"), 6, 2, 2).collect()}
    each = df.selectExpr("text", "explode(transform(sequence(1, greatest(1, char_length(text) - 5)), "
                         "i -> xxhash64(encode(substring(text, i, 6), 'UTF-32')))) as s")
    low = each.groupBy("text").agg(*[F.min(F.col("s").bitwiseXOR(F.lit(L._constant(j)))).alias(f"s{j}") for j in range(4)])
    want = low.select("text", F.array(F.xxhash64(F.lit(0), "s0", "s1"), F.xxhash64(F.lit(1), "s2", "s3")).alias("bands"))
    assert got == {r["text"]: r["bands"] for r in want.collect()}


def test_joins_that_grow_are_merges_on_small_tables(spark, monkeypatch):
    plans = {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(L, "stored", watched)
    df = spark.createDataFrame([(i, f"a line that is met in many documents, number {i // 3} of them" + "!" * (i % 3))
                                for i in range(30)] + [(30, "alone"), (31, "0123456789")], "doc_id long, text string")
    gone = L.dropped_lines(df)
    # the texts of crowded buckets and the lines that go
    for plan in (plans["line-crowd"], gone._jdf.queryExecution().executedPlan().toString()):
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan


def test_bits_are_those_of_the_shingles(spark):
    df = spark.createDataFrame([(1, "a line of words", 10), (2, "xxxxxxxx", 3), (3, "é😀", 1)], "line_id long, line string, m int")
    hashes = {r["line_id"]: r["all"] for r in df.select("line_id", L._shingles(F.col("line"), F.col("m"), 6).alias("all")).collect()}
    assert [len(hashes[i]) for i in (1, 2, 3)] == [10, 3, 1] and len(set(hashes[2])) == 1
    for r in L._bits(df, 6).collect():
        bits = {64 * w + i for w in range(L.WORDS) for i in range(64) if r[f"bits{w}"] >> i & 1}
        assert bits == {64 * (h >> 6 & L.WORDS - 1) + (h & 63) for h in hashes[r["line_id"]]}


def test_bits_tell_long_lines_apart(spark):
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = []
    for i in range(40):  # 375 of 625 shingles in common, so no shingle of such a pair needs to be compared
        base = text(380)
        rows += [(2 * i, base + text(125)), (2 * i + 1, base + text(125))]
    df = spark.createDataFrame(rows, "line_id long, line string").withColumn("m", L._n_shingles(F.col("line"), 6))
    bits = {x["line_id"]: [x[f"bits{w}"] for w in range(L.WORDS)] for x in L._bits(df, 6).collect()}
    for i in range(40):
        unlike = sum(bin((a ^ b) % (1 << 64)).count("1") for a, b in zip(bits[2 * i], bits[2 * i + 1]))
        assert unlike * 180 > 1000 * 20
