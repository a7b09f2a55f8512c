"""The pipeline's stages on the small tables, each against plain code."""

import corpus_pipeline as P

from dialtone.llm import toxicity
from dialtone.llm.common import stored, table
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_sets


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    before = {r["doc_id"]: r for r in docs.collect()}
    want = {k for k, r in before.items() if model.score(r["text"] or "") < 0.5}
    frames = {}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        frames[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    rows = {name: {r["doc_id"]: r for r in df.collect()} for name, df in frames.items()}

    assert set(rows["toxicity"]) == want
    gone = brute_lines([(k, r["text"]) for k, r in rows["toxicity"].items()])
    missed = 0
    for k, r in rows["toxicity"].items():
        lines = r["text"].split("\n")
        left = [x for i, x in enumerate(lines) if i not in gone.get(k, ())]
        kept = rows["line_dedup"].get(k)
        if kept is None:
            assert k in gone and not any(x.strip() for x in left)
            continue
        assert kept["n_chars"] == len(kept["text"])
        stays = iter(kept["text"].split("\n"))
        assert all(x in stays for x in left)  # in order, none that stands alone is gone
        missed += kept["text"].count("\n") + 1 - len(left)
    # near copies whose signatures share no band
    assert missed <= 0.01 * sum(map(len, gone.values()))
    sets = brute_sets([(k, r["text"]) for k, r in rows["line_dedup"].items()])
    assert set(rows["ngram_join"]) == {k for k, (_, component, _) in sets.items() if component == k}
    assert set(rows["decontamination"]) <= set(rows["ngram_join"])
    assert {"domain", "epoch", "tokens"} <= set(frames["mixing"].columns)
    assert set(rows["mixing"]) <= set(rows["decontamination"])


def test_odd_documents(spark, tables_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, label string, mix string"
    rows = [(1, None, None, None, None, "l", "m"), (2, "", "en", "src1", 0, "l", "m"), (None, "a b c", "en", "src1", 5, "l", "m"),
            (3, "a line of words", "en", "src1", 15, "l", "m"), (3, "a line of words", "en", "src1", 15, "l", "m"),
            (4, "a line of words", "en", "src2", 15, "l", "m")]
    folder = tables_dir(documents=spark.createDataFrame(rows, schema))
    out = P.run(spark, folder)
    assert {"label", "mix", "domain"} <= set(out.columns)
    assert 4 not in {r["doc_id"] for r in out.collect()}
    empty = spark.createDataFrame([], schema)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, folder)
    assert empty.count() == 0
