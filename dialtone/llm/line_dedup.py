"""Fuzzy line deduplication by MinHash, in DataFrame functions.

A document's lines are the stretches between line feeds, compared without
outer blanks. Equal lines are one from the start. Each different line gets a
MinHash signature over its character shingles; bands of the signature are
buckets; lines of a bucket are verified by the exact Jaccard similarity of all
their shingles; links join lines to components by distributed union-find. Of a
component the first line stays (smallest document id, then smallest line
number); the others go, wherever they are.

Signatures are taken over all shingles of every line, whatever its length, so
that those of any two lines can be compared. With the defaults a pair of
similarity 0.8, 0.85, 0.9 shares a bucket with probability 0.96, 0.988, 0.998.

Within a bucket every line is verified against a leader, in linear work; the
leader differs from band to band. Buckets that still hold several components
get other leaders in the next of ``rounds``. Those that hold several after the
last round, and more lines than leaders have met, are cut into tiles, and for every pair of tiles all lines of
different components are verified, so that every pair of a bucket is decided.
This last work grows with the square of such a bucket; its join returns links
alone, and none of its lines is dropped or capped. Intermediate tables go as
soon as nothing reads them.

Defined cases: blank lines always stay; null and empty texts have no lines to
drop; lines with fewer characters than a shingle are one shingle; documents
with a null id keep all their lines; documents that share an id lose the same
line numbers; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialtone.llm.common import connected_components, remove, scratch, stored, stored_by

SHINGLE = 6
BANDS, ROWS = 6, 4
TILE = 512
#: So many words of 64 bits, a power of two, tell lines apart before their shingles are compared.
WORDS = 32
#: So many shingles of a line are met in one row while it is signed.
STRIDE = 4


def _constant(k: int) -> int:
    """The k-th of a fixed sequence of 64-bit numbers, signed, their first bits spread evenly."""
    x = (k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & (1 << 59) - 1
    x |= (k * 0b10011 & 31) << 59
    return x - (1 << 64) if x >> 63 else x


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, at, line, h1, h2) of every line that isn't blank."""
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("doc"), F.posexplode(F.split(text_col, "\n", -1)).alias("at", "line"))
            .withColumn("line", F.btrim("line", F.lit(" \t\n\v\f\r")))
            .where("line <> ''")
            .withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")}))


def _n_shingles(line: Column, k: int) -> Column:
    return F.greatest(F.lit(1), F.char_length(line) - (k - 1))


def _signatures(lines: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """Distinct lines with their first document, number of occurrences and one hash for each band."""
    one = lines.groupBy("h1", "h2").agg(
        F.min("doc").alias("doc"), F.count("*").alias("n"), F.min("line").alias("line"))
    one = one.withColumn("m", _n_shingles(F.col("line"), k))
    # UTF-32 gives every character four bytes, so that a shingle is cut out in constant time; a row has
    # STRIDE shingles, of which the last of a line may come again
    each = (one.withColumn("wide", F.encode("line", "UTF-32"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1, F.lit(STRIDE))))
            .withColumns({f"w{r}": F.xxhash64(F.substring(
                "wide", F.least(F.col("i") + r, F.col("m") - 1) * 4 + 1, F.lit(4 * k))) for r in range(STRIDE)}))
    hashes = range(bands * rows)
    each = each.select("h1", "h2", "doc", "n", "m", *[
        F.least(*[F.col(f"w{r}").bitwiseXOR(F.lit(_constant(j))) for r in range(STRIDE)]).alias(f"s{j}") for j in hashes])
    lowest = [F.min(f"s{j}").alias(f"s{j}") for j in hashes]
    # all columns of the lines are used on both sides, so their one shuffle serves both
    signed = each.groupBy("h1", "h2", "doc", "n", "m").agg(*lowest)
    keys = [F.xxhash64(F.lit(b), *[f"s{b * rows + r}" for r in range(rows)]) for b in range(bands)]
    # every line stays, whatever its signature: equal lines are one by their number of occurrences alone
    return one.join(signed.select("h1", "h2", F.array(*keys).alias("bands")).hint("merge"), ["h1", "h2"], "left").select(
        "doc", "n", "m", "line", "h1", "h2", "bands")


def _shingles(line: Column, m: Column, k: int) -> Column:
    """The hashes of all shingles in their order; equal ones come again."""
    return _once(F.encode(line, "UTF-32"), lambda wide: F.transform(
        F.sequence(F.lit(1), m * 4 - 3, F.lit(4)), lambda at: F.xxhash64(F.substring(wide, at, F.lit(4 * k)))))


def _jaccard_links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of line ids whose shingles have the wanted similarity.

    ``texts`` has (line_id, line, m, x), x the number of different shingles.
    """
    left = texts.select(F.col("line_id").alias("a"), F.col("line").alias("la"), F.col("m").alias("ma"), F.col("x").alias("xa"))
    right = texts.select(F.col("line_id").alias("b"), F.col("line").alias("lb"), F.col("m").alias("mb"), F.col("x").alias("xb"))
    # sorted and merged at every size: the texts grow with the documents
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(
        _enough(percent) & (_shared(k) * (100 + percent) >= percent * (F.col("xa") + F.col("xb")))).select("a", "b")


def _shared(k: int) -> Column:
    """The number of different shingles that the lines ``la`` and ``lb``, of ``ma`` and ``mb`` positions, share."""
    return F.size(F.array_intersect(_shingles(F.col("la"), F.col("ma"), k), _shingles(F.col("lb"), F.col("mb"), k)))


def _enough(percent: int) -> Column:
    """Whether the numbers of shingles ``xa``, ``xb`` allow the wanted similarity."""
    return 100 * F.least("xa", "xb") >= percent * F.greatest("xa", "xb")


def _bits(texts: DataFrame, k: int) -> DataFrame:
    """(line_id, bits0, ...): the 64 * WORDS bits that the hashes of a line's shingles set, each one of them."""
    each = (texts.select("line_id", "m", F.encode("line", "UTF-32").alias("wide"))
            .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("m") * 4 - 3, F.lit(4))))
            .select("line_id", F.xxhash64(F.substring("wide", F.col("at"), F.lit(4 * k))).alias("s"))
            .select("line_id", F.shiftright("s", 6).bitwiseAND(WORDS - 1).alias("word"), F.call_function(
                "shiftleft", F.lit(1).cast("long"), F.col("s").bitwiseAND(63).cast("int")).alias("bit")))
    return each.groupBy("line_id").agg(*[F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(0)).alias(f"bits{w}")
                                         for w in range(WORDS)])


def _split(crowded: DataFrame, component: DataFrame, leaders: int) -> DataFrame:
    """The rows of buckets that hold several components, with the component.

    Buckets of at most one line more than the different ``leaders`` they had are decided.
    """
    here = crowded.join(component, "line_id", "left").withColumn("component", F.coalesce("component", "line_id"))
    several = here.groupBy("band", "bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where(
        (F.col("x") != F.col("y")) & (F.col("size") > leaders + 1))
    return here.join(several.select("band", "bucket", "size"), ["band", "bucket"])


def _tile_links(here: DataFrame, texts: DataFrame, k: int, percent: int, tile: int) -> DataFrame:
    """The links (a, b) among all lines of a bucket that are of different components.

    ``here`` has (band, bucket, line_id, component, size). The conditions are in
    the join, which returns links only. A bit that two lines don't share stands
    for a shingle that they don't share, so a pair with too many can't link.
    """
    crowd = stored(texts.select("line_id", "line", "m", "x").join(
        here.select("line_id").distinct().hint("merge"), "line_id", "left_semi"), "line-crowd")
    known = crowd.join(stored(_bits(crowd, k), "line-bits").hint("merge"), "line_id")
    rows = (here.withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("line_id"), F.col("tiles")).cast("int"))
            .join(known.hint("merge"), "line_id"))

    def side(end: str, own: str, other: str, others: Column) -> DataFrame:
        return rows.select("band", "bucket", F.col("own").alias(own), F.explode(others).alias(other),
                           F.col("line_id").alias(end), F.col("component").alias(f"c{end}"),
                           F.col("line").alias(f"l{end}"), F.col("m").alias(f"m{end}"), F.col("x").alias(f"x{end}"),
                           *[F.col(f"bits{w}").alias(f"{end}{w}") for w in range(WORDS)])

    left = side("a", "i", "j", F.sequence(F.col("own"), F.col("tiles") - 1))
    right = side("b", "j", "i", F.sequence(F.lit(0), F.col("own")))
    unlike = sum((F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(f"b{w}"))) for w in range(WORDS)), F.lit(0))
    near = unlike * (100 + percent) <= (F.col("xa") + F.col("xb")) * (100 - percent)
    # the shingles are cut only for pairs that the numbers and the bits allow
    similar = _shared(k) * (100 + percent) >= percent * (F.col("xa") + F.col("xb"))
    left, right = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("band", "bucket", "i", "j")]
    once = (F.col("l.i") < F.col("l.j")) | (F.col("a") < F.col("b"))
    return (left.hint("merge").join(right, same[0] & same[1] & same[2] & same[3] & (F.col("ca") != F.col("cb")) & once
                                    & _enough(percent) & near & similar)
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` names it several times."""
    return F.transform(F.array(value), use)[0]


def _joined(component: DataFrame, links: DataFrame) -> DataFrame:
    """``component`` (line_id, component) after more links (a, b), which join whole components."""
    def of(end: str) -> DataFrame:
        return component.select(F.col("line_id").alias(end), F.col("component").alias(f"c{end}"))

    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    merged = connected_components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    alone = merged.join(component.select(F.col("component").alias("node")).distinct(), "node", "left_anti")
    return (component.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")),
                           "component", "left")
            .select("line_id", F.coalesce("to", "component").alias("component"))
            .unionByName(alone.select(F.col("node").alias("line_id"), "component")))


def line_components(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS, rounds: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(h1, h2, component, keeper): lines that occur again or have near copies, and the document that keeps one."""
    # dealt and stored by their hashes: the texts of all lines are shuffled once
    lines = stored_by(_signatures(_lines(docs, id_col, text_col), shingle, bands, rows)
                      .withColumn("line_id", F.monotonically_increasing_id()), "lines", "h1", "h2")
    placed = lines.select("h1", "h2", F.posexplode("bands").alias("band", "bucket"))
    shared = stored(placed.withColumn("size", F.count("*").over(Window.partitionBy("band", "bucket")))
                    .where("size > 1").drop("size"), "line-shared")
    # the texts of the lines that share a bucket with another, the only ones that are compared
    texts = stored(lines.select("h1", "h2", "line_id", "line", "m").join(
        shared.select("h1", "h2").distinct().hint("shuffle_hash"), ["h1", "h2"], "left_semi")
        .withColumn("x", F.size(F.array_distinct(_shingles(F.col("line"), F.col("m"), shingle)))), "line-texts")
    crowded = stored(shared.join(texts.select("h1", "h2", "line_id"), ["h1", "h2"])
                     .select("line_id", "band", "bucket"), "line-buckets")
    remove(shared)

    component = None
    for turn in range(rounds):
        # XOR with a constant of the band and turn: another order of the ids, from which they can be read back;
        # two turns have the same order, of which they take the first and the last, so that their leaders differ
        start = 1000 + 100 * (turn // 2)
        key = F.lit(_constant(start))
        for b in range(1, bands):
            key = F.when(F.col("band") == b, F.lit(_constant(start + b))).otherwise(key)
        here = crowded
        if component is not None:
            here = _split(crowded, component, min(turn, 2))
        here = here.withColumn("order", F.col("line_id").bitwiseXOR(key))
        leader = here.groupBy("band", "bucket").agg((F.max if turn % 2 else F.min)("order").alias("first"))
        pairs = (here.join(leader, ["band", "bucket"])
                 .select(F.col("line_id").alias("a"), F.col("first").bitwiseXOR(key).alias("b"),
                         *([] if component is None else ["component"]))
                 .where("a <> b"))
        if component is not None:
            pairs = pairs.join(component.select(F.col("line_id").alias("b"), F.col("component").alias("other")),
                               "b", "left").where("component <> coalesce(other, b)")
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        links = stored(_jaccard_links(pairs, texts, shingle, percent), "line-links")
        with scratch(docs.sparkSession) as keep:
            joined = (connected_components(links).select(F.col("node").alias("line_id"), "component") if component is None
                      else _joined(component, links))
            joined = keep(stored(joined, "line-components"))
        if component is not None:
            remove(component)
        remove(links)
        component = joined
    if component is None:
        component = lines.select("line_id", F.col("line_id").alias("component")).where("false")
    with scratch(docs.sparkSession) as keep:
        rest = stored(_split(crowded, component, min(rounds, 2)), "line-rest")
        links = stored(_tile_links(rest, texts, shingle, percent, tile), "line-links")
        component = keep(stored(_joined(component, links), "line-components"))
    remove(crowded)

    found = texts.select("h1", "h2", "line_id").join(component, "line_id").select("h1", "h2", "component")
    known = (lines.select("h1", "h2", "doc", "n", "line_id").join(found, ["h1", "h2"], "left")
             .where("component is not null or n > 1")
             .withColumn("component", F.coalesce("component", "line_id")))
    keeper = known.groupBy("component").agg(F.min("doc").alias("keeper"))
    return known.join(keeper, "component").select("h1", "h2", "component", "keeper")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, dropped): the numbers, from 0 and rising, of the lines that go, of documents that lose any."""
    with scratch(docs.sparkSession) as keep:
        again = keep(stored(line_components(docs, id_col=id_col, text_col=text_col, **options), "line-decisions"))
    seen = _lines(docs, id_col, text_col).select("doc", "at", "h1", "h2").join(again.hint("merge"), ["h1", "h2"])
    per = (seen.groupBy("doc", "component", "keeper")
           .agg(F.sort_array(F.collect_set("at")).alias("places"))
           .withColumn("gone", F.when(F.col("doc") == F.col("keeper"), F.slice("places", F.lit(2), F.size("places")))
                       .otherwise(F.col("places"))).where(F.size("gone") > 0))
    return per.groupBy(F.col("doc").alias(id_col)).agg(
        F.sort_array(F.flatten(F.collect_list("gone"))).alias("dropped"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the lines that stay; documents that lose their last line go."""
    with scratch(docs.sparkSession) as keep:
        gone = keep(stored(dropped_lines(docs, id_col, text_col, **options).select(
            F.col(id_col).alias("__lines_id"), F.col("dropped").alias("__lines_gone")), "lines-dropped"))
    # sorted and merged at every size: the documents that lose lines grow with the documents
    both = docs.join(gone.hint("merge"), F.col(id_col) == F.col("__lines_id"), "left")
    kept = F.filter(F.split(F.col(text_col), "\n", -1),
                    lambda x, i: ~F.array_contains("__lines_gone", i))
    text = F.when(F.col("__lines_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    left = F.col("__lines_gone").isNull() | F.exists(kept, lambda x: F.btrim(x, F.lit(" \t\n\v\f\r")) != "")
    return both.where(left).withColumn(text_col, text).select(*docs.columns)
