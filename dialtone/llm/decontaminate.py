"""Benchmark decontamination by spaced seeds, in DataFrame functions.

A mask is a fixed pattern over a window of words: the words under its ``1`` are
hashed, the others are ignored, so a substituted word there does no harm. The
window hashes of training texts are joined with those of the benchmark items.
Around each hit the words of text and item are compared along the same
alignment. A hit counts when a stretch that holds its window, with up to ``flank``
words on either side, has ``min_agree`` words that agree, and these are
``min_percent`` of the stretch. So any 12 words in a row out of an item are found,
wherever they stand, and longer passages with substitutions.

Of all ways to substitute 3 words of a 15-word item the three masks find 98 of a
hundred, all ways with 2; of 4 in 16 words, the most that may differ, 92.

Words are the stretches of letters and digits of the lower-cased text.

Defined cases: null and empty texts have no windows; a text or item with fewer
words than ``min_agree`` can't match; rows with a null id are not reported;
rows that share an id are reported under it once; repeated items are reported
each. Texts are searched whole. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.llm.common import scratch, stored

MASKS = ("1011010011", "1110010101", "1010001111")
FLANK = 10


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def word_codes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _windows(df: DataFrame, codes: str, masks: tuple[str, ...]) -> DataFrame:
    """A row for each window and mask, with its place ``at`` and hash ``seed``."""
    span = len(masks[0])
    if any(len(m) != span or set(m) - set("01") or "1" not in m for m in masks):
        raise ValueError("masks are strings of 0 and 1 of one length")
    placed = df.where(F.size(codes) >= span).withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.size(codes) - span)))
    hashes = [F.xxhash64(F.lit(k), *[F.get(F.col(codes), F.col("at") + i)
                                     for i, c in enumerate(m) if c == "1"])
              for k, m in enumerate(masks)]
    return placed.withColumn("seed", F.explode(F.array(*hashes)))


def _with_agreement(hits: DataFrame, span: int, flank: int, min_agree: int, min_percent: int) -> DataFrame:
    """``hits`` with ``agree``, the most words that agree in a stretch that counts, null without one."""
    def same(start: Column, n: Column) -> Column:
        return F.zip_with(F.slice("codes", F.col("at") + start + 1, n), F.slice("item_codes", F.col("item_at") + start + 1, n),
                          lambda x, y: F.when(x == y, 1).otherwise(0))

    def total(flags: Column) -> Column:
        return F.aggregate(flags, F.lit(0), lambda a, x: a + x)

    def ends(flags: str) -> Column:
        """(words, those that agree) of the beginnings of ``flags`` that end with a word that agrees, and of none."""
        here = F.filter(F.sequence(F.lit(1), F.size(flags)), lambda n: F.element_at(flags, n) == 1)
        found = F.transform(F.when(F.size(flags) > 0, here), lambda n: F.struct(
            n.alias("n"), total(F.slice(flags, F.lit(1), n)).alias("same")))
        none = F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("same")))
        return F.concat(none, F.coalesce(found, F.array().cast("array<struct<n:int,same:int>>")))

    sides = hits.select(
        "id", "item", "at", "item_at", F.least(F.lit(flank), "at", "item_at").alias("left"),
        F.least(F.lit(flank), F.size("codes") - F.col("at") - span, F.size("item_codes") - F.col("item_at") - span).alias("right"),
        "codes", "item_codes")
    flags = sides.select("id", "item", "at", "item_at", total(same(F.lit(0), F.lit(span))).alias("inside"),
                         F.reverse(same(-F.col("left"), F.col("left"))).alias("before"),
                         same(F.lit(span), F.col("right")).alias("behind"))
    # a stretch that ends with a word that doesn't agree is never better than the one without it
    stretches = flags.select("id", "item", "at", "item_at", "inside", ends("before").alias("before"), ends("behind").alias("behind"))
    enough = lambda n, same_: (same_ >= min_agree) & (100 * same_ >= min_percent * n)
    most = F.struct((F.element_at("before", -1)["n"] + F.element_at("behind", -1)["n"] + span).alias("n"),
                    (F.element_at("before", -1)["same"] + F.element_at("behind", -1)["same"] + F.col("inside")).alias("same"))
    widest = stretches.withColumn("most", most)
    best = F.array_max(F.flatten(F.transform("before", lambda x: F.transform("behind", lambda y: F.when(
        enough(x["n"] + y["n"] + span, x["same"] + y["same"] + F.col("inside")), x["same"] + y["same"] + F.col("inside"))))))
    # the widest stretch has the most words that agree: where it counts no other need be looked at
    return widest.select("id", "item", "at", "item_at", F.when(
        F.col("most.same") < min_agree, F.lit(None)).when(enough(F.col("most.n"), F.col("most.same")), F.col("most.same"))
        .otherwise(best).alias("agree"))


def find_overlaps(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, flank: int = FLANK,
                  min_agree: int = 12, min_percent: int = 75, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that overlap: (id, item, n_hits, most_agree).

    ``n_hits`` counts alignments of window starts that were verified,
    ``most_agree`` the largest number of words that agree around one. Hashes are
    joined first, texts only of documents with a hit; Spark chooses the joins.
    """
    span = len(masks[0])
    with scratch(docs.sparkSession) as keep:
        known = keep(stored(items.where(F.col(item_col).isNotNull())
                            .select(F.col(item_col).alias("item"), word_codes(F.col(item_text)).alias("item_codes"))
                            .where(F.size("item_codes") >= span), "items"))
        seeds = stored(_windows(known, "item_codes", masks)
                       .select("seed", "item", F.col("at").alias("item_at")).distinct(), "seeds")
        texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        windows = _windows(texts.select("id", word_codes(F.col("text")).alias("codes")), "codes", masks)
        found = keep(stored(windows.select("id", "at", "seed").join(seeds, "seed")
                            .select("id", "at", "item", "item_at").distinct(), "seed-hits"))
        ids = keep(stored(found.select("id").distinct(), "hit-ids"))  # a table, so that its size is known
    hit = texts.join(ids, "id", "left_semi").select("id", word_codes(F.col("text")).alias("codes"))
    hits = found.join(known, "item").join(hit, "id").where(F.col("at") + span <= F.size("codes"))
    verified = _with_agreement(hits, span, flank, min_agree, min_percent).where("agree is not null")
    return (verified.groupBy("id", "item")
            .agg(F.count_distinct("at", "item_at").alias("n_hits"), F.max("agree").cast("long").alias("most_agree"))
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_hits", "most_agree"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that overlap an item. Rows with a null id stay."""
    with scratch(docs.sparkSession) as keep:
        found = keep(stored(find_overlaps(docs, items, id_col=id_col, **options).select(id_col).distinct(), "contaminated"))
    return docs.join(found, id_col, "left_anti").select(*docs.columns)
