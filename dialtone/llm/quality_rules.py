"""Quality rules as learned decision lists, in DataFrame functions.

Statistics of every text (words, symbols, repeated lines and word windows,
letter case and so on) become whole numbers, most of them rates per thousand.
From labelled rows a decision list is learned by sequential covering:

1. of the rows that no rule covers yet, the rarer label is the target;
2. a rule grows on two thirds of them, one threshold at a time, the one with the
   best gain of information first, until it covers no other label;
3. it is pruned on the last third: conditions go from its end while
   (right - wrong) / covered doesn't fall;
4. it joins the list if it is mostly right there, and its rows are covered.

The list ends with the commoner label of the rows that no rule covers. It is
emitted as one ordered conditional expression over the statistics. The driver
sees thresholds, and counts by threshold bin, never rows; all labelled rows count.
Texts are read once, for their statistics, and never shuffled.

Repeated words are found within a row by sorting its window hashes (64 bits, so
two different windows of one text are taken for equal with a probability under
n^2 / 2^65), in memory of about 200 bytes for a word of the text.

Defined cases: a null text is empty and fails the base rules; rows without a
label, or with several different ones, teach nothing; with one label only every
text gets that verdict, without labels every text is kept; repeated rows are
returned each; an empty table gives an empty result. Other columns are passed
on; the structs that are added have names of the caller's choice, and take the
place of columns with these names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.llm.common import remove, stored

BLANKS = " \t\n\v\f\r"
#: The statistics that rules may name.
FEATURES = ("n_words", "word_length", "symbols", "repeated_lines", "repeated_words", "richness",
            "capitals", "digits", "stops", "line_length")
BINS = 48
MAX_CONDITIONS = 4
MAX_RULES = 24


# ---- statistics -----------------------------------------------------------

def _count(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _rate(part: Column, whole: Column) -> Column:
    """Parts of a thousand, rounded down; 0 of nothing."""
    return F.when(whole > 0, F.floor(part.cast("long") * 1000 / whole)).otherwise(F.lit(0)).cast("long")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def statistics(docs: DataFrame, text_col: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with a struct ``name``: the counts n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, ``rules``, a struct of FEATURES, and ``prune``, whether the text is of the last third.

    This is the expensive step: store what it gives (without the texts) and both learn and judge from that.
    """
    own = _free(docs, "__quality")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one step for each array, so that none is computed twice
    step = docs.withColumn(own, F.struct(
        text.alias("text"), F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines")))

    def more(df: DataFrame, **columns: Column) -> DataFrame:
        return df.withColumn(own, F.struct(f"{own}.*", *[c.alias(k) for k, c in columns.items()]))

    def get(x: str) -> Column:
        return F.col(f"{own}.{x}")

    step = step.withColumn(own, F.struct(
        get("text").alias("text"), F.size(get("lines")).alias("n_lines"),
        (F.size(get("lines")) - F.size(F.array_distinct(get("lines")))).alias("n_dup_lines"),
        F.transform(get("words"), lambda w: F.xxhash64(w)).alias("codes")))
    step = more(step, n_words=F.size(get("codes")), windows=F.when(F.size(get("codes")) > 3, F.transform(
        F.sequence(F.lit(0), F.size(get("codes")) - 3), lambda i: F.xxhash64(
            F.get(get("codes"), i), F.get(get("codes"), i + 1), F.get(get("codes"), i + 2)))))
    # windows in the order of their hashes, with their places; only where one occurs again
    again = F.size(F.array_distinct(get("windows"))) < F.size(get("windows"))
    step = more(step, different=F.size(F.array_distinct(get("codes"))), placed=F.when(again, F.sort_array(F.transform(
        get("windows"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    hits = F.filter(get("placed"), lambda x, j: (
        (F.get(get("placed"), j - 1)["w"] == x["w"]) | (F.get(get("placed"), j + 1)["w"] == x["w"])))
    step = step.withColumn(own, F.struct(
        *[get(x).alias(x) for x in ("text", "n_lines", "n_dup_lines", "n_words", "different")],
        F.sort_array(F.transform(hits, lambda x: x["i"])).alias("hits")))
    # a window covers three words, less where the next one begins earlier
    covered = F.aggregate(F.transform(get("hits"), lambda i, j: F.least(
        F.lit(3), F.coalesce(F.get(get("hits"), j + 1) - i, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    step = step.withColumn(own, F.struct(
        *[get(x).alias(x) for x in ("n_lines", "n_dup_lines", "n_words", "different")],
        (F.pmod(F.xxhash64(get("text")), F.lit(3)) == 0).alias("prune"),  # copies of a text are of one part
        F.char_length(get("text")).alias("chars"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
        F.char_length(F.translate(get("text"), BLANKS, "")).alias("word_chars"),
        _count(get("text"), "#*$%&|<>").alias("n_symbols"),
        F.regexp_count(get("text"), F.lit(r"\p{Lu}")).alias("capitals"),
        _count(get("text"), "0123456789").alias("digits"), _count(get("text"), ".,;:!?").alias("stops")))
    rules = F.struct(
        get("n_words").cast("long").alias("n_words"), _rate(get("word_chars"), get("n_words")).alias("word_length"),
        _rate(get("n_symbols"), get("chars")).alias("symbols"),
        _rate(get("n_dup_lines"), get("n_lines")).alias("repeated_lines"),
        _rate(get("n_repeat_words"), get("n_words")).alias("repeated_words"),
        # the logarithm of different words over that of words changes little with a text's length
        F.when(get("n_words") > 1, F.floor(1000 * F.ln(get("different")) / F.ln(get("n_words")))).otherwise(1000)
        .cast("long").alias("richness"),
        _rate(get("capitals"), get("chars")).alias("capitals"), _rate(get("digits"), get("chars")).alias("digits"),
        _rate(get("stops"), get("chars")).alias("stops"),
        F.when(get("n_lines") > 0, F.floor(get("chars") / get("n_lines"))).otherwise(0).cast("long").alias("line_length"))
    counts = [get(x).cast("long").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return step.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()],
                       F.struct(*counts, rules.alias("rules"), get("prune").alias("prune")).alias(name))


def base_failed(stats: str = "stats") -> Column:
    """Too few words, or too many of them in windows that occur again."""
    n = F.col(f"{stats}.n_words")
    return (n < 50) | (100 * F.col(f"{stats}.n_repeat_words") > 50 * n)


# ---- decision lists -------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold}"

    def column(self, stats: str) -> Column:
        value = F.col(f"{stats}.{self.feature}")
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class Rule:
    """All ``conditions`` together give the verdict ``keep``."""

    conditions: tuple[Condition, ...]
    keep: bool

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f" -> {'keep' if self.keep else 'drop'}"

    def column(self, stats: str) -> Column:
        return _all([c.column(stats) for c in self.conditions])


@dataclass(frozen=True)
class DecisionList:
    """The first rule that covers a row decides, ``default`` where none does."""

    rules: tuple[Rule, ...]
    default: bool

    def column(self, stats: str = "stats.rules") -> Column:
        """The list as one conditional expression over the struct of statistics."""
        out = None
        for rule in self.rules:
            covers, verdict = rule.column(stats), F.lit(rule.keep)
            out = F.when(covers, verdict) if out is None else out.when(covers, verdict)
        return F.lit(self.default) if out is None else out.otherwise(F.lit(self.default))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[int]]:
    """Quantiles of each statistic under each label, rising."""
    shares = [k / bins for k in range(bins + 1)]
    named = [(f, y) for f in FEATURES for y in (0, 1)]
    found = rows.agg(*[F.percentile_approx(F.when(F.col("y") == y, F.col(f"x.{f}")), shares, 10_000).alias(f"{f}{y}")
                       for f, y in named]).first()
    cuts: dict[str, set[int]] = {f: set() for f in FEATURES}
    for f, y in named:
        for v in found[f"{f}{y}"] or []:
            cuts[f].update((v, v + 1))  # both sides of a common value
    return {f: sorted(v) for f, v in cuts.items()}


def _reached_by(value: Column):
    return lambda cut: cut <= value


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained on the covered target rows by going from (p0, n0) to (p, n)."""
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def _splits(cuts: list[int], counts: dict[int, tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(threshold, target rows below, other rows below); of thresholds that part the rows alike, the middle."""
    below, first = (0, 0), None
    for at, cut in enumerate(cuts):  # bin ``at`` holds the values under ``cut``
        here = tuple(map(sum, zip(below, counts.get(at, (0, 0)))))
        if first is not None and here != below:
            yield (first + cuts[at - 1]) // 2, *below
            first = None
        first = cut if first is None else first
        below = here
    if first is not None:
        yield (first + cuts[-1]) // 2, *below


def _strictest(conditions: list[Condition]) -> tuple[Condition, ...]:
    """One condition for each statistic and direction: of several, the others say nothing more."""
    kept: dict[tuple[str, bool], Condition] = {}
    for c in conditions:
        old = kept.get((c.feature, c.at_least), c)
        kept[c.feature, c.at_least] = max(c, old, key=lambda x: x.threshold if x.at_least else -x.threshold)
    return tuple(kept.values())


def _grow(rows: DataFrame, cuts: dict[str, list[int]], target: int, min_rows: int) -> list[Condition]:
    """Conditions that separate the rows of ``target``, the best first. ``rows`` has x, y and bins."""
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        inside = rows.where(_all([c.column("x") for c in conditions]))
        counts = (inside.select("y", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin")
                  .agg(F.count_if(F.col("y") == target).alias("p"), F.count("*").alias("n")).collect())  # features x bins
        if not counts:
            break
        by: list[dict[int, tuple[int, int]]] = [{} for _ in FEATURES]
        for r in counts:
            by[r["f"]][r["bin"]] = (r["p"], r["n"] - r["p"])
        p0, n0 = (sum(v[k] for v in by[0].values()) for k in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f, name in enumerate(FEATURES):
            for cut, p, n in _splits(cuts[name], by[f]):
                for at_least, p, n in ((False, p, n), (True, p0 - p, n0 - n)):
                    if p >= min_rows:
                        best = max(best, (_gain(p, n, p0, n0), Condition(name, at_least, cut)), key=lambda b: b[0])
        if best[1] is None or best[0] < 1e-9:
            break
        conditions.append(best[1])
    return conditions


def _prune(rows: DataFrame, conditions: list[Condition], target: int) -> tuple[list[Condition], int, int]:
    """The beginning of ``conditions`` with the best (right - wrong) / covered, the shortest of equal ones."""
    begun = [_all([c.column("x") for c in conditions[:k + 1]]) for k in range(len(conditions))]
    found = rows.agg(*[F.count_if(b & (F.col("y") == target)).alias(f"p{k}") for k, b in enumerate(begun)],
                     *[F.count_if(b & (F.col("y") != target)).alias(f"n{k}") for k, b in enumerate(begun)]).first()
    score = [((found[f"p{k}"] - found[f"n{k}"]) / max(1, found[f"p{k}"] + found[f"n{k}"]), -k) for k in range(len(begun))]
    k = -max(score)[1]
    return conditions[:k + 1], found[f"p{k}"], found[f"n{k}"]


def learn(rows: DataFrame, labels: DataFrame, bins: int = BINS, max_rules: int = MAX_RULES, min_rows: int = 5,
          id_col: str = "doc_id", stats: str = "stats", label_col: str = "quality") -> DecisionList:
    """A decision list from all rows with :func:`statistics` that ``labels`` calls good (1) or bad (0).

    A rule covers ``min_rows`` of the target rows that it grows on, at least.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("__y"))
             .where("y = __y").select("__id", "y"))
    given = rows.select(F.col(id_col).alias("__id"), F.col(f"{stats}.rules").alias("x"), F.col(f"{stats}.prune").alias("prune"))
    rows = stored(given.join(known, "__id").select("y", "x", "prune"), "quality-rows")
    shares = rows.groupBy("y").count().collect()  # two rows
    if len(shares) < 2:
        remove(rows)
        return DecisionList((), shares[0]["y"] == 1 if shares else True)
    cuts = _thresholds(rows, bins)
    # the bin of a value is the number of thresholds that it reaches
    binned = F.array(*[F.size(F.filter(F.array(*[F.lit(c) for c in cuts[f]]), _reached_by(F.col(f"x.{f}"))))
                       for f in FEATURES])
    left = stored(rows.withColumn("bins", binned), "quality-bins")
    remove(rows)
    rules: list[Rule] = []
    free = F.lit(True)
    while True:
        open_ = left.where(free)
        count = {r["y"]: r["count"] for r in open_.groupBy("y").count().collect()}
        good, bad = count.get(1, 0), count.get(0, 0)
        target = 1 if good < bad else 0
        default = not target
        if not min(good, bad) or len(rules) == max_rules:
            break
        conditions = _grow(open_.where("not prune"), cuts, target, min_rows)
        if not conditions:
            break
        conditions, right, wrong = _prune(open_.where("prune"), conditions, target)
        if right <= wrong:
            break
        rules.append(Rule(_strictest(conditions), target == 1))
        free = free & ~rules[-1].column("x")
    remove(left)
    return DecisionList(tuple(rules), default)


def judge(rows: DataFrame, rules: DecisionList, stats: str = "stats", name: str = "quality") -> DataFrame:
    """``rows`` with a struct ``name`` in place of their ``stats``: the counts, ``base_failed`` and ``kept``."""
    failed = base_failed(stats)
    counts = [F.col(f"{stats}.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    verdict = F.struct(*counts, failed.alias("base_failed"), (~failed & rules.column(f"{stats}.rules")).alias("kept"))
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in (name.lower(), stats.lower())],
                       verdict.alias(name))
