"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, scored by context windows.

The lexicon (words and word stems that stand in toxic documents and hardly in
others) and the weights of a small logistic regression are learned from a
bounded sample of labelled rows (``max_sample`` of each label); everything else
covers all documents and whole texts. Words and stems lie in tries: each word of a text is
walked as it is, then through the automaton of all strings within one edit, which
has to read a lexicon word to its end and a stem to any place in the word. A hit counts as abuse, or as quotation where its window holds quotation
marks around it or a word of reported speech.

Defined cases: a null or empty text scores as a text without hits; rows of
``labels`` with a null id or label are left out, of repeated ids the largest
label counts; without labelled rows of both labels, or without any term that
tells them apart, every score is 0.0; a null id is returned as it is; repeated rows are scored each; an
empty table gives an empty result. Other columns are ignored, whatever their names, but for those kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialtone.llm.common import pieces, remove, stored

WORD = re.compile(r"\w+")
STEMS = (4, 5, 6)
FEATURES = ("abuse", "fuzzy", "quoted", "strongest", "density", "terms")
#: Words of reported speech, and quotation marks.
REPORTING = frozenset("""said says saying quote quoted quotes called calls word words term wrote
    dit disait mot cité sagte sagt wort zitat nannte dijo dice palabra llamó cita""".split())
QUOTES = "\"“”„«»‹›"


class Trie:
    """Lexicon terms by character; a node is [children, word or None, stem or None]."""

    def __init__(self, words: Iterable[str], stems: Iterable[str] = (), step: int = 1):
        """``step`` -1 stores the terms from their ends."""
        self.root: list = [{}, None, None]
        for place, terms in ((1, words), (2, stems)):
            for term in terms:
                node = self.root
                for c in term[::step]:
                    node = node[0].setdefault(c, [{}, None, None])
                node[place] = term

    def exact(self, word: str) -> tuple[str | None, str | None]:
        """(the word itself if it is a term, the shortest stem that it begins with)."""
        node, stem = self.root, None
        for c in word:
            node = node[0].get(c)
            if node is None:
                return None, stem
            stem = stem or node[2]
        return node[1], stem

    def within(self, word: str, exact: int, edits: int = 1, place: int = 1) -> str | None:
        """A term that begins with the first ``exact`` characters of ``word`` and is at most
        ``edits`` insertions, deletions or substitutions from it; with ``place`` 2 a stem
        that is so near to a beginning of ``word``.

        Trie and automaton are walked together: the automaton's state is the
        set of (characters of ``word`` read, edits used) with the fewest edits
        for each, and a branch of the trie ends where that set is empty.
        """
        n, node = len(word), self.root
        for c in word[:exact]:
            node = node[0].get(c)
            if node is None:
                return None
        best, term = edits + 1, None
        stack = [(node, [(i, i - exact) for i in range(exact, min(exact + edits, n) + 1)])]
        while stack:
            node, state = stack.pop()
            if node[place] is not None:
                # a word must be read to its end, a stem may be followed by anything
                cost = min((e for i, e in state if place == 2 or i == n), default=best)
                if cost < best:
                    best, term = cost, node[place]
            for c, child in node[0].items():
                after: dict[int, int] = {}
                for i, e in state:  # by rising i
                    if e < edits and e + 1 < after.get(i, best):  # the term has c more
                        after[i] = e + 1
                    if i < n:
                        cost = e if word[i] == c else e + 1
                        if cost <= edits and cost < after.get(i + 1, best):
                            after[i + 1] = cost
                for i in list(after):  # the word has a character more
                    if i < n and after[i] < edits and after[i] + 1 < after.get(i + 1, best):
                        after[i + 1] = after[i] + 1
                if after:
                    stack.append((child, sorted(after.items()) if len(after) > 1 else list(after.items())))
        return term


@dataclass
class Lexicon:
    """Weights of whole words and of stems (beginnings of words).

    ``spelled`` are the words that are also met misspelled; so are stems of
    ``fuzzy_stem`` letters or more.
    """

    words: dict[str, float]
    stems: dict[str, float]
    spelled: list[str] = field(default_factory=list)
    window: int = 6
    fuzzy_stem: int = 5
    cache_size: int = 200_000
    cache: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        fuzzy = [w for w in self.spelled if len(w) >= 5]
        stems = [x for x in self.stems if len(x) >= self.fuzzy_stem]
        self.all = Trie(self.words, self.stems)
        self.forward, self.backward = Trie(fuzzy, stems), Trie(fuzzy, step=-1)
        # one edit leaves a term's first or its last half as it is
        self.halves = {(len(w), w[:len(w) // 2]) for w in fuzzy} | {
            (-len(w), w[len(w) // 2:]) for w in fuzzy}
        self.stem_parts = [(n, n // 2, {x[:n // 2] for x in stems if len(x) == n}, {x[n // 2:] for x in stems if len(x) == n})
                           for n in sorted({len(x) for x in stems})]
        # no term begins otherwise
        self.begun = min([3, *map(len, self.stems)])
        self.starts = {x[:self.begun] for x in (*self.words, *self.stems)}

    def lookup(self, word: str) -> tuple[str, float, bool] | None:
        """(term, weight, misspelled) of a lower-case word."""
        whole, stem = self.all.exact(word) if word[:self.begun] in self.starts else (None, None)
        if whole is not None:
            return whole, self.words[whole], False
        if stem is not None:
            return stem, self.stems[stem], False
        n = len(word)
        for size in (n - 1, n, n + 1):
            half = size // 2
            term = None
            if (size, word[:half]) in self.halves:
                term = self.forward.within(word, half)
            if term is None and (-size, word[half - size:]) in self.halves:
                term = self.backward.within(word[::-1], size - half)
            if term is not None:
                return term, self.words[term], True
        for size, half, first, last in self.stem_parts:
            if n < size - 1:
                break
            stem = self.forward.within(word, half, place=2) if word[:half] in first else None
            # the last half stands one place off where a letter is missing or too many
            if stem is None and (word[half:size] in last or word[half - 1:size - 1] in last or word[half + 1:size + 1] in last):
                stem = self.forward.within(word, 0, place=2)
            if stem is not None:
                return stem, self.stems[stem], True
        return None

    def hits(self, text: str) -> tuple[list, list]:
        """(words, [(place, (term, weight, misspelled))])."""
        words = WORD.findall(text)
        distinct = set(words)
        cache = self.cache
        if len(cache) > self.cache_size:
            cache.clear()
        found = {}
        for w in distinct:
            if w in cache:
                hit = cache[w]
            else:
                hit = cache[w] = self.lookup(w)
            if hit:
                found[w] = hit
        if not found:
            return words, []
        return words, [(i, found[w]) for i, w in enumerate(words) if w in found]

    def features(self, text: str) -> list[float]:
        lowered = text.lower()
        words, hits = self.hits(lowered)
        if not hits:
            return [0.0] * len(FEATURES)
        spans = [m.span() for m in WORD.finditer(lowered)]
        abuse = fuzzy = quoted = 0.0
        for i, (_, weight, misspelled) in hits:
            a, b = max(0, i - self.window), min(len(words), i + self.window + 1)
            before = lowered[spans[a][0]:spans[i][0]]
            after = lowered[spans[i][1]:spans[b - 1][1]]
            marked = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
            if marked or not REPORTING.isdisjoint(words[a:b]):
                quoted += weight
            elif misspelled:
                fuzzy += weight
            else:
                abuse += weight
        terms = {hit[0] for _, hit in hits}
        return [math.log1p(abuse), math.log1p(fuzzy), math.log1p(quoted),
                max(hit[1] for _, hit in hits),
                math.log1p(100 * sum(hit[1] for _, hit in hits) / len(words)), math.log1p(len(terms))]


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float]  # the constant, then one for each of FEATURES
    trained: bool = True

    def score(self, text: str) -> float:
        if not self.trained:
            return 0.0
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.lexicon.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, max_sample: int = 6000,
          min_docs: int = 4, min_share: float = 0.005, min_ratio: float = 20.0) -> Model:
    """Fit a model on labelled documents.

    ``max_sample`` bounds the labelled rows of each label (those with the
    smallest hash of their id). All words and stems that qualify reach the driver: as each
    stands in ``min_share`` of the toxic documents, they are 1 / ``min_share`` times the
    different words of one document at most, however large the corpus. A term stands in ``min_docs`` toxic documents and ``min_share`` of them at
    least, and is ``min_ratio`` times as frequent there as in the others.
    Words and stems of five letters or more are also met misspelled.
    """
    usable = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id"))))
    chosen = None
    for value in (1, 0):
        part = (usable.where(F.col("toxic") == value).select("doc_id", "toxic")
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * max_sample rows of two numbers
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "sample")

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        remove(sample)
        return Model(Lexicon({}, {}), [0.0] * (len(FEATURES) + 1), trained=False)
    counts = (sample.select("toxic", "text").mapInArrow(
        _count_features, "stem boolean, feature string, toxic bigint, clean bigint")
        .groupBy("stem", "feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    ratio = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    ranked = counts.where((F.col("toxic") >= max(min_docs, min_share * n_toxic)) & (ratio >= min_ratio)).withColumn("ratio", ratio)
    words, stems = ({r["feature"]: (r["toxic"], r["ratio"]) for r in
                     ranked.where(F.col("stem") == stem).orderBy(F.desc("toxic"), F.desc("ratio"), "feature").collect()}
                    for stem in (False, True))
    lexicon = _lexicon(words, stems)
    if not lexicon.words and not lexicon.stems:
        remove(sample)
        return Model(lexicon, [0.0] * (len(FEATURES) + 1), trained=False)
    rows = sample.select("toxic", "text").mapInArrow(
        _feature_rows(lexicon), "toxic int, features array<double>").collect()
    remove(sample)
    x = np.array([r["features"] for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    return Model(lexicon, _fit(x, y).tolist())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (the id alone unless named) and ``toxic_score`` of every row."""
    keep = [id_col] if keep is None else keep
    at = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "scored_text"):
                texts = piece.column(len(keep)).to_pylist()
                scores = pa.array([model.score(t or "") for t in texts], type=pa.float64())
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], scores],
                                                 names=[*at, "toxic_score"])

    narrow = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, at)],
                         F.col(f"`{text_col}`").alias("scored_text"))
    schema = T.StructType([T.StructField(a, docs.schema[c].dataType) for c, a in zip(keep, at)]
                          + [T.StructField("toxic_score", T.DoubleType())])
    done = narrow.mapInArrow(run, schema)
    return done.select(*[F.col(a).alias(c) for c, a in zip(keep, at)], "toxic_score")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word, or a word with that beginning."""
    tally = {k: (Counter(), Counter()) for k in (False, True)}
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = {w for w in WORD.findall((text or "").lower()) if len(w) >= 4 and not w.isdigit()}
            kind = 0 if label == 1 else 1
            tally[False][kind].update(words)
            tally[True][kind].update({w[:k] for w in words for k in STEMS if len(w) >= k})
    for stem, (toxic, clean) in tally.items():
        features = list(toxic.keys())  # those that no toxic document holds can't enter the lexicon
        for a in range(0, len(features), 50_000):
            part = features[a:a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([stem] * len(part)), pa.array(part, type=pa.string()),
                 pa.array([toxic[f] for f in part], type=pa.int64()),
                 pa.array([clean[f] for f in part], type=pa.int64())],
                names=["stem", "feature", "toxic", "clean"])


def _lexicon(words: dict, stems: dict) -> Lexicon:
    """Stems that many words share, without their own longer ones; words that no stem covers."""
    kept: dict[str, float] = {}
    top = defaultdict(int)
    for w, (n, _) in words.items():
        for k in STEMS:
            top[w[:k]] = max(top[w[:k]], n)
    for stem in sorted(stems, key=lambda s: (len(s), s)):
        n, ratio = stems[stem]
        if any(stem[:k] in kept for k in STEMS if k < len(stem)):
            continue
        if n >= 2 * max(1, top[stem]):  # else it is one word's beginning
            kept[stem] = math.log(ratio)
    own = {w: math.log(ratio) for w, (_, ratio) in words.items()
           if not any(w[:k] in kept for k in STEMS)}
    return Lexicon(own, kept, sorted(own))


def _feature_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [lexicon.features(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array(rows, type=pa.list_(pa.float64()))],
                names=["toxic", "features"])
    return run


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's steps, both labels of equal weight in all."""
    x = np.hstack([np.ones((len(x), 1)), x])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w
