"""Licence scans: a generalised suffix automaton over the words of licence templates.

Texts stream through the automaton, which gives, for every word, the longest
stretch ending there that occurs in a template (the matching statistics). Long
maximal matches are chained, per template, along rising text and template
positions; the template's words that a chain covers are its coverage. Every chain
that covers enough is reported, several of a template where they don't overlap,
and a match counts at all its places in a template. Matches have ``min_words``
words at least: a template in which every fourth word is changed has none.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined cases: a null or empty text has no words, no places and score 0; a
null id is returned as it is; repeated rows are scanned each; an empty table gives
an empty result. Texts are scanned whole; a chain may span any part of a text.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtone.llm.bytescan import ALNUM, utf8, word_hashes
from dialtone.llm.common import pieces
from dialtone.llm.licence_texts import PHRASES, TEMPLATES

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in text))


class SuffixAutomaton:
    """All substrings of several word sequences, with all places where each ends in each sequence."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]
        for k, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(k, []).append(at)
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[s]:  # the empty stretch ends everywhere
                up = self.ends[self.link[s]]
                for k, places in self.ends[s].items():
                    up[k] = sorted({*places, *up.get(k, ())})

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def matches(self, words: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, state) of the maximal matches of ``least`` words or more."""
        state, n = 0, 0
        moves, link, length = self.next, self.link, self.length
        for at, word in enumerate(words):
            to = moves[state].get(word)
            if to is None:
                if n >= least:
                    yield at - n, at, state
                while to is None and state:
                    state = link[state]
                    n = length[state]
                    to = moves[state].get(word)
                if to is None:
                    n = 0
                    continue
            state, n = to, n + 1
        if n >= least:
            yield len(words) - n, len(words), state


@dataclass
class Index:
    """Templates and phrases as numbers of words of a common vocabulary."""

    templates: dict[str, tuple[str, str]]
    phrases: dict[str, str]
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.names = list(self.templates)
        sequences = [words_of(text) for _, text in self.templates.values()]
        known = sorted({w for s in (*sequences, *map(words_of, self.phrases)) for w in s})
        data, offsets = utf8(pa.array(known))
        hashes = word_hashes(data, offsets, ALNUM[data])[0]
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)
        number = {w: k for k, w in enumerate(known)}
        self.automaton = SuffixAutomaton([[number[w] for w in s] for s in sequences])
        self.sizes = [len(s) for s in sequences]
        self.labels = [label for label, _ in self.templates.values()]
        self.base = [([number[w] for w in words_of(p)], label) for p, label in self.phrases.items()]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 beyond the vocabulary."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)


def _best_chain(segments: list[tuple], gap: int) -> tuple[int, int, int]:
    """(covered words, start, end) of the best chain of ``segments``, which come by rising end in the text.

    A segment is (start, end) in the text and in the template. Segments follow
    each other when starts and ends rise in both and neither gap is beyond ``gap``
    words; overlaps in the template count once. Of equal chains the first, then the shortest.
    """
    best: list[tuple[int, int]] = []  # covered words, minus the first word of the chain
    for i, (s, e, ts, te) in enumerate(segments):
        value = (te - ts, s)
        for j in range(i - 1, -1, -1):
            ps, pe, pts, pte = segments[j]
            if s - pe > gap:
                break  # so are all before it
            if ps < s and pe < e and pts < ts and pte < te and ts - pte <= gap:
                covered = best[j][0] + te - max(ts, pte)
                if (covered, best[j][1]) > value:
                    value = (covered, best[j][1])
        best.append(value)
    top = max(range(len(segments)), key=lambda i: (best[i][0], -segments[i][1], best[i][1]))
    return best[top][0], best[top][1], segments[top][1]


def chains(segments: list[tuple], gap: int, least: float) -> tuple[int, list[tuple[int, int, int]]]:
    """Covered words of the best chain, and all chains that cover ``least`` words and overlap no better one.

    The best chain of all is taken, then the best ones of what lies before and behind it.
    """
    out, most = [], 0
    waiting = [segments]
    while waiting:
        part = waiting.pop()
        if not part:
            continue
        covered, start, end = _best_chain(part, gap)
        most = max(most, covered)
        if covered >= least:
            out.append((covered, start, end))
            waiting += [[x for x in part if x[1] <= start], [x for x in part if x[0] >= end]]
    return most, sorted(out, key=lambda x: x[1])


def segments_by_template(index: Index, found: list[tuple[int, int, int]]) -> dict[int, list[tuple]]:
    """Matches at all their places in each template, as (start, end, template start, template end)."""
    by = defaultdict(list)
    for start, end, state in found:
        for k, places in index.automaton.ends[state].items():
            by[k] += [(start, end, last + 1 - (end - start), last + 1) for last in places]
    return by


def scan_licences(docs: DataFrame, templates: dict | None = None, phrases: dict | None = None,
                  min_words: int = 4, gap: int = 12, min_coverage: float = 0.6,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_words, places, spans, score).

    ``places``: array<struct<label, start>> of the phrases; ``spans``:
    array<struct<template, label, start, end, covered, coverage>> of chains that
    cover ``min_coverage`` of their template, starts and ends in words;
    ``score``: the largest coverage of any chain, 1 where a phrase stands.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    name = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, phrases)
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield _scan_piece(index, piece, min_words, gap, min_coverage)

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(scan, f"id {name}, n_words bigint, "
                        "places array<struct<label: string, start: bigint>>, "
                        "spans array<struct<template: string, label: string, start: bigint, "
                        "end: bigint, covered: bigint, coverage: double>>, score double")
            .withColumnRenamed("id", id_col))


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_CHAINS = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()),
                              ("start", pa.int64()), ("end", pa.int64()),
                              ("covered", pa.int64()), ("coverage", pa.float64())]))


def _scan_piece(index: Index, piece: pa.RecordBatch, min_words: int, gap: int,
                min_coverage: float) -> pa.RecordBatch:
    data, offsets = utf8(piece.column(1))
    hashes, row, _, _ = word_hashes(data, offsets, ALNUM[data])
    n_rows = len(offsets) - 1
    n_words = np.bincount(row, minlength=n_rows).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(n_words)))
    number = index.lookup(hashes)
    places: list[list] = [[] for _ in range(n_rows)]
    for wanted, label in index.base:
        k = len(wanted)
        if len(number) < k:
            continue
        hit = row[:len(row) - k + 1] == row[k - 1:]
        for j, w in enumerate(wanted):
            hit &= number[j:len(number) - k + 1 + j] == w
        for at in np.flatnonzero(hit).tolist():
            r = int(row[at])
            places[r].append({"label": label, "start": at - int(first[r])})
    spans: list[list] = [[] for _ in range(n_rows)]
    score = np.array([1.0 if p else 0.0 for p in places])
    # stretches of vocabulary words; a match can't reach beyond one
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = row[1:] != row[:-1]
    known = number >= 0
    starts = np.flatnonzero(known & (fresh | ~np.concatenate(([False], known[:-1]))))
    ends = np.flatnonzero(known & np.concatenate((fresh[1:] | ~known[1:], [True]))[:len(row)]) + 1
    found = defaultdict(list)
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a >= min_words:
            r = int(row[a])
            base = a - int(first[r])
            for s, e, state in index.automaton.matches(number[a:b].tolist(), min_words):
                found[r].append((base + s, base + e, state))
    for r, matches in found.items():
        for k, segments in segments_by_template(index, matches).items():
            size = index.sizes[k]
            most, done = chains(segments, gap, min_coverage * size)
            score[r] = max(score[r], most / size)
            spans[r] += [{"template": index.names[k], "label": index.labels[k], "start": s,
                          "end": e, "covered": covered, "coverage": covered / size} for covered, s, e in done]
    return pa.RecordBatch.from_arrays(
        [piece.column(0), pa.array(n_words), pa.array(places, type=_PLACES),
         pa.array(spans, type=_CHAINS), pa.array(np.minimum(score, 1.0))],
        names=["id", "n_words", "places", "spans", "score"])
