"""N-gram Jaccard join with a prefix tree.

A document's set holds its distinct word shingles (64-bit hashes). Two
documents link when the Jaccard similarity of their sets is ``percent`` / 100 or
more; the result is exact up to collisions of 64-bit hashes within a pair.

1. Equal sets are one class from the start.
2. If two sets link, their lowest-hashed beginnings share a known number of
   shingles. A class that shares fewer with all others links with nothing;
   most classes end here, after one shuffle of a third of the shingles.
3. The sets that remain are ordered by the shingles' document frequency, rarest
   first. Linked sets share a shingle of their beginnings in this order, so the
   components of "shares such a shingle" are blocks that hold every link.
4. Each block is cut into tiles by hash; for every pair of tiles the sets of one
   are stored in a prefix tree and those of the other traverse it. Sets with a
   common beginning share the overlap counted so far, and a subtree is left
   when the lengths that remain can't reach the overlap that is needed.
5. Links join classes to components.

No block is dropped, capped or sampled: a large block gives more tiles, and a
task holds two tiles at most. A group returns a row for each of its sets that
has links, never its pairs.

Defined cases: a null or empty text has an empty set and links with nothing; a
text with fewer words than a shingle has the whole sequence as its one shingle;
rows with a null id are left out; rows that share an id count once, the text
with the smallest digest standing for them; an empty table gives an empty
result. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.llm.bytescan import SPACE, mix, utf8, word_hashes
from dialtone.llm.common import connected_components, pieces, remove, scratch, stored

TILE = 512
EDGE = 64  # longest edge of a tree, so that long tails can be left early
#: Beyond the necessary beginning of a set, one in so many of its shingles is looked at.
EXTRA = 12


# ---- shingles -------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; empty where it has no words."""
    hashes, row, _, _ = word_hashes(data, offsets, ~SPACE[data])
    n_rows = len(offsets) - 1
    counts = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))
    weights = mix(np.arange(101, 101 + size, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        whole += hashes[k:k + len(whole)] * weights[k]
    whole = mix(whole)
    out = []
    for r in range(n_rows):
        at, n = int(first[r]), int(counts[r])
        if n >= size:
            out.append(np.unique(whole[at:at + n - size + 1]))
        elif n:
            short = (hashes[at:at + n] * weights[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix(np.array([short], dtype=np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return (int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            yield piece, shingle_sets(*utf8(piece.column(piece.schema.get_field_index("text"))), size)


# ---- bounds ---------------------------------------------------------------

def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` shares at least with any set that it links with."""
    return -(-n * percent // 100)


def _extra(n):
    return np.maximum(1, -(-n // EXTRA))


def _beginning(n: int, percent: int) -> int:
    """So many lowest hashes hold ``_extra(n)`` of those shared with any linked set."""
    return int(n - least_overlap(n, percent) + _extra(n))


def _shared_needed(n: Column, percent: int) -> Column:
    """``_extra`` of the smallest size that can link with ``n``."""
    least = F.floor((n * percent + 99) / 100)
    return F.greatest(F.lit(1), F.floor((least + EXTRA - 1) / EXTRA))


# ---- step 2 ---------------------------------------------------------------

def _postings(size: int, percent: int):
    """Rows (shingle, cls, count) of the beginnings: a shingle of one class of the piece; a shingle
    of several, once, with a null class; and a class with the count of its shingles of the latter kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, size):
            by_class = {_digest(s)[0]: s[:_beginning(len(s), percent)] for s in sets if len(s)}
            if not by_class:
                continue
            classes = np.fromiter(by_class, dtype=np.int64, count=len(by_class))
            lengths = np.array([len(s) for s in by_class.values()])
            shingles = np.concatenate(list(by_class.values())).view(np.int64)
            owner = np.repeat(np.arange(len(classes)), lengths)
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], owner[order]
            same = np.zeros(len(shingles) + 1, dtype=bool)
            same[1:-1] = shingles[1:] == shingles[:-1]
            several = same[1:] | same[:-1]
            once = several & ~same[:-1]
            local = np.bincount(owner[several], minlength=len(classes))
            counted = np.flatnonzero(local)
            single = ~several
            n = (int(single.sum()), int(once.sum()), len(counted))
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(shingles[single]), pa.array(shingles[once]), pa.array(classes[counted])]),
                pa.concat_arrays([pa.array(classes[owner[single]]), pa.nulls(n[1], pa.int64()),
                                  pa.array(classes[counted])]),
                pa.concat_arrays([pa.nulls(n[0] + n[1], pa.int32()), pa.array(local[counted].astype(np.int32))]),
            ], names=["shingle", "cls", "n"])

    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, n): shingles that a class shares with another one. Rows come sorted by shingle and class."""
    rest = None
    for batch in batches:
        n = batch.column(2)
        counts = np.asarray(n.fill_null(0)) if n.null_count else np.asarray(n)
        is_count = np.asarray(n.is_valid())
        cls = batch.column(1)
        known = np.asarray(cls.is_valid())
        shingle, cls = np.asarray(batch.column(0)), np.asarray(cls.fill_null(0))
        if is_count.any():
            yield _class_counts(cls[is_count], counts[is_count])
        rows = (shingle[~is_count], cls[~is_count], known[~is_count])
        if rest is not None:
            rows = tuple(np.concatenate(x) for x in zip(rest, rows))
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last shingle may go on in the next batch
        rest = tuple(x[last:] for x in rows)
        done = _shared(*(x[:last] for x in rows))
        if done is not None:
            yield done
    if rest is not None:
        done = _shared(*rest)
        if done is not None:
            yield done


def _shared(shingle: np.ndarray, cls: np.ndarray, known: np.ndarray) -> pa.RecordBatch | None:
    if not len(shingle):
        return None
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = shingle[1:] != shingle[:-1]
    other = new.copy()
    other[1:] |= (cls[1:] != cls[:-1]) | (known[1:] != known[:-1])
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    # two classes, or the mark of a piece that had several
    several = (np.add.reduceat(other.astype(np.int64), starts) > 1) | ~np.minimum.reduceat(known, starts)
    hit = several[group] & known & other
    return _class_counts(cls[hit], np.ones(int(hit.sum()), dtype=np.int64)) if hit.any() else None


def _class_counts(cls: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    ids, at = np.unique(cls, return_inverse=True)
    total = np.bincount(at, weights=n, minlength=len(ids)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["cls", "n"])


# ---- step 4: the prefix tree ----------------------------------------------

class PrefixTree:
    """Rising sequences of numbers, stored so that common beginnings are held once.

    Nodes lie level by level; the children of a node are neighbours. A node has
    the numbers of its edge, the sizes of the smallest and largest set below it,
    and the longest tail that can follow.
    """

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sequences)), key=lambda i: sequences[i].tolist())
        ordered = [sequences[i] for i in order]
        common = [0] * len(ordered)
        for i in range(1, len(ordered)):
            a, b = ordered[i - 1], ordered[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common[i] = int(differ[0]) if len(differ) else n
        sizes = np.asarray(sizes)[order]
        lengths = [len(s) for s in ordered]
        self.levels: list[dict[str, np.ndarray]] = []
        level = self._children(0, len(ordered), 0, common, lengths) if ordered else []
        while level:
            below, counts, edges, leaves, bounds = [], [], [], [], []
            for lo, hi, start, end, full in level:
                edges.append(ordered[lo][start:end])
                bounds.append((sizes[lo:hi].min(), sizes[lo:hi].max(), max(lengths[lo:hi]) - end))
                if end < full:  # the rest of a long edge
                    own = [(lo, hi, end, min(full, end + EDGE), full)]
                elif hi - lo == 1 and lengths[lo] == end:
                    own = []
                else:
                    own = self._children(lo, hi, end, common, lengths)
                leaves.append(order[lo] if not own else -1)
                counts.append(len(own))
                below += own
            size = np.array([len(e) for e in edges])
            ends = np.cumsum(counts)
            smallest, largest, tail = (np.array(x) for x in zip(*bounds))
            self.levels.append({
                "numbers": np.concatenate(edges), "from": np.cumsum(size) - size, "size": size,
                "last": np.array([e[-1] if len(e) else -1 for e in edges]), "leaf": np.array(leaves),
                "smallest": smallest, "largest": largest, "tail": tail,
                "child": ends - counts, "children": np.array(counts)})
            level = below

    @staticmethod
    def _children(lo: int, hi: int, depth: int, common: list[int], lengths: list[int]) -> list[tuple]:
        """Nodes below ``depth`` of the sequences lo..hi, which agree up to it: (lo, hi, start, end, full end)."""
        cuts = [lo, *(i for i in range(lo + 1, hi) if common[i] <= depth), hi]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            full = lengths[a] if b - a == 1 else min(lengths[a], min(common[a + 1:b]))
            out.append((a, b, depth, min(full, depth + EDGE), full))
        return out

    def linked(self, probe: np.ndarray, n: int, marks: np.ndarray, percent: int) -> np.ndarray:
        """Places of the sets that link with a set of ``n`` members, ``probe`` those that others have too.

        ``marks`` is all False, as long as there are numbers; it is so again afterwards.
        """
        marks[probe] = True
        found, nodes, above = [], None, None
        for level in self.levels:
            if nodes is None:
                nodes, above = np.arange(len(level["leaf"])), np.zeros(len(level["leaf"]), dtype=np.int64)
            smallest, largest = level["smallest"][nodes], level["largest"][nodes]
            fits = (100 * largest >= percent * n) & (percent * smallest <= 100 * n)
            nodes, above, smallest = nodes[fits], above[fits], smallest[fits]
            if not len(nodes):
                break
            size = level["size"][nodes]
            ends = np.cumsum(size)
            at = np.arange(int(ends[-1])) + np.repeat(level["from"][nodes] - (ends - size), size)
            upto = np.concatenate(([0], np.cumsum(marks[level["numbers"][at]])))
            overlap = above + upto[ends] - upto[ends - size]
            ahead = len(probe) - np.searchsorted(probe, level["last"][nodes], side="right")
            needed = -(-percent * (n + smallest) // (100 + percent))
            alive = overlap + np.minimum(ahead, level["tail"][nodes]) >= needed
            nodes, overlap = nodes[alive], overlap[alive]
            leaf = level["leaf"][nodes]
            found.append(leaf[leaf >= 0])  # smallest is the set's own size there, so the bound is exact
            children = level["children"][nodes]
            ends = np.cumsum(children)
            if not len(ends) or not ends[-1]:
                break
            above = np.repeat(overlap, children)
            nodes = np.arange(int(ends[-1])) + np.repeat(level["child"][nodes] - (ends - children), children)
        marks[probe] = False
        return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def _join_tiles(percent: int):
    """Links of each group; rows come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            keys = [now.column(k).to_numpy() for k in ("block", "a", "b")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            bounds = [0, *new.tolist()]
            for at, to in zip(bounds, bounds[1:]):
                yield from _join_group(now.slice(at, to - at).combine_chunks(), percent)
            rest = now.slice(bounds[-1])
        if rest is not None and rest.num_rows:
            yield from _join_group(rest.combine_chunks(), percent)

    return run


def _join_group(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    cls, sizes, weight = (rows.column(c).to_numpy() for c in ("cls", "n", "copies"))
    own, a, b = (rows.column(c).to_numpy() for c in ("own", "a", "b"))
    lists = rows.column("ranked").combine_chunks()
    members = lists.flatten()
    frequency, shingle = (np.asarray(members.field(i)) for i in (0, 1))
    order = np.lexsort((shingle, frequency))
    sorted_shingle, sorted_frequency = shingle[order], frequency[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_shingle[1:] != sorted_shingle[:-1]) | (sorted_frequency[1:] != sorted_frequency[:-1])
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    bounds = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
    sets = [number[x:y] for x, y in zip(bounds, bounds[1:])]
    marks = np.zeros(int(new.sum()), dtype=bool)
    crossing = a[0] != b[0]
    inside = np.flatnonzero(own == a[0]) if crossing else np.arange(len(cls))
    probes = np.flatnonzero(own == b[0]) if crossing else inside
    tree = PrefixTree([sets[i] for i in inside], sizes[inside])
    links = np.zeros(len(cls), dtype=np.int64)
    up = np.arange(len(cls))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    for i in probes.tolist():
        found = inside[tree.linked(sets[i], int(sizes[i]), marks, percent)]
        found = found[found != i]
        if not len(found):
            continue
        links[i] += int(weight[found].sum())
        if crossing:
            links[found] += weight[i]
        for j in set(up[found].tolist()):
            x, y = top(i), top(j)
            if x != y:
                x, y = (x, y) if cls[x] < cls[y] else (y, x)
                up[y] = x
    hit = np.flatnonzero(links)
    if len(hit):
        roots = np.array([cls[top(i)] for i in hit.tolist()])
        yield pa.RecordBatch.from_arrays([pa.array(cls[hit]), pa.array(links[hit]), pa.array(roots)],
                                         names=["cls", "links", "root"])


# ---- the operator ---------------------------------------------------------

def ngram_join(docs: DataFrame, size: int = 5, percent: int = 75, tile: int = TILE,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_shingles, component_id, n_links).

    ``n_links`` counts the other documents linked directly.
    """
    with scratch(docs.sparkSession) as keep:
        return _ngram_join(docs, size, percent, tile, id_col, text_col, keep)


def _ngram_join(docs: DataFrame, size: int, percent: int, tile: int, id_col: str, text_col: str,
                keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["id"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, size):
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(s) for s in sets], type=pa.int64()),
                 pa.array([d[0] for d in digests], type=pa.int64()),
                 pa.array([d[1] for d in digests], type=pa.int64())], names=["id", "n", "d1", "d2"])

    described = keep(stored(
        texts.mapInArrow(describe, f"id {kind}, n bigint, d1 bigint, d2 bigint")
        .groupBy("id").agg(F.min(F.struct("d1", "d2", "n")).alias("one"))
        .select("id", "one.n", "one.d1", "one.d2"), "ngram-sets"))
    classes = (described.where("n > 0").groupBy("d1", "d2")
               .agg(F.min("id").alias("cls"), F.count("*").alias("copies"), F.min("n").alias("n")))

    # step 2
    postings = texts.select("text").mapInArrow(_postings(size, percent), "shingle bigint, cls bigint, n int")
    shared = (postings.repartition("shingle").sortWithinPartitions("shingle", "cls")
              .mapInArrow(_count_shared, "cls bigint, n bigint")
              .groupBy(F.col("cls").alias("d1")).agg(F.sum("n").alias("shared")))
    alive = stored(classes.join(shared, "d1").where(F.col("shared") >= _shared_needed(F.col("n"), percent))
                   .select("cls", "d1", "d2", "n", "copies"), "ngram-alive")

    # step 3
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, size):
            wanted = zip(*(piece.column(c).to_pylist() for c in ("d1", "d2")))
            keep = [i for i, (s, d) in enumerate(zip(sets, wanted)) if _digest(s) == d]
            if keep:
                part = piece.select(["cls", "n", "copies"]).take(pa.array(keep))
                flat = np.concatenate([sets[i] for i in keep]).view(np.int64)
                ends = np.concatenate(([0], np.cumsum([len(sets[i]) for i in keep]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["cls", "n", "copies", "shingles"])

    sets = stored(
        # sorted and merged at every size: these classes grow with the documents
        texts.join(alive.withColumnRenamed("cls", "id").hint("merge"), "id").select(
            F.col("id").alias("cls"), "n", "copies", "d1", "d2", "text")
        .mapInArrow(tokens, f"cls {kind}, n bigint, copies bigint, shingles array<bigint>")
        .dropDuplicates(["cls"]), "ngram-shingles")
    single = sets.select("cls", "n", "copies", F.explode("shingles").alias("shingle"))
    frequency = single.groupBy("shingle").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    beginning = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    ranked = stored(
        single.join(frequency, "shingle").groupBy("cls", "n", "copies")
        .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"))
        # the shingles of one class only are the rarest, so they come first
        .withColumn("open", (beginning - (F.col("n") - F.size("ranked"))).cast("int")).where("open > 0"),
        "ngram-ranked")
    remove(sets)
    first = ranked.select("cls", F.explode(F.slice("ranked", F.lit(1), F.col("open"))).alias("x")).select(
        "cls", F.col("x.shingle").alias("shingle"))
    lowest = first.groupBy("shingle").agg(F.min("cls").alias("low"), F.count("*").alias("n")).where("n > 1")
    near = first.join(lowest, "shingle").where("cls <> low").select(
        F.col("cls").alias("a"), F.col("low").alias("b")).distinct()
    with scratch(docs.sparkSession) as keep_blocks:
        blocks = keep_blocks(stored(connected_components(near).select(
            F.col("node").alias("cls"), F.col("component").alias("block")), "ngram-blocks"))

    # step 4
    tiles = blocks.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    placed = (blocks.join(tiles, "block")
              .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .select("block", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "cls"))
    keys = ["block", "a", "b"]
    groups = (placed.join(ranked.select("cls", "n", "copies", "ranked"), "cls")
              .select(*keys, "own", "cls", "n", "copies", "ranked").repartition(*keys).sortWithinPartitions(*keys, "cls"))
    found = keep(stored(groups.mapInArrow(_join_tiles(percent), f"cls {kind}, links bigint, root {kind}"), "ngram-links"))

    # step 5
    component = keep(connected_components(
        found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b"))))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    member = described.join(classes.select("d1", "d2", "cls", "copies"), ["d1", "d2"], "left")
    return (member.join(links, "cls", "left").join(component.withColumnRenamed("node", "cls"), "cls", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "cls", "id").alias("component_id"),
                    F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links")))
