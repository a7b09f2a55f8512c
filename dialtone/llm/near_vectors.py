"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosines.

Vectors are scaled to length one; ``tables`` groups of ``width`` random normal
projections, shifted and cut into steps of ``step``, give one bucket each.
Vectors of a label that share a bucket are compared by cosine in double
precision. For unit vectors a cosine of 0.98 is a distance of 0.2; with the
defaults such a pair meets in some table with probability 0.9998, closer ones
sooner, unrelated ones with about 0.0004.

Equal vectors of a label are one class from the start. Buckets of any size are
compared whole: a large one is cut into tiles by hash, every pair of tiles is a
group of its own, and a group returns sums for its vectors, never its pairs. A
pair that shares several buckets counts in the first of them only.

Defined cases: vectors with a null label, null, empty or zero vectors and those
that hold a null or a non-finite number link with nothing; vectors of different
lengths don't link; rows that share an id count once, the smallest label and
vector standing for them; rows with a null id are left out; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtone.llm.bytescan import mix
from dialtone.llm.common import connected_components, stored

TILE = 512


def _normal(shape: tuple[int, ...], seed: int) -> np.ndarray:
    """Standard normal numbers that depend on nothing but shape and seed."""
    n = int(np.prod(shape))
    at = np.arange(2 * n, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    u = (mix(mix(at)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return (np.sqrt(-2 * np.log(u[:n] + 2.0**-54)) * np.cos(2 * np.pi * u[n:])).reshape(shape)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def signatures(vectors: np.ndarray, tables: int, width: int, step: float, seed: int) -> np.ndarray:
    """A 64-bit bucket for every vector and table."""
    dim = vectors.shape[1]
    planes = _normal((dim, tables * width), seed)
    shift = (_normal((tables * width,), seed + 1) * 7919.0 % 1.0) * step
    cells = np.floor((_unit(vectors) @ planes + shift) / step).astype(np.int64).astype(np.uint64)
    out = np.full((len(vectors), tables), dim, dtype=np.uint64)
    cells = cells.reshape(len(vectors), tables, width)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return mix(out + np.arange(tables, dtype=np.uint64)).astype(np.int64)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the lists of each length."""
    lengths = np.asarray(column.value_lengths())
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.reshape(len(rows), n)


def near_vectors(vectors: DataFrame, min_cosine: float = 0.98, tables: int = 32, width: int = 10,
                 step: float = 1.2, seed: int = 29, tile: int = TILE, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept)."""
    named = (vectors.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.struct(F.col(label_col).alias("label"),
                                                         F.col(vector_col).alias("vector")).alias("row"))
             .groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    usable = (F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
              & F.exists("vector", lambda x: x != 0))
    whole = stored(named.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")

    # classes of equal vectors, told apart by 128 bits of hash
    key = ["label", "h1", "h2"]
    hashed = whole.where("usable").withColumns(
        {"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    classes = hashed.groupBy(*key).agg(F.min("id").alias("cls"), F.count("*").alias("size"))
    member = stored(hashed.select("id", *key).join(classes, key).select("id", "cls", "size"), "vector-classes")

    one = member.where("id = cls").select("cls", "size").join(
        whole.select(F.col("id").alias("cls"), "label", "vector"), "cls")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets: list = [None] * batch.num_rows
            for rows, matrix in _by_length(batch.column(3)):
                for r, s in zip(rows.tolist(), signatures(matrix, tables, width, step, seed)):
                    buckets[r] = s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(buckets, type=pa.list_(pa.int64()))],
                names=["cls", "size", "label", "vector", "buckets"])

    kind = dict(whole.dtypes)
    signed = stored(one.mapInArrow(
        sign, f"cls {kind['id']}, size bigint, label {kind['label']}, vector {kind['vector']}, "
              "buckets array<bigint>"), "vector-buckets")

    # buckets with several classes; only their members carry their vectors on
    placed = signed.select("cls", F.posexplode("buckets").alias("nr", "bucket"), "label").select(
        "cls", "nr", F.xxhash64("bucket", "label").alias("bucket"))
    crowded = placed.groupBy("nr", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")
    spread = (placed.join(crowded, ["nr", "bucket"]).withColumn("tiles", tiles).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .select("nr", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                      "own", "cls"))
    rows = spread.join(signed, "cls").select("nr", "bucket", "a", "b", "label", "own", "cls", "size", "vector", "buckets")
    keys = ["nr", "bucket", "a", "b"]
    groups = rows.repartition(*keys).sortWithinPartitions(*keys, "cls")
    found = stored(groups.mapInArrow(
        _compare_groups(min_cosine), f"cls {kind['id']}, links bigint, root {kind['id']}"), "vector-links")

    edges = found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b"))
    component = connected_components(edges)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    done = (member.join(links, "cls", "left")
            .join(component.withColumnRenamed("node", "cls"), "cls", "left")
            .select("id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                    F.coalesce("component", "cls").alias("component_id")))
    alone = whole.where("not usable").select("id", F.lit(0).cast("bigint").alias("n_links"),
                                             F.col("id").alias("component_id"))
    return (done.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id"))
            .withColumnRenamed("id", id_col))


def _compare_groups(min_cosine: float):
    """Compare the rows of each group; rows come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            bounds = _group_bounds(now)
            rest = now.slice(bounds[-2])
            if len(bounds) > 2:
                yield from _compared(now.slice(0, bounds[-2]).combine_chunks(), bounds[:-1], min_cosine)
        if rest is not None and rest.num_rows:
            yield from _compared(rest.combine_chunks(), [0, rest.num_rows], min_cosine)

    return run


def _group_bounds(rows: pa.Table) -> list[int]:
    """Where groups start, and the number of rows."""
    n = rows.num_rows
    if not n:
        return [0, 0]
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for name in ("nr", "bucket", "a", "b"):
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return [*np.flatnonzero(new).tolist(), n]


def _compared(rows: pa.Table, bounds: list[int], min_cosine: float) -> Iterator[pa.RecordBatch]:
    nr, own = rows.column("nr").to_numpy(), rows.column("own").to_numpy()
    a, b = rows.column("a").to_numpy(), rows.column("b").to_numpy()
    cls, size = rows.column("cls").to_numpy(), rows.column("size").to_numpy()
    out: list[tuple[np.ndarray, ...]] = []
    for at, to in zip(bounds, bounds[1:]):
        if to - at < 2:
            continue
        part = rows.slice(at, to - at)
        lists = part.column("vector").combine_chunks()
        lengths = np.asarray(lists.value_lengths())
        if (lengths != lengths[0]).any():  # hashes of different lengths that are equal by chance
            continue
        x = _unit(lists.flatten().to_numpy(zero_copy_only=False).reshape(to - at, -1))
        labels = part.column("label").to_numpy()
        buckets = part.column("buckets").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(to - at, -1)
        near = (x @ x.T >= min_cosine) & (labels[:, None] == labels[None, :])
        np.fill_diagonal(near, False)
        if a[at] != b[at]:
            near &= own[at:to, None] != own[None, at:to]
        for k in range(int(nr[at])):  # counted in an earlier table
            if not near.any():
                break
            near &= buckets[:, None, k] != buckets[None, :, k]
        hit = np.flatnonzero(near.any(axis=1))
        if not len(hit):
            continue
        near = near[np.ix_(hit, hit)]
        root = np.arange(len(hit))
        while True:  # smallest place within reach
            low = np.minimum(root, np.where(near, root[None, :], len(hit)).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        ids = cls[at:to][hit]
        out.append((ids, near.astype(np.int64) @ size[at:to][hit], ids[root]))
        if len(out) >= 256:
            yield _links(out)
            out = []
    if out:
        yield _links(out)


def _links(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    ids, links, roots = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(roots)],
                                      names=["cls", "links", "root"])
