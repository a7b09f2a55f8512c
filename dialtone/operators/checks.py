"""Integrity rules of the source schema, re-aimed as data checks on DataFrames.

The original enforces uniqueness, foreign keys and delete propagation in
the database at write time. Here they are batch checks and batch
corrections: each returns a DataFrame, computed with aggregates and
semi/anti joins (shuffle joins on the key; no driver-side sets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (``UNIQUE (keys)``).

    A row with a NULL in any key column never violates uniqueness, as in SQL.
    """
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return (df.filter(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (``left_anti``)."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return (child.filter(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("_pk"), "left_anti"))


def apply_cascade(child: DataFrame, deleted_parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children that remain after their parents are deleted with ``ON DELETE CASCADE``."""
    gone = deleted_parents.select(F.col(pk).alias("_pk")).distinct()
    return child.join(gone, F.col(fk) == F.col("_pk"), "left_anti")


def apply_set_null(child: DataFrame, deleted_parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children after ``ON DELETE SET NULL``: the key of a deleted parent becomes NULL.

    A semi-join marks the affected rows (no row multiplication even if the
    deleted set repeats a key), then the key is nulled in place.
    """
    gone = deleted_parents.select(F.col(pk).alias("_pk")).distinct().withColumn("_gone", F.lit(True))
    j = child.join(gone, F.col(fk) == F.col("_pk"), "left")
    cols = [F.when(F.col("_gone"), F.lit(None).cast(child.schema[fk].dataType))
            .otherwise(F.col(fk)).alias(fk) if c == fk else F.col(c) for c in child.columns]
    return j.select(*cols)


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``rows`` and ``nulls_<col>`` for each column that must not be NULL."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def not_null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols`` (``NOT NULL`` constraints)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def primary_key_faults(df: DataFrame, key: str) -> DataFrame:
    """One row: ``rows``, ``nulls`` (rows without a key) and ``repeated`` (rows whose key another row has too)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), zero).alias("nulls"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n"))), zero).alias("repeated"))


def _parents_first(tables: list[str], edges) -> list[str]:
    order: list[str] = []
    waiting = list(tables)
    while waiting:
        free = [t for t in waiting if not any(child == t and parent in waiting for child, _, parent, _, _ in edges if parent != t)]
        if not free:
            raise ValueError(f"the foreign keys of {waiting} form a cycle")
        order += free
        waiting = [t for t in waiting if t not in free]
    return order


def propagate(tables: dict[str, DataFrame], edges, primary_keys: dict[str, str],
              deleted: dict[str, DataFrame] | None = None, changed: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables after rows were deleted and keys changed, carried along all foreign keys.

    ``edges`` are (child, column, parent, parent column, "cascade" or "set null" on
    delete); changed keys are always carried on. ``deleted`` has, by table, a
    DataFrame of primary keys (its first column); ``changed`` one of old and new
    primary keys (its first two columns). Keys that don't occur have no effect; of
    a key that is deleted and changed, the deletion counts. Tables are done
    parents first, so that a deletion goes on to the children of children. A
    child is joined to the keys that vanish or change, never to the whole parent.
    """
    deleted, changed = deleted or {}, changed or {}
    edges = [e for e in edges if e[0] in tables and e[2] in tables]
    done: dict[str, DataFrame] = {}
    for name in _parents_first(list(tables), edges):
        columns = tables[name].columns
        df = tables[name].select("*", *[F.col(x).alias(f"_old_{x}") for x in columns], F.lit(False).alias("_gone"))
        if name in deleted:
            keys = deleted[name].select(F.col(deleted[name].columns[0]).alias("_k")).distinct().withColumn("_hit", F.lit(True))
            df = (df.join(keys, F.col(primary_keys[name]) == F.col("_k"), "left")
                  .withColumn("_gone", F.coalesce("_hit", F.lit(False))).drop("_k", "_hit"))
        if name in changed:
            old, new = changed[name].columns[:2]
            keys = (changed[name].select(F.col(old).alias("_k"), F.col(new).alias("_new")).where("_new is not null")
                    .groupBy("_k").agg(F.min("_new").alias("_new")))
            pk = primary_keys[name]
            df = (df.join(keys, F.col(f"_old_{pk}") == F.col("_k"), "left")
                  .withColumn(pk, F.coalesce("_new", pk).cast(tables[name].schema[pk].dataType)).drop("_k", "_new"))
        for _, column, parent, key, on_delete in (e for e in edges if e[0] == name):
            above = done[parent]
            # a key is gone with its last row; of several rows with one key any new value is as good
            effect = (above.where(F.col(f"_old_{key}").isNotNull()).groupBy(F.col(f"_old_{key}").alias("_k"))
                      .agg(F.min("_gone").alias("_lost"), F.max(F.when(~F.col("_gone"), F.col(key))).alias("_new"))
                      .where("_lost or not _k <=> _new"))
            kept = F.coalesce("_new", f"_old_{column}") if column != primary_keys[name] else F.coalesce("_new", column)
            df = df.join(effect, F.col(f"_old_{column}") == F.col("_k"), "left")
            lost = F.coalesce("_lost", F.lit(False))
            if on_delete == "cascade":
                df = df.withColumn("_gone", F.col("_gone") | lost)
                value = kept
            else:
                value = F.when(~lost, kept)
            df = df.withColumn(column, value.cast(tables[name].schema[column].dataType)).drop("_k", "_lost", "_new")
        done[name] = df
    return {name: df.where(~F.col("_gone")).select(*tables[name].columns) for name, df in done.items()}
