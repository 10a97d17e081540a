"""Keyed writes: insert-ignore, overwrite and coalesce upserts.

A batch is first collapsed to one row per key, which has the same effect as applying
its rows one after the other, and then joined to the target. Both sides of the join
are unique on the key, so no key can be hot there; the collapse itself prunes every
map partition to one row per key before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.schemas import COALESCE, INSERT_IGNORE, TableSpec

ACTION = "merge_action"
ACTIONS = ("inserted", "updated", "kept")


def pick_row(batch: DataFrame, key: list[str], sequence: list[str], last: bool = True) -> DataFrame:
    """The last (or first) whole row of every key in ``sequence`` order."""
    order = [F.col(c).desc() if last else F.col(c).asc() for c in sequence]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return batch.withColumn("_place", place).filter("_place = 1").drop("_place")


def pick_values(batch: DataFrame, key: list[str], sequence: list[str], columns: list[str]) -> DataFrame:
    """Per key and per column, the last value that is not null in ``sequence`` order."""
    moment = F.struct(*sequence)
    return batch.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), moment)).alias(c) for c in columns]
    )


def collapse(batch: DataFrame, spec: TableSpec, sequence: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per key, as the policy of the table would leave it."""
    key, columns = list(spec.key), list(columns or spec.listed)
    slim = batch.select(*dict.fromkeys([*key, *columns, *sequence]))
    if spec.policy == COALESCE:
        return pick_values(slim, key, sequence, columns)
    return pick_row(slim, key, sequence, last=spec.policy != INSERT_IGNORE).select(*key, *columns)


def _as_table_rows(rows: DataFrame, spec: TableSpec, run_ts: Column) -> DataFrame:
    """Shape collapsed rows like the table: listed columns, time stamps, nulls elsewhere."""
    present = set(rows.columns)
    return rows.select(
        *[
            run_ts.cast(f.dataType).alias(f.name)
            if f.name in spec.stamps
            else F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spec.schema
        ]
    )


def as_inserts(batch: DataFrame, spec: TableSpec, sequence: list[str], run_ts: Column) -> DataFrame:
    """Table rows of a batch whose keys are known to be absent from the target.

    The work lists give such batches, so their writer appends and leaves the
    (much larger) target unread.
    """
    return _as_table_rows(collapse(batch, spec, sequence), spec, run_ts)


def insert_ignore(
    target: DataFrame, batch: DataFrame, spec: TableSpec, sequence: list[str], run_ts: Column
) -> DataFrame:
    """Only the rows to add: the first row of each key the target does not hold."""
    key = list(spec.key)
    fresh = collapse(batch, spec, sequence).join(target.select(*key), key, "left_anti")
    return _as_table_rows(fresh, spec, run_ts)


def merge(
    target: DataFrame, batch: DataFrame, spec: TableSpec, sequence: list[str], run_ts: Column
) -> DataFrame:
    """The whole new state of the table, with the action taken on every row.

    ``merge_action`` is ``kept`` (row not in the batch), ``inserted`` or ``updated``.
    Columns outside the listed ones survive an update.
    """
    key = list(spec.key)
    if spec.policy == INSERT_IGNORE:
        fresh = insert_ignore(target, batch, spec, sequence, run_ts)
        return target.withColumn(ACTION, F.lit("kept")).unionByName(
            fresh.withColumn(ACTION, F.lit("inserted"))
        )

    news = collapse(batch, spec, sequence)
    news = news.select(
        *key, *[F.col(c).alias(f"_new_{c}") for c in spec.listed], F.lit(True).alias("_in_batch")
    )
    both = target.withColumn("_in_target", F.lit(True)).join(news, key, "full_outer")
    in_batch, in_target = F.col("_in_batch").isNotNull(), F.col("_in_target").isNotNull()

    def value(field) -> Column:
        old, name = F.col(field.name), field.name
        if name in spec.listed:
            new = F.col(f"_new_{name}").cast(field.dataType)
            return F.coalesce(new, old) if spec.policy == COALESCE else F.when(in_batch, new).otherwise(old)
        if name == spec.updated_at:
            return F.when(in_batch, run_ts.cast(field.dataType)).otherwise(old)
        if name == spec.inserted_at:
            return F.when(~in_target, run_ts.cast(field.dataType)).otherwise(old)
        return old

    action = F.when(~in_batch, "kept").when(in_target, "updated").otherwise("inserted")
    return both.select(*[value(f).alias(f.name) for f in spec.schema], action.alias(ACTION))


def insert_counts(
    target: DataFrame, batch: DataFrame, spec: TableSpec, by: list[str] | None = None
) -> DataFrame:
    """Attempted and inserted keys of an insert-ignore, optionally per group.

    Attempted counts each distinct key of the batch once; a key is booked in the
    group of its first row.
    """
    key, by = list(spec.key), list(by or [])
    firsts = pick_row(batch.select(*dict.fromkeys([*key, *by])), key, by or key, last=False)
    known = target.select(*key).withColumn("_known", F.lit(True))
    return (
        firsts.join(known, key, "left")
        .groupBy(*by)
        .agg(F.count("*").alias("attempted"), F.count_if(F.col("_known").isNull()).alias("inserted"))
    )
