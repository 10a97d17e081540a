"""Constraints checked at the end of a batch: references, keys, nulls and lengths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from boxlake.functions.parsing import outside_int32
from boxlake.schemas import TableSpec


def orphan_values(rows: DataFrame, column: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Distinct non-null values of ``column`` that the parent table does not hold.

    The values are reduced to distinct ones before the join, so a value shared by a
    large part of all rows costs one row per map partition.
    """
    values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    keys = parent.select(F.col(parent_key or column).alias(column))
    return values.join(keys, column, "left_anti")


def orphan_games(rows: DataFrame, spec: TableSpec, parents: dict[str, DataFrame]) -> DataFrame:
    """(game_id, reference) for every game holding a reference to something unknown.

    Each reference is one pass over two narrow columns. Spark broadcasts a parent that
    is small by measured size and otherwise splits a team or player that holds a large
    share of the rows; game ids are made distinct ahead of their shuffle.
    """
    found = []
    for fk in spec.foreign_keys:
        if fk.table not in parents:
            continue
        pairs = rows.select(*dict.fromkeys(["game_id", fk.column])).filter(F.col(fk.column).isNotNull())
        if fk.column == "game_id":
            pairs = pairs.distinct()
        orphans = pairs.join(parents[fk.table].select(fk.column), fk.column, "left_anti")
        found.append(orphans.select("game_id", F.lit(fk.column).alias("reference")).distinct())
    return reduce(DataFrame.unionByName, found)


def cascade(rows: DataFrame, surviving_games: DataFrame) -> DataFrame:
    """Box rows left after their games were deleted."""
    return rows.join(surviving_games.select("game_id"), "game_id", "left_semi")


def without_games(rows: DataFrame, bad_games: DataFrame) -> DataFrame:
    """Drop every row of the bad games, so that a game is written whole or not at all."""
    return rows.join(bad_games.select("game_id").distinct(), "game_id", "left_anti")


def duplicate_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys held by several rows; a null is no key and is reported on its own."""
    return rows.dropna(subset=list(spec.key)).groupBy(*spec.key).agg(F.count("*").alias("copies")).filter("copies > 1")


def row_violations(rows: DataFrame, spec: TableSpec) -> list[Column]:
    """The row-local constraints a row breaks, such as ``not_null:game_id``, each a text or NULL."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in spec.not_null]
    broken += [
        F.when(F.char_length(c) > n, F.lit(f"length:{c}")) for c, n in spec.lengths
    ]
    # A column that is 32 bits wide already cannot be out of range.
    narrow = {f.name for f in rows.schema if isinstance(f.dataType, IntegerType)}
    return broken + [
        F.when(outside_int32(F.col(f.name)), F.lit(f"int32:{f.name}"))
        for f in spec.schema
        if isinstance(f.dataType, IntegerType) and f.name not in narrow
    ]


def constraint_violations(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """(constraint, violations) over a table: row-local ones and repeated keys."""
    local = rows.select(F.explode(F.array(*row_violations(rows, spec))).alias("constraint")).filter(
        F.col("constraint").isNotNull()
    )
    repeated = duplicate_keys(rows, spec).select(
        F.lit("unique:" + ",".join(spec.key)).alias("constraint")
    )
    return local.unionByName(repeated).groupBy("constraint").agg(F.count("*").alias("violations"))
