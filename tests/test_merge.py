"""Merge policies against a row-by-row replay."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from boxlake.operators import merge as M
from boxlake.schemas import DIM_PLAYERS, DIM_TEAMS, FACT_GAMES, SPINE, TEAMBOX, COALESCE, INSERT_IGNORE

OLD, NOW = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)


def _replay(target: dict, batch: list[dict], spec) -> dict:
    """Apply the batch one row after the other, as a keyed upsert would."""
    state = {k: dict(v) for k, v in target.items()}
    for row in batch:
        key = tuple(row[c] for c in spec.key)
        if key not in state:
            state[key] = {c: row.get(c) if c in (*spec.key, *spec.listed) else None for c in spec.columns}
            for stamp in spec.stamps:
                state[key][stamp] = NOW
            continue
        if spec.policy == INSERT_IGNORE:
            continue
        for c in spec.listed:
            if spec.policy != COALESCE or row.get(c) is not None:
                state[key][c] = row.get(c)
        if spec.updated_at:
            state[key][spec.updated_at] = NOW
    return state


def _value(rng, field):
    if rng.random() < 0.3:
        return None
    kind = field.dataType.typeName()
    return {
        "string": lambda: rng.choice(["", "a", "b", "c"]), "integer": lambda: rng.randint(0, 5),
        "double": lambda: rng.randint(0, 5) / 2, "boolean": lambda: rng.random() < 0.5,
        "date": lambda: dt.date(2024, 1, rng.randint(1, 9)), "timestamp": lambda: OLD,
    }[kind]()


def _row(rng, spec):
    row = {f.name: _value(rng, f) for f in spec.schema}
    for f in spec.schema:
        if f.name in spec.key:
            row[f.name] = rng.randint(1, 12) if f.dataType.typeName() == "integer" else f"k{rng.randint(1, 12)}"
    for stamp in spec.stamps:
        row[stamp] = OLD
    return row


@pytest.mark.parametrize("spec", [SPINE, FACT_GAMES, DIM_TEAMS, DIM_PLAYERS, TEAMBOX], ids=lambda s: s.name)
def test_merge_equals_replay(spark, spec):
    rng = random.Random(spec.name)
    target = {}
    for _ in range(12):
        row = _row(rng, spec)
        target[tuple(row[c] for c in spec.key)] = row
    batch = [_row(rng, spec) for _ in range(60)]
    old = spark.createDataFrame([tuple(r[c] for c in spec.columns) for r in target.values()], spec.schema)
    news = spark.createDataFrame([tuple(r[c] for c in spec.columns) for r in batch], spec.schema)
    order = spark.createDataFrame([(i, *[r[c] for c in spec.columns]) for i, r in enumerate(batch)], "seq int, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema))
    assert news.count() == order.count()
    merged = M.merge(old, order, spec, ["seq"], F.lit(NOW))
    expected = _replay(target, batch, spec)
    found = {tuple(r[c] for c in spec.key): {c: r[c] for c in spec.columns} for r in merged.collect()}
    assert found == expected

    counts = merged.groupBy(M.ACTION).count().collect()
    by_action = {r[M.ACTION]: r["count"] for r in counts}
    assert by_action.get("inserted", 0) == len(expected) - len(target)
    again = M.merge(merged.drop(M.ACTION), order, spec, ["seq"], F.lit(NOW))
    assert {tuple(r[c] for c in spec.columns) for r in again.collect()} == {tuple(r[c] for c in spec.columns) for r in merged.collect()}
    assert again.filter(F.col(M.ACTION) == "inserted").count() == 0


def test_insert_counts(spark):
    target = spark.createDataFrame([("g1", "2023-24", OLD)], SPINE.schema)
    batch = spark.createDataFrame([("g1", "2024-25"), ("g2", "2024-25"), ("g2", "2024-25"), ("g3", "2025-26")], "game_id string, season string")
    rows = M.insert_counts(target, batch, SPINE).first()
    assert (rows.attempted, rows.inserted) == (3, 2)
    by_season = {r.season: (r.attempted, r.inserted) for r in M.insert_counts(target, batch, SPINE, ["season"]).collect()}
    assert by_season == {"2024-25": (2, 1), "2025-26": (1, 1)}


def test_hot_key_is_pruned_before_the_shuffle(spark):
    """A key with most rows is cut to one row per map partition ahead of the exchange."""
    rows = spark.range(0, 100000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as game_id", "'s' as season", "id as seq")
    picked = M.pick_row(rows, ["game_id"], ["seq"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert picked.filter("game_id = 'hot'").first().seq == 99999
    assert picked.count() == 100000 - 33334 + 1
