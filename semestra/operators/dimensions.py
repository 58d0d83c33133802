"""Dimension members: extraction, stable keys, upsert, key resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from semestra.operators.numbering import PART, PLACE, placed
from semestra.reference_data import literal_frame


def extract_members(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct attribute combinations occurring in ``rows``."""
    return rows.select(*columns).distinct()


def _merged(existing: DataFrame, incoming: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """All members with their surrogate keys, and whether they are ``incoming``.

    Old and new rows are tagged and put together by one grouping, which takes the newest
    attributes and the key already given. Members without one are numbered after the
    highest, in the order of a hash prefix and of their natural key: the members are cut
    into ranges of that order, and one row for each range tells the numbers below it. The
    result depends only on the members, not on partitioning.
    """
    others = [name for name in incoming.columns if name not in key]
    old = existing.select(*key, *others, F.col(surrogate).cast("bigint").alias(surrogate), F.lit(0).alias("age"))
    new = incoming.select(*key, *others, F.lit(None).cast("bigint").alias(surrogate), F.lit(1).alias("age"))
    together = old.unionByName(new).groupBy(*key).agg(
        F.max_by(F.struct(F.lit(True), *others), "age").alias("newest"), F.max(surrogate).alias(surrogate),
        (F.max("age") == 1).alias("incoming"),
    )
    fresh = F.col(surrogate).isNull()
    order = [fresh, F.substring(F.md5(F.concat_ws("\u001f", *key)), 1, 2), *map(F.col, key)]
    rows = placed(together, order)
    totals = rows.groupBy(PART).agg(
        F.count(surrogate).alias("n_old"), F.count(F.when(fresh, 1)).alias("n_fresh"), F.max(surrogate).alias("highest"),
    ).collect()
    number = max((t.highest for t in totals if t.highest is not None), default=0) + 1
    below = []
    for t in sorted(totals, key=lambda t: t[PART]):
        # In a range old members come first
        below.append((t[PART], number - t.n_old))
        number += t.n_fresh
    offsets = literal_frame(rows.sparkSession, below, f"{PART} int, first long")
    return rows.join(offsets, PART).select(
        *key, *[F.col(f"newest.{name}").alias(name) for name in others],
        F.coalesce(F.col(surrogate), F.col("first") + F.col(PLACE)).alias(surrogate), "incoming",
    )


def assign_keys(incoming: DataFrame, existing: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Give every incoming member a surrogate key (bigint), keeping those already given."""
    return _merged(existing, incoming, key, surrogate).filter("incoming").drop("incoming")


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Incoming members replace those with the same key; the others stay as they are. Each
    side is read once."""
    return _merged(existing, incoming, key, surrogate).drop("incoming")


def insert_absent(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows untouched, plus the incoming rows whose key is new."""
    return existing.unionByName(incoming.join(existing, key, "left_anti"))


def resolve(facts: DataFrame, members: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Add the surrogate key; NULL marks a member the dimension does not have.

    Whether ``members`` is broadcast is left to its measured size.
    """
    return facts.join(members.select(*key, surrogate), key, "left")


def with_known_keys(facts: DataFrame, members: dict[str, DataFrame], most: int = 1000) -> DataFrame:
    """Facts of the members alone, where a dimension's selected members are few.

    Their keys are looked up first, in one small job, and stand as literals in the filter:
    unlike the condition of a join they reach the files, whose statistics then pass over
    row groups and pages without them. A dimension with more than ``most`` selected members
    is left to its join.
    """
    if not members:
        return facts
    few = [
        rows.select(F.lit(key).alias("name"), F.col(key).cast("bigint").alias("key")).distinct().limit(most + 1)
        for key, rows in members.items()
    ]
    found: dict[str, list[int]] = {key: [] for key in members}
    for row in reduce(DataFrame.unionByName, few).collect():
        found[row.name].append(row.key)
    for key, values in found.items():
        if len(values) <= most:
            facts = facts.filter(F.col(key).isin(sorted(values)))
    return facts


def star_join(facts: DataFrame, dimensions: list[tuple[DataFrame, str]]) -> DataFrame:
    """Inner join of a fact to its dimensions on their keys."""
    for members, key in dimensions:
        facts = facts.join(members, key)
    return facts
