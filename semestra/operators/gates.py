"""Quality gates: count violations as a report, or refuse the load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from semestra.reference_data import literal_frame

#: Codes that a report names for a check, at most.
NAMED = 10
_REPORT = "check_name string, issue_count long, codes string"
_OFFENDERS = "check_name string, code string, n long"


class GateFailure(ValueError):
    """A load was refused; ``issues`` maps each failed check to its count."""

    def __init__(self, issues: dict[str, int], detail: str = ""):
        self.issues = issues
        listed = ", ".join(f"{name}: {count}" for name, count in issues.items())
        super().__init__(f"Load refused ({listed}){detail}")


def report(name: str, violations: DataFrame) -> DataFrame:
    """One row ``check_name, issue_count``."""
    return violations.agg(F.count("*").alias("issue_count")).select(
        F.lit(name).alias("check_name"), "issue_count"
    )


def combine(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def count_violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Evaluate all row rules in one pass; a rule is true where a row is at fault."""
    if not rules:
        return literal_frame(rows.sparkSession, [], "check_name string, issue_count long")
    counts = rows.agg(
        *[F.count(F.when(rule, F.lit(1))).alias(name) for name, rule in rules.items()]
    )
    return counts.unpivot([], [F.col(f"`{name}`") for name in rules], "check_name", "issue_count")


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys occurring more than once, with ``copies``. Counts combine before the shuffle."""
    return rows.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def duplicate_rows(name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """Counts all rows of duplicated keys."""
    return duplicates(rows, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("issue_count")
    ).select(F.lit(name).alias("check_name"), "issue_count")


def suspected_duplicates(name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """Like ``duplicate_rows`` on a 96-bit hash of the key. Zero proves there are no
    duplicates, and shuffling hashes is cheaper than shuffling wide text keys; any
    other count is for ``duplicate_rows`` to confirm. Hashes are counted where they were
    sent to: counting them before would keep all of a task in memory, as most are unique."""
    hashed = rows.select(F.xxhash64(*key).alias("h64"), F.hash(*key).alias("h32")).repartition("h64", "h32")
    return duplicate_rows(name, hashed, ["h64", "h32"])


def duplicate_groups(name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """Counts duplicated keys, each once."""
    return report(name, duplicates(rows, key))


def missing_members(rows: DataFrame, members: DataFrame, key: list[str], n: str | None = None) -> DataFrame:
    """Distinct keys in ``rows`` that ``members`` lacks; deduplicated before the join.
    ``n`` names a count of the rows that have each."""
    distinct = rows.groupBy(*key).agg(F.count("*").alias(n)) if n else rows.select(*key).distinct()
    return distinct.join(members.select(*key), key, "left_anti")


# Named offenders: check_name, code, n rows


def _named(name: str, rows: DataFrame, key: list[str], n: Column) -> DataFrame:
    codes = [F.coalesce(F.col(k).cast("string"), F.lit("(none)")) for k in key]
    return rows.select(F.lit(name).alias("check_name"), F.concat_ws(" ", *codes).alias("code"), n.cast("long").alias("n"))


def missing_codes(name: str, rows: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
    """Keys that ``members`` lacks, by name."""
    return _named(name, missing_members(rows, members, key, "n"), key, F.col("n"))


def repeated_codes(name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, by name."""
    return _named(name, duplicates(rows, key), key, F.col("copies"))


def offending_codes(members: DataFrame, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """Codes at fault, by name, from one pass over combinations of codes.

    A rule names the column of its code and is true where it is at fault; ``members`` has
    the ``n`` rows of each combination.
    """
    if not rules:
        return literal_frame(members.sparkSession, [], _OFFENDERS)
    faults = F.array(*[
        F.when(rule, F.struct(F.lit(name).alias("check_name"), F.coalesce(F.col(code).cast("string"), F.lit("(none)")).alias("code")))
        for name, (code, rule) in rules.items()
    ])
    found = members.select(F.explode(F.filter(faults, lambda fault: fault.isNotNull())).alias("fault"), "n")
    return found.groupBy("fault.check_name", "fault.code").agg(F.sum("n").alias("n"))


def gate_report(spark: SparkSession, checks: list[DataFrame], offenders: list[DataFrame], names: list[str]) -> DataFrame:
    """``check_name, issue_count, codes`` of all checks.

    ``checks`` have a count, ``offenders`` name their codes; their count is that of the rows
    with such codes, and the first of them in order are given. ``names`` are checks that
    stand in the report even where nothing is at fault.
    """
    parts = [literal_frame(spark, [(name, 0, None) for name in names], _REPORT)]
    for check in checks:
        codes = F.col("codes") if "codes" in check.columns else F.lit(None).cast("string").alias("codes")
        parts.append(check.select("check_name", "issue_count", codes))
    if offenders:
        rank = F.row_number().over(Window.partitionBy("check_name").orderBy("code"))
        listed = reduce(DataFrame.unionByName, offenders).withColumn("place", rank)
        first = F.array_sort(F.collect_list(F.when(F.col("place") <= NAMED, F.col("code"))))
        parts.append(listed.groupBy("check_name").agg(
            F.sum("n").alias("issue_count"), F.array_join(first, ", ").alias("codes")
        ))
    return reduce(DataFrame.unionByName, parts).groupBy("check_name").agg(
        F.sum("issue_count").alias("issue_count"), F.nullif(F.array_join(F.array_sort(F.collect_set("codes")), ", "), F.lit("")).alias("codes")
    )


def orphans(facts: DataFrame, references: list[tuple[DataFrame, str]]) -> DataFrame:
    """Facts lacking a member in any of the dimensions; each fact counts once."""
    flags = []
    for i, (members, key) in enumerate(references):
        flag = f"found_{i}"
        # A key given twice must not count its facts twice
        facts = facts.join(members.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
        flags.append(F.col(flag).isNull())
    return facts.filter(reduce(lambda a, b: a | b, flags))


def sample(violations: DataFrame, columns: list[str], size: int = 10) -> DataFrame:
    """A few distinct offenders, for the error message."""
    return violations.select(*columns).distinct().limit(size)


def enforce(
    checks: DataFrame, offenders: DataFrame | None = None, must_occur: tuple[str, ...] = (),
    informative: tuple[str, ...] = (),
) -> dict[str, int]:
    """Evaluate all checks in one job; raise if any failed, naming the codes at fault and
    listing at most ten offenders.

    Checks named in ``must_occur`` fail at zero instead; ``informative`` ones never
    fail. Returns all counts.
    """
    # One row per check: bounded by the number of checks.
    found = checks.collect()
    counts = {r.check_name: r.issue_count for r in found}
    codes = {r.check_name: r.codes for r in found if "codes" in checks.columns and r.codes}
    issues = {
        name: count for name, count in counts.items()
        if count > 0 and name not in must_occur and name not in informative
    }
    issues.update({f"no {name}": 1 for name in must_occur if not counts.get(name)})
    if issues:
        rows = [row.asDict() for row in offenders.limit(10).collect()] if offenders is not None else []
        named = {name: codes[name] for name in issues if name in codes}
        raise GateFailure(issues, (f"; codes: {named}" if named else "") + (f"; sample: {rows}" if rows else ""))
    return counts
