import hashlib
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from semestra.operators import calendar, gates
from semestra.operators.dimensions import assign_keys, insert_absent, upsert
from semestra.operators.membership import expand_membership
from semestra.operators.olap import Summary, drill_across, mean_of_means, summarise
from semestra.operators.profile import profile_missing, profile_nulls, profile_shape
from semestra.operators.selection import extremes, sign_class, zeros_and_highest
from semestra.operators.windows import change_from_previous, global_rank, moving_mean
from semestra.reference_data import eu_history, geo_entities, literal_frame


def keyless(frame, name):
    return frame.limit(0).withColumn(name, F.lit(0))


def test_calendars(spark, rows):
    assert calendar.years(spark, 1900, 2030).count() == 131
    assert calendar.semesters(spark, 2007, 2026).count() == 40
    assert calendar.months(spark, 1900, 2026).count() == 1524
    assert rows(calendar.semesters(spark, 2007, 2007)) == [("2007-S1", 2007, 1), ("2007-S2", 2007, 2)]
    assert rows(calendar.months(spark, 2013, 2013))[0] == ("2013-01", 2013, 1)


def test_eu_history(spark):
    members = geo_entities(spark)
    geo = assign_keys(members, keyless(members, "geo_sk"), ["eurostat_code"], "geo_sk")
    bridge = expand_membership(eu_history(spark), calendar.years(spark, 1900, 2030), geo)
    assert geo.count() == 46 and bridge.count() == 1191
    per_year = dict(bridge.groupBy("year_sk").count().collect())
    assert (per_year[2007], per_year[2019], per_year[2020], per_year[2024]) == (27, 28, 27, 27)
    assert min(per_year) == 1957 and max(per_year) == 2030


def test_membership_edges(spark, rows):
    history = literal_frame(
        spark, [("A", 1999, None), ("B", 1980, 2001), ("C", 2000, 2000), ("X", 2000, None), ("A", 2001, 2002)],
        "code string, entry_year int, exit_year int",
    )
    geo = literal_frame(spark, [("A", 1), ("B", 2), ("C", 3)], "eurostat_code string, geo_sk int")
    got = rows(expand_membership(history, calendar.years(spark, 1999, 2002), geo))
    assert got == [(1, 1999), (1, 2000), (1, 2001), (1, 2002), (2, 1999), (2, 2000)]


def test_keys_are_stable(spark):
    first = literal_frame(spark, [(f"c{i}", i) for i in range(500)], "code string, v int")
    keyed = assign_keys(first, keyless(first, "sk"), ["code"], "sk")
    keys = {r.code: r.sk for r in keyed.collect()}
    assert sorted(keys.values()) == list(range(1, 501))
    assert keys == {r.code: r.sk for r in assign_keys(first.repartition(7), keyless(first, "sk"), ["code"], "sk").collect()}

    second = literal_frame(spark, [(f"c{i}", -i) for i in range(400, 600)], "code string, v int")
    merged = {r.code: (r.sk, r.v) for r in upsert(keyed, second, ["code"], "sk").collect()}
    assert len(merged) == 600 and all(merged[c][0] == k for c, k in keys.items())
    assert merged["c10"][1] == 10 and merged["c450"][1] == -450
    assert sorted(sk for sk, _ in merged.values()) == list(range(1, 601))


@pytest.fixture
def many_ranges(spark):
    """Ranges stay as many as the shuffle partitions, however small."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set(setting, before)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_keys_over_many_ranges(spark, many_ranges):
    first = spark.range(1000).selectExpr("concat('c', id) AS code", "int(id % 7) AS part", "id AS v")
    keyed = assign_keys(first, first.limit(0).withColumn("sk", F.lit(0)), ["code", "part"], "sk")
    assert keyed.schema["sk"].dataType.simpleString() == "bigint"
    keys = {r.code: r.sk for r in keyed.collect()}
    assert sorted(keys.values()) == list(range(1, 1001))
    second = spark.range(900, 1500).selectExpr("concat('c', id) AS code", "int(id % 7) AS part", "-id AS v")
    merged = {r.code: (r.sk, r.v) for r in upsert(keyed, second, ["code", "part"], "sk").collect()}
    assert len(merged) == 1500 and all(merged[c][0] == k for c, k in keys.items())
    assert sorted(sk for sk, _ in merged.values()) == list(range(1, 1501))
    assert merged["c950"][1] == -950 and merged["c10"][1] == 10
    # New members follow the hash prefix and the natural key, as if one task numbered them
    fresh = sorted((c for c in merged if c not in keys), key=lambda c: (hashlib.md5(f"{c}\x1f{int(c[1:]) % 7}".encode()).hexdigest()[:2], c))
    assert [merged[c][0] for c in fresh] == list(range(1001, 1501))


def test_each_side_of_an_upsert_is_read_once(spark, many_ranges):
    def counting(seen):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return run

    old_seen, new_seen = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    old = spark.range(50).selectExpr("concat('c', id) AS code", "id AS v", "id + 1 AS sk").mapInArrow(
        counting(old_seen), "code string, v long, sk long")
    new = spark.range(40, 90).selectExpr("concat('c', id) AS code", "-id AS v").mapInArrow(counting(new_seen), "code string, v long")
    assert upsert(old, new, ["code"], "sk").count() == 90
    assert (old_seen.value, new_seen.value) == (50, 50)


def test_rank_over_many_ranges_with_nan_and_ties(spark, many_ranges):
    random = Random(5)
    values = [float("nan")] * 5 + [1.5] * 400 + [random.choice([0.5, 2.5, 3.5, 1e9]) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(7)
    got = {r.id: (r.k, str(r.p)) for r in global_rank(frame, "v", "k", "p").collect()}
    order = sorted({0.5, 1.5, 2.5, 3.5, 1e9}) + ["nan"]
    counts = Counter("nan" if v != v else v for v in values)
    for i, v in enumerate(values):
        at = order.index("nan" if v != v else v)
        smaller = sum(counts[w] for w in order[:at])
        pct = (Decimal(smaller) * 100 / (len(values) - 1)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[i] == (len(order) - at, str(pct))


def test_rank_of_equal_values_and_of_none(spark, many_ranges):
    same = spark.range(300).selectExpr("id", "CAST(7 AS decimal(10,2)) AS v")
    assert {(r.k, str(r.p)) for r in global_rank(same, "v", "k", "p").collect()} == {(1, "0.00")}
    assert global_rank(same.limit(0), "v", "k", "p").collect() == []


def test_insert_absent(spark, rows):
    old = literal_frame(spark, [(1, "a")], "k int, v string")
    new = literal_frame(spark, [(1, "b"), (2, "c")], "k int, v string")
    assert rows(insert_absent(old, new, ["k"])) == [(1, "a"), (2, "c")]


def test_gates(spark, rows):
    frame = literal_frame(spark, [(1, 1), (1, 1), (2, 5), (3, None)], "k int, v int")
    checks = gates.count_violations(frame, {"no v": F.col("v").isNull(), "big": F.col("v") > 3})
    assert rows(checks) == [("big", 1), ("no v", 1)]
    assert gates.duplicate_rows("d", frame, ["k"]).first().issue_count == 2
    assert gates.duplicate_groups("d", frame, ["k"]).first().issue_count == 1
    assert gates.suspected_duplicates("d", frame, ["k"]).first().issue_count == 2
    assert gates.suspected_duplicates("d", frame.filter("k > 1"), ["k", "v"]).first().issue_count == 0
    members = literal_frame(spark, [(1,), (2,)], "k int")
    assert rows(gates.missing_members(frame, members, ["k"])) == [(3,)]
    with pytest.raises(gates.GateFailure, match="big: 1"):
        gates.enforce(checks, gates.sample(frame, ["k"]))
    with pytest.raises(gates.GateFailure, match="no none"):
        gates.enforce(gates.count_violations(frame, {"none": F.col("v") > 9}), must_occur=("none",))
    assert gates.enforce(gates.count_violations(frame, {"none": F.col("v") > 9})) == {"none": 0}


def test_orphans_count_a_fact_once(spark):
    facts = literal_frame(spark, [(1, 1), (9, 9), (1, 9), (None, 1)], "a int, b int")
    known_a = literal_frame(spark, [(1,)], "a int")
    known_b = literal_frame(spark, [(1,)], "b int")
    assert gates.orphans(facts, [(known_a, "a"), (known_b, "b")]).count() == 3


def test_profiles(spark):
    wide = spark.createDataFrame([("a,b", ": ", "1"), ("a,b,c", ": c", None)], ["k,geo\\T", "2007 ", "2008 "])
    assert tuple(profile_shape(wide).first()) == (2, 3, "k,geo\\T", 3)
    assert profile_missing(wide).first().missing_cells == 1
    assert tuple(profile_nulls(wide).first()) == (6, 1, Decimal("16.67"))
    assert profile_nulls(wide.limit(0)).first().null_pct is None


def test_drill_across_takes_aggregates_only(spark, rows):
    frame = literal_frame(spark, [("x", 2000, 1), ("x", 2001, 2)], "c string, y int, v int")
    left = summarise(frame, ["c", "y"], a=F.max("v"))
    right = summarise(frame, ["y"], b=F.max("v"))
    assert rows(drill_across(left, right, ["y"]).rows.select("c", "y", "a", "b")) == [("x", 2000, 1, 1), ("x", 2001, 2, 2)]
    with pytest.raises(TypeError):
        drill_across(left, frame, ["y"])
    with pytest.raises(ValueError):
        drill_across(right, left, ["y"])
    assert isinstance(left, Summary)


def test_mean_of_means_is_unweighted(spark):
    data = [(1, 2000, Decimal(1)), (1, 2000, Decimal(3)), (2, 2000, Decimal(10))]
    facts = spark.createDataFrame(data, "geo int, y int, v decimal(10,4)")
    row = mean_of_means(facts, ["y", "geo"], ["y"], "v", "m", "n").rows.first()
    assert (row.n, row.m) == (2, Decimal(6))


def test_moving_mean_counts_rows(spark):
    random = Random(3)
    data = [(s, f"20{y:02d}-01", Decimal(random.randint(0, 9999)).scaleb(-2))
            for s in "ab" for y in range(30) if random.random() < 0.7]
    frame = spark.createDataFrame(data, "s string, m string, v decimal(14,4)").repartition(5)
    got = {(r.s, r.m): r.a for r in moving_mean(frame, ["s"], "m", "v", 3, 2, "a").collect()}
    for s in "ab":
        series = sorted((m, v) for k, m, v in data if k == s)
        for i, (m, _) in enumerate(series):
            last = [v for _, v in series[max(0, i - 2): i + 1]]
            expected = (sum(last) / Decimal(len(last))).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert got[s, m] == expected


def test_change_from_previous_row(spark):
    data = [("al", 2021, Decimal(0)), ("al", 2022, Decimal(1)), ("al", 2023, Decimal("1.5")), ("at", 2022, Decimal(2))]
    frame = spark.createDataFrame(data, "c string, y int, v decimal(10,4)")
    got = {(r.c, r.y): r.p for r in change_from_previous(frame, ["c"], "y", "v", 2, "p").collect()}
    assert got == {("al", 2021): None, ("al", 2022): None, ("al", 2023): Decimal("50.00"), ("at", 2022): None}


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_global_rank_with_a_hot_value(spark, buckets):
    random = Random(buckets)
    values = [Decimal("7.5")] * 200 + [Decimal(random.randint(-50, 50)) for _ in range(400)]
    data = [(i, v) for i, v in enumerate(values)] + [(-1, None)]
    frame = spark.createDataFrame(data, "id int, v decimal(12,4)").repartition(6)
    got = {r.id: (r.rank, r.pct) for r in global_rank(frame, "v", "rank", "pct", buckets=buckets).collect()}
    counts = Counter(values)
    distinct = sorted(counts, reverse=True)
    assert len(got) == 600
    for i, v in enumerate(values):
        smaller = sum(n for w, n in counts.items() if w < v)
        pct = (Decimal(smaller) * 100 / 599).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[i] == (distinct.index(v) + 1, pct)


def test_rank_percentiles_of_37(spark):
    frame = spark.createDataFrame([(i, Decimal(i)) for i in range(37)], "id int, v decimal(12,4)")
    got = {r.id: (r.k, str(r.p)) for r in global_rank(frame, "v", "k", "p").collect()}
    assert got[36] == (1, "100.00") and got[35] == (2, "97.22") and got[0] == (37, "0.00")
    one = global_rank(frame.filter("id = 5"), "v", "k", "p").first()
    assert (one.k, str(one.p)) == (1, "0.00")


def test_selections(spark, rows):
    frame = literal_frame(spark, [(i, v) for i, v in enumerate([5, 5, 4, 3, -2, -2, None, 0, 0])], "id int, v int")
    assert rows(extremes(frame, "v", "id", 1, 2).select("id")) == [(0,), (4,), (5,)]
    assert extremes(frame, "v", "id", 10, 10).count() == 8
    assert rows(zeros_and_highest(frame, "v", "id", 1).select("id")) == [(0,), (7,), (8,)]
    signs = Counter(r[0] for r in frame.select(sign_class(F.col("v"))).collect())
    assert signs == {"non_negative": 6, "negative": 2, None: 1}
