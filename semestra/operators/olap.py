"""Cube operators over non-additive measures: averages, extremes, drill-across.

A measure is never summed here: prices, rates, indices and equivalent days only
have means, minima and maxima.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from semestra.functions.numeric import exact_mean, guarded_corr, half_up


@dataclass(frozen=True)
class PriceContext:
    """The homogeneous context a price average needs.

    ``bands`` names one band per consumer type, for averages that compare them.
    """

    commodity: str
    consumer: str | None = None
    band: str | None = None
    bands: dict[str, str] | None = None
    tax: str = "X_VAT"
    currency: str = "EUR"
    unit: str = "KWH"

    def band_condition(self) -> Column:
        condition = F.col("commodity_type") == self.commodity
        if self.consumer:
            condition &= F.col("consumer_type") == self.consumer
        if self.band:
            condition &= F.col("band_code") == self.band
        if self.bands:
            either = F.lit(False)
            for consumer, band in self.bands.items():
                either |= (F.col("consumer_type") == consumer) & (F.col("band_code") == band)
            condition &= either
        return condition

    def tax_condition(self) -> Column:
        return F.col("tax_code") == self.tax

    def unit_condition(self) -> Column:
        return (F.col("currency_code") == self.currency) & (F.col("energy_unit_code") == self.unit)


@dataclass(frozen=True)
class Summary:
    """An aggregate with one row per ``keys``; what drill-across takes instead of a fact."""

    rows: DataFrame
    keys: tuple[str, ...]


def summarise(facts: DataFrame, keys: list[str], **measures: Column) -> Summary:
    """Aggregate to ``keys``. Spark combines partially before it shuffles, so a hot
    group costs one row per task."""
    rows = facts.groupBy(*keys).agg(*[value.alias(name) for name, value in measures.items()])
    return Summary(rows, tuple(keys))


def mean_by(facts: DataFrame, keys: list[str], measure: str, digits: int, alias: str) -> DataFrame:
    """Mean of the raw rows at the requested grain, rounded once at the end."""
    return summarise(facts, keys, **{alias: half_up(exact_mean(F.col(measure)), digits)}).rows


def mean_where(condition: Column, measure: str) -> Column:
    """Mean of the rows meeting a condition; NULL if none does."""
    return exact_mean(F.when(condition, F.col(measure)))


def level_stats(facts: DataFrame, keys: list[str], measure: str, digits: int, names: list[str]) -> DataFrame:
    """Mean, minimum and maximum of a level measure."""
    value = F.col(measure)
    mean, lowest, highest = names
    return summarise(
        facts, keys,
        **{
            mean: half_up(exact_mean(value), digits),
            lowest: half_up(F.min(value), digits),
            highest: half_up(F.max(value), digits),
        },
    ).rows


def drill_across(left: Summary, right: Summary, on: list[str], how: str = "inner") -> Summary:
    """Join two aggregates. ``right`` must have one row per ``on``, so nothing fans out."""
    if not isinstance(left, Summary) or not isinstance(right, Summary):
        raise TypeError("Aggregate each fact first: drill-across joins summaries, not facts")
    if not set(right.keys) <= set(on) or not set(on) <= set(left.keys):
        raise ValueError(f"Cannot join grain {left.keys} to grain {right.keys} on {on}")
    return Summary(left.rows.join(right.rows, on, how), left.keys)


def paired_correlation(
    pairs: DataFrame, group: str, period: str, x: str, y: str,
    min_periods: int, digits: int, alias: str,
) -> DataFrame:
    """Pearson correlation of two series per group, for groups with enough periods."""
    corr = guarded_corr(F.col(x), F.col(y))
    return (
        pairs.groupBy(group)
        .agg(
            F.count("*").alias("comparable_years"),
            F.min(period).alias("first_year"),
            F.max(period).alias("last_year"),
            half_up(corr.cast("decimal(20,15)"), digits).alias(alias),
        )
        .filter(F.col("comparable_years") >= min_periods)
    )


def members_only(facts: DataFrame, bridge: DataFrame, on: list[str]) -> DataFrame:
    """Facts of entities that were members in that year. The bridge is unique, so
    existence is enough and nothing is duplicated."""
    return facts.join(bridge, on, "left_semi")


def mean_of_means(
    facts: DataFrame, inner: list[str], outer: list[str], measure: str, mean: str, contributors: str
) -> Summary:
    """Unweighted mean over members of each member's own mean, with the member count."""
    per_member = summarise(facts, inner, member_mean=exact_mean(F.col(measure)))
    return summarise(
        per_member.rows, outer,
        **{contributors: F.count("*"), mean: exact_mean(F.col("member_mean"))},
    )
