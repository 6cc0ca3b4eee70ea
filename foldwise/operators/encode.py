"""One-hot encoding with rare categories folded into one shared bucket.

Fitting is one grouped pass over all categorical features. A fitted encoder is a
list of column expressions: encoding a table needs no join, shuffle or UDF. Only
the categories that keep their own column travel through the driver, and their
number is checked first; the possibly endless tail of rare ones stays a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.config import OTHER_CATEGORY, FeatureSpec
from foldwise.errors import DataError
from foldwise.functions.names import q
from foldwise.sources.settle import Settled, settle

#: Clashing categories an error names; it states how many there are.
NAMED = 20


def indicator_name(feature: str, category: str) -> str:
    return f"{feature}_OHE__{category}"


def unpivot_categories(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, category)``, one row per input row and feature."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), q(f).alias("category"))
                      for f in features])
    return df.select(F.explode(pairs).alias("p")).select("p.feature", "p.category")


def category_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Frequency of every category of every feature, from one pass."""
    return (unpivot_categories(df, features).groupBy("feature", "category")
            .agg(F.count("*").alias("count")))


def _per_feature(specs: Sequence[FeatureSpec], value) -> Column:
    return F.element_at(
        F.create_map(*[F.lit(x) for s in specs for x in (s.column, value(s))]), F.col("feature"))


def category_distribution(counts: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    """Add percent, the rare flag and the final category to category counts.

    The total of a feature comes from an aggregate of a row per feature, not from
    a window, so a feature with very many categories is not gathered in one task.
    """
    totals = counts.groupBy("feature").agg(F.sum("count").alias("_total"))
    pct = F.col("count") / F.col("_total") * 100
    return (counts.join(F.broadcast(totals), "feature")
            .withColumn("pct", pct)
            .withColumn("is_rare", pct < _per_feature(specs, lambda s: s.rare_below_pct))
            .withColumn("final_category", F.when(F.col("is_rare"), OTHER_CATEGORY)
                        .otherwise(F.col("category")))
            .select("feature", "category", "count", "pct", "is_rare", "final_category"))


def encoding_summary(distribution: DataFrame) -> DataFrame:
    """One row per feature: what the guards and warnings look at."""
    kept, rare = ~F.col("is_rare"), F.col("is_rare")
    return distribution.groupBy("feature").agg(
        F.sum("count").alias("rows"),
        F.count("*").alias("raw_categories"),
        F.count(F.when(kept, True)).alias("own_categories"),
        F.count(F.when(rare, True)).alias("rare_categories"),
        F.coalesce(F.sum(F.when(rare, F.col("pct"))), F.lit(0.0)).alias("other_pct"),
        F.coalesce(F.sum(F.when(F.col("category").isNull() | (F.col("category") == ""),
                                F.col("count"))), F.lit(0)).alias("empty_rows"),
        F.coalesce(F.max(F.col("category") == OTHER_CATEGORY), F.lit(False)).alias("has_reserved"),
    ).withColumn("final_categories",
                 F.col("own_categories") + (F.col("rare_categories") > 0).cast("bigint"))


def final_distribution(distribution: DataFrame) -> DataFrame:
    """Counts and percents after rare categories were folded."""
    return distribution.groupBy("feature", F.col("final_category").alias("category")).agg(
        F.sum("count").alias("count"), F.sum("pct").alias("pct"))


def case_collisions(counts: DataFrame, strict: bool = False) -> DataFrame:
    """Category groups that differ by letter case only.

    By default a group counts when one member is itself the lower-case form; with
    ``strict`` any two members do. ``example`` is the smallest other member.
    """
    low, own = F.lower("category"), F.col("category")
    return (counts.groupBy("feature", low.alias("lower_form"))
            .agg(F.count("*").alias("forms"), F.max(own == low).alias("_has_lower"),
                 F.min(F.when(own != low, own)).alias("example"))
            .where((F.col("forms") > 1) & (F.lit(strict) | F.col("_has_lower")))
            .select("feature", "lower_form", "example", "forms"))


@dataclass(frozen=True)
class FeatureEncoding:
    """Fitted encoding of one feature; ``own`` lists the kept categories, sorted."""

    feature: str
    own: tuple[str, ...]
    rare_count: int
    raw_count: int
    other_pct: float
    rare_below_pct: float
    max_categories: int
    allow_unknown: bool

    @property
    def final_categories(self) -> tuple[str, ...]:
        """Sorted by code point, the shared bucket among them if it was needed."""
        return tuple(sorted((*self.own, *([OTHER_CATEGORY] if self.rare_count else []))))

    @property
    def indicator_categories(self) -> tuple[str, ...]:
        """As above; without rare categories the shared bucket comes last, all zero."""
        final = self.final_categories
        return final if self.rare_count else (*final, OTHER_CATEGORY)

    @property
    def output_columns(self) -> tuple[str, ...]:
        return tuple(indicator_name(self.feature, c) for c in self.indicator_categories)

    @property
    def is_own(self) -> Column:
        return q(self.feature).isin(*self.own) if self.own else F.lit(False)

    @property
    def final_category(self) -> Column:
        return F.when(self.is_own, q(self.feature)).otherwise(OTHER_CATEGORY)

    def indicators(self) -> list[Column]:
        value = {c: q(self.feature) == c for c in self.own} | {OTHER_CATEGORY: ~self.is_own}
        return [value[c].cast("int").alias(indicator_name(self.feature, c))
                for c in self.indicator_categories]


@dataclass(frozen=True)
class Encoder:
    encodings: tuple[FeatureEncoding, ...]
    categories: Settled | None = None

    @property
    def category_df(self) -> DataFrame:
        """``(feature, category, count, pct, is_rare, final_category)``."""
        if self.categories is None:
            raise DataError("the encoder has no categorical feature")
        return self.categories.df

    def columns(self) -> list[Column]:
        return [c for e in self.encodings for c in e.indicators()]

    @property
    def output_columns(self) -> list[str]:
        return [c for e in self.encodings for c in e.output_columns]

    def rare_categories(self, encoding: FeatureEncoding) -> list[str]:
        """Names folded into the shared bucket; callers check ``rare_count`` first."""
        if not encoding.rare_count:
            return []
        rows = self.category_df.where(F.col("is_rare") & (F.col("feature") == encoding.feature))
        return [r["category"] for r in rows.select("category").collect()]

    def unknown_categories(self, df: DataFrame,
                           encodings: Sequence[FeatureEncoding] | None = None) -> DataFrame:
        """``(feature, category)`` of values the fitted table did not have.

        Values with an own column drop out before the shuffle; the rest are made
        distinct and then compared with the table of rare ones.
        """
        checked = self.encodings if encodings is None else encodings
        pairs = F.filter(F.array(*[
            F.struct(F.lit(e.feature).alias("feature"), q(e.feature).alias("category"),
                     e.is_own.alias("own")) for e in checked]),
            lambda p: ~p["own"] & p["category"].isNotNull())
        strange = (df.select(F.explode(pairs).alias("p"))
                   .select("p.feature", "p.category").distinct())
        if self.categories is None or not any(e.rare_count for e in checked):
            return strange
        rare = self.categories.over(
            lambda t: t.where("is_rare").select("feature", "category"))
        return strange.join(rare.joinable, ["feature", "category"], "left_anti")


def fit_encoder(df: DataFrame, specs: Sequence[FeatureSpec], strict_case: bool = False) -> Encoder:
    """Fit all categorical features from one grouped pass over complete cases."""
    if not specs:
        return Encoder(())
    features = [s.column for s in specs]
    counts = settle(category_counts(df, features), "categories")
    distribution = counts.over(lambda t: category_distribution(t, specs))
    summary = {r["feature"]: r for r in encoding_summary(distribution.df).collect()}
    _check_summary(summary, specs)
    clashes = case_collisions(counts.df, strict_case)
    clash = clashes.orderBy("feature", "lower_form").limit(NAMED).collect()
    if clash:
        raise DataError(
            f"{clashes.count()} categories differ from others in letter case only; "
            "case_collisions() gives all, the first are: " + "; ".join(
                f"'{r['lower_form']}' of '{r['feature']}' ({r['forms']} spellings)"
                for r in clash))
    own: dict[str, list[str]] = {f: [] for f in features}
    # At most max_categories rows per feature, as checked above.
    for r in distribution.df.where(~F.col("is_rare")).select("feature", "category").collect():
        own[r["feature"]].append(r["category"])
    return Encoder(tuple(
        FeatureEncoding(
            feature=s.column, own=tuple(sorted(own[s.column])),
            rare_count=summary[s.column]["rare_categories"],
            raw_count=summary[s.column]["raw_categories"],
            other_pct=summary[s.column]["other_pct"],
            rare_below_pct=s.rare_below_pct, max_categories=s.max_categories,
            allow_unknown=s.allow_unknown)
        for s in specs), distribution)


def _check_summary(summary: dict, specs: Sequence[FeatureSpec]) -> None:
    for s in specs:
        row = summary.get(s.column)
        if row is None:
            raise DataError(f"no rows are left to fit the feature '{s.column}'")
        if row["empty_rows"]:
            raise DataError(f"the category column '{s.column}' must not contain empty values")
        if row["has_reserved"]:
            raise DataError(f"'{s.column}' contains the reserved category '{OTHER_CATEGORY}'")
        if row["raw_categories"] < 2:
            raise DataError(f"the category column '{s.column}' needs at least 2 categories")
        if row["final_categories"] > s.max_categories:
            raise DataError(
                f"too many categories in '{s.column}': {row['final_categories']} would get a column, "
                f"the maximum is {s.max_categories}")
