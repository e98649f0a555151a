"""Data-quality rules as data, evaluated in one pass per model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.dedup import orphans


class DataQualityError(Exception):
    """One or more checks failed; the message lists every one of them."""


@dataclass(frozen=True)
class RowRule:
    """Broken where ``broken()`` is true; unknown (NULL) counts as fine."""

    name: str
    broken: Callable[[], Column]

    def condition(self) -> Column:
        return F.coalesce(self.broken(), F.lit(False))


@dataclass(frozen=True)
class UniqueRule:
    """No two rows share ``keys``. With ``skip_nulls`` rows with a null key pass."""

    name: str
    keys: tuple[str, ...]
    skip_nulls: bool = False


Rule = RowRule | UniqueRule


# --- rule constructors ------------------------------------------------------

def not_null(column: str) -> RowRule:
    return RowRule(f"not_null_{column}", lambda: F.col(column).isNull())


def unique(*keys: str) -> UniqueRule:
    return UniqueRule(f"unique_{'_'.join(keys)}", keys, skip_nulls=len(keys) == 1)


def accepted_values(column: str, values: Sequence[str]) -> RowRule:
    return RowRule(f"accepted_values_{column}", lambda: ~F.col(column).isin(*values))


def expression_is_true(name: str, expression: str) -> RowRule:
    """SQL predicate that must hold; NULL passes."""
    return RowRule(name, lambda: ~F.expr(expression))


# --- evaluation -------------------------------------------------------------
def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows (or, for uniqueness, the keys with their count) that break a rule."""
    if isinstance(rule, RowRule):
        return df.where(rule.condition())
    keyed = df
    if rule.skip_nulls:
        for k in rule.keys:
            keyed = keyed.where(F.col(k).isNotNull())
    return keyed.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with a violation count per rule, named after it, in one scan.

    Row rules are settled in the scan: only rows that break some are counted, by
    the set of rules they break. A uniqueness rule sends its keys, counted before
    the exchange, and nothing else; duplicates are the rows beyond the first of
    each key. At most 63 row rules.
    """
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    unique_rules = [r for r in rules if isinstance(r, UniqueRule)]
    if not unique_rules:
        return df.agg(*[F.count_if(r.condition()).alias(r.name) for r in row_rules])
    keys = list(dict.fromkeys(k for r in unique_rules for k in r.keys))
    types = {f.name: f.dataType for f in df.select(*keys).schema}

    def entry(number: int, broken: Column, own: Sequence[str]) -> Column:
        held = [(F.col(k) if k in own else F.lit(None).cast(types[k])).alias(f"_key_{i}") for i, k in enumerate(keys)]
        return F.struct(F.lit(number).alias("_rule"), broken.alias("_broken"), *held)

    broken = F.lit(0).cast("bigint")
    for i, r in enumerate(row_rules):
        broken = broken + F.when(r.condition(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    entries = [F.when(broken != 0, entry(0, broken, ()))] if row_rules else []
    for number, r in enumerate(unique_rules, 1):
        known = F.lit(True)
        for k in r.keys if r.skip_nulls else ():
            known = known & F.col(k).isNotNull()
        entries.append(F.when(known, entry(number, F.lit(0).cast("bigint"), r.keys)))
    counted = (
        df.select(F.inline(F.array(*entries))).where("_rule IS NOT NULL")
        .groupBy("_rule", "_broken", *[f"_key_{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("_n"))
    )
    found = {r.name: F.when((F.col("_rule") == 0) & F.getbit("_broken", F.lit(i)).cast("boolean"), F.col("_n"))
             for i, r in enumerate(row_rules)}
    found |= {r.name: F.when(F.col("_rule") == number, F.col("_n") - 1) for number, r in enumerate(unique_rules, 1)}
    return counted.agg(*[F.coalesce(F.sum(found[r.name]), F.lit(0)).alias(r.name) for r in rules])


def long_summary(model: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its violations."""
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(r.name).cast("bigint").alias("violations"))
        for r in rules
    ])
    return summary(df, rules).select(F.lit(model).alias("model"), F.inline(rows))


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_rules(models: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """Violations per model and rule, for all models that have rules."""
    return _stack([long_summary(m, df, rules[m]) for m, df in models.items() if rules.get(m)])


def require(results: DataFrame) -> None:
    """Raise one error listing every failed rule of a ``run_rules`` result.

    The result has one row per rule, a list that is written by hand.
    """
    failed = results.where("violations > 0").orderBy("model", "rule").collect()
    if failed:
        raise DataQualityError("Data quality validation failed:\n" + "\n".join(
            f"- {r.model}.{r.rule}: {r.violations} violations" for r in failed))


# --- set-based checks -------------------------------------------------------
def relationship(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a reference that no parent has; a null reference passes."""
    return orphans(child.where(F.col(child_key).isNotNull()), parent, child_key, parent_key)


def missing_columns(required: Sequence[str], df: DataFrame) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def freshness_gaps(df: DataFrame, date_column: str) -> DataFrame:
    """Calendar days between a table's first and last date that have no row."""
    present = df.select(F.to_date(date_column).alias("date")).where("date is not null").distinct()
    span = present.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    # One row; its sequence is one entry per calendar day.
    expected = span.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return expected.join(present, "date", "left_anti")


def reconcile(accounts: DataFrame, transactions: DataFrame, tolerance: str = "0.00000001") -> DataFrame:
    """Accounts whose balance differs from the sum of their transactions."""
    booked = transactions.groupBy(F.col("account_id").alias("_account")).agg(F.sum("amount").alias("booked"))
    diff = F.col("balance") - F.coalesce("booked", F.lit(0))
    return (
        accounts.join(booked, F.col("account_id") == F.col("_account"), "left")
        .select("account_id", "balance", F.coalesce("booked", F.lit(0)).alias("booked"), diff.alias("difference"))
        .where(F.abs("difference") > F.lit(tolerance).cast("decimal(18,8)"))
    )


def quarantine(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass and rejected rows with the names of broken rules."""
    tagged = df.withColumn("broken_rules", broken_rules(rules))
    valid = tagged.where(F.size("broken_rules") == 0).drop("broken_rules")
    return valid, tagged.where(F.size("broken_rules") > 0)


def broken_rules(rules: Sequence[RowRule]) -> Column:
    return F.filter(
        F.array(*[F.when(r.condition(), F.lit(r.name)) for r in rules]), lambda r: r.isNotNull()
    )
