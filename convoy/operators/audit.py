"""Rule-driven data audits.

A rule names a table and a column (and, for a foreign key, the referenced
table and column). Each rule is evaluated as one aggregation over its table,
producing one row ``(rule_id, rule, table_name, column_name, ref_table,
ref_column, violations, ok)``; the rows of all rules are unioned.

* ``primary_key`` / ``unique``: rows whose key value occurs more than once
  (``primary_key`` also counts NULL keys). Partial aggregation per key, so a
  key held by a huge number of rows costs one row per map task.
* ``not_null``: rows with a NULL value.
* ``foreign_key``: rows with a non-NULL key missing from the parent
  (left anti join; AQE broadcasts the parent only if it is small at runtime).
* ``max_length``: rows with a text longer than the declared ``length``.
* ``default``: rows where the column is NULL, i.e. where the declared default
  would have applied; :func:`apply_defaults` fills them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    rule: str
    table: str
    column: str
    ref_table: str | None = None
    ref_column: str | None = None
    default: object = None
    length: int | None = None

    @property
    def rule_id(self) -> str:
        ref = f"->{self.ref_table}.{self.ref_column}" if self.ref_table else ""
        return f"{self.rule}:{self.table}.{self.column}{ref}"


def orphan_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str,
                 null_is_orphan: bool = False) -> DataFrame:
    """One-row ``v``: child rows whose ``key`` has no parent row.

    Children are counted per key first (partial aggregation, so a key held by
    many rows becomes one row), and only the per-key counts meet the parent
    in the anti join. NULL keys never match; they count when
    ``null_is_orphan`` (a LEFT JOIN ... IS NULL check) and not for a foreign
    key constraint.
    """
    per_key = child.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    if not null_is_orphan:
        per_key = per_key.where(F.col("_k").isNotNull())
    ref = parent.select(F.col(parent_key).alias("_ref"))
    missing = per_key.join(ref, F.col("_k") == F.col("_ref"), "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("v"))


def _row(r: Rule, v: F.Column) -> F.Column:
    return F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.rule).alias("rule"),
        F.lit(r.table).alias("table_name"), F.lit(r.column).alias("column_name"),
        F.lit(r.ref_table).cast("string").alias("ref_table"),
        F.lit(r.ref_column).cast("string").alias("ref_column"),
        v.cast("bigint").alias("violations"))


def _key_violations(df: DataFrame, r: Rule) -> DataFrame:
    """One-row ``v``: rows whose key occurs more than once, and for a primary key
    rows without one. One aggregate on the column's own type; an empty table counts 0."""
    k, n = F.col("_k"), F.col("_n")
    per_key = df.groupBy(F.col(r.column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    bad = k.isNotNull() & (n > 1)
    if r.rule == "primary_key":
        bad = bad | k.isNull()
    return per_key.agg(F.coalesce(F.sum(F.when(bad, n)), F.lit(0)).alias("v"))


def _row_check(r: Rule) -> F.Column:
    """Rows of the table that break a rule on single rows."""
    if r.rule == "max_length":
        return F.count_if(F.coalesce(F.length(F.col(r.column)) > r.length, F.lit(False)))
    return F.count_if(F.col(r.column).isNull())


def audit(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """One row per rule with its violation count.

    Per table, all rules on single rows (``not_null``, ``default``,
    ``max_length``) are counted in one aggregation pass; each key rule
    (``unique``, ``primary_key``) is one aggregate on the key, each foreign key
    one anti join.
    """
    parts = []
    row_rules: dict[str, list[Rule]] = {}
    for r in rules:
        if r.rule in ("not_null", "default", "max_length"):
            row_rules.setdefault(r.table, []).append(r)
            continue
        if r.rule in ("unique", "primary_key"):
            v = _key_violations(tables[r.table], r)
        elif r.rule == "foreign_key":
            v = orphan_count(tables[r.table], r.column, tables[r.ref_table], r.ref_column)
        else:
            raise ValueError(f"unknown rule {r.rule}")
        parts.append(v.select(F.explode(F.array(_row(r, F.col("v")))).alias("r")))
    for table, rs in row_rules.items():
        counts = tables[table].agg(*[_row_check(r).alias(f"v{i}") for i, r in enumerate(rs)])
        parts.append(counts.select(F.explode(F.array(
            *[_row(r, F.col(f"v{i}")) for i, r in enumerate(rs)])).alias("r")))
    out = reduce(DataFrame.unionByName, parts).select("r.*")
    return out.withColumn("ok", F.col("violations") == 0)


def rules_frame(spark, rules: list[Rule]) -> DataFrame:
    """The constraint catalog itself as a DataFrame (which table/column
    references which)."""
    return spark.createDataFrame(
        [(r.rule_id, r.rule, r.table, r.column, r.ref_table, r.ref_column,
          None if r.default is None else str(r.default)) for r in rules],
        "rule_id string, rule string, table_name string, column_name string, "
        "ref_table string, ref_column string, default_value string")


def apply_defaults(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Fill declared defaults into NULL cells (``coalesce(col, default)``)."""
    out = df
    for r in rules:
        if r.rule == "default" and r.table == table:
            t = dict(df.dtypes)[r.column]
            out = out.withColumn(r.column, F.coalesce(F.col(r.column), F.lit(r.default).cast(t)))
    return out
