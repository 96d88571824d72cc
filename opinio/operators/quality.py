"""Load-quality audit: D1 (constraints), D2/M13 (cascade delete), D3 (column defaults),
S8/S9 (table profile and preview).

Every rule is a filter, an aggregate with ``having`` or an anti join, producing rows of
``(table_name, rule, key)``; violations are data, never exceptions, and nothing is dropped
silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATION_COLS = ("table_name", "rule", "key")


def _v(df: DataFrame, table: str, rule: str, key: Column) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), key.cast("string").alias("key"))


def row_checks(df: DataFrame, table: str, key: str, checks) -> DataFrame:
    """All row rules of a table in one pass: ``checks`` are (rule, condition that breaks it); a
    row gives one violation per broken rule (a condition that is NULL breaks nothing)."""
    broken = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in checks]), lambda r: r.isNotNull())
    return (df.select(F.lit(table).alias("table_name"), F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key")))


def not_null(df: DataFrame, table: str, col: str, key: str) -> DataFrame:
    return _v(df.where(F.col(col).isNull()), table, f"{col} not null", F.col(key))


def max_length(df: DataFrame, table: str, col: str, n: int, key: str) -> DataFrame:
    return _v(df.where(F.length(col) > n), table, f"{col} length <= {n}", F.col(key))


def in_domain(df: DataFrame, table: str, col: str, domain, key: str) -> DataFrame:
    return _v(df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(domain))), table, f"{col} in domain", F.col(key))


def unique(df: DataFrame, table: str, cols, rule: str | None = None) -> DataFrame:
    """Keys held by more than one row (partial + final aggregate on the key)."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return _v(g, table, rule or f"unique({', '.join(cols)})", F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))


def foreign_key(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str, parent_name: str) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti join on the key)."""
    orphans = child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return _v(orphans, table, f"{fk} references {parent_name}.{pk}", F.col(fk))


def outside(col: str, low, high) -> Column:
    """A value that a bounded column cannot hold."""
    return (F.col(col) < low) | (F.col(col) > high)


def union_all(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def cascade_delete(children: DataFrame, deleted_ids: DataFrame, fk: str = "corpus_id") -> DataFrame:
    """Child rows that survive deleting ``deleted_ids`` (ON DELETE CASCADE)."""
    return children.join(deleted_ids.select(F.col("id").alias(fk)).distinct(), fk, "left_anti")


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """D3: fill NULLs with the column defaults of the schema."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column ``(column_name, data_type, n_rows, n_nulls, n_distinct)`` in one pass
    (one aggregate, then an unpivot of its single row). ``exact=False`` uses HyperLogLog
    sketches (``approx_count_distinct``): mergeable partial states instead of one distinct
    shuffle per column — the choice for wide tables at scale."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c, kind in df.dtypes:
        # strings are counted by their digest: texts themselves would be shuffled as group keys
        value = F.unhex(F.sha2(F.col(c).cast("binary"), 256)) if kind == "string" else F.col(c)
        dist = F.count_distinct(value) if exact else F.approx_count_distinct(F.col(c))
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), dist.alias(f"{c}__distinct")]
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                     F.col("_rows").alias("n_rows"), F.col(f"{c}__nulls").alias("n_nulls"),
                     F.col(f"{c}__distinct").alias("n_distinct")) for c in df.columns]
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows (a sample for eyeballing; the limit is the feature)."""
    return df.limit(n)
