"""Q1-Q5: declared constraints re-aimed as data-quality checks.

Every check returns a violations DataFrame with one row per offending value:
``table_name, rule, value, n_rows`` (empty = the rule holds). Checks are
aggregations or anti joins; nothing is collected. ``violations`` checks whole models: one scan of
each table counts what its rules need (one row to the driver), and only rules that those counts
don't prove are listed row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATION_COLUMNS = ["table_name", "rule", "value", "n_rows"]


def _repr(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in cols])


def _shape(df: DataFrame, table: str, rule: str, cols: list[str], count_col: str = "count") -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), _repr(cols).alias("value"), F.col(count_col).cast("long").alias("n_rows")
    )


def pk_violations(df: DataFrame, table: str, key_cols: list[str]) -> DataFrame:
    """Q1: key values that are NULL or held by more than one row."""
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in key_cols])
    g = df.groupBy(*[F.col(f"`{c}`") for c in key_cols]).count().filter((F.col("count") > 1) | any_null)
    return _shape(g, table, f"primary key ({', '.join(key_cols)})", key_cols)


def unique_violations(df: DataFrame, table: str, col: str) -> DataFrame:
    """Q2: non-NULL values held by more than one row (UNIQUE allows many NULLs)."""
    g = df.groupBy(F.col(f"`{col}`")).count().filter(F.col(f"`{col}`").isNotNull() & (F.col("count") > 1))
    return _shape(g, table, f"unique ({col})", [col])


def fk_violations(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str, parent_table: str) -> DataFrame:
    """Q3: non-NULL child values with no parent row. Values are counted first, so that the join
    moves each once a task and not with every row."""
    c = F.col(f"`{col}`")
    counts = child.filter(c.isNotNull()).groupBy(c).count()
    keys = parent.select(F.col(f"`{parent_col}`").alias("_key"))
    g = counts.join(keys, c == F.col("_key"), "left_anti")
    return _shape(g, table, f"foreign key ({col}) -> {parent_table} ({parent_col})", [col])


def domain_violations(df: DataFrame, table: str, col: str, allowed: list[str]) -> DataFrame:
    """Q4: non-NULL values outside the allowed set."""
    c = F.col(f"`{col}`")
    g = df.filter(c.isNotNull() & ~c.isin(*allowed)).groupBy(c).count()
    return _shape(g, table, f"check ({col} in {', '.join(allowed)})", [col])


def length_violations(df: DataFrame, table: str, col: str, limit: int) -> DataFrame:
    """Q5: values longer than the declared VARCHAR limit."""
    c = F.col(f"`{col}`")
    g = df.filter(F.length(c) > limit).groupBy(c).count()
    return _shape(g, table, f"length ({col}) <= {limit}", [col])


def too_long(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Q5 for all limited columns of a table in one pass."""
    cells = [
        F.struct(F.lit(f"length ({c}) <= {n}").alias("rule"), F.col(f"`{c}`").alias("value"), F.lit(n).alias("limit"))
        for c, n in limits.items()
    ]
    long = df.select(F.inline(F.array(*cells))).filter(F.length("value") > F.col("limit"))
    g = long.groupBy("rule", "value").count()
    return g.select(F.lit(table).alias("table_name"), "rule", "value", F.col("count").cast("long").alias("n_rows"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass(frozen=True)
class Rules:
    """What a table declares: its key, unique columns, references (column to table and column),
    allowed values and length limits by column."""

    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    limits: dict[str, int] = field(default_factory=dict)


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def _whole(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.IntegralType)


def facts(df: DataFrame, rules: Rules, referenced: set[str] = frozenset()) -> Row:
    """One row of counts over one scan: rows, distinct keys without nulls, distinct and present
    unique values, smallest and largest whole numbers of references and referenced columns, values
    outside the allowed ones, texts that are too long."""
    out = {"rows": F.count(F.lit(1))}
    if rules.key:
        out["keys"] = F.count_distinct(*map(_col, rules.key))
    for c in rules.unique:
        out[f"present {c}"], out[f"distinct {c}"] = F.count(_col(c)), F.count_distinct(_col(c))
    for c in {*rules.references, *referenced}:
        if _whole(df, c):
            out[f"least {c}"], out[f"most {c}"] = F.min(_col(c)), F.max(_col(c))
    for c, values in rules.allowed.items():
        out[f"outside {c}"] = F.count_if(~_col(c).isin(*values))
    if rules.limits:
        out["long"] = F.count_if(reduce(lambda a, b: a | b, [F.coalesce(F.length(_col(c)) > n, F.lit(False)) for c, n in rules.limits.items()]))
    return df.agg(*(c.alias(name) for name, c in out.items())).first()


def _references_hold(child: dict, c: str, parent: dict, rules: Rules, parent_col: str) -> bool:
    """Proven by counts alone: the parent's distinct whole-number keys leave no gap between the
    smallest and the largest, and all child values lie between these."""
    if f"least {c}" not in child or f"least {parent_col}" not in parent or rules.key != (parent_col,):
        return False
    low, high = parent[f"least {parent_col}"], parent[f"most {parent_col}"]
    if child[f"least {c}"] is None:
        return True
    return low is not None and parent["keys"] == high - low + 1 and low <= child[f"least {c}"] and child[f"most {c}"] <= high


def violations(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """Q1-Q5 over a model: the same rows as the single checks give together."""
    tables = {t: df for t, df in tables.items() if t in rules}
    referenced = {t: {pc for t2 in tables for p, pc in rules[t2].references.values() if p == t} for t in tables}
    seen = {t: facts(df, rules[t], referenced[t]).asDict() for t, df in tables.items()}
    found = []
    for t, df in tables.items():
        r, n = rules[t], seen[t]
        if r.key and n["keys"] < n["rows"]:
            found.append(pk_violations(df, t, list(r.key)))
        found += [unique_violations(df, t, c) for c in r.unique if n[f"distinct {c}"] < n[f"present {c}"]]
        for c, (parent, pc) in r.references.items():
            if not _references_hold(n, c, seen[parent], rules[parent], pc):
                found.append(fk_violations(df, t, c, tables[parent], pc, parent))
        found += [domain_violations(df, t, c, list(v)) for c, v in r.allowed.items() if n[f"outside {c}"]]
        if r.limits and n["long"]:
            found.append(too_long(df, t, r.limits))
    if found:
        return union_all(found)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([], "table_name string, rule string, value string, n_rows long")
