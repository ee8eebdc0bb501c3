"""Types of text columns found from the data, and rows whose cells don't fit kept apart.

A load without a schema infers the types; one with a schema must say what it could not
read. Both look at every cell of the whole table: ``inferred_types`` is one aggregate over all
columns, ``accepted`` and ``rejected`` are projections of one scan, over cells that are read once each.

A cell is empty if it is null or has only white space; empty cells fit every type and are null
in typed rows. ``rejected`` has a row for each cell that doesn't fit, with its row's cells. Rows
that repeat are kept and rejected as often as they occur. Without rows, or with empty cells
only, a column is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types in the order they are tried, with what a cell of each looks like.
TRIED = [("int", r"[+-]?\d{1,10}"), ("bigint", r"[+-]?\d{1,19}"), ("double", r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"), ("date", r"\d{4}-\d{2}-\d{2}")]
#: The characters of ``\s``. Taking them off as a set needs no regular expression.
WHITE_SPACE = " \t\n\x0b\f\r"


def _cell(name: str) -> Column:
    """A trimmed cell."""
    return F.btrim(F.col(f"`{name}`"), F.lit(WHITE_SPACE))


def _filled(name: str) -> Column:
    """Whether a cell has more than white space; null or false if it is empty."""
    return _cell(name) != F.lit("")


def _as(name: str, kind: str) -> Column:
    """The cell as a type; null if it doesn't fit."""
    shape = dict(TRIED).get(kind)
    if shape is None:
        return F.col(f"`{name}`")
    cell = _cell(name)
    return F.when(cell.rlike(f"^({shape})$"), cell.try_cast(kind))


def inferred_types(text: DataFrame) -> DataFrame:
    """(column_name, type, n_values, n_empty): of each text column the first type of ``TRIED`` that
    all its values fit, else string."""
    every = []
    for name in text.columns:
        counts = [F.count(_as(name, kind)).alias(kind) for kind, _ in TRIED]
        every.append(F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(_filled(name)).alias("values"), *counts).alias(name))
    one = text.agg(*every)
    found = []
    for name in text.columns:
        values = F.col(f"`{name}`.values")
        kind = F.lit("string")
        for tried, _ in reversed(TRIED):
            kind = F.when((values > 0) & (F.col(f"`{name}`.{tried}") == values), tried).otherwise(kind)
        found.append(
            F.struct(
                F.lit(name).alias("column_name"),
                kind.alias("type"),
                values.alias("n_values"),
                (F.col(f"`{name}`.rows") - values).alias("n_empty"),
            )
        )
    return one.select(F.inline(F.array(*found)))


def typed_schema(text: DataFrame) -> T.StructType:
    """The schema that ``inferred_types`` gives, a row for each column on the driver."""
    kinds = {r["column_name"]: r["type"] for r in inferred_types(text).collect()}
    return T.StructType.fromDDL(", ".join(f"`{c}` {kinds[c]}" for c in text.columns))


def _read(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Of the n-th column of ``schema`` the cell (``cell_n``), and unless it is text its value
    (``value_n``) and whether it has one (``filled_n``). Rows come out of a generator: Spark would push what is asked of
    a projection's columns below it, and read every cell again for each use."""
    cells = []
    for n, f in enumerate(schema.fields):
        cell, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        cells.append(cell.alias(f"cell_{n}"))
        if not isinstance(f.dataType, T.StringType):
            cells += [_as(f.name, kind).alias(f"value_{n}"), F.coalesce(_filled(f.name), F.lit(False)).alias(f"filled_{n}")]
    return text.select(F.inline(F.array(F.struct(*cells))))


def _misfit(n: int) -> Column:
    return F.col(f"value_{n}").isNull() & F.col(f"filled_{n}")


def _checked(schema: T.StructType) -> list[tuple[int, T.StructField]]:
    return [(n, f) for n, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]


def accepted(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows all of whose cells fit ``schema``, typed."""
    misfit, typed = F.lit(False), {n for n, _ in _checked(schema)}
    for n in sorted(typed):
        misfit = misfit | _misfit(n)
    values = (F.col(f"value_{n}" if n in typed else f"cell_{n}").alias(f.name) for n, f in enumerate(schema.fields))
    return _read(text, schema).filter(~misfit).select(*values)


def rejected(text: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, reason, value) of each cell that doesn't fit, and its row's cells."""
    found = [
        F.when(
            _misfit(n),
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(f"not {f.dataType.simpleString()}").alias("reason"), F.col(f"cell_{n}").alias("value")
            ),
        )
        for n, f in _checked(schema)
    ]
    cells = [F.col(f"cell_{n}").alias(f.name) for n, f in enumerate(schema.fields)]
    out = _read(text, schema).select(F.explode(F.array_compact(F.array(*found))).alias("_found"), *cells)
    return out.select("_found.*", *(F.col(f"`{f.name}`") for f in schema.fields))
