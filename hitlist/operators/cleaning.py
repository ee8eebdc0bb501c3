"""Chart cleaning (U1-U13) as a chain of projections.

Each rule is one ``select`` over the previous stage, so a rule that sets two
columns reads both from the old row, exactly like a single SQL UPDATE. Catalyst
collapses the chain into one Project inside the scan's codegen stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.functions import artist as A
from hitlist.schemas import CHART_CLEAN, CHART_COLUMNS

ARTIST = "Artist"
FEATURED = "Featured_Artist"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _replace(df: DataFrame, **updates: Column) -> DataFrame:
    """Set some columns from expressions over the *current* row, keep the others."""
    return df.select(*[updates[c].alias(c) if c in updates else _q(c) for c in df.columns])


# --------------------------------------------------------------------------- typing


def typed(raw: DataFrame) -> DataFrame:
    """U2-U4 (bootstrap form): Date to DATE, any ``Last Week`` containing '-' to 0, then INT.

    The sentinel must be replaced before the cast: under ANSI casts '-' raises.
    """
    lw = _q("Last Week")
    return _replace(
        raw,
        Date=_q("Date").cast("date"),
        **{"Last Week": F.when(lw.contains("-"), F.lit("0")).otherwise(lw).cast("int")},
    )


def sentinel_any_column(raw: DataFrame) -> DataFrame:
    """U3w (weekly form): every text cell equal to exactly '-' becomes '0'."""
    return raw.na.replace("-", "0")


def typed_weekly(raw: DataFrame) -> DataFrame:
    """U3w then the casts of U2/U4, as the weekly load does before appending."""
    df = sentinel_any_column(raw)
    return _replace(df, Date=_q("Date").cast("date"), **{"Last Week": _q("Last Week").cast("int")})


def add_featured(df: DataFrame) -> DataFrame:
    """Nullable featured-artist column."""
    return df.withColumn(FEATURED, F.lit(None).cast("string"))


# --------------------------------------------------------------------------- rules


def unquote(df: DataFrame) -> DataFrame:  # U5
    return _replace(df, Artist=A.unquote(_q(ARTIST)))


def _keyword_split(df: DataFrame, keyword: str) -> DataFrame:
    a = _q(ARTIST)
    gate = A.keyword_gate(a, keyword)
    return _replace(
        df,
        Artist=F.when(gate, A.keyword_part(a, keyword, 1)).otherwise(a),
        Featured_Artist=F.when(gate, A.keyword_part(a, keyword, 2)).otherwise(_q(FEATURED)),
    )


def featuring_split(df: DataFrame) -> DataFrame:  # U6
    return _keyword_split(df, A.FEATURING)


def feat_split(df: DataFrame) -> DataFrame:  # U7
    return _keyword_split(df, A.FEAT)


def separators_standardized(df: DataFrame) -> DataFrame:  # U8
    return _replace(df, Artist=A.standardize_separators(_q(ARTIST)))


def ampersand_corrected(df: DataFrame) -> DataFrame:  # U9
    return _replace(df, Artist=A.ampersand_to_comma(_q(ARTIST)))


def anchor_stripped(df: DataFrame) -> DataFrame:  # U10
    return _replace(df, Artist=A.strip_anchor(_q(ARTIST)))


def featured_standardized(df: DataFrame) -> DataFrame:  # U11
    return _replace(df, Featured_Artist=A.standardize_separators(_q(FEATURED)))


# In file order; each step sees the previous step's output.
STEPS: list[tuple[str, Callable[[DataFrame], DataFrame]]] = [
    ("artist_unquoted", unquote),
    ("featuring_split", featuring_split),
    ("feat_split", feat_split),
    ("separators_standardized", separators_standardized),
    ("ampersand_corrected", ampersand_corrected),
    ("anchor_stripped", anchor_stripped),
    ("featured_standardized", featured_standardized),
]
STEP_NAMES = [name for name, _ in STEPS]


def _conform(df: DataFrame) -> DataFrame:
    return df.select(*[_q(f.name).cast(f.dataType).alias(f.name) for f in CHART_CLEAN.fields])


def apply_rules(df: DataFrame, standardize_featured: bool = True, through: str | None = None) -> DataFrame:
    """U5-U11 over a typed frame that already has ``Featured_Artist``.

    ``standardize_featured=False`` is the weekly form (ends after U10);
    ``through`` stops after the named step.
    """
    for name, step in STEPS:
        if name == "featured_standardized" and not standardize_featured:
            break
        df = step(df)
        if name == through:
            break
    return df


def clean(raw_flagged: DataFrame, standardize_featured: bool = True, through: str | None = None) -> DataFrame:
    """Bootstrap cleaning U1-U11 of raw rows carrying ``is_new``."""
    df = add_featured(typed(raw_flagged))
    return _conform(apply_rules(df, standardize_featured, through))


def clean_new_rows(new_typed: DataFrame, standardize_featured: bool = False) -> DataFrame:
    """The weekly rules (U5-U10) applied to the new rows only.

    The caller unions the result with the untouched history, so no rule ever
    re-reads or rewrites stored rows.
    """
    df = new_typed if FEATURED in new_typed.columns else add_featured(new_typed)
    return _conform(apply_rules(df, standardize_featured))


def flags_reset(df: DataFrame) -> DataFrame:
    """Every row is processed once the refresh commits."""
    return _replace(df, is_new=F.lit(False))


def raw_columns(df: DataFrame) -> DataFrame:
    return df.select(*[_q(c) for c in CHART_COLUMNS])
