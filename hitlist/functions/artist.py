"""Artist-credit rules as Column expressions (JVM-side, no UDF).

Every function maps an input Column to an output Column; predicates that are
NULL leave the value unchanged, as a SQL UPDATE ... WHERE would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's values for identical results.
# ---------------------------------------------------------------------------
# Separators between co-credited acts (case-insensitive, surrounded by whitespace).
SEPARATOR_REGEX = r"\s+(x|&|\+|/|with|duet with)\s+"
SEPARATOR_REPLACEMENT = " , "
# Acts whose own name contains a separator; a credit naming one skips separator
# rewriting entirely (case-sensitive match).
PROTECTED_ACTS = [
    "Mumford & Sons",
    "Simon & Garfunkel",
    "She & Him",
    "Nico & Vinz",
    "Zay Hilfigerrr & Zayion McCall",
    "Dan + Shay",
    "Florence + The Machine",
    "Lil Nas X",
    "X Ambassadors",
    "Audrey Nuna & REI AMI",
]
# Credits naming one of these (case-insensitive) get every '&' turned into ','.
AMPERSAND_TO_COMMA_ACTS = ["Lil Nas X", "Dan + Shay", "Florence + The Machine"]
# A leaked HTML anchor; the credit is the trimmed text after it.
LEAKED_ANCHOR = '<a href="https://www.billboard.com/artist/lil-Nas-x/">'
# An act whose name contains the list delimiter; rows naming it are left out of
# the artist list and of the song-artist bridge.
COMMA_ACT = "Tyler, The Creator"
# Featured-credit keywords, split case-sensitively after a case-insensitive gate.
FEATURING = "Featuring"
FEAT = "Feat."
# Delimiter of the standardised multi-artist credit.
LIST_DELIMITER = ","


def _contains_ci(c: Column, text: str) -> Column:
    return c.ilike(f"%{text}%")


def unquote(c: Column) -> Column:
    """Strip leading/trailing double quotes when the credit contains one."""
    return F.when(c.contains('"'), F.btrim(c, F.lit('"'))).otherwise(c)


def keyword_gate(c: Column, keyword: str) -> Column:
    """U6/U7 gate: the credit mentions the keyword in any letter case."""
    return _contains_ci(c, keyword)


def keyword_part(c: Column, keyword: str, part: int) -> Column:
    """Trimmed part 1 (main act) or 2 (featured acts) of a case-sensitive split."""
    return F.trim(F.split_part(c, F.lit(keyword), F.lit(part)))


def standardize_separators(c: Column) -> Column:
    """Rewrite every separator to ' , ' unless a protected act is named."""
    pattern = "(?i)" + SEPARATOR_REGEX
    not_protected = ~reduce(lambda a, b: a | b, [c.contains(name) for name in PROTECTED_ACTS])
    # a credit without a separator comes back as it is: it isn't searched for one beforehand
    return F.when(not_protected, F.regexp_replace(c, F.lit(pattern), F.lit(SEPARATOR_REPLACEMENT))).otherwise(c)


def ampersand_to_comma(c: Column) -> Column:
    """For credits naming one of three acts, every '&' becomes ','."""
    gate = reduce(lambda a, b: a | b, [_contains_ci(c, name) for name in AMPERSAND_TO_COMMA_ACTS])
    return F.when(gate, F.replace(c, F.lit("&"), F.lit(","))).otherwise(c)


def strip_anchor(c: Column) -> Column:
    """Keep the trimmed text after a leaked anchor (gate ignores case, split does not)."""
    return F.when(_contains_ci(c, LEAKED_ANCHOR), F.trim(F.split_part(c, F.lit(LEAKED_ANCHOR), F.lit(2)))).otherwise(c)


def names_without_comma_act(c: Column) -> Column:
    """Credit usable as a name list: NULL when it names the comma act.

    A string-to-array split of '' yields no elements, so '' also maps to NULL
    (Spark's ``split('')`` would yield one empty name).
    """
    return F.when(~c.contains(COMMA_ACT) & (c != F.lit("")), c)


def split_names(c: Column) -> Column:
    """Array of trimmed names of a standardised credit (empty names kept)."""
    return F.transform(F.split(c, F.lit(LIST_DELIMITER), -1), lambda x: F.trim(x))
