"""Column expressions for cleaning. All are built-in Spark expressions (codegen,
no Python in the data path) and keep NULL-on-failure semantics with ANSI mode
on: every cast is a ``try_cast``, every parse a ``try_to_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the source feed's conventions for right results.
# Placeholder text per posts column, as regular expressions searched anywhere in
# the value (a match anywhere nulls the whole value).
POSTS_PLACEHOLDERS = {
    "description": "(No description available|Untitled)",
    "follower_count": "User Info Error",
    "image_src": "Image src error.",
    "poster_name": "User Info Error",
    "tag_list": "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e",
    "title": "(^$|No Title Data Available)",
}
# Multiplier suffixes of follower counts: suffix -> text that replaces every
# occurrence of it (case-sensitive), and the power of ten it stands for.
FOLLOWER_SUFFIXES = {"k": ("000", 3), "M": ("000000", 6)}
# Text removed from save_location (every occurrence).
SAVE_LOCATION_PREFIX = "Local save in "
# Timestamp text format of the batch feed.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Age groups: (low, high, label), bounds inclusive; everything else gets AGE_OTHER.
AGE_GROUPS = [(18, 24, "18-24"), (25, 35, "25-35"), (36, 50, "36-50")]
AGE_OTHER = "50+"
# ---------------------------------------------------------------------------


def null_if_matches(c: Column, pattern: str) -> Column:
    """NULL where ``c`` contains a match of ``pattern``; NULL stays NULL."""
    return F.when(c.rlike(pattern), F.lit(None)).otherwise(c)


def text_to_int(c: Column, dtype: T.DataType | None = None) -> Column:
    """Integer from text, NULL when it does not parse or overflows.

    Text that is not a plain integer goes through decimal, so that ``'12.7'``
    gives 12 (truncation, as a non-ANSI cast would) instead of NULL; a plain
    integer takes the direct parse (same value, cheaper). Other types are cast
    directly.
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.try_cast("int")
    return F.coalesce(c.try_cast("int"), c.try_cast("decimal(38,10)").try_cast("int"))


def expand_suffix(c: Column, suffixes: dict = FOLLOWER_SUFFIXES, mode: str = "compat") -> Column:
    """Suffixed count text (``12k``, ``3M``) to int.

    ``compat``: a value ending in a suffix has *every* occurrence of it replaced
    by its zeros (``kk12k`` -> ``00000012000``), then the text is cast
    (``1.2k`` -> ``1.2000`` -> 1). ``exact``: the number before the suffix is
    multiplied out (``1.2k`` -> 1200); anything else must parse as is.
    """
    if mode not in ("compat", "exact"):
        raise ValueError(f"unknown mode {mode!r}")
    branch = None
    for suffix, (zeros, power) in suffixes.items():
        cond = c.endswith(suffix)
        if mode == "compat":
            val = F.regexp_replace(c, F.lit(suffix), F.lit(zeros))
            val = text_to_int(val)
        else:
            mantissa = c.substr(F.lit(1), F.length(c) - len(suffix))
            val = (mantissa.try_cast("decimal(38,10)") * F.lit(10 ** power)).try_cast("int")
        branch = F.when(cond, val) if branch is None else branch.when(cond, val)
    rest = text_to_int(c)
    return rest if branch is None else branch.otherwise(rest)


def strip_text(c: Column, pattern: str = SAVE_LOCATION_PREFIX) -> Column:
    """Remove every match of ``pattern`` (regex), not only a leading one."""
    return F.regexp_replace(c, F.lit(pattern), F.lit(""))


def split_list(c: Column, sep: str = ",") -> Column:
    """Split to an array keeping trailing empty parts (``'a,b,,'`` -> 4 parts)."""
    return F.split(c, sep, -1)


def pack_array(*cols: str | Column) -> Column:
    """Array of the given columns; never NULL itself, elements may be."""
    return F.array(*cols)


def join_name(first: str | Column, last: str | Column) -> Column:
    """``first + ' ' + last``; NULL when either part is NULL."""
    return F.concat(F.col(first) if isinstance(first, str) else first, F.lit(" "),
                    F.col(last) if isinstance(last, str) else last)


def parse_timestamp(c: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp by pattern; NULL when the text does not fit it."""
    return F.try_to_timestamp(c, F.lit(fmt))


def age_group(c: Column, groups=AGE_GROUPS, other: str = AGE_OTHER, strict: bool = False) -> Column:
    """Label of the inclusive range holding ``c``. Values outside every range,
    NULL included, get ``other`` (or NULL with ``strict=True``)."""
    expr = None
    for lo, hi, label in groups:
        cond = (c >= lo) & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string") if strict else F.lit(other))


def age_group_order(label: Column, groups=AGE_GROUPS, other: str = AGE_OTHER) -> Column:
    """Sort index of an age-group label (its position in ``groups``, ``other`` last)."""
    expr = None
    for i, (_, _, name) in enumerate(groups, start=1):
        cond = label == name
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.when(label == other, F.lit(len(groups) + 1))
