"""Coercion and text expressions (E1, E4, E11-E13, NaN handling).

Every helper returns a ``Column``; nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_if_nan(col) -> Column:
    """NaN -> NULL (pandas treats both as missing; Spark ``avg`` does not)."""
    return F.nanvl(_c(col), F.lit(None).cast("double"))


def to_double(col) -> Column:
    """``to_numeric(errors='coerce')`` - bad text and NaN become NULL.

    The JVM's number syntax also has type suffixes (``12d``, ``5F``) and hexadecimal floats,
    which are codes here, not numbers; ``inf`` ends in a suffix letter but is a number.
    """
    value, text = _c(col), F.lower(strip_ws(_c(col).cast("string")))
    suffixed = F.right(text, F.lit(1)).isin("d", "f") & (F.right(text, F.lit(3)) != "inf")
    number = F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))
    return F.when(~(suffixed | text.contains("x")), number)


def computed_once(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """``df`` with the columns ``cols``, each computed once per row.  The optimiser copies a projected
    expression into every filter, key and aggregate above it; it does not copy a generator's output."""
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, F.inline(F.array(F.struct(*[v.alias(k) for k, v in cols.items()]))))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply ``null_if_nan`` to every floating column of ``df``."""
    cols = {f.name: null_if_nan(f.name) for f in df.schema.fields
            if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(cols) if cols else df


# Fixed value: the ASCII whitespace set Python's ``str.strip()`` removes.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(col) -> Column:
    """Python ``str.strip()``: all leading/trailing whitespace, not only
    spaces as Spark ``trim`` does (Q22).  ``btrim`` with a character set is
    a plain scan, no regular expression."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def upper_key(col) -> Column:
    """Upper-cased, stripped text key.  NULL stays NULL (Q12)."""
    return F.upper(strip_ws(_c(col).cast("string")))


def hs4_from_code(col) -> Column:
    """Keep digits only, first four characters (HS8 -> HS4)."""
    return F.substring(F.regexp_replace(_c(col).cast("string"), r"[^0-9]", ""), 1, 4)


# Canonical grade codes, tested in this order on the upper-cased,
# stripped text; anything else is kept as that text.
GRADE_PATTERNS = [
    ("EXTRA", "EVOO"),
    ("LAMPANTE", "LAMPANTE"),
    ("POMACE", "POMACE"),
    ("REFINED", "REFINED"),
    ("VIRGIN", "VIRGIN"),
]


def canon_grade(col) -> Column:
    """Canonical olive-oil grade from free text."""
    key = upper_key(col)
    expr = None
    for needle, code in GRADE_PATTERNS:
        cond = key.contains(needle)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(key)


# Text forms of a date, tried in order; optional parts in brackets.  A text matches at most one
# form of each group in full, so the order only decides how many parses a row costs.
TIME = "HH:mm[:ss[.SSSSSSSSS]]"
ISO_FORMATS = [f"yyyy-M-d[ {TIME}][XXX]", f"yyyy-M-d'T'{TIME}[XXX]", f"yyyy/M/d[ {TIME}]", "yyyyMMdd",
               "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy"]
MONTH_FIRST = [f"M/d/yyyy[ {TIME}]", f"M.d.yyyy[ {TIME}]", f"M-d-yyyy[ {TIME}]"]
DAY_FIRST = [f"d/M/yyyy[ {TIME}]", f"d.M.yyyy[ {TIME}]", f"d-M-yyyy[ {TIME}]"]


#: A plain ISO date.
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def date_formats(dayfirst: bool = False) -> list[str]:
    """All forms; ``03/04/2024`` is 4 March unless ``dayfirst``, and a form that cannot be read
    in the preferred order (``13/04/2024``) is read in the other."""
    return ISO_FORMATS + (DAY_FIRST + MONTH_FIRST if dayfirst else MONTH_FIRST + DAY_FIRST)


def parse_date_text(col, formats=None, dayfirst: bool = False) -> Column:
    """Date text -> timestamp, bad -> NULL; a zone suffix is converted to the session's
    zone, and no zone is kept.  Plain ISO dates, the usual case, are seen by their shape."""
    text = strip_ws(_c(col).cast("string"))
    plain = [] if formats else [F.when(text.rlike(ISO_DATE), text.try_cast("date").cast("timestamp"))]
    return F.coalesce(*plain, *[F.try_to_timestamp(text, F.lit(f)) for f in (formats or date_formats(dayfirst))])
