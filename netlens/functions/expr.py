"""Column-expression builders shared by the operators.

Everything here returns a ``Column`` (JVM-side, code-generated) or a
DataFrame transform built from built-in functions; nothing runs per row in
Python.  Driver-side helpers only validate or escape user arguments.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


# ------------------------------------------------------------ argument helpers
def has_value(x) -> bool:
    """Driver-side "no value" test for a parameter: None, blank or "null"."""
    if x is None:
        return False
    s = str(x).strip()
    return s != "" and s.lower() != "null"


def csv_list(x, upper: bool = False) -> list[str]:
    """Comma-separated parameter -> trimmed non-blank items."""
    if not has_value(x):
        return []
    items = [p.strip() for p in str(x).split(",") if p.strip()]
    return [p.upper() for p in items] if upper else items


def escape_regex(text: str) -> str:
    """Literal text as a Java regex fragment."""
    return re.sub(r"([\\.\[\]{}()*+?^$|/-])", r"\\\1", text)


def prefix_regex(text: str, space_flexible: bool = False) -> str:
    """Case-insensitive starts-with regex of a literal; optionally any run of
    spaces in the input matches any run of white space."""
    esc = escape_regex(text.strip())
    if space_flexible:
        esc = re.sub(r"\s+", r"\\s*", esc)
    return "(?i)^" + esc


# ---------------------------------------------------------------- column rules
def col_has_value(c) -> Column:
    """Column is non-null and not blank."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def link_type_key(relation="relation", link_type="link_type") -> Column:
    """Edge identity part: ISIS links are keyed by link type (blank == null),
    other relations ignore it."""
    rel = F.col(relation) if isinstance(relation, str) else relation
    lt = F.col(link_type) if isinstance(link_type, str) else link_type
    return F.when(F.upper(rel) == S.ISIS, F.coalesce(F.trim(lt), F.lit(""))).otherwise(F.lit(""))



def extracting_id(c) -> Column:
    """Last '_'-separated segment of a name."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "^.*_", "")


def has_coordinates(strict: bool = False, lat="latitude", lng="longitude") -> Column:
    """Coordinates present; strict = both parse as double."""
    la, lo = F.col(lat), F.col(lng)
    if strict:
        return (la.cast("string").try_cast("double").isNotNull()
                & lo.cast("string").try_cast("double").isNotNull())
    return col_has_value(la) & col_has_value(lo)


def num_or_text_cmp(left: Column, op: str, right: str) -> Column:
    """Compare numerically when both sides parse as double, else as
    case-insensitive text."""
    ln = left.cast("string").try_cast("double")
    try:
        rn = float(right)
    except ValueError:
        rn = None
    lt = F.lower(left.cast("string"))
    rt = F.lit(right.lower())
    ops = {
        ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "!=": lambda a, b: a != b,
        "=": lambda a, b: a == b, ">": lambda a, b: a > b, "<": lambda a, b: a < b,
    }
    f = ops[op]
    text = f(lt, rt)
    if rn is None:
        return F.coalesce(text, F.lit(False))
    return F.coalesce(F.when(ln.isNotNull(), f(ln, F.lit(rn))).otherwise(text), F.lit(False))


def num_or_text_sort(c: Column, descending: bool = False) -> list[Column]:
    """Sort keys for mixed numeric/text values: numbers first (by value), then
    text (case-insensitive), nulls last; descending is the exact reverse."""
    num = c.cast("string").try_cast("double")
    txt = F.lower(c.cast("string"))
    if descending:
        return [c.isNull().desc(), num.isNull().desc(), num.desc(), txt.desc()]
    return [c.isNull().asc(), num.isNull().asc(), num.asc(), txt.asc()]


# ------------------------------------------------------------------ paging
def page(df: DataFrame, order: list[Column], lower: int, upper: int,
         inclusive: bool = False) -> DataFrame:
    """Rows ``[lower, upper)`` (or ``[lower, upper]``) of ``df`` in a total
    order.  A global row_number needs one ordered stream, so the page is taken
    with ``orderBy`` + ``offset``/``limit``: Spark plans that as a distributed
    sort (range partitioned) whose last step reads only the first
    ``upper`` rows (TakeOrderedAndProject for a small upper bound)."""
    n = upper - lower + (1 if inclusive else 0)
    if n <= 0:
        return df.limit(0)
    return df.orderBy(*order).offset(lower).limit(n)
