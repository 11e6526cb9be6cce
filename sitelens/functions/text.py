"""Column-level text helpers (all JVM-side expressions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the audited tool's behaviour.
# Placeholder written when a field is absent from a page.
MISSING = "Mancante"
# Tokens a pandas CSV reader turns into null by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")

# Python's str.strip() set: Unicode White_Space plus the \x1c-\x1f separators.
_STRIP_RE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def py_strip(c: Column) -> Column:
    """Strip like Python ``str.strip()`` (Spark ``trim`` removes spaces only)."""
    return F.regexp_replace(c, _STRIP_RE, "")


def is_missing(c: Column) -> Column:
    """Sentinel, null, or blank after strip.  Never null itself."""
    return (c.isNull() | (c == F.lit(MISSING))
            | (py_strip(c.cast("string")) == F.lit(""))).eqNullSafe(True)


def any_of(preds) -> Column:
    """OR-fold of predicates, false when there are none."""
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def slash_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))


def null_if_na_token(c: Column) -> Column:
    """pandas-style NA tokens become null."""
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _py_float_layout(p: Column) -> Column:
    """``d.ddde+XX`` (shortest digits) -> Python's layout of that float."""
    sci = r"^(-?)(\d)\.(\d+)e([+-]\d+)$"
    sign = F.regexp_extract(p, sci, 1)
    lead = F.regexp_extract(p, sci, 2)
    frac = F.regexp_replace(F.regexp_extract(p, sci, 3), "0+$", "")
    digits = F.concat(lead, frac)
    e = F.regexp_extract(p, sci, 4).cast("int")
    n = F.length(digits)
    int_part = F.when(n > e + 1, F.substring(digits, 1, e + 1)).otherwise(
        F.concat(digits, F.repeat(F.lit("0"), e + 1 - n)))
    frac_part = F.when(n > e + 1, F.substring(digits, e + 2, F.lit(400))).otherwise(F.lit("0"))
    mantissa = F.concat(lead, F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")))
    expo = F.concat(F.when(e >= 0, F.lit("+")).otherwise(F.lit("-")),
                    F.lpad(F.abs(e).cast("string"), 2, "0"))
    return (F.when((e >= 0) & (e < 16), F.concat(sign, int_part, F.lit("."), frac_part))
            .when((e < 0) & (e >= -4), F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
            .otherwise(F.concat(sign, mantissa, F.lit("e"), expo)))


def py_float_text(d: Column) -> Column:
    """A double as Python's ``repr`` writes it (``12500000.0``, ``1e-05``,
    ``1.5e+16``).  For 1e-3 <= |x| < 1e7 the JVM's plain text already is
    that; otherwise the shortest of the 15/16/17-significant-digit renderings
    that reads back as the same double is laid out the Python way.  The slow
    path sits inside a one-element ``transform`` so that none of it is
    evaluated (or hoisted as a common sub-expression) for plain values."""
    t = d.cast("string")

    def slow(x: Column) -> Column:
        cands = [F.format_string(f"%.{p - 1}e", x) for p in (15, 16, 17)]
        pick = (F.when(cands[0].cast("double") == x, cands[0])
                .when(cands[1].cast("double") == x, cands[1]).otherwise(cands[2]))
        return F.get(F.transform(F.array(pick), _py_float_layout), 0)

    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(~t.contains("E") & ~F.isnan(d) & (F.abs(d) != float("inf")) & (d != 0), t)
            .when(F.isnan(d), F.lit("nan"))
            .when(d == float("inf"), F.lit("inf")).when(d == float("-inf"), F.lit("-inf"))
            .when(d == 0, F.when(t.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
            .otherwise(F.get(F.transform(F.array(d), slow), 0)))
