"""Column-to-column expressions: coercion, code maps, bands, labels and scores.

Every function builds a native Spark expression, so it stays inside code
generation and works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"
NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def to_number(col: Column) -> Column:
    """Text to double; blanks and unparsable text become null."""
    text = F.btrim(col.cast("string"), F.lit(BLANKS))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def fill_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def _sql(value) -> str:
    """A constant as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def map_codes(col: Column, codes: Mapping, strict: bool = False, name: str = "") -> Column:
    """Look a value up in a small fixed map; unmapped is null, or an error if strict.

    A map lookup names its input once, so stacked expressions stay small for the optimizer.
    """
    pairs = ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in codes.items())
    found = F.try_element_at(F.expr(f"map({pairs})"), col)
    if strict:
        message = F.concat(
            F.lit(f"unmapped value in {name}: "), F.coalesce(col.cast("string"), F.lit("null"))
        )
        return F.coalesce(found, F.raise_error(message).cast("int"))
    return found


def trimmed_yes_no(col: Column) -> Column:
    """' Yes ' and ' No ' to 1 and 0, anything else to null."""
    return map_codes(F.btrim(col, F.lit(BLANKS)), {"Yes": 1, "No": 0})


def label_or_self(col: Column, labels: Mapping) -> Column:
    return F.coalesce(map_codes(col, labels), col.cast("string"))


def indicator(col: Column, value) -> Column:
    """1 where the column equals the value, else 0 (null counts as 0)."""
    return col.eqNullSafe(F.lit(value)).cast("byte")


def row_sum(cols: Sequence[Column]) -> Column:
    """Sum across columns, skipping nulls."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in cols])


def ratio(num: Column, den: Column, on_zero: str = "inf") -> Column:
    """num / den; a zero divisor gives a signed infinity (0/0 is NaN) or null."""
    if on_zero not in ("inf", "null"):
        raise ValueError("on_zero must be 'inf' or 'null'")
    num, den = num.cast("double"), den.cast("double")
    if on_zero == "null":
        return F.when(den != 0, num / den)
    return F.when(den == 0, num * F.lit(float("inf"))).otherwise(num / den)


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-open, right-closed band label; values outside every band are null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    out = F.when(col <= edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(col <= edge, F.lit(label))
    return out


def tenure_group(col: Column) -> Column:
    return (
        F.when(col <= 12, F.lit("Under 1 year"))
        .when(col <= 24, F.lit("Between 1 and 2 years"))
        .otherwise(F.lit("2 or more years"))
    )


def internet_label(fiber: Column, none: Column) -> Column:
    return (
        F.when(fiber == 1, F.lit("Fiber Optic"))
        .when(none == 1, F.lit("No Internet"))
        .otherwise(F.lit("DSL"))
    )


def score_points(rules: Sequence[tuple[Column, int]]) -> Column:
    """Sum of points of the rules that hold; a null condition scores nothing."""
    return reduce(add, [F.when(cond, F.lit(points)).otherwise(F.lit(0)) for cond, points in rules])


def percent_text(col: Column) -> Column:
    return F.format_string("%.1f%%", col)


def money_text(col: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(col, 0))


def clip_text(col: Column, length: int = 250) -> Column:
    return F.substring(col.cast("string"), 1, length)
