"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpanel.functions.fixed_values import EARTH_RADIUS_KM, MILES_PER_KM

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Backquote a column name, so that names such as ``est<5`` or ``a.b`` work."""
    return "`" + name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, without the excluded ones."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def zero_pad(c: ColumnLike, width: int) -> Column:
    """Left-pad with zeros; text already longer than ``width`` is kept whole."""
    text = as_column(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def parse_number(c: ColumnLike, to: str = "double", sentinels: Sequence[str] = ()) -> Column:
    """Text to number: commas and blanks removed, anything unparsable is NULL.

    Whole numbers go through decimals, not doubles, so all their digits count; a
    text with a fraction is no whole number and gives NULL unless it is zero.
    """
    text = F.trim(F.replace(as_column(c).cast("string"), F.lit(","), F.lit("")))
    if sentinels:
        text = F.when(~text.isin(list(sentinels)), text)
    if to in ("long", "int", "bigint", "integer"):
        exact = text.try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact).try_cast(to)
    value = text.try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if to == "double" else value.try_cast(to)


def nan_to_null(c: ColumnLike) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def half_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round half to even, as the source data's tools do."""
    return F.bround(as_column(c).cast("double"), digits)


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b with NULL for a zero divisor."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def not_in(c: ColumnLike, values: Sequence) -> Column:
    """``NOT IN`` that keeps rows whose value is NULL."""
    return ~F.coalesce(as_column(c).isin(list(values)), F.lit(False))


def matches(c: ColumnLike, pattern: str, ignore_case: bool = False) -> Column:
    """Regular-expression search; NULL never matches."""
    flag = "(?i)" if ignore_case else ""
    return F.coalesce(as_column(c).rlike(flag + pattern), F.lit(False))


def split_last(c: ColumnLike, sep: str = "_") -> tuple[Column, Column]:
    """Split once at the last separator into (head, tail)."""
    text = as_column(c)
    escaped = "".join("\\" + ch for ch in sep)
    pattern = f"(?s)^(.*){escaped}(.*)$"
    hit = text.contains(sep)
    return (
        F.when(hit, F.regexp_extract(text, pattern, 1)).otherwise(text),
        F.when(hit, F.regexp_extract(text, pattern, 2)),
    )


def map_values(c: ColumnLike, mapping: Mapping, keep_unknown: bool = True) -> Column:
    """Recode through a literal map held in the plan; meant for short code lists."""
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    found = F.create_map(*pairs)[as_column(c)]
    return F.coalesce(found, as_column(c)) if keep_unknown else found


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """SQL text of the great-circle distance in statute miles."""
    half = lambda a, b: f"pow(sin((radians({b}) - radians({a})) * 0.5D), 2.0D)"
    h = f"{half(lat1, lat2)} + cos(radians({lat1})) * cos(radians({lat2})) * {half(lon1, lon2)}"
    return f"asin(sqrt(least({h}, 1.0D))) * {2.0 * EARTH_RADIUS_KM * MILES_PER_KM!r}D"


def haversine_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in statute miles of two points given by column names or literals."""
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def adjusted_skew(c: ColumnLike) -> Column:
    """Bias-adjusted sample skew as an aggregate; NULL below three values."""
    c = as_column(c).cast("double")
    n = F.count(c).cast("double")
    factor = F.try_divide(F.sqrt(n * F.greatest(n - 1.0, F.lit(0.0))), n - 2.0)
    return F.when(n >= 3, F.skewness(c) * factor)


def zero_sum(c: ColumnLike) -> Column:
    """Sum that gives 0, not NULL, for a group without values."""
    return F.coalesce(F.sum(as_column(c)), F.lit(0))


def safe_ln(c: ColumnLike) -> Column:
    """Natural logarithm, NULL where it is not defined."""
    c = as_column(c).cast("double")
    return F.when(c > 0, F.ln(c))


def normal_quantile(p: ColumnLike) -> Column:
    """Inverse of the standard normal distribution function.

    Spark has no such function; this is the published rational approximation
    by Acklam (relative error below 1.2e-9). NULL outside the open unit interval.
    """
    p = as_column(p).cast("double")

    def poly(x: Column, coefficients: Sequence[float]) -> Column:
        out = F.lit(coefficients[0])
        for value in coefficients[1:]:
            out = out * x + F.lit(value)
        return out

    # The coefficients of the published approximation.
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
         1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
         6.680131188771972e01, -1.328068155288572e01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
         -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
         3.754408661907416e00, 1.0]
    low = 0.02425
    tail = F.when(p < low, p).otherwise(1.0 - p)
    q_tail = F.sqrt(-2.0 * safe_ln(tail))
    outer = F.try_divide(poly(q_tail, c), poly(q_tail, d))
    q_mid = p - 0.5
    r = q_mid * q_mid
    inner = F.try_divide(poly(r, a) * q_mid, poly(r, b))
    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(p < low, outer)
        .when(p > 1 - low, -outer)
        .otherwise(inner)
    )


def normal_tail(z: ColumnLike) -> Column:
    """Upper tail of the standard normal distribution for z >= 0.

    Power series near the centre, the classical continued fraction further out.
    """
    z = as_column(z).cast("double")
    density = F.exp(z * z * -0.5) * 0.3989422804014327
    step = lambda s, i: F.struct(
        (s["t"] * z * z / (2 * i + 1)).alias("t"), (s["s"] + s["t"] * z * z / (2 * i + 1)).alias("s")
    )
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), F.struct(z.alias("t"), z.alias("s")), step, lambda s: s["s"]
    )
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), z, lambda a, i: z + F.try_divide(i, a))
    return F.when(z < 2.5, 0.5 - density * series).otherwise(density / fraction)
