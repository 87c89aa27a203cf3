"""Scalar column expressions built from ``pyspark.sql.functions``.

They stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["signed_log", "safe_div", "inverse_distance", "argmax_index", "weighted",
           "manhattan", "euclidean", "linear_grid", "lower_clip", "fmt_fixed",
           "fmt_mean_sd", "fmt_thousands", "small_int_word", "mantissa_exponent",
           "missing_to_level", "strict_double", "NUMBER_PATTERN", "hash_unit", "hash_hex",
           "numeric_columns", "class_names", "vector_key"]

# fixed values: spelled-out small integers used in report cells
SMALL_INT_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven",
                   "eight", "nine", "ten"]
NUMBER_PATTERN = r"^-?\d+(\.\d+)?([eE][-+]?\d+)?%?$"


def signed_log(c) -> Column:
    """log1p of the value clipped below at 0."""
    return F.log1p(F.greatest(F.col(c) if isinstance(c, str) else c, F.lit(0.0)))


def safe_div(a, b, default: float = 0.0) -> Column:
    """a / b, ``default`` when b is 0 or NULL (never NaN, never an ANSI error)."""
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def inverse_distance(d) -> Column:
    """1/d; callers apply the exact-match override (only d = 0 rows vote)."""
    return F.try_divide(F.lit(1.0), d)


def argmax_index(arr) -> Column:
    """0-based position of the array maximum, lowest index on ties."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def weighted(arr, weights) -> Column:
    """element-wise product of a class distribution and per-class weights."""
    return F.transform(arr, lambda x, i: x * F.element_at(weights, i + 1))


def manhattan(a, b) -> Column:
    """sum of absolute differences of two numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a, b) -> Column:
    """Euclidean norm of the difference of two numeric arrays."""
    sq = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def linear_grid(lo: float, hi: float, n: int) -> Column:
    """N evenly spaced values from lo to hi inclusive, as an array column."""
    if n == 1:
        return F.array(F.lit(float(lo)))
    step = (hi - lo) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(float(lo)) + i * F.lit(step))


def lower_clip(c, floor: float = 1e-3) -> Column:
    """clip from below for log axes."""
    return F.greatest(F.col(c) if isinstance(c, str) else c, F.lit(floor))


def fmt_fixed(c, d: int) -> Column:
    """Fixed decimals."""
    return F.format_string(f"%.{d}f", c)


def fmt_mean_sd(m, s, d: int = 4) -> Column:
    """``mean ± sd`` cell."""
    return F.format_string(f"%.{d}f ± %.{d}f", m, s)


def fmt_thousands(c) -> Column:
    """Integer with thousands grouping."""
    return F.format_number(c, 0)


def small_int_word(c) -> Column:
    """0..10 spelled out, larger numbers as digits."""
    words = F.array(*[F.lit(w) for w in SMALL_INT_WORDS])
    return F.when((c >= 0) & (c <= 10), F.element_at(words, c.cast("int") + 1)).otherwise(c.cast("string"))


def mantissa_exponent(c) -> tuple[Column, Column]:
    """x = m * 10^e with 1 <= |m| < 10."""
    e = F.floor(F.log10(F.abs(c)))
    return c / F.pow(F.lit(10.0), e), e.cast("int")


def missing_to_level(c: str, token: str = "?", level: str = "unknown") -> Column:
    """Explicit level for the missing token."""
    return F.when(F.col(c) == token, F.lit(level)).otherwise(F.col(c))


def strict_double(c: str) -> Column:
    """Strict numeric cast; under ANSI mode a bad value fails the job."""
    return F.col(c).cast("double")


def hash_hex(seed: int, key) -> Column:
    """md5 of ``'<seed>-<key>'`` as lowercase hex; identical in DuckDB."""
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))


def hash_unit(h) -> Column:
    """First 8 hex digits of a hex hash as an integer in [0, 2^32)."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def numeric_columns(columns: list[str], nominal: list[str], exclude: list[str] = ()) -> list[str]:
    """Numeric features are every column that is not nominal (nor excluded)."""
    return [c for c in columns if c not in set(nominal) | set(exclude)]


def class_names(label, names: dict) -> Column:
    """P5: class code -> name through a literal map (the class dimension is a handful of rows)."""
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])
    return m[label if isinstance(label, Column) else F.col(label)]


def vector_key(cols: list[str]) -> Column:
    """P10: one string key over all feature columns, joined with chr(31); NULLs
    are spelled out first because ``concat_ws`` would skip them."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
