"""Scalar column functions (X1-X14): plain ``pyspark.sql.functions``
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_field(text, sep: str, index: int, to: str = "int", strip_chars: str | None = None) -> Column:
    """Split ``text`` on ``sep`` (a literal), trim field ``index`` (0-based), cast.

    ``try_cast`` semantics: malformed fields become NULL instead of failing
    the task.
    """
    t = _c(text)
    if strip_chars:
        t = F.regexp_replace(t, "[" + "".join("\\" + ch for ch in strip_chars) + "]", "")
    parts = F.split(t, _regex_literal(sep))
    return F.trim(F.element_at(parts, index + 1)).try_cast(to)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def recode_missing(col, missing=-1, replacement=3) -> Column:
    """``missing`` -> ``replacement`` (the reference maps -1 to 3)."""
    c = _c(col)
    return F.when(c == F.lit(missing), F.lit(replacement)).otherwise(c)


def tokens(text, sep: str = " ") -> Column:
    """Array of tokens split on a literal separator (explode to flatten)."""
    return F.split(_c(text), _regex_literal(sep))


def count_equal(cols: Sequence[str], value=-1) -> Column:
    """Per row, how many of ``cols`` equal ``value``."""
    terms = [F.when(F.col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0)) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out.cast("bigint")


def feature_cross(a, b) -> Column:
    """Product of two columns."""
    return _c(a) * _c(b)


def onehot_to_index(cols: Sequence[str] | None = None, array=None) -> Column:
    """One-hot group -> ordinal, Σ_k k * x_k (columns or an array column)."""
    if array is not None:
        arr = _c(array)
        idx = F.sequence(F.lit(0), F.size(arr) - 1)
        return F.aggregate(F.arrays_zip(arr.alias("v"), idx.alias("k")), F.lit(0).cast("bigint"),
                           lambda acc, x: acc + x["v"].cast("bigint") * x["k"].cast("bigint"))
    out = None
    for k, c in enumerate(cols or []):
        t = F.col(c).cast("bigint") * F.lit(k)
        out = t if out is None else out + t
    return out


def log_popularity(count) -> Column:
    """ln(1 + count)."""
    return F.log1p(_c(count).cast("double"))


def square_error(a, b) -> Column:
    """X11: (a - b)^2."""
    d = _c(a).cast("double") - _c(b).cast("double")
    return d * d


def embedding_width(card, factor: float = 6.0, power: float = 0.25) -> Column:
    """min(card, int(6 * card^(1/4)))."""
    c = _c(card)
    return F.least(c.cast("bigint"), F.floor(F.lit(factor) * F.pow(c.cast("double"), F.lit(power))).cast("bigint"))


def onehot_array(label, n_classes) -> Column:
    """Array of (label == k) for k in 0..n_classes-1."""
    return F.transform(F.sequence(F.lit(0), _c(n_classes) - 1),
                       lambda k: (k == _c(label)).cast("int"))


#: Ids count modulo this, so that their products stay below 2^63.
ID_RANGE = 1 << 31


def arith_hash(*terms: tuple[str | Column, int], offset: int = 0, mod: int = 4294967296) -> Column:
    """Deterministic arithmetic hash ``(Σ c_k * m_k + offset) mod mod``.

    Used for oracle-comparable splits and draws: any SQL engine evaluates it
    identically, unlike engine-specific hash functions.
    """
    acc = F.lit(offset).cast("bigint")
    for c, m in terms:
        acc = acc + F.pmod(_c(c).cast("bigint"), F.lit(ID_RANGE)) * F.lit(m).cast("bigint")
    return F.pmod(acc, F.lit(mod).cast("bigint"))


def join_ints(arr, sep: str = ",") -> Column:
    """Render an integer array as 'a,b,c' (engine-independent text form)."""
    return F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), sep)


def join_fixed(arr, decimals: int = 6, sep: str = ",") -> Column:
    """Render a double array with a fixed number of decimals, 'x.xxxxxx,...'."""
    return F.array_join(F.transform(_c(arr), lambda x: F.format_string(f"%.{decimals}f", x)), sep)
