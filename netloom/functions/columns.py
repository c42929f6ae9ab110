"""Built-in column expressions used across operators (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Quotient that is NULL (not an ANSI error) when the divisor is 0."""
    return F.try_divide(_c(num), _c(den))


def pop_corr(x: str | Column, y: str | Column) -> Column:
    """Population correlation as an aggregate; NULL when either side is
    constant (plain ``corr`` raises DIVIDE_BY_ZERO under ANSI there)."""
    return F.try_divide(F.covar_pop(_c(x), _c(y)), F.stddev_pop(_c(x)) * F.stddev_pop(_c(y)))


def name_of(prefix: str, *keys: str | Column) -> Column:
    """Tableau name: prefix and keys joined by underscores, e.g. ship_A_B."""
    parts: list[Column] = [F.lit(prefix)]
    for k in keys:
        parts += [F.lit("_"), _c(k)]
    return F.concat(*parts)


def html_escape(c: str | Column) -> Column:
    out = _c(c)
    for raw, esc in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def caption(labels: Sequence[tuple[str, str]] = (), data: Sequence[tuple[str, str]] = ()) -> Column:
    """Popup caption: ``label: value`` parts joined by ``<br />``.

    ``labels`` are (column, label) pairs for identifier columns, ``data``
    the same for value columns; both keep their given order, labels first.
    An empty label prints the value alone. NULL values drop their part.
    """
    parts = []
    for col_name, label in [*labels, *data]:
        value = html_escape(F.col(col_name).cast("string"))
        parts.append(F.concat(F.lit(f"{label}: "), value) if label else value)
    if not parts:
        return F.lit("")
    return F.concat_ws("<br />", *parts)


def join_null_safe(left, right, keys: Sequence[str], how: str = "inner"):
    """Join on ``keys`` where NULL matches NULL (a NULL group is a group);
    the key columns appear once, from the left side. Both sides are aliased,
    so a side derived from the other (a self-join) resolves."""
    import uuid
    from functools import reduce as _reduce

    a, b = f"l{uuid.uuid4().hex[:8]}", f"r{uuid.uuid4().hex[:8]}"
    cond = _reduce(lambda x, y: x & y, [F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`")) for k in keys])
    rest = [F.col(f"{b}.`{c}`") for c in right.columns if c not in keys]
    return left.alias(a).join(right.alias(b), cond, how).select(
        *[F.col(f"{a}.`{c}`") for c in left.columns], *rest
    )
