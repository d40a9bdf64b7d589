"""Node-path expressions (F10, F11, P01–P03). A node path is ``array<string>`` from
the top pipeline down to the node; the root pipeline is the empty array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def empty_path() -> Column:
    return F.array().cast("array<string>")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_literal(path: Sequence[str]) -> Column:
    return F.array(*[F.lit(p) for p in path]).cast("array<string>") if path else empty_path()


def path_has_prefix(col, prefix: Sequence[str], strict: bool = False) -> Column:
    """``col`` starts with ``prefix`` (self included unless ``strict``). The root
    prefix matches every path."""
    c = _col(col)
    n = len(prefix)
    cond = F.lit(True) if n == 0 else (F.slice(c, 1, n) == path_literal(prefix))
    if strict:
        cond = cond & (F.size(c) > n)
    return cond


def path_text(col, sep: str = "/") -> Column:
    return F.array_join(_col(col), sep)


def last_name(col, root_name: str = "root") -> Column:
    """Last element of a path, ``root_name`` for the empty root path."""
    c = _col(col)
    return F.coalesce(F.try_element_at(c, F.lit(-1)), F.lit(root_name))


def relative_label(col, level: int, sep: str = " / ") -> Column:
    """Path below ``level`` joined with ``' / '`` (label inside a parent)."""
    c = _col(col)
    return F.array_join(F.slice(c, level + 1, F.greatest(F.size(c) - level, F.lit(0))), sep)
