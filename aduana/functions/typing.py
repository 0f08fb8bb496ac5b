"""Text to typed values. ANSI mode stays on, so every conversion that may fail is a `try_` one."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_PATTERN = "yyyyMMdd"


def parsed(c: Column, type_name: str) -> Column:
    """Convert text `c`; what cannot be read becomes null, as it does without ANSI mode.

    Dates arrive as yyyyMMdd. Fractional numbers may carry a decimal comma; whole numbers lose what
    stands after a decimal point.
    """
    kind = type_name.strip().lower()
    if kind == "string":
        return c.cast("string")
    if kind == "date":
        return F.try_to_date(c, DATE_PATTERN)
    if kind == "double" or kind.startswith("decimal"):
        return F.replace(c, F.lit(","), F.lit(".")).try_cast(kind)
    if kind in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        # Nearly all are plain; only what that cast refuses, such as a decimal point, is looked at again.
        whole = F.regexp_replace(F.trim(c), r"^([+-]?\d+)\.\d*$", "$1")
        return F.coalesce(c.try_cast(kind), whole.try_cast(kind), c.try_cast("decimal(38,9)").try_cast(kind))
    return c.try_cast(kind)
