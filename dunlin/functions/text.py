"""String and number helpers with the comparison rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_str(col: Column) -> Column:
    """Control characters to blanks, outer blanks removed."""
    return F.trim(F.regexp_replace(col, "[\\t\\n\\x0B\\f\\r]", " "))


def null_if_blank(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def text_len(col: Column) -> Column:
    """Length that ignores trailing blanks."""
    return F.length(F.rtrim(col))


def same_text(col: Column) -> Column:
    """Comparison key: case and trailing blanks do not matter."""
    return F.lower(F.rtrim(col))


def concat_null_as_empty(*cols: Column) -> Column:
    return F.concat_ws("", *cols)


def email_domain(col: Column) -> Column:
    """Text after the first ``@`` (the whole text when there is none)."""
    return F.substr(col, F.instr(col, "@") + 1)


def strip_suffix(col: Column, mark: str = "-") -> Column:
    """Text before the first ``mark``, or the whole text."""
    at = F.instr(col, mark)
    return F.when(at > 0, F.substr(col, F.lit(1), at - 1)).otherwise(col)


def strip_prefix(col: Column, prefix: str) -> Column:
    return F.when(col.startswith(prefix), F.substr(col, F.lit(len(prefix) + 1))).otherwise(col)


def drop_last(col: Column, n: int, only_if: str | None = None) -> Column:
    """Remove the last ``n`` characters, optionally only where ``only_if`` occurs."""
    cut = F.substr(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))
    return cut if only_if is None else F.when(F.instr(col, only_if) > 0, cut).otherwise(col)


def norm_key(col: Column, rules=("trim",)) -> Column:
    """Apply normalisation steps in order, then join on the result.

    A step is ``"trim"``, ``"lower"``, ``"long"``, ``("before", mark)``,
    ``("without", prefix)``, ``("replace", old, new)`` or ``("drop_last", n, only_if)``.
    """
    for rule in rules:
        name, args = (rule, ()) if isinstance(rule, str) else (rule[0], rule[1:])
        if name == "trim":
            col = F.trim(col)
        elif name == "lower":
            col = F.lower(col)
        elif name == "long":
            col = col.try_cast("bigint")
        elif name == "before":
            col = strip_suffix(col, *args)
        elif name == "without":
            col = strip_prefix(col, *args)
        elif name == "replace":
            col = F.replace(col, F.lit(args[0]), F.lit(args[1]))
        elif name == "drop_last":
            col = drop_last(col, *args)
        else:
            raise ValueError(f"unknown key rule {name!r}")
    return col


def whole_seconds(ms: Column) -> Column:
    """Milliseconds to seconds by integer division (1,499 and 1,500 both give 1)."""
    return F.floor(ms / 1000).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """Division that is NULL (blank) on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))
