"""Bands, classes and codes, all built from data so that literals stay arguments."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _chain(pairs: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    out = None
    for cond, value in pairs:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return F.lit(None) if otherwise is None else otherwise
    return out if otherwise is None else out.otherwise(otherwise)


def band(col: Column, bands: Sequence[tuple], otherwise=None) -> Column:
    """Label by the half-open range ``[low, high)`` that holds the value.

    ``bands`` holds ``(low, high, label)``; None leaves an end open. Gaps give NULL.
    """
    def inside(low, high):
        cond = F.lit(True)
        if low is not None:
            cond = cond & (col >= low)
        if high is not None:
            cond = cond & (col < high)
        return cond & col.isNotNull()

    rest = None if otherwise is None else F.lit(otherwise)
    return _chain(((inside(lo, hi), F.lit(label)) for lo, hi, label in bands), rest)


def upto_bands(col: Column, edges: Sequence[tuple], rest) -> Column:
    """Label of the first edge with ``value <= edge``; ``rest`` beyond the last edge."""
    return _chain(((col <= edge, F.lit(label)) for edge, label in edges), F.lit(rest))


def classify(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """First matching rule wins."""
    pairs = ((c, v if isinstance(v, Column) else F.lit(v)) for c, v in rules)
    rest = otherwise if isinstance(otherwise, Column) or otherwise is None else F.lit(otherwise)
    return _chain(pairs, rest)


def map_outcome(code: Column, mapping: Mapping, otherwise="Other") -> Column:
    """Event code -> outcome label."""
    return classify([(code == k, v) for k, v in mapping.items()], otherwise)


def sort_key(col: Column, order: Sequence) -> Column:
    """1-based position of a code in ``order``; NULL when it is not listed."""
    return _chain((col == value, F.lit(i)) for i, value in enumerate(order, start=1))


def group_values(col: Column, groups: Mapping[str, Sequence], blank="(Blank)") -> Column:
    """Group label of a code; blanks get ``blank``, unlisted codes keep their own text."""
    rules = [(col.isNull(), F.lit(blank))]
    rules += [(col.isin(list(members)), F.lit(name)) for name, members in groups.items()]
    return _chain(rules, col)


def decode_flags(col: Column, names: Mapping[str, str]) -> dict[str, Column]:
    """One 0/1 column per flag character. A NULL text counts as set: the absence test
    ``position = 0`` is unknown for NULL, so the other branch fires."""
    return {
        name: F.when(F.instr(col, char) == 0, 0).otherwise(1) for char, name in names.items()
    }


def control_split(id_col: Column, pos: int, length: int, cutoff: int) -> Column:
    """True for ids whose digits at ``pos`` exceed ``cutoff``: a stable control group."""
    return F.substring(id_col, pos, length).try_cast("int") > cutoff


def recode(df: DataFrame, pred: Column, col: str, value: Column) -> DataFrame:
    return df.withColumn(col, F.when(pred, value).otherwise(F.col(col)))


def where_in(df: DataFrame, col: str, values, negate: bool = False) -> DataFrame:
    """IN / NOT IN list filter. A DataFrame of values becomes a semi or anti join, which
    Spark broadcasts or shuffles by size."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(keys, col, "left_anti" if negate else "left_semi")
    cond = F.col(col).isin(list(values))
    return df.where(~cond if negate else cond)


def where_by_era(df: DataFrame, day: Column, since, rule: Column, exempt: Column | None = None):
    """Apply ``rule`` only from ``since`` on; rows matching ``exempt`` always pass."""
    keep = (day < F.lit(since)) | rule
    return df.where(keep if exempt is None else keep | exempt)


def month_age_bands(age: Column, edges: Sequence[int]) -> dict[str, Column]:
    """One test per age band ``[edge, next edge)``; below the first edge and from the last
    edge on are bands too."""
    out = {f"under_{edges[0]}m": age < edges[0]}
    for low, high in zip(edges, edges[1:]):
        out[f"m{low}_{high}"] = (age >= low) & (age < high)
    out[f"from_{edges[-1]}m"] = age >= edges[-1]
    return out

