"""Column names: quoting, and the names of the rolling features."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    """A column name as SQL text takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def rolling_column_names(param: str, hours: int, extremes: bool = True) -> dict[str, str]:
    """Statistic -> output column, in output order."""
    stats = ("max", "min", "mean", "cumulative") if extremes else ("mean", "cumulative")
    return {stat: f"{param} ({hours}h {stat})" for stat in stats}


def rolling_columns(
    param: str, hours: Iterable[int], without_extremes: Iterable[str] = ()
) -> list[str]:
    """All rolling columns of one parameter: by window, then by statistic."""
    keep = param not in set(without_extremes)
    return [c for h in hours for c in rolling_column_names(param, h, keep).values()]
