"""Top lists kept beside the statistics, so that a small run looks at the items it changed and not at all of them.

Of each list the best KEPT items are stored, with a floor: every item that is not stored ranks after it. Changed items come in
where they rank before the floor and go where they fall behind it. Only if fewer than LEAST are left are all items ranked again.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.operators import reports as R

#: Stored items of a list, and how many of them a report may ask for.
KEPT, LEAST = 4 * S.MAX_REPORT_ROWS, S.MAX_REPORT_ROWS


class TopList(NamedTuple):
    """A report's items in its order, and the columns of that order with whether it descends."""

    ranked: Callable[[DataFrame], DataFrame]
    keys: tuple[tuple[str, bool], ...]


LISTS = {
    "views": TopList(R.by_views, (("total_views", True), ("anime_id", False))),
    "rating": TopList(R.by_rating, (("average_rating", True), ("total_ratings", True), ("anime_id", False))),
}


def not_after(name: str, floor: list) -> Column:
    """Whether a row ranks at or before a floor."""
    inside = F.lit(True)
    for (column, descends), value in reversed([*zip(LISTS[name].keys, floor, strict=True)]):
        before = F.col(column) > value if descends else F.col(column) < value
        inside = before | ((F.col(column) == value) & inside)
    return inside


def updated(name: str, kept: DataFrame, changed: DataFrame, every: Callable[[], DataFrame],
            floors: dict[str, list | None]) -> tuple[list[Row], list | None]:
    """The items to store of a list, at most KEPT, and its floor; None if there are no others.

    `kept` are the stored items, `changed` the new statistics of the items that changed, `every` those of all items. A list
    without an entry in `floors` is new.
    """
    ranked, keys = LISTS[name]
    rows, floor, whole = [], None, True
    if name in floors:
        floor = floors[name]
        pool = kept.join(changed.select("anime_id"), "anime_id", "left_anti").unionByName(changed)
        pool = pool if floor is None else pool.where(not_after(name, floor))
        rows = ranked(pool).limit(KEPT + 1).collect()
        whole = floor is not None and len(rows) < LEAST
    if whole:
        floor, rows = None, ranked(every()).limit(KEPT + 1).collect()
    if len(rows) > KEPT:
        rows = rows[:KEPT]
        floor = [rows[-1][column] for column, _ in keys]
    return rows, floor
