"""Stored Parquet tables in a shared folder: replaced whole, or day by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from faremill.sources.versions import DATA, Store, Version

#: Looks at the rows a write is about to make visible; an exception keeps them out.
Audit = Callable[[DataFrame], None]
WHOLE = "all"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table, or None when there is none."""
    store = Store(spark, path)
    version = store.last()
    return store.rows(version) if version else None


def _audited(store: Store, rows: DataFrame, folder: str, audit: Audit | None) -> None:
    if audit is None:
        return
    try:
        audit(rows)
    except Exception:
        store.delete(f"{DATA}/{folder}")
        raise


def replace_table(df: DataFrame, path: str, cluster: Sequence[str] = (), audit: Audit | None = None) -> None:
    """Write a new version next to the old one, which stays readable until the new one is complete.

    Sorting inside each task's rows costs no shuffle and lets a later filter on those columns skip
    Parquet pages. The version before the last is kept for queries that are still reading it.
    """
    store = Store(df.sparkSession, path)
    folder = store.write(df.sortWithinPartitions(*cluster) if cluster else df)
    _audited(store, df.sparkSession.read.schema(df.schema).parquet(f"{path}/{DATA}/{folder}"), folder, audit)
    # Both of two writers at once have a whole table; the later commit is the one that is seen.
    while store.commit(store.last(), df.schema, {WHOLE: folder}) is None:
        pass


def rebalanced(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day together, for few, well-sized files per day.

    A rebalance, unlike a plain repartition by day, lets adaptive execution split a day that is
    too large for one task and merge days that are small.
    """
    return df.hint("rebalance", day)


def clustered_by_day(df: DataFrame, day: str, cluster: Sequence[str]) -> DataFrame:
    """Rows by day (see ``rebalanced``), each file sorted so that Parquet statistics can skip row groups."""
    return rebalanced(df, day).sortWithinPartitions(day, *cluster)


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The newest day that has rows, from the names in the table's pointer; no job is started."""
    version = Store(spark, path).last()
    days = [p for p in (version.parts if version else {}) if p[:1].isdigit()]
    return max(map(dt.date.fromisoformat, days), default=None)


def overwrite_days(
    df: DataFrame,
    path: str,
    day: str,
    cluster: Sequence[str] = (),
    *,
    all_days: bool,
    audit: Audit | None = None,
    dealt: bool = False,
) -> None:
    """Replace the days present in ``df``, or the whole table, in one step.

    ``dealt`` says that the rows come by day already, as from a table stored by the same days: they are
    sorted and written by the tasks that read them, a file for each one read, and none crosses the network.

    The new days' files are written first; the pointer then names them beside the files of the days that
    stay. A writer that finds another one's version in between adds its days to that.
    """
    store = Store(df.sparkSession, path)
    folder = store.write(df.sortWithinPartitions(day, *cluster) if dealt else clustered_by_day(df, day, cluster), day)
    new = {n.removeprefix(f"{day}="): f"{folder}/{n}" for n in store.folders_with_files(f"{DATA}/{folder}")}
    while True:
        before = store.last()
        parts = new if all_days or before is None else {**before.parts, **new}
        _audited(store, store.rows(Version(0, df.schema, parts)), folder, audit)
        if store.commit(before, df.schema, parts):
            return
