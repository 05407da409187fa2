"""Storage of a type 2 history: the open versions of the last run, and the closed ones of all runs.

Each run writes all open versions and the versions it closed, so a run costs as much as the
current rows, however long the history grows. Closed sets are merged as they pile up: eight sets
of one level become one set of the next, in files of disjoint key ranges. After n runs there are at
most seven sets a level and log8(n) levels, and each row has been rewritten as many times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators.history import CLOSED, OPEN, as_new_versions, next_versions
from faremill.sources.tables import Audit, read_table
from faremill.sources.versions import DATA, Store, Version

#: Closed sets of one level that are merged into one of the next.
MERGED_SETS = 8

read_history = read_table


def _levels(version: Version | None) -> dict[int, list[str]]:
    """Names of the closed parts by level; a part is called ``closed-<level>-<folder>``."""
    found: dict[int, list[str]] = {}
    for name in version.parts if version else ():
        if name.startswith(f"{CLOSED}-"):
            found.setdefault(int(name.split("-")[1]), []).append(name)
    return found


def _merged(store: Store, base: Version, key: str, updated_at: str) -> Version:
    """The same rows with full levels merged into sets of the next."""
    parts, level = dict(base.parts), 0
    while len(names := _levels(Version(0, base.schema, parts)).get(level, [])) >= MERGED_SETS:
        rows = store.rows(Version(0, base.schema, parts), names)
        rows = rows.repartitionByRange(key, updated_at).sortWithinPartitions(key, updated_at)
        folder = store.write(rows.withColumn("state", F.lit(CLOSED)), "state")
        merged = {f"{CLOSED}-{level + 1}-{folder}": f"{folder}/state={CLOSED}"}
        parts = {n: f for n, f in parts.items() if n not in names} | merged
        level += 1
    return Version(base.number, base.schema, parts)


def append_run(source: DataFrame, path: str, key: str, updated_at: str, audit: Audit | None = None) -> None:
    """Bring the history up to date with the source rows (each key at most once).

    A run that finds another one's version when it commits starts again from that.
    """
    spark = source.sparkSession
    store = Store(spark, path)
    while True:
        before = store.last()
        if before:
            versions = next_versions(store.rows(before, [OPEN] if OPEN in before.parts else []), source, key, updated_at)
        else:
            versions = as_new_versions(source, key, updated_at)
        schema = versions.drop("state").schema
        folder = store.write(versions, "state")
        written = store.folders_with_files(f"{DATA}/{folder}")
        parts = {n: f for n, f in (before.parts if before else {}).items() if n != OPEN}
        if f"state={OPEN}" in written:
            parts[OPEN] = f"{folder}/state={OPEN}"
        if f"state={CLOSED}" in written:
            parts[f"{CLOSED}-0-{folder}"] = f"{folder}/state={CLOSED}"
        after = _merged(store, Version(0, schema, parts), key, updated_at)
        if audit is not None:
            audit(store.rows(after))
        if store.commit(before, schema, after.parts):
            return
        store.delete(f"{DATA}/{folder}")
