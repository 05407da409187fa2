"""Stored tables in Spark's catalog."""

from __future__ import annotations

from faremill.sources.tables import WHOLE
from faremill.sources.versions import DATA, Store, Version

#: Partitions added in one statement.
BATCH = 500


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def register_table(store: Store, version: Version, schema: str, name: str, day: str | None) -> None:
    """A view ``schema.name`` of one version of a table, and beside it the table ``name__v<number>``.

    The table is external: it names the version's folders, each day's folder as a partition. Replacing
    the view moves readers from one version to the next in one step; the tables of versions whose
    files may be gone are dropped. A history, whose rows lie in several folders, has a table each.
    """
    spark = store.spark
    at = f"{store.path}/{DATA}"
    spark.sql(f"create schema if not exists {_quoted(schema)} location '{store.path}/_catalog'")
    columns = ", ".join(_quoted(c) for c in version.schema.names)

    def full(table: str) -> str:
        return f"{_quoted(schema)}.{_quoted(table)}"

    def external(table: str, folder: str, partitioned: str = "") -> None:
        declared = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in version.schema)
        spark.sql(f"create table if not exists {full(table)} ({declared}) using parquet {partitioned} location '{folder}'")

    newest = f"{name}__v{version.number}"
    if day:
        external(newest, f"{at}/_{newest}", f"partitioned by ({_quoted(day)})")
        days = [(p if p[:1].isdigit() else None, folder) for p, folder in version.parts.items()]
        for start in range(0, len(days), BATCH):
            added = " ".join(
                f"partition ({_quoted(day)} = {'null' if value is None else repr(value)}) location '{at}/{folder}'"
                for value, folder in days[start : start + BATCH]
            )
            spark.sql(f"alter table {full(newest)} add if not exists {added}")
        source = f"select {columns} from {full(newest)}"
    elif set(version.parts) == {WHOLE}:
        external(newest, f"{at}/{version.parts[WHOLE]}")
        source = f"select {columns} from {full(newest)}"
    else:
        tables = [f"{newest}_{i}" for i in range(len(version.parts))]
        for table, folder in zip(tables, version.parts.values(), strict=True):
            external(table, f"{at}/{folder}")
        source = " union all ".join(f"select {columns} from {full(t)}" for t in tables)
    spark.sql(f"create or replace view {full(name)} as {source}")
    for found in spark.catalog.listTables(schema):
        base, _, rest = found.name.partition("__v")
        number = rest.split("_")[0]
        if base == name and number.isdigit() and int(number) < version.number - 1:
            spark.sql(f"drop table if exists {full(found.name)}")
