"""Data-quality checks: ``model, column_name, failures``, one row per declared column, and the failing rows.

However many columns of a table are declared, conditions on its rows are counted in one
aggregate over one pass, repeated and unwanted values in one pass over the columns concerned, and all
foreign keys of a table in one pass; a table that others refer to is read once for all of them. Counts
are laid out as rows only after they have shrunk to one row per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]
Columns = Mapping[str, Iterable[str]]
Fails = Callable[[Column], Column]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _laid_out(counts: DataFrame, names: Sequence[tuple[str, ...]], columns: str) -> DataFrame:
    """One row of counts ``c0, c1, ...`` as a row for each count, under its names."""
    rows = ", ".join(", ".join(f"'{n}'" for n in name) + f", coalesce(c{i}, 0L)" for i, name in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {rows}) as ({columns}, failures)")


def _counted(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    return df.agg(*[F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(conditions)])


# --- conditions on rows ----------------------------------------------------------------------


def is_missing(c: Column) -> Column:
    return c.isNull()


def is_negative(c: Column) -> Column:
    """Null passes."""
    return c < 0


def _if_completed(condition: Column) -> Column:
    return (F.col("trip_status") == "completed") & condition


def is_not_positive_when_completed(c: Column) -> Column:
    return _if_completed(c.isNull() | (c <= 0))


def is_zero_when_completed(c: Column) -> Column:
    return _if_completed(c == 0)


def count_failing_rows(tables: Tables, checks: Mapping[str, tuple[Columns, Fails]]) -> DataFrame:
    """``check, model, column_name, failures`` of several checks: one aggregate for each table."""
    by_table: dict[str, list[tuple[str, str, Fails]]] = {}
    for check, (declared, fails) in checks.items():
        for model, columns in declared.items():
            by_table.setdefault(model, []).extend((check, c, fails) for c in columns)
    return union_all(
        [
            _laid_out(
                _counted(tables(model), [fails(F.col(c)) for _, c, fails in items]),
                [(check, model, c) for check, c, _ in items],
                "check, model, column_name",
            )
            for model, items in by_table.items()
        ]
    )


def _one(tables: Tables, declared: Columns, fails: Fails) -> DataFrame:
    return count_failing_rows(tables, {"": (declared, fails)}).drop("check")


def not_null(tables: Tables, declared: Columns) -> DataFrame:
    return _one(tables, declared, is_missing)


def at_least_zero(tables: Tables, declared: Columns) -> DataFrame:
    return _one(tables, declared, is_negative)


def positive_when_completed(tables: Tables, declared: Columns) -> DataFrame:
    return _one(tables, declared, is_not_positive_when_completed)


def not_zero_when_completed(tables: Tables, declared: Columns) -> DataFrame:
    return _one(tables, declared, is_zero_when_completed)


# --- values ----------------------------------------------------------------------------------


def _by_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each value of each column and its number of rows ``n``; the other columns are null.

    Grouping sets go over the rows once and combine before the shuffle.
    """
    return df.groupingSets([[c] for c in columns], *columns).agg(
        F.count("*").alias("n"), *[F.grouping(c).alias(f"_other{i}") for i, c in enumerate(columns)]
    )


def _is_value(columns: Sequence[str], i: int) -> Column:
    return (F.col(f"_other{i}") == 0) & F.col(columns[i]).isNotNull()


def unique(tables: Tables, declared: Columns) -> DataFrame:
    """Number of values that occur more than once; nulls do not count."""

    def of(model: str, columns: list[str]) -> DataFrame:
        values = _by_value(tables(model).select(*columns), columns)
        repeated = [_is_value(columns, i) & (F.col("n") > 1) for i in range(len(columns))]
        return _laid_out(_counted(values, repeated), [(model, c) for c in columns], "model, column_name")

    return union_all([of(model, list(columns)) for model, columns in declared.items()])


def accepted_values(tables: Tables, allowed: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Number of distinct values outside the list; null passes."""

    def of(model: str, lists: Mapping[str, Sequence[str]]) -> DataFrame:
        columns = list(lists)
        unwanted = [~F.col(c).isin(*lists[c]) for c in columns]
        values = _by_value(tables(model).select(*columns).where(reduce(or_, unwanted)), columns)
        counts = _counted(values, [_is_value(columns, i) & u for i, u in enumerate(unwanted)])
        return _laid_out(counts, [(model, c) for c in columns], "model, column_name")

    return union_all([of(model, lists) for model, lists in allowed.items()])


def relationships(tables: Tables, parents: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Rows whose non-null key is missing from the parent's column of the same name.

    Children and parents meet in one aggregation by parent and key, which combines before the shuffle, so
    a key that fills a third of a table crosses the network once per task. Each child is read once for
    all its keys, and each parent once for all its children.
    """
    pairs = [(model, key) for model, keys in parents.items() for key in keys]

    def named(parent: str, key: str) -> Column:
        return F.lit(f"{parent}.{key}")

    def keys_of(model: str) -> DataFrame:
        rows = [
            x
            for key, parent in parents[model].items()
            for x in (F.lit(pairs.index((model, key))), named(parent, key), F.col(key).cast("string"))
        ]
        return tables(model).select(F.stack(F.lit(len(parents[model])), *rows).alias("number", "parent", "key"))

    known = [
        tables(parent).select(F.lit(-1).alias("number"), named(parent, key).alias("parent"), F.col(key).cast("string").alias("key"))
        for parent, key in dict.fromkeys((p, k) for keys in parents.values() for k, p in keys.items())
    ]
    rows = union_all([*[keys_of(model) for model in parents], *known]).where("key is not null")
    by_key = rows.groupBy("parent", "key").agg(
        F.bool_or(F.col("number") == -1).alias("known"),
        *[F.count_if(F.col("number") == i).alias(f"n{i}") for i in range(len(pairs))],
    )
    counts = by_key.where("not known").agg(*[F.sum(f"n{i}").alias(f"c{i}") for i in range(len(pairs))])
    return _laid_out(counts, pairs, "model, column_name")


# --- what fails ------------------------------------------------------------------------------


def rows_where(fails: Fails) -> Callable[[Tables, str, str], DataFrame]:
    """The rows of a table for which the condition on the column holds."""
    return lambda tables, model, column: tables(model).where(fails(F.col(column)))


def repeated_values(tables: Tables, model: str, column: str) -> DataFrame:
    """The values that occur more than once, and how often."""
    return tables(model).where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")


def unwanted_values(tables: Tables, model: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """The values outside the list, and how often they occur."""
    return tables(model).where(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count("*").alias("n_records"))


def orphans(tables: Tables, model: str, key: str, parent: str) -> DataFrame:
    """The rows whose non-null key the parent does not have."""
    return tables(model).where(F.col(key).isNotNull()).join(tables(parent).select(key), key, "left_anti")
