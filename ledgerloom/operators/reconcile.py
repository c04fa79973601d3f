"""Invoices against provisions: a group keeps its actual documents if it has any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.business import document_class
from ledgerloom.operators.lookup import without_matches


def reconcile(
    df: DataFrame,
    group_keys: Sequence[str],
    flag: str = "document_binary",
    type_column: str | None = "document_type",
) -> DataFrame:
    """Keep actual documents, and provisional ones of groups without any actual one.

    Adds the group's flag (1 actual, 0 provisional); with `type_column` None, `flag` already holds
    each row's own class. Rows of unknown type are dropped. An actual row is always kept, so only
    provisional rows are checked against the distinct groups that hold an actual row; NULL group
    keys match each other. Works on document lines and on totals per document class.
    """
    lines = df if type_column is None else df.withColumn(flag, document_class(type_column))
    lines = lines.filter(F.col(flag).isNotNull())
    settled = lines.filter(F.col(flag) == 1).select(*group_keys).distinct()
    return without_matches(lines, settled, group_keys, F.col(flag) == 0)


def reconcile_totals(
    df: DataFrame, group_keys: Sequence[str], class_column: str, keep_unclassed: bool = False
) -> DataFrame:
    """The same rule on monthly totals, as a window that can share their partitioning.

    For totals whose groups hold few rows (one holding in one month). `keep_unclassed` lets rows
    with a NULL class, which come from an already reconciled source, through.
    """
    best = F.max(class_column).over(Window.partitionBy(*group_keys))
    kept = F.col(class_column) == F.col("__best")
    if keep_unclassed:
        kept = kept | F.col(class_column).isNull()
    return df.withColumn("__best", best).filter(kept).drop("__best")


def _in_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys (NULL matching NULL) occur in `groups`."""
    names = [f"__g{i}" for i in range(len(keys))]
    right = groups.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    return df.join(right, match, "left_semi")


def _net(df: DataFrame, columns: Sequence[str], change: str) -> DataFrame:
    """Equal rows added up; those that cancel vanish."""
    total = df.groupBy(*columns).agg(F.sum(change).alias("__n")).filter(F.col("__n") != 0)
    return total.withColumn(change, F.signum("__n").cast("int")).withColumn("__n", F.abs("__n").cast("int"))


def _repeated(df: DataFrame) -> DataFrame:
    return df.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__n")


def reconcile_delta(
    lines: DataFrame,
    changes: DataFrame,
    group_keys: Sequence[str],
    change: str = "change",
    flag: str = "document_binary",
    type_column: str | None = "document_type",
) -> DataFrame:
    """What `changes` do to the reconciled result, without running it again over all of `lines`.

    `changes` has the columns of `lines` and, in `change`, 1 for a document that comes in and -1 for one that goes; a
    corrected document is both. Only groups that a change names are looked at: a late invoice retracts its group's
    provisions, and the last invoice that goes brings them back. Gives the rows that enter (1) and leave (-1) the result of
    `reconcile`. `lines` are the documents before the changes; a document to remove that is not among them counts for
    nothing. Filter `lines` to the partitions that the changes can touch, where they are stored by one of the keys.
    """
    columns = list(lines.columns)
    touched = changes.select(*group_keys).distinct()
    before = _in_groups(lines, touched, group_keys)
    moves = before.withColumn(change, F.lit(1)).unionByName(changes.select(*columns, F.col(change).cast("int").alias(change)))
    after = _repeated(_net(moves, columns, change).filter(F.col(change) > 0)).select(*columns)
    old = reconcile(before, group_keys, flag, type_column)
    new = reconcile(after, group_keys, flag, type_column)
    result = list(new.columns)
    moved = new.withColumn(change, F.lit(1)).unionByName(old.withColumn(change, F.lit(-1)))
    return _repeated(_net(moved, result, change)).select(*result, change)


def apply_delta(stored: DataFrame, delta: DataFrame, group_keys: Sequence[str], change: str = "change") -> DataFrame:
    """A stored result with the rows of a delta entered and retracted. Rows of untouched groups pass as they are."""
    columns = list(stored.columns)
    touched = delta.select(*group_keys).distinct()
    same = without_matches(stored, touched, group_keys, F.lit(True))
    moved = _in_groups(stored, touched, group_keys).withColumn(change, F.lit(1)).unionByName(delta.select(*columns, change))
    return same.unionByName(_repeated(_net(moved, columns, change).filter(F.col(change) > 0)).select(*columns))
