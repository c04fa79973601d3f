"""Documents stored with some members in columns of their own, so that a scan reads only the members asked for."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import json_value, with_json

SHREDDED = "__"


def member_column(document: str, path: str) -> str:
    """Column in which a member stands beside its document."""
    return document + SHREDDED + re.sub(r"[^0-9A-Za-z]+", "_", path.removeprefix("$.")).strip("_")


def shred(df: DataFrame, document: str, paths: Iterable[str]) -> DataFrame:
    """`df` with a text column per path beside the JSON text of `document`, parsed once: the scalar there, NULL for
    objects, arrays, JSON null and malformed text. Write this once; `with_members` then reads no document at all."""
    paths = list(paths)
    columns = [member_column(document, p) for p in paths]
    clash = {c for c in columns if columns.count(c) > 1 or c in df.columns}
    if clash:
        raise ValueError(f"member columns clash: {sorted(clash)}")
    source = f"{document}{SHREDDED}"
    parsed = with_json(df.withColumn(source, F.col(document)), source)
    members = {c: json_value(source, p) for c, p in zip(columns, paths, strict=True)}
    return parsed.withColumns(members).drop(source)


def with_members(df: DataFrame, document: str, members: Mapping[str, str]) -> DataFrame:
    """`df` with members of a document as columns (name -> path) in its place. Members that are stored in columns are
    taken from there; if all are, the document isn't read."""
    stored = {name: member_column(document, path) for name, path in members.items()}
    rest = [c for c in df.columns if c != document and not c.startswith(document + SHREDDED)]
    if set(stored.values()) <= set(df.columns):
        return df.select(*rest, *[F.col(c).alias(name) for name, c in stored.items()])
    parsed = with_json(df, document)
    # Generated, so that no filter evaluates them again, and as texts: Spark takes a variant for 2 KB, and rows that drop one
    # for so much smaller that it would broadcast millions of them.
    texts = F.array(F.struct(*[json_value(document, path).alias(f"__{name}") for name, path in members.items()]))
    return parsed.select(*rest, F.inline(texts)).withColumnsRenamed({f"__{name}": name for name in members})
