"""Long lists of LIKE patterns, matched once per distinct text through an index of character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 4


def _grams(text: Column, size: Column | int = GRAM) -> Column:
    """Every run of `size` characters."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, size))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def _literals(pattern: Column) -> Column:
    """Runs of literal characters of a pattern: what stands between the wildcards."""
    return F.split(pattern, "[%_]")


def match_patterns(names: DataFrame, rules: DataFrame, fold_case: bool = False) -> DataFrame:
    """(name, label, rank): for each distinct text of `names` (name) the first rule (rank, pattern, label) that it is
    LIKE; texts that match none are left out, as are NULL texts and patterns. Rules must have distinct ranks.

    The rules are rows, not branches of an expression, so the plan is the same for ten of them and for ten thousand. Each
    pattern stands in the index under one n-gram of its literal characters, the one that the fewest texts have; texts and
    patterns that share it are compared in full. Patterns with fewer literal characters in a row stand under a shorter
    one, and those without any under none, to be compared with every distinct text: keep these few.
    """
    fold = F.upper if fold_case else (lambda c: c)
    texts = names.where(F.col("name").isNotNull()).select(F.col("name"), fold(F.col("name")).alias("text")).distinct()
    # Of rules with one pattern only the first can be a text's first.
    distinct = rules.where(F.col("pattern").isNotNull()).groupBy(fold(F.col("pattern")).alias("pattern"))
    rules = distinct.agg(F.min(F.struct("rank", "label")).alias("first")).select("first.rank", "pattern", "first.label")

    # A backslash makes the next character literal; such patterns are not taken apart.
    longest = F.least(F.array_max(F.transform(_literals(F.col("pattern")), F.length)), F.lit(GRAM))
    sized = rules.withColumn("size", F.when(F.col("pattern").contains("\\"), F.lit(0)).otherwise(longest))
    grams = F.array_distinct(F.flatten(F.transform(_literals(F.col("pattern")), lambda part: _grams(part, F.col("size")))))
    keyed = sized.where("size > 0").withColumn("gram", F.explode(grams))
    free = sized.where("size = 0").withColumn("gram", F.lit(""))
    # Texts show the sizes that some pattern uses, the empty one where a pattern has no literal character.
    sizes = sorted(r["size"] for r in sized.select("size").distinct().collect())  # at most GRAM + 1
    shown = [F.array_distinct(_grams(F.col("text"), n)) if n else F.array(F.lit("")) for n in sizes]
    index = texts.select("name", "text", F.explode(F.concat(F.array().cast("array<string>"), *shown)).alias("gram"))

    # An inner join: a pattern one of whose grams no text has can match nothing. Its rarest gram is the one to look under.
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    counted = keyed.join(counts, "gram", "left")
    place = counted.groupBy("rank", "pattern", "label").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("rarest")
    ).where("rarest.n > 0").select("rank", "pattern", "label", F.col("rarest.gram").alias("gram"))
    listed = place.unionByName(free.select("rank", "pattern", "label", "gram"))
    found = index.join(listed, "gram").where(F.expr("text LIKE pattern"))
    first = found.groupBy("name").agg(F.min(F.struct("rank", "label")).alias("first"))
    return first.select("name", "first.label", "first.rank")


def label_by_patterns(df: DataFrame, column: str, rules: DataFrame, label: str, fold_case: bool = False) -> DataFrame:
    """`df` with the label of the first pattern that a text column is LIKE, NULL where there is none. Texts are matched
    once each, however many rows have them."""
    from ledgerloom.operators.lookup import Key, lookup

    matched = match_patterns(df.select(F.col(column).alias("name")).distinct(), rules, fold_case)
    return lookup(df, matched, [Key(column, "name")], {"label": label})


def without_patterns(df: DataFrame, column: str, rules: DataFrame, fold_case: bool = False) -> DataFrame:
    """Rows whose text is LIKE none of the patterns; rows without a text stay."""
    return label_by_patterns(df, column, rules.withColumn("label", F.lit(True)), "__hit", fold_case).where("__hit IS NULL").drop("__hit")
