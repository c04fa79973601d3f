"""Language identification in two steps: the family first, then the language within it.

Texts are seen as hashed character n-grams (one to three letters, words closed by spaces). One-versus-one linear
support vector machines separate the families, and within each family its languages. The models are additive over
n-grams, so a text is scored in pieces of bounded size, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.units import free_encoders, slices

UNDETERMINED = "und"

# Families of language codes; any other code is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "hr": "slavic",
}


@dataclass(frozen=True)
class LanguageSettings:
    """`per_language` bounds the training documents of each language (those with the smallest hashed doc_id);
    `bits`: log2 of the hashed features."""

    per_language: int = 200
    bits: int = 14
    penalty: float = 100.0
    epochs: int = 40
    piece: int = 500_000


@dataclass(frozen=True)
class LanguageModel:
    """`duels`: (first label, second label) per column of `weights`; a positive value speaks for the first."""

    families: dict[str, tuple[str, ...]]
    duels: tuple[tuple[str, str], ...]
    weights: np.ndarray
    bias: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
    return table


def _features(text: str, bits: int, piece: int) -> Iterator[tuple[np.ndarray, int]]:
    """Hashed n-grams of each piece of a text, and its number of letters. Anything but letters counts as a space and
    spaces in a row count once; pieces overlap by two characters, so that no n-gram is lost or counted twice."""
    shift = np.uint32(32 - bits)
    tail = np.array([32], np.uint32)
    for at in range(0, len(text), piece):
        codes = np.frombuffer(text[at : at + piece].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        codes = np.where(letter, codes, np.uint32(32))
        n_letters = int(letter.sum())
        if at + piece >= len(text):
            codes = np.append(codes, np.uint32(32))
        codes = np.concatenate((tail, codes))
        space = codes == 32
        codes = codes[~(space & np.concatenate(([False], space[:-1])))] if len(codes) > 1 else codes
        old = min(2, len(tail))
        one = codes * np.uint32(0x9E3779B1) + np.uint32(1)
        two = (codes[:-1] * np.uint32(0x85EBCA6B) ^ codes[1:] * np.uint32(0xC2B2AE35)) + np.uint32(2)
        three = two[:-1] * np.uint32(0x27D4EB2F) ^ codes[2:] * np.uint32(0x165667B1)
        parts = [one[old:], two[max(old - 1, 0) :], three[max(old - 2, 0) :]]
        mixed = np.concatenate(parts) * np.uint32(0x9E3779B1)
        yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> shift).astype(np.int64), n_letters
        tail = codes[-2:]


def _separator(gram: np.ndarray, sign: np.ndarray, s: LanguageSettings) -> np.ndarray:
    """Dual coefficients, with their signs, of a linear support vector machine by coordinate descent."""
    alpha, f = np.zeros(len(gram)), np.zeros(len(gram))
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(s.epochs):
        moved = 0.0
        for i in order.permutation(len(gram)):
            new = min(max(alpha[i] + (1 - sign[i] * f[i]) / gram[i, i], 0.0), s.penalty)
            if new != alpha[i]:
                f += (new - alpha[i]) * sign[i] * gram[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return alpha * sign


def fit(examples: list[tuple[str, str]], settings: LanguageSettings = LanguageSettings(), families: Mapping[str, str] = FAMILIES) -> LanguageModel:
    """Model of (text, language) examples; those without a letter are left out. No examples give a model that
    leaves everything undetermined, one language a model that always answers it."""
    s = settings
    seen = [(x, lang) for x, lang in ((_example(text, s), lang) for text, lang in examples) if x is not None]
    return _fitted([x for x, _ in seen], [lang for _, lang in seen], s, families)


def _example(text: str, s: LanguageSettings) -> np.ndarray | None:
    """Features of a training text by its letters, None without a letter."""
    counts, n = np.zeros(1 << s.bits), 0
    for features, letters in _features(text, s.bits, s.piece):
        counts += np.bincount(features, minlength=1 << s.bits)
        n += letters
    return (counts * (10.0 / n)).astype(np.float32) if n else None


def _fitted(rows: list[np.ndarray], labels: list[str], s: LanguageSettings, families: Mapping[str, str]) -> LanguageModel:
    langs = np.array(labels, dtype=object)
    family = np.array([families.get(x, x) for x in labels], dtype=object)
    tree = {f: tuple(sorted(set(langs[family == f]))) for f in sorted(set(family))}
    duels = [(f"family {a}", f"family {b}", family == a, family == b) for a, b in combinations(tree, 2)]
    duels += [(a, b, langs == a, langs == b) for members in tree.values() for a, b in combinations(members, 2)]
    x = np.array(rows, np.float32).reshape(-1, 1 << s.bits)
    coefficients = np.zeros((len(rows), len(duels)))
    for j, (_, _, a, b) in enumerate(duels):
        who = np.flatnonzero(a | b)
        gram = (x[who] @ x[who].T).astype(np.float64) + 1.0  # the bias is one more constant feature
        coefficients[who, j] = _separator(gram, np.where(a[who], 1.0, -1.0), s)
    weights = x.T @ coefficients.astype(np.float32)
    return LanguageModel(tree, tuple((a, b) for a, b, _, _ in duels), np.ascontiguousarray(weights), coefficients.sum(axis=0))


def _winner(names: tuple[str, ...], values: dict[tuple[str, str], float]) -> tuple[str, float]:
    """Most duels won, then the largest sum of margins; its confidence is the logistic of its narrowest duel."""
    if len(names) == 1:
        return names[0], 1.0
    margins = {n: [v if a == n else -v for (a, b), v in values.items() if n in (a, b)] for n in names}
    best = max(names, key=lambda n: (sum(m > 0 for m in margins[n]), sum(margins[n]), n))
    return best, float(1 / (1 + np.exp(-3 * np.clip(min(margins[best]), -20, 20))))


def predict(text: str | None, model: LanguageModel, s: LanguageSettings) -> tuple[str, float]:
    """(language, score from 0 to 1): the product of the confidences in the family and in the language within it."""
    total, n = np.zeros(len(model.duels)), 0
    for features, letters in _features(text or "", s.bits, s.piece):
        n += letters
        for at in range(0, len(features), 65_536):
            total += model.weights[features[at : at + 65_536]].sum(axis=0, dtype=np.float64)
    if not n or not model.families:
        return UNDETERMINED, 0.0
    values = dict(zip(model.duels, (total * (10.0 / n) + model.bias).tolist(), strict=True))
    names = tuple(f"family {f}" for f in model.families)
    family, sure = _winner(names, {d: v for d, v in values.items() if d[0] in names})
    members = model.families[family.removeprefix("family ")]
    lang, surer = _winner(members, {d: v for d, v in values.items() if d[0] in members and d[1] in members})
    return lang, sure * surer


def held_out() -> Column:
    """crc32 of doc_id as text leaves 2 on division by 4; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    """False for a null text and one without a letter."""
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, settings: LanguageSettings = LanguageSettings(), families: Mapping[str, str] = FAMILIES) -> LanguageModel:
    """Fit every language on a bounded sample of rows that have it, a letter and an id that is not held out. The first
    pass counts ids per language, which bounds the hashes of the second. Texts become features where they are; the driver
    receives the features of `per_language` texts of each language at most, whatever the length of these texts."""
    s = settings
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & has_letter(F.col("text")))
    usable = usable.select("lang", "doc_id", "text", F.xxhash64("doc_id").alias("place"))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    # Hashes spread evenly, so about twice as many ids as needed lie below this bound.
    low = (F.col("place") / F.lit(2.0**64) + 0.5) * F.col("n") < 2.0 * s.per_language + 50
    near = usable.join(F.broadcast(sizes), "lang").where(low).select("lang", "doc_id", "text", "place").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", F.xxhash64("text"), "text"))
    picked = near.withColumn("rank", rank).where(F.col("rank") <= s.per_language)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        for batch in batches:
            made = [_example(t.as_py(), s) for t in batch.column(3)]
            used = [np.flatnonzero(x) if x is not None else np.empty(0, np.int64) for x in made]
            at = [u.astype("<u4").tobytes() for u in used]
            values = [x[u].astype("<f4").tobytes() if x is not None else b"" for x, u in zip(made, used, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(at, pa.binary()), pa.array(values, pa.binary())],
                names=["doc_id", "lang", "mark", "at", "value"],
            )

    texts = picked.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.xxhash64("text").alias("mark"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(features, "doc_id long, lang string, mark long, at binary, value binary").where("length(at) > 0")
    rows = []
    examples = sorted(found.collect(), key=lambda r: (r["doc_id"], r["lang"], r["mark"]))
    for r in examples:
        x = np.zeros(1 << s.bits, np.float32)
        x[np.frombuffer(r["at"], "<u4")] = np.frombuffer(r["value"], "<f4")
        rows.append(x)
    return _fitted(rows, [r["lang"] for r in examples], s, families)


def identify(docs: DataFrame, model: LanguageModel, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """(row, lang_pred, score): every row of `docs` as a struct, with the prediction for its whole text. A null text
    and one without a letter are `und` with score 0. Nothing but the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = pc.struct_field(batch.column(0), at).cast(pa.string())
            for part in slices(pa.RecordBatch.from_arrays([batch.column(0), texts], names=["row", "text"]), 1):
                made = [predict(t.as_py(), known, settings) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                    names=["row", "lang_pred", "score"],
                )

    at = [docs.columns.index("text")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def predicted(docs: DataFrame, model: LanguageModel, name: str = "__judged", settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """`docs` with one more column, a struct of lang_pred and score as in `identify`. Only the texts go to the Python
    workers, and only the predictions come back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        free_encoders()
        for batch in texts:
            made = [predict(t.as_py(), shared.value, settings) for t in batch]
            columns = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    return docs.withColumn(name, judge(F.col("text").cast("string")))
