"""MinHash near-duplicates with sequential Bayesian verification.

Whole texts become sets of five-word shingles. Equal sets form a class at once; only one member of each class goes
on. Signatures are cut into bands, and documents that share a band are candidates. A candidate pair is compared in
batches of signature positions: under a uniform prior the similarity after m of n matches is Beta(m + 1, n - m + 1),
and the pair is dropped as soon as the posterior probability of reaching the threshold is below `miss_probability`.
Every survivor is confirmed on the full shingle sets.

No bucket is ever expanded into all pairs of one connected group. Round one compares every member of a bucket with
one hub, a different one in each band, which already connects large groups of near copies. Round two compares, in
blocks of bounded size, only members whose components still differ: first their signatures, then the sets of those
that have a plausible partner. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bloom import bloom_blocks, possible
from ledgerloom.llm.components import components
from ledgerloom.llm.staging import staged
from ledgerloom.llm.units import free_encoders

SHINGLE = 5


@dataclass(frozen=True)
class MinHashSettings:
    """`bands` of `rows` positions. The chance that a pair at the threshold shares no band is
    (1 - threshold ** rows) ** bands, 6e-6 by default. `percent`: similarity threshold in hundredths.
    `block`: members compared at a time; `filter_blocks`: size of the filter of wanted ids, in units of 64 bytes."""

    bands: int = 32
    rows: int = 4
    percent: int = 75
    batch: int = 16
    miss_probability: float = 1e-6
    block: int = 2048
    filter_blocks: int = 1 << 15

    @property
    def positions(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=8)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.Generator(np.random.PCG64(20_240_601))
    factor = made.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factor, made.integers(0, 2**63, n, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of anything but ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles; a shorter text is one shingle, no words give none."""
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray, positions: int) -> np.ndarray:
    """Minimum per permutation, mixed and cut to 16 bits: a chance match in 65,536 makes sets look more alike, never
    less."""
    factor, offset = _permutations(positions)
    low = np.full(positions, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), 1024):
        moved = hashes[at : at + 1024, None] * factor + offset
        low = np.minimum(low, (moved >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return (low * np.uint32(0x9E3779B1) >> np.uint32(16)).astype("<u2")


@lru_cache(maxsize=8)
def fewest_matches(batch: int, positions: int, percent: int, miss_probability: float) -> tuple[tuple[int, int], ...]:
    """(n, m) per batch: a pair with fewer than m matches among the first n positions is dropped, because
    P(similarity >= threshold) = P(Binomial(n + 1, threshold) <= matches) is below `miss_probability`."""
    out, t = [], percent / 100
    for n in [*range(batch, positions, batch), positions]:
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss_probability:
                break
            m += 1
        out.append((n, m))
    return tuple(out)


def plausible(left: np.ndarray, right: np.ndarray, limits: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Indices of the row pairs that no batch prunes."""
    alive = np.arange(len(left) if left.ndim > 1 else len(right))
    matches, at = np.zeros(len(alive), np.int64), 0
    for n, fewest in limits:
        a = left[alive, at:n] if left.ndim > 1 else left[at:n]
        matches = matches + (a == right[alive, at:n]).sum(axis=1)
        alive, matches, at = alive[matches >= fewest], matches[matches >= fewest], n
        if not len(alive):
            break
    return alive


def shingle_features(docs: DataFrame, s: MinHashSettings) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig) per row: size, identity and signature of the shingle set. A text without
    words gets a key of its own id, so that it equals nothing but its own repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        for batch in batches:
            counts, keys, sigs = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                hashes = shingle_hashes(words_of(text.as_py()))
                counts.append(len(hashes))
                if len(hashes):
                    keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    sigs.append(signature(hashes, s.positions).tobytes())
                else:
                    keys.append(xxhash.xxh3_128_digest(f"empty {doc_id.as_py()}".encode()))
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "sig"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _surviving(pairs: DataFrame, sigs: DataFrame, s: MinHashSettings) -> DataFrame:
    limits = fewest_matches(s.batch, s.positions, s.percent, s.miss_probability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, s.positions) for i in (2, 3)
            ]
            good = pa.array(plausible(*sides, limits))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(good) for i in (0, 1)], names=["a", "b"])

    first = sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    second = sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "sig_a", "sig_b")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _compact(texts: DataFrame, s: MinHashSettings) -> DataFrame:
    """(rep, sig, codes): signature and full shingle set, as hashes of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        for batch in batches:
            sets = [shingle_hashes(words_of(t.as_py())) for t in batch.column(1)]
            some = pa.array([len(h) > 0 for h in sets], pa.bool_())  # an id may have a text without words beside others
            sets = [h for h in sets if len(h)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(some), pa.array([signature(h, s.positions).tobytes() for h in sets], pa.binary()),
                    pa.array([h.astype("<u8").tobytes() for h in sets], pa.binary()),
                ],
                names=["rep", "sig", "codes"],
            )

    return texts.mapInArrow(run, "rep long, sig binary, codes binary")


def _block_groups(rest: DataFrame, s: MinHashSettings) -> DataFrame:
    """Rows of `rest` (bkey, band, rep, comp, main, n_main, n_out) with a task group (bkey, i, j) and a side of it.

    Members of a bucket's largest component (`main`) need no comparison among themselves, so they are dealt into
    blocks once; only the others are copied to every block. A group holds about two blocks at most, however large
    the bucket.
    """
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(s.block)).cast("int"))
    deal = F.xxhash64("rep", "bkey")
    dealt = rest.withColumn("blocks_main", parts("n_main")).withColumn("blocks_out", parts("n_out"))
    own = F.when(F.col("main"), F.pmod(deal, F.col("blocks_main"))).otherwise(F.pmod(deal, F.col("blocks_out")))
    dealt = dealt.withColumn("own", own.cast("int"))
    fields = ["bkey", "band", "rep", "comp"]
    main = dealt.where("main").select(*fields, F.lit(-1).alias("i"), F.col("own").alias("j"), F.lit(0).alias("side"))
    out = dealt.where("not main")
    # Others against the largest component: a copy per block of it; i = -1 marks that kind of group.
    to_main = out.select(*fields, F.lit(-1).alias("i"), F.explode(F.expr("sequence(0, blocks_main - 1)")).alias("j"), F.lit(1).alias("side"))
    # Others among themselves: each pair of their blocks is one group.
    among = out.withColumn("other", F.explode(F.expr("sequence(0, blocks_out - 1)"))).select(
        *fields, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    return main.unionByName(to_main).unionByName(among)


def _partners(sigs: np.ndarray, comps: np.ndarray, sides: np.ndarray, band: int, s: MinHashSettings) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a group with the rows of another component that no batch of the signatures prunes. A pair is
    given in the first band that it shares, not once per band. `comps` may change while this runs."""
    limits = fewest_matches(s.batch, s.positions, s.percent, s.miss_probability)
    # The outer loop goes over the side without the largest component, which is the smaller one.
    inner, outer = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    for x in outer:
        against = inner[comps[inner] != comps[x]]
        if sides[x] == 2:
            against = against[against > x]
        against = against[plausible(sigs[x], sigs[against], limits)]
        same = (sigs[against] == sigs[x]).reshape(len(against), s.bands, s.rows).all(axis=2)
        yield x, against[same.argmax(axis=1) == band]


def _signatures(table: pa.Table, s: MinHashSettings) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, s.positions)


def _with_partners(groups: DataFrame, s: MinHashSettings) -> DataFrame:
    """Rows of `groups` (with sig) that have a plausible partner in their group, without sig."""

    def mark(table: pa.Table) -> pa.Table:
        comps, sides = (table.column(c).to_numpy() for c in ("comp", "side"))
        wanted = np.zeros(table.num_rows, bool)
        for x, against in _partners(_signatures(table, s), comps, sides, table.column("band")[0].as_py(), s):
            wanted[x] |= len(against) > 0
            wanted[against] = True
        return table.drop_columns(["sig"]).filter(pa.array(wanted))

    schema = "bkey long, band int, rep long, comp long, i int, j int, side int"
    columns = [f.split()[0] for f in schema.split(", ")]
    return groups.select(*columns, "sig").groupBy("bkey", "i", "j").applyInArrow(mark, schema)


def _linking_pairs(groups: DataFrame, s: MinHashSettings) -> DataFrame:
    """Pairs that link rows of one group (with sig and codes) across components.

    Pairs that survive the signatures are confirmed on the full sets, and each pair that joins two components is given
    once: a link between components that are already joined would change nothing. So the pairs given number less
    than the members, and components are only joined by confirmed links.
    """

    def compare(table: pa.Table) -> pa.Table:
        reps, comps, sides = (table.column(c).to_numpy().copy() for c in ("rep", "comp", "side"))
        codes = [np.frombuffer(c.as_buffer(), "<u8") for c in table.column("codes")]
        sizes = np.array([len(c) for c in codes])
        left, right = [], []
        for x, against in _partners(_signatures(table, s), comps, sides, table.column("band")[0].as_py(), s):
            for at in range(0, len(against), 256):
                some = against[at : at + 256]
                some = some[comps[some] != comps[x]]
                if not len(some):
                    continue
                shared = np.isin(np.concatenate([codes[y] for y in some]), codes[x])
                shared = np.add.reduceat(shared.astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
                for y in some[100 * shared >= s.percent * (sizes[some] + sizes[x] - shared)]:
                    if comps[y] != comps[x]:
                        left.append(min(reps[x], reps[y]))
                        right.append(max(reps[x], reps[y]))
                        comps[comps == comps[y]] = comps[x]
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return groups.groupBy("bkey", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _likely_texts(ids: DataFrame, docs: DataFrame, s: MinHashSettings) -> DataFrame:
    """(id, text) of the given ids and of a few others, which an exact join has to remove: a Bloom filter of bounded
    size keeps most texts out of that join. The more ids there are for its size, the more texts only the join removes."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return possible(texts, F.col("id"), bloom_blocks(ids, F.col("id"), s.filter_blocks), s.filter_blocks)


def _confirmed(pairs: DataFrame, docs: DataFrame, s: MinHashSettings) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    texts = _likely_texts(wanted, docs, s)
    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        @lru_cache(maxsize=64)
        def hashes(text: str | None) -> np.ndarray:
            return shingle_hashes(words_of(text))

        for batch in batches:
            good = []
            for row, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                left, right = hashes(x.as_py()), hashes(y.as_py())
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if shared and 100 * shared >= s.percent * (len(left) + len(right) - shared):
                    good.append(row)
            kept = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i).take(kept) for i in (0, 1)], names=["a", "b"])

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: MinHashSettings = MinHashSettings()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, kept tells whether the document is that one. Texts
    that are null, empty or without words have no shingles and no links. Rows that repeat a doc_id are one document
    with the links of all its texts. A row with null doc_id can't be named by others: component_id is null and kept
    is true. Other columns are ignored. An empty table gives an empty result.
    """
    s = settings
    feats = staged(shingle_features(docs, s), "shingles")
    named = feats.where("doc_id is not null")
    classes = named.groupBy("set_key").agg(F.min(F.struct("doc_id", "sig")).alias("first"), F.count("*").alias("size"))
    classes = staged(classes.select("set_key", F.col("first.doc_id").alias("rep"), F.col("first.sig").alias("sig"), "size"), "classes")
    sigs = classes.where("sig is not null").select("rep", "sig")

    band = F.explode(F.sequence(F.lit(0), F.lit(s.bands - 1)))
    width = 2 * s.rows
    banded = sigs.withColumn("band", band).select(
        F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("bkey"), "band", "rep"
    )
    # Exclusive or with the bucket's key orders the members differently in each bucket, and gives the hub back.
    mixed = F.min(F.col("rep").bitwiseXOR(F.col("bkey")))
    hubs = banded.groupBy("bkey").agg(mixed.bitwiseXOR(F.col("bkey")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = banded.join(hubs, "bkey")
    members = staged(members, "members")

    star = members.where("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    links = staged(_confirmed(staged(_surviving(star.distinct(), sigs, s), "pairs"), docs, s), "confirmed")
    # A doc_id with several different texts joins the classes of these texts.
    several = named.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"), F.count("*").alias("n"))
    several = several.where("x <> y").select("doc_id")
    tied = named.join(several, "doc_id", "left_semi").join(classes.select("set_key", "rep"), "set_key")
    links = links.unionByName(tied.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"))

    comps = components(links)
    left = members.where("n > 2").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    left = left.select("bkey", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    sizes = left.groupBy("bkey", "comp").agg(F.count("*").alias("n"))
    shape = sizes.groupBy("bkey").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("k"))
    shape = shape.where("k > 1").select(
        "bkey", F.col("top.comp").alias("main_comp"), F.col("top.n").alias("n_main"), (F.col("n") - F.col("top.n")).alias("n_out")
    )
    rest = left.join(shape, "bkey").withColumn("main", F.col("comp") == F.col("main_comp"))
    rest = staged(_with_partners(_block_groups(rest, s).join(sigs, "rep"), s), "rest")
    wanted = rest.select(F.col("rep").alias("id")).distinct()
    texts = _likely_texts(wanted, docs, s).join(wanted, "id", "left_semi")
    second = staged(_linking_pairs(rest.join(_compact(texts, s), "rep"), s), "pairs")
    comps = components(links.unionByName(second))

    grouped = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = grouped.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = feats.select("doc_id", "n_shingles", "set_key").join(grouped, "set_key", "left")
    unnamed = F.col("doc_id").isNull()
    component = F.when(~unnamed, F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), (unnamed | (F.col("doc_id") == F.col("component_id"))).alias("kept")
    )
