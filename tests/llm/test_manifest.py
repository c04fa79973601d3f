"""Manifest against a plain recursion over all leaves."""

import hashlib
import zlib
from dataclasses import replace

from pyspark.sql import functions as F

from ledgerloom.llm import merkle as M

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def fold(nodes):
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0]


def climb(nodes, place):
    """Siblings from a node to the top."""
    out = []
    while len(nodes) > 1:
        start = place // 8 * 8
        out += [n for i, n in enumerate(nodes[start : start + 8], start) if i != place]
        nodes, place = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], place // 8
    return out


def brute(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {g: fold([leaf(r) for r in groups[g]]) for g in names}
    root = fold([tops[g] for g in names])
    out = []
    for k, g in enumerate(names):
        leaves = [leaf(r) for r in groups[g]]
        for i, row in enumerate(groups[g]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            low = None if row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            new = leaf((*row[:4], low)) if hit else leaves[i]
            top = fold([*leaves[:i], new, *leaves[i + 1 :]])
            folded = fold([top if n == g else tops[n] for n in names])
            proof = h(*climb(leaves, i), *climb([tops[n] for n in names], k))
            out.append((row[0], leaves[i], tops[g], root, proof, folded, folded == root))
    return sorted(out, key=str)


def run(df, levels):
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return M.manifest(df, COLUMNS, "lang", "doc_id", {"text": lower}, hit, replace(M.ManifestSettings(), levels=levels))


def corpus():
    rows = [(i * 5 % 301, "s", None if i % 11 == 0 else f"l{i % 4}", i, f"Text {i}" if i % 3 else f"text {i}") for i in range(300)]
    rows += [(900, None, "Ä", None, None), (901, "", "", 0, ""), (903, "s", "z", 1, "Ünï " + "A long one. " * 20_000)]
    rows += [(None, "s", "l1", 1, "NO id"), (904, "s", "l2", 1, "A twin"), (904, "s", "l2", 2, "Another"), (904, "s", "l2", 1, "A twin")]
    return rows


def test_equals_plain_recursion_over_several_stages(spark, frame):
    """Blocks of 8 nodes, so that languages reach over three stages; the last run of a level is often short."""
    rows = corpus()
    got = run(frame(rows, SCHEMA).repartition(6), 1).drop("copied").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_block_size_does_not_change_the_result(spark, frame):
    rows = corpus()
    got = run(frame(rows, SCHEMA).repartition(3), 3).drop("copied").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_many_groups(spark, frame):
    """More groups than a block has nodes: the tree over the subroots is spread as well."""
    rows = [(i, "s", f"l{i % 90}", i, f"T{i}") for i in range(200)]
    assert sorted(map(tuple, run(frame(rows, SCHEMA), 1).drop("copied").collect()), key=str) == brute(rows)


def test_versions_copy_a_path_and_share_the_rest(spark, frame):
    rows = [(i, "s", "l", i, f"T{i}") for i in range(100)]
    got = {r["doc_id"]: r for r in run(frame(rows, SCHEMA), 1).collect()}
    for r in got.values():
        if zlib.crc32(str(r["doc_id"]).encode()) % 3:
            assert r["copied"] == [] and r["verified"]
        else:
            # Leaf, 13 runs, 2 runs, top; a lone language is the root itself.
            assert len(r["copied"]) == 4 and r["copied"][-1] == r["folded_root"] != r["root"]


def test_single_row_and_empty_table(spark, frame):
    row = (3, "s", "l", 1, "x")
    (only,) = run(frame([row], SCHEMA), 3).collect()
    assert only["root"] == only["subroot"] == only["leaf"] == leaf(row) and only["proof_sha256"] == h("")
    empty = run(frame([], SCHEMA), 3)
    assert empty.collect() == [] and "verified" in empty.columns
