"""Near duplicates against brute force over all pairs."""

import random
from dataclasses import replace

import numpy as np
import pytest

from ledgerloom.llm import minhash as M


def brute(rows):
    sets = {}
    for doc_id, text in rows:
        w = M.words_of(text)
        sets.setdefault(doc_id, []).append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    low = {i: i for i in sets}
    changed = True
    linked = [(a, b) for a in sets for b in sets if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "w" + str(r.randrange(3000))
    rows, n = [], 0
    for base in range(12):
        text = [word() for _ in range(r.choice([4, 30, 120]))]
        for _ in range(r.choice([1, 2, 25])):
            copy = [w if r.random() > 0.03 else word() for w in text]
            rows.append((n, " ".join(copy)))
            n += 1
    return rows


def test_equals_brute_force_with_small_blocks(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, " \t\n"), (903, "One  TWO"), (904, "one two"), (905, "one two"), (906, "x " * 20_000), (907, "x " * 9)]
    settings = replace(M.MinHashSettings(), block=4)
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    low = brute(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == low
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    counts = {r["doc_id"]: r["n_shingles"] for r in got}
    assert [counts[i] for i in (900, 901, 902, 903, 906, 907)] == [0, 0, 0, 1, 1, 1]


def test_null_and_repeated_ids_and_clashing_columns(frame):
    a, b = "a b c d e f g h", "k l m n o p q r"
    rows = [(5, a), (5, b), (5, b), (7, a), (8, b), (None, a), (None, None)]
    got = M.near_duplicates(frame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {5: 5, 7: 5, 8: 5, None: None}
    assert len(got) == len(rows)
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True, True]


def test_empty(frame):
    assert M.near_duplicates(frame([], "doc_id long, text string")).collect() == []


def test_pruning_limits_follow_the_posterior():
    limits = M.fewest_matches(16, 128, 75, 1e-6)
    assert [n for n, _ in limits] == list(range(16, 129, 16))
    assert all(a <= b for (_, a), (_, b) in zip(limits, limits[1:], strict=False))
    left = np.zeros((2, 128), np.uint32)
    right = np.stack([np.zeros(128, np.uint32), np.ones(128, np.uint32)])
    assert M.plausible(left, right, limits).tolist() == [0]


@pytest.mark.parametrize("links", [[], [(2, 1)], [(i, i + 1) for i in range(40)] + [(100, 99), (3, 3), (None, 4)]])
def test_components(spark, links):
    from ledgerloom.llm.components import components

    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {} if not links else {2: 1, 1: 1} if len(links) == 1 else {**{i: 0 for i in range(41)}, 99: 99, 100: 99}
    assert got == want


def test_second_round_joins_components_by_full_hashes_only(spark):
    # Equal in the upper 32 bits, so that only full hashes tell the sets of 1 and 2 apart; 3 truly links to 2.
    high = np.arange(1, 41, dtype=np.uint64) << np.uint64(32)
    sets = {1: high | np.uint64(1), 2: high | np.uint64(2), 3: np.concatenate([high[:36] | np.uint64(2), high[36:] | np.uint64(3)])}
    s = M.MinHashSettings()
    sig = M.signature(sets[2], s.positions).tobytes()
    rows = [(5, 0, i, i, 0, 0, 2, sig, h.astype("<u8").tobytes()) for i, h in sets.items()]
    groups = spark.createDataFrame(rows, "bkey long, band int, rep long, comp long, i int, j int, side int, sig binary, codes binary")
    assert [tuple(r) for r in M._linking_pairs(groups, s).collect()] == [(2, 3)]


def test_repeated_id_with_a_text_without_words(frame):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, t) for i in range(6) for t in (text.replace("w59", f"x{i}"), " ", None)]
    got = M.near_duplicates(frame(rows, "doc_id long, text string")).collect()
    assert len(got) == 18 and {r["component_id"] for r in got} == {0}
