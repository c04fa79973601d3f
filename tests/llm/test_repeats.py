"""Repeated passages against a scan over all windows."""

import random
from dataclasses import replace

import pytest

from ledgerloom.llm import anchors as A


def brute(rows, window):
    """Result by doc_id, where ids are distinct: windows are looked up one after the other."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc_id] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


def result(df, settings):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in A.without_repeats(df, settings).collect()}


def corpus(seed):
    """Passages around the window's length, drawn again and again, between words of a small and of a large vocabulary."""
    r = random.Random(seed)
    words = lambda n, kinds: " ".join(f"w{r.randrange(kinds)}" for _ in range(n))
    pool = [words(r.choice([5, 7, 8, 9, 15, 40]), 50) for _ in range(30)]
    rows = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a " * 500), (1004, "b c " * 40), (None, pool[-1] + " x " + pool[-2])]
    for i in range(300):
        parts = [r.choice(pool) if r.random() < 0.5 else words(r.randrange(1, 20), r.choice([9, 5000])) for _ in range(r.randrange(8))]
        rows.append((i * 7 % 307, " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed, window", [(0, 7), (1, 8), (2, 20)])
def test_equals_scan_over_all_windows(spark, frame, seed, window):
    """Small chunks and buckets, so that passages meet across many of them; odd and even lengths."""
    rows = corpus(seed)
    settings = replace(A.RepeatSettings(), window=window, chunk_bytes=700, bucket_entries=500)
    assert result(frame(rows, "doc_id long, text string").repartition(5), settings) == brute(rows, window)


def test_settings_do_not_change_the_result(spark, frame):
    docs = frame(corpus(5), "doc_id long, text string")
    small = replace(A.RepeatSettings(), window=8, chunk_bytes=100, bucket_entries=200)
    assert result(docs, small) == result(docs.repartition(7), replace(small, chunk_bytes=1 << 20, bucket_entries=10**6))


def test_hot_passage_and_maximal_spans(spark, frame):
    """A passage that all documents hold stays in the first only; spans are maximal runs of removed words."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} {passage} z{i}") for i in range(400)]
    got = {r["doc_id"]: r for r in A.without_repeats(frame(rows, "doc_id long, text string"), replace(A.RepeatSettings(), chunk_bytes=900)).collect()}
    assert got[0]["n_removed"] == 0 and got[0]["kept"] == rows[0][1]
    assert all([tuple(s) for s in got[i]["spans"]] == [(1, 61)] and got[i]["kept"] == f"a{i} z{i}" for i in range(1, 400))


def test_long_text_repeated_rows_and_unnamed_rows(spark, frame):
    long = " ".join(f"l{i % 9973}" for i in range(200_000))
    rows = [(1, long), (2, long), (7, "q " + long[:600]), (7, "q " + long[:600]), (None, long[:900]), (None, "only here")]
    got = sorted((r["doc_id"] or 99, r["n_words"], r["n_removed"]) for r in A.without_repeats(frame(rows, "doc_id long, text string")).collect())
    seven, tail = len(rows[2][1].split()), len(rows[4][1].split())
    # Only whole words of the long text repeat; the cut-off last one doesn't.
    assert [g for g in got if g[0] in (1, 2)] == [(1, 200_000, 200_000 - 9973 - 0), (2, 200_000, 200_000)]
    assert [g[:2] for g in got if g[0] == 7] == [(7, seven)] * 2 and {g[2] for g in got if g[0] == 7} <= {seven - 2, seven - 1, seven}
    assert [g[1] for g in got if g[0] == 99] == [2, tail]


def test_empty_table(spark, frame):
    empty = A.without_repeats(frame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]
