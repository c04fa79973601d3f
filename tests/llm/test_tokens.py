"""Token files and merge replay: exact round trips, and equality with the public libraries."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerloom.llm import bitplanes as B
from ledgerloom.llm import bpe_replay as R
from ledgerloom.llm import units
from ledgerloom.llm.staging import new_path
from ledgerloom.llm.units import Memo, distinct_pieces, distinct_units, splitter, unit_text

LIBRARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
PARTS = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "'s", "'ll", "n't", ".", "…", "é", "日本", "٣", "1", "23", "\x1c", "\x85", "\x0b", "\r", "😀", "<|endoftext|>", "aaaa", "​", "²", "\x00"]


def texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(LIBRARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=R.load_ranks(RANKS), special_tokens={}).encode_ordinary


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_blocks_round_trip(kind):
    r = np.random.default_rng(1)
    for ids in (r.integers(0, 50257, 70_001), r.integers(0, 2**32, 9), np.zeros(5), np.empty(0)):
        assert np.array_equal(B.unpack_block(B.pack_block(ids.astype("<u4"), kind)), ids.astype("<u4"))


def test_joined_crc():
    data = random.Random(2).randbytes(1000)
    cuts = [(0, 300), (300, 301), (301, 301), (301, 1000)]
    assert B.crc32_joined([(zlib.crc32(data[a:b]), b - a) for a, b in cuts]) == zlib.crc32(data)


def test_memo_overflow_and_odd_texts(library, ranks):
    b, r = B.LibraryEncoder(LIBRARY, P.PATTERN, memo_units=5), R.ReplayEncoder(RANKS, P.PATTERN, memo_units=5, pairs=3)
    for text in texts(1500):
        assert np.frombuffer(b.texts([text])[0], "<u4").tolist() == library(text)
        ids, data = r.texts([text])[0]
        assert ([int(i) for i in ids.split(",")] if ids else []) == ranks(text)
        assert data == text.encode()


def test_added_tokens_as_the_library_has_them_by_default():
    default = Tokenizer.from_file(LIBRARY)
    encoder = B.LibraryEncoder(LIBRARY, P.PATTERN, memo_units=5, added=True)
    given = [None, "", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext| >", *texts(600)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.texts(given)]
    assert got == [default.encode(t or "", add_special_tokens=False).ids for t in given]
    assert got[2] == [64, 220, 50256, 275]


def test_query_of_token_ids_knows_added_tokens(spark, tmp_path):
    from ledgerloom.llm.queries import op4_bit_plane_ids

    rows, default, start = [(1, "a <|endoftext|> b"), (2, "the next one"), (3, None)], Tokenizer.from_file(LIBRARY), 0
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op4_bit_plane_ids(spark, f"file://{tmp_path}").collect()))
    for doc, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*default.encode(text or "", add_special_tokens=False).ids, 0]
        assert doc == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_crc_of_pieces_is_joined_from_few_matrices():
    made = []
    step = lambda k, f=B._crc_step.__wrapped__: made.append(k) or f(k)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(B, "_crc_step", lru_cache(step))
        for n in (1, 5, 65_536, 262_145):
            data = random.Random(n).randbytes(n + 9)
            assert B.crc32_joined([(zlib.crc32(data[:9]), 9), (zlib.crc32(data[9:]), n)]) == zlib.crc32(data)
    assert len(made) == len(set(made)) <= 22


def test_a_full_memo_stays_while_it_is_of_use():
    memo, made = Memo(3), []
    ask = lambda units: list(map(memo.encode(units, lambda m: made.extend(m) or map(str.upper, m)).__getitem__, units))
    for units in ("abcd", "abce", "abcf"):
        memo.start_task()
        assert ask(list(units)) == list(units.upper())
    assert made == list("abcdef")
    for _ in range(2):  # other texts: the task after starts afresh
        memo.start_task()
        assert ask(["x", "y"]) == ["X", "Y"]
    memo.start_task()
    assert ask(["x", "y"]) == ["X", "Y"] and made == [*"abcdef", "x", "y", "x", "y"]


def test_pieces_of_units_in_any_mix():
    pieces, find = splitter(P.PATTERN)
    for seed in range(200):
        keys = [k for k in distinct_units(texts(9, seed), find)[0] if seed % 3 or k[0] in "\0\n"]
        cut, numbers, counts = distinct_pieces(keys, pieces, find)
        runs = np.split(numbers, np.cumsum(counts)[:-1]) if keys else []
        assert len(set(cut)) == len(cut)
        assert [[cut[i] for i in run] for run in runs] == [pieces(unit_text(k)) for k in keys]


def test_replay_takes_byte_pairs_from_an_array(ranks):
    encoder = R.ReplayEncoder(RANKS, P.PATTERN)
    words = [f"{a}qz{b}xj{a}" for a in "abcdefgh" for b in "klmnopq"]
    assert encoder.replay([*map(str.encode, words), b"", b"a"]) == [*map(ranks, words), [], ranks("a")]
    single = set(encoder.single)
    assert not any(left in single and right in single for left, found in encoder.by_left.items() for right in found)
    assert sum(map(len, encoder.by_left.values())) == sum(map(len, encoder.by_right.values())) == encoder.n_pairs


def test_operators_that_encode_nothing_free_the_encoder(frame, monkeypatch):
    from ledgerloom.llm import minhash, tiling

    df, tasks = frame([(1, "the words")], "doc_id long, text string"), []
    keep = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, task, *a, **b: tasks.append(task) or keep(self, task, *a, **b))
    minhash.shingle_features(df, minhash.MinHashSettings())
    tiling.contaminated_pairs(df, frame([(1, "a word")], "item_id long, text string"))
    for task in (tasks[0], tasks[2]):
        encoder = R.replay_encoder(RANKS, P.PATTERN)
        assert R.replay_encoder(RANKS, P.PATTERN) is encoder
        list(task(iter([])))
        assert R.replay_encoder(RANKS, P.PATTERN) is not encoder
    B.library_encoder(LIBRARY, P.PATTERN)
    assert len(units._ENCODERS) == 1


def test_long_pieces(ranks):
    text = "ab" * 20_000 + "a" * 5001 + " " * 3000
    ids, data = R.ReplayEncoder(RANKS, P.PATTERN).texts([text])[0]
    assert [int(i) for i in ids.split(",")] == ranks(text)
    assert data == text.encode()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_folder(frame, spark, library, kind):
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts(60))] + [(200, None), (201, ""), (202, "the words " * 5000), (203, "x"), (203, "x"), (None, "none")]
    path = new_path(spark, "test-ids")
    B.write_token_ids(frame(rows, "doc_id long, text string"), path, LIBRARY, P.PATTERN, block_ids=1000, kind=kind)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    want, start = {}, 0
    for doc_id, text in ordered:
        ids = [*library(text), 0]
        want.setdefault(doc_id, []).append((start, ids))
        start += len(ids)
    whole = {}
    for r in B.read_token_ids(spark, path).collect():
        whole.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    digests = {}
    for r in B.digests(spark, path).collect():
        digests.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    for doc_id, parts in want.items():
        assert sorted(whole[doc_id]) == sorted(parts)
        assert sorted(digests[doc_id]) == sorted((s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for s, i in parts)


def test_empty_token_folder(frame, spark):
    path = new_path(spark, "test-ids")
    B.write_token_ids(frame([], "doc_id long, text string"), path, LIBRARY, P.PATTERN)
    assert B.digests(spark, path).collect() == []


def test_replay_rows(frame, ranks):
    rows = [(i, t) for i, t in enumerate(texts(40))] + [(None, None), (3, ""), (3, ""), (9, "the words " * 3000)]
    df = frame(rows, "doc_id long, text string")
    got = sorted(map(tuple, R.digests(df, RANKS, P.PATTERN).collect()), key=str)
    want = []
    for doc_id, text in rows:
        ids = ranks(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    encoded = R.encode(df, RANKS, P.PATTERN)
    assert sorted((r["doc_id"] or -1, r["ids"], r["n_tokens"]) for r in encoded.collect()) == sorted((d or -1, ranks(t or ""), len(ranks(t or ""))) for d, t in rows)
    decoded = R.decode(encoded.select("doc_id", "ids"), RANKS, P.PATTERN)
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"])) for r in decoded.collect()) == sorted((d or -1, (t or "").encode()) for d, t in rows)
    assert R.digests(frame([], "doc_id long, text string"), RANKS, P.PATTERN).collect() == []
