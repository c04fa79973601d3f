"""The pipeline as a whole, stage by stage against plain Python versions over all documents."""

import hashlib
import re

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from ledgerloom.llm import bpe_replay, pii
from ledgerloom.llm import tiling as T
from test_minhash import brute


def test_run_equals_plain_versions_of_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    # Language: only texts with a letter stay.
    texts = {r["doc_id"]: r["text"] for r in docs if r["text"] and any(c.isalpha() for c in r["text"])}
    # Near duplicates: the smallest id that is reachable over links.
    low = brute(list(texts.items()))
    texts = {d: t for d, t in texts.items() if low[d] == d}
    # Decontamination: every document against every item, longest unmarked match first.
    parts = [T.words_of(t) for t in items]

    def contaminated(text):
        words = T.words_of(text)
        return any(sum(n for _, _, n in plain_tiles(i, words, min(5, len(i)))) >= 0.6 * len(i) for i in parts if i and may_share(i, words))

    clean = {d: t for d, t in texts.items() if not contaminated(t)}
    assert 0 < len(clean) < len(texts) < len(docs)
    # Personal data, then token ids as the public library has them.
    masked = {d: pii.masked(t, pii.find_spans(t)[1]) for d, t in clean.items()}
    ranks = bpe_replay.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: (library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for d, t in masked.items()}

    got = C.run(spark, sf_dir).collect()
    assert len(got) == len({r["doc_id"] for r in got})
    assert {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in got} == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def may_share(item, words):
    size = min(5, len(item))
    runs = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)}
    return any(tuple(words[i : i + size]) in runs for i in range(len(words) - size + 1))


def plain_tiles(item, doc, shortest):
    """Greedy string tiling by looking for the longest common run of unmarked words again and again."""
    item_free, doc_free, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        before = [0] * (len(doc) + 1)
        for a in range(len(item)):
            now = [0] * (len(doc) + 1)
            for b in range(len(doc)):
                if item_free[a] and doc_free[b] and item[a] == doc[b]:
                    now[b + 1] = n = before[b] + 1
                    if n >= shortest:
                        best = max(best, (n, n - a - 1, n - b - 1))
            before = now
        if not best[0]:
            return tiles
        n, a, b = best[0], -best[1], -best[2]
        item_free[a : a + n], doc_free[b : b + n] = [False] * n, [False] * n
        tiles.append((a, b, n))


def test_tiles_equal_the_plain_search():
    import random

    r = random.Random(3)
    for _ in range(150):
        kinds = r.choice([2, 3, 6, 60])
        word = lambda: b"w%d" % r.randrange(kinds)  # noqa: B023, E731
        item, doc = [word() for _ in range(r.randrange(1, 30))], [word() for _ in range(r.randrange(1, 50))]
        if r.random() < 0.5:
            doc[3:3] = item[2:20]
        size = r.choice([1, 2, 4])
        want = sorted(plain_tiles(item, doc, size))
        assert sorted(T.tile(item, doc, size)) == sorted(T._tile_repetitive(item, doc, size)) == want


@pytest.mark.parametrize("column", ["text", "lang", "source", "n_chars", "doc_id"])
def test_run_over_empty_tables_and_null_columns(spark, sf_dir, tmp_path, column):
    """A table whose column is null throughout; with doc_id null, documents can't be named and stay as far as their texts
    allow."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"file://{tmp_path}"
    few = docs.limit(0) if column == "text" else docs.orderBy("doc_id").limit(12)
    few.selectExpr(*[f"CAST(NULL AS {t}) AS {c}" if c == column else c for c, t in docs.dtypes]).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(0 if column == "lang" else 5).write.parquet(f"{folder}/benchmark.parquet")
    got = C.run(spark, folder).collect()
    assert (len(got) == 0) == (column == "text")
    if column == "doc_id":
        assert len(got) == sum(bool(r["text"]) and any(c.isalpha() for c in r["text"]) for r in few.collect())


# ---- personal data: the patterns of the contract, run beside the operator's --------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n // 10 + n % 10
    return total % 10 == 0


def contract_spans(text):
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_plain_findings_equal_the_contract_on_random_texts():
    import random

    r = random.Random(7)
    pieces = ["a", "b.c", "@", ".", "-", " ", "+4", "1", "22", "192.168.0.1", "256", "4111 1111 1111 1111", "4111111111111111", "(030) ", "é", "%", "_", "\n", "9999-"]
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 18)))
        assert pii.find_plain(text) == contract_spans(text), text


def test_long_disguised_texts_take_bounded_memory():
    import tracemalloc

    text = ("привет мир, some more words in between " * 60_000) + "joe at mail dot org"
    tracemalloc.start()
    plain, spans = pii.find_spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert plain == [] and spans == [("email", len(text) - 19, len(text))]
    assert peak < 25 * len(text)


def test_repetitive_items_take_linear_memory():
    import tracemalloc

    tracemalloc.start()
    tiles = T.tile([b"x"] * 2_000, [b"x"] * 300_000, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tiles == [(0, 0, 2_000)] and peak < 100 * 2**20


def test_most_texts_stay_without_a_shuffle(spark, frame, monkeypatch):
    rows = [(i, f"text {i} of its own kind and words {i} {i + 1}") for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(20)] + [(7, rows[7][1]), (8, "quite another text"), (None, "no id"), (None, None)]
    docs = frame(rows, "doc_id long, text string")
    asked = []
    monkeypatch.setattr(C, "possible", lambda *a, f=C.possible: asked.append(f(*a)) or asked[0])
    got = [tuple(r) for r in C.keep_one_of_near_duplicates(spark, docs, "").select("doc_id", "text").collect()]
    eight = [r for r in got if r[0] == 8]
    assert len(eight) == 1 and eight[0] in {rows[8], (8, "quite another text")}
    assert sorted((r for r in got if r[0] != 8), key=str) == sorted([*(r for r in rows[:300] if r[0] != 8), *rows[-2:]], key=str)
    assert 24 <= asked[0].count() <= 40
