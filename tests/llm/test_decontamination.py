"""Benchmark search against a plain comparison of every window at every place."""

import hashlib
import random
import re
import string
import tracemalloc

import pytest

from docfold.llm import decontamination as dec
from docfold.llm.common import ready

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        have, hit, named = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            k = min(window, len(w))
            for i in range(len(w) - k + 1 if k else 0):
                for j in range(len(have) - k + 1):
                    if have[j : j + k] == w[i : i + k]:
                        hit.update(range(j, j + k))
                        named.add(item)
        names = ",".join(sorted(str(x) for x in named - {None}))
        sha = hashlib.sha256(names.encode()).hexdigest()
        out.append((doc_id, len(have), len(hit), len(named - {None}), sha, bool(hit)))
    return sorted(out, key=str)


def case(seed):
    pick = random.Random(seed)
    vocabulary = ["a", "B", "c0", "É", "ß中", "the", "Of"]
    text = lambda n: "".join(pick.choice(vocabulary) + pick.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(pick.choice([0, 1, 2, 5, 9, 10, 11, 14, 30]))) for i in range(8)]
    items += [(None, text(12)), (99, None), (3, text(11)), (0, items[0][1])]
    docs = [(i, text(pick.choice([0, 1, 4, 10, 40, 200]))) for i in range(30)]
    docs += [(100 + i, text(7) + x[1] + text(5)) for i, x in enumerate(items) if x[1]]
    docs += [(None, "x"), (7, None), (8, ""), docs[12], docs[12]]
    return docs, items


def run(spark, docs, items, **options):
    ready(spark)
    left = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, found string")
    right = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_words int")
    got = dec.contamination(left, right, **options).drop("starts", "ends").collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs, items = case(seed)
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("window", [1, 3])
def test_other_windows_and_blocks(spark, window):
    docs, items = case(7)
    assert run(spark, docs, items, window=window, block_bytes=60) == brute(docs, items, window)


def test_places_and_buckets_that_are_shared(monkeypatch):
    """Whatever blocks and windows share by their hashes, words decide."""
    monkeypatch.setattr(dec, "hash", lambda x: len(x) % 2, raising=False)
    for seed in range(3):
        docs, items = case(seed)
        matcher = dec.Matcher([(i, None if t is None else t.encode()) for i, t in items], 10)
        for doc, want in zip(sorted(docs, key=str), sorted(docs, key=str), strict=True):
            ranges, named = matcher.find(dec.words_of((doc[1] or "").encode()))
            ((_, _, hit, n_items, _, _),) = brute([want], items)
            assert (sum(b - a for a, b in ranges), len(named)) == (hit, n_items)


def test_memory_of_a_block():
    """A quarter of a full block of random words; a full one takes four times that."""
    pick, letters = random.Random(5), string.ascii_lowercase
    word = lambda: "".join(pick.choices(letters, k=pick.randint(3, 8)))
    items = [(i, " ".join(word() for _ in range(320)).encode()) for i in range(1000)]
    assert sum(len(t) for _, t in items) > dec.BLOCK_BYTES // 5
    tracemalloc.start()
    matcher = dec.Matcher(items, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 40 << 20 and peak < 75 << 20
    assert matcher.find(dec.words_of(items[7][1]))[1] == {7}


def test_a_very_long_text(spark):
    docs, items = case(3)
    long = "q " * 300_000 + items[6][1] + " q" * 300_000
    ready(spark)
    left = spark.createDataFrame([(1, long)], "doc_id long, text string")
    right = spark.createDataFrame([(6, items[6][1])], "item_id long, text string")
    (got,) = dec.contamination(left, right).collect()
    assert got.n_hit == len(words(items[6][1])) and got.n_words == 600_000 + got.n_hit


def test_empty_tables(spark):
    docs, items = case(1)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_drop_keeps_columns(spark):
    docs, items = case(2)
    frame = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, found string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = dec.drop_contaminated(frame, right)
    assert got.columns == frame.columns
    clean = [r[0] for r in brute(docs, items) if not r[5]]
    assert sorted(map(str, clean)) == sorted(str(r.doc_id) for r in got.collect())
