"""Fingerprints and classes against a comparison of all pairs."""

import random
import re

import pytest
import xxhash

from docfold.llm import simhash
from docfold.llm.common import components, ready


def fingerprint(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [w[i : i + k] for i in range(len(w) - k + 1)] or ([w] if w else [])
    hashed = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def classes(prints, distance):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def brute(docs, distance=2):
    prints = [fingerprint(t) for _, t in docs]
    roots = classes(prints, distance)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [d for (d, _), r in zip(docs, roots, strict=True) if r == roots[i] and d is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def case(seed):
    pick = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(400)] + ["É", "a b"]
    docs = []
    for _ in range(25):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([3, 40, 400]))]
        for _ in range(pick.choice([1, 2, 6])):
            changed = list(base)
            if pick.random() < 0.8:
                changed[pick.randrange(len(changed))] = pick.choice(vocabulary)
            docs.append((len(docs), pick.choice([" ", "\n", "\t "]).join(changed)))
    docs += [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one two"), (None, "one two")]
    docs += [docs[3], docs[4], (None, "lonely text without an id")]
    return docs


def frame(spark, docs):
    rows = [(*d, "c", i) for i, d in enumerate(docs)]
    return ready(spark).createDataFrame(rows, "doc_id long, text string, fp string, _row int")


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    docs = case(seed)
    got = sorted((tuple(r) for r in simhash.near_duplicates(frame(spark, docs)).collect()), key=str)
    assert got == brute(docs)


def test_chains_of_near_prints(spark):
    # Fingerprints that differ by one or two bits from the one before: one class although the ends are far.
    pick = random.Random(5)
    prints, value = [], 0
    for i in range(60):
        for bit in pick.sample(range(64), pick.choice([1, 2])):
            value ^= 1 << bit
        prints.append((i, value - (1 << 64) if value >> 63 else value))
    prints += [(100 + i, pick.getrandbits(62)) for i in range(40)]
    found = spark.createDataFrame(prints, "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(found, 2).collect()}
    values = [v % (1 << 64) for _, v in prints]
    roots = classes(values, 2)
    for (_, v), r in zip(prints, roots, strict=True):
        assert got[v] == min(d for (d, _), q in zip(prints, roots, strict=True) if q == r)


def test_keep_one(spark):
    docs = case(1)
    data = frame(spark, docs)
    kept = simhash.keep_one(data)
    assert kept.columns == data.columns
    want = {r[2] for r in brute(docs)}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, want))


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.keep_one(frame(spark, [])).count() == 0


def test_long_text_is_counted_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(100_000))
    assert simhash.fingerprint(text.encode()) == fingerprint(text)


def test_components_of_random_graphs(spark):
    pick = random.Random(3)
    pairs = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)]
    pairs += [(i, i + 1) for i in range(400, 470)] + [(500, i) for i in range(501, 560)]
    low = {n: n for p in pairs for n in p}
    for _ in range(len(low)):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    want = {n: c for n, c in low.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert {r.node: r.component for r in got.collect()} == want
