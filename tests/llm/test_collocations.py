"""Collocations against a plain count, with small budgets, colliding tables and odd texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docfold.llm import collocations
from docfold.llm.common import ready

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, top=2000):
    counts, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {key: a for key, a in counts.items() if a >= 30 and len(key[1]) > 1}
    covered = Counter()
    for (lang, w), a in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, w[i : i + size]
                covered[key] = max(covered[key], a)
    out = []
    for lang in n:
        best = []
        for (own, w), a in found.items():
            if own != lang or 100 * covered[own, w] >= 80 * a:
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = counts[lang, w[:k]], counts[lang, w[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(spark, rows, **options):
    ready(spark)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    more = frame.withColumns({"leaf": F.lit(1), "n": F.lit("x"), "phrase": F.lit(None)})
    return sorted(tuple(r) for r in collocations.collocations(more, **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["de", "la", "La", "mer", "é", "東", "x'y", "a\x00b", " ", "und"] + [f"w{i}" for i in range(40)]
    fixed = ["San Jose costa rica", "new york city", "de la", "é é é é é", "w1 w2 w3 w4 w5"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "\n", "\r\n", "!", ";", ":"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(40)):
            parts += [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words), rng.choice(gaps)]
        out.append((i, "".join(parts), rng.choice(["en", "en", "en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("budget, small", [(200_000, 10_000), (40, 10_000), (40, 0)])
def test_equals_a_plain_count(spark, monkeypatch, budget, small):
    monkeypatch.setattr(collocations, "SMALL_ROWS", small)
    monkeypatch.setattr(collocations, "PART_BYTES", 500)
    monkeypatch.setattr(collocations, "PAIRS_HELD", 300)
    rows = corpus(1, 600)
    found = run(spark, rows, budget=budget)
    assert found == brute(rows) and len(found) > 30


def test_full_bit_tables_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TABLE_BITS", 64)
    rows = corpus(2, 300)
    assert run(spark, rows) == brute(rows) != []


def test_top_and_ties(spark):
    rows = [(i, "a b. c d. e f. g h i", "en") for i in range(31)] + [(99, "a b", "fr")]
    assert run(spark, rows, top=3) == brute(rows, 3)
    assert [r[2] for r in run(spark, rows, top=3)] == ["a b", "c d", "e f"]


def test_one_hot_phrase_and_long_text(spark):
    rows = [(0, "de la " * 60_000, "es"), (1, "x" * 300_000 + " de la", "es"), (2, "de la mer. " * 40, "es")]
    assert run(spark, rows, budget=16) == brute(rows)


def test_odd_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, "en"), (2, "", None), (3, " \t.,", "en")]) == []
    rows = [(None, "One two", None)] * 30 + [(1, "one\ntwo", "und")] * 3
    assert run(spark, rows) == brute(rows) == [("und", 1, "one two", 30, 33, 33, 66, 909090)]


def test_subtrees_split_by_prefix_add_up():
    rows = [("en", leaf, n) for leaf, n in [("a b", 5), ("a b c d", 20), ("a b c e", 11), ("a c", 2), ("b c", 40)]]
    lang, leaf, n = zip(*rows, strict=True)
    cut = [3, 4, 4, 2, 1]
    group = pa.table({"lang": lang, "leaf": leaf, "n": n, "cut": np.array(cut, np.int32)})
    found = {tuple(r.values()) for r in collocations.subtrees(group).to_pylist()}
    assert ("en", "b c", 40, True) in found
    assert {r for r in found if not r[3]} == {("en", "a b c", 31, False), ("en", "a b", 36, False)}
