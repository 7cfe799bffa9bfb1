"""The pipeline against its stages done by plain code on a small corpus, and its promises stage by stage."""

import os
import re
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from test_decontamination import brute as contamination
from test_packing import check_places, reference_ids
from test_simhash import brute as near_duplicates
from tokenizers import Tokenizer

import corpus_pipeline
from docfold.llm import quality, secrets

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, row int"


def write(spark, folder, docs, labels, items):
    tables = {
        "documents": spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 1) for i, t in docs], COLUMNS),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def brute(docs, labels, items):
    """The rows of the last stage without their places."""
    model = plain_model(docs, labels)
    docs = [(i, t) for i, t in docs if model(t) >= 0.3]
    groups = defaultdict(list)
    for i, t in docs:
        groups[next(c for d, _, c in near_duplicates(docs) if d == i)].append((i, t))
    docs = [(i, t) for c, rows in groups.items() for i, t in rows if i == c]
    bad = {r[0] for r in contamination(docs, items) if r[5]}
    out = []
    for i, t in docs:
        if i in bad:
            continue
        spans = [s for s in secrets.find(t, secrets.Novelty()) if s]
        hidden = {p for _, a, b in spans for p in range(a, b)}
        t = "".join("*" if p in hidden else c for p, c in enumerate(t or ""))
        ids = reference_ids(t)
        first = (len(ids) - 1) % 1024 + 1
        starts = [0, *range(first, len(ids), 1024)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            crc = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
            out.append((i, piece, a, b - a, crc))
    return sorted(out)


def plain_model(docs, labels):
    from test_quality import brute_scores

    scores = brute_scores(docs, labels)
    by_text = {t: scores[i] for i, t in docs}
    return by_text.__getitem__


def corpus():
    docs, labels = [], []
    for i in range(90):
        good = i % 4 > 0
        body = [f"w{(i * j + j * j) % 97}x{j % 7}" for j in range(20 + 5 * i)] if good else ["SPAM!!", "$$$"] * (9 + i)
        docs.append((i, " ".join(body)))
        labels.append((i, int(good)))
    docs.append((200, docs[5][1]))
    docs.append((201, docs[6][1].upper()))
    items = [(1, " ".join(f"bench{k}" for k in range(14))), (2, None), (3, "")]
    docs.append((202, docs[7][1] + " " + items[0][1] + " tail"))
    docs.append((203, docs[9][1][:300] + " token=abcdefghij0123456789 " + docs[11][1][:200]))
    return docs, labels, items


def test_equals_brute_force(spark, tmp_path):
    docs, labels, items = corpus()
    folder = write(spark, tmp_path, docs, [(*y, 0) for y in labels], items)
    rows = corpus_pipeline.run(spark, folder).collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == brute(docs, labels, items)
    check_places(rows, 1024)
    # The ids themselves are there, and read as the texts that the stages have left.
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id] += struct.unpack(f"<{r.length}I", r.ids)
    kept = {i: t for i, t in docs if i in pieces and "token=" not in t}
    assert len(kept) > 30
    for i, text in kept.items():
        assert pieces[i][-1] == 2 and tokens.decode(pieces[i][:-1], skip_special_tokens=False) == text


def test_odd_tables(spark, tmp_path):
    docs, labels, items = corpus()
    docs += [(300, None), (301, ""), (302, " "), (None, "no id at all here"), (5, docs[5][1]), (303, "word " * 60_000)]
    folder = write(spark, tmp_path / "a", docs, [(*y, 0) for y in labels], items)
    assert corpus_pipeline.run(spark, folder).count() > 0
    folder = write(spark, tmp_path / "b", [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        if name != "packing":
            assert after.columns == docs.columns
            assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs, before = after, docs
    assert not any(re.search("[0-9a-f]{16}", r.text) for r in before.collect())
