"""Paragraph classes against all pairs, planted passages, clean documents, odd rows."""

import random

import numpy as np
import pytest

from docfold.llm import passages
from docfold.llm.common import ready

PICK = random.Random(11)
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("ten", "sol", "vir", "", "pax") for c in ("", "a", "os", "ing", "um", "é")]


def text(n, pick=PICK):
    return [pick.choice(WORDS) + (str(pick.randrange(40)) if pick.random() < 0.5 else "") for _ in range(n)]


def line(words):
    return " ".join(words)


def shingles(words, k=5):
    w = [x.lower() for x in words]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def frame(spark, docs):
    rows = [(*d, "c", 7) for d in docs]
    return ready(spark).createDataFrame(rows, "doc_id long, text string, uid string, words int")


def edited(words, times, pick=PICK):
    out = list(words)
    for _ in range(times):
        out[pick.randrange(len(out))] = pick.choice(WORDS)
    return out


def corpus():
    docs = []
    for i in range(40):
        docs.append((i, "\n".join(line(text(PICK.choice([3, 15, 25, 45, 120]))) for _ in range(5))))
    passage, near, whole = text(50), text(90), text(30)
    planted = {"passage": [], "near": [], "whole": []}
    for i in range(100, 112):  # inside a long line
        docs.append((i, line(text(2)) + "\n" + line([*text(40 + i % 7), *passage, *text(30)]) + "\nend"))
        planted["passage"].append(i)
    for i in range(200, 206):  # a paragraph with one word changed
        docs.append((i, line(text(30)) + "\n" + line(edited(near, 1)) + "\n" + line(text(21))))
        planted["near"].append(i)
    for i in range(300, 304):  # equal but for case and spaces
        docs.append((i, line(text(22)) + "\n  " + "  ".join(whole).upper() + " \n"))
        planted["whole"].append(i)
    return docs, planted


def test_planted_and_clean(spark):
    docs, planted = corpus()
    docs += [(400, None), (401, ""), (402, " \n\n "), (403, "spam " * 3000), (404, "one two\n" * 50)]
    docs += [(405, line(text(60)) + "\n" + line(text(60))), (405, docs[3][1])]
    got = {r.doc_id: r for r in passages.by_document(passages.duplicates(frame(spark, docs))).collect()}
    # Document 405 has a copy of document 3 as a second row.
    assert set(got) == {i for ids in planted.values() for i in ids} | {3, 405}
    for ids in planted.values():
        assert got[ids[0]].n_removed == 0 and got[ids[0]].keepers == []
        for i in ids[1:]:
            assert got[i].n_removed > 0 and got[i].keepers[0] in ids
    by_id = dict(docs)
    for i in planted["passage"]:
        words, want = by_id[i].lower().split(), set(corpus_words(docs, planted))
        a, b = map(int, got[i].spans.split(",")[0].split(":"))
        # A stretch that reaches one word beyond the passage is still similar enough.
        assert 16 <= b - a <= 52 and len(set(words[a:b]) - want) <= 2


def corpus_words(docs, planted):
    by_id = dict(docs)
    first, second = (by_id[i].lower().split() for i in planted["passage"][:2])
    return set(first) & set(second)


def test_classes_equal_all_pairs(spark):
    pick = random.Random(5)
    docs, lines = [], []
    for i in range(30):
        base = text(pick.choice([24, 40, 49]), pick)
        for _ in range(pick.choice([1, 2, 5])):
            own = edited(base, pick.choice([0, 0, 1]), pick)
            docs.append((len(docs), line(own)))
            lines.append(own)
    found = passages.paragraphs(frame(spark, docs).select("doc_id", "text"))
    uid = {r.doc_id: r.uid for r in found.collect()}
    linked = {(r.a, r.b) for r in passages.links(frame(spark, docs), found).collect()}
    alike = {
        tuple(sorted((uid[i], uid[j])))
        for i in range(len(docs))
        for j in range(i)
        if uid[i] != uid[j] and jaccard(lines[i], lines[j]) >= 0.8
    }
    assert linked <= alike  # every link is verified
    assert classes(linked) == classes(alike)


def classes(pairs):
    low = {n: n for p in pairs for n in p}
    for _ in low:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return low


def stretches(data):
    (block,) = passages.Paragraphs().of([data])
    return set(block["uid"][block["words"] == 16].tolist())


def test_blocks_change_nothing(monkeypatch):
    """Any block size gives the same paragraphs, and keys are those of the paragraph alone."""
    pick = random.Random(2)
    texts = ["\n".join(line(text(n, pick)) for n in (3, 20, 49, 50, 51, 130)).encode() for _ in range(12)]
    texts += [None, b"", b"spam " * 400, line(["a", "b"] * 90).encode()]
    runs = []
    for words in (1, 700, 1 << 18):
        monkeypatch.setattr(passages, "BLOCK_WORDS", words)
        rows = []
        for b in passages.Paragraphs().of(texts):
            columns = (b[c].tolist() for c in ("uid", "text", "first", "words", "keys"))
            rows += [(u, t, f, n, tuple(k)) for u, t, f, n, k in zip(*columns, strict=True)]
        runs.append(sorted(rows))
    assert runs[0] == runs[1] == runs[2]
    for uid, number, first, n, keys in runs[0]:
        own = texts[number].lower().split()[first : first + n]
        assert np.uint64(passages._name(own)).view(np.int64) == uid
        if n >= passages.LEAST_WORDS:
            (alone,) = passages.Paragraphs().of([b" ".join(own)])
            assert keys == tuple(alone["keys"][0].tolist())


def test_a_shared_passage_has_a_common_place():
    pick = random.Random(9)
    for _ in range(60):
        shared = text(48, pick)
        own = [
            stretches(line([*text(pick.randrange(9), pick), *shared, *text(20, pick)]).encode())
            for _ in range(2)
        ]
        assert own[0] & own[1]


def test_band_keys_estimate_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, (300, 80), np.uint64)
    other = both.copy()
    other[:, :9] = rng.integers(0, 1 << 63, (300, 9), np.uint64)  # Jaccard 71 / 89
    hashes = list(zip(passages._MULTIPLY, passages._ADD, strict=True))
    smallest = lambda x: np.stack([(x * m + a).min(axis=1) for m, a in hashes], axis=1)
    met = (passages.band_keys(smallest(both)) == passages.band_keys(smallest(other))).any(axis=1)
    assert met.mean() > 0.96
    far = passages.band_keys(smallest(rng.integers(0, 1 << 63, (300, 80), np.uint64)))
    assert not (passages.band_keys(smallest(both)) == far).any()


@pytest.mark.parametrize("docs", [[], [(1, None)], [(None, "x")]])
def test_nothing_shared(spark, docs):
    assert passages.by_document(passages.duplicates(frame(spark, docs))).count() == 0


def test_rows_without_id(spark):
    shared = line(text(30))
    got = passages.by_document(passages.duplicates(frame(spark, [(None, shared), (None, shared), (5, shared)])))
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[None].keepers == [5] and rows[5].n_removed == 0
    alone = frame(spark, [(None, shared), (None, shared)])
    assert passages.duplicates(alone).count() == 0


def broken(words, pick, longest):
    """The words in lines of 1 to ``longest`` words."""
    out, at = [], 0
    while at < len(words):
        n = pick.randint(1, longest)
        out.append(line(words[at : at + n]))
        at += n
    return "\n".join(out)


@pytest.mark.parametrize("longest", [6, 19, 40, 80])
def test_a_passage_across_lines_has_a_common_place(longest, monkeypatch):
    pick = random.Random(longest)
    for block in (1, 60, 1 << 18):
        monkeypatch.setattr(passages, "BLOCK_WORDS", block)
        for _ in range(30):
            shared = text(50, pick)
            own = []
            for _ in range(2):
                words = [*text(pick.randrange(70), pick), *shared, *text(pick.randrange(70), pick)]
                data = broken(words, pick, longest).encode()
                blocks = passages.Paragraphs().of([data])
                own.append({u for b in blocks for u in b["uid"][b["words"] == 16].tolist()})
            assert own[0] & own[1]


def test_passages_across_short_lines_are_found(spark):
    pick = random.Random(21)
    shared = text(60, pick)
    docs = [(i, broken([*text(25, pick), *shared, *text(25, pick)], pick, 12)) for i in range(6)]
    docs += [(50 + i, broken(text(110, pick), pick, 12)) for i in range(6)]
    got = {r.doc_id: r for r in passages.by_document(passages.duplicates(frame(spark, docs))).collect()}
    assert set(got) == set(range(6))
    assert got[0].n_removed == 0 and all(got[i].n_removed >= 16 and got[i].keepers == [0] for i in range(1, 6))


def test_boilerplate_families_equal_all_pairs(spark):
    """Bands of one long boilerplate mix many classes; all pairs that meet and are similar end together."""
    pick = random.Random(33)
    boiler, docs, lines = text(60, pick), [], []
    for _ in range(150):
        own = text(25, pick)
        for edits in (0, 1, 2):
            words = boiler + edited(own, edits, pick)
            docs.append((len(docs), line(words)))
            lines.append([w.lower() for w in words])
    given = frame(spark, docs)
    (block,) = passages.Paragraphs().of([line(x).encode() for x in lines])
    whole = block["words"] == 85
    uid, keys = block["uid"][whole].tolist(), [set(k) for k in block["keys"][whole].tolist()]
    sets = [shingles(x) for x in lines]
    meet = {
        tuple(sorted((uid[i], uid[j])))
        for i in range(len(docs))
        for j in range(i)
        if uid[i] != uid[j] and keys[i] & keys[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    }
    found = passages.paragraphs(given.select("doc_id", "text"))
    of = classes({(r.a, r.b) for r in passages.links(given, found).collect()})
    assert len(meet) > 200
    assert not [p for p in meet if p[0] not in of or of[p[0]] != of.get(p[1])]
    assert of == {r.node: r.component for r in passages.linked_classes(given, found).collect()}


def test_pairs_of_a_family_grow_with_it(spark, monkeypatch):
    """Copies with one word changed are 0.84 alike if it is the same word and 0.70 if not: nine classes, few pairs."""
    pick, written = random.Random(8), {}
    base, places = text(60, pick), range(10, 55, 5)

    def counted(data, purpose, write=passages.materialize):
        out = write(data, purpose)
        written[purpose] = out.count()
        return out

    monkeypatch.setattr(passages, "materialize", counted)
    lines = [[*base[:p], f"own{i}x{p}", *base[p + 1 :]] for i in range(40) for p in places]
    given = frame(spark, [(i, line(x)) for i, x in enumerate(lines)])
    found = passages.paragraphs(given.select("doc_id", "text"))
    rows = found.where("words = 60").join(passages.linked_classes(given, found).toDF("uid", "class"), "uid")
    of = {r.doc_id: r["class"] for r in rows.collect()}
    by_place = [{of[i + j] for i in range(0, len(lines), 9)} for j in range(9)]
    assert len(of) == 360 and all(len(c) == 1 for c in by_place) and len(set().union(*by_place)) == 9
    assert written["passages-remaining"] < 10 * len(lines)


def test_parities_bound_what_only_one_set_has():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (1, 12, 12, 700, 40)]
    sets += [np.concatenate([sets[4][:30], sets[1]]), sets[1][:11]]
    sizes = np.array([len(x) for x in sets])
    bits, order = (f(np.concatenate(sets), sizes) for f in (passages.parities, passages.orders))
    for i, a in enumerate(sets):
        assert (passages.orders(a, sizes[i : i + 1]) == order[i]).all()
        for j, b in enumerate(sets):
            differ = sum(int(x).bit_count() for x in bits[i] ^ bits[j])
            assert differ <= len(set(a.tolist()) ^ set(b.tolist()))
    assert sum(int(x).bit_count() for x in bits[1] ^ bits[2]) > 12


def test_bands_of_repeated_rows(spark, monkeypatch):
    """A paragraph that several tasks gave keys of is one in its bands; one without keys is another's copy."""
    monkeypatch.setattr(passages, "MEMORY", 3)
    seen = set()
    ids = lambda *x: passages._again(np.array(x), seen).tolist()
    assert ids(1, 1, 2) == [False, True, False] and ids(2, 3) == [True, False] and ids(3) == [False]
    rows = [(u, *(b * 10 for b in range(passages.BANDS))) for u in (4, 4, 6, 5, 5, 4)]
    rows += [(5, *[None] * passages.BANDS), (7, *(b * 10 + 1 for b in range(passages.BANDS)))]
    names = ", ".join(f"k{i} long" for i in range(passages.BANDS))
    found = ready(spark).createDataFrame(rows, f"uid long, {names}").repartition(3)
    got = sorted((r.key, r.uid, r.low, r.near, r.nth) for r in passages.bands(found).collect())
    assert got == sorted(x for b in range(passages.BANDS) for x in ((b * 10, 5, 4, 4, 2), (b * 10, 6, 4, 5, 3)))
