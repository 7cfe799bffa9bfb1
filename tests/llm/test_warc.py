"""Archives: exact round trip, splits at any byte, chance magics, damage, odd rows."""

import glob
import gzip
import hashlib
import os

import pytest

from docfold.llm import warc
from docfold.llm.common import ready

MAGICAL = b"\x1f\x8b\x08\x00words " * 3
SCHEMA = "page_id long, url string, html string, record string"


def pages(spark, rows):
    return ready(spark).createDataFrame(rows, SCHEMA)


def by_id(frame):
    return sorted((r.asDict() for r in frame.collect()), key=lambda r: str(r))


@pytest.fixture
def split(spark):
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def brute(rows, least):
    """Type and target of each row, by comparing payloads."""
    out = []
    for page_id, _, html, _ in rows:
        same = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        size = len((html or "").encode())
        top = max(same) if size >= least and same else page_id
        copies = sum((h or "") == (html or "") for _, _, h, _ in rows)
        revisit = copies > 1 and size >= least and top != page_id
        out.append((page_id, "revisit" if revisit else "response", top if revisit else None,
                    size, hashlib.sha1((html or "").encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    rows = frame.selectExpr(
        "try_cast(regexp_extract(record_id, 'page:(\\\\d+)', 1) as long) page_id", "record_type",
        "try_cast(regexp_extract(refers_to, 'page:(\\\\d+)', 1) as long) refers_to",
        "payload_bytes", "payload_digest", "intact",
    ).collect()
    assert all(r.intact for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


ROWS = [
    (1, "http://a/x y\n", "é" * 600, "clash"),
    (2, None, "é" * 600, None),
    (9, "http://b", "é" * 600, None),
    (3, "http://c", None, None),
    (4, "http://c", "", None),
    (5, "http://c", "short", None),
    (6, "http://c", "short", None),
    (None, "http://d", "z" * 5000, None),
    (7, "http://d", "z" * 5000, None),
    (7, "http://d", "z" * 5000, None),
    (8, "http://e", "WARC/1.0\r\n\r\n\x1f\x8b\x08" * 2000, None),
]


@pytest.mark.parametrize("size", [64, 301, 4096, 1 << 24])
@pytest.mark.parametrize("level", [0, 6])
def test_round_trip_over_splits(spark, split, tmp_path, size, level):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, ROWS).repartition(2), folder, level=level)
    split(size)
    assert result(warc.read(spark, folder)) == brute(ROWS, 1000)


@pytest.mark.parametrize("size", [64, 4096, 1 << 24])
@pytest.mark.parametrize("block", [64, 1 << 20])
def test_names_of_archives(spark, split, tmp_path, monkeypatch, size, block):
    """Files named ``.gz`` are read by ranges too, beside others, with odd characters in their names."""
    folder = tmp_path / "w"
    more = [(100 + i, "http://m", "m" * 50 * i, None) for i in range(9)]
    for rows, to, name in ((ROWS, folder, "a b%20+é.warc.gz"), (more, tmp_path / "v", "plain.warc")):
        warc.write(pages(spark, rows).coalesce(1), str(to))
        (part,) = (f for f in glob.glob(f"{to}/part-*") if os.path.getsize(f))
        os.rename(part, folder / name)
    (folder / "empty.warc.gz").write_bytes(b"")
    split(size)
    want = sorted(brute(ROWS, 1000) + brute(more, 1000), key=str)
    assert result(warc.read(spark, str(folder))) == want
    monkeypatch.setattr(warc, "BLOCK", block)  # here only; tasks read by whole blocks
    for start in (0, 1, 50, 700):
        held = warc._File(f"file:{folder}/a b%20+é.warc.gz")
        length = os.path.getsize(folder / "a b%20+é.warc.gz")
        cuts = list(range(0, length, max(1, start * 7))) + [length]
        whole = [r["record_id"] for r in held.records(0, length, False)]
        found = [r["record_id"] for a, b in zip(cuts, cuts[1:], strict=False) for r in held.records(a, b, False)]
        assert found == whole and whole


def test_damage_in_a_named_file(spark, split, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    digest = hashlib.sha1(b"p" * 400).hexdigest()
    data = [warc.record(i, "http://x", b"p" * 400, digest, None, warc.DATE) for i in range(5)]
    members = [warc.gzip_member(d) for d in data]
    members[1] = members[1][:-20]
    members[3] = members[3][:60] + b"\0\0\0\0" + members[3][64:]
    (folder / "a.warc.gz").write_bytes(b"junk" + b"".join(members) + b"\x1f")
    split(120)
    found = {r.record_id for r in warc.read(spark, str(folder)).collect()}
    assert found == {f"<urn:page:{i}>" for i in (0, 2, 4)}


def test_a_member_over_many_ranges(spark, split, tmp_path):
    """Chains of pieces: a record over dozens of ranges between small ones."""
    folder = tmp_path / "w"
    folder.mkdir()
    sizes = [10, 9_000, 20, 30, 7_000, 7_000, 40]
    with open(folder / "a.warc", "wb") as f:
        for i, size in enumerate(sizes):
            payload = (MAGICAL * size)[:size]
            digest = hashlib.sha1(payload).hexdigest()
            f.write(warc.gzip_member(warc.record(i, "http://x", payload, digest, None, warc.DATE), 0))
    split(200)
    rows = warc.read(spark, str(folder)).collect()
    assert sorted((int(r.record_id[10:-1]), r.payload_bytes, r.intact) for r in rows) == [
        (i, size, True) for i, size in enumerate(sizes)
    ]


@pytest.mark.parametrize("size", [50, 97, 1000, 1 << 20])
def test_magic_inside_stored_data(spark, split, tmp_path, size):
    # Level 0 stores the bytes as they are, so a gzip member as payload shows its magic inside another.
    folder = tmp_path / "w"
    folder.mkdir()
    inner = gzip.compress(b"WARC/1.0\r\nnothing") + b"\x1f\x8b\x08\x00rest" + b"\x1f\x8b\x08\xff"
    made = []
    for i in range(6):
        payload = inner * (1 + 3 * (i % 2))
        digest = hashlib.sha1(payload).hexdigest()
        made.append((i, len(payload), digest))
        data = warc.record(i, "http://x", payload, digest, None, warc.DATE)
        with open(folder / "a.warc", "ab") as f:
            f.write(warc.gzip_member(data, 0))
    split(size)
    rows = warc.read(spark, str(folder)).collect()
    assert all(r.intact for r in rows)
    got = sorted((int(r.record_id[10:-1]), r.payload_bytes, r.payload_digest) for r in rows)
    assert got == made


def test_damage_and_foreign_bytes(spark, split, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    digest = hashlib.sha1(b"p" * 400).hexdigest()
    data = [warc.record(i, "http://x", b"p" * 400, digest, None, warc.DATE) for i in range(5)]
    members = [warc.gzip_member(d) for d in data]
    members[1] = members[1][:-20]  # cut off
    members[3] = members[3][:60] + b"\0\0\0\0" + members[3][64:]  # damaged
    (folder / "a.warc").write_bytes(b"junk" + b"".join(members) + b"\x1f")
    split(120)
    found = {r.record_id for r in warc.read(spark, str(folder)).collect()}
    assert found == {f"<urn:page:{i}>" for i in (0, 2, 4)}


def test_files_are_plain_gzip(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, ROWS).coalesce(1), folder)
    (name,) = (f for f in glob.glob(f"{folder}/part-*") if os.path.getsize(f))
    data = gzip.decompress(open(name, "rb").read())
    assert data.count(b"WARC/1.0\r\nWARC-Type") == len(ROWS)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write(pages(spark, []), folder)
    assert warc.read(spark, folder).count() == 0
