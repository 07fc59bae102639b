"""Archives: written, opened by other tools, read back and looked up."""

from __future__ import annotations

from hashlib import sha256
from pathlib import Path

import pyarrow as pa
import pytest
import zstandard
from fixtures import rows

from eventlake.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, first string, bundle int"
LONG = "ab" * 60


def table(spark, pages):
    return spark.createDataFrame([(*page, "x", "y", 1) for page in pages], SCHEMA)


def plain(pages, least=100):
    """The contract by a loop over the table."""
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    found = []
    for page, _, html in pages:
        data, of = (html or "").encode(), first.get(html or "")
        again = len(data) >= least and of is not None and (page is None or page > of)
        found.append((page, len(data), sha256(data).hexdigest(), "revisit" if again else "response", of if again else None))
    return found


def ordered(found):
    return sorted(found, key=str)


PAGES = [
    (1, "http://a/", "short"),
    (2, "http://b/", "short"),
    (3, None, None),
    (4, "http://c/\r\nEvil: x y", ""),
    (5, "http://d/ü", LONG),
    (6, "http://e/", LONG),
    (9, "http://e/", LONG),
    (7, "http://f/", "\r\n\r\nWARC/1.1\r\n\r\n" * 50),
    (8, "http://g/", "日本語 😀 " * 20),
    (10, "http://g/", "日本語 😀 " * 20),
    (5, "http://d/ü", LONG),
    (None, "http://h/", LONG),
    (None, "http://i/", "no key " * 20),
    (None, "http://i/", "no key " * 20),
    (11, "http://j/", "x" * 99),
    (12, "http://j/", "x" * 99),
    (13, "http://k/", "ü" * 50),
    (14, "http://k/", "ü" * 50),
    (15, "http://l/", "long " * 700_000),
]


def test_pages_come_back(spark, monkeypatch):
    for sizes in ((1 << 20, 64 << 20), (500, 4000)):
        monkeypatch.setattr(warc, "FRAME_BYTES", sizes[0])
        monkeypatch.setattr(warc, "BUNDLE_BYTES", sizes[1])
        for parts in (1, 4):
            found = warc.round_trip(spark, table(spark, PAGES).repartition(parts)).drop("record_id")
            assert ordered(rows(found)) == ordered(plain(PAGES))


def test_many_copies_and_an_empty_table(spark):
    pages = [(i, f"http://x/{i}", LONG if i % 3 else f"{i} " * 40) for i in range(3000)]
    found = warc.round_trip(spark, table(spark, pages)).drop("record_id")
    assert ordered(rows(found)) == ordered(plain(pages))
    empty = warc.round_trip(spark, table(spark, []))
    assert rows(empty) == [] and empty.columns[0] == "page_id"


def test_copies_joined_without_broadcast(spark):
    pages = [(i, "u", f"{i % 7} " * 60) for i in range(200)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = rows(warc.round_trip(spark, table(spark, pages)).drop("record_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ordered(found) == ordered(plain(pages))


@pytest.fixture
def archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    folder = str(tmp_path / "archive")
    index = warc.write(table(spark, PAGES).repartition(2), folder, date="2024-01-01T00:00:00Z")
    return folder, index


def test_files_are_plain_zstandard_and_warc(archive):
    """Any reader gets one stream of records, the seek table being a frame that readers skip."""
    folder, index = archive
    seen = []
    names = {row["bundle"] for row in index.collect()}
    assert {p.name for p in Path(folder).glob("*.zst")} == names
    for name in names:
        packed = Path(folder, name).read_bytes()
        data = b"".join(zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True).read(1 << 30) for _ in [0])
        found = list(warc.records(data))
        assert found[0][0]["WARC-Type"] == "warcinfo" and found[0][0]["WARC-Filename"] == name
        seen += [fields for fields, _ in found[1:]]
        assert all(set(f) >= {"WARC-Record-ID", "WARC-Date", "Content-Length"} for f, _ in found)
    assert len(seen) == len(PAGES)
    assert all("Evil" not in fields for fields in seen)
    assert {f.get("WARC-Target-URI") for f in seen} >= {None, "http://c/%0D%0AEvil:%20x%20y", "http://d/ü"}


def test_frames_stand_alone(archive):
    """Each frame opens without the others; the index names frame and offset of every record."""
    folder, index = archive
    found = index.collect()
    for name in {row["bundle"] for row in found}:
        with pa.OSFile(f"{folder}/{name}") as file:
            table = warc.seek_table(file, file.size())
            for row in (r for r in found if r["bundle"] == name):
                data = warc.read_frame(file, *table[row["frame"]])
                cut = data[row["offset"] : row["offset"] + row["length"]]
                [(fields, _)] = warc.records(cut)
                assert fields["WARC-Record-ID"] == f"<urn:uuid:{row['record_id']}>"


def test_lookup_and_what_a_revisit_refers_to(spark, archive):
    folder, index = archive
    digest = sha256(LONG.encode()).hexdigest()
    wanted = spark.createDataFrame([(warc.record_id(p, digest),) for p in (5, 9, 9, 777)], "record_id string")
    found = {row["page_id"]: row for row in warc.lookup(index, folder, wanted).collect()}
    assert set(found) == {5, 9}
    assert bytes(found[5]["payload"]) == LONG.encode() and found[9]["payload"] is None
    assert warc.record_id(found[9]["refers_to"], found[9]["payload_digest"]) == found[5]["record_id"]


def test_damage_is_noticed(spark, archive):
    folder, index = archive
    name = index.first()["bundle"]
    path = Path(folder, name)
    data = bytearray(path.read_bytes())
    with pa.OSFile(str(path)) as file:
        start, packed, *_ = warc.seek_table(file, file.size())[-1]
    data[start + packed // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    with pytest.raises(Exception):
        warc.read(index, folder).collect()
    path.write_bytes(bytes(data[:-1]))
    with pytest.raises(Exception, match="seek table"):
        warc.read(index, folder).collect()


def test_files_that_a_lost_attempt_left_are_not_read(archive):
    folder, index = archive
    Path(folder, "pages-0.warc.zst").write_bytes(b"half a file")
    assert warc.read(index, folder).count() == len(PAGES)
