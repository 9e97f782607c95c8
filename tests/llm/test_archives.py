import base64
import hashlib
import io
import struct
import zipfile

import pytest

from wickline.llm import archives

PAGES = "page_id bigint, url string, html string"


def pages(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, PAGES).withColumn("page", F.lit(1)).withColumn("sha1", F.lit(2)).withColumn(
        "first", F.lit(3))


def round_trip(spark, folder, rows, **options):
    archives.write_archives(pages(spark, rows), "page_id", "url", "html", folder, **options)
    return sorted(map(tuple, archives.read_archives(spark, folder).collect()), key=str)


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(raw) >= least else None
        refers = first if first is not None and first != page else None
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


ROWS = [(5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, None, "same"), (3, "http://a/2", "same"), (1, "u\r\nX: y", ""),
        (2, "ü", None), (None, "n", "same"), (None, "n", "alone"), (7, "u", "é🙂 \r\n\r\n WARC/1.1"), (8, "u", "x" * 2_000_000)]


@pytest.mark.parametrize("least", [0, 3, 100])
def test_round_trip(spark, tmp_path, least):
    assert round_trip(spark, str(tmp_path / "a"), ROWS, least_bytes=least) == expected(ROWS, least)


def test_many_archives(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", f"page {i % 40} " * 50) for i in range(400)]
    folder = tmp_path / "a"
    # the size is read in the workers, so the pages are packed here as a task does it
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 2000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]),
        pa.array([hashlib.sha1(r[2].encode()).hexdigest() for r in rows]), pa.array([None] * 400, pa.int64())],
        names=["page", "url", "html", "sha1", "refers"])
    folder.mkdir()
    packed = [b.column(0)[0].as_py() for b in archives._archives(iter([batch]))]
    assert len(packed) > 5
    for i, content in enumerate(packed):
        (folder / f"{i}.zip").write_bytes(content + b"\n")
    got = archives.read_archives(spark, str(folder)).collect()
    assert sorted(r.page_id for r in got) == list(range(400))


def test_files_are_plain_archives(spark, tmp_path):
    round_trip(spark, str(tmp_path / "a"), ROWS)
    files = [p for p in (tmp_path / "a").glob("part-*") if p.stat().st_size]
    names = set()
    for path in files:
        with zipfile.ZipFile(path) as packed:
            assert packed.testzip() is None and packed.comment == b"\n"
            names |= set(packed.namelist())
            assert all(i.compress_type == zipfile.ZIP_STORED for i in packed.infolist())
    assert files and names == {archives.RECORDS, archives.INDEX}


def test_empty(spark, tmp_path):
    assert round_trip(spark, str(tmp_path / "a"), []) == []


def packed(members, comment=b"", **zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, content, method in members:
            z.writestr(zipfile.ZipInfo(name), content, compress_type=method)
        z.comment = comment
    return out.getvalue()


MEMBERS = [("a", b"PK\x05\x06 not the end" * 3, zipfile.ZIP_STORED), ("b", b"squeezed" * 99, zipfile.ZIP_DEFLATED),
           ("dir/ü", b"\x00" * 1000, zipfile.ZIP_STORED)]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"\n", b"PK\x05\x06" + b"c" * 300])
def test_members(tmp_path, monkeypatch, wide, comment):
    if wide:  # the writer then uses ZIP64 fields, entries and end record for every size
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = packed(MEMBERS, comment)
    assert (archives.END64_SIGNATURE in raw) == wide
    path = tmp_path / "x.zip"
    path.write_bytes(raw)
    for source in (archives.BytesRanges(raw), archives.FileRanges(str(path))):
        found = archives.members(source)
        assert set(found) == {"a", "dir/ü"}  # compressed members are not ranges of an archive
        for name, content, method in MEMBERS:
            if method == zipfile.ZIP_STORED:
                assert source.read(found[name].offset, found[name].size) == content
        source.close()


def test_broken():
    with pytest.raises(ValueError):
        archives.members(archives.BytesRanges(b"no archive"))
    raw = bytearray(packed(MEMBERS))
    at = raw.rfind(archives.END_SIGNATURE)
    struct.pack_into("<L", raw, at + 16, 3)
    with pytest.raises(ValueError):
        archives.members(archives.BytesRanges(bytes(raw)))


def test_changed_payload_is_noticed():
    archive = archives._Archive()
    archive.add(1, archives._record(1, None, b"payload", "A" * 32, None))
    with pytest.raises(ValueError):
        list(archives.records(archives.BytesRanges(archive.content() + b"\n")))
