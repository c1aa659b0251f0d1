from __future__ import annotations

import gzip
import hashlib

import pytest

from flowcubes.llm import warc as W
from flowcubes.llm.common import prepare


def archive(n=6, packed=True):
    parts = [W.record(i, f"http://x/{i}", f"<p>page {i}</p>".encode() * 40, None, False) for i in range(n)]
    return [gzip.compress(p, mtime=0) for p in parts] if packed else parts


def ids(raw):
    found = list(W.salvage(raw))
    assert [0, *(f.end for f in found)] == [*(f.start for f in found), len(raw)]
    return [W._page(f.fields["warc-record-id"]) for f in found if f.fields], [(f.start, f.end) for f in found if not f.fields]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archives_have_no_gaps(packed):
    assert ids(b"".join(archive(packed=packed))) == (list(range(6)), [])
    assert ids(b"") == ([], [])


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "junk", "zero", "tail", "head"])
def test_damage_costs_only_the_damaged_records(packed, harm):
    parts = archive(packed=packed)
    start = sum(map(len, parts[:2]))
    raw = bytearray(b"".join(parts))
    lost = {2}
    if harm == "flip":
        raw[start + len(parts[2]) // 2] ^= 0xFF
    elif harm == "cut":
        del raw[start + 20:start + len(parts[2]) - 5]
    elif harm == "junk":
        raw[start:start] = b"\x1f\x8b\x08junk WARC/1.1\r\nnot a record"
        lost = set()
    elif harm == "zero":
        raw[start:start + 30] = bytes(30)
    elif harm == "tail":
        del raw[-7:]
        lost = {5}
    else:
        del raw[:9]
        lost = {0}
    got, gaps = ids(bytes(raw))
    assert got == [i for i in range(6) if i not in lost]
    assert len(gaps) == 1
    if harm == "junk":
        assert gaps == [(start, start + 30)] or gaps[0][0] == start


def test_wrong_length_and_digest_are_found():
    parts = archive(packed=False)
    parts[1] = parts[1].replace(b"page 1", b"pagX 1", 1)
    parts[3] = parts[3].replace(b"Content-Length: 6", b"Content-Length: 9")
    assert ids(b"".join(parts))[0] == [0, 2, 4, 5]


def test_plain_records_after_a_damaged_line_are_read_beside_stored_gzip():
    parts = archive(packed=False)
    parts[1] = W.record(1, "http://x/1", b"<p>" + gzip.compress(b"a stored file" * 50, mtime=0), None, False)
    parts[0] = b"WXRC" + parts[0][4:]
    got, gaps = ids(b"".join(parts))
    assert got == [1, 2, 3, 4, 5] and gaps == [(0, len(parts[0]))]
    # the stored file lies in the damaged record itself
    parts = archive(packed=False)
    parts[0] = b"WXRC" + W.record(0, "http://x/0", b"<p>" + gzip.compress(b"a stored file" * 50, mtime=0), None, False)[4:]
    got, gaps = ids(b"".join(parts))
    assert got == [1, 2, 3, 4, 5] and gaps == [(0, len(parts[0]))]


def test_members_with_several_records_and_mixed_files():
    parts, plain = archive(), archive(packed=False)
    both = gzip.compress(plain[2] + plain[3], mtime=0)
    raw = parts[0] + plain[1] + both + plain[4] + parts[5]
    found = list(W.salvage(raw))
    assert [W._page(f.fields["warc-record-id"]) for f in found] == [0, 1, 2, 3, 4, 5]
    at = len(parts[0] + plain[1])
    assert [(f.start, f.end, f.inner) for f in found[2:4]] == [(at, at + len(both), 0), (at, at + len(both), len(plain[2]))]
    harmed = bytearray(raw)
    harmed[10] ^= 0xFF  # the member before plain records
    found = list(W.salvage(bytes(harmed)))
    assert [W._page(f.fields["warc-record-id"]) for f in found if f.fields] == [1, 2, 3, 4, 5]
    assert [(f.start, f.end) for f in found if f.reason] == [(0, len(parts[0]))]


def test_a_damaged_record_within_a_member_and_a_member_cut_short():
    plain = archive(packed=False)
    bad = plain[1].replace(b"page 1", b"pagX 1", 1)
    found = list(W.salvage(gzip.compress(plain[0] + bad + plain[2], mtime=0) + archive()[3]))
    assert [W._page(f.fields["warc-record-id"]) for f in found if f.fields] == [0, 2, 3]
    assert [(f.inner, f.reason) for f in found if f.reason] == [(len(plain[0]), "block digest differs")]
    found = list(W.salvage(gzip.compress(b"".join(plain), mtime=0)[:-7]))
    assert [W._page(f.fields["warc-record-id"]) for f in found if f.fields] == [0, 1, 2, 3, 4]
    assert [f.reason for f in found if f.reason] == ["member cut short"]


def test_batches_of_bounded_payload(spark, tmp_path):
    files = W.write(W.marked(frame(spark, PAGES)), str(tmp_path))
    assert W.read(files, str(tmp_path), whole=True, most=1000).count() == len(PAGES)


def test_a_folder_without_scheme_is_on_the_default_file_system(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://names:8020")
        assert W._shared(spark, "/shared/x") == "hdfs://names:8020/shared/x"
        assert W._shared(spark, "file:/tmp/x") == "file:/tmp/x"
    finally:
        conf.set("fs.defaultFS", before)
    assert W._shared(spark, "/shared/x") == "/shared/x"


PAGES = [(1, "http://a", "x" * 1500), (2, "http://b", "x" * 1500), (3, None, "short"), (4, "http://d\r\nx", "short"), (5, "u", None), (6, "u", ""), (9, "u", "é" * 500), (8, "u", "é" * 500), (8, "u", "é" * 500),
         (None, "u", "é" * 500), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "é😀" * 300_000), (None, "v", "z" * 2000), (None, "v", "z" * 2000)]


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS largest").checkpoint()


def test_round_trip(spark, tmp_path):
    got = sorted(map(tuple, W.round_trip(frame(spark, PAGES)).collect()), key=str)
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        top = max(same, default=None)
        again = len(raw) >= 1000 and top is not None and i != top
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    assert got == sorted(want, key=str)
    assert W.round_trip(frame(spark, PAGES[:1]).limit(0)).count() == 0


def test_reader_logs_gaps_of_damaged_files(spark, tmp_path):
    folder = str(tmp_path / "warc")
    files = W.write(W.marked(frame(spark, PAGES)), folder, roll=500)
    assert files.agg({"records": "sum"}).first()[0] == len(PAGES)
    path = sorted(r.path for r in files.collect())[0]
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 0x55
    open(path, "wb").write(raw)
    rows = W.read(files, folder).collect()
    gaps = [r for r in rows if r.gap]
    assert [g.path for g in gaps] == [path] and gaps[0].end > gaps[0].start
    assert len(PAGES) - 1 <= len(rows) - len(gaps) < len(PAGES) + 1


def test_each_archive_has_a_reader_task(spark, tmp_path):
    prepare(spark)
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 400) as html").repartition(8)
    files = W.write(W.marked(pages), str(tmp_path), roll=2000)
    n = files.count()
    read = W.read(files, str(tmp_path), whole=True)
    assert n > 3 and read.count() == 40
    assert read.rdd.getNumPartitions() == n
    short = files.withColumn("records", files.records + 1)
    with pytest.raises(Exception, match="records written"):
        W.read(short, str(tmp_path), whole=True).count()
