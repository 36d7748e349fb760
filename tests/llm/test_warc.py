from collections import Counter

import numpy as np
import pytest

from loadstar.llm import warc as K


def page_rows():
    """Pages whose payloads hold whole records, half magic strings and copies of each other."""
    fake = K.record(99, "u", b"fake", None).decode()
    rows = []
    for i in range(150):
        html = "x" * (i * 37 % 900) + (fake if i % 3 == 0 else "") + ("WARC/1.0\r\n" if i % 2 else "") + str(i % 40)
        rows.append((i, None if i == 5 else f"http://x/{i}\r\nWARC-Type: y é", None if i % 7 == 0 else html))
    rows += [(None, "n", "dup"), (7000, "n", "dup"), (7000, "n", "dup"), (None, "q", "y" * 50_000), (300, "", "")]
    return rows


def expected(rows, min_bytes=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = Counter()
    for payload, ids in groups.items():
        kept = max((i for i in ids if i is not None), default=None) if len(payload) >= min_bytes else None
        for i in ids:
            again = kept is not None and (i is None or i < kept)
            out[(i, len(payload), K.digest(payload), "revisit" if again else "response", kept if again else None)] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "c", 1) for r in page_rows()]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, kept int").repartition(2)


# 64 bytes: nearly every record spans several slices.
@pytest.mark.parametrize("slice_bytes", [64, 1000, 1 << 20])
def test_round_trip_in_slices(pages, slice_bytes):
    folder, manifest = K.write_warc(pages, file_bytes=40_000 if slice_bytes > 64 else 3000)
    if slice_bytes == 64:
        manifest = manifest.orderBy("path").limit(3).cache()
    got = K.read_warc(folder, manifest, slice_bytes=slice_bytes).collect()
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    if slice_bytes == 64:
        assert sum(found.values()) == sum(r.n_records for r in manifest.collect()) and not found - expected(page_rows())
    else:
        assert found == expected(page_rows())


def test_small_payloads_are_not_revisited(pages):
    folder, manifest = K.write_warc(pages, min_bytes=100)
    got = K.read_warc(folder, manifest).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(page_rows(), 100)


def test_exits_follow_chains():
    offset, successor = np.array([0, 10, 14, 30]), np.array([10, 30, 15, 70])
    assert K.exits(offset, successor, 64).tolist() == [70, 70, -1, 70]
    assert K.exits(np.zeros(0, np.int64), np.zeros(0, np.int64), 64).tolist() == []


def test_empty_table(pages):
    folder, manifest = K.write_warc(pages.limit(0))
    assert K.read_warc(folder, manifest).count() == 0


def read(rows, spark, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder, manifest = K.write_warc(pages)
    return folder, manifest, K.read_warc(folder, manifest, **options)


@pytest.mark.parametrize("length", ["99999999999999999999", "9223372036854775807", "0" * 30 + "5"])
def test_payloads_that_claim_any_length(spark, length):
    rows = [(1, "a", f"x\r\nWARC/1.0\r\nContent-Length: {length}\r\n\r\nrest"), (2, "b", "plain")]
    got = read(rows, spark)[2].collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


def test_headers_of_any_length(spark):
    rows = [(1, "a", "one"), (2, "http://x/" + "u" * (2 << 20), "two"), (3, "c", "three"), (4, "d", "WARC/1.0\r\n" + "y" * (3 << 20))]
    for slice_bytes in (5000, K.SLICE_BYTES):
        got = read(rows, spark, slice_bytes=slice_bytes)[2].collect()
        assert {(r.page_id, r.payload_bytes, len(r.url)) for r in got} == {(i, len(h), len(u)) for i, u, h in rows}


def test_lost_records_are_noticed(spark):
    import pyarrow.fs

    folder, manifest, _ = read([(i, "u", "text " * i) for i in range(50)], spark)
    path = manifest.first().path
    fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
    with fs.open_input_file(path) as f:
        data = f.read()
    at = data.index(b"Content-Length", len(data) // 2)  # a record of the middle gets another length
    with fs.open_output_stream(path) as f:
        f.write(data[:at] + b"Content-Lengxx" + data[at + 14 :])
    with pytest.raises(ValueError, match="missing or damaged"):
        K.read_warc(folder, manifest)


def test_slices_are_read_in_as_many_tasks(spark):
    _, _, got = read([(i, "u", f"{i} " * 500) for i in range(60)], spark, slice_bytes=4096)
    tasks = got.groupBy(K.F.spark_partition_id()).count().count()
    assert tasks > 8
