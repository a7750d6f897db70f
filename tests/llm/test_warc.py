import gzip
import hashlib
import os

from duologue.llm import warc

COLUMNS = "page_id long, url string, html string, key string, digest string, shard int"


def pages(spark, tables):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in tables], COLUMNS)


ROWS = [
    (5, "http://a/1", "same " * 40),
    (3, "http://a/2", "same " * 40),
    (9, "http://a/3\r\nX: y", "same " * 40),
    (9, "http://a/3", "same " * 40),
    (3, "http://a/2", "same " * 40),
    (7, None, "short"),
    (8, "", "short"),
    (1, "http://é/", None),
    (2, "http://b", ""),
    (None, "http://c", "same " * 40),
    (4, "http://d", "é" * 49 + "z"),
    (6, "http://d", "é" * 49 + "z"),
    (10, "http://d", "é" * 50),
    (11, "http://d", "é" * 50),
    (12, "http://big", "big\r\n\r\n" * 300_000),
]


def expected(table):
    first = {}
    for i, _, html in table:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    out, seen = [], set()
    for i, _, html in table:
        data = (html or "").encode()
        again = i is not None and len(data) >= 100 and (i > first[data] or (i, data) in seen)
        seen.add((i, data))
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "out")
    manifest = warc.write(pages(spark, ROWS), folder, shard_bytes=3000, roll_bytes=400)
    got = warc.read(spark, folder, payload=True).collect()
    assert sorted(((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(ROWS)
    data = {(r.key, r.url): bytes(r.payload) for r in got if r.record_type == "response"}
    assert data[12, "http://big"] == ROWS[-1][2].encode() and data[7, None] == b"short"
    assert {r.url for r in got if r.key == 9} == {"http://a/3", "http://a/3%0D%0AX:%20y"}
    listed = {r.file: r for r in manifest.collect()}
    on_disk = {f for f in os.listdir(folder) if f.endswith(".warc.gz")}
    assert on_disk == set(listed) and len({r.shard for r in listed.values()}) > 1 and max(r.number for r in listed.values()) > 0
    assert not os.path.exists(f"{folder}/_temporary")
    for name, r in listed.items():
        raw = open(f"{folder}/{name}", "rb").read()
        assert len(raw) == r.bytes and hashlib.sha256(raw).hexdigest() == r.sha256
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    ranges = sorted((r.shard, r.number, r.first_key or -1, r.last_key or -1) for r in listed.values())
    assert all(a[3] <= b[2] for a, b in zip(ranges, ranges[1:], strict=False))


def test_files_depend_on_the_rows_alone(spark, tmp_path):
    digests = []
    for n in (1, 7):
        warc.write(pages(spark, ROWS).repartition(n), str(tmp_path / f"o{n}"), shard_bytes=2000)
        digests.append(sorted((r.file, r.sha256) for r in warc.manifest_of(spark, str(tmp_path / f"o{n}")).collect()))
    assert digests[0] == digests[1] and len(digests[0]) > 1


def test_empty_and_unlisted_files(spark, tmp_path):
    folder = str(tmp_path / "none")
    assert warc.write(pages(spark, []), folder).count() == 0 and warc.read(spark, folder).count() == 0
    folder = str(tmp_path / "some")
    warc.write(pages(spark, ROWS[:3]), folder)
    open(f"{folder}/shard-99999-00000.warc.gz", "wb").write(b"left by a failed run")
    assert warc.read(spark, folder).count() == 3
