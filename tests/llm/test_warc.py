import hashlib

from docrecords.llm.warc import read_archive, write_archive


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def archive(spark, tmp_path, rows, name="a", **options):
    root = str(tmp_path / name)
    manifest = write_archive(pages(spark, rows), root, **options)
    return root, manifest, read_archive(manifest, root, with_payload=True).collect()


def test_revisits_nulls_and_repeats(spark, tmp_path):
    long, other = "é" * 600, "b" * 2000
    rows = [
        (1, "http://a/1", long, "x"), (7, "http://a/7", long, None), (3, None, long, None), (None, "http://a/n", long, None),
        (4, "http://a/\n4", "short", None), (5, "http://a/5", "short", None), (6, "", None, None),
        (8, "u", other, None), (8, "u", other, None),
    ]
    _, _, got = archive(spark, tmp_path, rows)
    digest = hashlib.sha1(long.encode()).hexdigest()
    found = sorted(((r.record_key, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr)
    assert found == sorted(
        [
            ("1", "revisit", "7", 1200), ("7", "response", None, 1200), ("3", "revisit", "7", 1200), (None, "revisit", "7", 1200),
            ("4", "response", None, 5), ("5", "response", None, 5), ("6", "response", None, 0),
            ("8", "response", None, 2000), ("8", "revisit", "8", 2000),
        ],
        key=repr,
    )
    assert {r.payload_digest for r in got if r.payload_bytes == 1200} == {digest}
    assert {r.record_key: r.uri for r in got}["4"] == "http://a/\n4"
    assert {r.record_key: r.uri for r in got}["3"] is None
    assert [r.payload.decode() for r in got if r.record_key == "7"] == [long]


def test_files_roll_by_size_and_are_the_same_each_time(spark, tmp_path):
    rows = [(i, f"u{i}", hashlib.sha512(str(i).encode()).hexdigest() * 20, None) for i in range(300)]
    options = {"shard_bytes": 200_000, "file_bytes": 20_000}
    _, first, got = archive(spark, tmp_path, rows, **options)
    _, second, _ = archive(spark, tmp_path, rows[::-1], "b", **options)
    key = lambda m: sorted((r.file, r.sha1, r.bytes, r.records) for r in m.collect())
    assert key(first) == key(second) and len(key(first)) > 4
    assert sorted(int(r.record_key) for r in got) == list(range(300))
    assert not (tmp_path / "a" / "_temporary").exists()


def test_empty_table(spark, tmp_path):
    _, manifest, got = archive(spark, tmp_path, [])
    assert manifest.count() == 0 and got == []
