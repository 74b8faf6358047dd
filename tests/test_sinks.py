"""Sinks, scans and extraction on input the derived logbook does not show."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from quillstack.operators import extract
from quillstack.sources import archive as store
from quillstack.sources import files, ranges
from quillstack.sources.workspace import Workspace


def test_xml_replaces_what_it_cannot_hold(spark, tmp_path):
    rows = [(1, "a\x01b\x0bc\x00d\te", [("x\x02", "y")], None), (2, None, None, ("\x1fz",))]
    kind = "id long, t string, refs array<struct<_path:string,_VALUE:string>>, s struct<name:string>"
    path = str(tmp_path / "odd")
    store.write_xml(spark.createDataFrame(rows, kind), path, "rows", "row")
    back = spark.read.schema(kind).format("xml").option("rowTag", "row").load(path).orderBy("id").collect()
    assert back[0]["t"] == "a\ufffdb\ufffdc\ufffdd\te" and back[0]["refs"][0] == ("x\ufffd", "y")
    assert back[1]["t"] is None and back[1]["s"]["name"] == "\ufffdz"


def test_writing_again_replaces(spark, tmp_path):
    path = str(tmp_path / "names")
    store.write_names(spark.createDataFrame([("a",), ("b",)], "name string"), path, "author")
    store.write_names(spark.createDataFrame([("c",)], "name string"), path, "author")
    assert [r["name"] for r in store.read_names(spark, path, "author").collect()] == ["c"]


def test_listings_of_equal_names_stay_apart(spark, tmp_path):
    for folder, text in (("one", "first"), ("two", "second")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "View").write_text(text)
    found = files.scan_contents(spark, str(tmp_path / "*"), "View")
    assert {r["contents_file"].rsplit("/", 2)[1]: r["html"] for r in found.collect()} == {"one": "first", "two": "second"}


@pytest.mark.parametrize("whole", [0, 4, 64 << 20])
def test_media_scan_hashes_files_of_any_size(spark, tmp_path, monkeypatch, whole):
    """Whether as values or as streams of ranges, the same comes out."""
    monkeypatch.setattr(files, "WHOLE_BYTES", whole)
    monkeypatch.setattr(ranges, "RANGE_BYTES", 3)
    monkeypatch.setattr(ranges, "HEAD_BYTES", 8)
    (tmp_path / "in").mkdir()
    names = {"a b&c%20?x.txt": b"text", "in/b.gz": b"\x1f\x8bnot really packed", "p.png": b"\x89PNG\r\n\x1a\n" * 9}
    for name, data in {"1?OpenDocument": b"page", **names}.items():
        (tmp_path / name).write_bytes(data)
    found = {r["path"].removeprefix(f"{tmp_path}/"): r for r in files.scan_media(spark, str(tmp_path)).collect()}
    assert {n: (r["file_hash"], r["n_bytes"], bytes(r["head"])) for n, r in found.items()} == {
        n: (hashlib.md5(d).hexdigest(), len(d), d[:8]) for n, d in names.items()
    }


@pytest.mark.parametrize("limit", [700, 2_000, 1 << 20])
def test_parts_are_bounded_and_in_order(spark, tmp_path, limit):
    sizes = [0, 5, 300, 40, 2_500, 10, 10, 900, 700, 0, 1, 350, 349]
    rows = [(i, None if i % 3 else "h", ("&<\r" if i % 2 else "é\x01") * (n // 3)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "n long, k string, body string").repartition(4)
    store.write_xml_parts(Workspace(spark), df, str(tmp_path / "out"), "rows", "row", ("n", "k"), limit)
    parts = sorted((tmp_path / "out").glob("part=*"))
    read = []
    for part in parts:
        (file,) = [p for p in part.iterdir() if p.name.startswith("part-")]
        numbers = [int(x) for x in re.findall("<n>(\\d+)</n>", file.read_text())]
        assert file.stat().st_size <= limit or len(numbers) == 1
        read += numbers
    assert read == list(range(len(sizes))) and len(parts) == (1 if limit > 10_000 else len(parts))


def test_files_over_two_gib_are_hashed(spark, tmp_path):
    with open(tmp_path / "large.bin", "wb") as out:
        out.truncate(3 << 30)
    want = hashlib.md5()
    for _ in range(3 << 6):
        want.update(bytes(1 << 24))
    (row,) = files.scan_media(spark, str(tmp_path)).collect()
    assert (row["file_hash"], row["n_bytes"]) == (want.hexdigest(), 3 << 30)


def test_files_that_cannot_be_read_have_no_hash(spark, tmp_path):
    uris = spark.createDataFrame([(f"file:{tmp_path}/missing",), ("nosuch://store/x",)], "uri string")
    assert [r["file_hash"] for r in ranges.hashed(uris).collect()] == [None, None]


def test_copies_are_whole_or_absent(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"first")
    (tmp_path / "out").mkdir()
    md5 = hashlib.md5(b"first").hexdigest()
    rows = spark.createDataFrame([(f"file:{tmp_path}/a", md5, f"{md5}.txt")], "uri string, file_hash string, name string")
    for _ in range(2):  # a second attempt replaces the first one's file
        assert [tuple(r) for r in ranges.copied(rows, f"file:{tmp_path}/out").collect()] == [(f"{md5}.txt", md5, 5)]
    changed = rows.withColumn("file_hash", F.lit("0" * 32)).withColumn("name", F.lit("changed"))
    with pytest.raises(Exception, match="changed while"):
        ranges.copied(changed, f"file:{tmp_path}/out").collect()
    assert [p.name for p in (tmp_path / "out").iterdir()] == [f"{md5}.txt"]


def test_nested_font_tags_keep_their_text(spark):
    cell = (
        '<font color="red"><font size="2">Title</font></font><FONT size="2">A <font color="red">b</font> tail</FONT >'
        '<font size="2">x < y</font><font size="3">no</font></font><font size="2">open'
    )
    row = spark.createDataFrame([(cell,), ('<font size="2">p</font><font size=2>q</font>',)], "c string")
    nested = row.select(F.col("c").rlike(extract.NESTED_FONT).alias("n"), extract._outer_fonts(F.col("c")).alias("f"))
    assert [tuple(r) for r in nested.collect()] == [
        (True, ["Title", 'A <font color="red">b</font> tail', "x < y"]),
        (False, ["p", "q"]),
    ]


def test_texts_become_one_file_each_in_bounded_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "FOLDER_FILES", 2)
    texts = [None, "", "a\nb", "same", "same", "ü"]
    table = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    files.write_texts(spark, table, f"{tmp_path}/out")
    found = files.read_files(spark, f"{tmp_path}/out", "part-*.txt").collect()
    assert sorted(bytes(r["content"]).decode() for r in found) == sorted(f"{t or ''}\n" for t in texts)
    assert len({os.path.dirname(r["path"]) for r in found}) == 3
    # No checksum files, no other attempts' folders.
    assert sum(len(names) for _, _, names in os.walk(tmp_path)) == len(texts)
    assert [n for n in os.listdir(f"{tmp_path}/out") if n.startswith(".")] == []


def test_no_texts_become_no_files(spark, tmp_path):
    files.write_texts(spark, spark.createDataFrame([], "text string"), f"{tmp_path}/out")
    assert files.scan_media(spark, f"{tmp_path}/out", "part-*.txt").count() == 0


def test_second_attempt_of_a_task_leaves_each_file_once(tmp_path):
    _, _, write = ranges._tools()
    for attempt in (1, 2):
        assert write(iter([b"x", b"y"]), f"{tmp_path}/task", f"{tmp_path}/.attempt-{attempt}") == 2
    assert os.listdir(tmp_path) == ["task"]
    assert sum(len(names) for _, _, names in os.walk(tmp_path)) == 2


def test_sizes_are_asked_of_the_listing_alone(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"part-{i}.txt").write_text("x" * i + "y")
    one_scan = spark.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions()
    assert files.read_files(spark, str(tmp_path), "*.txt").rdd.getNumPartitions() == one_scan
    found = files.read_files(spark, str(tmp_path), "*.txt", max_bytes=50).collect()
    assert sorted(r["n_bytes"] for r in found if r["content"] is None) == list(range(51, 101))


def test_tasks_list_what_a_scan_of_spark_lists(spark, tmp_path, monkeypatch):
    """Odd names, links, hidden and empty files; no other test folder has such."""
    monkeypatch.setattr(ranges, "BATCH_ROWS", 2)
    monkeypatch.setattr(ranges, "BATCH_BYTES", 5)
    root = tmp_path / "in a%20b"
    names = [
        "1?OpenDocument", "a&b?OpenDocument&x=ü", "_hid?OpenDocument", "_k=1?OpenDocument", ".dot?OpenDocument", "new\nline?OpenDocument",
        "deep/er/2?OpenDocument", "_metadata/3?OpenDocument", "_metadata?OpenDocument", ".git/4?OpenDocument", "_tmp/5?OpenDocument",
        "k=v/6?OpenDocument", "x._COPYING_/7?OpenDocument", "8?OpenDocument._COPYING_", "other.txt", "back\\slash?OpenDocument", "?OpenDocument",
    ]
    for i, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * (i + 1))
    (root / "empty?OpenDocument").touch()
    (root / "bare").mkdir()
    (root / "link?OpenDocument").symlink_to(root / "other.txt")
    (root / "linked").symlink_to(root / "deep")
    (root / "gone?OpenDocument").symlink_to(root / "nowhere")
    with open(os.fsencode(root) + b"/\xff?OpenDocument", "wb") as out:
        out.write(b"not UTF-8")
    for glob in (files.DOCUMENT_GLOB, "*", "[0-5]*", "{1,a&b}*"):
        own = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(str(root))
        own = own.select(files.file_path(F.col("path")), "content", "length", "modificationTime").collect()
        found = files.read_files(spark, str(root), glob)
        assert found.columns == ["path", "content", "n_bytes", "modified"]
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, own)) != []


def test_driver_holds_no_list_of_documents(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"in/{i % 7}/{i % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/{i % 7}/{i % 3}/{i}?OpenDocument").write_text(f"text {i}")
    found = files.scan_documents(spark, f"file://{tmp_path}/in")
    assert [f for f in found.inputFiles() if "OpenDocument" in f] == []
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(bytes(r["content"]).decode() for r in found.collect()) == sorted(f"text {i}" for i in range(300))


def test_large_documents_are_read_whole(spark, tmp_path):
    data = {"1?OpenDocument": bytes(range(256)) * (1 << 19), "2?OpenDocument": b"x", "3?OpenDocument": b"y" * 50}
    for name, value in data.items():
        (tmp_path / name).write_bytes(value)
    found = files.read_files(spark, str(tmp_path), "*", max_bytes=1 << 30).select("path", F.md5("content"))
    assert {(p.rsplit("/", 1)[1], h) for p, h in found.collect()} == {(n, hashlib.md5(v).hexdigest()) for n, v in data.items()}


def test_documents_not_asked_for_are_not_read(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}?OpenDocument").write_text(f"text {i}")
    found = files.scan_documents(spark, str(tmp_path))
    for i in range(3):
        (tmp_path / f"{i}?OpenDocument").unlink()
    assert found.select("path").count() == 3
    with pytest.raises(Exception, match="No such file"):
        found.collect()


def test_driver_holds_no_list_of_media(spark, tmp_path):
    data = {f"{i % 7}/{i % 3}/{i}.txt": f"text {i}".encode() for i in range(300)}
    for name, value in {**data, "0/1?OpenDocument": b"page", "1/.hidden.txt": b"x"}.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(value)
    found = files.scan_media(spark, f"{tmp_path}/in")
    assert [f for f in found.inputFiles() if f.endswith(".txt")] == []
    # Those over the whole-file limit, of which there are none here, have tasks of their own.
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    want = {(f"{tmp_path}/in/{n}", hashlib.md5(v).hexdigest(), len(v), v) for n, v in data.items()}
    assert {(r["path"], r["file_hash"], r["n_bytes"], bytes(r["head"])) for r in found.collect()} == want


def test_small_media_that_cannot_be_read_end_the_run(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    found = files.scan_media(spark, str(tmp_path))
    (tmp_path / "a").unlink()
    with pytest.raises(Exception, match="No such file"):
        found.collect()
