import json
import os

import pytest
from examples import FIVE, frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stepmark.operators.images import keep_existing_images
from stepmark.operators.messages import render_chat
from stepmark.session import shared_path, spread, through_table
from stepmark.sources import (
    describe_columns,
    list_files,
    publish_version,
    read_files,
    read_manifest,
    scan_files,
    scan_jsonl,
    scan_split,
    scan_table,
    verify_written,
    write_sharded,
)
from stepmark.streaming import stream_jsonl, stream_peek, stream_prepare, stream_regroup


def lines(folder, *files):
    for number, rows in enumerate(files):
        (folder / f"{number}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(folder)


def short(images):
    """An example as it comes, with the keys that are not there left out."""
    return {"images": images, "messages": [{"role": "user", "content": [{"type": "text", "text": "hé"}]}]}


def test_jsonl(spark, tmp_path):
    df = scan_jsonl(spark, lines(tmp_path, [short(["p"]), {"messages": FIVE}]))
    rows = sorted(df.collect(), key=lambda r: len(r["messages"]))
    assert rows[0]["messages"][0]["content"][0].asDict() == {"type": "text", "text": "hé", "image": None, "index": None}
    assert rows[1]["images"] is None and len(rows[1]["messages"]) == 5


def test_a_bad_line_is_fatal(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text(json.dumps(short([])) + "\n{no json\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan_jsonl(spark, str(tmp_path)).collect()


def test_sharded_write(spark, tmp_path):
    path = f"{tmp_path}/out"
    write_sharded(spark.range(1000), path, shards=4)
    assert len(list((tmp_path / "out").glob("part-*"))) == 4
    assert scan_table(spark, path).count() == 1000
    with pytest.raises(AnalysisException):
        write_sharded(spark.range(3), path)
    write_sharded(spark.range(3).coalesce(1), f"{tmp_path}/plain")
    assert len(list((tmp_path / "plain").glob("part-*"))) == 1


def test_publish_and_read_a_split(spark, tmp_path):
    df = spark.range(100).withColumn("split", F.when(F.col("id") % 10 == 0, "test").otherwise("train"))
    manifest = publish_version(df, str(tmp_path), "steps", "2", "id")
    got = {r["split"]: (r["num_rows"], r["min_key"], r["max_key"], r["version"]) for r in manifest.collect()}
    assert got == {"test": (10, 0, 90, "2"), "train": (90, 1, 99, "2")}
    test = scan_split(spark, f"{tmp_path}/steps/v=2", "test")
    assert test.count() == 10
    listed = test.inputFiles()
    assert listed and all("/steps/v=2/split=test/" in f for f in listed), "only the chosen folder is in the plan"
    assert set(test.columns) == {"id", "split"}
    by_version = scan_split(spark, f"{tmp_path}/steps", "train", v="2")
    assert by_version.count() == 90
    assert set(by_version.columns) == {"id", "v", "split"}
    with pytest.raises(FileExistsError):
        publish_version(df, str(tmp_path), "steps", "2", "id")
    with pytest.raises(FileNotFoundError):
        scan_split(spark, f"{tmp_path}/steps", "train", v="3")
    with pytest.raises(ValueError, match="no partition columns"):
        scan_split(spark, f"{tmp_path}/steps", "train", v="2", lang="en")


def test_split_by_several_columns_in_any_order(spark, tmp_path):
    df = spark.range(12).selectExpr("id", "if(id % 2 = 0, 'a b', 'x:y') AS config", "if(id % 3 = 0, 'test', 'train') AS split")
    publish_version(df, str(tmp_path), "t", "1", "id", by=("config", "split"))
    ids = lambda got: sorted(r["id"] for r in got.collect())
    assert ids(scan_split(spark, f"{tmp_path}/t/v=1", "test", config="x:y")) == [3, 9]
    assert ids(scan_split(spark, f"{tmp_path}/t", "train", config="a b", v="1")) == [2, 4, 8, 10]
    assert ids(scan_split(spark, f"{tmp_path}/t", "test")) == [0, 3, 6, 9], "all values of the other columns"


def test_a_publication_that_fails_leaves_no_version(spark, tmp_path, monkeypatch):
    from stepmark.sources import writers

    df = spark.range(10).withColumn("split", F.lit("train"))
    monkeypatch.setattr(writers, "MANIFEST", "a/\0")  # the second of the two writes fails
    with pytest.raises(Exception):  # noqa: B017, PT011  (whatever the file system says)
        publish_version(df, str(tmp_path), "t", "1", "id")
    assert not (tmp_path / "t" / "v=1").exists()
    monkeypatch.undo()

    def no_rename(*_):
        raise OSError("lost")

    monkeypatch.setattr(writers._Renaming, "rename", no_rename)
    with pytest.raises(OSError, match="lost"):
        publish_version(df, str(tmp_path), "t", "1", "id")
    assert not (tmp_path / "t" / "v=1").exists()
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no partition columns"):
        scan_split(spark, f"{tmp_path}/t", "train", v="1")
    publish_version(df, str(tmp_path), "t", "1", "id")
    assert scan_split(spark, f"{tmp_path}/t", "train", v="1").count() == 10
    assert read_manifest(spark, str(tmp_path), "t", "1").first()["num_rows"] == 10
    with pytest.raises(Exception, match="FileAlreadyExists"):
        writers._Renaming(spark, str(tmp_path)).rename(f"{tmp_path}/t/_staged", f"{tmp_path}/t/v=1")


def test_listing_by_tasks_equals_the_listing_of_the_driver(spark, tmp_path):
    for name in ("a/1.bin", "a/b/2.bin", "a/b/c/3.bin", "d/_hidden/4.bin", "d/.x", "d/e f/5 %20+.bin", "6.bin"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode() * 3)
    (tmp_path / "empty").mkdir()
    driver = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    expected = {(r["path"].removeprefix("file:"), r["length"]) for r in driver.select("path", "length").collect()}
    assert {tuple(r) for r in list_files(spark, str(tmp_path)).collect()} == expected and len(expected) == 5
    assert {tuple(r) for r in list_files(spark, f"file://{tmp_path}/").collect()} == expected
    assert list_files(spark, f"{tmp_path}/empty").count() == 0
    content = {r["path"]: bytes(r["content"]) for r in scan_files(spark, str(tmp_path)).collect()}
    assert content == {p: open(p, "rb").read() for p, _ in expected}
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"{tmp_path}/none")


def test_files_are_read_where_the_rows_are(spark, tmp_path, monkeypatch):
    from stepmark.sources import files

    monkeypatch.setattr(files, "READ_BYTES", 10)
    for i in range(4):
        (tmp_path / f"{i}").write_bytes(bytes([i]) * 7)
    names = [f"{tmp_path}/{i % 4}" for i in range(20)] + [f"file://{tmp_path}/1", None, f"{tmp_path}/gone", str(tmp_path), "odd://x"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, path string").sortWithinPartitions("path")
    for r in read_files(df).collect():
        if r["id"] < 21:
            assert bytes(r["content"]) == bytes([r["id"] % 4 if r["id"] < 20 else 1]) * 7 and r["reason"] is None
        else:
            assert r["content"] is None
            assert r["reason"].startswith(["no reference", "not found", "unreadable", "unreadable"][r["id"] - 21])
    with pytest.raises(ValueError, match="already"):
        read_files(df.withColumn("reason", F.lit(1)))


def test_verify_written(spark):
    expected = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id int")
    assert verify_written(expected, expected, ["id"]).count() == 0
    written = expected.where("id < 3")
    assert [r["id"] for r in verify_written(expected, written, ["id"], strict=False).collect()] == [3]
    with pytest.raises(ValueError, match="not written"):
        verify_written(expected, written, ["id"])


def test_describe(spark):
    df = frame(spark, [(1, [], FIVE)])
    got = {r["column"]: (r["type"], r["num_rows"]) for r in describe_columns(df).collect()}
    assert got["id"] == ("bigint", 1) and got["images"] == ("array<string>", 1) and len(got) == 3


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_path(spark, "x") != shared_path(spark, "x")
    if named:
        assert shared_path(spark, "x").startswith(f"{named.rstrip('/')}/x-")
    assert through_table(spark.range(5), "y").count() == 5


def test_spread_leaves_large_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide, "id") is wide
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 16


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_stream_equals_batch(spark, tmp_path, files_per_batch):
    (tmp_path / "in").mkdir()
    source = lines(tmp_path / "in", [short(["p"]), short(["q", "p"])], [short(["p"])], [short([])])
    rows = lambda df: sorted(json.dumps(r.asDict(), default=str) for r in df.collect())

    def local(df):
        return df.select(F.explode("images").alias("image"), render_chat(F.col("messages")).alias("text"))

    stream = stream_jsonl(spark, source, files_per_batch=files_per_batch)
    stream_prepare(stream, local, f"{tmp_path}/rows", f"{tmp_path}/state1").awaitTermination()
    assert rows(scan_table(spark, f"{tmp_path}/rows")) == rows(local(scan_jsonl(spark, source)))

    listing = spark.createDataFrame([("p",)], "path string")

    def existing(df):
        from stepmark.operators.examples import example_key

        keyed = example_key(df).withColumn("key", F.concat_ws("-", "row_hash", F.col("ordinal").cast("string")))
        return keep_existing_images(keyed.drop("row_hash", "ordinal"), listing, "key").select("images")

    stream = stream_jsonl(spark, source, files_per_batch=files_per_batch)
    stream_regroup(stream, existing, f"{tmp_path}/groups", f"{tmp_path}/state2").awaitTermination()
    assert rows(scan_table(spark, f"{tmp_path}/groups").select("images")) == rows(existing(scan_jsonl(spark, source)))


def test_stream_peek(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = lines(tmp_path / "in", [{"images": [f"{i}"], "messages": []} for i in range(9)])
    stream = stream_jsonl(spark, source).withColumn("first", F.get("images", F.lit(0)))
    got = stream_peek(stream, "first", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r["first"] for r in got.collect()) == ["0", "1", "2"]


def test_stream_peek_stops(spark, tmp_path):
    """Two rows a file, one file a micro-batch: three rows are in the first two files, the third is broken."""
    (tmp_path / "in").mkdir()
    for number, line in enumerate(["ab", "cd", None, "ef"]):
        file = tmp_path / "in" / f"{number}.jsonl"
        file.write_text("{broken" if line is None else "".join(json.dumps({"images": [c], "messages": []}) + "\n" for c in line))
        os.utime(file, (1_700_000_000 + 100 * number,) * 2)
    stream = lambda: stream_jsonl(spark, f"{tmp_path}/in", files_per_batch=1).withColumn("first", F.get("images", F.lit(0)))
    got = stream_peek(stream(), "first", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r["first"] for r in got.collect()) == ["a", "b", "c"]
    again = stream_peek(stream(), "first", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r["first"] for r in again.collect()) == ["a", "b", "c"], "a query that starts again has what it needs"
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        stream_peek(stream(), "first", f"{tmp_path}/out2", f"{tmp_path}/state2", n=5)
