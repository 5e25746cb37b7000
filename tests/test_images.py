import os
import time
import tracemalloc

import numpy as np
import pytest
from examples import FIVE, frame
from pyspark.sql import functions as F

from stepmark.operators import hooks as H
from stepmark.operators import images as I
from stepmark.plans import flows
from stepmark.plans.adapters import _pam, _png
from stepmark.sources import list_files, read_files, scan_image_files, scan_images

PREFIX = "s3://bucket/base/"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Gray, RGB and RGBA images, a name with spaces and signs, and a file that is no image."""
    root = tmp_path_factory.mktemp("images")
    (root / "deep").mkdir()
    rng = np.random.default_rng(5)
    made = {}
    for name, channels in (("gray.png", 1), ("deep/rgb.png", 3), ("a b+c%20.png", 4)):
        made[name] = rng.integers(0, 256, (5, 9, channels), dtype=np.uint8)
        (root / name).write_bytes(_png(made[name]))
    (root / "broken.png").write_bytes(b"no image")
    return str(root), made


def test_files_and_images(spark, folder):
    root, made = folder
    names = {f"{root}/{n}" for n in [*made, "broken.png"]}
    files = {r["path"]: r for r in scan_image_files(spark, root).collect()}
    assert set(files) == names
    assert all(r["length"] == len(r["content"]) == os.path.getsize(p) for p, r in files.items())
    assert scan_image_files(spark, root, content=False).columns == ["path", "length"]
    images = {r["path"]: r for r in scan_images(spark, root).collect()}
    assert set(images) == names
    assert images[f"{root}/broken.png"]["height"] == -1
    assert {images[f"{root}/{n}"]["channels"] for n in made} == {1, 3, 4}
    assert scan_images(spark, root, drop_invalid=True).count() == 3


def test_rgb_on_white(spark, folder):
    root, made = folder
    rows = {r["path"]: r for r in I.images_to_rgb(scan_images(spark, root)).collect()}
    assert rows[f"{root}/broken.png"]["data"] is None
    for name, pixels in made.items():
        row = rows[f"{root}/{name}"]
        got = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], 3)
        if pixels.shape[2] == 4:
            alpha = pixels[:, :, 3:] / 255.0
            expected = np.rint(pixels[:, :, :3] * alpha + 255 * (1 - alpha))
        else:
            expected = np.broadcast_to(pixels, (5, 9, 3))
        assert np.array_equal(got, expected)


def plain_resample(pixels, height, width):
    """The same resampling written per output pixel, without separation."""

    def weights(old, new):
        rows = []
        for i in range(new):
            scale = old / new
            stretch = max(scale, 1.0)
            center = (i + 0.5) * scale
            row = []
            for j in range(old):
                x = abs((j + 0.5 - center) / stretch)
                if x < 1:
                    row.append(1.5 * x**3 - 2.5 * x**2 + 1)
                elif x < 2:
                    row.append(-0.5 * x**3 + 2.5 * x**2 - 4 * x + 2)
                else:
                    row.append(0.0)
            rows.append(np.array(row) / sum(row))
        return np.array(rows)

    down, across = weights(pixels.shape[0], height), weights(pixels.shape[1], width)
    return np.clip(np.einsum("hi,wj,ijc->hwc", down, across, pixels.astype(float)), 0, 255)


@pytest.mark.parametrize("size", [(28, 56), (3, 4), (5, 9), (2, 30)])
def test_resample_within_tolerance(size):
    pixels = np.random.default_rng(3).integers(64, 192, (5, 9, 3), dtype=np.uint8)
    assert np.abs(I.resample(pixels, *size) - plain_resample(pixels, *size)).max() <= 2.0


def test_resample_keeps_flat_color_and_same_size():
    flat = np.full((40, 30, 3), 77, np.uint8)
    assert (I.resample(flat, 28, 56) == 77).all()
    pixels = np.random.default_rng(1).integers(0, 256, (6, 7, 3), dtype=np.uint8)
    assert np.array_equal(I.resample(pixels, 6, 7), pixels)


def test_images_resize(spark, folder):
    root, _ = folder
    rows = {r["path"]: r for r in I.images_resize(I.images_to_rgb(scan_images(spark, root)), "small").collect()}
    gray = rows[f"{root}/gray.png"]
    assert gray["derived_path"] == f"{root}/gray_small.png"
    assert (gray["height"], gray["width"]) == (56, 84) and len(gray["data"]) == 56 * 84 * 3
    broken = rows[f"{root}/broken.png"]
    assert broken["height"] is None and broken["data"] is None


def raw(spark):
    return frame(spark, [
        (1, ["p", "gone", "q", "p"], FIVE),
        (2, ["gone"], FIVE),
        (3, [], FIVE),
        (4, None, FIVE),
        (5, ["q"], FIVE),
    ])


def test_missing_images(spark):
    listing = spark.createDataFrame([("p",), ("q",)], "path string")
    got = {r["path"]: r["n_refs"] for r in I.missing_images_strict(raw(spark), listing, strict=False).collect()}
    assert got == {"gone": 2}
    with pytest.raises(FileNotFoundError, match="gone"):
        I.missing_images_strict(raw(spark), listing)


@pytest.mark.parametrize("rows_per_task", [1, 1_000_000])
def test_keep_existing_images(spark, rows_per_task):
    listing = spark.createDataFrame([("p",), ("q",), ("q",), ("other",)], "path string")
    kept = I.keep_existing_images(raw(spark), listing, "id", rows_per_task).collect()
    assert {r["id"]: r["images"] for r in kept} == {1: ["p", "q", "p"], 2: [], 3: [], 4: [], 5: ["q"]}
    assert all(len(r["messages"]) == 5 for r in kept)


def test_attach_bytes(spark, folder):
    root, _ = folder
    names = [f"{root}/gray.png"] * 9 + [f"{root}/nowhere.png", None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, image string")
    rows = I.attach_image_bytes(df, ["id"]).collect()
    assert len(rows) == 11
    content = open(f"{root}/gray.png", "rb").read()
    for r in rows:
        expected = content if r["id"] < 9 else None
        assert r["image"]["path"] == names[r["id"]]
        assert (bytes(r["image"]["bytes"]) if r["image"]["bytes"] else None) == expected
    assert {r["image_reason"] for r in rows} == {None, "no reference", f"not found: {root}/nowhere.png"}
    plan = I.attach_image_bytes(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange rangepartitioning") == 1, "rows are dealt out once, bytes never"
    with pytest.raises(FileNotFoundError, match="no reference|nowhere"):
        I.attach_image_bytes(df, ["id"], strict=True)


def test_media_of_batches(spark, folder):
    root, _ = folder
    gray, gone = f"{root}/gray.png", f"{root}/gone.png"
    rows = [(0, [[gray, gone], [], [gray]]), (1, [[None]]), (2, []), (3, None), (4, [None, [gray]])]
    df = spark.createDataFrame(rows, "micro_batch int, images array<array<string>>")
    content = open(gray, "rb").read()
    file = lambda p: (p, content if p == gray else None)
    got = {r["micro_batch"]: r["media"] for r in I.attach_media(df).collect()}
    for number, lists in rows:
        expected = None if lists is None else [None if x is None else [file(p) for p in x] for x in lists]
        media = got[number]
        plain = None if media is None else [None if x is None else [(f["path"], f["bytes"] and bytes(f["bytes"])) for f in x] for x in media]
        assert plain == expected
    with pytest.raises(ValueError, match="already"):
        I.attach_media(df, media="images")


def netpbm(pixels, form):
    height, width, channels = pixels.shape
    if form == "pam":
        return _pam(pixels)
    return f"P{ {1: 5, 3: 6}[channels] }\n# a comment\n{width} {height}\n255\n".encode() + pixels.tobytes()


@pytest.fixture(scope="module")
def pictures(tmp_path_factory):
    """Files of every kind, one cut short, one no image, one too long for its height."""
    root = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(8)
    made = {}
    for name, channels in (("g.pgm", 1), ("c.ppm", 3), ("g.pam", 1), ("c.pam", 3), ("a.pam", 4)):
        made[name] = rng.integers(0, 256, (6, 11, channels), dtype=np.uint8)
        made[name][0, 0] = 10  # a line feed at the start of the pixels
        (root / name).write_bytes(netpbm(made[name], name[-3:]))
    made["long.pgm"] = np.zeros((1, 500, 1), np.uint8)
    (root / "long.pgm").write_bytes(netpbm(made["long.pgm"], "pgm"))
    (root / "cut.ppm").write_bytes(netpbm(made["c.ppm"], "ppm")[:-9])
    (root / "none.ppm").write_bytes(b"")
    return str(root), made


def test_decode(spark, pictures):
    root, made = pictures
    files = read_files(list_files(spark, root).union(spark.createDataFrame([(f"{root}/gone", 0)], "path string, length long")))
    rows = {r["path"].removeprefix(f"{root}/"): r for r in I.decode_images(files).collect()}
    assert set(rows) == {*made, "cut.ppm", "none.ppm", "gone"}
    for name, pixels in made.items():
        got = np.frombuffer(rows[name]["data"], np.uint8).reshape(rows[name]["height"], rows[name]["width"], 3)
        color, alpha = pixels[:, :, :3].astype(float), pixels[:, :, 3:] / 255 if pixels.shape[2] == 4 else 1.0
        assert np.array_equal(got, np.broadcast_to(np.rint(color * alpha + 255 * (1 - alpha)), got.shape))
        assert rows[name]["reason"] is None
    for name, reason in {"cut.ppm": "not an image", "none.ppm": "not an image", "gone": "not found"}.items():
        assert rows[name]["data"] is None and rows[name]["reason"].startswith(reason)


def test_a_decoder_is_built_once_per_worker(spark, pictures, tmp_path):
    root, _ = pictures

    def factory(log=str(tmp_path), kind=I.netpbm_decoder):
        open(f"{log}/{os.getpid()}-{time.time_ns()}", "w").close()
        return kind()

    files = read_files(list_files(spark, root).repartition(16))
    for _ in range(2):
        I.decode_images(files, factory).count()
    built = [name.split("-")[0] for name in os.listdir(tmp_path)]
    assert built and len(built) == len(set(built))


@pytest.mark.parametrize("strip", [1, 3, 64])
def test_strips_change_nothing(monkeypatch, strip):
    pixels = np.random.default_rng(3).integers(0, 256, (70, 90, 3), dtype=np.uint8)
    whole = []
    for size in ((28, 56), (130, 7), (1, 300)):
        monkeypatch.setattr(I, "STRIP", 10_000)
        whole.append(I.resample(pixels, *size))
        monkeypatch.setattr(I, "STRIP", strip)
        assert np.array_equal(I.resample(pixels, *size), whole[-1])
    alpha = np.random.default_rng(4).integers(0, 256, (70, 9, 4), dtype=np.uint8)
    monkeypatch.setattr(I, "STRIP", 10_000)
    expected = I.to_rgb(alpha)
    monkeypatch.setattr(I, "STRIP", strip)
    assert np.array_equal(I.to_rgb(alpha), expected)


def test_memory_of_a_large_image():
    """12.8 million pixels: input, bytes between, output and strips in less than 300 MB."""
    pixels = np.zeros((3200, 4000, 3), np.uint8)
    tracemalloc.start()
    I.resample(pixels, 2800, 3584)
    assert tracemalloc.get_traced_memory()[1] + pixels.nbytes < 300e6
    tracemalloc.stop()


def test_image_features(spark, pictures):
    root, made = pictures
    rgb = I.decode_images(read_files(list_files(spark, root)))

    def mean_color(scale=2.0):
        return lambda pixels: pixels.mean(axis=(0, 1)) * scale

    features = H.image_features(rgb, mean_color, (3,), "color")
    assert features.columns == ["path", "height", "width", "reason", "color"]
    assert features.schema["color"].metadata == {"shape": [3]}
    for r in features.collect():
        name = r["path"].removeprefix(f"{root}/")
        if r["reason"]:
            assert r["color"] is None
        elif made[name].shape[2] < 4:
            assert np.allclose(r["color"], np.broadcast_to(made[name], (*made[name].shape[:2], 3)).mean(axis=(0, 1)) * 2)
    with pytest.raises(Exception, match="declared shape"):
        H.image_features(rgb, mean_color, (4,)).collect()


def test_map_batches(spark):
    df = spark.createDataFrame([(0, [[1, 2], [3, 0]]), (1, [[5]])], "micro_batch bigint, input_ids array<array<int>>")

    def factory():
        return lambda batch: {"micro_batch": batch["micro_batch"], "longest": max(map(len, batch["input_ids"])), "flat": sum(batch["input_ids"], [])}

    got = H.map_batches(df, factory, "micro_batch bigint, longest int, flat array<int>").collect()
    assert sorted(map(tuple, got)) == [(0, 2, [1, 2, 3, 0]), (1, 1, [5])]


def test_conversion(spark, folder):
    root, _ = folder
    refs = [PREFIX + "gray.png", PREFIX + "deep/rgb.png"]
    df = frame(spark, [(1, refs, FIVE), (2, refs[:1], FIVE)])
    converted = flows.converted_table(df, scan_image_files(spark, root, content=False), PREFIX, root)
    assert converted.columns == ["image", "messages", "split"] and converted.count() == 3
    with pytest.raises(FileNotFoundError):
        flows.converted_table(frame(spark, [(1, [PREFIX + "no.png"], FIVE)]), list_files(spark, root), PREFIX, root)


def test_resize_flow(spark, pictures):
    root, made = pictures
    ref = lambda *names: [PREFIX + n for n in names]
    good = [(1, ref("g.pgm", "c.ppm"), FIVE), (2, ref("c.ppm"), FIVE), (3, ref("gone.ppm", "a.pam"), FIVE), (3, ref("a.pam"), FIVE)]
    bad = [(4, [], FIVE), (5, None, FIVE), (6, ref("gone.ppm"), FIVE), (7, ref("cut.ppm"), FIVE), (8, ref("long.pgm"), FIVE)]
    flow = lambda rows, **options: flows.resized_table(frame(spark, rows), "id", PREFIX, root, suffix="small", **options)
    got = flow([*good, *bad], strict=False)
    assert got.examples.columns == ["id", "image", "messages", "split"]
    examples = sorted((r["id"], r["image"].removeprefix(root + "/"), len(r["messages"])) for r in got.examples.collect())
    assert examples == [(1, "c_small.ppm", 5), (2, "c_small.ppm", 5), (3, "a_small.pam", 5), (3, "a_small.pam", 5)]
    rejected = {r["example_key"]: r["reason"] for r in got.rejects.collect()}
    assert rejected == {"4": "no image", "5": "no image", "6": f"not found: {root}/gone.ppm", "7": f"not an image: {root}/cut.ppm", "8": "aspect ratio"}
    images = {r["path"].removeprefix(root + "/"): r for r in got.images.collect()}
    assert set(images) == {"c.ppm", "a.pam"}, "only picked images are opened, each once"
    c = images["c.ppm"]
    expected = I.resample(made["c.ppm"], c["height"], c["width"])
    assert bytes(c["data"]) == expected.tobytes() and c["derived_path"] == f"{root}/c_small.ppm"
    assert flow(good).rejects.count() == 0
    with pytest.raises(ValueError, match="rejected"):
        flow([*good, bad[2]])


def test_resize_with_sides_of_its_own(spark, pictures):
    from stepmark.functions.sizes import requested_size

    root, _ = pictures
    schema = "path string, rh bigint, rw bigint, low bigint, high bigint"
    paths = spark.createDataFrame([(f"{root}/c.ppm", 56, 140, None, None), (f"{root}/g.pgm", None, None, 28 * 28, 28 * 28 * 4)], schema)
    sizes = requested_size(*(F.col(c) for c in ("height", "width", "rh", "rw", "low", "high")))
    got = {r["path"][-5:]: (r["height"], r["width"], len(r["data"])) for r in I.resized_files(paths, sizes=sizes).collect()}
    assert got == {"c.ppm": (56, 140, 56 * 140 * 3), "g.pgm": (28, 28, 28 * 28 * 3)}


def test_keep_readable_images(spark, pictures):
    root, _ = pictures
    names = ["c.ppm", "cut.ppm", "gone.ppm", "c.ppm", "a.pam", "none.ppm"]
    df = frame(spark, [(1, [f"{root}/{n}" for n in names], FIVE), (2, [f"{root}/cut.ppm"], FIVE), (3, [], FIVE)])
    readable = I.readable_images(df.select(F.explode("images").alias("path")))
    kept = {r["id"]: [p.removeprefix(f"{root}/") for p in r["images"]] for r in I.keep_existing_images(df, readable, "id").collect()}
    assert kept == {1: ["c.ppm", "c.ppm", "a.pam"], 2: [], 3: []}
