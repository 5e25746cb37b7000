"""Image references against storage, and the two pixel jobs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmark.functions.refs import derive_resized_path
from stepmark.functions.sizes import CONVERSION, PixelBounds, resize_plan
from stepmark.operators.hooks import per_worker
from stepmark.operators.joins import ROWS_PER_TASK, salted_left_join
from stepmark.sources.files import in_reading_tasks, read_file, read_files

RGB_SCHEMA = "path string, height int, width int, data binary"
RESIZED_SCHEMA = "path string, derived_path string, height int, width int, data binary"
ASPECT_RATIO = "aspect ratio"
#: Rows or columns of an image that are resampled together.
STRIP = 64
IMAGES_PER_TASK = 64
# Kind, width, height and greatest sample of a PGM or PPM file; comments may stand between.
_PNM_HEAD = re.compile(rb"(P[56])(?:\s+|#.*\n)+(\d+)(?:\s+|#.*\n)+(\d+)(?:\s+|#.*\n)+(\d+)\s")


def missing_images_strict(df: DataFrame, listing: DataFrame, strict: bool = True) -> DataFrame:
    """References of `images` that are not in `listing`, with how often they occur.

    Strict mode raises, naming one. References are counted before the join, so an image that
    very many examples share is one row there.
    """
    refs = df.select(F.explode("images").alias("path")).groupBy("path").agg(F.count("*").alias("n_refs"))
    missing = refs.join(listing.select("path"), "path", "left_anti")
    if strict:
        first = missing.take(1)
        if first:
            raise FileNotFoundError(f"image not found: {first[0]['path']}")
    return missing


def keep_existing_images(
    df: DataFrame, listing: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Drop the images that are not in `listing`; examples stay, with an empty list if need be.

    `listing` has the paths that count as existing; see `readable_images` for those that can be
    opened. Only key, position and reference take part in the lookup. The messages are shuffled once,
    when the kept lists join back. `key` must be unique; NULL is a key like any other.
    """
    refs = df.select(key, F.posexplode("images").alias("pos", "path"))
    present = listing.select("path").distinct().withColumn("found", F.lit(True))
    found = salted_left_join(refs, present, "path", [key, "pos"], rows_per_task)
    kept = (
        found.where("found")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "path"))).alias("kept"))
        .select(F.col(key).alias("_key"), F.col("kept.path").alias("_kept"))
    )
    empty = F.array().cast("array<string>")
    joined = df.join(kept, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("images", F.coalesce("_kept", empty)).drop("_key", "_kept")


def attach_image_bytes(df: DataFrame, spread_by: list[str], strict: bool = False) -> DataFrame:
    """Replace the path in `image` by struct(path, bytes), and say in `image_reason` why there are none.

    The bytes are read from storage by the task that holds the row: they go through no join and
    no shuffle, and nothing is listed. Only the rows are dealt out, by ranges of the reference and
    then of a hash of `spread_by`, and sorted by reference: an image of many rows is read once per
    task that has it, and a reference that a third of the rows share is dealt over as many tasks.
    Rows without bytes stay, with their reason (see `rejects`); strict mode raises if there is one.
    """
    order = [F.col("image"), F.xxhash64(*spread_by)]
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    attached = read_files(dealt, "image", "_bytes", "image_reason")
    if strict:
        first = attached.where("image_reason is not null").select("image_reason").take(1)
        if first:
            raise FileNotFoundError(first[0]["image_reason"])
    return attached.withColumn("image", F.struct(F.col("image").alias("path"), F.col("_bytes").alias("bytes"))).drop("_bytes")


def attach_media(batches: DataFrame, images: str = "images", media: str = "media") -> DataFrame:
    """Add to collated batches the files behind their references: a nested column of the same form,
    a list per row of struct(path, bytes), in the order of the references.

    Read by reference after batching, by the task that holds the batch, so no image is shuffled
    with the ids. One batch at a time is in memory, each of its files once. Bytes are NULL where a
    file cannot be read.
    """
    if media in batches.columns:
        raise ValueError(f"column is there already: {media}")
    file = T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.BinaryType())])
    schema = T.StructType([*batches.schema.fields, T.StructField(media, T.ArrayType(T.ArrayType(file)))])
    kind = pa.list_(pa.list_(pa.struct([("path", pa.string()), ("bytes", pa.binary())])))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(part.num_rows):
                row = part.slice(at, 1)
                lists = row[images].to_pylist()[0]
                found = {ref: read_file(ref)[0] for refs in lists or [] for ref in refs or []}
                files = None if lists is None else [None if refs is None else [{"path": r, "bytes": found[r]} for r in refs] for refs in lists]
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([files], kind)], [*row.schema.names, media])

    return batches.mapInArrow(read, schema)


def netpbm_decoder() -> Callable[[bytes], np.ndarray]:
    """A decoder factory for binary PGM, PPM and PAM files with one byte per sample."""

    def decode(data: bytes) -> np.ndarray:
        if data[:2] == b"P7":
            head, _, body = data.partition(b"ENDHDR\n")
            fields = dict(line.split(None, 1) for line in head.split(b"\n")[1:] if b" " in line)
            width, height, channels, most = (int(fields[k]) for k in (b"WIDTH", b"HEIGHT", b"DEPTH", b"MAXVAL"))
        else:
            head = _PNM_HEAD.match(data)
            channels = {b"P5": 1, b"P6": 3}[head[1]]
            width, height, most = map(int, head.groups()[1:])
            body = data[head.end() :]
        if most != 255:
            raise ValueError("more than one byte per sample")
        return np.frombuffer(body, np.uint8, height * width * channels).reshape(height, width, channels)

    return decode


def decode_images(files: DataFrame, factory: Callable[[], Callable[[bytes], np.ndarray]] = netpbm_decoder) -> DataFrame:
    """Pixels of read files (path, content, reason): (path, height, width, data, reason), data in RGB.

    `factory` builds a user's decoder, bytes to a (height, width, 1, 3 or 4) byte array in the order
    red, green, blue, alpha; it is called once per worker. What it raises on goes on without
    pixels and with a reason, as do files that were not read.
    """
    build = per_worker(factory)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = build()

        def one(path: str, content: bytes | None, reason: str | None) -> tuple:
            if content is None:
                return path, None, None, None, reason
            try:
                pixels = decode(content)
                height, width, channels = pixels.shape
                rgb = to_rgb(pixels if channels == 1 else pixels[:, :, [2, 1, 0, 3][:channels]])
            except Exception:  # noqa: BLE001  (a user's decoder may raise anything on a broken file)
                return path, None, None, None, f"not an image: {path}"
            return path, height, width, rgb.tobytes(), None

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                values = one(*(row[c][0].as_py() for c in ("path", "content", "reason")))
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string())
                columns = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["path", "height", "width", "data", "reason"])

    return files.select("path", "content", "reason").mapInArrow(convert, f"{RGB_SCHEMA}, reason string")


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """RGB array of one decoded image (stored as gray, BGR or BGRA); alpha goes on white, a strip
    of rows at a time."""
    channels = pixels.shape[2]
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    color = pixels[:, :, 2::-1]
    if channels == 3:
        return color
    out = np.empty((*pixels.shape[:2], 3), np.uint8)
    for top in range(0, len(pixels), STRIP):
        alpha = pixels[top : top + STRIP, :, 3:].astype(np.uint32)
        out[top : top + STRIP] = (color[top : top + STRIP] * alpha + 255 * (255 - alpha) + 127) // 255
    return out


def _rgb_pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return to_rgb(np.frombuffer(data, np.uint8).reshape(height, width, channels))


def readable_images(listing: DataFrame, decoder: Callable[[], Callable[[bytes], np.ndarray]] = netpbm_decoder) -> DataFrame:
    """(path) of the listed files that are there and can be decoded.

    As the listing of `keep_existing_images` it drops unreadable images as well as missing ones.
    Each distinct file is opened once, by a task; pixels go no further.
    """
    files = in_reading_tasks(listing.select("path").distinct(), "path", IMAGES_PER_TASK)
    return decode_images(read_files(files), decoder).where("reason is null").select("path")


def images_to_rgb(images: DataFrame) -> DataFrame:
    """Three-channel pixels of decoded images; data is NULL where the image was unreadable."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rgb = [
                _rgb_pixels(r["data"], r["height"], r["width"], r["channels"]).tobytes() if r["height"] > 0 else None
                for r in batch.select(["height", "width", "channels", "data"]).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["path"], batch["height"], batch["width"], pa.array(rgb, pa.binary())],
                ["path", "height", "width", "data"],
            )

    return images.mapInArrow(convert, RGB_SCHEMA)


def _cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution kernel with a = -0.5, as in Keys (1981)."""
    x = np.abs(x)
    near = (1.5 * x - 2.5) * x * x + 1.0
    far = ((-0.5 * x + 2.5) * x - 4.0) * x + 2.0
    return np.where(x < 1.0, near, np.where(x < 2.0, far, 0.0))


def _taps(old: int, size: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """How `size` places along an axis are made from `old`: for each tap the source place and weight
    of every new place, and the sum of the weights. The kernel widens where the image shrinks."""
    scale = old / size
    stretch = max(scale, 1.0)
    center = (np.arange(size) + 0.5) * scale
    first = np.floor(center - 2.0 * stretch).astype(np.int64)
    taps, weight_sum = [], np.zeros(size)
    for tap in range(int(np.ceil(4.0 * stretch)) + 1):
        source = first + tap
        weight = _cubic((source + 0.5 - center) / stretch) * ((source >= 0) & (source < old))
        taps.append((np.clip(source, 0, old - 1), weight[:, None, None]))
        weight_sum += weight
    return taps, weight_sum[:, None, None]


def _resample_first(pixels: np.ndarray, taps: list[tuple[np.ndarray, np.ndarray]], weight_sum: np.ndarray) -> np.ndarray:
    """Resample the first axis of a strip to bytes."""
    total = np.zeros((len(weight_sum), *pixels.shape[1:]))
    for source, weight in taps:
        total += weight * pixels[source]
    return np.clip(np.rint(total / weight_sum), 0, 255)


def resample(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bicubic resize of a (height, width, channels) byte array, columns first.

    Works in strips of STRIP rows, then of STRIP columns, with weights computed once; between the
    two the image is bytes. So besides input, output and one image between, only a strip is there.
    """
    old_height, old_width, channels = pixels.shape
    taps, weight_sum = _taps(old_width, width)
    across = np.empty((old_height, width, channels), np.uint8)
    for top in range(0, old_height, STRIP):
        strip = pixels[top : top + STRIP].transpose(1, 0, 2)
        across[top : top + STRIP] = _resample_first(strip, taps, weight_sum).transpose(1, 0, 2)
    taps, weight_sum = _taps(old_height, height)
    out = np.empty((height, width, channels), np.uint8)
    for left in range(0, width, STRIP):
        out[:, left : left + STRIP] = _resample_first(across[:, left : left + STRIP], taps, weight_sum)
    return out


def images_resize(
    rgb: DataFrame, suffix: str = "resized", bounds: PixelBounds = CONVERSION, plan: Column | None = None
) -> DataFrame:
    """RGB images at their planned size under their derived path.

    The plan is computed as columns; only pixels go through Arrow. `plan` replaces the default
    one where rows have bounds or requested sides of their own. Size and data are NULL where the
    image was unreadable or its sides cannot be planned. If `rgb` has a `reason`, so has the result:
    its own, or that the sides cannot be planned.
    """
    has_reason = "reason" in rgb.columns
    if plan is None:
        plan = resize_plan(F.col("height"), F.col("width"), F.lit(bounds.min_pixels), F.lit(bounds.max_pixels))
    planned = rgb.select(
        "path",
        derive_resized_path(F.col("path"), suffix).alias("derived_path"),
        "height",
        "width",
        plan["height"].cast("int").alias("new_height"),
        plan["width"].cast("int").alias("new_width"),
        "data",
        *([F.coalesce("reason", F.when(plan.isNull(), ASPECT_RATIO)).alias("reason")] if has_reason else []),
    )

    def resized(row: dict) -> bytes | None:
        if row["data"] is None or row["new_height"] is None:
            return None
        pixels = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], 3)
        return resample(pixels, row["new_height"], row["new_width"]).tobytes()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1) for b in batches for at in range(b.num_rows)):
            data = pa.array([resized(row) for row in batch.to_pylist()], pa.binary())
            columns = [batch["path"], batch["derived_path"], batch["new_height"], batch["new_width"], data]
            names = ["path", "derived_path", "height", "width", "data"]
            if has_reason:
                columns, names = [*columns, batch["reason"]], [*names, "reason"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return planned.mapInArrow(convert, f"{RESIZED_SCHEMA}, reason string" if has_reason else RESIZED_SCHEMA)


def resized_files(
    paths: DataFrame,
    decoder: Callable[[], Callable[[bytes], np.ndarray]] = netpbm_decoder,
    suffix: str = "resized",
    bounds: PixelBounds = CONVERSION,
    sizes: dict[str, Column] | None = None,
) -> DataFrame:
    """Read, decode and resize the files of `paths` (path): (path, derived_path, height, width, data, reason).

    Only these files are opened, each by the task that resizes it. `sizes` are the columns
    plan_height, plan_width, plan_min and plan_max of `requested_size`, computed from the other
    columns of `paths`, for images with bounds or sides of their own; those columns must be one
    value per path. A file that cannot be used has a reason and no pixels.
    """
    rgb = decode_images(read_files(in_reading_tasks(paths.select("path"), "path", IMAGES_PER_TASK)), decoder)
    if sizes is None:
        return images_resize(rgb, suffix, bounds)
    wanted = rgb.join(paths, "path").withColumns(sizes)
    plan = resize_plan(*(F.col(c) for c in ("plan_height", "plan_width", "plan_min", "plan_max")))
    return images_resize(wanted, suffix, bounds, plan)
