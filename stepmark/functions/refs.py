"""Image references: prefixes, schemes, data URIs, derived paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder part and name up to the last dot, then the extension; leading dots belong to the name.
_STEM_AND_EXTENSION = r"(?s)^((?:.*/)?\.*[^./][^/]*)(\.[^/.]*)$"


def rewrite_prefix(images: Column, prefix: str, base: str) -> Column:
    """Replace `prefix` by `base/` wherever it occurs; other references stay as they are."""
    return F.transform(images, lambda ref: F.replace(ref, F.lit(prefix), F.lit(base + "/")))


def classify_image_ref(ref: Column) -> Column:
    """http, file, data, path, or unrecognized (a data URI that is not base64)."""
    return (
        F.when(ref.startswith("http://") | ref.startswith("https://"), "http")
        .when(ref.startswith("file://"), "file")
        .when(ref.startswith("data:image"), F.when(ref.contains("base64,"), "data").otherwise("unrecognized"))
        .when(ref.isNotNull(), "path")
    )


def strip_file_scheme(ref: Column) -> Column:
    """A `file://` reference without these seven characters; others unchanged."""
    return F.when(ref.startswith("file://"), F.substring(ref, 8, 2**31 - 1)).otherwise(ref)


def decode_data_uri(ref: Column) -> Column:
    """The bytes after the first `base64,` of an image data URI; NULL for other references."""
    payload = F.substring(ref, F.instr(ref, "base64,") + 7, F.length(ref))
    return F.when(classify_image_ref(ref) == "data", F.unbase64(payload))


def derive_resized_path(path: Column, suffix: str = "resized") -> Column:
    """`dir/name.ext` becomes `dir/name_<suffix>.ext`; without extension the suffix comes last."""
    has_extension = path.rlike(_STEM_AND_EXTENSION)
    stem = F.regexp_extract(path, _STEM_AND_EXTENSION, 1)
    extension = F.regexp_extract(path, _STEM_AND_EXTENSION, 2)
    return F.when(has_extension, F.concat(stem, F.lit(f"_{suffix}"), extension)).otherwise(
        F.concat(path, F.lit(f"_{suffix}"))
    )
