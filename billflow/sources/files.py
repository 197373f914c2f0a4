"""Bill files: listing, admission by MIME type, and data URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# MIME type by file extension.
MIME_BY_EXTENSION = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "webp": "image/webp",
    "gif": "image/gif",
    "bmp": "image/bmp",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "heic": "image/heic",
    "avif": "image/avif",
    "svg": "image/svg+xml",
    "pdf": "application/pdf",
}
UNKNOWN_MIME = "application/octet-stream"
# The refusal text.
NOT_AN_IMAGE = "Please upload an image file."


def mime_type(file: Column) -> Column:
    extension = F.lower(F.regexp_extract(file, r"\.([A-Za-z0-9]+)\z", 1))
    known = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension), F.lit(UNKNOWN_MIME))


def scan_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """One row per file of any kind (``admit_images`` says which are refused, and why); the bytes are
    read only if ``content`` is selected."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", "true").load(directory)
    name = F.regexp_extract("path", r"([^/]+)\z", 1)
    return found.select("path", name.alias("file_name"), mime_type(name).alias("mime"),
                        "modificationTime", "length", "content")


def admit_images(files: DataFrame, mime: str = "mime") -> DataFrame:
    """Marks files that are not images with a reason; no file is dropped."""
    return files.withColumn("error", F.when(
        ~F.coalesce(F.col(mime).startswith("image/"), F.lit(False)), NOT_AN_IMAGE))


def encode_data_url(mime: Column, content: Column) -> Column:
    """``data:<mime>;base64,<bytes>`` on one line."""
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"),
                    F.regexp_replace(F.base64(content), r"[\r\n]", ""))


def data_url_mime(url: Column) -> Column:
    return F.split_part(F.split_part(url, F.lit(";"), F.lit(1)), F.lit(":"), F.lit(2))


def data_url_base64(url: Column) -> Column:
    return F.split_part(url, F.lit(","), F.lit(2))


def rebuild_data_url(url: Column) -> Column:
    return F.concat(F.lit("data:"), data_url_mime(url), F.lit(";base64,"), data_url_base64(url))
