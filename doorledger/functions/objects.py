"""Object-store names: parsing and building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_S3 = "^s3://([^/]*)/?(.*)$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_object_uri(uri: Column | str, default_bucket: str) -> Column:
    """``s3://bucket/key`` to (bucket, key); anything else is a key in the default bucket."""
    uri = _c(uri)
    full = uri.startswith("s3://")
    return F.struct(
        F.when(full, F.regexp_extract(uri, _S3, 1)).otherwise(F.lit(default_bucket))
        .alias("bucket"),
        F.when(full, F.regexp_extract(uri, _S3, 2)).otherwise(uri).alias("key"))


def file_extension(name: Column | str, default: str = "jpg") -> Column:
    """Text after the last dot, or the default for a name without one."""
    name = _c(name)
    return F.when(name.contains("."), F.substring_index(name, ".", -1)).otherwise(default)


def prediction_object_path(ts: Column | str, prediction_id: Column | str) -> Column:
    return F.concat(F.date_format(ts, "'predictions/Year='yyyy'/Month='MM'/'dd'/'"),
                    _c(prediction_id), F.lit(".jpg"))


def onboarding_object_path(username: Column | str, index: Column | str,
                           filename: Column | str) -> Column:
    user = _c(username)
    return F.concat(F.lit("onboarding/"), user, F.lit("/"), user, F.lit("_"),
                    _c(index).cast("string"), F.lit("."), file_extension(filename))
