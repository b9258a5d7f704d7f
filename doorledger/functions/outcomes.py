"""Gates and outcomes decided row by row, each as an ordered chain of conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doorledger.functions.events import ANONYMOUS

# fixed values of the onboarding and upload rules
MIN_FACE_CONFIDENCE = 0.90
MIN_FACE_SIDE = 80
MAX_IMAGE_MB = 10
IMAGE_TYPES = ("image/jpeg", "image/jpg", "image/png")


def upload_reject_reason(content_type: Column | str, size_bytes: Column | str,
                         max_mb: int = MAX_IMAGE_MB) -> Column:
    """First failing upload rule, null when accepted."""
    ctype = F.col(content_type) if isinstance(content_type, str) else content_type
    size = F.col(size_bytes) if isinstance(size_bytes, str) else size_bytes
    return (F.when(~F.coalesce(ctype.isin(*IMAGE_TYPES), F.lit(False)),
                   "Invalid file type. Only JPEG and PNG are supported.")
            .when(size > max_mb * 1024 * 1024,
                  f"File too large. Maximum size is {max_mb}MB."))


def request_reject_reason(user_id: str = "user_id", username: str = "username",
                          email: str = "email", full_name: str = "full_name",
                          image_paths: str = "image_paths") -> Column:
    """First failing rule for an onboarding request, null when complete."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
             for c in (user_id, username, email, full_name)]
    n = F.coalesce(F.size(image_paths), F.lit(0))
    n = F.when(F.col(image_paths).isNull(), 0).otherwise(n)
    return (F.when(blank[0] | blank[1] | blank[2] | blank[3],
                   "Missing required fields: user_id, username, email, full_name")
            .when(n < 1, F.concat(F.lit("Need at least 1 image, got "), n.cast("string"))))


def first_face(boxes: Column | str, probs: Column | str,
               min_probability: float = MIN_FACE_CONFIDENCE) -> Column:
    """Serving rule: the first box, or null when there is none or it is too uncertain.

    ``boxes`` holds corner coordinates (left, top, right, bottom); width and height
    are truncated after subtracting.
    """
    box = F.get(boxes, 0)
    p = F.get(probs, 0)
    x1, y1, x2, y2 = (F.get(box, i) for i in range(4))
    return F.when(box.isNotNull() & (p >= min_probability), F.struct(
        x1.cast("int").alias("x"), y1.cast("int").alias("y"),
        (x2 - x1).cast("int").alias("w"), (y2 - y1).cast("int").alias("h"),
        p.cast("double").alias("confidence")))


def fixed_decimals(x: Column, digits: int) -> Column:
    """A non-negative double as text with ``digits`` decimals, rounded by its exact value.

    ``format_string`` rounds the shortest decimal form half up (0.6675 gives 0.668, though the
    double lies below that). Here the product with the power of ten is kept exactly, as a
    rounded part and its error, before it is rounded half to even.
    """
    power = 10 ** digits
    scaled = x * float(power)
    wide = x * 134217729.0  # 2^27 + 1 splits a double into two halves
    high = wide - (wide - x)
    error = (high * float(power) - scaled) + (x - high) * float(power)
    whole = F.floor(scaled)
    over = (scaled - whole - 0.5) + error  # how far beyond the midpoint
    n = (F.when(over < 0, whole).when(over > 0, whole + 1)
         .otherwise(whole + F.pmod(whole, F.lit(2)))).cast("bigint")
    return F.concat(F.floor(n / power).cast("string"), F.lit("."),
                    F.lpad(F.pmod(n, F.lit(power)).cast("string"), digits, "0"))


def face_reject_reason(faces: Column | str) -> Column:
    """Onboarding rule for one image's detections: first failing rule, null when accepted."""
    faces = F.col(faces) if isinstance(faces, str) else faces
    n = F.when(faces.isNull(), 0).otherwise(F.size(faces))
    sure = F.filter(faces, lambda f: f["confidence"] >= MIN_FACE_CONFIDENCE)
    face = F.when(n > 1, F.get(sure, 0)).otherwise(F.get(faces, 0))
    return (F.when(n == 0, "no face detected")
            .when((n > 1) & (F.size(sure) != 1),
                  F.format_string("expected 1 face, found %d (high-confidence)", F.size(sure)))
            .when(face["confidence"] < MIN_FACE_CONFIDENCE,
                  F.concat(F.lit("face confidence too low ("),
                           fixed_decimals(face["confidence"], 3),
                           F.lit(f" < {MIN_FACE_CONFIDENCE})")))
            .when((face["w"] < MIN_FACE_SIDE) | (face["h"] < MIN_FACE_SIDE),
                  F.format_string(f"face too small (%dx%d < {MIN_FACE_SIDE}x{MIN_FACE_SIDE})",
                                  face["w"], face["h"])))


def prediction_status(face_found: Column | str, has_embedding: Column | str,
                      matched: Column | str, error: Column | str | None = None) -> Column:
    """no_face, error, success or no_match, tested in that order after a raised error."""
    face = F.col(face_found) if isinstance(face_found, str) else face_found
    emb = F.col(has_embedding) if isinstance(has_embedding, str) else has_embedding
    hit = F.col(matched) if isinstance(matched, str) else matched
    err = F.lit(None) if error is None else (F.col(error) if isinstance(error, str) else error)
    return (F.when(err.isNotNull(), "error")
            .when(~F.coalesce(face, F.lit(False)), "no_face")
            .when(~F.coalesce(emb, F.lit(False)), "error")
            .when(F.coalesce(hit, F.lit("")) != "", "success")
            .otherwise("no_match"))


def log_user(matched: Column | str) -> Column:
    """The user an event is logged under: the match, else anonymous."""
    hit = F.col(matched) if isinstance(matched, str) else matched
    return F.when(F.coalesce(hit, F.lit("")) != "", hit).otherwise(ANONYMOUS)


def response_message(status: Column | str, matched: Column | str) -> Column:
    status = F.col(status) if isinstance(status, str) else status
    hit = F.col(matched) if isinstance(matched, str) else matched
    return (F.when(status == "success", F.concat(F.lit("Match found: "), hit))
            .when(status == "no_match", "No match found")
            .when(status == "no_face", "No face detected in image")
            .otherwise("Failed to extract face embedding"))
