"""Onboarding data quality: duplicate detection, image gates per request, set-oriented upsert."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doorledger.functions.events import stable_uuid
from doorledger.functions.outcomes import face_reject_reason
from doorledger.operators.components import components
from doorledger.session import settled

#: registrations of one component that a task goes through by itself
LARGEST = 1_000_000


def requested_images(requests: DataFrame, key: str = "request_id",
                     paths: str = "image_paths") -> DataFrame:
    """(key, pos, path): each image with its 0-based place in the upload."""
    return requests.select(key, F.posexplode(paths).alias("pos", "path"))


def gate_images(images: DataFrame, detections: DataFrame, key: str = "request_id") -> DataFrame:
    """Each image with ``reject_reason`` (null when accepted), prefixed by its path.

    An image without a detection row could not be read.
    """
    seen = detections.select(key, "pos", "faces", F.lit(True).alias("_seen"))
    reason = F.when(F.col("_seen").isNull(), "download failed").otherwise(
        face_reject_reason("faces"))
    return images.join(seen, [key, "pos"], "left").select(
        *images.columns, F.when(reason.isNotNull(), F.concat("path", F.lit(": "), reason))
        .alias("reject_reason"))


def request_passes(gated: DataFrame, key: str = "request_id") -> DataFrame:
    """Per request: accepted and total images, the first reason, and whether it passes.

    All reasons stay rows of the gated images, so no request has to fit into one value.
    """
    ok = F.col("reject_reason").isNull()
    return (gated.groupBy(key).agg(
        F.count_if(ok).alias("accepted"), F.count(F.lit(1)).alias("total"),
        F.min_by("path", F.when(ok, F.col("pos"))).alias("first_accepted"),
        F.min_by("reject_reason", F.when(~ok, F.col("pos"))).alias("first_reason"))
        .withColumn("passes", F.col("accepted") >= 1))


def duplicate_users(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Requests whose username or email is already taken: two equi semi joins, not one OR."""
    by_name = requests.join(users.select("username"), "username", "left_semi")
    by_mail = requests.join(users.select("email"), "email", "left_semi")
    rest = by_mail.join(users.select("username"), "username", "left_anti")
    return by_name.select(*requests.columns).unionByName(rest.select(*requests.columns))


def ambiguous_requests(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Requests whose username and email belong to two different users."""
    named = users.select("username", F.col("id").alias("id_by_username"))
    mailed = users.select("email", F.col("id").alias("id_by_email"))
    return (requests.join(named, "username").join(mailed, "email")
            .where(F.col("id_by_username") != F.col("id_by_email")))


def _without(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows that share neither username nor email with ``taken``."""
    return (rows.join(taken.select("username"), "username", "left_anti")
            .join(taken.select("email"), "email", "left_anti"))


def _new_users(registrations: DataFrame, users: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Registrations that insert a row when all are applied one after the other by ``seq``.

    A registration inserts if no user and no earlier inserting registration shares its
    username or email. Who shares nothing inserts at once. The others fall into components over
    names and addresses, and each is gone through in order of ``seq`` by one task's stream, so
    the number of jobs does not grow with the length of a chain. Components above ``largest``
    registrations are settled in rounds instead.
    """
    def alone(c: str) -> Column:  # a missing name or address is shared with nobody
        return F.coalesce(F.col(c), F.concat(F.lit("\0"), F.col("seq").cast("string"))).alias(c)

    free = _without(registrations.select("seq", alone("username"), alone("email")), users)
    # of registrations that are alike in both, only the first can insert
    firsts = settled(free.groupBy("username", "email").agg(F.min("seq").alias("seq")))
    shared = [firsts.groupBy(c).agg(F.count(F.lit(1)).alias(f"_{c}")).where(F.col(f"_{c}") > 1) for c in ("username", "email")]
    marked = (firsts.join(shared[0], "username", "left").join(shared[1], "email", "left")
              .select("seq", "username", "email", (F.col("_username").isNotNull() | F.col("_email").isNotNull()).alias("_shares")))
    marked = settled(marked)
    single = marked.where(~F.col("_shares")).drop("_shares")
    meeting = marked.where("_shares").drop("_shares")
    if meeting.isEmpty():
        return single
    node = F.concat(F.lit("n"), "username")
    linked = components(meeting.select(node.alias("src"), F.concat(F.lit("m"), "email").alias("dst")))
    grouped = settled(meeting.join(linked.withColumnRenamed("node", "_n"), node == F.col("_n")).drop("_n"))
    giant = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > largest).select("component")
    giant = settled(giant)
    won = single.unionByName(_in_turn(grouped.join(giant, "component", "left_anti")))
    if giant.isEmpty():
        return won
    return won.unionByName(_in_rounds(grouped.join(giant, "component", "left_semi").drop("component")))


def _in_turn(grouped: DataFrame) -> DataFrame:
    """The inserting rows of each component, taken by ``seq``; names and addresses of one component are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component, names, mails = None, set(), set()
        for b in batches:
            keep = []
            for i, (c, name, mail) in enumerate(zip(*(b[x].to_pylist() for x in ("component", "username", "email")), strict=True)):
                if c != component:
                    component, names, mails = c, set(), set()
                if name not in names and mail not in mails:
                    names.add(name)
                    mails.add(mail)
                    keep.append(i)
            yield b.take(pa.array(keep, pa.int64())).select(["seq", "username", "email"])

    schema = StructType([grouped.schema[c] for c in ("seq", "username", "email")])
    rows = grouped.select("component", "seq", "username", "email").repartition("component")
    return rows.sortWithinPartitions("component", "seq").mapInArrow(run, schema)


def _in_rounds(pending: DataFrame) -> DataFrame:
    """The inserting rows, without holding a component anywhere.

    Each round settles, without pairing rows, those that come first for both
    their username and their email, and drops the ones they make into updates.
    """
    won: DataFrame | None = None
    while won is None or not pending.isEmpty():
        first_name = pending.groupBy("username").agg(F.min("seq").alias("seq"))
        first_mail = pending.groupBy("email").agg(F.min("seq").alias("seq"))
        winners = settled(first_name.join(first_mail, "seq").select("seq", "username", "email"))
        won = winners if won is None else won.unionByName(winners)
        pending = settled(_without(pending, winners))
    return won


def upsert_users(users: DataFrame, registrations: DataFrame, now: str | Column) -> DataFrame:
    """Next snapshot of ``users`` after all registrations, in order of their unique ``seq``.

    A registration (seq, username, email, full_name, face_embedding) updates name, embedding
    and ``updated_at`` of every user with its username or email; without one it inserts a user.
    The last registration that matches a user decides its values.
    """
    at = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    added = _new_users(registrations, users)
    # at most one row each: the ids and the sequence span to go on from
    top = users.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    low = registrations.agg(F.coalesce(F.min("seq"), F.lit(0))).first()[0]
    rows = added.select("seq").join(
        registrations.select("seq", "username", "email", "full_name", "face_embedding"), "seq")
    everyone = users.unionByName(rows.select(
        (F.col("seq") - F.lit(low) + F.lit(top + 1)).cast("bigint").alias("id"),
        stable_uuid(F.lit("user"), "seq", "username", "email").alias("uuid"),
        "email", "username", "full_name", "face_embedding",
        at.alias("created_at"), at.alias("updated_at")))
    value = F.max(F.struct("seq", "full_name", "face_embedding"))
    by_name = registrations.groupBy("username").agg(value.alias("_by_name"))
    by_mail = registrations.groupBy("email").agg(value.alias("_by_mail"))
    last = F.greatest("_by_name", "_by_mail")
    hit = F.col("_last").isNotNull()
    joined = (everyone.join(by_name, "username", "left").join(by_mail, "email", "left")
              .withColumn("_last", last))
    return joined.select(*[
        F.when(hit, F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c)
        if c in ("full_name", "face_embedding")
        else F.when(hit, at).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.col(c) for c in users.columns])


def predictions_with_users(predictions: DataFrame, users: DataFrame) -> DataFrame:
    """Predictions with the matched user's name columns; unmatched ones are kept."""
    who = users.select(F.col("id").alias("user_id"), "username", "email", "full_name")
    return predictions.join(who, "user_id", "left")


def verify_registration(expected: DataFrame, matches: DataFrame,
                        key: str = "request_id") -> DataFrame:
    """Does the predicted id equal the registered one, compared as text?"""
    want = F.col("user_id").cast("string")
    got = F.col("match_id").cast("string")
    return (expected.select(key, "user_id").join(matches.select(key, "match_id", "score"), key)
            .withColumn("verified", want.eqNullSafe(got)))
