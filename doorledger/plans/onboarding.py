"""Onboarding: many requests per run, rejections returned as rows instead of raised."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.functions.outcomes import fixed_decimals, request_reject_reason
from doorledger.operators import features, onboarding, pooling, similarity
from doorledger.session import settled


def _reject(rows: DataFrame, stage: str, reason) -> DataFrame:
    return rows.select("request_id", F.lit(stage).alias("stage"), reason.alias("reason"))


class Onboarded:
    """The results of a run. Each is worked out when it is first asked for, from stages settled once:
    flags per image, one verdict and one vector per request, the next users table."""

    def __init__(self, requests: DataFrame, detections: DataFrame, embeddings: DataFrame, users: DataFrame, now: str,
                 threshold: float | None, max_distance: float):
        self._checked = requests.withColumn("_reason", request_reject_reason())
        self._complete = self._checked.where(F.col("_reason").isNull()).drop("_reason")
        self._detections, self._embeddings, self._users = detections, embeddings, users
        self._now, self._threshold, self._max_distance = now, threshold, max_distance

    @cached_property
    def images(self) -> DataFrame:
        """Every image with its reject_reason."""
        return settled(onboarding.gate_images(onboarding.requested_images(self._complete), self._detections))

    @cached_property
    def _passes(self) -> DataFrame:
        return onboarding.request_passes(self.images)

    @cached_property
    def _usable(self) -> DataFrame:
        accepted = self.images.where(F.col("reject_reason").isNull()).select("request_id", "pos")
        return (self._embeddings.where(F.col("embedding").isNotNull())
                .join(accepted, ["request_id", "pos"], "left_semi"))

    @cached_property
    def _verdict(self) -> DataFrame:
        return settled(pooling.same_person(self._usable, max_distance=self._max_distance))

    @cached_property
    def rejected(self) -> DataFrame:
        """request_id, stage, reason."""
        out = _reject(self._checked.where(F.col("_reason").isNotNull()), "request", F.col("_reason"))
        out = out.unionByName(_reject(
            self._passes.where(~F.col("passes")), "faces",
            F.concat(F.lit("Only 0 images passed face detection (need >= 1). First: "),
                     F.col("first_reason"))))
        none = (self._passes.where("passes")
                .join(self._verdict.select("request_id"), "request_id", "left_anti"))
        out = out.unionByName(_reject(
            none, "embedding", F.lit("Only 0 embeddings extracted (need >= 1)")))
        mixed = self._verdict.where(~F.col("same_person"))
        # images are named by their place among the request's usable embeddings
        place = (self._usable.join(mixed, "request_id").groupBy("request_id", "distance").agg(
            F.count_if(F.col("pos") < F.col("first_i")).alias("i"),
            F.count_if(F.col("pos") < F.col("first_j")).alias("j")))
        return out.unionByName(_reject(place, "person", F.concat(
            F.format_string("Images %d and %d may not be the same person (cosine_distance=", "i", "j"),
            fixed_decimals(F.col("distance"), 4), F.lit(f" > {self._max_distance})"))))

    @cached_property
    def _same(self) -> DataFrame:
        return self._verdict.where("same_person").select("request_id")

    @cached_property
    def _registered(self) -> DataFrame:
        pooled = pooling.pool_embeddings(self._usable.join(self._same, "request_id", "left_semi"))
        return settled(pooled.join(self._complete, "request_id"))

    @cached_property
    def registered(self) -> DataFrame:
        """request_id, user_id, embedding, images."""
        return self._registered.select("request_id", "user_id", "embedding", "images")

    @cached_property
    def users(self) -> DataFrame:
        """The next snapshot of the users table."""
        rows = self._registered.select("seq", "username", "email", "full_name",
                                       F.to_json("embedding").alias("face_embedding"))
        return settled(onboarding.upsert_users(self._users, rows, self._now))

    @cached_property
    def features(self) -> DataFrame:
        """Feature rows to push."""
        return features.embedding_rows(self._registered, "user_id", self._now)

    @cached_property
    def verified(self) -> DataFrame:
        """request_id, user_id, match_id, score, verified: the first accepted image must find its own user."""
        first = (self._usable.join(self._same, "request_id", "left_semi").groupBy("request_id")
                 .agg(F.min_by("embedding", "pos").alias("embedding")))
        gallery = features.users_to_features(self.users).select(
            F.col("employee_id").alias("match_id"), "embedding")
        found = similarity.best_match(first, gallery, self._threshold, query_id="request_id").select(
            F.col("query_id").alias("request_id"), "match_id", "score")
        return onboarding.verify_registration(
            self._registered.select("request_id", "user_id"), found)


def run_onboarding(requests: DataFrame, detections: DataFrame, embeddings: DataFrame,
                   users: DataFrame, now: str, threshold: float | None = None,
                   max_distance: float = pooling.MAX_DISTANCE) -> Onboarded:
    """requests: request_id, seq, user_id, username, email, full_name, image_paths;
    detections: request_id, pos, faces; embeddings: request_id, pos, embedding."""
    return Onboarded(requests, detections, embeddings, users, now, threshold, max_distance)
