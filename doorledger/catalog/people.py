"""Onboarding, recognition, object-name and generator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from doorledger.catalog.tables import LOGS_SQL, access_logs, table
from doorledger.functions import events as ev
from doorledger.functions import objects as ob
from doorledger.functions import outcomes as oc
from doorledger.operators import features, generate, onboarding, pooling
from doorledger.plans import recognition
from doorledger.plans.onboarding import run_onboarding

NOW = "2024-06-01 00:00:00"


def upload_gate(spark, sf_dir):
    """Pages as uploads; a page's length in 1000-byte units stands for its size."""
    p = table(spark, sf_dir, "pages")
    kind = F.when(F.col("url").contains("ref="), "text/plain").otherwise(
        F.when(F.col("url").contains("page=2"), "image/png").otherwise("image/jpeg"))
    size = F.length("html") * 1000
    return p.select("page_id", F.coalesce(oc.upload_reject_reason(kind, size), F.lit("accepted"))
                    .alias("reason"))


def _faces(e):
    """Detections made from an event: as many faces as its number modulo 4."""
    conf = F.col("value") / 100
    faces = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(
        (conf + i * 0.2).alias("confidence"), F.lit(0).alias("x"), F.lit(0).alias("y"),
        (F.col("event_id") % 90 + 40 + i * 10).cast("int").alias("w"),
        (F.col("event_id") % 70 + 60).cast("int").alias("h")))
    return F.slice(faces, F.lit(1), F.pmod("event_id", F.lit(4)).cast("int"))


def _gated(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    d = e.select(F.col("user_id").alias("request_id"), F.col("event_id").alias("pos"),
                 _faces(e).alias("faces"))
    images = e.select(F.col("user_id").alias("request_id"), F.col("event_id").alias("pos"),
                      F.concat(F.lit("img_"), F.col("event_id").cast("string")).alias("path"))
    return onboarding.gate_images(images, d)


def face_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select("request_id", "pos",
                                        F.coalesce("reject_reason", F.lit("accepted"))
                                        .alias("reason"))


def request_passes(spark, sf_dir):
    return onboarding.request_passes(_gated(spark, sf_dir)).select(
        "request_id", "accepted", "total", "first_accepted", "first_reason")


def detection_gate(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    box = F.array(v, v / 2, v + 40.7, v / 2 + 33.3)
    boxes = F.when(F.col("event_type") != "view", F.array(box, F.array(v, v, v, v)))
    f = oc.first_face(boxes, F.array(v / 50, F.lit(1.0)))
    return e.select("event_id", f.alias("f")).select("event_id", "f.x", "f.y", "f.w", "f.h",
                                                     F.round("f.confidence", 6)
                                                     .alias("confidence"))


def required_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    r = c.select("c_custkey", F.col("c_custkey").cast("string").alias("user_id"),
                 F.col("c_name").alias("username"),
                 F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
                 .otherwise("").alias("email"),
                 F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("full_name"),
                 F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1),
                         F.pmod("c_nationkey", F.lit(3))).alias("image_paths"))
    return r.select("c_custkey", F.coalesce(oc.request_reject_reason(), F.lit("complete"))
                    .alias("reason"))


def _users(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    at = F.lit("2024-01-01").cast("timestamp")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("uuid"),
                    F.concat(F.lit("mail"), F.col("c_custkey").cast("string")).alias("email"),
                    F.col("c_name").alias("username"), F.col("c_mktsegment").alias("full_name"),
                    F.lit("[0.5]").alias("face_embedding"), at.alias("created_at"),
                    at.alias("updated_at"))


def _registrations(spark, sf_dir):
    """Every order registers somebody: by a name or an address that may already exist."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_custkey")
    number = F.lpad(k.cast("string"), 9, "0")
    name = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("new "), number)).otherwise(
        F.concat(F.lit("Customer#"), number))
    mail = F.when(F.col("o_orderpriority") == "1-URGENT",
                  F.concat(F.lit("mail"), (k + 1).cast("string"))).otherwise(
        F.concat(F.lit("other"), k.cast("string")))
    return o.select(F.col("o_orderkey").alias("seq"), name.alias("username"),
                    mail.alias("email"), F.col("o_orderpriority").alias("full_name"),
                    F.concat(F.lit("["), F.col("o_totalprice").cast("string"), F.lit("]"))
                    .alias("face_embedding"))


def duplicate_users(spark, sf_dir):
    d = onboarding.duplicate_users(_registrations(spark, sf_dir), _users(spark, sf_dir))
    return d.select("seq", "username", "email")


def ambiguous_requests(spark, sf_dir):
    d = onboarding.ambiguous_requests(_registrations(spark, sf_dir), _users(spark, sf_dir))
    return d.select("seq", "id_by_username", "id_by_email")


def upsert_users(spark, sf_dir):
    u = onboarding.upsert_users(_users(spark, sf_dir), _registrations(spark, sf_dir), NOW)
    return u.select("username", "email", "full_name", "face_embedding",
                    F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


def users_left_join(spark, sf_dir):
    """Orders as predictions; those below a price matched nobody."""
    o = table(spark, sf_dir, "orders")
    p = o.select(F.col("o_orderkey").alias("id"),
                 F.when(F.col("o_totalprice") > 100_000, F.col("o_custkey")).alias("user_id"))
    j = onboarding.predictions_with_users(p, _users(spark, sf_dir))
    return j.select("id", "user_id", "username", "email")


def verify_registration(spark, sf_dir):
    """Does each customer's order find the customer with the same number as the order?"""
    o = table(spark, sf_dir, "orders")
    want = o.select(F.col("o_orderkey").alias("request_id"),
                    F.col("o_custkey").cast("string").alias("user_id"))
    got = o.select(F.col("o_orderkey").alias("request_id"), F.pmod("o_orderkey", F.lit(1000))
                   .alias("match_id"), F.col("o_totalprice").alias("score"))
    v = onboarding.verify_registration(want, got)
    return v.select("request_id", F.col("verified").cast("int").alias("verified"))


def _recognised(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    g = pooling.pool_embeddings(e, "label", "vec_id").select(
        (F.col("label") + 1).cast("bigint").alias("match_id"), "embedding")
    reqs = e.select(
        F.col("vec_id").cast("string").alias("prediction_id"),
        (F.lit("2024-01-01").cast("timestamp")
         + F.make_dt_interval(mins=F.col("vec_id").cast("int"))).alias("ts"),
        F.when(F.col("label") != 0, F.array(F.array(*[F.lit(float(x)) for x in (1, 2, 51, 62)])))
        .alias("boxes"),
        F.array(F.lit(0.95)).alias("probs"),
        F.when(F.col("label") != 1, F.col("embedding")).alias("embedding"),
        F.lit("10.0.0.1").alias("source_ip"), F.lit(12.5).alias("processing_time_ms"),
        F.when(F.col("label") == 2, "broken").alias("error"))
    return recognition.bulk_recognition(reqs, g, 0.25)


def bulk_recognition(spark, sf_dir):
    return _recognised(spark, sf_dir).select("prediction_id", "status", "matched_user",
                                             F.round("confidence", 6).alias("confidence"),
                                             "message")


def recognition_predictions(spark, sf_dir):
    return recognition.recognition_predictions(_recognised(spark, sf_dir)).select(
        "uuid", "user_id", "image_path", "status", "meta_data")


def recognition_logs(spark, sf_dir):
    logs = recognition.recognition_logs(_recognised(spark, sf_dir))
    back = ev.log_events(logs.select("value"))
    return back.select("prediction_id", "user_id", "action", "source_ip", "prediction_status",
                       F.round("confidence", 6).alias("confidence"), "timestamp")


def _onboarded(spark, sf_dir):
    """Each vector as a request with one image; a label's requests are for the same person."""
    e = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("string")
    ident = F.col("vec_id").cast("string")
    reqs = e.select(
        ident.alias("request_id"), F.col("vec_id").alias("seq"), label.alias("user_id"),
        F.concat(F.lit("user "), label).alias("username"),
        F.when(F.get("embedding", 0) > -0.15, F.concat(F.lit("mail "), label)).alias("email"),
        F.concat(F.lit("by "), ident).alias("full_name"),
        F.array(F.concat(F.lit("img_"), ident)).alias("image_paths"))
    sure = (F.get("embedding", 1) + 0.95).cast("double")
    face = F.struct(sure.alias("confidence"), F.lit(0).alias("x"), F.lit(0).alias("y"),
                    F.lit(100).alias("w"), F.lit(100).alias("h"))
    dets = e.select(ident.alias("request_id"), F.lit(0).alias("pos"), F.array(face).alias("faces"))
    embs = e.select(ident.alias("request_id"), F.lit(0).alias("pos"),
                    F.when(F.get("embedding", 2) < 0.15, F.col("embedding")).alias("embedding"))
    at = F.lit("2024-01-01").cast("timestamp")
    users = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("uuid"),
        F.concat(F.lit("mail "), F.col("r_regionkey").cast("string")).alias("email"),
        F.concat(F.lit("user "), F.col("r_regionkey").cast("string")).alias("username"),
        F.lit("old").alias("full_name"), F.lit(None).cast("string").alias("face_embedding"),
        at.alias("created_at"), at.alias("updated_at"))
    return run_onboarding(reqs, dets, embs, users, NOW)


def onboarding_rejected(spark, sf_dir):
    r = _onboarded(spark, sf_dir).rejected
    return r.select("request_id", "stage")


def onboarding_users(spark, sf_dir):
    u = _onboarded(spark, sf_dir).users
    first = F.get(F.from_json("face_embedding", "array<float>"), 0)
    return u.select("username", "email", "full_name",
                    F.round(first.cast("double"), 5).alias("x0"))


def object_uri_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    uri = F.when(F.col("url").contains("ref="), F.regexp_replace("url", "^https?://", "s3://")) \
        .when(F.col("url").contains("page="), F.lit("s3://bucket")).otherwise(F.col("url"))
    parts = p.select("page_id", ob.parse_object_uri(uri, "raw-images").alias("o"))
    return parts.select("page_id", "o.bucket", "o.key")


def object_paths(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ident = F.col("event_id").cast("string")
    name = F.when(F.col("event_type") == "view", "plain").otherwise(
        F.concat("event_type", F.lit(".a.png")))
    return e.select("event_id", ob.prediction_object_path(F.col("ts").cast("timestamp"), ident)
                    .alias("prediction_path"),
                    ob.onboarding_object_path(F.col("event_type"), F.col("event_id"), name)
                    .alias("onboarding_path"))


def webhook_envelope(spark, sf_dir):
    from doorledger.catalog.detection import RULES
    from doorledger.operators.detect import fraud_alerts
    return ev.webhook_envelope(ev.alert_json(fraud_alerts(access_logs(spark, sf_dir), RULES)))


def generated_logs(spark, sf_dir):
    """A synthetic record per event id."""
    e = table(spark, sf_dir, "events")
    g = generate.logs_from_ids(e, "event_id", 500, seed=7)
    m = "metadata."
    return g.select("event_id", "user_id", F.col(m + "prediction_id").alias("prediction_id"),
                    F.round(m + "confidence", 6).alias("confidence"),
                    F.round(m + "processing_time_ms", 6).alias("processing_time_ms"),
                    m + "source_ip", m + "prediction_status", m + "device_id",
                    m + "check_in_type", "timestamp")


def generated_users(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return generate.users_from_ids(c, "c_custkey", seed=7)


def generated_folders(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id")
    g = generate.with_batch_folders(e, "event_id", 250)
    return g.groupBy("Year", "Month", "Day").agg(F.count(F.lit(1)).alias("n"))


def pushed_features(spark, sf_dir):
    """Templates pushed over stored vectors; some are older than what is stored and lose."""
    e = table(spark, sf_dir, "embeddings")
    at = F.lit("2024-01-01").cast("timestamp")
    old = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    base = features.embedding_rows(old, "label", at)
    pooled = pooling.pool_embeddings(e, "label", "vec_id")
    new = features.embedding_rows(pooled, "label", F.when(
        F.col("images") > 50, F.lit("2024-02-01")).otherwise("2023-02-01").cast("timestamp"))
    history, online = features.push(new, base, base)
    n = history.groupBy("employee_id").agg(F.count(F.lit(1)).alias("history"))
    return online.join(n, "employee_id").select(
        "employee_id", "history", F.date_format("event_timestamp", "yyyy-MM-dd").alias("day"),
        F.round(F.get("embedding", 0).cast("double"), 5).alias("x0"))


def _d(page: int, slot: int, salt: str = "CAST(event_id AS VARCHAR)") -> str:
    """SQL of one uniform draw for a row."""
    return (f"(CAST('0x' || substr(md5({salt} || '|7|{page}'), {1 + 8 * slot}, 8) AS BIGINT)"
            " / 4294967296.0::DOUBLE)")


def _uuid(expr: str) -> str:
    h = f"md5({expr})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4)"
            f" || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


_USER_SALT = "('user' || CAST(c_custkey AS VARCHAR))"
_USERS = """users AS (SELECT c_custkey AS id, c_name AS username, 'mail' || c_custkey AS email,
    c_mktsegment AS full_name, '[0.5]' AS face_embedding FROM customer)"""
_REGS = """regs AS (SELECT o_orderkey AS seq,
    CASE WHEN o_orderstatus = 'F' THEN 'new ' ELSE 'Customer#' END
      || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS username,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'mail' || (o_custkey + 1)
         ELSE 'other' || o_custkey END AS email,
    o_orderpriority AS full_name, '[' || o_totalprice || ']' AS face_embedding FROM orders)"""
_REASON = """CASE WHEN n = 0 THEN 'no face detected'
  WHEN n > 1 AND len(sure) <> 1
    THEN 'expected 1 face, found ' || len(sure) || ' (high-confidence)'
  WHEN f.c < 0.9 THEN 'face confidence too low (' || printf('%.3f', f.c) || ' < 0.9)'
  WHEN f.w < 80 OR f.h < 80 THEN 'face too small (' || f.w || 'x' || f.h || ' < 80x80)' END"""
_GATED = f"""raw AS (SELECT user_id AS request_id, event_id AS pos, event_id % 4 AS n,
    list_transform(range(0, event_id % 4), lambda i: {{
      'c': value / 100 + i * 0.2::DOUBLE, 'w': event_id % 90 + 40 + i * 10,
      'h': event_id % 70 + 60}}) AS faces FROM events),
  sure AS (SELECT *, list_filter(faces, lambda f: f.c >= 0.9::DOUBLE) AS sure FROM raw),
  one AS (SELECT *, CASE WHEN n > 1 THEN sure[1] ELSE faces[1] END AS f FROM sure),
  gated AS (SELECT request_id, pos, 'img_' || pos AS path, {_REASON} AS why FROM one)"""
_STATUS = """CASE WHEN label = 2 THEN 'error' WHEN label = 0 THEN 'no_face'
  WHEN label = 1 THEN 'error' WHEN c >= 0.25 THEN 'success' ELSE 'no_match' END"""


_ONBOARD = """staged AS (SELECT *, CASE
    WHEN embedding[1] <= -0.15::DOUBLE THEN 'request'
    WHEN CAST(embedding[2] + 0.95::FLOAT AS DOUBLE) < 0.9::DOUBLE THEN 'faces'
    WHEN embedding[3] >= 0.15::DOUBLE THEN 'embedding' END AS stage FROM embeddings)"""


def _recognised_sql() -> str:
    from doorledger.catalog.vectors import _TEMPLATES_SQL
    return f"""{_TEMPLATES_SQL}, s AS (
        SELECT vec_id, emb.label, templates.label + 1 AS m, list_cosine_similarity(e, t) AS c
        FROM emb, templates
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, templates.label) = 1),
        r AS (SELECT CAST(vec_id AS VARCHAR) AS prediction_id, vec_id, {_STATUS} AS status,
                     CASE WHEN label > 2 AND c >= 0.25 THEN m END AS matched,
                     CASE WHEN label > 2 THEN round(c, 6) END AS confidence,
                     TIMESTAMP '2024-01-01' + to_minutes(vec_id) AS ts FROM s)"""


QUERIES = {
    "upload_gate": (upload_gate, """
        SELECT page_id, CASE WHEN contains(url, 'ref=')
            THEN 'Invalid file type. Only JPEG and PNG are supported.'
          WHEN length(html) * 1000 > 10485760 THEN 'File too large. Maximum size is 10MB.'
          ELSE 'accepted' END AS reason FROM pages"""),
    "face_gate": (face_gate, f"""WITH {_GATED}
        SELECT request_id, pos, coalesce(path || ': ' || why, 'accepted') AS reason FROM gated"""),
    "request_passes": (request_passes, f"""WITH {_GATED}
        SELECT request_id, count(*) FILTER (why IS NULL) AS accepted, count(*) AS total,
               arg_min(path, pos) FILTER (why IS NULL) AS first_accepted,
               arg_min(path || ': ' || why, pos) FILTER (why IS NOT NULL) AS first_reason
        FROM gated GROUP BY 1"""),
    "detection_gate": (detection_gate, """WITH b AS (
        SELECT *, event_type <> 'view' AND value / 50 >= 0.9::DOUBLE AS ok FROM events)
        SELECT event_id, CASE WHEN ok THEN CAST(trunc(value) AS INTEGER) END AS x,
               CASE WHEN ok THEN CAST(trunc(value / 2) AS INTEGER) END AS y,
               CASE WHEN ok THEN CAST(trunc(value + 40.7::DOUBLE - value) AS INTEGER) END AS w,
               CASE WHEN ok THEN CAST(trunc(value / 2 + 33.3::DOUBLE - value / 2) AS INTEGER)
                 END AS h,
               CASE WHEN ok THEN round(value / 50, 6) END AS confidence FROM b"""),
    "required_fields": (required_fields, """
        SELECT c_custkey, CASE
          WHEN c_mktsegment = 'MACHINERY' OR c_acctbal <= 0
            THEN 'Missing required fields: user_id, username, email, full_name'
          WHEN c_nationkey % 3 = 0 THEN 'Need at least 1 image, got 0'
          ELSE 'complete' END AS reason FROM customer"""),
    "duplicate_users": (duplicate_users, f"""WITH {_USERS}, {_REGS}
        SELECT seq, username, email FROM regs r WHERE EXISTS (
          SELECT 1 FROM users u WHERE u.username = r.username)
        OR EXISTS (SELECT 1 FROM users u WHERE u.email = r.email)"""),
    "ambiguous_requests": (ambiguous_requests, f"""WITH {_USERS}, {_REGS}
        SELECT seq, a.id AS id_by_username, b.id AS id_by_email FROM regs
        JOIN users a USING (username) JOIN users b ON b.email = regs.email
        WHERE a.id <> b.id"""),
    # a registration inserts if its name and address are both new; in these tables a new name
    # always comes with the same customer's address, so the first of each name inserts unless
    # an inserted row already has its address
    "upsert_users": (upsert_users, f"""WITH RECURSIVE {_USERS}, {_REGS},
        fresh AS (SELECT * FROM regs r WHERE NOT EXISTS (
                    SELECT 1 FROM users u WHERE u.username = r.username)
                  AND NOT EXISTS (SELECT 1 FROM users u WHERE u.email = r.email)),
        added AS (SELECT * FROM fresh QUALIFY
                  row_number() OVER (PARTITION BY username ORDER BY seq) = 1),
        everyone AS (SELECT username, email, full_name, face_embedding FROM users
          UNION ALL SELECT username, email, full_name, face_embedding FROM added),
        byname AS (SELECT username, max(seq) AS s FROM regs GROUP BY 1),
        bymail AS (SELECT email, max(seq) AS s FROM regs GROUP BY 1)
        SELECT e.username, e.email, coalesce(r.full_name, e.full_name) AS full_name,
               coalesce(r.face_embedding, e.face_embedding) AS face_embedding,
               CASE WHEN r.seq IS NULL THEN '2024-01-01' ELSE '2024-06-01' END AS updated
        FROM everyone e LEFT JOIN byname n ON n.username = e.username
        LEFT JOIN bymail m ON m.email = e.email
        LEFT JOIN regs r ON r.seq = greatest(n.s, m.s)"""),
    "users_left_join": (users_left_join, f"""WITH {_USERS}
        SELECT o_orderkey AS id, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS user_id,
               username, email
        FROM orders LEFT JOIN users u
          ON u.id = CASE WHEN o_totalprice > 100000 THEN o_custkey END"""),
    "verify_registration": (verify_registration, """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_custkey = o_orderkey % 1000 THEN 1 ELSE 0 END AS verified
        FROM orders"""),
    "bulk_recognition": (bulk_recognition, f"""WITH {_recognised_sql()}
        SELECT prediction_id, status, CAST(matched AS VARCHAR) AS matched_user, confidence,
               CASE status WHEN 'success' THEN 'Match found: ' || matched
                 WHEN 'no_match' THEN 'No match found'
                 WHEN 'no_face' THEN 'No face detected in image'
                 ELSE 'Failed to extract face embedding' END AS message
        FROM r"""),
    "recognition_predictions": (recognition_predictions, f"""WITH {_recognised_sql()}
        SELECT prediction_id AS uuid, CAST(matched AS BIGINT) AS user_id,
               'predictions/Year=2024/Month=01/' || strftime(ts, '%d') || '/' || prediction_id
                 || '.jpg' AS image_path, status,
               '{{"bounding_box":{{"x":1,"y":2,"w":50,"h":60,"confidence":0.95}}}}' AS meta_data
        FROM r WHERE status IN ('success', 'no_match')"""),
    "recognition_logs": (recognition_logs, f"""WITH {_recognised_sql()}
        SELECT prediction_id, coalesce(CAST(matched AS VARCHAR), 'anonymous') AS user_id,
               'prediction' AS action, '10.0.0.1' AS source_ip, status AS prediction_status,
               confidence, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
        FROM r"""),
    "onboarding_rejected": (onboarding_rejected, f"""WITH {_ONBOARD}
        SELECT CAST(vec_id AS VARCHAR) AS request_id, stage FROM staged
        WHERE stage IS NOT NULL"""),
    "onboarding_users": (onboarding_users, f"""WITH {_ONBOARD},
        last AS (SELECT label, arg_max(vec_id, vec_id) AS v, arg_max(embedding[1], vec_id) AS x
                 FROM staged WHERE stage IS NULL GROUP BY 1),
        ids AS (SELECT r_regionkey AS id FROM region UNION SELECT label FROM last)
        SELECT 'user ' || id AS username, 'mail ' || id AS email,
               coalesce('by ' || v, 'old') AS full_name, round(CAST(x AS DOUBLE), 5) AS x0
        FROM ids LEFT JOIN last ON label = id"""),
    "object_uri_parts": (object_uri_parts, """WITH u AS (
        SELECT page_id, CASE
          WHEN contains(url, 'ref=') THEN regexp_replace(url, '^https?://', 's3://')
          WHEN contains(url, 'page=') THEN 's3://bucket' ELSE url END AS uri FROM pages)
        SELECT page_id, CASE WHEN starts_with(uri, 's3://') THEN split_part(uri[6:], '/', 1)
                             ELSE 'raw-images' END AS bucket,
               CASE WHEN NOT starts_with(uri, 's3://') THEN uri
                    WHEN contains(uri[6:], '/') THEN uri[6 + strpos(uri[6:], '/'):]
                    ELSE '' END AS key FROM u"""),
    "object_paths": (object_paths, """
        SELECT event_id, 'predictions/Year=' || strftime(ts, '%Y') || '/Month='
            || strftime(ts, '%m') || '/' || strftime(ts, '%d') || '/' || event_id || '.jpg'
            AS prediction_path,
          'onboarding/' || event_type || '/' || event_type || '_' || event_id || '.'
            || CASE WHEN event_type = 'view' THEN 'jpg' ELSE 'png' END AS onboarding_path
        FROM events"""),
    "webhook_envelope": (webhook_envelope, None),
    "generated_logs": (generated_logs, f"""WITH g AS (
        SELECT event_id, CAST(floor({_d(0, 0)} * 4) AS INTEGER) < 3 AS ok,
               CAST(floor({_d(0, 1)} * 500) AS BIGINT) AS u, {_d(0, 2)} AS conf,
               CAST(floor({_d(0, 3)} * 189302401) AS BIGINT) AS secs,
               {_d(1, 0)} * 450 + 50 AS ms, CAST(floor({_d(1, 1)} * 50) AS BIGINT) + 1 AS dev,
               CAST(floor({_d(1, 2)} * 3) AS INTEGER) AS kind,
               CAST(floor({_d(1, 3)} * 65536) AS BIGINT) AS a,
               CAST(floor({_d(2, 0)} * 65536) AS BIGINT) AS b FROM events)
        SELECT event_id, CASE WHEN ok THEN {_uuid("'pool|7|' || u")} ELSE 'anonymous' END
                 AS user_id,
               {_uuid("'prediction|7|' || event_id")} AS prediction_id,
               round(CASE WHEN ok THEN conf * 0.4::DOUBLE + 0.6::DOUBLE
                          ELSE conf * 0.3::DOUBLE + 0.3::DOUBLE END, 6) AS confidence,
               round(ms, 6) AS processing_time_ms,
               (a // 256) || '.' || (a % 256) || '.' || (b // 256) || '.' || (b % 256)
                 AS source_ip,
               CASE WHEN ok THEN 'success' ELSE 'no_match' END AS prediction_status,
               'device_' || dev AS device_id,
               ['face', 'card', 'manual'][kind + 1] AS check_in_type,
               strftime(TIMESTAMP '2020-01-01' + to_seconds(secs), '%Y-%m-%dT%H:%M:%S')
                 AS "timestamp" FROM g"""),
    "generated_users": (generated_users, f"""
        SELECT {_uuid("'pool|7|' || c_custkey")} AS user_id, 'user_' || c_custkey AS username,
               'user_' || c_custkey || '@example.com' AS email,
               'User ' || c_custkey AS full_name,
               ['Engineering', 'Sales', 'Marketing', 'HR', 'Finance']
                 [CAST(floor({_d(0, 0, _USER_SALT)} * 5) AS INTEGER) + 1] AS department,
               ['Office A', 'Office B', 'Office C', 'Remote']
                 [CAST(floor({_d(0, 1, _USER_SALT)} * 4) AS INTEGER) + 1] AS location
        FROM customer"""),
    "generated_folders": (generated_folders, """WITH b AS (
        SELECT event_id // 250 AS b FROM events)
        SELECT CAST(2020 + b % 6 AS VARCHAR) AS "Year",
               lpad(CAST(b % 12 + 1 AS VARCHAR), 2, '0') AS "Month",
               lpad(CAST(b % 28 + 1 AS VARCHAR), 2, '0') AS "Day", count(*) AS n
        FROM b GROUP BY 1, 2, 3"""),
    "pushed_features": (pushed_features, """WITH
        old AS (SELECT label, arg_min(embedding, vec_id)[1] AS x, count(*) > 50 AS newer
                FROM embeddings GROUP BY 1),
        new AS (SELECT label, CAST(median(CAST(embedding[1] AS DOUBLE)) AS FLOAT) AS x
                FROM embeddings GROUP BY 1)
        SELECT CAST(old.label AS VARCHAR) AS employee_id, CAST(2 AS BIGINT) AS history,
               CASE WHEN newer THEN '2024-02-01' ELSE '2024-01-01' END AS day,
               round(CAST(CASE WHEN newer THEN new.x ELSE old.x END AS DOUBLE), 5) AS x0
        FROM old JOIN new ON old.label = new.label"""),
}


def _webhook_sql() -> str:
    """The alert text is JSON inside JSON, so its quotes are escaped."""
    from doorledger.catalog.detection import BRUTE_SQL, SPAM_SQL
    bs, q = chr(92), '"'
    e = bs + q
    fields = (f"""'{{{e}alert_type{e}:{e}' || alert_type || '{e},'
        || coalesce('{e}user_id{e}:{e}' || user_id || '{e},', '')
        || '{e}source_ip{e}:{e}' || source_ip || '{e},{e}count{e}:' || "count"
        || ',{e}window_seconds{e}:' || window_seconds || ',{e}severity{e}:{e}' || severity
        || '{e},{e}message{e}:{e}' || message || '{e},{e}timestamp{e}:{e}' || "timestamp"
        || '{e}}}'""")
    return f"""WITH {LOGS_SQL}, alerts AS ({SPAM_SQL} UNION ALL {BRUTE_SQL})
        SELECT '{{"content":"' || {fields} || '"}}' AS value FROM alerts"""


QUERIES["webhook_envelope"] = (webhook_envelope, _webhook_sql())
