"""Suspicious activity by exact trailing-window counts, batch form.

An event at ``t`` counts itself and the key's earlier events in ``(t - window, t]``.
Each event contributes +1 when it happens and -1 when it leaves the window, so the count
is a running total of these steps; leaving comes before arriving at the same millisecond
(the lower bound is strict) and equal milliseconds follow ``ingest_seq``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doorledger.functions import events as ev
from doorledger.operators.ordered import HOUR_MS, running_total


@dataclass(frozen=True)
class Rule:
    """One detector: which events count, for which key, how many in how long."""

    alert_type: str
    threshold: int
    window_seconds: int
    key: Callable[[], Column] = field(repr=False)
    predicate: Callable[[], Column] = field(repr=False)
    per_user: bool

    @property
    def window_ms(self) -> int:
        return self.window_seconds * 1000


def spam_rule(threshold: int = 5, window_seconds: int = 60,
              predicate: Callable[[], Column] = ev.is_named_success) -> Rule:
    return Rule("spam_detection", threshold, window_seconds, ev.user_key, predicate, True)


def brute_force_rule(threshold: int = 10, window_seconds: int = 300,
                     predicate: Callable[[], Column] = ev.is_failed_match) -> Rule:
    return Rule("brute_force_detection", threshold, window_seconds, ev.ip_key, predicate, False)


def trailing_count(rows: DataFrame, keys: Sequence[str], ms: str, seq: str,
                   window_ms: int | Column, out: str = "count", block_ms: int = HOUR_MS,
                   longest_ms: int | None = None) -> DataFrame:
    """Add ``out`` to every row: the key's events in the window that ends with it.

    Windows up to ``block_ms`` take one scan, one shuffle and one sort: keys are cut into
    blocks as long as the window, so an event leaves exactly one block after it came, and the
    events that leave during a block are those the block starts with. Longer windows use
    blocks of ``block_ms`` and totals carried between them, which costs a second, narrow scan
    but keeps the pieces of a hot key small. With a column of widths, ``longest_ms`` bounds
    them.
    """
    longest = window_ms if isinstance(window_ms, int) else longest_ms
    width = F.lit(window_ms).cast("bigint") if isinstance(window_ms, int) else window_ms
    payload = [c for c in rows.columns if c not in (*keys, ms, seq)]
    gone = F.col(ms) + width
    step = {"step": (F.lit(1), F.lit(-1)), "at": (F.col(ms), gone),
            "seq": (F.col(seq), F.lit(None).cast(rows.schema[seq].dataType)),
            "row": (F.struct(*payload) if payload else F.lit(None), F.lit(None))}
    short = longest is not None and longest <= block_ms
    if short:
        step["_blk"] = tuple(t - F.pmod(t, width) for t in step["at"])
    sides = [F.struct(*[pair[i].alias(name) for name, pair in step.items()]) for i in (0, 1)]
    moves = rows.select(*keys, F.explode(F.array(*sides)).alias("m")).select(*keys, "m.*")
    order = ["at", "step", "seq"]
    if short:
        block = Window.partitionBy(*keys, "_blk").orderBy(*order)
        everywhere = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        so_far = block.rowsBetween(Window.unboundedPreceding, 0)
        counted = moves.withColumn(out, F.count_if(F.col("step") < 0).over(everywhere)
                                   + F.sum("step").over(so_far))
    else:
        counted = running_total(moves, keys, "at", order, "step", out, block_ms)
    back = [F.col(f"row.{c}").alias(c) for c in payload]
    return counted.where(F.col("step") > 0).select(
        *keys, F.col("at").alias(ms), F.col("seq").alias(seq), *back, out)


def rule_rows(logs: DataFrame, rules: Sequence[Rule], also: Sequence[str] = ()) -> DataFrame:
    """Each event once per rule it counts for, with that rule's key, in one scan.

    ``also`` names further columns to keep.
    """
    hits = [F.when(r.predicate(), F.struct(
        F.lit(i).alias("rule"), r.key().alias("key"), F.lit(r.window_ms).cast("bigint")
        .alias("window_ms"))) for i, r in enumerate(rules)]
    if "ingest_seq" not in logs.columns:  # events of one millisecond then come in any order
        logs = logs.withColumn("ingest_seq", F.lit(0).cast("bigint"))
    return (logs.select("event_ms", "ingest_seq", "timestamp", *also,
                        ev.ip_key().alias("source_ip"), F.explode(F.array(*hits)).alias("h"))
            .where(F.col("h").isNotNull())
            .select("h.rule", "h.key", "h.window_ms", "event_ms", "ingest_seq", "source_ip",
                    "timestamp", *also))


def _per_rule(rules: Sequence[Rule], pick: Callable[[Rule], Column]) -> Column:
    chain = F
    for i, r in enumerate(rules):
        chain = chain.when(F.col("rule") == i, pick(r))
    return chain


def alerts_from_counts(counted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Counts above their rule's threshold as alerts."""
    c = F.col("count")
    over = counted.where(c > _per_rule(rules, lambda r: F.lit(r.threshold)))

    def severity(r: Rule) -> Column:
        if not r.per_user:
            return F.lit("critical")
        return F.when(c > 2 * r.threshold, "critical").otherwise("warning")

    def message(r: Rule) -> Column:
        who, did = (("User ", " logged in successfully ") if r.per_user else ("IP ", " had "))
        unit = " times in " if r.per_user else " failed matches in "
        return F.concat(F.lit(who), F.col("key"), F.lit(did), c.cast("string"),
                        F.lit(f"{unit}{r.window_seconds}s"))

    return over.select(
        _per_rule(rules, lambda r: F.lit(r.alert_type)).alias("alert_type"),
        _per_rule(rules, lambda r: F.col("key") if r.per_user
                  else F.lit(None).cast("string")).alias("user_id"),
        _per_rule(rules, lambda r: F.col("source_ip") if r.per_user
                  else F.col("key")).alias("source_ip"),
        c.cast("bigint").alias("count"),
        _per_rule(rules, lambda r: F.lit(r.window_seconds)).cast("int").alias("window_seconds"),
        _per_rule(rules, severity).alias("severity"),
        _per_rule(rules, message).alias("message"),
        F.coalesce("timestamp", F.lit("")).alias("timestamp"))


def fraud_alerts(logs: DataFrame, rules: Sequence[Rule] | None = None,
                 block_ms: int = HOUR_MS) -> DataFrame:
    """All rules over flat events (``ingest_seq`` breaks ties): one scan, one main shuffle."""
    rules = list(rules) if rules is not None else [spam_rule(), brute_force_rule()]
    counted = trailing_count(rule_rows(logs, rules), ["rule", "key"], "event_ms", "ingest_seq",
                             F.col("window_ms"), block_ms=block_ms,
                             longest_ms=max(r.window_ms for r in rules))
    return alerts_from_counts(counted, rules)


def spam_alerts(logs: DataFrame, threshold: int = 5, window_seconds: int = 60,
                block_ms: int = HOUR_MS) -> DataFrame:
    return fraud_alerts(logs, [spam_rule(threshold, window_seconds)], block_ms)


def brute_force_alerts(logs: DataFrame, threshold: int = 10, window_seconds: int = 300,
                       block_ms: int = HOUR_MS) -> DataFrame:
    return fraud_alerts(logs, [brute_force_rule(threshold, window_seconds)], block_ms)
