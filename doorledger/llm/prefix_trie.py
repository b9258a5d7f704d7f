"""Conversation prefix trie on minimal-perfect-hash node tables.

A node is a distinct sequence of turns (role, text), known by a chained 32-byte digest. Conversations are streamed in turn
order, shuffled as digests and never as texts. Nodes of more than ``T`` conversations are the top of the trie: a table of at
most ``TOP_NODES`` rows, as ``T`` follows the number of turns. Every other node hangs below one whose parent is in
the top, and that one names its shard, which so holds at most ``T`` conversations, however hot a first turn is. A shard
enumerates its distinct prefixes, gives each a slot of a minimal perfect hash, verified against the whole digest, scatters
its counts into flat arrays and adds them up through an array of parent slots, deepest first. The shards' totals, added per
top node, then go through the same arrays of the top. Numbers of conversations that end at a top node may be
very long: they are sorted by range over all tasks, joined there, and hashed in that order.

A conversation is one task's sorted stream of which one turn is held. Turns come by ``turn``, null first; turns that
repeat a number follow their digest, repeated rows are turns of their own. Null roles and texts count as empty; rows
without a conversation id belong to none. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import map_rows, shuffle_parts, stored

BLOCK, SHARES = 100, 6
TOP_NODES, LEAST = 1 << 19, 64
ROOT = hashlib.sha256(b"root").digest()
_ROWS = 1 << 15
_PATHS = "conv_id long, depth long, digest binary, parent binary, chars long, ends boolean"
_NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def shared_turns(conv_id: int, shares: int) -> int:
    """How many turns of its block's first conversation a conversation starts with."""
    return zlib.crc32(str(conv_id).encode()) % shares


def paths(conversations: DataFrame, block: int | None = None, shares: int = SHARES, conv_col: str = "conv_id",
          turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per conversation and prefix: depth, digests of the prefix and the one before, length of the last text, whether it ends there.

    With ``block`` conversations are rebuilt first: the first turns (``shared_turns``) are those of conversation
    ``c - c % block``, then come a conversation's own turns after as many.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    conv = F.col(conv_col).cast("long")
    base = conv - conv % block if block else conv
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = (conversations.where(F.col(conv_col).isNotNull())
            .select(base.alias("base"), conv.alias("conv"), F.col(turn_col).alias("turn"),
                    F.unhex(F.sha2(said.cast("binary"), 256)).alias("said"), F.length(text).cast("long").alias("chars")))

    def run(batches):
        out = _Rows()
        group = first = current = None
        path, depth, skip, own = ROOT, 0, 0, 0

        def push(said: bytes, chars: int) -> None:
            nonlocal path, depth
            before, path, depth = path, hashlib.blake2b(path + said, digest_size=32).digest(), depth + 1
            out.add(current, depth, path, before, chars)

        for b in batches:
            for base, conv, said, chars in zip(*(b[c].to_pylist() for c in ("base", "conv", "said", "chars")), strict=True):
                if conv != current or base != group:
                    out.end()
                    if base != group:
                        group, first = base, []
                    current, path, depth, own, skip = conv, ROOT, 0, 0, 0
                    out.add(conv, 0, ROOT, b"", 0)
                    if block and conv != base:
                        skip = shared_turns(conv, shares)
                        for turn in first[:skip]:
                            push(*turn)
                if conv == base and len(first) < shares:
                    first.append((said, chars))
                if own >= skip:
                    push(said, chars)
                own += 1
            yield from out.full()
        out.end()
        yield from out.full(0)

    # the block's first conversation is streamed before those that share its turns
    return map_rows(rows.repartition(shuffle_parts(rows), "base").sortWithinPartitions(
        "base", F.col("conv") != F.col("base"), "conv", F.col("turn").asc_nulls_first(), "said"), run, _PATHS)


class _Rows:
    """Rows of ``paths``; the last one waits until it is known whether its conversation goes on."""

    _NAMES = ("conv_id", "depth", "digest", "parent", "chars", "ends")

    def __init__(self):
        self.columns = [[] for _ in self._NAMES]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, (*row, False), strict=True):
            column.append(value)

    def end(self) -> None:
        if self.columns[5]:
            self.columns[5][-1] = True

    def full(self, least: int = _ROWS) -> Iterator[dict]:
        hold = 1 if least else 0
        if len(self.columns[0]) > least:
            yield {name: c[:len(c) - hold] for name, c in zip(self._NAMES, self.columns, strict=True)}
            self.columns = [c[len(c) - hold:] for c in self.columns]


class SlotTable:
    """Minimal perfect hash of distinct 32-byte keys to 0..n-1, with the keys kept by slot to verify each answer.

    Keys that are alone in their cell of a level take the cell's rank, the others go on to the next level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        slot = np.empty(len(keys), np.int64)
        left, taken = np.arange(len(keys)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys are not distinct")
            size = 2 * len(left)
            cell = self._cell(keys[left], len(self.levels), size)
            marks = np.bincount(cell, minlength=size) == 1
            rank = taken + np.cumsum(marks) - 1
            alone = marks[cell]
            slot[left[alone]] = rank[cell[alone]]
            self.levels.append((marks, rank))
            left, taken = left[~alone], taken + int(alone.sum())
        self.keys = np.empty_like(keys)
        self.keys[slot] = keys
        if taken != len(keys) or not np.array_equal(self.slots(keys), slot):
            raise ValueError("slots collide")

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        h = (keys[:, level % 4] ^ np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD1342543DE82EF95)
        h ^= keys[:, (level + 1) % 4]
        h ^= h >> np.uint64(32)
        return (h % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the key stored there is another one."""
        slot, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (marks, rank) in enumerate(self.levels):
            cell = self._cell(keys[left], level, len(marks))
            hit = marks[cell]
            slot[left[hit]] = rank[cell[hit]]
            left = left[~hit]
        found = slot >= 0
        found[found] = (self.keys[slot[found]] == keys[found]).all(1)
        return np.where(found, slot, -1)


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def accumulated(parent: np.ndarray, depth: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Each array summed over the subtrees, given every slot's parent slot (-1: none here), deepest first."""
    totals = [v.astype(np.int64) for v in values]
    order = np.argsort(-depth, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        at = at[parent[at] >= 0]
        for t in totals:
            np.add.at(t, parent[at], t[at])
    return totals


def _digest_of(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _shard(digest: list[bytes], parent: list[bytes], conv: np.ndarray, depth: np.ndarray, chars: np.ndarray,
           ends: np.ndarray, top: dict[bytes, int]) -> dict:
    """The nodes of some whole shards, from their rows in order of digest and conversation."""
    keys = _keys(digest)
    heads = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
    table = SlotTable(keys[heads])
    of_head = table.slots(keys[heads])
    n = len(heads)

    def by_slot(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[of_head] = values[heads]
        return out

    slot = table.slots(keys)
    up = np.empty(n, np.int64)
    up[of_head] = table.slots(_keys([parent[i] for i in heads.tolist()]))
    members = np.bincount(slot, minlength=n)
    first, level, length = by_slot(conv), by_slot(depth), by_slot(chars)
    children = np.bincount(up[up >= 0], minlength=n)
    leaves, saved = accumulated(up, level, children == 0, (members - 1) * length)
    above = [b""] * n  # the top node over a shard's root
    over = np.where(up >= 0, first[up], 0)
    for i, s in zip(heads.tolist(), of_head.tolist(), strict=True):
        if up[s] < 0:
            above[s], over[s] = parent[i], top[parent[i]]
    said = [_digest_of(np.zeros(0, np.int64))] * n
    last = np.flatnonzero(ends)
    last = last[np.argsort(slot[last], kind="stable")]  # conversations stay in ascending order
    for at in np.split(last, np.flatnonzero(np.diff(slot[last])) + 1):
        if len(at):
            said[slot[at[0]]] = _digest_of(conv[at])
    return {"conv_id": first, "depth": level, "parent_conv_id": over, "n_convs": members, "n_children": children,
            "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": said,
            "above": pa.array([a or None for a in above], pa.binary())}


def _ends_of(top: DataFrame, found: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the top nodes at which conversations end, however many."""
    def pieces(batches):
        held, ids = None, []

        def flush():
            return {"digest": [held], "first": [ids[0]], "ids": [",".join(map(str, ids))]}

        for b in batches:
            for digest, conv in zip(b["digest"].to_pylist(), b["conv_id"].to_pylist(), strict=True):
                if digest != held or len(ids) == 1 << 16:
                    if ids:
                        yield flush()
                    held, ids = digest, []
                ids.append(conv)
        if ids:
            yield flush()

    def hashed(batches):
        held = digest = None
        for b in batches:
            for key, ids in zip(b["digest"].to_pylist(), b["ids"].to_pylist(), strict=True):
                if key == held:
                    digest.update(b"," + ids.encode())
                else:
                    if held is not None:
                        yield {"digest": [held], "ends_sha256": [digest.hexdigest()]}
                    held, digest = key, hashlib.sha256(ids.encode())
        if held is not None:
            yield {"digest": [held], "ends_sha256": [digest.hexdigest()]}

    n = shuffle_parts(found)
    last = found.where("ends").select("digest", "conv_id").join(F.broadcast(top.select("digest")), "digest")  # at most TOP_NODES
    runs = map_rows(last.repartitionByRange(n, "digest", "conv_id").sortWithinPartitions("digest", "conv_id"), pieces,
                    "digest binary, first long, ids string")
    return map_rows(runs.repartition(n, "digest").sortWithinPartitions("digest", "first").select("digest", "ids"), hashed,
                    "digest binary, ends_sha256 string")


def nodes(conversations: DataFrame, block: int | None = None, shares: int = SHARES, least: int = LEAST, **columns: str) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    found = stored(paths(conversations, block, shares, **columns))
    n = shuffle_parts(found)
    limit = max(least, -(-found.count() // TOP_NODES))
    top = stored(found.groupBy("digest").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("chars").alias("chars")).where((F.col("n_convs") > limit) | (F.col("depth") == 0)))
    shared = spark.sparkContext.broadcast({bytes(r.digest): r.conv_id for r in top.select("digest", "conv_id").collect()})

    def hung(batches):
        """Rows below the top, with the digest at which their conversation leaves it."""
        known, current, shard = shared.value, None, None
        for b in batches:
            mine, keep = [], []
            for i, (conv, digest, parent) in enumerate(zip(*(b[c].to_pylist() for c in ("conv_id", "digest", "parent")), strict=True)):
                if conv != current:
                    current, shard = conv, None
                if digest in known:
                    continue
                if shard is None:
                    shard = digest
                mine.append(shard)
                keep.append(i)
            at = pa.array(keep, pa.int32())
            yield {"shard": pa.array(mine, pa.binary()), **{c: b[c].take(at) for c in b}}

    below = map_rows(found.repartition(n, "conv_id").sortWithinPartitions("conv_id", "depth"), hung, f"shard binary, {_PATHS}")

    def counted(batches):
        held: list[dict] = []
        size = 0

        def resolve(parts: list[dict]):
            cols = {c: pa.concat_arrays([p[c] for p in parts]) for c in parts[0]}
            digest = cols["digest"].to_pylist()
            return _shard(digest, cols["parent"].to_pylist(), *(cols[c].to_numpy(zero_copy_only=False) for c in ("conv_id", "depth", "chars", "ends")),
                          shared.value)

        for b in batches:
            held.append(b)
            size += len(b["digest"])
            if size < _ROWS:
                continue
            shards = b["shard"].to_pylist()
            cut = len(shards) - 1  # where the last shard begins, which may go on
            while cut >= 0 and shards[cut] == shards[-1]:
                cut -= 1
            if cut >= 0:
                whole = [*held[:-1], {c: v.slice(0, cut + 1) for c, v in b.items()}]
                yield resolve(whole)
                held = [{c: v.slice(cut + 1) for c, v in b.items()}]
                size = len(held[0]["digest"])
        if held:
            yield resolve(held)

    low = stored(map_rows(below.repartition(n, "shard").sortWithinPartitions("shard", "digest", "conv_id"), counted,
                          f"{_NODES}, above binary"))
    from_shards = (low.where("above is not null").groupBy(F.col("above").alias("digest"))
                   .agg(F.count("*").alias("roots"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")))
    high = (top.join(from_shards, "digest", "left").join(_ends_of(top, found), "digest", "left")
            .select("digest", "parent", "conv_id", "depth", "n_convs", "chars",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("roots", "leaves", "saved")],
                    F.coalesce("ends_sha256", F.lit(_digest_of(np.zeros(0, np.int64)))).alias("ends_sha256")))

    def finished(batches):
        parts = list(batches)  # at most TOP_NODES rows
        if not parts:
            return
        cols = {c: pa.concat_arrays([p[c] for p in parts]) for c in parts[0]}
        num = {c: cols[c].to_numpy(zero_copy_only=False) for c in ("conv_id", "depth", "n_convs", "chars", "roots", "leaves", "saved")}
        keys = _keys(cols["digest"].to_pylist())
        table = SlotTable(keys)
        slot = table.slots(keys)
        num = {c: v[np.argsort(slot)] for c, v in num.items()}
        up = table.slots(_keys([p or bytes(32) for p in cols["parent"].to_pylist()]))[np.argsort(slot)]
        children = num["roots"] + np.bincount(up[up >= 0], minlength=len(up))
        leaves, saved = accumulated(up, num["depth"], num["leaves"] + (children == 0), num["saved"] + (num["n_convs"] - 1) * num["chars"])
        yield {"conv_id": num["conv_id"], "depth": num["depth"], "n_convs": num["n_convs"], "n_children": children,
               "parent_conv_id": pa.array(np.where(up >= 0, num["conv_id"][up], 0), pa.int64(), mask=up < 0),
               "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": cols["ends_sha256"].take(pa.array(np.argsort(slot)))}

    return low.drop("above").unionByName(map_rows(high.repartition(1), finished, _NODES))
