"""Suffix-array dedup: bytes covered by a 200-byte string that starts anywhere else are removed.

Every 200-byte string holds one anchor, the leftmost lowest of the hashes of its 32-byte substrings, so
equal strings have equal anchors at equal places. Anchors seen once cannot be repeated. Where
the whole surroundings of an anchor (all 200-byte strings that hold it) recur, all of them are
repeated. What is left are the edges of copied passages: their bytes are gathered by anchor and their
suffixes are sorted to a depth of 200 by bucket-pointer refinement. Initial buckets of 5-byte grams are refined
by the bucket numbers found at later offsets, whose own refinement is reused at each round,
until 200 bytes are ordered; only positions of buckets with company go on. An anchor of more than ``HOT``
regions is dealt out before it is sorted: a 200-byte string holds the anchor with some number of bytes before it, and
strings with few, some and many go to groups of their own, named by all the bytes that the strings of such a group share.
Regions of equal bytes are repeated as a whole and go on as one, regions alone in a group are out, other groups are
sorted, and those that are still above ``HOT`` are dealt out again, until the number of bytes is given.

Texts are dealt by row number once, so that neither regions nor results shuffle them again.

Texts are UTF-8 bytes, null counts as empty, texts under 200 bytes hold nothing to remove.
Matches never cross rows; overlapping matches count, also within one row. Repeated rows, ids
included, are rows like others and so remove each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import RID, bucketed, counted, map_rows, shuffle_parts, stored
from doorledger.llm.near_dedup import mix

LENGTH = 200
_GRAM = 32
_WINDOW = LENGTH - _GRAM + 1
#: bytes before and after an anchor that its 200-byte strings can reach
_REACH = LENGTH - _GRAM
#: parts into which the numbers of bytes before an anchor are dealt
_PARTS = 4
#: regions (of at most 368 bytes) of one anchor that a task sorts by itself
HOT = 4096
_CHUNK, _LONG, _FLUSH = 1 << 19, 4 << 20, 24 << 20
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_tables: dict = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    if int(base) not in _tables or len(_tables[int(base)][0]) < n:
        size, out = max(n, _CHUNK + 1), []
        for b in (base, np.uint64(pow(int(base), -1, 1 << 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps))
        _tables[int(base)] = tuple(out)
    return _tables[int(base)]


def _region_hash(data: np.ndarray, s: np.ndarray, e: np.ndarray, base: np.uint64) -> np.ndarray:
    up, down = _powers(base, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + base) * up[:len(data)], out=sums[1:])
    return mix((sums[e] - sums[s]) * down[s])


def _anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of concatenated texts (``starts`` has one entry more)."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = data.astype(np.uint64) + np.uint64(1)
    size, factor = 1, int(_B2)
    while size < _GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = size * 2, factor * factor % (1 << 64)
    h = mix(h)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= _WINDOW:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = _WINDOW - size
    low = np.minimum(low[:-rest], low[rest:]) if rest else low
    ok = np.zeros(n + 1, np.int32)  # where a 200-byte string within one text starts
    long = np.flatnonzero(np.diff(starts) >= LENGTH)
    np.add.at(ok, starts[long], 1)
    np.add.at(ok, starts[long + 1] - LENGTH + 1, -1)
    low = low[np.cumsum(ok)[:len(low)] > 0]
    at = np.unique(low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at, h[at]


def _described(data: np.ndarray, starts: np.ndarray):
    """Per anchor: text number, place in it, anchor hash and two hashes of its surroundings."""
    at, h = _anchors(data, starts)
    of = np.searchsorted(starts, at, "right") - 1
    s, e = np.maximum(starts[of], at - _REACH), np.minimum(starts[of + 1], at + _GRAM + _REACH)
    place = (at - s).astype(np.uint64)
    return of, at - starts[of], h, mix(_region_hash(data, s, e, _B1) + place), _region_hash(data, s, e, _B2)


def _slices(data: np.ndarray):
    """A long text in slices; every 200-byte string lies in one of them, with all its surroundings."""
    for first in range(0, max(1, len(data) - LENGTH + 1), _LONG):
        yield first, max(0, first - 2 * LENGTH), min(len(data), first + _LONG + 3 * LENGTH)


def _long_anchors(data: np.ndarray):
    found = {}
    for first, s, e in _slices(data):
        cut = data[s:e]
        _, at, h, r1, r2 = _described(cut, np.array([0, len(cut)]))
        for p, *values in zip(at + s, h, r1, r2, strict=True):
            # an anchor near the cut ends would show surroundings that stop at the cut
            if (s == 0 or p - s >= _REACH) and (e == len(data) or e - p >= _GRAM + _REACH):
                found.setdefault(int(p), values)
    at = np.array(sorted(found), np.int64)
    cols = [np.array([found[int(p)][i] for p in at], np.uint64) for i in range(3)]
    return np.zeros(len(at), np.int64), at, *cols


def _text_runs(texts: pa.Array):
    """(first row, data, starts) of about half a megabyte of texts as bytes."""
    raw = texts.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(raw):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _CHUNK, "right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


_PLACES = np.dtype([("rid", "<i8"), ("pos", "<i8")])


def _occurrences(batches):
    """Anchors of a task; equal surroundings are one row with all their places packed."""
    held, size = [], 0

    def collapsed():
        rid, pos, h, r1, r2 = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((pos, rid, r2, r1, h))
        rid, pos, h, r1, r2 = rid[order], pos[order], h[order], r1[order], r2[order]
        heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])]))
        places = np.empty(len(rid), _PLACES)
        places["rid"], places["pos"] = rid, pos
        raw = pa.Array.from_buffers(pa.binary(), len(heads), [
            None, pa.py_buffer(np.append(heads * 16, len(rid) * 16).astype(np.int32).tobytes()), pa.py_buffer(places.tobytes())])
        return {"h": h[heads].view(np.int64), "r1": r1[heads].view(np.int64), "r2": r2[heads].view(np.int64), "places": raw}

    for b in batches:
        rids = b[RID].to_numpy(zero_copy_only=False)
        for row, data, starts in _text_runs(b["_text"]):
            of, at, h, r1, r2 = _long_anchors(data) if len(data) > 2 * _LONG else _described(data, starts)
            if len(at):
                held.append((rids[row + of], at, h, r1, r2))
            size += len(data)
            if size > _FLUSH and held:
                yield collapsed()
                size = 0
    if held:
        yield collapsed()


def _sorted_out(batches):
    """Rows sorted by anchor and surroundings: repeated places whole, and the edges to look at.

    Of equal surroundings one place stands for all, marked as ``known``. Nothing is held but
    the places of the region at hand, and those only until its second row comes.
    """
    anchor = region = pending = None
    rid, pos, anchors, known = [], [], [], []
    several = False  # regions of this anchor

    def emit(places: np.ndarray, kind: bool | None, h: int) -> None:
        rid.append(places["rid"])
        pos.append(places["pos"])
        anchors.append(np.full(len(places), h))
        known.extend([kind] * len(places))

    def leave(last: bool) -> None:
        """The region is complete; ``last`` if its anchor has no other."""
        nonlocal pending
        if pending is not None and not last:
            emit(pending[0], pending[1], anchor)
        pending = None

    def flush():
        out = {RID: np.concatenate(rid), "pos": np.concatenate(pos), "h": np.concatenate(anchors), "known": pa.array(known, pa.bool_())}
        for x in (rid, pos, anchors, known):
            x.clear()
        return out

    for b in batches:
        own = b["h"].to_numpy(zero_copy_only=False)
        same = np.concatenate([[True], own[1:] == own[:-1], [True]])  # an anchor at the ends may go on
        single = ~same[:-1] & ~same[1:] & (pc.binary_length(b["places"]).to_numpy(zero_copy_only=False) == _PLACES.itemsize)
        rest = pa.array(np.flatnonzero(~single))  # anchors with one place hold nothing
        b = {c: v.take(rest) for c, v in b.items()}
        for h, r1, r2, raw in zip(b["h"].to_pylist(), b["r1"].to_pylist(), b["r2"].to_pylist(), b["places"], strict=True):
            places = np.frombuffer(raw.as_py(), _PLACES)
            if h != anchor:
                leave(not several)
                anchor, region, several = h, None, False
            elif (r1, r2) != region:
                several = True
                leave(False)
            if (r1, r2) == region:
                if not pending[1]:  # its second place makes it known
                    emit(pending[0], None, anchor)
                    pending = (pending[0], True)
                emit(places, None, anchor)
            else:
                region = (r1, r2)
                pending = (places[:1], len(places) > 1)
                if len(places) > 1:
                    emit(places, None, anchor)
        if rid:
            yield flush()
    leave(not several)
    if rid:
        yield flush()


def _buckets(key: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that share their key with others, and the numbers of their keys, in order of the keys."""
    if not len(at):
        return at, at
    if bits <= 21:  # key and position are one number, which sorts by itself
        both = np.sort(key << bits | at)
        key, at = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    company = ~(fresh & np.append(fresh[1:], True))
    return at[company], np.cumsum(fresh)[company]


def refined(text: np.ndarray, room: np.ndarray, depth: int = LENGTH, gram: int = 5) -> np.ndarray:
    """Bucket number of the ``depth`` bytes from each position on, by bucket-pointer refinement.

    Equal numbers mean equal bytes. Positions that are alone in their bucket, or whose ``room``
    (bytes to the end of their region) is too short, get -1.
    """
    n = len(text)
    bits = max(n.bit_length(), 1)  # of a position, and of a bucket's number
    bucket = np.full(n, -1, np.int64)
    at, size = np.flatnonzero(room >= gram), gram
    key = np.zeros(len(at), np.int64)
    for k in range(gram):
        key = (key << 8) | text[at + k]
    while True:
        at, number = _buckets(key, at, bits)
        bucket[:] = -1
        bucket[at] = number
        if size == depth or not len(at):
            return bucket
        size, before = min(2 * size, depth), size
        at = at[room[at] >= size]
        ahead = bucket[at + size - before]  # the two stretches may overlap
        on = ahead >= 0  # what is alone later on is alone here too
        at = at[on]
        key = bucket[at] << bits | ahead[on]


def _edges(batches, limit: int = 1 << 18):
    """Regions sorted by anchor to intervals of repeated bytes: packed pairs per row."""
    held, size, anchor = [], 0, None

    def resolve():
        text = np.frombuffer(b"".join(r[4] for r in held), np.uint8)
        lengths = np.array([len(r[4]) for r in held], np.int32)  # as of and inner, which are as long as the text
        begin = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        of = np.repeat(np.arange(len(held), dtype=np.int32), lengths)
        inner = np.arange(len(text), dtype=np.int32) - begin[of]
        bucket = refined(text, lengths[of] - inner)
        use = np.flatnonzero(bucket >= 0)
        rids, number = np.unique(np.array([r[1] for r in held]), return_inverse=True)
        place = np.array([r[2] for r in held])[of[use]] + inner[use]
        where = number[of[use]] << 40 | place  # row and place as one number
        many = np.array([bool(r[3]) for r in held])[of[use]]
        at, group = _buckets(bucket[use], np.arange(len(use)), max(len(text).bit_length(), 1))
        out = np.zeros(0, np.int64)
        if len(at):
            heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            again = np.minimum.reduceat(where[at], heads) != np.maximum.reduceat(where[at], heads)
            again |= np.logical_or.reduceat(many[at], heads)
            out = np.unique(where[at][np.repeat(again, np.diff(np.append(heads, len(at))))])
        held.clear()
        place = out & ((1 << 40) - 1)
        return _packed(rids[out >> 40], place, place + LENGTH)

    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in ("h", RID, "start", "known", "bytes")), strict=True):
            if row[0] != anchor:
                anchor = row[0]
                if size > limit:
                    yield resolve()
                    size = 0
            held.append(row)
            size += len(row[4])
    if held:
        yield resolve()


_PARTED = "h long, lo int, hi int, left int, bytes binary, known boolean, places binary"
_REGIONS = f"h long, {RID} long, start long, left int, known boolean, lo int, hi int, bytes binary, whole boolean"


def _dealt(batches, limit: int = 16 << 20):
    """Regions of hot groups, with the bytes before the anchor counted from ``lo`` to ``hi``, in ``_PARTS`` narrower ones.

    A part's key is a hash of what all its strings share: ``lo`` bytes, the anchor, and what ``hi`` leaves after it. Equal
    parts of a task are one row with all their places packed.
    """
    held: dict[tuple, list] = {}
    size = 0

    def flush():
        out = {c: [k[i] for k in held] for i, c in enumerate(("h", "lo", "hi", "left", "bytes"))}
        out["known"] = [v[0] for v in held.values()]
        out["places"] = [np.array(v[1], _PLACES).tobytes() for v in held.values()]
        return out

    for b in batches:
        for rid, start, left, known, lo, hi, text in zip(*(b[c].to_pylist() for c in (RID, "start", "left", "known", "lo", "hi", "bytes")), strict=True):
            right = len(text) - left - _GRAM
            step = -(-(hi - lo + 1) // _PARTS)
            for first in range(lo, hi + 1, step):
                last = min(first + step - 1, hi)
                s, e = max(0, left - last), min(len(text), left + _GRAM + _REACH - first)
                if left < first or right < _REACH - last or e - s < LENGTH:
                    continue  # the text holds no such string
                shared = text[left - first:left + _GRAM + _REACH - last]
                key = int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=bytes([first, last])).digest(), "little", signed=True)
                own = held.setdefault((key, first, last, left - s, text[s:e]), [False, []])
                own[0] |= bool(known)
                own[1].append((rid, start + s))
                size += LENGTH if len(own[1]) == 1 else 16
        if size > limit:
            yield flush()
            held.clear()
            size = 0
    if held:
        yield flush()


def _collapsed(batches, limit: int = 1 << 16):
    """Parts sorted by key, bytes before the anchor and bytes: the places of equal ones whole, and one of them to go on."""
    out: list[tuple] = []
    current, one = None, None

    def go_on():
        if one is not None:
            out.append((current[0], *one[0], current[3], one[1], current[1], current[2], current[4], False))

    def flush():
        cols = dict(zip(("h", RID, "start", "left", "known", "lo", "hi", "bytes", "whole"), zip(*out, strict=True), strict=True))
        out.clear()
        return cols

    for b in batches:
        for *part, known, places in zip(*(b[c].to_pylist() for c in ("h", "lo", "hi", "left", "bytes", "known", "places")), strict=True):
            places = np.frombuffer(places, _PLACES).tolist()
            if part == current:
                if not one[1]:  # the first place was alone so far
                    out.append((part[0], *one[0], part[3], None, part[1], part[2], part[4], True))
                one = (one[0], True)
            else:
                go_on()
                current, one = part, (places[0], known or len(places) > 1)
                if len(places) == 1:
                    continue
            out.extend((part[0], rid, start, part[3], None, part[1], part[2], part[4], True) for rid, start in places)
            if len(out) > limit:
                yield flush()
        if out:
            yield flush()
    go_on()
    if out:
        yield flush()


def _whole(batches):
    for b in batches:
        rid, start = (b[c].to_numpy(zero_copy_only=False) for c in (RID, "start"))
        end = start + b["n"].to_numpy(zero_copy_only=False)
        order = np.lexsort((start, rid))
        yield _packed(rid[order], start[order], end[order])


def _hot_spans(regions: DataFrame) -> DataFrame:
    """Like ``_edges`` for the regions of hot anchors; no group above ``HOT`` is one task's."""
    spans, now = [], regions
    while True:
        parts = map_rows(now, _dealt, _PARTED)
        met = stored(map_rows(
            parts.repartition(shuffle_parts(parts), "h", "left", "bytes").sortWithinPartitions("h", "lo", "hi", "left", "bytes"),
            _collapsed, _REGIONS))
        spans.append(map_rows(met.where("whole").select(RID, "start", F.length("bytes").cast("long").alias("n")), _whole,
                              f"{RID} long, spans binary"))
        parts = met.where("not whole").drop("whole")
        company = (parts.groupBy("h").agg(F.count("*").alias("n"), F.count_if(~F.col("known")).alias("fresh"))
                   .where("n > 1 and fresh > 0").select("h", "n"))
        met = stored(parts.join(company, "h"))
        spans.append(_looked(met.where(F.col("n") <= HOT)))
        now = met.where((F.col("n") > HOT) & F.expr("lo < hi")).drop("n")
        if now.isEmpty():
            break
    out = spans[0]
    for part in spans[1:]:
        out = out.union(part)
    return out


def _looked(edges: DataFrame) -> DataFrame:
    """Spans of the strings that recur among the regions of a group ``h``."""
    return map_rows(edges.repartition(shuffle_parts(edges), "h").sortWithinPartitions("h"), _edges, f"{RID} long, spans binary")


def _packed(rid: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
    """Intervals sorted by row and start, merged, as one packed value per row."""
    if not len(rid):
        return {RID: pa.array([], pa.int64()), "spans": pa.array([], pa.binary())}
    rows = np.cumsum(np.concatenate([[0], rid[1:] != rid[:-1]]))
    high = int(end.max()) + 1
    end = np.maximum.accumulate(rows * high + end) - rows * high  # how far the row's intervals reach so far
    fresh = np.concatenate([[True], (rid[1:] != rid[:-1]) | (start[1:] > end[:-1])])
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(rid)) - 1
    spans = np.stack([start[head], end[last]], 1).astype("<i8")
    owner = rid[head]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    cuts = np.append(first, len(owner))
    return {RID: owner[first], "spans": [spans[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]}


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(_rid, spans): packed (start, end) byte intervals that are repeated, several rows per text,
    of a table of _rid and _text that is bucketed by _rid."""
    rows = rows.select(RID, "_text")
    found = stored(map_rows(
        map_rows(rows, _occurrences, "h long, r1 long, r2 long, places binary")
        .repartition(shuffle_parts(rows), "h").sortWithinPartitions("h", "r1", "r2"),
        _sorted_out, f"{RID} long, pos long, h long, known boolean"))
    start = F.greatest(F.col("pos") - _REACH, F.lit(0))
    several = found.where("known is not null")
    large = stored(several.groupBy("h").count().where(F.col("count") > HOT).select("h"))

    def regions(places: DataFrame) -> DataFrame:
        return (rows.join(places.hint("merge"), RID)
                .select("h", RID, start.alias("start"), (F.col("pos") - start).cast("int").alias("left"), "known",
                        F.lit(0).alias("lo"), F.lit(_REACH).alias("hi"),
                        F.substring("_text", (start + 1).cast("int"), (F.col("pos") + _GRAM + _REACH - start).cast("int")).alias("bytes")))

    if large.isEmpty():
        looked = _looked(regions(several))
    else:
        looked = _looked(regions(several.join(large, "h", "left_anti"))).union(
            _hot_spans(regions(several.join(large, "h", "left_semi"))))

    def whole(batches):
        for b in batches:
            rid, pos = (b[c].to_numpy(zero_copy_only=False) for c in (RID, "pos"))
            order = np.lexsort((pos, rid))
            # the end is cut to the text's length where the text is at hand
            yield _packed(rid[order], np.maximum(pos[order] - _REACH, 0), pos[order] + _GRAM + _REACH)

    return map_rows(found.where("known is null").select(RID, "pos"), whole, f"{RID} long, spans binary").union(looked)


def cut(text: bytes, spans: list[bytes] | None) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and removed runs."""
    if not spans:
        return text, 0, 0
    all_spans = np.frombuffer(b"".join(spans), "<i8").reshape(-1, 2)
    kept, runs, at, gone = [], 0, 0, 0
    end = -1
    for s, e in all_spans[np.argsort(all_spans[:, 0], kind="stable")].tolist():
        e = min(e, len(text))
        if s > end:
            kept.append(text[at:s])
            runs += 1
            gone += e - s
            at = end = e
        elif e > end:
            gone += e - end
            at = end = e
    kept.append(text[at:])
    return b"".join(kept), gone, runs


def without_repeats(docs: DataFrame, columns: list[str], text_col: str, fn, ddl: str) -> DataFrame:
    """``fn`` over batches with the named columns as _c0, _c1, ..., the text and its spans."""
    own = [F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    rows = bucketed(counted(docs.select(*own, F.col(text_col).cast("binary").alias("_text"))), RID)
    spans = repeated_spans(rows).groupBy(RID).agg(F.collect_list("spans").alias("_spans"))
    return map_rows(rows.join(spans.hint("merge"), RID, "left").drop(RID), fn, ddl)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b["_text"].to_pylist()]
            out = [cut(t, s) for t, s in zip(texts, b["_spans"].to_pylist(), strict=True)]
            yield {"id": b["_c0"], "n_bytes": [len(t) for t in texts], "n_removed": [o[1] for o in out],
                   "n_spans": [o[2] for o in out], "kept_sha256": [hashlib.sha256(o[0]).hexdigest() for o in out]}

    named = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return without_repeats(named, ["_id"], "_t", run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of a stored table with repeated bytes cut out of the text, all other columns as
    they were. Characters of which only some bytes were cut are dropped; null texts stay null."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches):
        for b in batches:
            texts = [None if t is None else cut(t, s)[0].decode("utf-8", "ignore")
                     for t, s in zip(b["_text"].to_pylist(), b["_spans"].to_pylist(), strict=True)]
            yield {**{c: b[f"_c{i}"] for i, c in enumerate(others)}, text_col: texts}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return without_repeats(docs, others, text_col, run, ddl)
