"""Exact dedup: Patricia tries over whole byte strings own the smallest identifier of each text.

Each task inserts its texts into a trie, so that only one copy per task and text is shuffled;
length-and-content-hash partitions then insert those byte strings into tries of their own. Equal
hashes alone never make two texts equal. A trie over its memory budget hands on its heaviest
subtree and forgets it: its texts are then simply handed on twice and meet in the next trie.
In the second pass the rows come sorted by length and hash, so that all copies of a text are there before the next length
and hash; only between those does a partition's trie hand on subtrees, and their owners are final.

Texts are compared after replacing each run of bytes 0x20, 0x09-0x0D by one space; null counts as
empty. The row with the smallest id stays, null ids come last, and of rows repeated with the same
id the first one stays. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import RID, counted, decided, map_rows, numbered, shuffle_parts, stored

#: bytes of edges that one task's trie may hold
TRIE_BYTES = 96 << 20


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space replaced by one space."""
    out = b" ".join(text.split())
    if not out:
        return b" " if text else b""
    return b" " * text[:1].isspace() + out + b" " * text[-1:].isspace()


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``start``, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[start + low:start + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Node:
    __slots__ = ("edge", "children", "owner")

    def __init__(self, edge: bytes, owner: list | None = None):
        self.edge, self.children, self.owner = edge, {}, owner


class PatriciaTrie:
    """Compressed radix trie of byte strings; a terminal node holds its text's owner record."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def terminal(self, key: bytes) -> Node:
        """The node of ``key``, made where it is missing."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.size += len(key) - at + 200
                return child
            if key.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
                continue
            k = _common(child.edge, key, at)
            upper = Node(child.edge[:k])
            child.edge = child.edge[k:]
            upper.children[child.edge[0]] = child
            node.children[key[at]] = upper
            self.size += 200
            node, at = upper, at + k
        return node

    def subtrees(self) -> list[tuple[int, Node, int, bytes]]:
        """(bytes below, parent, branch, key before it) of the branches worth handing on."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            node = next(iter(node.children.values()))
            prefix += node.edge
        return [(sum(len(n.edge) + 200 for n, _ in walk(c, b"")), node, b, prefix)
                for b, c in node.children.items()] if node.children else []

    def spill(self) -> Iterator[tuple[bytes, list]]:
        """The texts and owners of the heaviest subtree, which is cut off."""
        found = self.subtrees()
        if not found:
            yield from self.drain()
            return
        size, parent, branch, prefix = max(found, key=lambda x: x[0])
        top = parent.children.pop(branch)
        self.size -= size
        for node, key in walk(top, prefix):
            if node.owner is not None:
                yield key, node.owner

    def drain(self) -> Iterator[tuple[bytes, list]]:
        for node, key in walk(self.root, b""):
            if node.owner is not None:
                yield key, node.owner
        self.root, self.size = Node(b""), 0


def walk(top: Node, prefix: bytes) -> Iterator[tuple[Node, bytes]]:
    stack = [(top, prefix)]
    while stack:
        node, before = stack.pop()
        key = before + node.edge
        yield node, key
        stack.extend((c, key) for c in node.children.values())


_MAPPED = ("member boolean, rid long, id long, label long, size long, hash long, n long, "
           "text binary, sha binary")
_OWNED = "label long, keep_id long, keep_rid long, group_size long"


def _order(doc_id: int | None, rid: int) -> tuple:
    return (doc_id is None, doc_id or 0, rid)


def _local(budget: int):
    """Rows of one task to member rows and one row per text that the task has seen.

    A text's label is the number of the first row that had it since the last spill.
    """
    def run(batches):
        trie = PatriciaTrie()

        def texts(found, limit: int = 4 << 20):
            rows, held = [], 0
            for key, (label, order, n) in found:
                sha = hashlib.sha256(key).digest()
                rows.append((label, order, n, key, sha))
                held += len(key)
                if held > limit:
                    yield rows
                    rows, held = [], 0
            if rows:
                yield rows

        def as_columns(rows):
            k = len(rows)
            return {"member": [False] * k, "rid": [r[1][2] for r in rows],
                    "id": [None if r[1][0] else r[1][1] for r in rows], "label": [r[0] for r in rows],
                    "size": [len(r[3]) for r in rows],
                    "hash": [int.from_bytes(r[4][:8], "big", signed=True) for r in rows],
                    "n": [r[2] for r in rows], "text": [r[3] for r in rows], "sha": [r[4] for r in rows]}

        for b in batches:
            rids, ids = b[RID].to_pylist(), b["_id"].to_pylist()
            labels, shas = [], []
            for rid, doc_id, text in zip(rids, ids, b["_text"], strict=True):
                key = normalised(text.as_py() or b"")
                node = trie.terminal(key)
                order = _order(doc_id, rid)
                if node.owner is None:
                    node.owner = [rid, order, 0]
                owner = node.owner
                owner[2] += 1
                if order < owner[1]:
                    owner[1] = order
                labels.append(owner[0])
                shas.append(hashlib.sha256(key).digest())
            k = len(rids)
            yield {"member": [True] * k, "rid": rids, "id": ids, "label": labels, "sha": shas,
                   "size": [None] * k, "hash": [None] * k, "n": [None] * k, "text": [None] * k}
            while trie.size > budget:
                for rows in texts(trie.spill()):
                    yield as_columns(rows)
        for rows in texts(trie.drain()):
            yield as_columns(rows)

    return run


def _owners(budget: int):
    """Owners of texts that come sorted by length and hash, from one trie over the whole partition.

    A trie over its budget spills its heaviest subtrees once a new length or hash begins: their texts don't come again.
    """
    def run(batches):
        trie, now, out = PatriciaTrie(), None, []

        def emit(found):
            for _, (order, n, labels) in found:
                keep = (None if order[0] else order[1], order[2])
                out.extend((label, *keep, n) for label in labels)

        def columns():
            rows, out[:] = list(zip(*out, strict=True)), []
            return {k: list(v) for k, v in zip(("label", "keep_id", "keep_rid", "group_size"), rows, strict=True)}

        for b in batches:
            cols = {k: b[k].to_pylist() for k in ("size", "hash", "id", "rid", "n", "label")}
            for i, text in enumerate(b["text"]):
                key = (cols["size"][i], cols["hash"][i])
                if key != now:
                    while trie.size > budget:
                        emit(trie.spill())
                    now = key
                order = _order(cols["id"][i], cols["rid"][i])
                node = trie.terminal(text.as_py())
                if node.owner is None:
                    node.owner = [order, 0, []]
                node.owner[0] = min(node.owner[0], order)
                node.owner[1] += cols["n"][i]
                node.owner[2].append(cols["label"][i])
            if out:
                yield columns()
        emit(trie.drain())
        if out:
            yield columns()

    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Per row of a stored table: _rid, id, keep_id, group_size, kept, text_sha256.

    ``_rid`` is that of a table from ``numbered``; of any other table it is only good within the result.
    """
    rows = (docs if RID in docs.columns else counted(docs)).select(RID, F.col(id_col).cast("long").alias("_id"),
                                 F.col(text_col).cast("binary").alias("_text"))
    mapped = stored(map_rows(rows, _local(trie_bytes), _MAPPED))
    owners = map_rows(mapped.where("not member").select("size", "hash", "id", "rid", "n", "label", "text")
                      .repartition(shuffle_parts(docs), "size", "hash").sortWithinPartitions("size", "hash"),
                      _owners(trie_bytes), _OWNED)
    members = mapped.where("member").select("rid", "id", "label", "sha")
    return members.join(owners, "label").select(
        F.col("rid").alias(RID), "id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of a stored table that stay, with all their columns."""
    rows = numbered(docs)
    kept = decided(lambda: exact_groups(rows, id_col, text_col).where("kept").select(RID))
    return rows.join(kept, RID, "left_semi").drop(RID)
