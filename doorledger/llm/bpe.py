"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

A merge list decides how far to its left the end of what has been read can still change tokens. That sufficient
lookahead is computed from the list (``sufficient_lookahead``); a word of any length is encoded
through a window of a few times as many symbols, and every token that ends further than the lookahead before
the window's end is emitted, since nothing that follows can change it. Decoding maps ids to bytes and
emits text as soon as its characters are complete.

Ids are those of a ``tokenizers`` file of the BPE kind with byte-level symbols and an end-of-word mark; its own
normalizer and splitting rule are applied to pieces between white space, which no word and no
canonical composition crosses. The strings of added tokens inside a text are those tokens.
Texts of a batch are cut together, and each of its distinct words is merged once, all words of one length step by step in
arrays; what needs the library or a window is encoded piece by piece.
Null and empty texts have no ids. Repeated rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import kept, map_rows

#: distinct pieces of text whose ids a task keeps at hand, and the longest of them and of the words merged together (below 64)
CACHE, CACHED = 500_000, 48
#: characters of a long text that are encoded at a time, and of a piece that the library splits
BLOCK, SLICE = 1 << 20, 1 << 14
#: bytes of short texts that are encoded together
AHEAD = 1 << 22

_SPACE = regex.compile(r"\s+")
# fixed values: the splitting rule of the files that lower-case and drop white space
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(_RULE)
#: byte-level symbols: visible Latin-1 characters stand for themselves, other bytes follow from U+0100 on
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_BYTES = [chr(b) if b in _SHOWN else chr(256 + _HIDDEN.index(b)) for b in range(256)]
_CUT = re.compile(r"(?<=[A-Za-z]{3})(?=[A-Za-z])")


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols before the end of what was read a token can still change.

    Unequal continuations change tokens from right to left only by a chain of merges of falling priority:
    a token c that would join its right neighbour does or does not do so, and this shows to the token
    left of it only through a later merge (b, e) whose right part e begins with c. The
    longest such chain, each link as long as its left part, bounds the change. The list must be proper, that
    is, parts of a merge come from earlier merges.
    """
    made: dict[str, tuple[str, str]] = {}
    reach: dict[str, int] = {}
    longest = 0
    parts = {x for pair in merges for x in pair}
    products = {a + b for a, b in merges}
    for a, b in merges:
        if any(x in parts and x in products and x not in made for x in (a, b)):
            raise ValueError(f"merge ({a}, {b}) comes before the merge that makes its parts")
        e, best = b, 0
        while True:
            best = max(best, reach.get(e, 0))
            if e not in made:
                break
            e = made[e][0]
        chain = best + _symbols(a)
        longest = max(longest, chain)
        reach[a] = max(reach.get(a, 0), chain)
        made.setdefault(a + b, (a, b))
    return longest + max((_symbols(p) for p in products), default=1)


_MARK = "</w>"


def _symbols(token: str) -> int:
    return len(token) - len(_MARK) + 1 if token.endswith(_MARK) and len(token) > len(_MARK) else len(token)


class Vocabulary:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        model = json.loads(Path(path).read_text(encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.mark = model["model"].get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        ids = self.ids
        self.rank = {ids[a] << 20 | ids[b]: i for i, (a, b) in enumerate(merges)}
        self.made = [ids[a + b] for a, b in merges]
        self.pairs, self.products = _Pairs(self.rank), np.array(self.made, np.int32)
        # every byte has a symbol, also one that ends a word
        self.symbol = {c: ids[c] for c in _BYTES}
        self.last = {c: ids[c + self.mark] for c in _BYTES}
        self.symbols, self.lasts = (np.array([of[c] for c in _BYTES], np.int32) for of in (self.symbol, self.last))
        self.lookahead = sufficient_lookahead(merges)
        rules = [r.get("pattern", {}).get("Regex") for r in model["pre_tokenizer"].get("pretokenizers", [])]
        kinds = [n["type"] for n in (model["normalizer"] or {}).get("normalizers", [])]
        self.plain = rules[:1] == [_RULE] and kinds == ["NFC", "Replace", "Lowercase"]
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        size = max([*self.ids.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for token, i in {**self.ids, **self.added}.items():
            self.tokens[i] = token
        self.width = [_symbols(t) for t in self.tokens]

    def merged(self, parts: list[int]) -> list[int]:
        """All merges applied, lowest rank first, from the left within a rank; changes ``parts``."""
        rank, none, made = self.rank.get, 1 << 30, self.made
        ranks = [rank(a << 20 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            parts[i] = new = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(new << 20 | parts[i + 1], none)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | new, none)
        return parts


    def merged_together(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length, their bytes in rows, and the number of each one's: all go on by their next merge at a time.

        As ``merged`` does word by word, the lowest rank goes first, from the left within a rank. Places of symbols are rows
        and words columns. A merge leaves its token in the left place and empties the right one; one more row stands
        for what lies before and behind a word.
        """
        n, size = words.shape
        parts = np.full((size + 1, n), _Pairs.NOTHING, np.int32)
        parts[:-1] = self.symbols[words].T
        parts[-2] = self.lasts[words[:, -1]]
        places = np.arange(size + 1)
        follow, lead = (np.repeat(x % (size + 1), n) for x in (places + 1, places - 1))
        none = _Pairs.NONE << 6
        queue = np.full((size + 1, n), none, np.int32)  # of each place the rank of its pair, and the place
        for i in range(size - 1):
            queue[i] = self.pairs.ranks(parts[i], parts[i + 1]) << 6 | i
        tokens, first = parts.reshape(-1), queue.reshape(-1)
        while True:
            low = queue.min(axis=0)
            word = np.flatnonzero(low < none)
            if not len(word):
                break
            low = low[word]
            i, new = low & 63, self.products[low >> 6]
            here = i * np.int64(n) + word
            right = follow[here] * n + word
            j, k = lead[here], follow[right]
            before, behind = j * n + word, k * n + word
            tokens[here], tokens[right] = new, _Pairs.NOTHING
            follow[here], lead[behind], first[right] = k, i, none
            ranks = self.pairs.ranks(np.concatenate([new, tokens[before]]), np.concatenate([tokens[behind], new])) << 6
            first[here], first[before] = ranks[:len(word)] | i, ranks[len(word):] | j
        left = parts.T != _Pairs.NOTHING
        return parts.T[left].astype("<u4"), left.sum(axis=1)


class _Pairs:
    """Ranks of pairs of tokens for whole arrays, by open addressing."""

    NOTHING, NONE = (1 << 20) - 1, 1 << 24

    def __init__(self, rank: dict[int, int]):
        self.bits = len(rank).bit_length() + 2
        self.keys, self.rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.NONE, np.int32)
        pairs, ranks = np.array(list(rank), np.int64), np.array(list(rank.values()), np.int32)
        slots = self._slots(pairs)
        while len(pairs):
            slots, first = self._next_free(slots)
            self.keys[slots[first]], self.rank[slots[first]] = pairs[first], ranks[first]
            rest = np.ones(len(pairs), bool)
            rest[first] = False
            pairs, ranks, slots = pairs[rest], ranks[rest], slots[rest]

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next_free(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next free slot from each one on, and which of these come first to theirs."""
        while len(taken := np.flatnonzero(self.keys[slots] >= 0)):
            slots[taken] = (slots[taken] + 1) % len(self.keys)
        return slots, np.unique(slots, return_index=True)[1]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = a.astype(np.int64) << 20 | b
        slots = self._slots(pairs)
        found, out = self.keys[slots], self.rank[slots]
        off = np.flatnonzero(found != pairs)
        while len(off):
            out[off] = self.NONE
            off = off[found[off] >= 0]  # another pair stands there: on to the next slot
            slots[off] = (slots[off] + 1) % len(self.keys)
            found[off], out[off] = self.keys[slots[off]], self.rank[slots[off]]
            off = off[found[off] != pairs[off]]
        return out


class WordTransducer:
    """Streams the symbols of one word to its tokens, holding a window of bounded length."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.window = vocabulary, ""
        self.limit = 2 * vocabulary.lookahead + 64

    def feed(self, symbols: str) -> Iterator[int]:
        for i in range(0, len(symbols), self.limit):
            self.window += symbols[i:i + self.limit]
            if len(self.window) > self.limit:
                # the last symbol may yet turn out to end the word, and then it is another one
                stable, done = len(self.window) - 1 - self.v.lookahead, 0
                for token in self.v.merged([self.v.symbol[c] for c in self.window[:-1]]):
                    if done + self.v.width[token] > stable:
                        break
                    done += self.v.width[token]
                    yield token
                self.window = self.window[done:]

    def close(self) -> Iterator[int]:
        if self.window:
            yield from self.v.merged([self.v.symbol[c] for c in self.window[:-1]] + [self.v.last[self.window[-1]]])
        self.window = ""


class _Cutter:
    """Cuts texts in UTF-8 at white space, and pieces of visible composed Latin characters, lower-cased, into words.

    Other pieces stay whole and as they are, as do those with an apostrophe or an added token. Characters up to U+0250 go by a table.
    """

    SPACE, LETTER, NUMBER, OTHER, ODD = range(5)

    def __init__(self, vocabulary: Vocabulary):
        self.added = re.compile(vocabulary.split_added.pattern.encode()) if vocabulary.split_added else None
        self.kinds, self.lower = np.full(0x280, self.ODD, np.uint8), np.arange(0x280)
        for i in range(0x250):
            c, low = chr(i), chr(i).lower()
            if _SPACE.fullmatch(c):
                self.kinds[i] = self.SPACE
            elif vocabulary.plain and c.isprintable() and c != "'" and len(low) == 1 and ord(low) < 0x250:
                self.lower[i] = ord(low)
                self.kinds[i] = (self.LETTER if regex.fullmatch(r"\p{L}", low) else
                                 self.NUMBER if regex.fullmatch(r"\p{N}", low) else self.OTHER)
        self.byte_kinds, self.byte_lower = np.full(256, self.ODD, np.uint8), np.arange(256, dtype=np.uint8)
        self.byte_kinds[:128], self.byte_lower[:128] = self.kinds[:128], self.lower[:128]
        self.spaces = np.array([i for i in range(0x800, 0x10000) if _SPACE.fullmatch(chr(i))])

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words and uncut pieces in order, which of them are uncut pieces or words too long to merge at once, and how many end up to each text's end."""
        kind, low = self._read(data)
        filled = kind != self.SPACE
        begun = np.ones(len(data) + 1, bool)
        begun[1:-1] = ~filled[:-1]
        begun[offsets] = True
        begun = begun[:-1] & filled
        chunk = np.cumsum(begun, dtype=np.int32) - 1
        odd = np.zeros(len(data) + 1, bool)
        odd[chunk[kind == self.ODD]] = True
        uncut = odd[chunk] & filled
        begun[1:] |= filled[1:] & ~uncut[1:] & ((kind[1:] != kind[:-1]) | ((kind[1:] == self.NUMBER) & (data[1:] & 0xC0 != 0x80)))
        np.copyto(low, data, where=uncut)
        starts = np.flatnonzero(begun)
        kept = low[filled]
        cuts = np.append(np.flatnonzero(begun[filled]), len(kept)).astype(np.int32)
        units = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(kept)])
        return units, uncut[starts] | (np.diff(cuts) > CACHED), np.searchsorted(starts, offsets[1:])

    def _read(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per byte the kind of its character, and the byte lower-cased."""
        kind, low = self.byte_kinds[data], self.byte_lower[data]
        leads = np.flatnonzero(data >= 0xC0)
        first = data[leads]
        two = leads[first < 0xCA]
        c = (data[two] & 31).astype(np.int32) << 6 | data[two + 1] & 63
        kind[two] = kind[two + 1] = self.kinds[c]
        c = self.lower[c]
        low[two], low[two + 1] = 0xC0 | c >> 6, 0x80 | c & 63
        three = leads[(first >= 0xE0) & (first < 0xF0)]
        c = (data[three] & 15).astype(np.int32) << 12 | (data[three + 1] & 63).astype(np.int32) << 6 | data[three + 2] & 63
        three = three[np.isin(c, self.spaces)]
        kind[three] = kind[three + 1] = kind[three + 2] = self.SPACE
        if self.added:
            for m in self.added.finditer(data):
                kind[m.start()] = self.ODD
        return kind, low


class Encoder:
    """Texts to ids, as unsigned 32-bit numbers in the byte order of the machine, little-endian here."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces, self.cutter = _Pieces(self), _Cutter(vocabulary)
        self.words: dict[str, bytes] = {}

    def blocks(self, text: str) -> Iterator[bytes]:
        """Ids of a whole text, block by block; blocks end at white space."""
        at = 0
        while at < len(text):
            end = at + BLOCK
            if end < len(text):
                space = _SPACE.search(text, end)
                end = space.end() if space else len(text)
            block = text if at == 0 and end >= len(text) else text[at:end]
            at = end
            if len(block) > 2 * BLOCK:  # hardly any white space
                yield b"".join(map(self.pieces.__getitem__, filter(None, _SPACE.split(block))))
            else:
                data = np.frombuffer(block.encode(), np.uint8)
                yield self._ids(data, np.array([0, len(data)]))[0].tobytes()

    def texts(self, column: pa.Array) -> Iterator[Iterable[bytes]]:
        """The blocks of each text of a column, null being empty; short texts are encoded together."""
        column = pc.fill_null(column, "").cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
        data = np.frombuffer(data or b"", np.uint8)
        start = 0
        while start < len(column):
            end = int(np.searchsorted(offsets, offsets[start] + AHEAD, "right")) - 1
            if end == start:
                yield self.blocks(column[start].as_py().decode())
                start += 1
                continue
            own = offsets[start:end + 1]
            ids, ends = self._ids(data[own[0]:own[-1]], own - own[0])
            yield from ((ids[a:b].tobytes(),) for a, b in pairwise([0, *ends.tolist()]))
            start = end

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in UTF-8, one after the other, and where those of each text end. Every distinct word is merged once."""
        units, odd, last = self.cutter.units(data, offsets)
        words, chunks = (units.filter(pa.array(x)).dictionary_encode() for x in (~odd, odd))
        ids, counts = self._of_words(words.dictionary)
        others = [self.pieces[c.decode()] for c in chunks.dictionary.to_pylist()]
        ids = np.concatenate([ids, np.frombuffer(b"".join(others), "<u4")])
        counts = np.concatenate([counts, np.fromiter(map(len, others), np.int64, len(others)) // 4])
        which = np.empty(len(units), np.int64)
        which[~odd] = words.indices.to_numpy()
        which[odd] = chunks.indices.to_numpy() + np.int64(len(words.dictionary))
        n = counts[which]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(counts) - counts)[which] - ends + n, n)
        at += np.arange(len(at))
        return ids[at], np.concatenate([[0], ends])[last]

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple words, one after the other, and their numbers; words of one length are merged together."""
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset)
        data = np.frombuffer(data or b"", np.uint8)
        sizes, counts = np.diff(offsets), np.zeros(len(words), np.int64)
        order = np.argsort(sizes, kind="stable")
        out, at = [], 0
        for size, n in zip(*np.unique(sizes, return_counts=True), strict=True):
            some = order[at:at + n]
            ids, counts[some] = self.v.merged_together(data[offsets[some, None] + np.arange(size)])
            out.append(ids)
            at += n
        if not out:
            return np.zeros(0, "<u4"), counts
        ids = np.concatenate(out)
        n = counts[order]
        starts = np.empty_like(counts)
        starts[order] = np.cumsum(n) - n
        back = np.repeat(starts - np.cumsum(counts) + counts, counts)
        back += np.arange(len(ids))
        return ids[back], counts

    def piece(self, chunk: str) -> bytes:
        """Ids of a piece of text without white space."""
        if not self.has_added(chunk):
            return self._plain(chunk)
        return b"".join(self.v.added[p].to_bytes(4, "little") if p in self.v.added else self._plain(p)
                        for p in self.v.split_added.split(chunk) if p)

    def has_added(self, chunk: str) -> bool:
        return self.v.split_added is not None and self.v.split_added.search(chunk) is not None

    def _plain(self, chunk: str) -> bytes:
        out, open_word = [], None
        for part, goes_on in _slices(chunk):
            words = self._split(part)
            for i, word in enumerate(words):
                ends = not goes_on or i < len(words) - 1
                if open_word is None and ends and len(word) <= CACHED:
                    out.append(self._word(word))
                    continue
                open_word = open_word or WordTransducer(self.v)
                out.append(array("I", open_word.feed(word)).tobytes())
                if ends:
                    out.append(array("I", open_word.close()).tobytes())
                    open_word = None
        return b"".join(out)

    def simple(self, part: str) -> bool:
        """Visible composed Latin characters only, which need neither normalizing nor the library."""
        return self.v.plain and part.isprintable() and (part.isascii() or max(part) < "\u0250")

    @staticmethod
    def _simple_words(part: str) -> list[str]:
        if part.isascii():
            low = part.lower()
            return [low] if low.isalpha() else _WORDS.findall(low)
        low = part.lower()
        words = [low] if low.isalpha() else _WORDS.findall(low)
        return ["".join(map(_BYTES.__getitem__, w.encode())) for w in words]

    def _split(self, part: str) -> list[str]:
        if self.simple(part):
            return self._simple_words(part)
        normal = self.v.library.normalizer.normalize_str(part) if self.v.library.normalizer else part
        return [w for w, _ in self.v.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            # shorter than any window: the transducer would only see its end
            ids = list(map(self.v.symbol.__getitem__, word))
            ids[-1] = self.v.last[word[-1]]
            got = self.words[word] = array("I", self.v.merged(ids)).tobytes()
        return got


def _slices(chunk: str) -> Iterator[tuple[str, bool]]:
    """A long piece in slices cut inside runs of ASCII letters, and whether the last word goes on."""
    at = 0
    while len(chunk) - at > SLICE:
        cut = _CUT.search(chunk, at + SLICE)
        if cut is None:
            break
        yield chunk[at:cut.start()], True
        at = cut.start()
    yield chunk[at:], False


class _Pieces(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) <= CACHED and self.encoder.simple(chunk) and not self.encoder.has_added(chunk):
            ids = b"".join(map(self.encoder._word, self.encoder._simple_words(chunk)))
        else:
            ids = self.encoder.piece(chunk)
        if len(chunk) <= CACHED:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = ids
        return ids


class Decoder:
    """Ids to text, incrementally: the state is the bytes of a character that is not complete.

    Token strings are joined by ``separator``, as the library does for files without a decoder.
    Bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self, table: list[bytes], separator: bytes = b" "):
        self.table, self.separator = table, separator
        self.pending, self.begun = b"", False

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        data = self.separator.join(map(self.table.__getitem__, ids))
        data = self.pending + (self.separator if self.begun else b"") + data
        self.begun = True
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):  # a lead byte that asks for more than there is
            byte = data[-back]
            if byte >= 0xC0:
                if back < 2 + (byte >= 0xE0) + (byte >= 0xF0):
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.pending, self.begun = self.pending.decode("utf-8", "replace"), b"", False
        return rest


_vocabulary = lru_cache(maxsize=2)(Vocabulary)


def encoder_of(path: str) -> Encoder:
    """The encoder of a file, kept with its cache, bounded by ``CACHE``, for an operator's tasks in a Python worker."""
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(_vocabulary(path))
    return kept["encoder", path]


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 of the whole text, in one pass."""
    def run(batches):
        encoder = encoder_of(path)
        table = [t.encode() for t in encoder.v.tokens]
        numerals = [str(i) for i in range(len(table))]
        decoder = Decoder(table)
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for blocks in encoder.texts(b["_text"]):
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                for block in blocks:
                    ids = np.frombuffer(block, "<u4").tolist()
                    if ids:
                        ids_hash.update(((" " if n else "") + " ".join(map(numerals.__getitem__, ids))).encode())
                        text_hash.update(decoder.feed(ids).encode())
                        n += len(ids)
                text_hash.update(decoder.close().encode())
                counts.append(n)
                ids_sha.append(ids_hash.hexdigest())
                text_sha.append(text_hash.hexdigest())
            yield {"id": b["_id"], "n_tokens": counts, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return map_rows(rows, run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
