"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a text: density of lexicon words (given and learned), density of learned word
beginnings, hits near a second-person word, capitals, punctuation, exclamation marks, obfuscated
spellings and length. The trees are grown in numpy on the driver on a bounded sample of labelled
rows (``sample_rows`` rows, of long texts ``pieces`` spread over the whole text); scoring is one pass
over whole texts without a shuffle.

Null and empty texts get the score of a text without any hit. Rows with a null id or a null label
are not learned from. With no labelled rows, or labels of one class only, the score is the share
of label 1 (0 with no rows). Repeated rows are scored alike. Extra columns are left as they are.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import fold, small_batches, spread

# fixed values: common insults and second-person words
INSULTS = ("idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "pathetic", "worthless",
           "disgusting", "clown", "garbage", "fool", "jerk", "filth", "vermin", "imbecile", "creep")
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi "
                          "ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())

_LEET = str.maketrans("013457@$", "oieastas")
_BREAKS = str.maketrans({c: " " for c in "\"#%&()+,/:;<=>?[\\]^`{|}~“”«»¡¿…\t\n\r"})
_EDGE = ".!-_*'"
_INNER = re.compile(r"[a-zà-ÿ][\d@$*_.\-]+[a-zà-ÿ]")
_STEM = range(3, 8)
NEAR = 4
_LETTERS = np.r_[65:91, 97:123, 192:256]
_MARKS = np.r_[33:48, 58:65, 91:97, 123:127]


def words_of(chunk: str) -> list[tuple[str, bool]]:
    """Lower-case words of a piece of text without white space, and whether each was disguised."""
    out = []
    for w in chunk.lower().translate(_BREAKS).split():
        w = w.strip(_EDGE)
        hidden = bool(w) and not w.isalpha() and _INNER.search(w) is not None
        if hidden:
            w = re.sub(r"[*_.\-]", "", w.translate(_LEET))
        if w:
            out.append((w, hidden))
    return out


def _distinct(text: str) -> set[str]:
    return {w for c in set(text.split()) for w, _ in words_of(c)}


class _Chunks(dict):
    """What the words of a chunk count for; 0 stands for one word of no interest.

    Otherwise (words, disguised, lexicon weight or 0, best stem weight or 0, second person, letter).
    """

    LIMIT = 300_000

    def __init__(self, lexicon: dict[str, float], stems: dict[str, float]):
        super().__init__()
        self.lexicon, self.stems = lexicon, stems
        self.lengths = sorted({len(s) for s in stems})

    def word(self, w: str) -> tuple[float, float]:
        got = self.lexicon.get(w, 0.0)
        stem = 0.0 if got else max((self.stems.get(w[:k], 0.0) for k in self.lengths if len(w) >= k),
                                   default=0.0)
        return got, stem

    def __missing__(self, chunk: str):
        words = words_of(chunk)
        hits = [self.word(w) for w, _ in words]
        person = any(w in SECOND_PERSON for w, _ in words)
        letter = words[0][0] if len(words) == 1 and len(words[0][0]) == 1 else ""
        out = (len(words), sum(h for _, h in words), [h for h, _ in hits if h],
               [t for _, t in hits if t], person, letter)
        value = 0 if out == (1, 0, [], [], False, "") else out
        if len(chunk) <= 40:
            if len(self) >= self.LIMIT:
                self.clear()
            self[chunk] = value
        return value


@dataclass
class ToxicityModel:
    lexicon: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    trees: list = field(default_factory=list)
    base: float = 0.0
    steps: tuple = ((), ())
    _chunks: _Chunks | None = None

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        if self._chunks is None:
            self._chunks = _Chunks(self.lexicon, self.stems)
        chunks = self._chunks
        found = [chunks[c] for c in text.split()]
        n, hidden, hits, near, stems, person, spelled, last = len(found), 0, [], 0, [], [], "", -2
        marked = [(i, v) for i, v in enumerate(found) if v]
        person = [i for i, v in marked if v[4]]
        for i, (count, disguised, own, stem, _, letter) in [*marked, (n + 1, (1, 0, [], [], 0, ""))]:
            n += count - 1
            hidden += disguised
            if spelled and (not letter or i != last + 1):
                if len(spelled) >= 4:  # a word spelled letter by letter
                    hidden += 1
                    a, b = chunks.word(spelled)
                    own, stem = [*own, a] if a else own, [*stem, b] if b else stem
                spelled = ""
            if letter:
                spelled, last = (spelled + letter)[:64], i
            if own:
                hits += own
                k = bisect_left(person, i - NEAR)
                near += k < len(person) and person[k] <= i + NEAR
            stems += stem
        weight, stem_weight = sum(hits), sum(stems)
        chars = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
        letters, marks = int(chars[_LETTERS].sum()), int(chars[_MARKS].sum())
        capitals = int(chars[65:91].sum())
        per = 100.0 / max(n, 1)
        return [len(hits) * per, min(len(hits), 20), weight * per, min(weight, 60.0), near * per,
                len(stems) * per, stem_weight * per, min(stem_weight, 60.0), capitals / max(letters, 1),
                marks / max(len(text), 1), int(chars[33]) * per, hidden * per, math.log1p(n)]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(_DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += leaf[node - (2 ** _DEPTH - 1)]
        return out

    def score(self, texts: pd.Series) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        raw = self.raw(np.array([self.features(t) for t in texts], float))
        return np.interp(raw, *self.steps) if len(self.steps[0]) else 1 / (1 + np.exp(-raw))


_DEPTH = 3


def _grow(x_bins: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          rate: float, l2: float = 1.0) -> tuple:
    """One tree of fixed depth on binned features, in breadth-first arrays."""
    inner = 2 ** _DEPTH - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(grad), np.int64)
    for k in range(inner):
        own = np.flatnonzero(node == k)
        right = np.zeros(len(own), bool)
        if len(own) >= 8:
            g, h, best = grad[own], hess[own], (1e-6, None, None)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                gs = np.bincount(x_bins[own, f], g, len(e) + 1).cumsum()
                hs = np.bincount(x_bins[own, f], h, len(e) + 1).cumsum()
                gain = (gs ** 2 / (hs + l2) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + l2)
                        - gs[-1] ** 2 / (hs[-1] + l2))[:-1]
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (gain[b], f, b)
            if best[1] is not None:
                feature[k], cut[k] = best[1], edges[best[1]][best[2]]
                right = x_bins[own, best[1]] > best[2]
        node[own] = 2 * k + 1 + right
    last = node - inner
    leaf = -np.bincount(last, grad, 2 ** _DEPTH) / (np.bincount(last, hess, 2 ** _DEPTH) + l2) * rate
    return feature, cut, leaf


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a monotone curve from raw scores to shares of label 1."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum, count, lowest and highest raw score
    for r, v in zip(raw[order], y[order], strict=True):
        blocks.append([v, 1, r, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, top = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = top
    xs, ys = [], []
    for s, n, low, high in blocks:
        share = (s + 0.01) / (n + 0.02)
        xs += [low] if low == high else [low, high]
        ys += [share] if low == high else [share, share]
    keep = np.concatenate([[True], np.diff(xs) > 0]) if xs else np.zeros(0, bool)
    return np.array(xs)[keep], np.maximum.accumulate(np.array(ys)[keep])


def _lift(toxic: Counter, clean: Counter, n1: int, n0: int, floor: int) -> dict[str, float]:
    out = {}
    for w, c in toxic.items():
        if c >= floor:
            odds = math.log((c + 0.5) / (n1 + 1) * (n0 + 1) / (clean[w] + 0.5))
            if odds > 2.5 and clean[w] <= c / 4:
                out[w] = min(odds, 6.0)
    return out


def fit(texts: list[str | None], labels: list[int], folds: list[int],
        trees: int = 60, rate: float = 0.2) -> ToxicityModel:
    """Lexicon from folds 2 and 3, trees from 4 and the first two, calibration from fold 1.

    ``folds`` holds numbers other than 0; rows of one fold are used for one purpose at a time,
    so that the lexicon's own rows don't make its features look better than they are.
    """
    y, fold_of = np.array(labels, float), np.array(folds)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(steps=(np.array([0.0, 1.0]), np.array([share, share])))

    def learned(rows: np.ndarray) -> ToxicityModel:
        seen = {0: (Counter(), Counter(), 0), 1: (Counter(), Counter(), 0)}
        for i in rows:
            ws = {w for w in _distinct(texts[i] or "") if len(w) > 2}
            a, b, n = seen[int(y[i])]
            a.update(ws)
            b.update({w[:k] for w in ws for k in _STEM if len(w) > k})
            seen[int(y[i])] = (a, b, n + 1)
        floor = max(3, int(0.01 * seen[1][2]))
        lexicon = _lift(seen[1][0], seen[0][0], seen[1][2], seen[0][2], floor)
        stems = _lift(seen[1][1], seen[0][1], seen[1][2], seen[0][2], floor)
        return ToxicityModel(lexicon={**dict.fromkeys(INSULTS, 4.0), **lexicon}, stems=stems)

    own, other = np.isin(fold_of, (2, 3)), fold_of == 4
    if not (y[own].any() and y[other].any()):
        own = other = np.ones(len(y), bool)
    model = learned(np.flatnonzero(own))
    rows = np.flatnonzero(other)
    x = np.array([model.features(texts[i]) for i in rows], float)
    target = y[rows]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    share = target.mean()
    model.base = math.log(max(share, 1e-3) / max(1 - share, 1e-3))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-model.raw(x))) if not model.trees else 1 / (1 + np.exp(-now))
        tree = _grow(bins, edges, p - target, np.maximum(p * (1 - p), 1e-6), rate)
        model.trees.append(tree)
        now = model.raw(x)
    rest = np.flatnonzero(fold_of == 1)
    if len(rest) >= 50 and y[rest].any():
        raw = model.raw(np.array([model.features(texts[i]) for i in rest], float))
        model.steps = isotonic(raw, y[rest])
    model._chunks = None  # not sent to the tasks
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, pieces: int = 5, piece_chars: int = 4000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows of folds other than 0, chosen by id hash.

    Of a text longer than ``pieces`` x ``piece_chars`` characters so many pieces are read, spread over the whole of it.
    """
    small_batches(docs.sparkSession)
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()
                           & (fold(F.col(id_col), 5) != 0))
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    rows = (docs.select(F.col(id_col).alias("_id"), spread(F.col(text_col), pieces, piece_chars).alias("_text"))
            .join(F.broadcast(chosen), "_id")  # at most sample_rows ids
            .select("_text", "_y", fold(F.col("_id"), 5).alias("_fold"))
            .orderBy(F.xxhash64("_id"), "_text").limit(sample_rows).collect())
    return fit([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


def score(text: Column, model: ToxicityModel) -> Column:
    """The score of whole texts as a column, 0 to 1."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.score(texts), 0.0, 1.0))

    return scored(text)
