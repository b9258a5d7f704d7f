"""Language ID: a byte convolutional network over fixed-length windows, trained in numpy.

Filters of several widths slide over the one-hot bytes of a window, their highest values over the window
feed a softmax. A filter's weights are one number per place and byte, so its values are sums of table
look-ups; pairs of bytes share one table. A text is cut into consecutive windows, the last one
padded, and the mean of their probabilities, weighted by their letters, is its result; no byte
is left out. Training takes at most ``rows_per_language`` rows of a language and ``sample_rows`` in all, chosen by id hash; of a text
longer than ``pieces`` x ``piece_chars`` characters so many pieces, spread over the whole of it; and ``windows`` windows of what is taken.

Null texts and texts without a letter are ``und`` with score 0. Rows with null id, language or text are
not learned from; with no rows to learn from everything is ``und``. Repeated rows are predicted alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doorledger.llm.common import fold, spread

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 8
_BATCH = 1024
_LETTER = np.zeros(256, np.float32)
_LETTER[np.r_[65:91, 97:123, 128:256]] = 1


def windows_of(data: bytes) -> np.ndarray:
    """Consecutive windows of a text, the last one filled up with spaces."""
    n = -(-len(data) // WINDOW) * WINDOW
    return np.frombuffer(data.ljust(n, b" "), np.uint8).reshape(-1, WINDOW)


@dataclass
class ByteCNN:
    languages: list[str]
    filters: dict[int, np.ndarray] = field(default_factory=dict)  # width: (width, 256, FILTERS)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    _pairs: dict | None = None

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> ByteCNN:
        rng = np.random.default_rng(seed)
        return cls(languages, {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
                   rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32),
                   np.zeros(len(languages), np.float32))

    def tables(self) -> dict:
        """Per width, tables of byte pairs (and a last single byte)."""
        if self._pairs is None:
            self._pairs = {w: [(f[i][:, None, :] + f[i + 1][None, :, :]).reshape(1 << 16, FILTERS) if i + 1 < w else f[i]
                               for i in range(0, w, 2)] for w, f in self.filters.items()}
        return self._pairs

    def pooled(self, x: np.ndarray, places: bool = False):
        """Highest value of each filter in each window, and where it is."""
        pairs = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        tops, where = [], []
        for w, tables in self.tables().items():
            n = WINDOW - w + 1
            value = np.take(tables[0], pairs[:, :n], axis=0)
            for k, t in enumerate(tables[1:], 1):
                value = value + np.take(t, pairs[:, 2 * k:2 * k + n] if len(t) > 256 else x[:, 2 * k:2 * k + n], axis=0)
            if places:
                at = value.argmax(1)
                where.append(at)
                tops.append(np.take_along_axis(value, at[:, None, :], 1)[:, 0])
            else:
                tops.append(value.max(1))
        top = np.concatenate(tops, 1)
        return (top, where) if places else top

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), _BATCH):
            out.append(_softmax(np.tanh(self.pooled(x[i:i + _BATCH])) @ self.weights + self.bias))
        return np.concatenate(out)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.02, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        moments = {}

        def step(name, value, grad):  # Adam
            m, v, t = moments.get(name, (0.0, 0.0, 0))
            m, v, t = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2, t + 1
            moments[name] = (m, v, t)
            value -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)

        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                rows = order[i:i + 64]
                self._pairs = None
                top, where = self.pooled(x[rows], places=True)
                hidden = np.tanh(top)
                p = _softmax(hidden @ self.weights + self.bias)
                p[np.arange(len(rows)), y[rows]] -= 1
                p /= len(rows)
                back = (p @ self.weights.T) * (1 - hidden ** 2)
                for k, w in enumerate(WIDTHS):
                    grad = np.zeros_like(self.filters[w])
                    g = back[:, k * FILTERS:(k + 1) * FILTERS]
                    for j in range(w):
                        byte = np.take_along_axis(x[rows], where[k] + j, 1)
                        np.add.at(grad[j], (byte, np.arange(FILTERS)[None, :].repeat(len(rows), 0)), g)
                    step(w, self.filters[w], grad)
                step("w", self.weights, hidden.T @ p)
                step("b", self.bias, p.sum(0))
        self._pairs = None

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and probability per text; all windows of several texts go through together."""
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        held, of = [], []

        def finish():
            x = np.concatenate(held)
            weight = _LETTER[x].sum(1) + 1e-3
            p = self.probabilities(x) * weight[:, None]
            at = np.concatenate([np.full(len(h), i) for h, i in zip(held, of, strict=True)])
            heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            mean = np.add.reduceat(p, heads) / np.add.reduceat(weight, heads)[:, None]
            for i, row in zip(at[heads], mean, strict=True):
                names[i], scores[i] = self.languages[int(row.argmax())], float(np.clip(row.max(), 0, 1))
            held.clear()
            of.clear()

        size = 0
        for i, t in enumerate(texts):
            if t and any(map(str.isalpha, t)):
                held.append(windows_of(t.encode("utf-8", "replace")))
                of.append(i)
                size += len(held[-1])
                if size >= 4 * _BATCH:
                    finish()
                    size = 0
        if held:
            finish()
        return names, scores


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[str], labels: list[str], windows: int = 6) -> ByteCNN:
    languages = sorted(set(labels))
    model = ByteCNN.fresh(languages)
    if not languages:
        return model
    xs, ys = [], []
    for t, lang in zip(texts, labels, strict=True):
        w = windows_of(t.encode("utf-8", "replace"))
        w = w[_LETTER[w].sum(1) >= 8] if len(w) else w
        take = w[np.linspace(0, len(w) - 1, min(windows, len(w))).astype(int)] if len(w) else w
        xs.append(take)
        ys += [languages.index(lang)] * len(take)
    if ys:
        model.train(np.concatenate(xs), np.array(ys))
    return model


def train(docs: DataFrame, rows_per_language: int = 375, sample_rows: int = 3000, pieces: int = 6, piece_chars: int = 1300,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCNN:
    """Fit on rows of folds other than 2 (of 4), chosen by id hash: a bounded number per language and in all.

    Where more languages occur than ``sample_rows`` has room for, each gives equally many. Of rows that repeat
    an id and a language the lowest text is taken.
    """
    usable = (docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                         & (fold(F.col(id_col), 4) != 2))
              .select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")))
    nth = F.row_number().over(Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    ids = (usable.select("_id", "_lang").distinct().withColumn("_nth", nth).where(F.col("_nth") <= rows_per_language)
           .orderBy("_nth", F.xxhash64("_id"), "_id", "_lang").limit(sample_rows).drop("_nth"))
    rows = (usable.join(F.broadcast(ids), ["_id", "_lang"])  # at most sample_rows ids, found before any text is moved
            .groupBy("_id", "_lang").agg(F.min(spread(F.col("_text"), pieces, piece_chars)).alias("_text"))
            .orderBy(F.xxhash64("_id"), "_lang").collect())
    return fit([r["_text"] for r in rows], [r["_lang"] for r in rows])


def predicted(text: Column, model: ByteCNN) -> Column:
    """(lang_pred, score) of whole texts."""
    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return run(text)
