"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes that cover all of them.  The network
embeds bytes, applies filters of several widths, takes each filter's maximum over
the window and a softmax over the languages; a document's score is the average
over its windows by length.  The network is trained in numpy on a bounded sample
of labelled rows (``SAMPLE`` rows a language by hash of the id, at most
``WINDOWS_PER_ROW`` windows of each, spread over the text); prediction reads whole
texts.

A filter over bytes is a sum of table lookups, so trained weights are folded into
one table per pair of neighbouring bytes.

Defined cases: ``und`` with score 0 for null texts and texts without a letter, or
if nothing can be learned; null languages teach nothing; rows without id are
predicted and neither learned from nor held out; repeated rows are predicted
each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 16, 8
SAMPLE, WINDOWS_PER_ROW, EPOCHS, BATCH, RATE = 400, 4, 6, 64, 0.01
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Windows that are scored at a time.
BLOCK = 256
LETTER = re.compile(r"[^\W\d_]")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def windows_of(text: str) -> np.ndarray:
    """Rows of WINDOW bytes; the last is padded with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = data
    return out.reshape(n, WINDOW)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray                  # 256, EMBEDDING
    filters: list[np.ndarray]              # per width: width, EMBEDDING, FILTERS
    bias: np.ndarray                       # widths * FILTERS
    out: np.ndarray                        # widths * FILTERS, languages
    out_bias: np.ndarray

    def fold_tables(self) -> None:
        """Per width the tables that pairs of bytes look up, each with the pair's offset."""
        self.tables = []
        for w in self.filters:
            single = [self.embedding @ w[k] for k in range(len(w))]            # 256, FILTERS
            pairs = [((single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS).astype(np.float32), k)
                     for k in range(0, len(w) - 1, 2)]
            odd = (single[-1].astype(np.float32), len(w) - 1) if len(w) % 2 else None
            self.tables.append((len(w), pairs, odd))

    def hidden(self, x: np.ndarray) -> np.ndarray:
        """Maximum of each filter over each window."""
        pair = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        found = []
        for width, pairs, odd in self.tables:
            n = WINDOW - width + 1
            total = None
            for table, k in pairs:
                part = table[pair[:, k:k + n]]
                total = part if total is None else np.add(total, part, out=total)
            if odd is not None:
                np.add(total, odd[0][x[:, odd[1]:odd[1] + n]], out=total)
            found.append(total.max(axis=1))
        return np.hstack(found) + self.bias

    def shares(self, x: np.ndarray) -> np.ndarray:
        h = np.vstack([self.hidden(x[k:k + BLOCK]) for k in range(0, len(x), BLOCK)])
        return _softmax(np.maximum(h, 0) @ self.out + self.out_bias)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        result = [(UNKNOWN, 0.0)] * len(texts)
        todo = [(k, t) for k, t in enumerate(texts) if t and LETTER.search(t)]
        at = 0
        while at < len(todo):
            taken, size = [], 0
            while at < len(todo) and (not taken or size < 4 * BLOCK):        # short texts share a batch
                w = windows_of(todo[at][1])
                taken.append((todo[at][0], w))
                size += len(w)
                at += 1
            p = self.shares(np.vstack([w for _, w in taken]))
            begin = 0
            for k, w in taken:
                own = p[begin:begin + len(w)]
                begin += len(w)
                weight = np.full(len(w), 1.0)
                weight[-1] = np.count_nonzero(w[-1]) / WINDOW
                mean = weight @ own / weight.sum()
                best = int(mean.argmax())
                result[k] = (self.languages[best], float(min(1.0, mean[best])))
        return result


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 0) -> Network:
    """Adam on the cross-entropy; the gradient of a maximum goes to the bytes that reached it."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, s=1.0: (rng.standard_normal(shape) * s).astype(np.float32)
    hidden = len(WIDTHS) * FILTERS
    params = [normal(256, EMBEDDING, s=0.5), *[normal(w, EMBEDDING, FILTERS, s=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
              np.zeros(hidden, np.float32), normal(hidden, len(languages), s=hidden ** -0.5),
              np.zeros(len(languages), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        for chosen in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            emb, *filters, bias, out, out_bias = params
            xb, yb = x[chosen], y[chosen]
            spots, pre = [], []
            e = emb[xb]                                                   # batch, WINDOW, EMBEDDING
            for w in filters:
                n = WINDOW - len(w) + 1
                z = sum(e[:, k:k + n] @ w[k] for k in range(len(w)))
                top = z.argmax(axis=1)                                    # batch, FILTERS
                spots.append(top)
                pre.append(np.take_along_axis(z, top[:, None], 1)[:, 0])
            h = np.hstack(pre) + bias
            p = _softmax(np.maximum(h, 0) @ out + out_bias)
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            grad_h = (p @ out.T) * (h > 0)
            grad_emb, grad_filters = np.zeros_like(emb), []
            for i, (w, top) in enumerate(zip(filters, spots, strict=True)):
                g = grad_h[:, i * FILTERS:(i + 1) * FILTERS]              # batch, FILTERS
                grad_w = np.zeros_like(w)
                for k in range(len(w)):
                    byte = np.take_along_axis(xb, top + k, 1)             # batch, FILTERS
                    grad_w[k] = np.einsum("bf,bfe->ef", g, emb[byte])
                    np.add.at(grad_emb, byte.ravel(), (g[:, :, None] * w[k].T[None]).reshape(-1, EMBEDDING))
                grad_filters.append(grad_w)
            grads = [grad_emb, *grad_filters, grad_h.sum(axis=0), np.maximum(h, 0).T @ p, p.sum(axis=0)]
            step += 1
            for k, g in enumerate(grads):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] = params[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    emb, *filters, bias, out, out_bias = params
    net = Network(languages, emb, filters, bias, out, out_bias)
    net.fold_tables()
    return net


def sample_windows(docs: DataFrame) -> pd.DataFrame:
    """``lang, bytes`` of at most SAMPLE * WINDOWS_PER_ROW windows a language, from the learning folds."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    ids = (known.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"))
           .withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE).select("doc_id", "lang"))

    def cut(batches):
        for pdf in batches:
            rows = []
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                if LETTER.search(text):
                    w = windows_of(text)
                    rows += [(lang, w[k].tobytes())
                             for k in np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_ROW).astype(int))]
            yield pd.DataFrame(rows, columns=["lang", "bytes"])

    # bounded by SAMPLE ids a language
    chosen = known.select("doc_id", "lang", text_or_empty().alias("text")).join(F.broadcast(ids), ["doc_id", "lang"])
    return chosen.mapInPandas(cut, "lang string, bytes binary").toPandas()


def fit(docs: DataFrame) -> Network | None:
    """The network, or nothing if there are no labelled texts."""
    rows = sample_windows(docs).sort_values(["lang", "bytes"], ignore_index=True)
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    x = np.frombuffer(b"".join(rows["bytes"]), np.uint8).reshape(-1, WINDOW)
    return train(x, np.searchsorted(languages, rows["lang"]), languages)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    net = fit(docs)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = net.predict(list(texts)) if net else [(UNKNOWN, 0.0)] * len(texts)
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), predict(text_or_empty()).alias("p"))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
                       "p.lang_pred", "p.score")
