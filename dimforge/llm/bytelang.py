"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows,
each filter's largest response is kept, and a softmax layer names the
language. Training (numpy, Adam) runs on a bounded sample of labelled windows;
prediction covers every byte of every text, the windows' probabilities being
averaged by the bytes they hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from dimforge.llm.common import free_names, sampled, ship

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
# Windows overlap so that every run of max(WIDTHS) bytes lies in one of them.
STRIDE = WINDOW - max(WIDTHS) + 1
# Bound of the training sample: documents per language, the languages learned
# (the most frequent ones) and windows per document.
TRAIN_DOCS = 300
LANGUAGES = 100
TRAIN_WINDOWS = 3
EPOCHS = 10
BATCH = 64
RATE = 0.004
SEED = 20240
HELD_OUT = 5
UNKNOWN = "und"
WINDOWS_AT_ONCE = 96

LETTER = re.compile(r"[^\W\d_]")


def windows_of(text: bytes, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a byte text, the last padded with zero bytes, and the
    number of bytes that each adds."""
    n = max(1, -(-(len(text) - window) // stride) + 1)
    padded = np.zeros((n - 1) * stride + window, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    out = np.lib.stride_tricks.sliding_window_view(padded, window)[::stride]
    sizes = np.full(n, stride, np.float64)
    sizes[-1] = max(1, len(text) - (n - 1) * stride)
    return out, sizes


@dataclass
class ByteNet:
    """Weights: embedding (256, d), filters (width * d, all filters) with zeros
    below narrower filters, bias, output (filters, languages) and its bias."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(languages: list[str]) -> ByteNet:
        rng = np.random.default_rng(SEED)
        wide, d, k = max(WIDTHS), EMBEDDING, FILTERS * len(WIDTHS)
        filters = rng.normal(0, 0.3, (wide * d, k)).astype(np.float32) * ByteNet.mask()
        return ByteNet(languages, rng.normal(0, 0.5, (256, d)).astype(np.float32), filters, np.zeros(k, np.float32),
                       rng.normal(0, 0.2, (k, len(languages))).astype(np.float32),
                       np.zeros(len(languages), np.float32))

    @staticmethod
    def mask() -> np.ndarray:
        m = np.zeros((max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
        for i, w in enumerate(WIDTHS):
            m[:w * EMBEDDING, i * FILTERS:(i + 1) * FILTERS] = 1
        return m

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, filters) before pooling."""
        wide, d = max(WIDTHS), EMBEDDING
        e = self.embedding[x].reshape(len(x), -1)
        runs = np.lib.stride_tricks.sliding_window_view(e, wide * d, axis=1)[:, ::d]
        return (runs.reshape(-1, wide * d) @ self.filters).reshape(len(x), -1, self.filters.shape[1])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), WINDOWS_AT_ONCE):
            pooled = np.maximum(self.responses(x[i:i + WINDOWS_AT_ONCE]).max(axis=1) + self.bias, 0)
            z = pooled @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        wide, d = max(WIDTHS), EMBEDDING
        r = self.responses(x)
        at = r.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(r, at[:, None], 1)[:, 0] + self.bias, 0)
        z = pooled @ self.out + self.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (pooled > 0)
        # Only the bytes under each filter's largest response take part.
        held = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(wide)]
        runs = self.embedding[held].reshape(*at.shape, wide * d)
        d_filters = np.einsum("nk,nkr->rk", back, runs) * self.mask()
        d_runs = (back[:, :, None] * self.filters.T).reshape(-1, d)
        d_embedding = np.zeros_like(self.embedding)
        np.add.at(d_embedding, held.reshape(-1), d_runs)
        return [d_embedding, d_filters, back.sum(0), pooled.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray) -> ByteNet:
        rng = np.random.default_rng(SEED + 1)
        weights = [self.embedding, self.filters, self.bias, self.out, self.out_bias]
        m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                some, step = order[i:i + BATCH], step + 1
                for j, g in enumerate(self.gradients(x[some], y[some])):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    weights[j] -= RATE * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; ``und``, 0 without a letter."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        held = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if not held or not self.languages:
            return out
        cut = [windows_of(texts[i].encode("utf-8", "surrogatepass")) for i in held]
        p = self.probabilities(np.concatenate([w for w, _ in cut]))
        at = np.cumsum([0] + [len(w) for w, _ in cut])
        for i, (_, sizes), a, b in zip(held, cut, at, at[1:]):
            mean = sizes @ p[a:b] / sizes.sum()
            best = int(mean.argmax())
            out[i] = (self.languages[best], min(1.0, float(mean[best])))
        return out


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 0 modulo 5; a
    null id counts as empty text and is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> ByteNet:
    """Fit on a sample by hash of ``TRAIN_DOCS`` rows of each of the
    ``LANGUAGES`` most frequent languages, ``TRAIN_WINDOWS`` windows each,
    held-out rows excluded. Rows with a null or empty text or a null language
    are not learned from, repeated rows once."""
    text, label = F.col(text_col), F.col(label_col)
    h = F.xxhash64(F.col(id_col), text)
    cuts = [F.substr(text, (F.pmod(F.shiftright("h", 16 * i), F.greatest(F.length(text) - WINDOW // 2, F.lit(1)))
                            + 1).cast("int"), F.lit(WINDOW)) for i in range(TRAIN_WINDOWS)]
    rows = (docs.filter(text.isNotNull() & (text != "") & label.isNotNull() & ~held_out(F.col(id_col)))
            .select(label.cast("string").alias("label"), text, h.alias("h")))
    taken, _ = sampled(rows, "label", F.col("h"), TRAIN_DOCS, LANGUAGES)
    taken = taken.select("label", "h", F.array(*cuts).alias("cuts")).distinct().collect()
    sample, held = [], {}
    for r in sorted(taken, key=lambda r: (r["label"], r["h"] & (1 << 64) - 1, r["cuts"])):
        held[r["label"]] = held.get(r["label"], 0) + 1
        if held[r["label"]] <= TRAIN_DOCS:
            sample.append(r)
    languages = sorted({r["label"] for r in sample})
    net = ByteNet.fresh(languages)
    if not sample:
        return net
    x, y = [], []
    for r in sample:
        for cut in r["cuts"]:
            x.append(windows_of(cut.encode("utf-8", "surrogatepass")[:WINDOW])[0][0])
            y.append(languages.index(r["label"]))
    return net.fit(np.stack(x), np.array(y))


def predict_column(net: ByteNet, text: Column) -> Column:
    """struct(lang, score) of whole texts."""
    ship()

    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        found = []
        values = texts.tolist()
        for i in range(0, len(values), 64):
            found += net.predict(values[i:i + 64])
        return pd.DataFrame(found, columns=["lang", "score"])

    return language(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             net: ByteNet | None = None) -> DataFrame:
    """``id, held_out, lang_pred, score`` for every row of ``docs``.

    Without ``net`` one is trained on the labelled rows. The prediction reads
    the text alone. Null and letterless texts are ``und`` with score 0, and so
    is every text if there is nothing to learn from; repeated rows get equal
    results; other columns are not read; an empty table gives an empty result.
    """
    net = net or train(docs, id_col, text_col, label_col)
    found = predict_column(net, F.col(text_col))
    return (docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"), found.alias("p"))
            .select(F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score")))


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                      min_score: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language is unknown or found with a
    score below ``min_score``; all columns kept, whatever their names.

    Null, empty and letterless texts go; null ids stay; very long texts are
    read whole; repeated rows are treated alike; an empty table stays empty.
    """
    (name,) = free_names(docs, "found")
    found = predict_column(train(docs, id_col, text_col, label_col), F.col(text_col))
    return (docs.withColumn(name, found)
            .filter((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= min_score)).drop(name))
