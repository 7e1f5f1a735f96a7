"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is a node of a chain with two labels, good and bad. Its
potential is linear in binned figures of the line and of the lines before and
after it (shares of character classes, repeated words, lengths); transitions
link neighbouring labels. The field is trained in numpy on a bounded sample of
labelled documents, whose label each of their lines carries. A document's score
is the mean of its lines' marginals of ``good`` from forward-backward, weighted
by the lines' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, fsum
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dimforge.llm.common import sampled, ship

HELD_OUT, HELD_OUT_REST = 3, 1
# Bound of the training sample: documents of each label, lines of a document.
TRAIN_DOCS = 800
TRAIN_LINES = 64
STEPS = 160
RATE = 0.08
DECAY = 1e-4
# Texts are cut into pieces of at most so many bytes for the figures; what is
# counted adds up over the pieces.
PIECE = 1 << 20
STRONGEST = 30.0
# Steps of the weights when texts are scored: sums of them have no rounding.
GRID = 2.0 ** -24

# Byte classes: white space, small letters, capitals, digits, marks that end a
# sentence, other marks of prose, symbols, bytes of characters beyond ASCII.
SPACE, LOWER, UPPER, DIGIT, STOP, MARK, SYMBOL, BEYOND = range(8)
CLASS = np.full(256, SYMBOL, np.uint8)
CLASS[128:] = BEYOND
for _class, _bytes in ((SPACE, b" \t\n\x0b\x0c\r"), (LOWER, bytes(range(97, 123))), (UPPER, bytes(range(65, 91))),
                       (DIGIT, b"0123456789"), (STOP, b".!?"), (MARK, b",;:'\"()-")):
    CLASS[np.frombuffer(_bytes, np.uint8)] = _class
ODD = np.uint64(0x9E3779B97F4A7C15)
# Odd, so that its powers have inverses modulo 2**64.
BASE = np.uint64(0x100000001B3)
POWER = np.cumprod(np.full(PIECE + 1, BASE, np.uint64), dtype=np.uint64)
INVERSE = np.cumprod(np.full(PIECE + 1, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64), dtype=np.uint64)

COUNTS = ("bytes", "lower", "upper", "digit", "stop", "mark", "symbol", "beyond", "words", "again", "near", "closed", "shouted")
SHARES = (0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.8)
WORD_STEPS = (1, 2, 4, 7, 12, 25, 60, 200)
LENGTH_STEPS = (2.0, 3.0, 4.0, 5.0, 6.5, 8.0, 12.0)
FIGURES = 1 + 9 * len(SHARES) + len(WORD_STEPS) + len(LENGTH_STEPS) + 1


def _pieces(text: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``PIECE`` bytes, cut after a line or between words if
    one ends there."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            cut = max(text.rfind(b"\n", at, end), text.rfind(b" ", at, end))
            end = cut + 1 if cut > at else end
        yield at, end
        at = end


def _counted(raw: bytes, first: int, counts: np.ndarray, mixed: np.ndarray, last: tuple[int, int]) -> tuple[int, int]:
    """Add the figures of a piece of text, which begins in line ``first``, to
    ``counts`` and to the lines' hashes ``mixed``. ``last`` are the hashes of
    the two words before the piece on its first line; those of its end are
    returned."""
    data = np.frombuffer(raw, np.uint8)
    kind = CLASS[data]
    line = first + np.concatenate([[0], np.cumsum(data[:-1] == 10)])
    lines = int(line[-1]) + 1
    for k, name in enumerate(COUNTS[1:8], 1):
        counts[first:lines, k] += np.bincount(line[kind == k] - first, minlength=lines - first)
    full = (kind != SPACE).astype(np.int8)
    turn = np.diff(full, prepend=0, append=0)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if not len(starts):
        return last if lines == first + 1 else (0, 0)
    total = np.concatenate([[np.uint64(0)], np.cumsum(data.astype(np.uint64) * POWER[:len(data)], dtype=np.uint64)])
    words = ((total[ends] - total[starts]) * INVERSE[starts] + np.uint64(1)) * ODD
    of = line[starts]
    place = np.arange(len(words)) - np.searchsorted(of, of)
    place[of == first] += counts[first, COUNTS.index("words")]

    def add(name: str, rows: np.ndarray, n: np.ndarray | None = None) -> None:
        counts[first:lines, COUNTS.index(name)] += np.bincount(rows - first, n, minlength=lines - first).astype(np.int64)

    add("bytes", of, ends - starts)
    add("words", of)
    one = np.concatenate([[np.uint64(last[1])], words[:-1]])
    two = np.concatenate([np.array(last, np.uint64), words[:-2]])[:len(words)]
    same = np.concatenate([[first], of[:-1]]) == of
    same2 = np.concatenate([[first, first], of[:-2]])[:len(words)] == of
    add("again", of[(words == one) & same])
    add("near", of[(words == two) & same2 & ~((words == one) & same)])
    add("closed", of[(kind[ends - 1] == STOP) | (kind[ends - 1] == MARK)])
    capital = np.concatenate([[0], np.cumsum(kind == UPPER)])
    small = np.concatenate([[0], np.cumsum(kind == LOWER)])
    add("shouted", of[(capital[ends] - capital[starts] > 1) & (small[ends] == small[starts])])
    np.add.at(mixed, of, words * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
    tail = [int(w) for w, o in zip(words[-2:], of[-2:]) if o == lines - 1]
    return tuple([0, 0, *([] if lines > first + 1 else last), *tail][-2:])


def line_figures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines with a word of the texts: binned figures (uint8, one row a
    line), their bytes, and the number of lines of each text."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    spans = np.array([r.count(b"\n") + 1 for r in raws], np.int64)
    begins = np.concatenate([[0], np.cumsum(spans)])
    counts = np.zeros((begins[-1], len(COUNTS)), np.int64)
    mixed = np.zeros(begins[-1], np.uint64)
    # Short texts are counted together.
    group: list[bytes] = []
    size, first = 0, 0
    for i, raw in enumerate(raws):
        if group and size + len(raw) + 1 > PIECE:
            _counted(b"\n".join(group), first, counts, mixed, (0, 0))
            group, size = [], 0
        if len(raw) > PIECE:
            at, last = int(begins[i]), (0, 0)
            for a, b in _pieces(raw):
                last = _counted(raw[a:b], at, counts, mixed, last)
                passed = raw.count(b"\n", a, b)
                at, last = at + passed, (0, 0) if passed and raw[b - 1] == 10 else last
            continue
        if not group:
            first = int(begins[i])
        if raw or group:
            group.append(raw)
            size += len(raw) + 1
        elif not raw:
            group.append(raw)
            size += 1
    if group and size > 1:
        _counted(b"\n".join(group), first, counts, mixed, (0, 0))
    doc = np.repeat(np.arange(len(texts)), spans)
    held = counts[:, COUNTS.index("words")] > 0
    counts, doc, mixed = counts[held], doc[held], mixed[held]
    of = dict(zip(COUNTS, counts.T.astype(np.float64)))
    size, words = np.maximum(of["bytes"], 1), np.maximum(of["words"], 1)
    # A line that the text already held, by the hash of its words.
    seen = np.ones(len(doc), bool)
    seen[np.unique(mixed * np.uint64(2) + doc.astype(np.uint64) * ODD, return_index=True)[1]] = False
    out = np.zeros((len(doc), FIGURES), np.uint8)
    out[:, 0] = 1
    at = 1
    for value, steps in (*((of[k] / size, SHARES) for k in ("upper", "digit", "stop", "mark", "symbol", "beyond")),
                         *((of[k] / words, SHARES) for k in ("again", "near", "shouted")),
                         (of["words"], WORD_STEPS), (size / words, LENGTH_STEPS)):
        out[:, at:at + len(steps)] = value[:, None] > np.array(steps)
        at += len(steps)
    out[:, at] = seen
    return out, counts[:, 0], np.bincount(doc, minlength=len(texts))


def potentials(figures: np.ndarray, chains: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log odds of good for every line by its own figures and those of the lines
    before and after it in its text; ``weights`` is (3, FIGURES).

    Weights count in steps of ``GRID``, so the sums are exact: a line has the
    same odds whatever lines are computed with it.
    """
    own, before, after = (figures.astype(np.float64) @ (np.rint(weights.T / GRID) * GRID)).T
    ends = np.cumsum(chains)
    has = chains > 0
    first, last = (ends - chains)[has], (ends - 1)[has]
    from_before, from_after = np.roll(before, 1), np.roll(after, -1)
    from_before[first], from_after[last] = 0, 0
    return np.clip(own + from_before + from_after, -STRONGEST, STRONGEST)


@dataclass
class LineField:
    """Weights of the figures (own line, line before, line after) and the log
    potentials of the transitions (from, to), labels bad and good."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, odds: list[float]) -> list[float]:
        """P(good) for every line of one chain, given the log odds.

        Only the odds of good against bad are carried along the chain, so no
        scaling is needed and memory is one number a line.
        """
        (bb, bg), (gb, gg) = np.exp(self.moves).tolist()
        local = [exp(x) for x in odds]
        ahead, a = [], None
        for x in local:
            a = x if a is None else x * (a * gg + bg) / (a * gb + bb)
            ahead.append(a)
        out, b = [0.0] * len(local), 1.0
        for i in range(len(local) - 1, -1, -1):
            both = ahead[i] * b
            out[i] = both / (1 + both)
            b = (local[i] * b * gg + gb) / (local[i] * b * bg + bb)
        return out

    def scores(self, texts: list[str]) -> list[float]:
        """Length-weighted mean of the lines' marginals; 0 without a word."""
        figures, sizes, chains = line_figures(texts)
        odds = potentials(figures, chains, self.weights).tolist()
        out, at = [], 0
        for n in chains.tolist():
            p = self.marginals(odds[at:at + n])
            weight = sizes[at:at + n].tolist()
            out.append(min(1.0, fsum(map(mul, p, weight)) / sum(weight)) if n else 0.0)
            at += n
        return out


def _objective(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, scale: np.ndarray, weights: np.ndarray,
               moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted mean of the chains' negative log-likelihood and its gradients.

    ``x`` is (lines of all chains, 3 * FIGURES); ``y`` is the label of all lines
    of a chain.
    """
    n, width = len(lengths), lengths.max()
    alive = np.arange(width) < lengths[:, None]
    theta = np.zeros((n, width, 2))
    theta[:, :, 1][alive] = x @ weights.ravel()
    ahead, back = np.zeros((n, width, 2)), np.zeros((n, width, 2))
    ahead[:, 0] = theta[:, 0]
    for t in range(1, width):
        to = theta[:, t] + np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
        ahead[:, t] = np.where(alive[:, t, None], to, ahead[:, t - 1])
    for t in range(width - 2, -1, -1):
        nxt = theta[:, t + 1] + back[:, t + 1]
        to = np.logaddexp(moves[:, 0] + nxt[:, :1], moves[:, 1] + nxt[:, 1:])
        back[:, t] = np.where(alive[:, t + 1, None], to, 0)
    z = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    p = np.exp(ahead[:, :, 1] + back[:, :, 1] - z[:, None])
    label = np.broadcast_to(y[:, None], (n, width))
    steps = lengths - 1
    gold = (theta[:, :, 1] * label * alive).sum(1) + np.where(y == 1, moves[1, 1], moves[0, 0]) * steps
    off = ((p - label) * scale[:, None])[alive].astype(x.dtype)
    grad = (off @ x).reshape(weights.shape)
    both = (ahead[:, :-1, :, None] + moves + (theta + back)[:, 1:, None, :] - z[:, None, None, None])
    pairs = np.exp(both) * alive[:, 1:, None, None]
    expected = np.einsum("ntij,n->ij", pairs, scale)
    held = np.array([[(scale * steps)[y == 0].sum(), 0], [0, (scale * steps)[y == 1].sum()]])
    return float(((z - gold) * scale).sum()), grad, expected - held


def fit(chains: list[np.ndarray], labels: list[int], scale: list[float]) -> LineField:
    """Train on chains of figures (lines, FIGURES), each with a label and a
    weight; Adam over all chains at once."""
    y, lengths, scale = np.array(labels), np.array(list(map(len, chains))), np.array(scale) / np.sum(scale)
    blank = np.zeros((1, FIGURES), np.uint8)
    x = np.concatenate([np.hstack([c, np.concatenate([blank, c[:-1]]), np.concatenate([c[1:], blank])])
                        for c in chains]).astype(np.float32)
    values = [np.zeros((3, FIGURES)), np.zeros((2, 2))]
    m, v = [np.zeros_like(w) for w in values], [np.zeros_like(w) for w in values]
    for step in range(1, STEPS + 1):
        _, *grads = _objective(x, y, lengths, scale, values[0].astype(np.float32), values[1])
        for j, g in enumerate(grads):
            g = g + DECAY * values[j]
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.99 * v[j] + 0.01 * g * g
            values[j] -= RATE * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.99 ** step)) + 1e-8)
    return LineField(*values)


def _rest(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % HELD_OUT


def _sampled_figures(rows: DataFrame) -> DataFrame:
    """``text`` replaced by the figures of at most ``TRAIN_LINES`` neighbouring
    lines, from a place that the row's hash gives."""
    schema = T.StructType([rows.schema["quality"], rows.schema["h"], T.StructField("figures", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist()):
                figures, _, _ = line_figures([text])
                at = h % max(1, len(figures) - TRAIN_LINES + 1)
                out.append(figures[at:at + TRAIN_LINES].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("h"), pa.array(out, pa.binary())],
                                             names=schema.names)

    return rows.select("quality", "text", "h").mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> LineField | None:
    """Fit on a sample by hash of ``TRAIN_DOCS`` labelled documents of each
    label; None without any.

    Only labels 0 and 1 of rows whose id's crc32 leaves another rest than
    ``HELD_OUT_REST`` are read; texts that are null or without a word are not
    learned from. The sample weighs as all labelled rows do.
    """
    usable = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("quality"))
              .filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull() & (_rest(F.col("id")) != HELD_OUT_REST))
              .withColumn("h", F.xxhash64("id", "quality")))
    some, counts = sampled(usable, "quality", F.col("h"), TRAIN_DOCS, 2)
    # At most 2.5 * TRAIN_DOCS rows, for the join and for the driver.
    some = some.select("id", "quality", "h").distinct()
    text = F.col(text_col)
    rows = (docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("t")).filter("text is not null")
            .join(F.broadcast(some), "id").groupBy("quality", "id", "h").agg(F.min_by("text", "t").alias("text")))
    chains, y = [], []
    for r in sorted(_sampled_figures(rows).collect(), key=lambda r: (r["quality"], r["h"] & (1 << 64) - 1)):
        if r["figures"] and y.count(r["quality"]) < TRAIN_DOCS:
            chains.append(np.frombuffer(r["figures"], np.uint8).reshape(-1, FIGURES))
            y.append(r["quality"])
    if not chains:
        return None
    held = {k: y.count(k) for k in (0, 1)}
    return fit(chains, y, [counts[k] / held[k] for k in y])


def score_column(field: LineField | None, text: Column) -> Column:
    """Score of whole texts; 0 for null and wordless texts, 0.5 for all others
    without a field."""
    ship()

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        values = [t or "" for t in texts]
        if field is None:
            return pd.Series([0.5 if t.split() else 0.0 for t in values])
        out: list[float] = []
        for at in range(0, len(values), 512):
            out += field.scores(values[at:at + 512])
        return pd.Series(out)

    return score(text)


def classify(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", field: LineField | None = None) -> DataFrame:
    """``id, held_out, score, predicted`` for every row of ``docs``.

    Without ``field`` one is trained on ``labels(id, label)``. The score reads
    the text alone, all of it. Null, empty and wordless texts score 0; with
    nothing to learn from all others score 0.5. Null ids count as empty text
    and are never learned from; equal ids and repeated rows are scored alike;
    other columns are not read; an empty table gives an empty result.
    """
    field = field or (train(docs, labels, id_col, text_col, label_col) if labels is not None else None)
    return (docs.select(F.col(id_col).alias("id"), (_rest(F.col(id_col)) == HELD_OUT_REST).alias("held_out"),
                        score_column(field, F.col(text_col)).alias("score"))
            .select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
