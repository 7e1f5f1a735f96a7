"""Quality rules: line frequency over documents.

Every line is normalised and hashed; per host the distinct documents that hold
it are counted, lines above the limit of a host are removed there, and a
document that keeps too little is rejected.

What makes documents distinct is their rest: the words outside *candidates*,
lines that more documents of the host hold than the least limit. Documents
whose rest is shorter than ``MIN_WORDS`` count as one document, and so do
those whose rest is mostly another's, by shared minima of its three-word
windows: exact and near copies count as one, pages of one template with words
of their own each count. No two documents are compared and nothing is merged
over a third one. Of near copies too few to share a line or a minimum
(``MIN_LINE_DOCS`` or fewer), each counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dimforge.llm.common import drop_written, free_names, materialise, row_key, salted, ship

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SIGNATURE_WINDOW = 3
# Minima of a rest, and how many of them must be shared by more documents of
# the host than MIN_LINE_DOCS for the rest to be a copy.
MINIMA = 8
SHARED_MINIMA = 2
# A line is above the limit of a host if more distinct documents hold it than
# MIN_LINE_DOCS and than LINE_SHARE of the host's distinct documents, or than
# MAX_LINE_DOCS on a host of any size.
MIN_LINE_DOCS = 10
LINE_SHARE = 0.01
MAX_LINE_DOCS = 1000
MIN_WORDS_LEFT = 10
MIN_SHARE_LEFT = 0.3
SALTS = 16

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PROFILE = T.StructType([T.StructField(n, T.LongType()) for n in FIGURES]
                       + [T.StructField("lines", T.ArrayType(T.LongType())), T.StructField("words", T.ArrayType(T.LongType())),
                          T.StructField("low", T.BinaryType())])


def _long(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def line_hash(line: str) -> int | None:
    """Hash of a line with white space runs as one space, A-Z lower-cased and
    digits as 0; None without a word."""
    words = line.encode("utf-8", "surrogatepass").split()
    return _long(md5(b" ".join(words).translate(_FOLD), usedforsecurity=False).digest()) if words else None


def repeated_words(words: list[bytes], n: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``n`` words that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(n))))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + n - max(i, end)
            end = i + n
    return covered


def minima(lines: list[bytes], n: int = SIGNATURE_WINDOW) -> np.ndarray:
    """(lines, MINIMA): the smallest of the hashes of each line's windows of
    ``n`` words (all words if fewer), as signed numbers in the hashes' order.

    Hash k of a window is its MD5, read from byte 2 * k on and round.
    """
    digests, starts = [], []
    for line in lines:
        words = line.split()
        starts.append(len(digests))
        digests += [md5(b" ".join(words[i:i + n]), usedforsecurity=False).digest() for i in range(max(1, len(words) - n + 1))]
    if not lines:
        return np.zeros((0, MINIMA), np.int64)
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 16)
    raw = np.concatenate([raw, raw[:, :8]], 1)
    out = np.empty((len(lines), MINIMA), np.int64)
    for k in range(MINIMA):
        hashes = np.ascontiguousarray(raw[:, 2 * k:2 * k + 8]).view(">u8")[:, 0].astype(np.uint64)
        out[:, k] = (np.minimum.reduceat(hashes, starts) ^ np.uint64(1 << 63)).view(np.int64)
    return out


def profile(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [ln for ln in text.split("\n") if ln.strip(SPACES)]
    held: dict[int, int] = {}
    firsts = []
    for ln in lines:
        key, raw = line_hash(ln), ln.encode("utf-8", "surrogatepass")
        if key not in held:
            firsts.append(raw)
        held[key] = held.get(key, 0) + len(raw.split())
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), list(held), list(held.values()),
            minima(firsts).tobytes())


def _profiles(rows: DataFrame) -> DataFrame:
    """``text`` of ``rows`` replaced by the fields of PROFILE: the figures, the
    distinct normalised lines, their words in all, and the minima of each."""
    ship(rows.sparkSession)
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                found = zip(*[profile(t or "") for t in some.column("text").to_pylist()])
                cols = [some.column(c) for c in names]
                cols += [pa.array(list(v), k) for v, k in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *PROFILE.names])

    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
    schema = T.StructType([rows.schema[c] for c in names] + PROFILE.fields)
    return rows.mapInArrow(run, schema)


def _rests(rows: DataFrame) -> DataFrame:
    """``row, host, rest, low`` for ``rows`` with ``lines, words, low`` and
    ``candidates`` (null: none): words and minima of the other lines."""
    schema = T.StructType([rows.schema["row"], rows.schema["host"], T.StructField("rest", T.LongType()),
                           T.StructField("low", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, low = [], []
            for lines, words, minimum, out in zip(*(batch.column(c).to_pylist() for c in ("lines", "words", "low", "candidates"))):
                out = set(out or ())
                left = [i for i, ln in enumerate(lines) if ln not in out]
                rest.append(sum(words[i] for i in left))
                table = np.frombuffer(minimum, np.int64).reshape(-1, MINIMA)
                low.append(table[left].min(0).tolist() if left else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("host"), pa.array(rest, pa.int64()),
                                              pa.array(low, pa.list_(pa.int64()))], names=schema.names)

    return rows.select("row", "host", "lines", "words", "low", "candidates").mapInArrow(run, schema)


def common_lines(profiles: DataFrame, min_docs: int = MIN_LINE_DOCS, share: float = LINE_SHARE,
                 max_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """``row, line, words`` of the lines above the limit of their host.

    ``profiles`` is a written table with ``row``, ``host`` (a hash; null is a
    host of its own) and the fields of PROFILE. Candidates and shared minima
    have no size bound, so their joins are sort-merge joins at every size.
    """
    held = profiles.select("row", "host", F.explode(F.arrays_zip("lines", "words")).alias("l")).select(
        "row", "host", F.col("l.lines").alias("line"), F.col("l.words").alias("words"))
    many = held.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs).drop("n")
    # A candidate stands in more than min_docs rows, so its SALTS copies are
    # at most about as many as those rows; likewise the minima below.
    left, right = salted(held, F.col("row"), many, SALTS)
    held = materialise(left.join(right.hint("merge"), ["host", "line", "__salt"]).drop("__salt"), "held-lines")
    some = held.groupBy("row").agg(F.collect_list("line").alias("candidates"))
    rests = materialise(_rests(profiles.join(some.hint("merge"), "row", "left")), "rests")
    own = rests.filter(F.col("rest") >= MIN_WORDS)
    low = own.select("row", "host", F.posexplode("low").alias("k", "value"))
    shared = low.groupBy("host", "k", "value").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs).drop("n")
    left, right = salted(low, F.col("row"), shared, SALTS)
    copies = (left.join(right.hint("merge"), ["host", "k", "value", "__salt"]).groupBy("row").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= SHARED_MINIMA).select("row", F.lit(True).alias("copy")))
    doc = F.when(F.col("copy").isNull() & (F.col("rest") >= MIN_WORDS), F.xxhash64("low")).otherwise(0).alias("doc")
    docs = materialise(rests.join(copies.hint("merge"), "row", "left").select("row", "host", doc), "distinct-docs")
    hosts = docs.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    limit = F.least(F.col("host_docs") * F.lit(share), F.lit(max_docs).cast("double"))
    above = (held.join(docs.select("row", "doc").hint("merge"), "row").select("host", "line", "doc").distinct()
             .groupBy("host", "line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > min_docs)
             .join(hosts, "host").filter(F.col("n_docs") > limit).select("host", "line"))
    left, right = salted(held, F.col("row"), above, SALTS)
    found = materialise(left.join(right.hint("merge"), ["host", "line", "__salt"]).select("row", "line", "words"), "common-lines")
    drop_written(held, rests, docs)
    return found


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_docs: int = MIN_LINE_DOCS, share: float = LINE_SHARE, max_docs: int = MAX_LINE_DOCS,
               min_words_left: int = MIN_WORDS_LEFT, min_share_left: float = MIN_SHARE_LEFT) -> DataFrame:
    """One row per row of ``docs``: the id, the base figures, ``base_failed``,
    ``removed_words`` and ``removed_lines`` (hashes of its lines above the
    limit), ``kept``, and ``k1, k2`` (hash of id, host and text).

    A null text counts as empty and fails the base rule, as every text under
    ``MIN_WORDS`` words; very long texts are read whole, in memory that grows
    with one text. Null ids and hosts, equal ids and repeated rows are rows
    like any other (a null host is a host). Other columns are not read. An
    empty table gives an empty result.
    """
    k1, k2 = row_key(F.col(id_col), F.col(host_col), F.col(text_col))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.xxhash64(F.col(host_col).isNull(), F.col(host_col)).alias("host"),
                       k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    prof = materialise(_profiles(rows), "line-profiles")
    removed = (common_lines(prof, min_docs, share, max_docs)
               .groupBy("row").agg(F.sum("words").alias("removed"), F.collect_list("line").alias("removed_lines")))
    left = F.col("n_words") - F.col("removed_words")
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    depleted = (F.col("removed_words") > 0) & ((left < min_words_left) | (left < F.col("n_words") * F.lit(min_share_left)))
    return (prof.drop("lines", "words", "low").join(removed.hint("merge"), "row", "left")
            .withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & ~depleted)
            .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "removed_words", "removed_lines", "k1", "k2"))


def strip_lines(text: Column, lines: Column) -> Column:
    """``text`` without the lines whose hash is in ``lines`` (null: as it is)."""
    ship()

    @F.pandas_udf("string")
    def strip(texts: pd.Series, gone: pd.Series) -> pd.Series:
        def one(t: str | None, g: object) -> str | None:
            if t is None or g is None:
                return t
            out = set(g)
            return "\n".join(ln for ln in t.split("\n") if line_hash(ln) not in out)

        return pd.Series([one(t, g) for t, g in zip(texts, gone)], dtype=object)

    return strip(text, lines)


def apply_line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """``docs`` without the rejected rows and without the lines above the limit
    (``length_col``, if there is one, follows the text); all columns kept,
    whatever their names.

    Null, empty and wordless texts go, as they fail the base rule; null ids and
    hosts and very long texts are treated as by ``line_rules``; repeated rows
    stay as often as they are there; an empty table stays empty.
    """
    n1, n2, gone = free_names(docs, "k1", "k2", "gone")
    rules = (line_rules(docs, id_col, text_col, host_col).filter("kept")
             .select(F.col("k1").alias(n1), F.col("k2").alias(n2), F.col("removed_lines").alias(gone))
             .dropDuplicates([n1, n2]))
    k1, k2 = row_key(F.col(id_col), F.col(host_col), F.col(text_col))
    out = docs.withColumn(n1, k1).withColumn(n2, k2).join(rules, [n1, n2])
    out = out.withColumn(text_col, strip_lines(F.col(text_col), F.col(gone)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(gone).isNull(), F.col(length_col))
                             .otherwise(F.length(text_col).cast(kind)))
    return out.select(*docs.columns)
