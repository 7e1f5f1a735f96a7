"""Bounded-space online packing of token ids into windows of fixed length.

Each input partition keeps at most ``open_windows`` unfinished windows. A
document is cut into whole windows and a rest; the rest goes best-fit into the
fullest open window that still takes it. When none does and all are in use,
the fullest is emitted, topped up with a cut of the rest if it lacks more than
``max_gap`` ids. At the end the partition pours its open windows together, so
at most one unfinished window per partition is left; those are merged over
partitions, ``FAN_IN`` at a time, until one is left, which is cut at powers of
two (sequences of such a length take no padding).
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dimforge.llm.common import materialise, ship

WINDOW = 2048
OPEN_WINDOWS = 64
MAX_GAP = 16
FAN_IN = 256
END_ID = 1
ID_BYTES = 4
CACHE_CHUNKS = 300_000
CACHED_BYTES = 48

PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary, part long, open boolean")


def byte_ranks(model: dict) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE model as its JSON file states it.

    Its alphabet writes a printable Latin-1 byte as itself and the others, in
    order, as the characters from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
    return {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token)}


class ChunkEncoder(dict):
    """Ids of a byte-level BPE tokenizer as packed bytes.

    Its pre-tokenizer cuts a text before every space that a non-space follows,
    whatever the vocabulary, and round a single line end between non-spaces.
    So a text may be encoded chunk by chunk, mostly words, and short chunks be
    remembered (``CACHE_CHUNKS`` at most; this dict). A chunk of Latin letters with closing
    marks is two pre-tokens, merged by the ranks of the same vocabulary; every
    other chunk goes to the tokenizer itself, and so do whole texts that hold
    characters on whose class regex libraries differ, or special tokens.
    """

    CUT = re.compile(r" (?=\S)")
    OTHER_SPACE = re.compile(r"[^\S \n]|[\u180e\u200b\ufeff]")
    RUNS = ("  ", "\n\n", " \n", "\n ")
    UNUSUAL = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
    WORD = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]{0,8})")

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pieces = tiktoken.Encoding("pieces", pat_str="(?s:.+)", special_tokens={},
                                        mergeable_ranks=byte_ranks(spec["model"]))
        self.marks: dict[str, bytes] = {}

    def _pack(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _piece(self, text: str) -> bytes:
        return array("I", self.pieces.encode_ordinary(text)).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        """Ids of a chunk; one that a space leads is named without it."""
        if m := self.WORD.fullmatch(chunk):
            line, word, marks = m.groups()
            if line:
                ids = self["\n"] + self._piece(word)
            else:
                ids = marks and self.get(word) or self._piece(" " + word)
            if marks:
                ids += self.marks.get(marks) or self.marks.setdefault(marks, self._piece(marks))
        elif chunk == "\n":
            ids = self._piece(chunk)
        else:
            ids = self._pack([chunk if chunk[:1] == "\n" else " " + chunk])[0]
        if len(self) < CACHE_CHUNKS and len(ids) <= CACHED_BYTES:
            self[chunk] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; ``add_special_tokens`` is off."""
        cut = []
        for text in texts:
            odd = self.OTHER_SPACE.search(text)
            if odd and self.UNUSUAL.search(text) or any(t in text for t in self.special):
                cut.append([text])
            elif odd or any(r in text for r in self.RUNS) or text[:1].isspace() or text[-1:].isspace():
                cut.append(self.CUT.split(text))
            else:
                cut.append(text.replace("\n", " \n").split(" "))
        heads = self._pack([words[0] for words in cut])
        return [head + b"".join(map(self.__getitem__, words[1:])) for head, words in zip(heads, cut)]


@cache
def chunk_encoder(path: str) -> ChunkEncoder:
    """One per worker process, kept from task to task."""
    return ChunkEncoder(path)


class _Sink:
    """Collects piece rows of finished sequences."""

    def __init__(self, first_id: int, part: int, keep_ids: bool):
        self.next_id, self.part, self.keep_ids, self.rows = first_id, part, keep_ids, []

    def emit(self, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // ID_BYTES
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset,
                              ids if is_open or self.keep_ids else None, self.part, is_open))
            offset += n
        self.next_id += 1


def _cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[:n * ID_BYTES], total), (doc, start + n, ids[n * ID_BYTES:], total)


def _size(piece: tuple) -> int:
    return len(piece[2]) // ID_BYTES


class OpenWindows:
    """At most ``limit`` unfinished windows, sorted by the room they have."""

    def __init__(self, sink: _Sink, window: int, limit: int, max_gap: int):
        self.sink, self.window, self.limit, self.max_gap = sink, window, limit, max_gap
        self.rooms: list[int] = []
        self.pieces: list[list[tuple]] = []

    def _put(self, room: int, pieces: list[tuple]) -> None:
        if room == 0:
            self.sink.emit(pieces)
            return
        at = bisect.bisect_left(self.rooms, room)
        self.rooms.insert(at, room)
        self.pieces.insert(at, pieces)

    def add(self, piece: tuple) -> None:
        while (n := _size(piece)) >= self.window:
            head, piece = _cut(piece, self.window)
            self.sink.emit([head])
        if not n:
            return
        at = bisect.bisect_left(self.rooms, n)
        if at < len(self.rooms):
            room, pieces = self.rooms.pop(at), self.pieces.pop(at)
            self._put(room - n, [*pieces, piece])
            return
        if len(self.rooms) == self.limit:
            room, pieces = self.rooms.pop(0), self.pieces.pop(0)
            if room > self.max_gap:
                head, piece = _cut(piece, room)
                pieces = [*pieces, head]
            self.sink.emit(pieces)
        self._put(self.window - _size(piece), [piece])

    def close(self) -> list[tuple]:
        """Pour all open windows together; what does not fill one is returned."""
        left = pour((p for pieces in self.pieces for p in pieces), self.window, self.sink)
        self.rooms, self.pieces = [], []
        return left


def pour(pieces: Iterable[tuple], window: int, sink: _Sink) -> list[tuple]:
    """Fill windows one after the other, cutting at their ends; the pieces of
    the last, unfilled one are returned."""
    held: list[tuple] = []
    room = window
    for piece in pieces:
        while _size(piece) >= room:
            head, piece = _cut(piece, room)
            sink.emit([*held, head])
            held, room = [], window
        if _size(piece):
            held.append(piece)
            room -= _size(piece)
    return held


def _powers_of_two(pieces: list[tuple], sink: _Sink) -> None:
    """Sequences whose lengths are the binary digits of the pieces' total."""
    total = sum(map(_size, pieces))
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        head, need = [], 1 << bit
        while need:
            first, rest = _cut(pieces[0], min(need, _size(pieces[0])))
            head.append(first)
            need -= _size(first)
            pieces = [rest, *pieces[1:]] if _size(rest) else pieces[1:]
        sink.emit(head)


def _columns(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                      ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                      ("ids", pa.binary()), ("part", pa.int64()), ("open", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, open_windows: int = OPEN_WINDOWS, max_gap: int = MAX_GAP,
         end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids`` of all documents.

    ``ids`` are little-endian unsigned 32-bit, null unless ``keep_ids``. A null
    or empty text is its end id alone; a null id, equal ids and repeated rows
    are packed like any other row; a text longer than a window fills windows of
    its own. Other columns are not read. An empty table gives no piece.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType
    ddl = PIECES.format(id=kind.simpleString())
    end = struct.pack("<I", end_id)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, schema, left = chunk_encoder(tokenizer_path), None, []
        sink = _Sink(part << 32, part, keep_ids)
        windows = OpenWindows(sink, window, open_windows, max_gap)
        for batch in batches:
            schema = schema or _columns(batch.schema.field("doc_id").type)
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [t or "" for t in some.column("text").to_pylist()]
                for doc, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(texts)):
                    ids += end
                    windows.add((doc, 0, ids, len(ids) // ID_BYTES))
                yield _batch(sink.rows, schema)
                sink.rows = []
        if schema is not None:
            if left := windows.close():
                sink.emit(left, is_open=True)
            yield _batch(sink.rows, schema)

    packed = materialise(docs.mapInArrow(local, ddl), "packed")
    done, level = [packed.filter("not open")], 0
    groups = packed.filter("open").agg(F.max("part")).first()[0]
    groups = 0 if groups is None else groups + 1
    while groups:
        level, groups = level + 1, -(-groups // FAN_IN)
        merged = _merge(packed.filter("open"), level, groups == 1, window, keep_ids, ddl)
        packed = materialise(merged, "merged")
        done.append(packed.filter("not open"))
        groups = 0 if groups == 1 else groups
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("part", "open")


def _merge(left: DataFrame, level: int, last: bool, window: int, keep_ids: bool, ddl: str) -> DataFrame:
    """Pour the unfinished windows of up to ``FAN_IN`` parts together."""
    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        group = int(key[0])
        rows = rows.sort_values(["part", "offset"], kind="stable")
        sink = _Sink((level << 56) + (group << 32), group, keep_ids)
        docs = [None if pd.isna(d) else d for d in rows["doc_id"]]
        held = pour(zip(docs, rows["start"], rows["ids"], rows["doc_tokens"]), window, sink)
        if last:
            _powers_of_two(held, sink)
        elif held:
            sink.emit(held, is_open=True)
        out = pd.DataFrame(sink.rows, columns=rows.columns.drop("grp"))
        return out.astype({c: "Int64" for c in out if rows[c].dtype.kind in "if" and c not in ("ids", "open")})

    grp = F.floor(F.col("part") / FAN_IN)
    return left.withColumn("grp", grp).groupBy("grp").applyInPandas(merge, ddl)
