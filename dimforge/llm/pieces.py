"""SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model starts from single characters and merges the best-scored
neighbours from an agenda. Here every candidate taken from the agenda is
skipped with a given probability, decided by a hash of the seed, the text, the
word's place in the text, the place in the word and the piece: a word is cut
anew wherever it stands, the same text always gets the same segmentation,
another seed another one, and all decode to the same text. Without dropout the
ids are those of the plain encoder.

Words of ordinary length are merged many at a time: their agendas are the
columns of one array, and every round takes the best candidate of each. Of a
word in use the merges without dropout are remembered; where none of them is
skipped, the word's agenda would run the same way, so its ids are taken from
there, and only occurrences with a skipped merge go through an agenda again.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from dimforge.llm.common import ship

SPACE = "▁"
# Stands for the model's space sign where a text itself holds it; no valid
# text holds a lone surrogate.
SPACE_IN_TEXT = "\udfff"
RUN = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}]*")
SHORT = 40
NEVER = 1 << 60
# 64-bit constants of a multiplicative hash.
MIX, MASK = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (1 << 64) - 1
DROPOUT = 0.1
SEED = 42
CACHE_WORDS = 250_000
# Words merged together have at most so many symbols, in one of these widths.
WIDTHS = (8, 12, 18, 26, SHORT)
PLACE_BITS = SHORT.bit_length()
NONE_LEFT = np.int32((1 << 31) - 1)
# Texts are encoded in groups of about so many characters.
GROUP_CHARS = 2_000_000
GROUP_WORDS = GROUP_CHARS // 4
BLOCK_WORDS = 1 << 16
# Ids that are decoded at once.
DECODE_IDS = 1 << 16


def occurrence_keys(text_key: int, first: int, n: int) -> np.ndarray:
    """Keys of the words ``first`` to ``first + n - 1`` of a text."""
    keys = np.uint64(text_key) + np.arange(first + 1, first + n + 1, dtype=np.uint64) * np.uint64(MIX[0])
    keys = (keys ^ keys >> np.uint64(30)) * np.uint64(MIX[1])
    return keys ^ keys >> np.uint64(27)


def skipped(keys: np.ndarray, orders: np.ndarray, places: np.ndarray, limit: int) -> np.ndarray:
    """Which candidates, given by the order of the piece and the place in the
    word, are skipped."""
    mixed = (keys ^ orders.astype(np.uint64) * np.uint64(MIX[0])) * (places.astype(np.uint64) + np.uint64(MIX[1]))
    return mixed >> np.uint64(32) < np.uint64(limit)


def merge_short(word: str, order: dict[str, int], key: int, limit: int) -> list[str]:
    """Merged symbols of a word, the agenda being a list that is searched.

    A candidate is skipped if the keyed hash of its place and order is below
    ``limit`` (0: none is).
    """
    sym, place, get = list(word), list(range(len(word))), order.get
    agenda = [get(a + b, NEVER) for a, b in zip(sym, sym[1:])]
    while agenda and (at := min(agenda)) < NEVER:
        i = agenda.index(at)
        if limit and ((key ^ at * MIX[0]) * (place[i] + MIX[1]) & MASK) >> 32 < limit:
            agenda[i] = NEVER
            continue
        left = sym[i] = sym[i] + sym.pop(i + 1)
        del place[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = get(left + sym[i + 1], NEVER)
        if i:
            agenda[i - 1] = get(sym[i - 1] + left, NEVER)
    return sym


def merge_long(word: str, order: dict[str, int], key: int, limit: int) -> list[str]:
    """The same with a heap and linked symbols, for words of any length."""
    sym = list(word)
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(order[a + b], i, a + b) for i, (a, b) in enumerate(zip(sym, sym[1:])) if a + b in order]
    heapq.heapify(agenda)
    while agenda:
        at, i, piece = heapq.heappop(agenda)
        j = after[i]
        if not sym[i] or j >= n or sym[i] + sym[j] != piece:
            continue
        if limit and ((key ^ at * MIX[0]) * (i + MIX[1]) & MASK) >> 32 < limit:
            continue
        sym[i], sym[j] = piece, ""
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            if piece + sym[j] in order:
                heapq.heappush(agenda, (order[piece + sym[j]], i, piece + sym[j]))
        h = before[i]
        if h >= 0 and sym[h] + piece in order:
            heapq.heappush(agenda, (order[sym[h] + piece], h, sym[h] + piece))
    return [s for s in sym if s]


class PairTable:
    """Order of the piece that two neighbours make, for arrays of neighbours.

    A symbol is named by its order; characters that stand in pieces and are
    none come after the pieces, and ``other`` is every other character. The
    pairs are kept in an open-addressing hash table.
    """

    def __init__(self, order: dict[str, int]):
        single = sorted({c for p in order for c in p} - order.keys())
        name = {**order, **{c: len(order) + i for i, c in enumerate(single)}}
        self.pieces, self.other = len(order), len(name)
        self.symbol = np.full(0x110000, self.other, np.int32)
        for c, n in name.items():
            if len(c) == 1:
                self.symbol[ord(c)] = n
        pairs = [(name[p[:k]] << 32 | name[p[k:]], n) for p, n in order.items() for k in range(1, len(p))
                 if p[:k] in name and p[k:] in name]
        keys, made = np.array(pairs, np.int64).reshape(-1, 2).T
        bits = (4 * len(pairs) + 16).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.made[slot[free]] = keys[free], made[free]
            left = self.keys[slot] != keys
            keys, made, slot = keys[left], made[left], (slot[left] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(MIX[0]) >> self.shift).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Order of the piece ``a + b``, -1 if there is none."""
        keys = a.astype(np.int64) << 32 | b
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.made[slot], np.int32(-1))
        more = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[more]
        while len(more):
            slot = (slot + 1) & self.last
            held = self.keys[slot]
            hit = held == keys[more]
            out[more[hit]] = self.made[slot[hit]]
            on = ~hit & (held >= 0)
            more, slot = more[on], slot[on]
        return out


def spelt_symbols(words: list[str], width: int, table: PairTable) -> np.ndarray:
    """(words, width): the symbols of their characters, ``other`` past the end."""
    chars = np.frombuffer("".join([w.ljust(width) for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.where(np.arange(width) >= lengths[:, None], np.int32(table.other), table.symbol[chars.reshape(len(words), width)])


def merge_many(symbols: np.ndarray, lengths: np.ndarray, table: PairTable, keys: np.ndarray, limit: int,
               merges: list | None = None, pairs: np.ndarray | None = None) -> np.ndarray:
    """``merge_short`` for words given as rows of symbols: one row of symbols
    per word, -1 for places merged away or past the end. All merges are added
    to ``merges`` as arrays of word, place and order. ``pairs`` holds the orders
    of neighbouring symbols, if they are known.

    Place p of all words is row p + 1 of the arrays; the first and last rows
    and the places past a word's end hold a symbol that merges with nothing.
    """
    n, width = symbols.shape
    ended = np.arange(width)[:, None] >= lengths
    sym = np.full((width + 2, n), table.other, np.int32)
    sym[1:-1] = symbols.T
    rows = np.arange(width + 2, dtype=np.int32)[:, None]
    after, before = (np.repeat(rows + d, n, 1).ravel().astype(np.int32) for d in (1, -1))

    def candidates(at: np.ndarray, row: np.ndarray, key: np.ndarray) -> np.ndarray:
        if limit:
            at[skipped(key, at, row - 1, limit)] = -1
        return np.where(at < 0, NONE_LEFT, at << PLACE_BITS | row.astype(np.int32))

    agenda = np.full((width + 2, n), NONE_LEFT, np.int32)
    at = table.lookup(sym[1:-1].ravel(), sym[2:].ravel()) if pairs is None else np.array(pairs.T, np.int32, order="C").ravel()
    agenda[1:-1] = candidates(at, np.repeat(rows[1:-1], n, 1).ravel(), np.tile(keys, width)).reshape(width, n)
    flat, todo = sym.ravel(), agenda.ravel()
    while len(live := np.flatnonzero((best := agenda.min(0)) < NONE_LEFT)):
        best, key = best[live], keys[live]
        made, row = best >> PLACE_BITS, (best & ((1 << PLACE_BITS) - 1)).astype(np.int64)
        here = row * n + live
        if merges is not None:
            merges.append((live, (row - 1).astype(np.uint8), made))
        there = after[here] * n + live
        end, start = after[there], before[here]
        flat[here], flat[there], todo[there] = made, -1, NONE_LEFT
        after[here], before[end * n + live] = end, row
        todo[here] = candidates(table.lookup(made, flat[end * n + live]), row, key)
        first = start > 0
        start, made, live = start[first], made[first], live[first]
        todo[start * n + live] = candidates(table.lookup(flat[start * n + live], made), start, key[first])
    return np.where(ended, np.int32(-1), sym[1:-1]).T


class PieceModel:
    """Pieces, merge ranks and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" ﬁ ") != f"{SPACE}{SPACE}ﬁ{SPACE}":
            raise ValueError("only models that leave texts as they are can decode losslessly")
        self.ids: dict[str, int] = {}
        self.rank: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        decoded: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                decoded.append(b"")
            else:
                self.ids[piece] = i
                self.rank[piece] = (-model.get_score(i), i)
                decoded.append(piece.replace(SPACE, " ").encode())
        # All pieces' bytes, and where each begins.
        self.letters = np.frombuffer(b"".join(decoded), np.uint8)
        self.sizes = np.fromiter(map(len, decoded), np.int64, len(decoded))
        self.starts = np.cumsum(self.sizes) - self.sizes
        if len(self.bytes) < 256:
            raise ValueError("the model needs all byte pieces to decode losslessly")
        order = sorted(self.rank, key=self.rank.__getitem__)
        self.order = {p: n for n, p in enumerate(order)}
        self.table = PairTable(self.order)
        self.id_of = np.array([self.ids[p] for p in order], np.uint32)
        # Words may be encoded one by one if no piece holds a line feed, or a
        # space sign after another character.
        self.by_word = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)

    def segment(self, word: str, dropout: float, key: int) -> bytes:
        """Ids of a word (its space sign included), packed in 32 bits each."""
        limit = int(dropout * (1 << 32))
        return self.packed((merge_short if len(word) <= SHORT else merge_long)(word, self.order, key, limit))

    def packed(self, symbols: list[str]) -> bytes:
        out, ids = array("I"), self.ids
        for piece in symbols:
            if piece in ids:
                out.append(ids[piece])
            else:
                raw = (SPACE if piece == SPACE_IN_TEXT else piece).encode("utf-8", "surrogatepass")
                out.extend(self.bytes[b] for b in raw)
        return out.tobytes()

    def segment_many(self, words: list[str], dropout: float, keys: np.ndarray,
                     merges: list | None = None) -> list[bytes]:
        """What ``segment`` gives for every word under its key; ``merges`` gets
        arrays of word, place and order of the merges of words up to ``SHORT``
        characters."""
        limit = int(dropout * (1 << 32))
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        by_length = np.argsort(lengths, kind="stable")
        ends = np.searchsorted(lengths[by_length], (0, *WIDTHS), "right").tolist()
        for width, start, end in zip(WIDTHS, ends, ends[1:]):
            for at in range(start, end, BLOCK_WORDS):
                places = by_length[at:min(at + BLOCK_WORDS, end)]
                some, made = [words[i] for i in places.tolist()], None if merges is None else []
                merged = merge_many(spelt_symbols(some, width, self.table), lengths[places], self.table, keys[places], limit, made)
                for i, ids in zip(places.tolist(), self._pack_many(some.__getitem__, lengths[places], merged)):
                    out[i] = ids
                if made:
                    merges.append((places[np.concatenate([m[0] for m in made])], *(np.concatenate([m[k] for m in made]) for k in (1, 2))))
        for i in by_length[ends[-1]:].tolist():
            out[i] = self.segment(words[i], dropout, int(keys[i]))
        return out

    def segment_known(self, known: Known, words: np.ndarray, dropout: float, keys: np.ndarray) -> list[bytes]:
        """``segment_many`` for remembered words, given by their numbers."""
        limit = int(dropout * (1 << 32))
        out, lengths = [b""] * len(words), known.lengths[words]
        by_length = np.argsort(lengths, kind="stable")
        ends = np.searchsorted(lengths[by_length], (0, *WIDTHS), "right").tolist()
        for width, start, end in zip(WIDTHS, ends, ends[1:]):
            for at in range(start, end, BLOCK_WORDS):
                places = by_length[at:min(at + BLOCK_WORDS, end)]
                which = words[places]
                merged = merge_many(known.symbols[which, :width], lengths[places], self.table, keys[places], limit,
                                    pairs=known.pairs[which, :width])
                for i, ids in zip(places.tolist(), self._pack_many(lambda j: known.words[which[j]], lengths[places], merged)):
                    out[i] = ids
        return out

    def _pack_many(self, spelt: Callable[[int], str], lengths: np.ndarray, symbols: np.ndarray) -> list[bytes]:
        stays, raw_too = symbols >= 0, (symbols >= self.table.pieces).any(1)
        ends = (4 * np.cumsum(stays.sum(1))).tolist()
        raw = self.id_of[np.minimum(symbols[stays], self.table.pieces - 1)].tobytes()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero(raw_too).tolist():
            word, cuts = spelt(i), [*np.flatnonzero(stays[i]).tolist(), int(lengths[i])]
            out[i] = self.packed([word[a:b] for a, b in zip(cuts, cuts[1:])])
        return out

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, np.uint32)
        parts = (self._spelt_bytes(ids[at:at + DECODE_IDS]) for at in range(0, len(ids), DECODE_IDS))
        return b"".join(parts)[1:].decode("utf-8", "surrogatepass")

    def _spelt_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces, gathered from those of all pieces."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.letters[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)].tobytes()


class Known:
    """Words in use: symbols, ids and merges (order, place) without dropout."""

    def __init__(self, table: PairTable) -> None:
        self.at: dict[str, int] = {}
        self.words: list[str] = []
        self.ids: list[bytes] = []
        self.table = table
        self.first = np.zeros(1, np.int64)
        self.lengths = np.zeros(0, np.int64)
        # Symbols of each word, and the orders of its neighbours, -1 for none.
        self.symbols = np.zeros((0, SHORT), np.min_scalar_type(table.other))
        self.pairs = np.zeros((0, SHORT), np.min_scalar_type(-1 - table.pieces))
        self.orders, self.places = np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def add(self, words: list[str], spelt: list[str], ids: list[bytes], merges: list) -> None:
        if not words:
            return
        self.at.update(zip(words, range(len(self.ids), len(self.ids) + len(words))))
        self.words += spelt
        self.ids += ids
        self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, spelt), np.int64, len(spelt))])
        symbols = spelt_symbols(spelt, SHORT, self.table)
        after = np.concatenate([symbols[:, 1:], np.full((len(spelt), 1), self.table.other, np.int32)], 1)
        pairs = self.table.lookup(symbols.ravel(), after.ravel()).reshape(-1, SHORT)
        self.symbols = np.concatenate([self.symbols, symbols.astype(self.symbols.dtype)])
        self.pairs = np.concatenate([self.pairs, pairs.astype(self.pairs.dtype)])
        of, places, orders = (np.concatenate([m[k] for m in merges]) if merges else np.zeros(0, np.int64) for k in range(3))
        by_word = np.argsort(of, kind="stable")
        counts = np.bincount(of.astype(np.int64), minlength=len(words))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts)])
        self.orders = np.concatenate([self.orders, orders[by_word].astype(np.int32)])
        self.places = np.concatenate([self.places, places[by_word].astype(np.uint8)])

    def disturbed(self, words: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """Which occurrences, given by the word's number and a key, have a
        skipped merge."""
        start = self.first[words]
        counts = self.first[words + 1] - start
        of = np.repeat(np.arange(len(words)), counts)
        merge = np.arange(len(of)) + np.repeat(start - (np.cumsum(counts) - counts), counts)
        hit = skipped(keys[of], self.orders[merge], self.places[merge], limit)
        return np.bincount(of[hit], minlength=len(words)) > 0


class TextEncoder:
    """Packed ids of texts. Words that stand more than once in a group of texts,
    or were met before, are learned; up to ``CACHE_WORDS`` are remembered.

    A word is named without the space sign before it; one that begins with a
    line feed has none.
    """

    def __init__(self, model: PieceModel, dropout: float, seed: int):
        self.model, self.dropout, self.seed = model, dropout, seed
        self.known = Known(model.table)
        # Words that were met once and not learned.
        self.met: set[str] = set()

    @staticmethod
    def _spelt(words: list[str]) -> list[str]:
        return [SPACE + w if w[:1] != "\n" else w for w in words]

    def _learn(self, words: list[str]) -> None:
        """Remember ``words``."""
        merges: list = []
        spelt = self._spelt(words)
        self.known.add(words, spelt, self.model.segment_many(spelt, 0, np.zeros(len(words), np.uint64), merges), merges)

    def _encoded(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of every occurrence of a word, under its key."""
        if len(self.known.ids) > CACHE_WORDS:
            self.known = Known(self.model.table)
        if len(self.met) > CACHE_WORDS:
            self.met = set()
        known, limit = self.known, int(self.dropout * (1 << 32))
        at = np.fromiter(map(known.at.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = [words[i] for i in new.tolist()]
            counts = Counter(unknown)
            learned = [w for w, n in counts.items() if (n > 1 or w in self.met) and len(w) < SHORT]
            self.met.update(w for w in counts if len(w) < SHORT)
            self.met.difference_update(learned)
            self._learn(learned)
            at[new] = np.fromiter(map(known.at.get, unknown, repeat(-1)), np.int64, len(unknown))
        strange = np.flatnonzero(at < 0)
        out = list(map(known.ids.__getitem__, at.tolist())) if known.ids else [b""] * len(words)
        for i, ids in zip(strange.tolist(), self.model.segment_many(self._spelt([words[i] for i in strange.tolist()]),
                                                                    self.dropout, keys[strange])):
            out[i] = ids
        if limit:
            held = np.flatnonzero(at >= 0)
            anew = held[known.disturbed(at[held], keys[held], limit)]
            for i, ids in zip(anew.tolist(), self.model.segment_known(known, at[anew], self.dropout, keys[anew])):
                out[i] = ids
        return out

    def _words(self, text: str) -> list[str]:
        if text[0].isspace() or text[-1].isspace() or any(r in text for r in ("  ", " \n", "\n ")):
            # Runs of space signs stay together, with the word after them.
            return [w if w[0] == "\n" else w[1:] for w in RUN.findall(SPACE + text.replace(" ", SPACE))]
        return text.replace("\n", " \n").split(" ")

    def _joined(self, texts: list[tuple[list[str], int, int]]) -> list[bytes]:
        """Ids of runs of words, given with the text's key and the place of the
        first word in it."""
        if not texts:
            return []
        flat = self._encoded([w for words, _, _ in texts for w in words],
                             np.concatenate([occurrence_keys(key, first, len(words)) for words, key, first in texts]))
        ends = np.cumsum([len(words) for words, _, _ in texts]).tolist()
        return [b"".join(flat[a:b]) for a, b in zip([0, *ends], ends)]

    def encode_many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of every text, in the order of ``texts``."""
        group: list[tuple[list[str], int, int]] = []
        size = 0
        for text in texts:
            key = xxh64_intdigest(text.encode("utf-8", "surrogatepass"), self.seed)
            text = text.replace(SPACE, SPACE_IN_TEXT)
            if group and (size + len(text) > GROUP_CHARS or not self.model.by_word):
                yield from self._joined(group)
                group, size = [], 0
            if not text:
                group.append(([], key, 0))
            elif not self.model.by_word:
                yield self.model.segment(SPACE + text.replace(" ", SPACE), self.dropout, key)
            elif len(text) > GROUP_CHARS:
                words = self._words(text)
                yield b"".join(self._joined([(words[a:a + GROUP_WORDS], key, a)])[0] for a in range(0, len(words), GROUP_WORDS))
            else:
                group.append((self._words(text), key, 0))
                size += len(text)
        yield from self._joined(group)

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))


@cache
def piece_model(path: str) -> PieceModel:
    """One per worker process, as the encoders below."""
    return PieceModel(path)


@cache
def text_encoder(path: str, dropout: float, seed: int) -> TextEncoder:
    return TextEncoder(piece_model(path), dropout, seed)


def _encoded(texts: pd.Series, model_path: str, dropout: float, seed: int) -> list[bytes | None]:
    rows = [i for i, t in enumerate(texts) if t is not None]
    out: list[bytes | None] = [None] * len(texts)
    for i, ids in zip(rows, text_encoder(model_path, dropout, seed).encode_many(texts.iloc[i] for i in rows)):
        out[i] = ids
    return out


def encode_column(text: Column, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> Column:
    """Ids of whole texts, packed as little-endian unsigned 32-bit; null for a
    null text, empty for an empty one."""
    ship()

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoded(texts, model_path, dropout, seed), dtype=object)

    return encode(text)


def checked_column(text: Column, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> Column:
    """``encode_column`` with the proof: a struct of ``ids`` and ``lossless``,
    which says that decoding gives the text back (null for a null text).

    Decoding the ids by ``decode_column`` in the same query would encode each
    text twice: Spark evaluates the inner function of a chain of Python
    functions anew for every function that takes its result.
    """
    ship()

    @F.pandas_udf("ids binary, lossless boolean")
    def encode_checked(texts: pd.Series) -> pd.DataFrame:
        model, ids = piece_model(model_path), _encoded(texts, model_path, dropout, seed)
        lossless = [None if p is None else model.decode(p) == t for p, t in zip(ids, texts)]
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "lossless": pd.Series(lossless, dtype=object)})

    return encode_checked(text)


def decode_column(ids: Column, model_path: str) -> Column:
    """The text that packed ids stand for; null for null."""
    ship()

    @F.pandas_udf("string")
    def decode(packed: pd.Series) -> pd.Series:
        model = piece_model(model_path)
        return pd.Series([None if p is None else model.decode(p) for p in packed], dtype=object)

    return decode(ids)


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``id, ids, n_ids, lossless`` for every row of ``docs``.

    ``lossless`` says that decoding gives the text back. A null text has null
    ids, no id and null ``lossless``; an empty one no id and is lossless. Null
    ids of rows and repeated rows pass through, equal texts get equal ids;
    other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), checked_column(F.col(text_col), model_path, dropout, seed).alias("checked"))
    return rows.select(F.col("id").alias(id_col), "checked.ids",
                       F.coalesce(F.octet_length("checked.ids") / 4, F.lit(0)).cast("long").alias("n_ids"),
                       "checked.lossless")
