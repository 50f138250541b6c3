"""SentencePiece encoding and decoding by suffix-array matching, for byte-pair models with byte fallback.

A batch's text, each distinct segment of it once, is concatenated and indexed by a suffix array; every piece of the
vocabulary is binary-searched for its occurrence range, the resulting edges (end, size, piece) are sorted by position
and relaxed: for every end position the relaxation keeps the one edge that is compatible with the piece before it,
which is what merging by score yields. Nothing is remembered from batch to batch but a table of fixed size.
"""

from __future__ import annotations

import functools
import importlib.util
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataframe.llm.batches import bound_batches, map_texts

META = "▁"
#: Stands between segments: no code point, above them all.
BORDER = np.uint32(0x110000)
#: The piece of a character that the vocabulary lacks; characters indexed together; segments that relax one by one.
LONE, CHARS, FEW = -2, 200_000, 12


def default_model_path() -> str:
    """The byte-fallback piece model of the installed public tokenizer files; without these, encode and decode need a model_path."""
    files = importlib.util.find_spec("public_tokenizers")
    if files is None:
        raise ValueError("model_path must name a byte-pair piece model, as no package of public tokenizer files is installed")
    return str(Path(files.origin).parent / "piece_bpe_32k.model")


def fields_of(data: bytes) -> dict[int, list]:
    """The fields of a protocol-buffer message by number: numbers, or bytes."""
    out: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        out.setdefault(tag >> 3, []).append(value)
    return out


def check_model(data: bytes) -> None:
    """Refuses models that this module would encode otherwise than the library: not byte-pair, or with a normaliser that changes texts."""
    model = fields_of(data)
    trainer, norm = (fields_of(model.get(k, [b""])[-1]) for k in (2, 3))
    if trainer.get(3, [1])[-1] != 2:
        raise ValueError("only byte-pair piece models are supported")
    if any(norm.get(2, [])) or norm.get(3, [1])[-1] != 1 or norm.get(4, [1])[-1] != 0 or norm.get(5, [1])[-1] != 1 or any(trainer.get(24, [0])):
        raise ValueError("the piece model's normaliser changes texts, which is not supported")


class PieceModel:
    """Vocabulary, merge splits and segment rule of a byte-pair model file with byte fallback."""

    def __init__(self, path: str):
        check_model(Path(path).read_bytes())
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [lib.id_to_piece(i) for i in range(lib.vocab_size())]
        normal = [i for i in range(len(self.pieces)) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.unk = lib.unk_id()
        self.control = {i for i in range(len(self.pieces)) if lib.is_control(i)}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # what a piece adds to a text
        byte_of = {i: bytes([b]) for b, i in enumerate(self.byte_ids) if i != self.unk}
        shown = [byte_of.get(i, b"" if i in self.control else p.replace(META, " ").encode()) for i, p in enumerate(self.pieces)]
        self.shown = pa.array(shown, pa.large_binary())
        self.ids = {self.pieces[i]: i for i in normal}
        # rank 0: single characters, then merges from the best score down; equal scores by id
        merges = sorted((i for i in normal if len(self.pieces[i]) > 1), key=lambda i: (-lib.get_score(i), i))
        self.rank = {i: 0 for i in normal if len(self.pieces[i]) == 1} | {i: n + 1 for n, i in enumerate(merges)}
        self._by_rank = merges
        self.left, self.right = np.arange(len(self.pieces)), np.arange(len(self.pieces))
        self.usable = {i for i, r in self.rank.items() if not r}
        for i in merges:
            parts = self._merge(self.pieces[i], self.rank[i])
            if parts and len(parts) == 2:
                self.left[i], self.right[i] = parts
                self.usable.add(i)
        rank = np.zeros(len(self.pieces), np.int64)
        for i, r in self.rank.items():
            rank[i] = r
        self.ranks = rank
        pairs = [(self.ids[p[:k]], self.ids[p[k:]], self.rank[i]) for i in merges for p in [self.pieces[i]] for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        width = len(self.pieces)
        keys = np.array([a * width + b for a, b, _ in pairs] or [-1], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([r for *_, r in pairs] or [0], np.int64)[order]
        # a segment ends before a space mark that no piece can hold after another character
        self.inner_mark = any(re.search(f"[^{META}]{META}", p) for p in self.ids)
        self.longest = max((len(p) for i, p in enumerate(self.pieces) if i in self.usable), default=1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, self.longest + 1):
            own = [i for i in self.usable if len(self.pieces[i]) == n]
            if own:
                text = np.array([[ord(c) for c in self.pieces[i]] for i in own], np.uint32)
                self.by_length[n] = (np.array(own, np.int64), text)

    def _merge(self, piece: str, below: int) -> list[int] | None:
        """The ids that merging leaves of piece, with merges of ranks under `below` only."""
        parts = [self.ids.get(c) for c in piece]
        if None in parts:
            return None
        names = list(piece)
        while len(parts) > 1:
            best = min(((self.rank[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(names, names[1:])) if self.ids.get(a + b) is not None and self.rank[self.ids[a + b]] < below), default=None)
            if best is None:
                break
            k = best[1]
            names[k : k + 2] = [names[k] + names[k + 1]]
            parts[k : k + 2] = [self.ids[names[k]]]
        return parts

    def joins(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For each pair of adjacent pieces, whether merging keeps the border between them."""
        a, b = first.copy(), second.copy()
        width, ok = len(self.pieces), np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            keys = x * width + y
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merged = (self.pair_keys[at] == keys) & (self.pair_ranks[at] < limit[live])
            ok[live[merged]] = False
            live, x, y = live[~merged], x[~merged], y[~merged]
            rx, ry = self.ranks[x], self.ranks[y]
            # the piece that was merged last is undone; on equal ranks the left one was merged first
            undo_left = rx > ry
            limit[live] = np.where(undo_left, rx, ry + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            live = live[(rx > 0) | (ry > 0)]
        return ok


@functools.lru_cache(4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def suffix_array(rank: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(positions in the order of their first `depth` codes, packed keys, codes a key); rank: 0 the border, 1 and up the codes.

    Beyond a border the order is of no use, as no piece holds one: only positions without a border among the codes of
    a key are ordered by what follows.
    """
    per = max(1, 63 // bits)
    key = np.zeros(len(rank), np.uint64)
    clear = np.ones(len(rank), bool)
    for k in range(per):
        key <<= np.uint64(bits)
        own = rank[k:]
        key[: len(own)] |= own.astype(np.uint64)
        clear[: len(own)] &= own > 0
        clear[len(own) :] = False
    order = np.argsort(key)
    if per < depth:
        at = np.flatnonzero(clear[order])
        own = order[at]
        by = [key[own]]
        for step in range(per, depth, per):
            by.append(key[np.minimum(own + step, len(key) - 1)])
        order[at] = own[np.lexsort(by[::-1])]
    return order, key, per


def occurrences(order: np.ndarray, key: np.ndarray, per: int, bits: int, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece (a row of ranks, all known) the range of the suffix array whose suffixes start with it."""
    n = pieces.shape[1]
    lo, hi = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(order), np.int64)
    for first in range(0, n, per):
        part = pieces[:, first : first + per]
        low = np.zeros(len(pieces), np.uint64)
        for k in range(part.shape[1]):
            low = low << np.uint64(bits) | part[:, k].astype(np.uint64)
        free = np.uint64(bits * (per - part.shape[1]))
        low, high = low << free, ((low + np.uint64(1)) << free) - np.uint64(1)
        lo, hi = _bisect(order, key, first, low, lo, hi, False), _bisect(order, key, first, high, lo, hi, True)
    return lo, hi


def _bisect(order: np.ndarray, key: np.ndarray, shift: int, value: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> np.ndarray:
    """For each row the first place in order[lo:hi] whose key, `shift` codes on, is not below value (above it, if after)."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        k = key[np.minimum(order[np.minimum(mid, len(order) - 1)] + shift, len(key) - 1)]
        below = open_ & ((k <= value) if after else (k < value))
        lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
    return lo


def edges(codes: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of all pieces over codes, sorted by end and falling size: (first edge of each end, piece, size).

    codes ends with a border. A character outside the vocabulary is an edge of its own, LONE, that merges with nothing.
    """
    place = np.zeros(int(BORDER) + 1, np.int32)
    place[codes] = 1
    values = np.flatnonzero(place)
    border = len(values) - 1  # BORDER is above all code points
    place[values] = np.r_[1 : border + 1, 0]
    rank = place[codes]
    bits = max(border.bit_length(), 1)
    order, key, per = suffix_array(rank, bits, model.longest)
    found = []
    covered = codes == BORDER
    for n, (own, text) in model.by_length.items():
        at = np.minimum(np.searchsorted(values, text), border)
        known = (values[at] == text).all(axis=1)
        own, ranks = own[known], at[known] + 1
        lo, hi = occurrences(order, key, per, bits, ranks)
        count = hi - lo
        some = count > 0
        count, lo = count[some], lo[some]
        places = order[np.repeat(lo - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())]
        found.append((n, places + n, np.repeat(own[some].astype(np.int32), count)))
        if n == 1:
            covered[places] = True
    lone = np.flatnonzero(~covered) + 1
    found.append((1, lone, np.full(len(lone), LONE, np.int32)))
    # a counting sort by position: no two edges of one size end at one place, as pieces and LONE differ
    count = np.zeros(len(codes) + 2, np.int32)
    for _, ends, _ in found:
        count[ends + 1] += 1
    first = np.cumsum(count)
    fill = first[:-1].copy()
    piece, size = np.empty(first[-1], np.int32), np.empty(first[-1], np.int8)
    for n, ends, own in sorted(found, key=lambda x: -x[0]):
        at = fill[ends]
        piece[at], size[at] = own, n
        fill[ends] += 1
    return first, piece, size


class Encoder:
    """Encodes batches of texts; keeps the answers of late to `joins`, in tables of fixed size."""

    def __init__(self, model: PieceModel, bits: int = 18):
        self.model, self.bits = model, bits
        self.asked, self.answer = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, bool)

    def joins(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = first * np.int64(len(self.model.pieces)) + second
        at = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.answer[at]
        new = np.flatnonzero(self.asked[at] != key)
        if len(new):
            ask, back = np.unique(key[new], return_inverse=True)
            got = self.model.joins(*np.divmod(ask, len(self.model.pieces)))[back]
            out[new] = got
            self.asked[at[new]], self.answer[at[new]] = key[new], got  # of keys that share a place the last stays
        return out

    def segments(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of the segments, which stand in codes from first on; a border follows each."""
        begin_edge, piece, size = edges(codes, self.model)
        last = np.full(len(codes) + 1, -1, np.int32)  # the piece that ends at a position
        back = np.zeros(len(codes) + 1, np.int8)  # and its size
        begins = np.zeros(len(codes) + 1, bool)
        begins[first] = True
        by_size = np.argsort(sizes, kind="stable")
        ordered = sizes[by_size]
        for depth in range(1, int(ordered[-1]) + 1):  # all segments relax step by step together
            begin = int(np.searchsorted(ordered, depth))
            if len(sizes) - begin < FEW:
                for i in by_size[begin:].tolist():
                    self._relax_on(begin_edge, piece, size, last, back, int(first[i]), depth, int(sizes[i]))
                break
            ends = first[by_size[begin:]] + depth
            at = begin_edge[ends]
            while len(ends):  # the next longest edge of every end that has none yet
                p, n = piece[at], size[at]
                start = ends - n
                before = last[start]
                sure = begins[start] | (p == LONE) | (before == LONE)
                ask = np.flatnonzero(~sure)
                sure[ask] = self.joins(before[ask].astype(np.int64), p[ask].astype(np.int64))
                done = ends[sure]
                last[done], back[done] = p[sure], n[sure]
                ends, at = ends[~sure], at[~sure] + 1
        # walk back from the ends of all segments together
        own, at = np.arange(len(sizes)), first + sizes
        places, found = [], []
        while len(own):
            found.append(last[at])
            at = at - back[at]
            places.append(at)
            more = at > first[own]
            own, at = own[more], at[more]
        place, got = np.concatenate(places), np.concatenate(found)
        by = np.argsort(place)
        place, got = place[by], got[by]
        of_first = np.argsort(first)
        ends = np.empty(len(first), np.int64)
        ends[of_first] = np.searchsorted(place, (first + sizes)[of_first])
        lone = np.flatnonzero(got == LONE)
        if len(lone):  # byte fallback
            coded = [self._bytes(int(c)) for c in codes[place[lone]]]
            width = np.ones(len(got), np.int64)
            width[lone] = [len(c) for c in coded]
            upto = np.r_[0, np.cumsum(width)]
            whole = np.repeat(got, width)
            whole[np.repeat(upto[lone], width[lone]) + np.concatenate([np.arange(len(c)) for c in coded])] = np.concatenate(coded)
            got, ends = whole, upto[ends]
        return got, ends

    def _bytes(self, code: int) -> list[int]:
        ids = [self.model.byte_ids[b] for b in chr(code).encode("utf-8", "replace")]
        return [self.model.unk] if self.model.unk in ids else ids

    def _relax_on(self, begin_edge, piece, size, last, back, first: int, depth: int, count: int) -> None:
        """The same relaxation for one segment from `depth` on: few and long ones are left."""
        for end in range(first + depth, first + count + 1):
            for e in range(int(begin_edge[end]), int(begin_edge[end + 1])):
                p, n = int(piece[e]), int(size[e])
                before = int(last[end - n])
                if end - n == first or LONE in (p, before) or self.joins(np.array([before]), np.array([p]))[0]:
                    last[end], back[end] = p, n
                    break

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The piece ids of each text, as an Arrow array; null texts count as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # a mark stands for a space, and one is put before each text that is not empty
        texts = pc.replace_substring(texts, META, " ")
        head = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        marked = pc.binary_join_element_wise(head, texts, pa.scalar("", pa.large_string()))
        ends = np.frombuffer(marked.buffers()[1], np.int64, len(marked) + 1, marked.offset * 8)
        data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[: ends[-1]]
        begins = np.zeros(len(data) + 1, bool)
        if not self.model.inner_mark:  # a segment ends before a space mark that no piece can hold after another character
            begins[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        begins[ends] = True
        begins[len(data)] = True
        cuts = np.flatnonzero(begins)
        if not len(data):
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.int32()))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), marked.buffers()[2]])
        held = pieces.dictionary_encode()
        each = self._distinct(held.dictionary).take(held.indices)
        upto = np.frombuffer(each.buffers()[1], np.int32, len(each) + 1)
        return pa.ListArray.from_arrays(pa.array(upto[np.searchsorted(cuts, ends)]), each.values)

    def _distinct(self, segments: pa.Array) -> pa.ListArray:
        """The piece ids of distinct segments, about CHARS characters of them at a time; a longer one stands alone."""
        ends = np.frombuffer(segments.buffers()[1], np.int64, len(segments) + 1)
        data = np.frombuffer(segments.buffers()[2], np.uint8)[: ends[-1]]
        chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][ends]
        ids, upto, at = [], [np.zeros(1, np.int64)], 0
        while at < len(segments):
            to = max(at + 1, int(np.searchsorted(chars, chars[at] + CHARS, "right")) - 1)
            plain = np.frombuffer(data[ends[at] : ends[to]].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            sizes = np.diff(chars[at : to + 1])
            first = chars[at:to] - chars[at] + np.arange(to - at)
            codes = np.full(len(plain) + len(sizes), BORDER)
            codes[np.arange(len(plain)) + np.repeat(np.arange(to - at), sizes)] = np.where(plain == 32, np.uint32(ord(META)), plain)
            got, own = self.segments(codes, first, sizes)
            upto.append(upto[-1][-1] + own)
            ids.append(got.astype(np.int32))
            at = to
        return pa.ListArray.from_arrays(pa.array(np.concatenate(upto).astype(np.int32)), pa.array(np.concatenate(ids)))


def decode_lists(lists: pa.ListArray, model: PieceModel) -> pa.Array:
    """The text of each list of ids: byte pieces joined and decoded, marks as spaces, without the leading one. Null gives an empty text."""
    lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
    flat = lists.flatten()
    upto = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].astype(np.int64)
    shown = model.shown.take(flat)
    offsets = np.frombuffer(shown.buffers()[1], np.int64, len(shown) + 1)[upto]
    plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(offsets), shown.buffers()[2] or pa.py_buffer(b"")])
    try:
        texts = plain.cast(pa.large_string())
    except pa.ArrowInvalid:  # byte pieces that are no UTF-8
        texts = pa.array([x.decode("utf-8", "replace") for x in plain.to_pylist()], pa.large_string())
    return pc.replace_substring_regex(texts, "^ ", "").cast(pa.string())


def decode_ids(ids: list[int], model: PieceModel) -> str:
    return decode_lists(pa.array([ids], pa.list_(pa.int32())), model)[0].as_py()


def encode(docs: DataFrame, model_path: str | None = None, text: str = "text", ids_out: str = "piece_ids") -> DataFrame:
    """docs with ids_out: the piece ids of the whole text, array<int>; null and empty texts give an empty array.

    A column named like ids_out is replaced, other columns pass through; rows map one to one.
    """
    path = model_path or default_model_path()
    fields = [T.StructField(ids_out, T.ArrayType(T.IntegerType()))]

    def start():
        encoder = Encoder(piece_model(path))
        return lambda texts: [encoder.encode(texts)]

    return map_texts(docs, [text], fields, start, slab=2_000_000, arrow=True)


def decode(docs: DataFrame, model_path: str | None = None, ids: str = "piece_ids", text_out: str = "decoded") -> DataFrame:
    """docs with text_out: the text of the ids; null ids give an empty text. A column named like text_out is replaced."""
    path = model_path or default_model_path()
    bound_batches(docs.sparkSession)
    kept = docs.drop(text_out)
    schema = T.StructType([*kept.schema.fields, T.StructField(text_out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = decode_lists(batch.column(batch.schema.get_field_index(ids)), piece_model(path))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return kept.mapInArrow(run, schema)
