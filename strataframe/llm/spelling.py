"""Spelling variants: words one edit apart, each led to its far more frequent form.

Full neighbourhood generation: for every word all distinct deletions, replacements and insertions over the observed alphabet
are made, and those that are words are found by a join on equal strings, so no distance is ever computed. The neighbours
are made as hashes first, from prefix and suffix hashes of the word; only what a Bloom filter of the vocabulary can't rule
out becomes a string. The filter has a fixed greatest size; once it is full it rules out less, and the join decides all the same.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.batches import bound_batches, trim
from strataframe.storage import restored, stored

#: Letters of a run, as Latin-1 bytes of lower-cased text; page of the bitmap functions in bits.
RUN = rb"[a-z\xc0-\xff]{%d,}"
PAGE = 1 << 15


@dataclass(frozen=True)
class SpellingParams:
    """min_chars, min_count: code points and occurrences of a word. ratio: a form is so many times as frequent. slip: runs whose checksum it
    divides lose a letter (0: none). filter_bits: power of two of the most bits of the filter, probes into it for each word. cells: neighbours
    made at a time. entries: distinct words that a task counts before it gives them out."""

    min_chars: int = 7
    min_count: int = 2
    ratio: int = 10
    slip: int = 0
    filter_bits: int = 28
    probes: int = 4
    cells: int = 2_000_000
    entries: int = 200_000


def text_words(text: str, name: str, p: SpellingParams) -> Counter[bytes]:
    """Words of a text with their number, as Latin-1 bytes; name is the document's id in decimal."""
    found = Counter(re.findall(RUN % p.min_chars, text.encode("latin-1", "replace").lower()))
    if not p.slip:
        return found
    out: Counter[bytes] = Counter()
    before = zlib.crc32(f"{name}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if h % p.slip == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= p.min_chars:
            out[run] += n
    return out


def count_words(docs: DataFrame, params: SpellingParams = SpellingParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of all texts, with their number of occurrences.

    A word is a maximal run of letters A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z, of which params.slip may take one away; null and empty
    texts have none, a null key counts as empty text, and rows that repeat count each. No rows give none.
    """
    bound_batches(docs.sparkSession)

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update(text_words(body.as_py() or "", name or "", params))
                if len(counts) >= params.entries:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)
        trim()

    found = docs.select(F.col(key).cast("string").alias("name"), F.col(text).alias("body")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= params.min_count)


def spread(position: np.ndarray, code: np.ndarray) -> np.ndarray:
    """64 mixed bits for a code point at a position; a word's hash is the exclusive or of its own."""
    z = position.astype(np.uint64) * np.uint64(0x110000) + code.astype(np.uint64) + np.uint64(1)
    z = z * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def probe(h: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Bit of the k-th probe of a word's hash."""
    return (h * np.uint64(2 * k + 1) + h.byteswap() * np.uint64(k)) >> np.uint64(64 - bits)


def by_length(words: list[str], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, code points as a matrix) of words of one length, about cells code points at a time."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, cells // size)
        for a in range(0, len(rows), step):
            own = rows[a : a + step]
            joined = "".join(words[i] for i in own.tolist()).encode("utf-32-le", "surrogatepass")
            yield own, np.frombuffer(joined, np.uint32).reshape(len(own), size)


def alphabet_of(words: DataFrame) -> np.ndarray:
    """The distinct code points of the column word, ascending; at most as many as there are code points."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint32)
        for batch in batches:
            seen = np.union1d(seen, np.frombuffer("".join(batch.column(0).to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32))], names=["code"])

    codes = words.select("word").mapInArrow(some, "code int").distinct().collect()
    return np.sort(np.array([r["code"] for r in codes], np.uint32))


def vocabulary_filter(words: DataFrame, p: SpellingParams) -> tuple[int, np.ndarray]:
    """(its size as a power of two, a Bloom filter of the column word as bytes), 64 bits a word up to the greatest size."""
    bits = min(p.filter_bits, max(PAGE.bit_length() - 1, int(words.count() * 64 - 1).bit_length()))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in by_length(batch.column(0).to_pylist(), p.cells):
                h = np.bitwise_xor.reduce(spread(np.arange(codes.shape[1])[None, :], codes), axis=1)
                at = np.concatenate([probe(h, k, bits) for k in range(p.probes)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at // PAGE), pa.array(at % PAGE)], names=["page", "bit"])

    pages = words.select("word").mapInArrow(hashed, "page long, bit long").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = np.frombuffer(r["bitmap"], np.uint8)
    return bits, out


def neighbours(words: list[str], alphabet: np.ndarray, bits: int, known: np.ndarray, p: SpellingParams) -> Iterator[tuple[int, str]]:
    """(row, neighbour): the distinct strings one deletion, replacement or insertion away that the filter doesn't rule out."""

    def passing(h: np.ndarray, possible: np.ndarray) -> np.ndarray:
        flat = h.ravel()
        at = np.flatnonzero(possible.ravel())
        for k in range(p.probes):
            where = probe(flat[at], k, bits)
            at = at[known[where >> np.uint64(3)] >> (where & np.uint64(7)).astype(np.uint8) & 1 > 0]
        return np.stack(np.unravel_index(at, h.shape), axis=1)

    for rows, codes in by_length(words, max(1, p.cells // max(len(alphabet), 1))):
        n, size = codes.shape
        zeros, places = np.zeros((n, 1), np.uint64), np.arange(size)[None, :]
        suffix = lambda x: np.bitwise_xor.accumulate(np.concatenate([zeros, x[:, ::-1]], axis=1), axis=1)[:, ::-1]
        here = spread(places, codes)
        prefix = np.bitwise_xor.accumulate(np.concatenate([zeros, here], axis=1), axis=1)
        later, earlier = suffix(spread(places + 1, codes)), suffix(spread(np.maximum(places - 1, 0), codes))
        # of a run of equal letters the first is deleted
        first = np.concatenate([np.ones((n, 1), bool), codes[:, 1:] != codes[:, :-1]], axis=1)
        for r, i in passing(prefix[:, :size] ^ earlier[:, 1:], first).tolist():
            word = words[rows[r]]
            yield int(rows[r]), word[:i] + word[i + 1 :]
        step = max(1, p.cells // max(n * len(alphabet), 1))
        for a in range(0, size + 1, step):
            z = min(a + step, size + 1)
            letter = spread(np.arange(a, z)[:, None], alphabet[None, :])
            # at the end of a run of equal letters one more is inserted
            ahead = np.concatenate([codes, np.full((n, 1), 0xFFFFFFFF, np.uint32)], axis=1)[:, a:z]
            other = ahead[:, :, None] != alphabet[None, None, :]
            for r, i, c in passing((prefix[:, a:z] ^ later[:, a:z])[:, :, None] ^ letter[None], other).tolist():
                word = words[rows[r]]
                yield int(rows[r]), word[: a + i] + chr(alphabet[c]) + word[a + i :]
            z = min(z, size)
            if a < z:
                for r, i, c in passing((prefix[:, size:] ^ here[:, a:z])[:, :, None] ^ letter[None, : z - a], other[:, : z - a]).tolist():
                    word = words[rows[r]]
                    yield int(rows[r]), word[: a + i] + chr(alphabet[c]) + word[a + i + 1 :]


def near_words(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """(word, near, near_n): all pairs of words, both ways, that one edit parts. words: (word, n), each word once."""
    spark = words.sparkSession
    alphabet = alphabet_of(words)
    bits, bitmap = vocabulary_filter(words, params)
    held = spark.sparkContext.broadcast(bitmap)  # 2 ** params.filter_bits bits at most

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda own, near: pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(near, pa.string())], names=["word", "near"])
        for batch in batches:
            texts, own, near, chars = batch.column(0).to_pylist(), [], [], 0
            for i, other in neighbours(texts, alphabet, bits, held.value, params):
                own.append(texts[i])
                near.append(other)
                chars += 2 * len(other)
                if chars >= params.cells:
                    yield pack(own, near)
                    own, near, chars = [], [], 0
            yield pack(own, near)
        trim()

    candidates = words.select("word").mapInArrow(made, "word string, near string")
    return candidates.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. A form is more frequent than its word, so none comes back; each round doubles the steps."""
    led, path = restored(forms.select("word", F.col("form").alias("root")), None, "roots")
    while True:
        ahead = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if led.join(ahead, "root", "left_semi").isEmpty():
            return led
        led, path = restored(led.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), path, "roots")


def group_variants(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of words (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point. form is the near word of the largest n, the smallest in
    code-point order of several, if its n is at least params.ratio times the word's own (2 at least); form_n is its n. root is where following forms
    ends, the word itself without one. Null and empty words are left out; rows of one word are summed up. No rows give none.
    """
    whole = stored(words.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    found = near_words(whole, params).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = (-F.col("best.minus")) >= F.col("n") * max(params.ratio, 2)
    met = whole.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.minus")).alias("form_n"))
    met = stored(met, "forms")
    led = roots(met.filter("form IS NOT NULL"))
    return met.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, params: SpellingParams = SpellingParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """group_variants of the words of docs, as count_words counts them; other columns of docs don't matter."""
    return group_variants(count_words(docs, params, key, text), params)
