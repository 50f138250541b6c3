"""Benchmark decontamination: approximate containment of test items by the pigeonhole principle.

An item may occur with up to k edits. Split into k + 1 pieces, at least one piece must occur exactly, so one
Aho-Corasick pass finds all places that can match; each is verified with Myers' bit-parallel distance. What passes
must also begin and end at word borders of the text, which one more distance over the same window decides.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.batches import map_texts
from strataframe.storage import stored



@dataclass(frozen=True)
class LeakParams:
    """error_rate: edits allowed per character of an item, at every length. block_bytes: items are broadcast in blocks of
    about so many characters, one pass over the texts per block."""

    error_rate: float = 0.08
    block_bytes: int = 4_000_000


def normalise(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def pieces_of(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): item in k + 1 parts of nearly equal length."""
    cuts = [len(item) * j // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(pattern: str, text: str, limit: int) -> int:
    """Least edit distance of pattern to any substring of text, limit + 1 if above limit (Myers 1999)."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            best = min(best, score)
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return min(best, limit + 1)


def border(text: str, at: int) -> bool:
    """Whether no word of letters, digits and underscores goes on over position at."""
    inside = lambda c: c.isalnum() or c == "_"
    return not (0 < at < len(text) and inside(text[at - 1]) and inside(text[at]))


def bordered_distance(pattern: str, text: str, a: int, b: int, limit: int) -> int:
    """Least edit distance of pattern to a substring of text[a:b] between word borders of text, limit + 1 if above limit."""
    a, b = max(a, 0), min(b, len(text))
    far = len(pattern) + b - a
    ends = np.array([border(text, j) for j in range(a, b + 1)])
    codes = np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), np.uint32)
    step = np.arange(b - a + 1)
    row = np.minimum.accumulate(np.where(ends, 0, far) - step) + step  # text before the item's first character is inserted too
    for i, c in enumerate(pattern, 1):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (codes != ord(c)))
        row = np.minimum.accumulate(new - step) + step  # insertions: from any place before
    return min(int(row[ends].min(initial=limit + 1)), limit + 1)


def occurs(item: str, text: str) -> bool:
    """Whether item stands in text between word borders."""
    at = text.find(item)
    while at >= 0:
        if border(text, at) and border(text, at + len(item)):
            return True
        at = text.find(item, at + 1)
    return False


class LeakIndex:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], params: LeakParams):
        self.items: dict[int, tuple[int, str, int]] = {}  # by position in the block, as ids may repeat
        self.auto = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for n, (item_id, text) in enumerate(items):
            norm = normalise(text)
            if not norm:
                continue
            k = min(int(params.error_rate * len(norm)), len(norm) - 1)
            self.items[n] = (item_id, norm, k)
            for offset, piece in pieces_of(norm, k):
                at.setdefault(piece, []).append((n, offset))
        for piece, places in at.items():
            self.auto.add_word(piece, (len(piece), places))
        if at:
            self.auto.make_automaton()

    def find(self, text: str | None) -> dict[int, int]:
        """{item_id: least edits} over the items that text contains."""
        if not self.items or not text:
            return {}
        norm = normalise(text)
        spans: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.auto.iter(norm):
            for n, offset in places:
                _, item, k = self.items[n]
                a = end + 1 - size - offset - k
                b = a + len(item) + 2 * k
                own = spans.setdefault(n, [])
                if own and a <= own[-1][1]:  # windows that overlap are read once
                    own[-1][1] = max(b, own[-1][1])
                    own[-1][0] = min(a, own[-1][0])
                else:
                    own.append([a, b])
        found: dict[int, int] = {}
        for n, windows in spans.items():
            item_id, item, k = self.items[n]
            d = 0 if occurs(item, norm) else k + 1
            if d and k:  # the cheap distance first, as pieces of short items are common
                near = [(a, b) for a, b in windows if best_distance(item, norm[max(a, 0) : b], k) <= k]
                d = min([bordered_distance(item, norm, a, b, k) for a, b in near] + [k + 1])
            if d <= k:
                found[item_id] = min(d, found.get(item_id, d))
        return found


def _blocks(items: DataFrame, params: LeakParams) -> Iterator[list[tuple[int, str]]]:
    """Items as the driver streams them, one partition at a time, in blocks of bounded size."""
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= params.block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams(), text: str = "text", item: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """docs with out: array of (item_id, edits), sorted, the items that the whole text contains within the budget.

    Case and white space do not count. Null and empty texts and items match nothing; a null item_id is ignored, and ids may have any type that is ordered;
    items repeated under one id count once each with their least edits. A column named like out is replaced;
    other columns pass through. The items go out in blocks of params.block_bytes, a bound on every broadcast, one in memory at a time; where
    there are several, the documents are written once, and each block's hits.
    """
    keyed = benchmark.select(F.col(item).alias("item_id"))
    leak = T.ArrayType(T.StructType([T.StructField("item_id", keyed.schema["item_id"].dataType), T.StructField("edits", T.IntegerType())]))
    items = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")
    blocks = _blocks(items, params)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _searched(docs, first, params, text, out, leak)
    # several: documents are numbered once, each block's pass reads numbers and texts and writes its hits, and these are joined at the end
    rest = [c for c in docs.columns if c != out]
    whole = stored(docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.col(text).alias("text")).withColumn("id", F.monotonically_increasing_id()), "numbered")
    hits = []
    for block in itertools.chain([first, second], blocks):
        found = _searched(whole.select("id", "text"), block, params, "text", "leaks", leak).filter(F.size("leaks") > 0)
        hits.append(stored(found.select("id", F.inline("leaks")), "hits"))
    least = reduce(DataFrame.unionByName, hits).groupBy("id", "item_id").agg(F.min("edits").alias("edits"))
    per = least.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("item_id", "edits"))).alias("leaks"))
    met = whole.join(per, "id", "left")
    return met.select("row.*", F.coalesce("leaks", F.array().cast(leak)).alias(out))


def _searched(docs: DataFrame, block: list[tuple], params: LeakParams, text: str, out: str, leak: T.ArrayType) -> DataFrame:
    """docs with out, the hits of one block of items."""
    held = docs.sparkSession.sparkContext.broadcast(block)

    def start():
        index = LeakIndex(held.value, params)
        return lambda texts: [[[{"item_id": a, "edits": b} for a, b in sorted(index.find(t).items())] for t in texts]]

    return map_texts(docs, [text], [T.StructField(out, leak)], start)
