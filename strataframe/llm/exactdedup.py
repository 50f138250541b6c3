"""Exact deduplication over content-defined chunk recipes.

Each text is normalised, cut at content-defined boundaries and becomes a recipe: the ordered list of its chunks'
identifiers. Chunk contents move once, are deduplicated, and an identifier is verified by comparing contents:
two contents under one hash get different ordinals. Texts are then compared by their recipes, never by moving
the texts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.llm.batches import bound_batches
from strataframe.storage import stored

SPACE = b" \t\n\v\f\r"


@dataclass(frozen=True)
class ChunkParams:
    """A boundary follows a window of `window` bytes whose hash has `bits` zero bits; chunks have min_bytes to max_bytes. hash_bytes: of a
    chunk's identifier; clashes are found and told apart at any number."""

    window: int = 16
    bits: int = 11
    min_bytes: int = 512
    max_bytes: int = 16_384
    hash_bytes: int = 16


def cut_points(data: bytes, p: ChunkParams = ChunkParams()) -> list[int]:
    """Ends of the chunks of data; they depend on the content around them alone, but for the size bounds."""
    n = len(data)
    if n <= p.min_bytes:
        return [n] if n else []
    h = np.frombuffer(data, np.uint8).astype(np.uint32)
    h += np.uint32(1)
    step, mult = 1, np.uint32(0x9E3779B1)
    while step < p.window:  # doubling: a hash over 2 * step bytes from two over step bytes
        h[step:] += h[:-step] * mult
        mult = np.uint32(int(mult) * int(mult) & 0xFFFFFFFF)
        step *= 2
    h *= np.uint32(0x85EBCA6B)
    marks = np.flatnonzero(h >> np.uint32(32 - p.bits) == 0) + 1
    ends, last = [], 0
    for m in marks.tolist():
        if m - last < p.min_bytes:
            continue
        while m - last > p.max_bytes:
            last += p.max_bytes
            ends.append(last)
        if m - last >= p.min_bytes:
            ends.append(m)
            last = m
    while n - last > p.max_bytes:
        last += p.max_bytes
        ends.append(last)
    return ends if last == n else [*ends, n]


def recipes(docs: DataFrame, params: ChunkParams = ChunkParams(), key: str = "doc_id", text: str = "text", contents: bool = True) -> DataFrame:
    """Per row: doc_id, n_code_points of the text, text_sha256 of the normalised text, ids (chunk hashes in order), chunks (null without contents)."""
    bound_batches(docs.sparkSession)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, t in zip(frame["doc_id"], frame["text"]):
                t = t or ""
                data = t.encode("utf-8", "surrogatepass").translate(None, SPACE)
                ends = cut_points(data, params)
                chunks = [data[a:b] for a, b in zip([0, *ends], ends)]
                out.append((doc_id, len(t), hashlib.sha256(data).hexdigest(), [xxhash.xxh3_128_digest(c)[: params.hash_bytes] for c in chunks], chunks if contents else None))
            yield pd.DataFrame(out, columns=["doc_id", "n_code_points", "text_sha256", "ids", "chunks"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, f"doc_id {kind}, n_code_points long, text_sha256 string, ids array<binary>, chunks array<binary>")


def exact_duplicates(docs: DataFrame, params: ChunkParams = ChunkParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space (space, \\t \\n \\v \\f \\r); null counts as empty,
    so null and empty texts form one group. The row with the most code points in its original text stays, then the
    one with the smallest doc_id (null sorts first); of rows that repeat both, one is kept. An empty table
    gives an empty result; other columns of docs are not read.
    """
    # Chunk contents move once, from here; the recipe table is what later steps read.
    path = stored(recipes(docs, params, key, text, contents=False).select("doc_id", "n_code_points", "text_sha256", "ids"), "recipes")
    chunks = recipes(docs, params, key, text).select(F.explode(F.arrays_zip("ids", "chunks")).alias("c")).select(F.col("c.ids").alias("id"), F.col("c.chunks").alias("chunk"))
    contents = chunks.distinct()  # equal keys collapse before the shuffle and are compared byte by byte
    clash = contents.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    clash = stored(clash, "clashing")
    if clash.isEmpty():
        verified = path
    else:  # a hash with several contents: the recipe takes the rank of the content beside the hash
        ranked = contents.join(clash, "id", "left_semi").withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("chunk")))
        pieces = recipes(docs, params, key, text).select("text_sha256", F.posexplode(F.arrays_zip("ids", "chunks")).alias("pos", "c"))
        pieces = pieces.select("text_sha256", "pos", F.col("c.ids").alias("id"), F.col("c.chunks").alias("chunk")).distinct()
        ident = F.concat("id", F.encode(F.coalesce("rank", F.lit(0)).cast("string"), "UTF-8"))
        pieces = pieces.join(ranked, ["id", "chunk"], "left").select("text_sha256", "pos", ident.alias("ident"))
        pieces = pieces.groupBy("text_sha256").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ident"))), lambda x: x["ident"]).alias("own"))
        verified = path.join(stored(pieces, "ranked"), "text_sha256", "left").withColumn("ids", F.coalesce("own", "ids")).select("doc_id", "n_code_points", "text_sha256", "ids")
    best = F.min(F.struct((-F.col("n_code_points")).alias("order"), F.col("doc_id").alias("keep_id"))).alias("best")
    groups = verified.groupBy("ids").agg(best, F.count("*").alias("group_size"))
    # written first: both sides of the join are then plain shuffles, whose hot keys adaptive execution splits
    groups = stored(groups.select("ids", "best.keep_id", F.negative("best.order").alias("most"), "group_size"), "groups")
    rows = verified.join(groups, "ids")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_code_points") == F.col("most"))
    # rows that repeat text and doc_id: one of them is kept
    ordinal = F.row_number().over(W.partitionBy("doc_id", "text_sha256", first).orderBy("n_code_points"))
    return rows.select("doc_id", "keep_id", "group_size", (first & (ordinal == 1)).alias("kept"), "text_sha256")
