"""Line deduplication: lines that stand in several documents stay in the first of these alone.

Native: lines are exploded as hashes with their positions, the distinct documents of every hash are counted, and what is
over the threshold goes. Only hashes and positions move; each text is put together again from the positions that stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class LineParams:
    """min_chars: code points of a key from which it counts. min_docs: distinct documents from which a key is a repeated one.
    parts: a hash with more than one part in so many of all lines goes through a broadcast of at most so many rows."""

    min_chars: int = 10
    min_docs: int = 2
    parts: int = 1024


def line_keys(text: Column) -> Column:
    """The lines of text, stripped of ASCII white space at both ends, A-Z as a-z."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(low, "\n"), lambda x: F.btrim(x, F.lit(SPACE)))


def text_id(text: Column) -> Column:
    """60 bits of a text's SHA-256: tells rows that share a document's id apart."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def repeated_lines(docs: DataFrame, params: LineParams = LineParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tid, gone): for each text that loses lines, the document's id, the text's identifier and the distinct positions, from 0,
    of its lines to drop. Rows of one id and one text share a row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc"), text_id(body).alias("tid"), F.posexplode(line_keys(body)).alias("pos", "line")).filter(F.length("line") >= params.min_chars)
    lines = stored(rows.select("doc", "tid", "pos", F.unhex(F.substring(F.sha2("line", 256), 1, 32)).alias("hash")), "lines")
    ids = [F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.when(F.col("doc").isNull(), 1)).alias("nulls")]
    if params.min_docs > 2:
        once = lines.groupBy("hash", "doc").agg(F.count("*").alias("n"))
        counted = once.groupBy("hash").agg(F.min("doc").alias("first"), F.count("*").alias("docs"), F.sum("n").alias("n")).filter(F.col("docs") >= params.min_docs)
    else:  # two distinct documents: the least and the greatest id differ
        ids = [F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.when(F.col("doc").isNull(), 1)).alias("nulls")]
        several = F.col("last").isNotNull() & ((F.col("first") < F.col("last")) | (F.col("nulls") > 0))
        counted = lines.groupBy("hash").agg(*ids, F.count("*").alias("n")).filter(several)
    counted = stored(counted.select("hash", "first", "n"), "repeated")
    # at most params.parts hashes can each have more than that part of all lines: these are broadcast, so no task gets one whole
    total = lines.count()
    often = F.col("n") * params.parts > total
    hot = F.broadcast(counted.filter(often).select("hash", F.col("first").alias("hot_first"), F.lit(True).alias("hot")))
    met = lines.join(hot, "hash", "left")
    by_hot = met.filter("hot").select("doc", "tid", "pos", F.col("hot_first").alias("first"))
    rest = met.filter("hot IS NULL").select("hash", "doc", "tid", "pos").join(counted.filter(~often).select("hash", "first"), "hash").select("doc", "tid", "pos", "first")
    gone = by_hot.unionByName(rest).filter(~F.col("doc").eqNullSafe(F.col("first")))
    return gone.groupBy("doc", "tid").agg(F.collect_set("pos").alias("gone"))


def drop_repeated_lines(docs: DataFrame, params: LineParams = LineParams(), key: str = "doc_id", text: str = "text", out: str = "kept_text", lines_out: str = "n_lines", dropped_out: str = "n_dropped") -> DataFrame:
    """docs with out (the lines that stay, joined by newlines), lines_out (lines before) and dropped_out (lines dropped).

    A line's key has ASCII white space stripped at both ends and A-Z as a-z. Keys of at least params.min_chars code points in at
    least params.min_docs documents stay in the document of the smallest id alone, there with all their repeats (params.min_docs counts as 2 at least). A document is a key
    value: rows that share one are one document, and the rows without one are one too, the last. Null and empty texts are one empty line.
    Columns named like an output are replaced; all others pass through, whatever their names. No rows give none.
    """
    others = [c for c in docs.columns if c not in (out, lines_out, dropped_out)]
    body = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.col(key).alias("doc"), body.alias("body"), text_id(body).alias("tid"))
    gone = repeated_lines(docs, params, key, text)
    met = whole.join(gone, whole["doc"].eqNullSafe(gone["doc"]) & (whole["tid"] == gone["tid"]), "left").select("row", "body", "gone")
    n = F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    # the split lines are bound once, as the argument of an outer function
    kept = F.transform(F.array(F.split("body", "\n")), lambda lines: F.array_join(F.transform(stay, lambda i: lines[i]), "\n"))[0]
    return met.select("row.*", F.when(F.col("gone").isNull(), F.col("body")).otherwise(kept).alias(out), n.cast("long").alias(lines_out), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(dropped_out))
