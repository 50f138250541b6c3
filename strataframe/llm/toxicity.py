"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are character n-grams over word borders, kept when their frequency differs between the labels of a bounded
sample. Examples sit in an inverted index of blocks with the largest weight per term and block. Texts are scored some
hundred at a time: the bounds of all blocks are one matrix product; the blocks with the best bounds give each text a k-th similarity,
and of the rest every block whose bound reaches that of a text is opened for it, so the neighbours are exact. They vote with the
reciprocal of their cosine distance, and the vote becomes a probability by a logistic curve that is fitted on the examples
themselves, each voted on by the others (those that are nearly the same text left out).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.batches import bound_batches, letter_codes, map_texts, ngram_buckets, slabs
from strataframe.llm.langid import bounded_sample
from strataframe.storage import stored


@dataclass(frozen=True)
class ToxParams:
    """n, bits: length and hash bits of the n-grams. max_examples: bound of the labelled sample (expected value).
    max_terms, min_df, min_chi2: which n-grams become terms, the best by chi-squared. k: neighbours. block: examples per block. rows: texts
    scored together. shrink: weight of the base rate in a vote. near: least distance in a weight. same: similarity from which an
    example counts as a copy when votes are calibrated. calibrate: examples that these votes are taken on, at most."""

    n: int = 5
    bits: int = 22
    max_examples: int = 8192
    max_terms: int = 4096
    min_df: int = 3
    min_chi2: float = 6.635
    k: int = 16
    block: int = 64
    rows: int = 256
    shrink: float = 0.5
    near: float = 0.05
    same: float = 0.98
    calibrate: int = 2048


def _grams(texts: list[str | None], p: ToxParams) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each n-gram with at least n - 1 letters; words have one border on either side."""
    codes, starts = letter_codes([f" {t or ''}" for t in texts], p.n)
    h = ngram_buckets(codes, p.n, p.bits)
    full = np.zeros(len(codes), np.int8)
    for j in range(p.n):
        full[: len(codes) - j] += codes[j:] != 0
    at = np.flatnonzero(full >= p.n - 1)
    return np.searchsorted(starts, at, "right") - 1, h[at]


@dataclass
class ToxModel:
    params: ToxParams
    term_of: np.ndarray  # bucket -> term or -1
    idf: np.ndarray
    base_rate: float
    empty_rate: float  # of examples without terms
    labels: np.ndarray
    ids: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray]]  # terms present, weights [term, example]
    upper: np.ndarray  # [term, block]
    slope: float = 1.0  # of the logistic curve over the logit of a vote
    shift: float = 0.0


def vectors(texts: list[str | None], term_of: np.ndarray, idf: np.ndarray, p: ToxParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight), sorted; the weights of a text have length 1."""
    doc, bucket = _grams(texts, p)
    term = term_of[bucket]
    some = term >= 0
    key, tf = np.unique(doc[some].astype(np.int64) * max(len(idf), 1) + term[some], return_counts=True)
    doc, term = np.divmod(key, max(len(idf), 1))
    w = (1 + np.log(tf)) * (idf[term] if len(idf) else 0)
    norm = np.sqrt(np.bincount(doc, w * w, minlength=len(texts)))
    return doc, term, w / norm[doc]


def select_terms(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, p: ToxParams) -> np.ndarray:
    """Positions of the kept buckets, by chi-squared of the two by two table of documents."""
    n = n_clean + n_toxic
    df = clean + toxic
    expected = df * (n_toxic / max(n, 1))
    var = expected * (1 - n_toxic / max(n, 1)) * (1 - df / max(n, 1))
    chi2 = np.where(var > 0, (toxic - expected) ** 2 / np.maximum(var, 1e-9), 0)
    ok = np.flatnonzero((df >= p.min_df) & (chi2 >= p.min_chi2))
    return np.sort(ok[np.lexsort((ok, -chi2[ok]))][: p.max_terms])


def fit(rows: DataFrame, params: ToxParams = ToxParams(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxModel:
    """Builds the index from a bounded sample of rows with text and label; rows: key, text, label. Rows whose text or label is null are left
    out, rows that repeat a key are examples of their own, labels above 0 are toxic, and a key that is no number is null."""
    bound_batches(rows.sparkSession)
    rows = rows.select(F.col(key).try_cast("long").alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")).filter("text IS NOT NULL AND label IS NOT NULL")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, docs = np.zeros((2, 1 << params.bits), np.int32), np.zeros(2, np.int64)
        for frame in frames:
            for part in slabs(frame):
                for y, own in part.groupby(part["label"] > 0):
                    doc, bucket = _grams(own["text"].tolist(), params)
                    seen = np.unique((doc.astype(np.int64) << params.bits) + bucket) & ((1 << params.bits) - 1)
                    df[int(y)] += np.bincount(seen, minlength=1 << params.bits).astype(np.int32)
                    docs[int(y)] += len(own)
        at = np.flatnonzero(df.any(axis=0))
        yield pd.DataFrame({"bucket": np.r_[at, -1], "clean": np.r_[df[0, at], docs[0]], "toxic": np.r_[df[1, at], docs[1]]})

    got = rows.mapInPandas(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    got = got.filter((F.col("bucket") < 0) | (F.col("clean") + F.col("toxic") >= params.min_df))
    total = got.filter("bucket < 0").first()
    n_clean, n_toxic = (int(total["clean"] or 0), int(total["toxic"] or 0)) if total else (0, 0)
    n = max(n_clean + n_toxic, 1)
    # the same test again where Spark orders it, so that only the kept terms reach the driver
    d, t = F.col("clean") + F.col("toxic"), F.col("toxic")
    expected = d * F.lit(n_toxic / n)
    chi2 = F.pow(t - expected, 2) / F.greatest(expected * (1 - n_toxic / n) * (1 - d / n), F.lit(1e-9))
    best = got.filter("bucket >= 0").withColumn("chi2", chi2).filter(F.col("chi2") >= params.min_chi2).orderBy(F.desc("chi2"), "bucket").limit(params.max_terms).toPandas()
    kept = select_terms(best["clean"].to_numpy(np.int64), best["toxic"].to_numpy(np.int64), n_clean, n_toxic, params)
    buckets, df = best["bucket"].to_numpy(np.int64)[kept], (best["clean"] + best["toxic"]).to_numpy(np.float64)[kept]
    term_of = np.full(1 << params.bits, -1, np.int32)
    term_of[buckets] = np.arange(len(buckets))
    idf = np.log((1 + n) / (1 + df)) + 1

    def embed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in slabs(frame):
                doc, term, w = vectors(part["text"].tolist(), term_of, idf, params)
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                pair = list(zip(cuts[:-1], cuts[1:]))
                yield pd.DataFrame({"key": part["key"].to_numpy(), "label": part["label"].to_numpy(), "terms": [term[a:b].astype(np.int32) for a, b in pair], "weights": [w[a:b].astype(np.float32) for a, b in pair]})

    examples = rows.mapInPandas(embed, "key long, label int, terms array<int>, weights array<float>").toPandas()
    return index(examples, term_of, idf, n_toxic / n, params)


def index(examples: pd.DataFrame, term_of: np.ndarray, idf: np.ndarray, base_rate: float, p: ToxParams) -> ToxModel:
    """Blocks of similar examples: ordered by label and strongest term, so that bounds are tight."""
    empty = examples["terms"].map(len) == 0
    shrunk = (examples.loc[empty, "label"].clip(0, 1).sum() + base_rate) / (empty.sum() + 1)
    used = examples[~empty].copy()
    used["lead"] = [t[np.argmax(w)] for t, w in zip(used["terms"], used["weights"])]
    used = used.sort_values(["label", "lead", "key"], kind="stable").reset_index(drop=True)
    blocks, upper = [], np.zeros((len(idf), max(1, -(-len(used) // p.block))), np.float32)
    for b in range(0, len(used), p.block):
        own = used.iloc[b : b + p.block]
        terms = np.unique(np.concatenate(own["terms"].tolist()))
        weights = np.zeros((len(terms), len(own)), np.float32)
        for j, (t, w) in enumerate(zip(own["terms"], own["weights"])):
            weights[np.searchsorted(terms, t), j] = w
        upper[terms, b // p.block] = weights.max(axis=1)
        blocks.append((terms, weights))
    model = ToxModel(p, term_of, idf, float(base_rate), float(shrunk), used["label"].clip(0, 1).to_numpy(np.float64), used["key"].to_numpy(), blocks, upper)
    return calibrated(model, used)


def dense(doc: np.ndarray, term: np.ndarray, w: np.ndarray, rows: int, terms: int) -> np.ndarray:
    out = np.zeros((rows, terms), np.float32)
    out[doc, term] = w
    return out


def nearest(q: np.ndarray, model: ToxModel, copies: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """[text, rank] example and similarity of the k most similar examples of each text (a row of term weights), by falling similarity, then
    example; similarity 0 where there are no more. Without copies those from params.same on are left out."""
    p, n = model.params, len(model.labels)
    k = min(p.k, n)
    bound = q @ model.upper
    sims = np.full((len(q), n), -1.0, np.float32)
    done = np.zeros(bound.shape, bool)

    def open_(b: int, rows: np.ndarray) -> None:
        own, weights = model.blocks[b]
        s = q[np.ix_(rows, own)] @ weights
        if not copies:
            s[s >= p.same] = -1.0
        sims[rows, b * p.block : b * p.block + weights.shape[1]] = s
        done[rows, b] = True

    first = np.argsort(-bound, axis=1, kind="stable")[:, : max(2, -(-2 * k // p.block))]
    for b in np.unique(first).tolist():
        open_(b, np.flatnonzero((first == b).any(axis=1)))
    found = np.partition(sims, n - k, axis=1)[:, n - k]
    for b in np.argsort(-bound.max(axis=0), kind="stable").tolist():
        rows = np.flatnonzero(~done[:, b] & (bound[:, b] > 0) & (bound[:, b] + 1e-6 >= found))
        if len(rows):
            open_(b, rows)
    key = np.round(sims.astype(np.float64), 6) - np.arange(n) * 1e-12  # ties go to the lesser example
    top = np.argpartition(-key, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(q), 1))
    order = np.argsort(-np.take_along_axis(key, top, axis=1), axis=1, kind="stable")
    top = np.take_along_axis(top, order, axis=1)
    return top, np.maximum(np.take_along_axis(sims, top, axis=1), 0.0).astype(np.float64)


def votes(top: np.ndarray, sims: np.ndarray, model: ToxModel) -> np.ndarray:
    """The share of toxic neighbours, each weighted by the reciprocal of its distance, drawn to the base rate."""
    p = model.params
    weight = np.where(sims > 0, 1 / np.maximum(1 - sims, p.near) - 1, 0.0)
    return ((weight * model.labels[top]).sum(axis=1) + p.shrink * model.base_rate) / (weight.sum(axis=1) + p.shrink)


def _logit(v: np.ndarray) -> np.ndarray:
    v = np.clip(v, 1e-4, 1 - 1e-4)
    return np.log(v / (1 - v))


def calibrated(model: ToxModel, used: pd.DataFrame) -> ToxModel:
    """model with the logistic curve of the votes on its own examples (evenly chosen, params.calibrate at most), by Newton steps. The targets are
    drawn a little together, so that few examples give no steep curve; a curve that would fall is left out."""
    p = model.params
    some = np.unique(np.linspace(0, len(used) - 1, min(len(used), p.calibrate)).astype(int)) if len(used) else np.zeros(0, int)
    y = model.labels[some] if len(some) else np.zeros(0)
    if min(y.sum(), len(y) - y.sum()) < 2:
        return model
    x = np.empty(len(some))
    for a in range(0, len(some), p.rows):
        own = used.iloc[some[a : a + p.rows]]
        sizes = own["terms"].map(len).to_numpy()
        q = dense(np.repeat(np.arange(len(own)), sizes), np.concatenate(own["terms"].tolist()), np.concatenate(own["weights"].tolist()), len(own), len(model.idf))
        x[a : a + p.rows] = _logit(votes(*nearest(q, model, copies=False), model))
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        prob = 1 / (1 + np.exp(-(slope * x + shift)))
        off, w = prob - target, np.maximum(prob * (1 - prob), 1e-6)
        grad = np.array([(off * x).sum() + 1e-3 * slope, off.sum()])
        hess = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-8:
            break
    return replace(model, slope=slope, shift=shift) if slope > 0 else model


def score_texts(texts: list[str | None], model: ToxModel) -> tuple[np.ndarray, list[np.ndarray]]:
    """Score and the keys of the neighbours of each text: the calibrated vote."""
    p = model.params
    doc, term, w = vectors(texts, model.term_of, model.idf, p)
    scores, evidence = np.full(len(texts), model.empty_rate), [np.zeros(0, np.int64)] * len(texts)
    if not len(model.labels):
        return np.clip(scores, 0, 1), evidence
    some = np.unique(doc)
    for a in range(0, len(some), p.rows):
        own = some[a : a + p.rows]
        lo, hi = np.searchsorted(doc, [own[0], own[-1] + 1])
        top, sims = nearest(dense(np.searchsorted(own, doc[lo:hi]), term[lo:hi], w[lo:hi], len(own), len(model.idf)), model)
        scores[own] = 1 / (1 + np.exp(-(model.slope * _logit(votes(top, sims, model)) + model.shift)))
        for i, t, s in zip(own.tolist(), top, sims):
            evidence[i] = model.ids[t[s > 0]]
    return np.clip(scores, 0, 1), evidence


def score(docs: DataFrame, model: ToxModel, text: str = "text", score_out: str = "toxicity", evidence_out: str = "evidence") -> DataFrame:
    """docs with score_out (0 to 1, higher: likelier toxic) and evidence_out (keys of the nearest labelled rows).

    Whole texts are read. Null texts, empty ones and those without any term get the rate of such examples and no
    evidence. Columns named like the outputs are replaced, others pass through.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(score_out, T.DoubleType()), T.StructField(evidence_out, T.ArrayType(T.LongType()))]
    return map_texts(docs, [text], fields, lambda: lambda texts: score_texts(texts, held.value))


def labelled_sample(docs: DataFrame, labels: DataFrame, params: ToxParams = ToxParams(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """key, text, label of a bounded sample of labels (about params.max_examples rows, chosen by a hash of the key); written once, as fitting reads
    it twice. A key with several labels has the largest; documents that repeat a key all get it."""
    chosen = bounded_sample(labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter("key IS NOT NULL AND label IS NOT NULL").groupBy("key").agg(F.max("label").alias("label")), F.col("key").cast("string"), params.max_examples)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    return stored(rows.select(F.col("key").alias(key), F.col("text").alias(text), F.col("label").alias(label)), "examples")
