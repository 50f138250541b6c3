"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (languages x 2**bits, a bound fixed by parameters and the number of languages) is
broadcast; batches are scored in numpy: one gather per n-gram and language, then sums per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.batches import bound_batches, letter_codes, map_texts, ngram_buckets, slabs

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangParams:
    """orders: n-gram lengths. bits: hash buckets per length, as a power of 2. alpha: smoothing.
    max_train_rows: bound of the sample of labelled rows that the counts come from (expected value)."""

    orders: tuple[int, ...] = (2, 3)
    bits: int = 16
    alpha: float = 0.5
    max_train_rows: int = 20_000


@dataclass(frozen=True)
class LangModel:
    langs: list[str]
    prior: np.ndarray
    log_prob: np.ndarray  # [language, order * 2**bits + bucket]
    params: LangParams


def _bucket_codes(texts: list[str | None], p: LangParams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    codes, starts = letter_codes(texts, max(p.orders))
    for k, n in enumerate(p.orders):
        h = ngram_buckets(codes, n, p.bits) + np.uint32(k << p.bits)
        some = codes != 0
        for j in range(1, n):
            some[: len(codes) - j] |= codes[j:] != 0
        yield h, some, starts


def bounded_sample(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About bound rows at most, chosen by a hash of key alone, so alike at every partitioning."""
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(int((1 << 40) * (bound / n))))


def fit(rows: DataFrame, params: LangParams = LangParams(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> LangModel:
    """Counts n-grams per language over a bounded sample of rows whose language and text are not null."""
    bound_batches(rows.sparkSession)
    rows = rows.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    size = len(params.orders) << params.bits

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for frame in frames:
            for part in slabs(frame):
                for name, own in part.groupby("lang", sort=False):
                    total = totals.setdefault(name, np.zeros(size, np.int64))
                    docs[name] = docs.get(name, 0) + len(own)
                    for h, some, _ in _bucket_codes(own["text"].tolist(), params):
                        total += np.bincount(h[some], minlength=size)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": np.r_[at, -1], "n": np.r_[total[at], docs[name]]})

    got = bounded_sample(rows, F.col("key"), params.max_train_rows).mapInPandas(count, "lang string, bucket long, n long")
    got = got.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    counts, docs = np.zeros((len(langs), size)), np.zeros(len(langs))
    for i, name in enumerate(langs):
        own = got[got["lang"] == name]
        inside = own["bucket"].to_numpy() >= 0
        counts[i, own["bucket"].to_numpy()[inside]] = own["n"].to_numpy()[inside]
        docs[i] = own["n"].to_numpy()[~inside].sum()
    log_prob = np.log(counts + params.alpha)
    for k in range(len(params.orders)):
        part = slice(k << params.bits, (k + 1) << params.bits)
        log_prob[:, part] -= np.log((counts[:, part] + params.alpha).sum(axis=1, keepdims=True))
    prior = np.log(np.maximum(docs, 1) / max(docs.sum(), 1))
    return LangModel(langs, prior, log_prob.astype(np.float32), params)


def predict_texts(texts: list[str | None], model: LangModel) -> tuple[np.ndarray, np.ndarray]:
    """(language, posterior) of each text; und and 0 where there is no letter or nothing was learned."""
    total = np.tile(model.prior, (len(texts), 1))
    found = np.zeros(len(texts), bool)
    for h, some, starts in _bucket_codes(texts, model.params):
        found |= np.logical_or.reduceat(some, starts)
        for i in range(len(model.langs)):
            total[:, i] += np.add.reduceat(np.where(some, model.log_prob[i][h], np.float32(0)), starts, dtype=np.float64)
    if not model.langs:
        return np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
    top = total.max(axis=1, keepdims=True)
    score = 1 / np.exp(total - top).sum(axis=1)
    best = np.array(model.langs, object)[total.argmax(axis=1)]
    return np.where(found, best, UNDETERMINED), np.where(found, score, 0.0)


def identify(docs: DataFrame, model: LangModel, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with lang_out (a learned language, or und where text is null or has no letter) and score_out (posterior, 0 to 1).

    Rows map one to one; other columns pass through, whatever their names, except that columns already called
    lang_out or score_out are replaced. Whole texts are read; an empty table gives an empty one; ties go to the
    language that sorts first.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    return map_texts(docs, [text], fields, lambda: lambda texts: predict_texts(texts, held.value))
