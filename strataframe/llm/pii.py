"""Personal data: pattern matches plus spans that a skip-chain conditional random field adds.

Nodes are whole entities or what may be one: the pattern matches and, between them, runs of digit groups and what
looks like an address with an at sign or word. Neighbouring nodes share a chain potential. Nodes with equal or similar
contents (the same digits, digits that end alike, one digit apart, the same address or local part) share a skip
potential, each with the nearest one before it, so that occurrences are tied to each other by paths. Loopy
sum-product messages run over all texts of a batch at once (the graphs are disjoint); pattern matches are evidence
that stays, and nodes outside them whose marginal for one kind reaches the threshold become spans.

The weights are fitted on a bounded sample by pseudo-likelihood. The patterns' own labels would teach the model to copy
the patterns, so a share of the matches is repeated in a form that their pattern misses (other separators, no
plus sign, a digit changed, an at word) with the label kept: the graph must recover these. Nodes that are tied to a match but
are none themselves are not taken as negatives.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.batches import bound_batches, map_texts
from strataframe.llm.langid import bounded_sample

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can start inside a run of digits, and no part of a match is given back: each pattern reads its text once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SOME = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[0-9]+")
#: What may be an address: an at sign or word between names; and a run of digit groups, one separator (and brackets) apart.
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]++(?:@| ?[\[(]at[\])] ?| at )[A-Za-z0-9-]+(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]+)*|[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]*")
NUMBER = re.compile(r"(?<![A-Za-z0-9])\+?\(?[0-9]++(?:(?:\)[ ./-]?|[ .,:/_-]| ?\()[0-9]++)*+(?![A-Za-z0-9])")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Pattern matches, leftmost and without overlap in each kind, by kind and start; failing matches are dropped."""
    out: list[Span] = []
    if not SOME.search(text):
        return out
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                out.append(("email", start, m.end()))
                done = m.end()
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(len, DIGITS.findall(m.group()))) <= 15:
                out.append(("phone", *m.span()))
    return out


def show(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@dataclass(frozen=True)
class CrfParams:
    """threshold: least marginal of an added span. rounds, damping: of the message passing. masked: share of the matches
    that training repeats in a form their pattern misses. penalty: of squared weights, but for the skip weight, against one example. steps: of the fit. max_train_rows:
    bound of the sample of texts that the weights are fitted on (expected value)."""

    threshold: float = 0.8
    rounds: int = 12
    damping: float = 0.3
    masked: float = 0.5
    penalty: float = 0.05
    steps: int = 600
    max_train_rows: int = 20_000


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    label: int  # by the base spans: 0 none, 1 + kind
    shown: str
    before: str  # the words around, lower case
    after: str


WORD_BEFORE, WORD_AFTER = re.compile(r"([^\W\d_]+)[\W_]*$"), re.compile(r"[\W_]*([^\W\d_]+)")


def nodes(text: str, spans: list[Span]) -> list[Node]:
    """The pattern matches and the candidates between them, by start. Words are looked for within 40 characters."""
    out = [(a, b, 1 + KINDS.index(k)) for k, a, b in spans]
    gaps, at = [], 0
    for a, b, _ in sorted(out):
        if a > at:
            gaps.append((at, a))
        at = max(at, b)
    gaps.append((at, len(text)))
    for low, high in gaps:
        free = low
        found = [m.span() for m in ADDRESS.finditer(text, low, high) if len(m.group().strip("@.-_%+")) > 1] if "@" in text or "at" in text else []
        for a, b in [*found, (high, high)]:
            out += [(x, y, 0) for x, y in (m.span() for m in NUMBER.finditer(text, free, a)) if sum(map(str.isdigit, text[x:y])) >= 4]
            if a < b:
                out.append((a, b, 0))
            free = b
    made = []
    for a, b, y in sorted(out):
        left, right = WORD_BEFORE.search(text[max(a - 40, 0) : a]), WORD_AFTER.match(text[b : b + 40])
        made.append(Node(a, b, y, text[a:b], left[1].lower() if left else "", right[1].lower() if right else ""))
    return made


def is_address(shown: str) -> bool:
    return any(c.isalpha() for c in shown) or "@" in shown


def address(shown: str) -> str:
    """An address with signs for words, lower case."""
    low = re.sub(r" ?[\[(]at[\])] ?| at ", "@", shown.lower())
    return re.sub(r" ?[\[(]dot[\])] ?| dot ", ".", low).strip(".-_%+")


def keys(shown: str) -> list[tuple]:
    """What a node has in common with similar ones; keys that begin with 'half' call for a comparison."""
    if is_address(shown):
        whole = address(shown)
        return [("address", whole), *([("local", whole.split("@")[0])] if len(whole.split("@")[0]) > 3 else [])]
    digits = "".join(DIGITS.findall(shown))
    out: list[tuple] = [("digits", digits)]
    if len(digits) >= 7:
        out += [("tail", digits[-7:]), ("half", len(digits), 0, digits[: len(digits) // 2]), ("half", len(digits), 1, digits[len(digits) // 2 :])]
    return out


def graph(own: list[Node], at: int = 0) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges and skip edges over nodes numbered from `at`: each node and, for each key, the nearest one before it that has it."""
    chain = [(at + i, at + i + 1) for i in range(len(own) - 1)]
    seen: dict[tuple, int] = {}
    skip = set()
    for i, node in enumerate(own):
        for key in keys(node.shown):
            if key in seen and (key[0] != "half" or _digits_apart(own[seen[key]].shown, node.shown) <= 1):
                skip.add((at + seen[key], at + i))
            seen[key] = i
    return chain, sorted(skip)


def _digits_apart(a: str, b: str) -> int:
    return sum(x != y for x, y in zip("".join(DIGITS.findall(a)), "".join(DIGITS.findall(b))))


def features(node: Node) -> list[str]:
    """Indicators of what a node looks like and of the words around it, one of each family."""
    shown = node.shown
    words = [f"before {node.before}", f"after {node.after}"]
    if is_address(shown):
        whole = address(shown)
        local, _, domain = whole.partition("@")
        return ["address", f"at {'@' in shown} {bool(local)} {bool(domain)}", f"dots {min(domain.count('.'), 3)}", "no groups", "no check", *words]
    groups = [len(x) for x in DIGITS.findall(shown)]
    n = sum(groups)
    digits = "".join(DIGITS.findall(shown))
    check = "luhn" if 13 <= n <= 19 and luhn(digits) else "bytes" if len(groups) == 4 and all(int(x) <= 255 for x in DIGITS.findall(shown)) else "none"
    shape = "-".join(map(str, groups)) if len(groups) <= 8 else "many"
    return ["number", f"n {min(n, 25)}", f"between {''.join(sorted(set(re.sub('[0-9]', '', shown[1:]))))}", f"groups {shape}", f"check {check}", *words]


def missed_form(kind: str, shown: str, rng: random.Random) -> str:
    """The entity as its pattern does not find it."""
    digits = "".join(DIGITS.findall(shown))
    if kind == "email":
        return shown.replace("@", rng.choice([" at ", " (at) ", "[at]"])) if rng.random() < 0.7 else shown.rsplit(".", shown.rsplit("@")[-1].count("."))[0]
    if kind == "ip":
        return rng.choice("-_:, ").join(DIGITS.findall(shown))
    if kind == "card":
        if rng.random() < 0.3:
            k = rng.randrange(len(digits))
            return digits[:k] + str((int(digits[k]) + 1 + rng.randrange(8)) % 10) + digits[k + 1 :]
        return rng.choice("._/").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    bare = shown.lstrip("+")
    local = digits[-10:]
    return rng.choice([bare, local, *(c.join([local[:-7], local[-7:-4], local[-4:]]) for c in "-. /"), f"({local[:-7]}) {local[-7:-4]}-{local[-4:]}"]) if len(digits) >= 10 else bare


@dataclass(frozen=True)
class CrfModel:
    weights: dict[str, np.ndarray]  # feature -> score of each label
    chain: np.ndarray  # [label of the one before, label]
    skip: float
    params: CrfParams


def examples(text: str, params: CrfParams) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """(features, label, labels of the chain neighbours as one number or -1 where there are none, skip neighbours by label) of the nodes of a text that teach something."""
    own = nodes(text, base_spans(text))
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    real = len(own)
    for node in own[:real]:
        if node.label and rng.random() < params.masked:
            far = rng.random() < 0.5  # with other words around it
            own.append(Node(-1, -1, node.label, missed_form(KINDS[node.label - 1], node.shown, rng), "" if far else node.before, "" if far else node.after))
            if rng.random() < 0.5:  # and one with no match to lean on: its digits are others
                other = "".join(str(rng.randrange(10)) if c.isdigit() else c for c in own[-1].shown)
                own.append(Node(-1, -1, node.label, other, own[-1].before, own[-1].after))
    _, skip = graph(own)
    near = np.zeros((len(own), 5), int)
    for i, j in skip:
        near[i, own[j].label] += 1
        near[j, own[i].label] += 1
    out = []
    for i, node in enumerate(own):
        copy = i >= real
        if not copy and (node.label or near[i, 1:].any()):
            continue
        left = own[i - 1].label if not copy and i else -1
        right = own[i + 1].label if not copy and i + 1 < real else -1
        out.append(("\x1f".join(features(node)), node.label, (left + 1) * 6 + right + 1, tuple(near[i])))
    return out


def fit(docs: DataFrame, params: CrfParams = CrfParams(), key: str = "doc_id", text: str = "text") -> CrfModel:
    """Fits the weights on a bounded sample of texts; distinct examples and their counts are what reaches the driver."""
    bound_batches(docs.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total: Counter = Counter()
            for t in frame["text"]:
                if t and SOME.search(t):
                    total.update(examples(t, params))
            yield pd.DataFrame([(f, y, c, list(map(int, n)), k) for (f, y, c, n), k in total.items()], columns=["f", "y", "c", "near", "k"])

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")
    rows = bounded_sample(rows, F.col("key"), params.max_train_rows)
    got = rows.mapInPandas(count, "f string, y int, c int, near array<int>, k long").groupBy("f", "y", "c", "near").agg(F.sum("k").alias("k"))
    return fit_weights(got.toPandas().sort_values(["f", "y", "c"], kind="stable"), params)


def fit_weights(rows: pd.DataFrame, params: CrfParams) -> CrfModel:
    """Maximises the penalised pseudo-likelihood of the labels, given those of the neighbours, by gradient steps."""
    if not len(rows):
        return CrfModel({}, np.zeros((5, 5)), 0.0, params)
    parts = [f.split("\x1f") for f in rows["f"]]
    seen = Counter()
    for p, k in zip(parts, rows["k"]):
        seen.update({f: int(k) for f in p})
    names = sorted(f for f, k in seen.items() if k > 1)  # what was seen once says nothing
    number = {f: i + 1 for i, f in enumerate(names)}  # 0: features that are not known
    at = np.array([[number.get(f, 0) for f in p] for p in parts])
    y, k = rows["y"].to_numpy(np.int64), rows["k"].to_numpy(np.float64)
    near = np.array(rows["near"].tolist(), np.float64)
    left, right = np.divmod(rows["c"].to_numpy(np.int64), 6)
    k = k / k.sum()
    one = np.eye(5)[y]
    # chain[0], back[0]: no neighbour
    w, chain, back, skip = np.zeros((len(names) + 1, 5)), np.zeros((6, 5)), np.zeros((6, 5)), np.zeros(1)
    state, square = ([np.zeros_like(x) for x in (w, chain, back, skip)] for _ in range(2))
    for step in range(1, params.steps + 1):
        score = w[at].sum(axis=1) + chain[left] + back[right] + skip[0] * near
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        off = (p - one) * k[:, None]
        grads = [np.zeros_like(w), np.zeros_like(chain), np.zeros_like(back), np.array([(off * near).sum()])]
        for c in range(at.shape[1]):
            np.add.at(grads[0], at[:, c], off)
        np.add.at(grads[1], left, off)
        np.add.at(grads[2], right, off)
        for j, (v, g) in enumerate(zip((w, chain, back, skip), grads)):
            if j < 3:
                g = g + params.penalty / len(rows) * v
                g[0] = 0  # what is unknown, or no neighbour, adds nothing
            state[j] = 0.9 * state[j] + 0.1 * g
            square[j] = 0.99 * square[j] + 0.01 * g * g
            v -= 0.1 * (state[j] / (1 - 0.9**step)) / (np.sqrt(square[j] / (1 - 0.99**step)) + 1e-8)
    # one matrix for both ends of a chain edge; its rows are the labels of the one before
    both = (chain[1:] + back[1:].T) / 2
    return CrfModel({f: w[i] for f, i in number.items()}, both, float(max(skip[0], 0.0)), params)


def unary(node: Node, model: CrfModel) -> np.ndarray:
    if node.label:  # a pattern match is evidence that stays
        out = np.full(5, -50.0)
        out[node.label] = 0
        return out
    out = np.zeros(5)
    for f in features(node):
        if f in model.weights:
            out = out + model.weights[f]
    return out


def marginals(local: np.ndarray, chain: np.ndarray, skip: np.ndarray, model: CrfModel) -> np.ndarray:
    """Sum-product messages along both directions of every edge, damped, all at once."""
    n, labels = local.shape
    if not n:
        return local
    ends = np.concatenate([chain, skip]).reshape(-1, 2)
    src, dst = np.r_[ends[:, 0], ends[:, 1]], np.r_[ends[:, 1], ends[:, 0]]
    e = len(ends)
    same = model.skip * np.eye(labels)
    pots = np.concatenate([np.broadcast_to(model.chain, (len(chain), labels, labels)), np.broadcast_to(same, (len(skip), labels, labels))])
    pots = np.concatenate([pots, pots.transpose(0, 2, 1)])
    mirror = np.r_[np.arange(e, 2 * e), np.arange(e)]
    sent = np.zeros((2 * e, labels))
    for _ in range(model.params.rounds if e else 0):
        belief = local.copy()
        np.add.at(belief, dst, sent)
        out = belief[src] - sent[mirror]
        new = np.logaddexp.reduce(out[:, :, None] + pots, axis=1)
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        sent = model.params.damping * sent + (1 - model.params.damping) * new
    belief = local.copy()
    np.add.at(belief, dst, sent)
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief)


def scan(texts: list[str], model: CrfModel) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, both by kind and start."""
    base = [base_spans(t) for t in texts]
    found, local, chain, skip, owners = [], [], [], [], []
    for i, t in enumerate(texts):
        if not SOME.search(t):
            continue
        own = nodes(t, base[i])
        c, s = graph(own, len(found))
        chain += c
        skip += s
        local += [unary(node, model) for node in own]
        found += own
        owners += [i] * len(own)
    got = [(b, b) for b in base]
    if not found or not model.weights:
        return got
    p = marginals(np.array(local), np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2), model)
    more: dict[int, list[Span]] = {}
    for k in np.flatnonzero(p[:, 1:].max(axis=1) >= model.params.threshold).tolist():
        node = found[k]
        if not node.label:
            more.setdefault(owners[k], []).append((KINDS[int(p[k, 1:].argmax())], node.start, node.end))
    for i, new in more.items():
        got[i] = (base[i], sorted(base[i] + merged(texts[i], new), key=lambda x: (KINDS.index(x[0]), x[1])))
    return got


def merged(text: str, spans: list[Span]) -> list[Span]:
    """Spans of one kind that stand a separator or two apart and have no more digits together than one may have are one."""
    out: list[Span] = []
    for kind, a, b in sorted(spans, key=lambda x: (x[0], x[1])):
        if out and out[-1][0] == kind in ("card", "phone"):
            _, x, y = out[-1]
            if a - y <= 2 and not text[y:a].strip(" ().-/") and sum(map(str.isdigit, text[x:b])) <= (19 if kind == "card" else 15):
                out[-1] = (kind, x, b)
                continue
        out.append((kind, a, b))
    return out


def find_pii(docs: DataFrame, model: CrfModel, text: str = "text", base_out: str = "base_spans", spans_out: str = "pii_spans") -> DataFrame:
    """docs with base_out and spans_out: arrays of (kind, start, end), code points, end exclusive, by kind then start.

    base_out holds pattern matches, spans_out those and what the model adds outside them. Whole texts are read;
    null counts as empty and has no span. Columns named like the outputs are replaced, others pass through.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

    def start():
        def run(texts: list[str | None]) -> list[list]:
            got = scan([t or "" for t in texts], held.value)
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in spans[i]] for spans in got] for i in (0, 1)]

        return run

    return map_texts(docs, [text], [T.StructField(base_out, span), T.StructField(spans_out, span)], start)

