r"""Secret scanning: patterns, and a randomness test battery under false-discovery control, with DataFrame functions only.

Tokens get an encoding (decimal, hex, base32, letters, base64) by the characters they use. Tests ask
whether a token looks drawn at random from that alphabet: chi-squared for uniform characters and for the kinds of characters,
runs above and below the alphabet's middle, lag-one serial correlation. Fisher's method joins them to a discrepancy, which grows with
length for ordinary text. How large it is for ordinary text of a length is measured on the corpus's own words: all
distinct words, joined to long strings and cut to several lengths, in each alphabet (for hex, the letters a to f that are left
of them). Tokens of letters are compared by how much likelier their letter pairs are in the corpus's words than
by chance, numbers with the corpus's numbers. A token's p-value is the chance that ordinary text of its length looks as random, and
the Benjamini-Hochberg rule sets the cut, over the tokens of letters and over all others.

How short a token can be follows from that: below some length even a discrepancy of 0 has a p-value above the false-discovery
rate, so that no token could pass, and none is tested. Tokens of letters alone are words, and tested from least_letters on.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.storage import checkpointed, stored

KINDS = ("assign", "access", "hex")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: Token characters. '=' is padding where no token character follows; elsewhere it parts a name from its value.
_C = "[A-Za-z0-9+/_-]"
#: Tokens of letters of so many characters, and others (with a digit, a sign, or a capital after the first letter).
TOKEN = r"(?<!%(c)s)(?:(?=[A-Za-z]*+[0-9+/_-]|[A-Z]*+[a-z]++[A-Z]|[A-Z]{2,}+[a-z])%(c)s{%(others)d,}+|%(c)s{%(letters)d,}+)(?:={1,2}+(?!%(c)s))?"
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: The alphabets in their code order.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "letters": "abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


@dataclass(frozen=True)
class SecretParams:
    """fdr: false-discovery rate of the added spans. random_p: least p-value under randomness. least_reference: strings
    of joined words (or numbers) that a length needs to be a reference. least_letters: characters of the shortest token of
    letters alone that is tested. words_joined: words of a string."""

    fdr: float = 0.01
    random_p: float = 0.01
    least_reference: int = 30
    least_letters: int = 16
    words_joined: int = 32


#: Lengths at which ordinary text is measured; between them figures are interpolated.
LENGTHS = (6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64, 96)
BLOCK, LEAST_SD = 512, 0.05


def located(text: Column, pattern: str, some: Column) -> Column:
    """Array of (start, end, hit) of the matches of pattern in text, code points; empty where not some. Positions are summed in
    blocks of matches, so that a long text costs little more for each."""
    kind = "array<struct<start:long,end:long,hit:string>>"
    none = F.array().cast(kind)
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
        F.array_append(acc["out"], F.struct((acc["at"] + F.length(x["gap"])).alias("start"), (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"))).alias("out"),
    )
    size = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda n, x: n + F.length(x["gap"]) + F.length(x["hit"]))
    upto = lambda blocks: F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + size(x)))
    inside = lambda blocks: F.zip_with(blocks, F.slice(upto(blocks), F.lit(1), F.size(blocks)), lambda x, at: F.aggregate(x, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"]))
    split = lambda pairs: F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")), lambda b: F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK)))
    found = let(F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap")), lambda pairs: F.when(F.size(pairs) > 0, let(split(pairs), lambda x: F.flatten(inside(x)))).otherwise(none))
    return F.when(some, found.cast(kind)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the pattern matches, sorted."""
    low = F.lower(text)
    worded = F.lit(False)
    for w in WORDS:
        worded = worded | low.contains(w)
    found = [
        F.filter(located(text, ASSIGN, worded), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 8),
        F.filter(located(text, ACCESS, text.contains("AKIA")), lambda x: F.length(x["hit"]) >= 16),
        located(text, HEX, text.rlike(HEX)),
    ]
    return F.array_sort(F.concat(*(_kind(f, k) for k, f in enumerate(found))))


def _kind(spans: Column, number: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _upper(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17), within 1e-7."""

    def tail(v: Column) -> Column:
        poly = lambda t: t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-v * v / 2) / 2.5066282746310002 * let(1 / (1 + 0.2316419 * F.abs(v)), poly)

    return let(z, lambda v: F.greatest(let(tail(v), lambda p: F.when(v >= 0, p).otherwise(1 - p)), F.lit(1e-300)))


def encoding(token: Column) -> Column:
    core = F.rtrim(token, F.lit("="))
    return (
        F.when(core.rlike("^[0-9]+$"), "decimal").when(core.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(core.rlike("^[A-Z2-7]+$") & core.rlike("[2-7]"), "base32")
        .when(core.rlike("^([a-z]+|[A-Z]+|[A-Z][a-z]+)$"), "letters").otherwise("base64")
    )


def plain_words(texts: DataFrame) -> DataFrame:
    """(w, c): the distinct words of letters of all texts, of 2 to 15 letters, with their numbers."""
    words = F.regexp_extract_all("text", F.lit(f"(?<!{_C})[A-Za-z]{{2,15}}+(?!{_C})"), F.lit(0))
    return stored(texts.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("c")), "words")


def letter_pairs(words: DataFrame) -> list[float]:
    """By 26 x first + second letter: the logarithm of how much likelier the pair is in words than by chance."""
    low = words.select(F.lower("w").alias("w"), "c")
    pairs = low.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.col("w").substr(i, F.lit(2)))).alias("pair"), "c")
    # at most 676 rows, whatever the input
    seen = {r["pair"]: r["c"] for r in pairs.groupBy("pair").agg(F.sum("c").alias("c")).collect()}
    letters = ALPHABETS["letters"]
    first = {a: sum(seen.get(a + b, 0) for b in letters) for a in letters}
    return [math.log(26 * (seen.get(a + b, 0) + 1) / (first[a] + 26)) for a in letters for b in letters]


def compared(code: Column, b: Column) -> Column:
    """What is compared with ordinary text, nearly normal for it; the less, the more random."""
    return F.when(code == "letters", b["wordlike"]).otherwise(F.log1p(b["discrepancy"]))


def reference(words: DataFrame, p: SecretParams) -> DataFrame:
    """n, code, s: strings of all words, joined in the order of a hash; each is there for every length that is asked and in every encoding."""
    bucket = F.pmod(F.xxhash64("w"), F.lit(max(1, words.count() // (64 * p.words_joined))))
    rank = F.row_number().over(W.partitionBy("bucket").orderBy(F.xxhash64("w", F.lit(1)), "w"))
    dealt = words.select("w", bucket.alias("bucket")).select("w", "bucket", rank.alias("rank")).withColumn("part", F.floor((F.col("rank") - 1) / p.words_joined))
    joined = dealt.groupBy("bucket", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "w"))), lambda x: x["w"]), "").alias("s"))
    forms = {"base64": F.col("s"), "letters": F.lower("s"), "base32": F.upper("s"), "hex": F.regexp_replace(F.lower("s"), "[^a-f]", "")}
    return joined.select(F.explode(F.array(*map(F.lit, LENGTHS))).alias("n"), F.array(*(F.struct(F.lit(k).alias("code"), v.alias("s")) for k, v in forms.items())).alias("forms")).select("n", F.inline("forms"))


def ordinary(words: DataFrame, pairs: list[float], p: SecretParams) -> dict[str, list[tuple[int, float, float]]]:
    """By encoding the (length, mean, standard deviation) of what is compared, over the reference strings of all words."""
    cut = reference(words, p)
    cut = cut.filter(F.length("s") >= F.col("n")).select("n", "code", battery(F.substring("s", F.lit(1), F.col("n")), pairs, F.col("code")).alias("b"))
    value = compared(F.col("code"), F.col("b"))
    # at most four encodings of as many rows as there are lengths
    rows = cut.groupBy("code", "n").agg(F.count("*").alias("k"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd")).filter(F.col("k") >= p.least_reference).collect()
    out: dict[str, list[tuple[int, float, float]]] = {}
    for r in sorted(rows, key=lambda r: r["n"]):
        out.setdefault(r["code"], []).append((r["n"], r["mean"], max(r["sd"], LEAST_SD)))
    return out


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def least_length(of: dict[str, list[tuple[int, float, float]]], p: SecretParams) -> int:
    """Of tokens that are not of letters alone: the least length at which a discrepancy of 0 could pass."""
    reachable = [n for code, rows in of.items() if code != "letters" for n, mean, sd in rows if upper_tail(mean / sd) <= p.fdr]
    below = max([n for n in LENGTHS if reachable and n < min(reachable)], default=LENGTHS[0] - 1)
    return below + 1


def battery(token: Column, pairs: list[float] | None = None, code: Column | None = None) -> Column:
    """struct(encoding, n, discrepancy, wordlike, p_random): the tests of one token joined by Fisher's method.

    The encoding is inferred where code is not given. wordlike is the mean of pairs over the token's letter pairs, 0 for other tokens; p_random counts it as a fourth test.
    """
    likely = F.from_json(F.lit(json.dumps(pairs or [0.0] * 676)), "array<double>")
    zero = F.struct(*(F.lit(-1.0 if k in ("prev", "first") else 0.0).alias(k) for k in ("prev", "first", "sx", "sxx", "sxy", "runs", "high")))

    def read(t: Column) -> Column:
        core = F.rtrim(t["token"], F.lit("="))
        text = F.when(t["code"].isin("hex", "letters"), F.lower(core)).otherwise(F.translate(core, "-_", "+/"))
        return F.struct(t["code"].alias("code"), F.coalesce(*(F.when(t["code"] == k, F.lit(v)) for k, v in ALPHABETS.items())).alias("alphabet"), F.filter(F.split(text, ""), lambda c: c != "").alias("chars"))

    def measure(t: Column) -> Column:
        middle = (F.length(t["alphabet"]) - 1) / 2
        bit = lambda v: (v > middle).cast("double")
        step = lambda acc, v: F.struct(
            v.alias("prev"), F.when(acc["first"] >= 0, acc["first"]).otherwise(v).alias("first"), (acc["sx"] + v).alias("sx"), (acc["sxx"] + v * v).alias("sxx"), (acc["sxy"] + F.when(acc["prev"] >= 0, acc["prev"] * v).otherwise(0.0)).alias("sxy"),
            (acc["runs"] + F.when((acc["prev"] >= 0) & (bit(acc["prev"]) == bit(v)), 0.0).otherwise(1.0)).alias("runs"), (acc["high"] + bit(v)).alias("high"),
        )
        values = F.transform(t["chars"], lambda c: (F.instr(t["alphabet"], c) - 1).cast("double"))
        count = lambda c: F.size(F.filter(t["chars"], lambda d: d == c)).cast("double")
        squares = F.aggregate(F.array_distinct(t["chars"]), F.lit(0.0), lambda acc, c: acc + F.pow(count(c), 2))
        at = lambda k: F.instr(t["alphabet"], F.element_at(t["chars"], k)) - 1
        pair = F.aggregate(F.sequence(F.lit(2), F.size(t["chars"])), F.lit(0.0), lambda acc, i: acc + F.element_at(likely, at(i - 1) * 26 + at(i) + 1))
        # kinds of characters: capitals, small letters, digits and signs, as far as the alphabet has them
        ends = F.when(t["code"] == "base64", F.array(*map(F.lit, (26, 52, 64)))).when(t["code"] == "base32", F.array(*map(F.lit, (26, 32)))).when(t["code"] == "hex", F.array(*map(F.lit, (10, 16)))).otherwise(F.array(F.length(t["alphabet"])))
        kinds = lambda values: let(ends, lambda e: F.transform(e, lambda end, i: let(F.when(i > 0, F.element_at(e, F.greatest(i, F.lit(1)))).otherwise(0), lambda begin: F.pow(F.size(F.filter(values, lambda v: (v >= begin) & (v < end))).cast("double"), 2) * F.length(t["alphabet"]) / (end - begin))))
        more = F.when((t["code"] == "letters") & (F.size(t["chars"]) >= 2), pair).otherwise(0.0)
        return F.struct(t["code"].alias("code"), F.length(t["alphabet"]).cast("double").alias("size"), F.size(t["chars"]).cast("double").alias("n"), squares.alias("squares"), more.alias("pair"), let(values, lambda v: F.struct(kinds(v).alias("kinds"), F.aggregate(v, zero, step).alias("s"))).alias("v"))

    def scores(t: Column) -> Column:
        n, s, kinds = t["n"], t["v"]["s"], t["v"]["kinds"]
        z_of = lambda chi, df: (F.pow(F.greatest(chi, F.lit(0.0)) / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        z_chi = z_of(t["squares"] * t["size"] / n - n, t["size"] - 1)
        kinds_df = (F.size(kinds) - 1).cast("double")
        z_kinds = z_of(F.aggregate(kinds, F.lit(0.0), lambda a, x: a + x) / n - n, F.greatest(kinds_df, F.lit(1.0)))
        by_kind = F.when(kinds_df > 0, -F.ln(_upper(z_kinds))).otherwise(0.0)
        runs = let(2 * s["high"] * (n - s["high"]) / n + 1, lambda mean: (s["runs"] - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.25))))
        # the last character is followed by the first, so that the level of the values does not count
        circle = s["sxy"] + s["prev"] * s["first"] - s["sx"] * s["sx"] / n
        serial = (circle / F.greatest(s["sxx"] - s["sx"] * s["sx"] / n, F.lit(1e-9)) + 1 / F.greatest(n - 1, F.lit(1.0))) * F.sqrt(n)
        two = lambda z: -F.ln(F.least(2 * _upper(F.abs(z)), F.lit(1.0)))
        return F.struct(t["code"].alias("code"), n.alias("n"), t["pair"].alias("pair"), (kinds_df > 0).alias("four"), (-F.ln(_upper(z_chi)) + by_kind + two(runs) + two(serial)).alias("half"))

    def joined(t: Column) -> Column:
        half, whole = t["half"], t["half"] + F.greatest(t["pair"], F.lit(0.0))
        # a likelihood ratio of e^x or more has by chance a probability of e^-x at most: x joins the sum as it is
        four = F.when((t["code"] == "letters") | t["four"], whole * whole * whole / 6).otherwise(0.0)
        p_random = F.exp(-whole) * (1 + whole + whole * whole / 2 + four)
        return F.struct(t["code"].alias("encoding"), t["n"].cast("long").alias("n"), (2 * half).alias("discrepancy"), (t["pair"] / F.greatest(t["n"] - 1, F.lit(1.0))).alias("wordlike"), p_random.alias("p_random"))

    first = F.struct(token.alias("token"), (encoding(token) if code is None else code).alias("code"))
    return let(let(let(let(first, read), measure), scores), joined)


def length_class(n: Column) -> Column:
    return F.least(F.floor(F.log2(n.cast("double")) * 2), F.lit(40)).cast("int")


def interpolated(rows: list[tuple[int, float]], n: Column) -> Column:
    """The figure at n: linear in the logarithm of n between the rows, the nearest one's beyond them; null without rows."""
    if not rows:
        return F.lit(None).cast("double")
    out = F.when(n <= rows[0][0], F.lit(rows[0][1]))
    for (a, x), (b, y) in zip(rows, rows[1:]):
        out = out.when(n <= b, x + (y - x) * (F.log(n.cast("double")) - math.log(a)) / (math.log(b) - math.log(a)))
    return out.otherwise(F.lit(rows[-1][1]))


def find_secrets(docs: DataFrame, params: SecretParams = SecretParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base_spans and spans: arrays of (start, kind, end), sorted; code points, end exclusive; kind is a name.

    base_spans are the pattern matches; spans holds them and, of kind random, the tokens outside them that the battery
    finds. Whole texts are read; null counts as empty. Rows map one to one; other columns are not read. Where the words of
    the texts make fewer than least_reference strings there is nothing to compare with, and no span is added.
    """
    p = params
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), t.alias("text"))
    words = plain_words(rows.select("text"))
    pairs = letter_pairs(words)
    known = ordinary(words, pairs, p)
    pattern = TOKEN % {"c": _C, "others": least_length(known, p), "letters": p.least_letters}
    # let() keeps the optimiser from computing the pattern matches again for every token
    tokens = lambda base: F.filter(located(F.col("text"), pattern, F.col("text").rlike(pattern)), lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    tested = lambda base: F.transform(tokens(base), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), battery(x["hit"], pairs).alias("b")))
    both = let(base_spans(F.col("text")), lambda base: F.struct(base.alias("base"), tested(base).alias("tokens")))
    rows = rows.select("doc_id", both.alias("both")).select("doc_id", "both.base", "both.tokens")
    rows = checkpointed(rows)
    letters = lambda x: x["b"]["encoding"] == "letters"
    x = F.col("x")
    all_tokens = rows.select(F.explode("tokens").alias("x")).select(letters(x).alias("letters"), x["b"].alias("b"))
    # numbers: at most 41 length classes, whatever the input
    numbers = all_tokens.filter("b.encoding = 'decimal'").groupBy(length_class(F.col("b.n")).alias("cls")).agg(F.min("b.n").alias("n"), F.count("*").alias("k"), *(f(F.log1p("b.discrepancy")).alias(k) for f, k in ((F.avg, "mean"), (F.stddev_pop, "sd"))))
    known["decimal"] = sorted((r["n"], r["mean"], max(r["sd"], LEAST_SD)) for r in numbers.filter(F.col("k") >= p.least_reference).collect())

    def p_plain(b: Column) -> Column:
        """The chance that ordinary text of the token's length looks as random; 1 where none is known."""
        out = F.lit(1.0)
        for code, of in known.items():
            value = compared(F.lit(code), b)
            mean, sd = (interpolated([(r[0], r[k]) for r in of], b["n"]) for k in (1, 2))
            out = F.when(b["encoding"] == code, F.coalesce(_upper((mean - value) / sd), F.lit(1.0))).otherwise(out)
        return out

    step = lambda v: F.floor(-F.log10(v) * 20)
    steps = all_tokens.select("letters", step(p_plain(F.col("b"))).alias("step")).groupBy("letters", "step").agg(F.count("*").alias("c"))
    # Benjamini-Hochberg on steps of 1/20 in -log10 p: at most 6,000 of them in either family
    upto = steps.withColumn("k", F.sum("c").over(W.partitionBy("letters").orderBy(F.desc("step")))).withColumn("m", F.sum("c").over(W.partitionBy("letters")))
    passed = upto.filter(F.pow(F.lit(10.0), -F.col("step") / 20.0) <= F.lit(p.fdr) * F.col("k") / F.col("m"))
    cuts = {r["letters"]: r["step"] for r in passed.groupBy("letters").agg(F.min("step").alias("step")).collect()}
    cut = lambda is_letters: F.when(is_letters, F.lit(cuts.get(True)).cast("long")).otherwise(F.lit(cuts.get(False)).cast("long"))
    seems = lambda x: step(p_plain(x["b"]))
    # where nothing passed there is no cut, and the comparison is null
    chosen = F.filter("tokens", lambda x: (x["b"]["p_random"] >= p.random_p) & F.coalesce(seems(x) >= cut(letters(x)), F.lit(False)))
    names = F.array(*map(F.lit, (*KINDS, "random")))
    named = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), F.element_at(names, x["kind"] + 1).alias("kind"), x["end"].alias("end")))
    more = _kind(chosen, len(KINDS))
    return rows.select("doc_id", named(F.col("base")).alias("base_spans"), named(F.array_sort(F.concat("base", more))).alias("spans"))
