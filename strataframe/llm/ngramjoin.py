"""N-gram Jaccard join with token-combination prefixes.

Every text becomes the set of its hashed word n-grams (tokens). Tokens are ordered by class, rare before frequent,
then by hash. If two sets of sizes n and m overlap enough for the threshold, each holds the k least common tokens
among its first n - ceil(t * n) + k. So a pair shares k tokens of these extended prefixes, and either a rare one is
among them or at least two frequent ones are: rare tokens are indexed alone, frequent ones as 2-combinations. A pair
whose shared rare tokens and possible frequent ones stay below k is dropped unseen. A set with very many frequent tokens in its
prefix is indexed by these one by one. What meets in combinations is compared in blocks, by matrix products.

Candidates are verified on whole sets, by other hashes of the n-grams than those that made them candidates: n-grams whose
tokens clash cost a comparison and link nothing. If two of one set clash, the join is done again with another seed. Sets that are equal are one node from the start, and what links to the same
hub is compared no further, so groups of copies cost in proportion to their size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.llm.batches import bound_batches, trim
from strataframe.operators.graph import connected_components
from strataframe.storage import fresh_path, released, stored

RARE, COMBINED, FEW, MANY = range(4)


@dataclass(frozen=True)
class JoinParams:
    """words: n of the n-grams. num, den: link when den * intersection >= num * union. frequent: documents that make a
    token frequent (raised by doubling until at most max_frequent tokens are, the bound of the broadcast).
    max_combined: frequent tokens in a prefix up to which their pairs are indexed. common: k. block_rows, block_tokens: mean
    size, at most, of a block of sets that are compared all with all. class_ratio: between the sizes of the largest and
    the smallest set of a block, where a family has several. id_bits: of the set identifiers. token_bits: of the tokens, as
    long as seed, that of the word hashes, is 0."""

    words: int = 5
    num: int = 80
    den: int = 100
    frequent: int = 64
    max_frequent: int = 1_000_000
    max_combined: int = 40
    common: int = 16
    block_rows: int = 512
    block_tokens: int = 1_000_000
    class_ratio: float = 1.05
    id_bits: int = 64
    token_bits: int = 64
    seed: int = 0

    def least(self, n):
        """Least overlap that a set of n tokens needs."""
        return -(-self.num * n // self.den)


#: Bytes of text that are hashed together, and of a word up to which it has a sum of table entries.
SLAB, SHORT = 1 << 20, 32
MIX = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_TABLES: dict[int, np.ndarray] = {}


def _tables(seed: int) -> np.ndarray:
    """Random numbers for each place in a word and byte there, for two hashes."""
    if seed not in _TABLES:
        _TABLES[seed] = np.random.default_rng([20240101, seed]).integers(0, 1 << 64, (2, SHORT * 256), np.uint64)
    return _TABLES[seed]


def _slabs(data: bytes) -> Iterator[bytes]:
    """data in parts of about SLAB bytes, cut at white space."""
    at = 0
    while at < len(data):
        border = _BLANK.search(data, min(at + SLAB, len(data)))
        end = border.start() if border else len(data)
        yield data[at:end]
        at = end


def word_hashes(data: bytes, seed: int = 0, second: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ends, hashes): for each word of data the byte after it, and one 64-bit hash or two. A-Z count as a-z.

    A word's hash is the sum of the table's numbers for its bytes at their places; a longer one than SHORT has the halves of XXH3.
    """
    places, sums, base = [], [[] for _ in range(1 + second)], 0
    for part in _slabs(data):
        low = part.lower()
        b = np.frombuffer(b"\n" + low + b"\n", np.uint8)
        space = _SPACE[b]
        starts = np.flatnonzero(space[:-1] & ~space[1:])
        ends = np.flatnonzero(~space[:-1] & space[1:])  # both without the first byte
        if len(starts):
            size = (ends - starts).astype(np.int32)
            first = np.cumsum(size, dtype=np.int32) - size
            place = np.arange(int(size.sum()), dtype=np.int32) - np.repeat(first, size)
            at = (np.minimum(place, SHORT - 1) << 8) + b[~space]
            long = np.flatnonzero(size > SHORT).tolist()
            for half, table in zip(sums, _tables(seed)):
                half.append(np.add.reduceat(table[at], first))
            for k in long:
                h = xxhash.xxh3_128_intdigest(low[starts[k] : ends[k]], seed)
                for n, half in enumerate(sums):
                    half[-1][k] = h >> 64 * n & 0xFFFFFFFFFFFFFFFF
            places.append(ends + base)
        base += len(part)
    cat = lambda xs, kind: np.concatenate([np.zeros(0, kind), *xs])
    return cat(places, np.int64), [cat(half, np.uint64) for half in sums]


def _ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of word hashes."""
    out = np.full(max(len(h) - n + 1, 0), n, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(MIX)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def token_sets(texts: list[str | None], p: JoinParams, second: bool = False) -> list[np.ndarray] | list[tuple[np.ndarray, np.ndarray]]:
    """For each text the sorted distinct hashes (int64) of its word n-grams; of a shorter text the whole sequence as one; none without words.

    A-Z count as a-z, words are what stands between ASCII white space. With second, pairs of these and of the n-grams'
    other hashes, which rest on second word hashes.
    """
    out: list = []
    group: list[bytes] = []
    size = 0
    for n, t in enumerate(texts, 1):
        group.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(group[-1])
        if size >= SLAB or n == len(texts):
            out += _some_sets(group, p, second)
            group, size = [], 0
    return out


def _some_sets(data: list[bytes], p: JoinParams, second: bool) -> list:
    ends, hashes = word_hashes(b"\n".join(data), p.seed, second)
    cuts = np.searchsorted(ends, np.cumsum([0, *(len(x) + 1 for x in data)])).tolist()
    few = np.uint64((1 << p.token_bits) - 1 if not p.seed else 0xFFFFFFFFFFFFFFFF)
    sets = []
    for half in range(1 + second):
        mask = few if not half else np.uint64(0xFFFFFFFFFFFFFFFF)
        joined = hashes[half]
        grams = (_ngrams(joined, p.words) & mask).view(np.int64)
        short = lambda a, c, joined=joined, mask=mask: (_ngrams(joined[a:c], c - a) & mask).view(np.int64)
        sets.append([np.unique(grams[a : c - p.words + 1] if c - a >= p.words else short(a, c) if c > a else grams[:0]) for a, c in zip(cuts, cuts[1:])])
    return list(zip(*sets)) if second else sets[0]


def set_id(tokens: np.ndarray, others: np.ndarray, p: JoinParams, clashing: frozenset[int] = frozenset()) -> tuple[int, int]:
    """(identifier, check) of a set, as signed 64-bit numbers: of its tokens and of its n-grams' other hashes. Sets of a
    clashing identifier have one of the other hashes."""
    first = xxhash.xxh3_64_intdigest(tokens.tobytes()) & ((1 << p.id_bits) - 1)
    data = others.tobytes()
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    return signed(xxhash.xxh3_64_intdigest(data, seed=1) if signed(first) in clashing else first), signed(xxhash.xxh64_intdigest(data))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        yield batch.column(0), batch.column(1)


def _two(docs: DataFrame, key: str, text: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"))


def frequent_tokens(docs: DataFrame, p: JoinParams, key: str, text: str) -> np.ndarray:
    """The tokens that p.frequent sets at least hold, as far as a prefix can reach them.

    First the lowest quarter (and 8) of each set's hashes is counted: where it has enough rare tokens, the prefix ends
    there. The sets in which it has not are then counted whole.
    """
    spark = docs.sparkSession

    def counted(part) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, texts in _texts(batches):
                own = [part(s) for s in token_sets(texts.to_pylist(), p)]
                token, n = np.unique(np.concatenate([np.zeros(0, np.int64), *own]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n.astype(np.int32))], names=["token", "n"])
            trim()

        counts = _two(docs, key, text).mapInArrow(count, "token long, n int").groupBy("token").agg(F.sum("n").alias("n"))
        return stored(counts.filter(F.col("n") >= p.frequent), "frequent")

    def bounded(counts: DataFrame) -> np.ndarray:
        least = p.frequent
        while counts.filter(F.col("n") >= least).count() > p.max_frequent:
            least *= 2
        return np.sort(counts.filter(F.col("n") >= least).select("token").toPandas()["token"].to_numpy(np.int64))

    low = lambda s: s[: len(s) // 4 + 8]
    first = bounded(counted(low))
    if not len(first):
        return first
    held = spark.sparkContext.broadcast(first)

    def whole(s: np.ndarray) -> np.ndarray:
        seen = low(s)
        rare = len(seen) - int(np.count_nonzero(_among(seen, held.value)))
        return s if rare < min(len(s), len(s) - p.least(len(s)) + p.common) else s[:0]

    both = np.union1d(first, bounded(counted(whole)))
    released(spark)
    return both


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each token is in the sorted array known."""
    if not len(known):
        return np.zeros(len(tokens), bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, p: JoinParams) -> tuple[np.ndarray, np.ndarray, int]:
    """(index keys, their class, number of frequent tokens in the prefix) of a set."""
    n = len(tokens)
    size = min(n, n - p.least(n) + p.common)
    often = _among(tokens, frequent)
    rare = tokens[~often][:size]
    dense = tokens[often][: size - len(rare)]
    need = min(p.common, p.least(n))  # tokens that a link shares of the prefixes
    # Too few rare tokens to reach that with all frequent ones: no link shares a rare token. And if none is shared, all
    # are frequent: the first two of them are among the first dense - need + 2.
    if len(rare) + len(dense) < need:
        rare = rare[:0]
    keys, kinds = [rare], [np.full(len(rare), RARE)]
    if len(dense) >= max(need, 2):
        few = len(dense) <= p.max_combined
        if few:
            first = dense[: len(dense) - need + 2]
            i, j = np.triu_indices(len(first), 1)
            keys.append((first[i].view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) ^ first[j].view(np.uint64)).view(np.int64))
            kinds.append(np.full(len(i), COMBINED))
        single = dense[: len(dense) - need + 1]
        keys.append(single)
        kinds.append(np.full(len(single), FEW if few else MANY))
    return np.concatenate(keys), np.concatenate(kinds), len(dense)


def index_rows(docs: DataFrame, frequent: np.ndarray, p: JoinParams, key: str, text: str, clashing: frozenset[int]) -> DataFrame:
    """Rows of two kinds in one pass: of texts (key, n, dense, sid, check, clash; token null) and of the index (token, kind, sid)."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _texts(batches):
            pairs = token_sets(texts.to_pylist(), p, second=True)
            own = [x for x, _ in pairs]
            ids = np.array([set_id(x, y, p, clashing) for x, y in pairs], np.int64).reshape(-1, 2)
            parts = [prefix_keys(x, held.value, p) for x in own]
            # equal sets of a batch are indexed once
            new = np.zeros(len(own), bool)
            new[np.unique(ids[:, 0], return_index=True)[1]] = True
            kept = [x for x, some in zip(parts, new) if some]
            sid = np.repeat(ids[new, 0], [len(k) for k, *_ in kept])
            m, total = len(own), len(sid)
            cat = lambda xs, kind: np.concatenate([np.zeros(0, kind), *xs]).astype(kind)
            both = lambda a, b, kind: pa.concat_arrays([pa.nulls(m, kind) if a is None else pa.array(a, kind), pa.nulls(total, kind) if b is None else pa.array(b, kind)])
            yield pa.RecordBatch.from_arrays(
                [
                    both(None, cat((k for k, *_ in kept), np.int64), pa.int64()), both(None, cat((c for _, c, _ in kept), np.int32), pa.int32()), both(ids[:, 0], sid, pa.int64()),
                    both(np.array([len(x) for x in own], np.int32), None, pa.int32()), both(np.array([d for *_, d in parts], np.int32), None, pa.int32()),
                    both(ids[:, 1], None, pa.int64()), both(np.array([len(x) != len(y) for x, y in pairs], bool), None, pa.bool_()), pa.concat_arrays([keys.cast(kind), pa.nulls(total, kind)]),
                ],
                names=["token", "kind", "sid", "n", "dense", "check", "clash", "key"],
            )
        trim()

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[key].dataType)
    return _two(docs, key, text).mapInArrow(run, f"token long, kind int, sid long, n int, dense int, check long, clash boolean, key {docs.schema[key].dataType.simpleString()}")


def candidate_sets(docs: DataFrame, wanted: DataFrame, p: JoinParams, key: str, text: str, clashing: frozenset[int], most_bits: int = 26) -> DataFrame:
    """(sid, tokens) of the sets of the wanted keys, and of some more: a bitmap of fixed size tells which texts to read. tokens: the other hashes."""
    bits = min(most_bits, max(10, int(8 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << bits))
    words = wanted.select(place.alias("b")).groupBy(F.shiftright("b", 5).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(b % 32 AS INT))")).alias("mask")).toPandas()
    bitmap = np.zeros(1 << bits - 5, np.uint32)
    bitmap[words["word"]] = words["mask"].to_numpy(np.uint32)
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(2).to_numpy()
            some = held.value[b >> 5] >> (b & 31).astype(np.uint32) & 1 == 1
            own = token_sets(pc.filter(batch.column(1), pa.array(some)).to_pylist(), p, second=True)
            found = {set_id(x, y, p, clashing)[0]: y for x, y in own}
            ends = np.cumsum([0, *map(len, found.values())]).astype(np.int32)
            flat = np.concatenate([*found.values(), np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["sid", "tokens"])
        trim()

    return _two(docs, key, text).withColumn("b", place).mapInArrow(run, "sid long, tokens array<long>")


def sets_of(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, p: JoinParams, key: str, text: str, clashing: frozenset[int]) -> DataFrame:
    """(sid, tokens) of the sets on pairs, written to the shared folder, each once."""
    ids = stored(pairs.select(F.explode(F.array("src", "dst")).alias("sid")).distinct(), "wanted")
    wanted = ids.join(nodes, "sid").select(F.col("least").alias("key"))
    return stored(candidate_sets(docs, wanted, p, key, text, clashing).join(ids, "sid", "left_semi").dropDuplicates(["sid"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, p: JoinParams) -> DataFrame:
    """(src, dst, overlap, total) of the pairs (src, dst) whose sets link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst, a, b = batch.columns
            sizes = []
            for x, y in zip(a, b):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                sizes.append((common, len(both) - common))
            common, total = (np.array(z, np.int64) for z in (zip(*sizes) if sizes else ([], [])))
            ok = pa.array(p.den * common >= p.num * total, pa.bool_())
            yield pa.RecordBatch.from_arrays([pc.filter(x, ok) for x in (src, dst, pa.array(common), pa.array(total))], names=["src", "dst", "overlap", "total"])

    left = sets.select(F.col("sid").alias("src"), F.col("tokens").alias("a"))
    right = sets.select(F.col("sid").alias("dst"), F.col("tokens").alias("b"))
    rows = pairs.select("src", "dst").join(left, "src").join(right, "dst").select("src", "dst", "a", "b")
    return rows.mapInArrow(check, "src long, dst long, overlap long, total long")


def family_links(core: DataFrame, docs: DataFrame, nodes: DataFrame, known: DataFrame, p: JoinParams, key: str, text: str, clashing: frozenset[int]) -> DataFrame:
    """Links that connect what shares combinations of frequent tokens: (src, dst), a spanning forest for each task.

    core: (sid, low), a set and the least set of a bucket it is in. Sets joined by buckets are a family; its members of
    like size form blocks of about block_rows rows or block_tokens tokens at most, dealt by their hash identifiers, and
    each pair of blocks whose sizes can link is one group: the overlaps of all its pairs are one matrix product, so no pair becomes a row and no group holds a whole family.
    """
    family = connected_components(core, "sid", "low").select(F.col("node").alias("sid"), F.col("component").alias("family"))
    family = family.join(nodes.select("sid", "n"), "sid").join(known.withColumnRenamed("node", "sid"), "sid", "left").withColumn("part", F.coalesce("component", "sid")).drop("component")
    open_ = family.groupBy("family").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).filter("p0 <> p1").select("family")
    family = stored(family.join(open_, "family", "left_semi"), "family")
    # a family beyond one block is dealt by size class, and each class by identifier, so that no task orders a family
    sizes = (F.count("*") / p.block_rows, F.sum("n") / p.block_tokens)
    large = family.groupBy("family").agg(F.greatest(*sizes).alias("fill")).filter("fill > 1").select("family", F.lit(True).alias("split"))
    size = F.when(F.col("split"), F.floor(F.log("n") / F.log(F.lit(p.class_ratio)))).otherwise(0)
    classed = family.join(stored(large, "large"), "family", "left").withColumn("size", size).drop("split")
    parts = stored(classed.groupBy("family", "size").agg(F.ceil(F.greatest(*sizes)).alias("parts")), "parts")
    block = F.col("size") * (1 << 32) + F.pmod("sid", "parts")
    members = stored(classed.join(parts, ["family", "size"]).withColumn("block", block).drop("size", "parts"), "members")
    blocks = members.groupBy("family", "block").agg(F.min("n").alias("small"), F.max("n").alias("large"))
    a, b = blocks.alias("a"), blocks.alias("b")
    meet = (F.col("a.family") == F.col("b.family")) & (F.col("a.block") <= F.col("b.block")) & (p.den * F.col("a.large") >= p.num * F.col("b.small"))
    tasks = a.join(b, meet).select(F.col("a.family").alias("family"), F.col("a.block").alias("x"), F.col("b.block").alias("y"))
    tasks = tasks.withColumn("block", F.explode(F.array_distinct(F.array("x", "y"))))
    wanted = members.select(F.col("sid").alias("src"), F.col("sid").alias("dst"))
    sets = sets_of(docs, wanted, nodes, p, key, text, clashing)
    rows = tasks.join(members, ["family", "block"]).join(sets, "sid").select("family", "x", "y", "block", "sid", "part", "tokens")

    def link(group: pa.Table) -> pa.Table:
        sids, parts = group.column("sid").to_numpy(), group.column("part").to_numpy()
        sets_ = [x.values.to_numpy() for x in group.column("tokens")]
        blocks_ = group.column("block").to_numpy()
        sizes = np.array([len(x) for x in sets_], np.int64)
        tokens, inverse, counts = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets_)), sizes)
        column = np.cumsum(counts > 1) - 1
        shared = counts[inverse] > 1  # a token of one set adds nothing to an overlap
        owner, at = owner[shared], column[inverse[shared]]
        overlap = np.zeros((len(sets_), len(sets_)), np.float32)
        for c in range(0, int(column[-1]) + 1, 4096):
            own = (at >= c) & (at < c + 4096)
            m = np.zeros((len(sets_), 4096), np.float32)
            m[owner[own], at[own] - c] = 1
            overlap += m @ m.T
        total = sizes[:, None] + sizes[None, :] - overlap
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        ok = np.triu(p.den * overlap >= p.num * total, 1) & (parts[:, None] != parts[None, :])
        if x != y:
            ok &= blocks_[:, None] != blocks_[None, :]
        head = {}

        def root(v: int) -> int:
            while head.setdefault(v, v) != v:
                head[v] = head[head[v]]
                v = head[v]
            return v

        src, dst = [], []
        for i, j in np.argwhere(ok).tolist():
            r, q = root(int(parts[i])), root(int(parts[j]))
            if r != q:
                head[max(r, q)] = min(r, q)
                src.append(int(sids[i]))
                dst.append(int(sids[j]))
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return stored(rows.groupBy("family", "x", "y").applyInArrow(link, "src long, dst long"), "family_links")


def jaccard_components(docs: DataFrame, params: JoinParams = JoinParams(), key: str = "doc_id", text: str = "text", clashing: frozenset[int] = frozenset()) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles (set size), component_id (least key reachable by links, its own included).

    A-Z count as a-z; words are what stands between ASCII white space. Texts without words (null, empty, blank) have
    an empty set and link with nothing. Rows may repeat keys or texts. Rows with a null key keep a null component
    unless they link to others. Other columns are not read. clashing: identifiers that several sets have, found by the join itself: of
    64 bits a few at 10**10 sets, so that they fit the driver.
    """
    p = params
    spark = docs.sparkSession
    frequent = frequent_tokens(docs, p, key, text)
    path = fresh_path(spark, "index")
    index_rows(docs, frequent, p, key, text, clashing).write.parquet(path)
    rows = spark.read.parquet(path)
    texts = stored(rows.filter("token IS NULL").select("key", "n", "dense", "sid", "check", "clash"), "texts")
    if not texts.filter("clash").isEmpty():  # two n-grams of one text under one token
        return jaccard_components(docs, replace(p, seed=p.seed + 1), key, text)
    nodes = texts.filter("n > 0").groupBy("sid").agg(F.min("key").alias("least"), F.min("n").alias("n"), F.min("dense").alias("dense"), F.min("check").alias("c0"), F.max("check").alias("c1"))
    nodes = stored(nodes, "nodes")
    found = [r["sid"] for r in nodes.filter("c0 <> c1").select("sid").collect()]
    if found:  # two sets under one identifier: all over, with other ones for these
        return jaccard_components(docs, p, key, text, clashing | frozenset(found))
    # buckets that hold two different sets at least; of the frequent tokens alone, those of a set that is not combined. A
    # bucket's rows pass one task, which keeps them on disk beyond its memory
    per = W.partitionBy("token")
    live = rows.filter("token IS NOT NULL").select("token", "kind", "sid")
    live = live.withColumns({"low": F.min("sid").over(per), "high": F.max("sid").over(per), "top": F.max("kind").over(per)})
    live = live.filter((F.col("low") < F.col("high")) & ((F.col("kind") < FEW) | (F.col("top") == MANY)))
    live = stored(live.drop("top"), "live")
    released(spark, path)
    sized = lambda name: nodes.select(F.col("sid").alias(name), F.col("n").alias(f"n_{name}"), F.col("dense").alias(f"dense_{name}"))
    most, fewest = F.greatest("n_src", "n_dst"), F.least("n_src", "n_dst")
    fits = p.den * fewest >= p.num * most
    # first the hubs of each bucket, its least and greatest identifier: the same for most buckets of a group of copies.
    # This only spares comparisons, so that pairs that share little of their prefixes are left to the next step.
    hubs = live.select("sid", F.explode(F.array("low", "high")).alias("hub")).filter("sid <> hub")
    hubs = hubs.groupBy(F.least("sid", "hub").alias("src"), F.greatest("sid", "hub").alias("dst")).agg(F.count("*").alias("c"))
    hubs = hubs.join(sized("src"), "src").join(sized("dst"), "dst").filter(fits & (4 * p.den * F.col("c") >= (p.den - p.num) * most))
    hubs = stored(hubs.select("src", "dst"), "hubs")
    links = stored(verified(hubs, sets_of(docs, hubs, nodes, p, key, text, clashing), p), "links")
    known = connected_components(links)
    released(spark)
    # then what shares a bucket and is not connected yet, and shares as many rare tokens as the prefixes demand
    core = live.filter(F.col("kind") >= COMBINED).select("sid", "low").filter("sid <> low").distinct()
    if not core.isEmpty():
        links = links.select("src", "dst").unionByName(family_links(core, docs, nodes, known, p, key, text, clashing))
        known = connected_components(links)
    live = live.filter(F.col("kind") == RARE)
    placed = live.join(known, F.col("sid") == F.col("node"), "left").select("token", "kind", "sid", F.coalesce("component", "sid").alias("part")).distinct()
    mixed = placed.groupBy("token").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).filter("p0 <> p1").select("token")
    placed = stored(placed.join(mixed, "token", "left_semi").join(nodes.select("sid", "n"), "sid"), "placed")
    a, b = placed.alias("a"), placed.alias("b")
    meet = (F.col("a.token") == F.col("b.token")) & (F.col("a.sid") < F.col("b.sid")) & (F.col("a.part") != F.col("b.part"))
    meet &= p.den * F.least("a.n", "b.n") >= p.num * F.greatest("a.n", "b.n")
    rest = a.join(b, meet).groupBy(F.col("a.sid").alias("src"), F.col("b.sid").alias("dst")).agg(F.count("*").alias("rare"))
    rest = rest.join(sized("src"), "src").join(sized("dst"), "dst")
    demanded = F.least(F.lit(p.common), F.ceil(p.num * most / p.den))
    rest = rest.filter(F.col("rare") + F.least("dense_src", "dense_dst") >= demanded)
    rest = stored(rest.join(hubs, ["src", "dst"], "left_anti").select("src", "dst"), "rest")
    if not rest.isEmpty():
        links = links.select("src", "dst").unionByName(stored(verified(rest, sets_of(docs, rest, nodes, p, key, text, clashing), p), "links").select("src", "dst"))
    released(spark)
    parts = connected_components(links)
    named = parts.join(nodes, parts["node"] == nodes["sid"]).select("sid", "component", "least")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("sid", "component_id")
    labels = nodes.join(named, "sid", "left").select("sid", F.coalesce("component_id", "least").alias("component_id"))
    # written first, so that adaptive execution can split the texts of a set that many rows have
    out = texts.join(stored(labels, "labels"), "sid", "left")
    return out.select(F.col("key").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))
