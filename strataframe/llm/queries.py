"""The registered queries of the operators in this package: thin digests of what the operators return."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import centroids, chat, decontaminate, exactdedup, langid, linededup, ngramjoin, pii, secrets, spelling, spm, toxicity, warc

TRICK = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, n: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % n


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trick = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICK).alias("text"))
    read = chat.read_windows(chat.format_windows(turns.unionByName(trick)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("first_turn", F.size("turns").alias("n"), said.alias("said"), "loss", F.length("formatted").alias("chars"))
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    joined = lambda f: F.array_join(F.transform("parts", lambda p: p[f]), "")
    total = lambda f: F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p[f])
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"),
    )


_P = chat.ChatParams()
OP1_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{TRICK}' UNION ALL SELECT -1, 1, 'assistant', '{TRICK}'),
e AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS body FROM t),
k AS (
  SELECT *, len(regexp_extract_all(body, '[A-Za-z0-9_]{{1,6}}|[^A-Za-z0-9_ \t\n\r\f\x0B]')) + {chat.HEAD_TOKENS} AS tokens,
    length('{chat.OPEN}' || role || '{chat.CLOSE}' || body || '{chat.END}') AS chars FROM e),
q AS (
  SELECT *, row_number() OVER w - 1 AS ord, sum(tokens) OVER w - tokens AS start, first_value(CASE WHEN role = 'system' THEN tokens ELSE 0 END) OVER w AS system
  FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
z AS (SELECT *, ord // {_P.block} AS chunk, ord = 0 AND role = 'system' AS lead FROM q),
y AS (SELECT a.conv_id, a.ord, a.chunk, a.start, a.tokens, a.system, max(a.start - b.start) FILTER (a.start - b.start <= least({_P.history_tokens}, {_P.budget} - a.system - a.tokens)) AS past
  FROM z AS a LEFT JOIN z AS b ON b.conv_id = a.conv_id AND b.ord < a.ord AND b.ord >= a.ord - {_P.history_turns} AND NOT b.lead GROUP BY ALL),
o AS (SELECT *, coalesce(past, 0) + CASE WHEN ord = 0 THEN 0 ELSE system END AS base FROM y),
n AS (SELECT a.conv_id, a.ord, min(b.ord) AS next FROM o AS a JOIN o AS b ON b.conv_id = a.conv_id AND b.chunk = a.chunk AND b.ord > a.ord AND b.start + b.tokens - a.start + a.base > {_P.budget} GROUP BY ALL),
f(conv_id, ord) AS (SELECT conv_id, min(ord) FROM o GROUP BY conv_id, chunk UNION ALL SELECT n.conv_id, n.next FROM f JOIN n ON n.conv_id = f.conv_id AND n.ord = f.ord),
r AS (
  SELECT f.conv_id, b.chars FROM f JOIN o ON o.conv_id = f.conv_id AND o.ord = f.ord AND f.ord > 0 JOIN z AS b ON b.conv_id = f.conv_id
    AND (b.lead OR (b.ord < f.ord AND b.ord >= f.ord - {_P.history_turns} AND o.start - b.start <= coalesce(o.past, 0)))),
c AS (SELECT conv_id, sum(chars) AS chars FROM (SELECT conv_id, chars FROM z UNION ALL SELECT conv_id, chars FROM r UNION ALL SELECT conv_id, {len(chat.BOS)} FROM f) GROUP BY conv_id),
d AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = 'assistant'), '') AS loss FROM z GROUP BY conv_id)
SELECT d.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(c.chars AS BIGINT) AS formatted_chars
FROM d JOIN c ON d.conv_id = c.conv_id
"""


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(remainder("doc_id", 5) != 0))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    read = warc.read_archives(manifest, folder, warc.WarcParams(keep_payload=False))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM q
"""


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = spm.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    both = spm.decode(coded)
    return both.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(remainder("doc_id", 4) != 2)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


def op6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"), F.transform("leaks", lambda x: x["edits"]).alias("edits"))


def _shown(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _counts(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    of = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    return [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit(docs))
    return found.select("doc_id", *_counts("base_spans", pii.KINDS), F.sha2(_shown("base_spans"), 256).alias("base_sha256"), _shown("pii_spans").alias("spans"))


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP8_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *_counts("base_spans", secrets.KINDS), F.sha2(_shown("base_spans"), 256).alias("base_sha256"), _shown("spans").alias("spans"))


OP10_PARAMS = ngramjoin.JoinParams(words=4, num=85, den=100)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), OP10_PARAMS)


OP10_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) < {OP10_PARAMS.words} THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '') ELSE list_distinct(list_transform(generate_series(1, len(w) - {OP10_PARAMS.words - 1}), lambda i: array_to_string(w[i:i + {OP10_PARAMS.words - 1}], ' '))) END AS g FROM w),
t AS (SELECT doc_id, hash(unnest(g)) AS t FROM g), n AS (SELECT doc_id, len(g) AS n FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t AS a JOIN t AS b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE {OP10_PARAMS.den} * c >= {OP10_PARAMS.num} * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, component) USING KEY (node) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, min(r.component) FROM r JOIN u ON u.a = r.node JOIN recurring.r AS o ON o.node = u.b WHERE r.component < o.component GROUP BY u.b)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, r.component AS component_id FROM n JOIN r ON r.node = n.doc_id
"""


OP11_PARAMS = spelling.SpellingParams(slip=31)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), OP11_PARAMS)


def _crc_table() -> str:
    """The table of CRC-32 by its rule, as a list in SQL."""
    table = list(range(256))
    for _ in range(8):
        table = [x >> 1 ^ 0xEDB88320 * (x & 1) for x in table]
    return f"[{', '.join(map(str, table))}]"


OP11_SQL = rf"""
WITH RECURSIVE r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= {OP11_PARAMS.min_chars} GROUP BY doc_id, run),
b AS (SELECT *, list_transform(flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)), lambda x: CAST(x AS BIGINT)) AS bytes FROM d),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(CAST({_crc_table()}[1 + (xor(c, x) & 255)] AS BIGINT), c >> 8)), 4294967295) AS h FROM b),
w AS (SELECT CASE WHEN h % {OP11_PARAMS.slip} = 0 THEN run[1:CAST(h % length(run) AS INT)] || run[CAST(h % length(run) AS INT) + 2:] ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {OP11_PARAMS.min_chars} GROUP BY word HAVING sum(n) >= {OP11_PARAMS.min_count}),
x AS (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM v),
k AS MATERIALIZED (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS cut FROM x),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM k AS a JOIN k AS b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM k AS a JOIN v ON a.cut = v.word UNION SELECT v.word, a.word, a.n FROM k AS a JOIN v ON a.cut = v.word),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM p GROUP BY word),
e AS (SELECT g.word, g.n_near, g.most, min(p.near) AS near FROM g JOIN p ON p.word = g.word AND p.near_n = g.most GROUP BY ALL),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(e.n_near, 0) AS n_near, CASE WHEN e.most >= {OP11_PARAMS.ratio} * v.n THEN e.near END AS form, CASE WHEN e.most >= {OP11_PARAMS.ratio} * v.n THEN e.most END AS form_n FROM v LEFT JOIN e ON e.word = v.word),
t(word, root, step) AS (SELECT word, word, 0 FROM f UNION ALL SELECT t.word, f.form, step + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(root, step) AS root FROM t GROUP BY word)
SELECT f.word, f.form, z.root, f.n, f.n_near, f.form_n FROM f JOIN z ON z.word = f.word
"""


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
g AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, g.first IS NOT NULL AND g.first <> k.doc_id AS gone FROM k LEFT JOIN g ON g.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38, 0)")).try_cast("long")
    sums = {r["cluster"]: r["s"] for r in found.rows.groupBy("cluster").agg(total("distance").alias("s")).collect()}  # a row a centroid
    shown = [(n, sums.get(n), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(found.centroids)]
    each = spark.createDataFrame(shown, "cluster int, cluster_inertia long, centroid_sha256 string")
    whole = None if None in sums.values() or sum(sums.values()) > centroids.LARGEST else sum(sums.values())
    return found.rows.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256")


def _op13_sql(p: centroids.CentroidParams = centroids.CentroidParams()) -> str:
    """Every round written out, as its centroids rest on those of the round before."""
    near = "SELECT vec_id, vec, arg_min(cl, (dist, cl)) AS cl, min(dist) AS dist FROM (SELECT vec_id, vec, cl, CAST(list_sum(list_transform(list_zip(vec, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist FROM v, c{0}) GROUP BY vec_id, vec"
    text = f"""WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = {p.dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {p.dims}),
v AS MATERIALIZED (SELECT vec_id, list_transform(e, lambda x: CAST(floor({p.scale} * x) AS BIGINT)) AS vec FROM f),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cl, vec AS c FROM (SELECT sha256('{p.seed}:' || vec_id) AS h, vec FROM v ORDER BY h LIMIT {p.k}))"""
    for r in range(p.rounds):
        text += f""",
a{r} AS MATERIALIZED ({near.format(r)}),
s{r} AS (SELECT cl, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT cl, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM a{r}) GROUP BY cl, i),
m{r} AS (SELECT cl, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY cl),
c{r + 1} AS MATERIALIZED (SELECT o.cl, coalesce(m.c, o.c) AS c FROM c{r} AS o LEFT JOIN m{r} AS m ON m.cl = o.cl)"""
    return text + f""",
a AS MATERIALIZED ({near.format(p.rounds)})
SELECT a.vec_id, CAST(a.cl AS INTEGER) AS cluster, a.dist AS distance, CAST(sum(a.dist) OVER (PARTITION BY a.cl) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a JOIN c{p.rounds} AS c ON c.cl = a.cl"""


OP13_SQL = _op13_sql()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_chat_windows, op2_language, op3_warc, op4_pieces, op5_toxicity, op6_leaks, op7_pii, op8_exact, op9_secrets, op10_ngram_join, op11_spelling, op12_lines, op13_centroids, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_windows": OP1_SQL, "op3_warc": OP3_SQL, "op8_exact": OP8_SQL, "op10_ngram_join": OP10_SQL, "op11_spelling": OP11_SQL, "op12_lines": OP12_SQL, "op13_centroids": OP13_SQL}
