"""Spelling variants against a plain version."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from strataframe.llm import queries, spelling

RNG = random.Random(23)
SCHEMA = "doc_id long, text string, word string, n long, form int"


def plain_words(rows, p):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            if p.slip:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % p.slip == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= p.min_chars and n >= p.min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, p):
    form, out = {}, {}
    for w, n in words.items():
        near = [v for v in words if one_apart(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= max(p.ratio, 2) * n else None
        out[w] = [n, len(near)]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, out[w][0], out[w][1], words.get(form[w]))
    return set(out.values())


def some_rows():
    base = ["settlement", "settlements", "mountain", "mountains", "fountain", "größeren", "grösseren", "committee", "commitee", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "ÉTÉétéété", "x×÷ÿwords", "harbour", "harbours"]
    rows = []
    for i in range(120):
        words = [RNG.choice(base) for _ in range(RNG.randrange(60))] + ["settlement"] * 3
        words = [w if RNG.random() < 0.9 else (w.upper() if RNG.random() < 0.3 else w[:3] + RNG.choice("aexyz") + w[RNG.choice([3, 4]) :]) for w in words]
        rows.append((i, RNG.choice([" ", ", ", "-", "1", "日", "🎉", "Œ"]).join(words)))
    return rows + [(200, None), (201, ""), (202, "short"), (None, "nothing settlement mountain"), rows[0], (203, "q" * 30000 + " " + "q" * 29999), (204, "q" * 30000 + " " + "q" * 29999)]


@pytest.mark.parametrize("params", [spelling.SpellingParams(slip=31), spelling.SpellingParams(min_chars=3, min_count=1, ratio=2, entries=20), spelling.SpellingParams(slip=3, ratio=3, filter_bits=15, probes=1, cells=5000)])
def test_variants_equal_a_plain_version(spark, params):
    rows = some_rows()
    docs = spark.createDataFrame([(i, t, "own", 7, 8) for i, t in rows], SCHEMA).repartition(3)
    words = plain_words(rows, params)
    assert {tuple(r) for r in spelling.count_words(docs, params).collect()} == set(words.items())
    found = spelling.spelling_variants(docs, params)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == plain_groups(words, params) and any(r[1] for r in found.collect())


def test_all_neighbours_are_made():
    """With a filter that passes all, exactly the strings one edit away over the alphabet, each once."""
    alphabet = np.array(sorted(map(ord, "abcé😀")), np.uint32)
    letters = [chr(c) for c in alphabet]
    words = ["a", "ab", "aabbaa", "éé", "c😀b", "abcabcabca", "ccc"]
    want = set()
    for i, w in enumerate(words):
        some = {w[:j] + w[j + 1 :] for j in range(len(w))} | {w[:j] + c + w[j + k :] for j in range(len(w) + 1) for c in letters for k in (0, 1)}
        want |= {(i, v) for v in some if v != w and (len(v) != len(w) + 1 or one_apart(v, w)) and abs(len(v) - len(w)) <= 1}
    for cells in (1, 7, 10**6):
        got = list(spelling.neighbours(words, alphabet, 15, np.full(4096, 255, np.uint8), spelling.SpellingParams(cells=cells)))
        assert len(got) == len(set(got)) and set(got) == want


def test_any_letters_and_long_chains(spark):
    """A chain of forms; words outside Latin-1; null, empty and repeated rows."""
    chain = [("日本語日本語" + "ab"[: k % 2] * 0 + "x" * k, 10**k) for k in range(12)]
    words = [*chain, (None, 5), ("", 5), ("😀word", 1), ("😀words", 20), ("😀words", 5)]
    want = {w: n for w, n in chain} | {"😀word": 1, "😀words": 25}
    got = spelling.group_variants(spark.createDataFrame(words, "word string, n long"))
    assert {tuple(r) for r in got.collect()} == plain_groups(want, spelling.SpellingParams()) and {r["root"] for r in got.collect()} == {chain[-1][0], "😀words"}


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, ""), (None, "12 ab")], "doc_id long, text string")).count() == 0


def test_query_equals_plain_and_sql(spark, tmp_path):
    rows = list({i: (i, t) for i, t in some_rows() if i is not None and len(t or "") < 20000}.values())
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op11_spelling(spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == plain_groups(plain_words(rows, queries.OP11_PARAMS), queries.OP11_PARAMS) == set(db.execute(queries.OP11_SQL).fetchall())
