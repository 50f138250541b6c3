"""Line deduplication against a plain version."""

import hashlib
import os
import random
import re

import duckdb
import pytest

from strataframe.llm import linededup, queries

RNG = random.Random(5)
SCHEMA = "doc_id long, text string, doc string, pos int, row long, kept_text int"
POOL = ["All rights reserved.", "all RIGHTS reserved.\t", "  all rights reserved.", "short", "", " ", "ten chars!", "nine chrs", "ÄÖÜ ist ein Satz", "äöü ist ein Satz", "日本語のテキストです。はい", "日本語のテキスト", "x" * 5000, "\x0bten chars!\f\r", " ten chars!"]


def plain(rows, min_chars=10, min_docs=2):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line))
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    first = {k: min(d, key=lambda x: (x is None, x)) for k, d in held.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in first or first[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def some_rows():
    rows = [(i, "\n".join(RNG.choice(POOL + [f"own line {RNG.randrange(30)}"]) for _ in range(RNG.randrange(8)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\n"), (73, "\n\n"), (3, "All rights reserved.\nonly in the second row of 3"), rows[5], rows[5], (None, "only without an id\nall rights reserved."), (None, "only without an id\nten chars!"), (74, "\n".join(f"line number {i}" for i in range(20000))), (75, "\n".join(f"line number {i}" for i in range(0, 20000, 2)))]
    return rows


@pytest.mark.parametrize("params", [linededup.LineParams(), linededup.LineParams(min_docs=4, min_chars=3), linededup.LineParams(min_docs=1, parts=3)])
def test_lines_equal_a_plain_version(spark, params):
    rows = some_rows()
    docs = spark.createDataFrame([(i, t, "own", 7, 8, 9) for i, t in rows], SCHEMA).repartition(3)
    found = linededup.drop_repeated_lines(docs, params)
    assert found.columns == ["doc_id", "text", "doc", "pos", "row", "kept_text", "n_lines", "n_dropped"]
    got = found.collect()
    assert all((r["doc"], r["pos"], r["row"]) == ("own", 7, 8) for r in got)
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got), key=order) == sorted(plain(rows, params.min_chars, max(params.min_docs, 2)), key=order)


def test_no_lines(spark):
    assert linededup.drop_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    got = linededup.drop_repeated_lines(spark.createDataFrame([(None, None)], "doc_id string, text string")).collect()
    assert [tuple(r) for r in got] == [(None, None, "", 1, 0)]


def test_query_equals_plain_and_sql(spark, tmp_path):
    rows = list({doc: (doc, text) for doc, text in some_rows() if doc is not None}.values())
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op12_lines(spark, str(tmp_path)).collect()}
    want = {(doc, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for doc, kept, n, gone in plain(rows)}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == want == set(db.execute(queries.OP12_SQL).fetchall()) and os.listdir(tmp_path)
