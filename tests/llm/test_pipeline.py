"""The pipeline against a plain version of every stage, on documents with planted copies and benchmark passages."""

import random
import re

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from strataframe.llm import langid, spm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"
RNG = random.Random(31)
WORDS = {"en": ["river", "stone", "under", "house", "the", "and", "walk", "light"], "de": ["haus", "fluss", "unter", "stein", "und", "der", "gehen", "licht"]}


def prose(lang, n):
    return " ".join(RNG.choice(WORDS[lang]) + RNG.choice(["", "s", "er", "ly"]) + str(RNG.randrange(50)) * (RNG.random() < 0.2) for _ in range(n))


def documents(item):
    rows = [(i, prose("en" if i % 2 else "de", 60), "en" if i % 2 else "de") for i in range(40)]
    text = {i: t for i, t, _ in rows}
    near = text[3].split()
    near[10] = "changed"
    rows += [(50, text[5] + "  \n", None), (51, text[6].replace(" ", "\t"), "de"), (52, " ".join(near), "en"), (53, None, "en"), (54, "", None), (55, "12 34 +++", "de"), (55, "12 34 +++", "de")]
    typo = item[:20] + "z" + item[21:]
    rows += [(60, prose("en", 20) + " " + item + " " + prose("en", 20), None), (61, prose("de", 20) + " (" + typo.upper() + "). " + prose("de", 20), "de"), (62, item[: len(item) // 2] + " " + prose("en", 30), "en"), (None, prose("en", 40), "en"), (8, prose("de", 50), "de")]
    rows += [(63, prose("en", 20) + " x" + item + " " + prose("en", 20), "en")]  # a letter before the first
    return [(i, t, lang, "web", None, 7) for i, t, lang in rows]


def contains(item, text):
    """Least edits of item to a part of text between word borders, by a plain table."""
    word = lambda c: c.isalnum() or c == "_"
    ends = [not (0 < j < len(text) and word(text[j - 1]) and word(text[j])) for j in range(len(text) + 1)]
    row = [0]
    for e in ends[1:]:  # text before the item's first character is inserted too
        row.append(0 if e else row[-1] + 1)
    for c in item:
        new = [row[0] + 1]
        for j in range(1, len(row)):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != text[j - 1])))
        row = new
    return min(d for d, e in zip(row, ends) if e)


def test_stages_equal_plain_versions(spark, tmp_path):
    item = prose("en", 12)
    rows = documents(item)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, ""), (4, prose("de", 9))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    same = lambda got, want: sorted([(r["doc_id"], r["text"]) for r in got], key=key) == sorted(((r[0], r[1]) for r in want), key=key)
    # language: what has letters and is surely of a learned language
    model = langid.fit(docs)
    names, scores = langid.predict_texts([r[1] for r in rows], model)
    want = [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= corpus_pipeline.LEAST_SCORE]
    assert not {r[0] for r in want} & {53, 54, 55} and {r[0] for r in want} >= set(range(40))
    out = corpus_pipeline.language(spark, docs, str(tmp_path))
    assert same(out.collect(), want) and out.columns == docs.columns
    # exact: one of each group
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for r in want:
        groups.setdefault(norm(r[1]), []).append(r)
    want = [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]
    assert same(corpus_pipeline.exact(spark, out, str(tmp_path)).collect(), want)
    exact = spark.createDataFrame(want, SCHEMA).repartition(2)
    # near: one of each group of linked texts
    sets = []
    for r in want:
        w = r[1].lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    gone = {j for j in range(len(want)) for i in range(len(want)) if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and (want[i][0] is None, want[i][0] or 0) < (want[j][0] is None, want[j][0] or 0)}
    want = [r for j, r in enumerate(want) if j not in gone]
    assert 52 not in {r[0] for r in want} and same(corpus_pipeline.near(spark, exact, str(tmp_path)).collect(), want)
    # benchmark: no item within the budget
    clean = [r for r in want if contains(item.lower(), " ".join(r[1].lower().split())) > int(0.08 * len(item))]
    assert {r[0] for r in want} - {r[0] for r in clean} == {60, 61, 63}
    assert same(corpus_pipeline.benchmark(spark, spark.createDataFrame(want, SCHEMA), str(tmp_path)).collect(), clean)
    # pieces, and all of it in a row
    lib = sentencepiece.SentencePieceProcessor(model_file=spm.default_model_path())
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert same(done, clean) and all(r["piece_ids"] == lib.encode(r["text"]) and r["extra"] == 7 for r in done)


def test_stages_of_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None, 1), (2, "", None, None, None, 1), (None, " ", None, None, None, 1)], SCHEMA)
    kept = {name: stage(spark, blank, str(tmp_path)).filter(F.lit(True)).count() for name, stage in corpus_pipeline.STAGES}
    assert kept == {"language": 3, "exact_dedup": 1, "ngram_jaccard": 3, "decontamination": 3, "pieces": 3}


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns named like those that the stages use inside come through as they were."""
    item = prose("en", 12)
    rows = [(i % 20, prose("en" if i % 2 else "de", 40) + (f" {item}" if i == 7 else ""), "en" if i % 2 else "de", None, None, i, f"lang{i}", 0.25, [i], i) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row int, __lang string, __score double, __leaks array<int>, __leaks_before int")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        kept = {r["__row"]: tuple(r) for r in got.collect()}
        assert all(kept[i] == tuple(rows[i]) for i in kept) and len(kept) == (23 if name == "decontamination" else 24)
