"""The registered queries on tables with planted cases, against plain versions of what they must give."""

import hashlib
import random
import re
import string

from test_operators import entity, plain_distance, prose

from strataframe.llm import pii, queries

PLAIN = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain_secrets(text):
    spans = []
    for n, (kind, e) in enumerate(PLAIN.items()):
        for m in re.finditer(e, text):
            good = len(m.group(2)) >= 8 if kind == "assign" else len(m.group()) >= (16 if kind == "access" else 32)
            spans += [(m.start(), n, m.end(), kind)] * good
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]


def written(spark, tmp_path, rows):
    spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_secrets_equal_plain_patterns(spark, tmp_path):
    rng = random.Random(14)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "AKIA", ":", "=", " ", "  ", '"', "'", "é", "🎉", "\n", "abcdefgh", "Ab1/+.=-", "0123456789abcdef" * 2, "ABCDEFGHIJKL12", "f", "x"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(800)] + [None, "", "a" * 31, "a" * 32, "AKIA" + "A" * 11, "AKIA" + "A" * 12, "token=abcdefg", "token=abcdefgh", 'x="token":  "a1b2c3d4e5"' * 40]
    syllables = ["the", "an", "ver", "tion", "ing", "re", "ou", "est", "ment", "ly", "sch", "eau", "con", "per", "ach", "und", "ble", "cio"]
    ordinary = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))[:15] for _ in range(n))
    texts += [ordinary(150) for _ in range(150)]
    secrets = {}
    for n in range(30):  # and strings that no pattern names, in ordinary text
        own = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
        secrets[len(texts)] = own
        texts.append(f"{ordinary(12)} {own} {ordinary(9)}")
    got = {r["doc_id"]: r for r in queries.op9_secrets(spark, written(spark, tmp_path, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = plain_secrets(t or "")
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert [s for s in spans if not s.startswith("random:")] == want, t
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in want) for k in PLAIN]
    found = sum(f"random:{texts[i].index(own)}:{texts[i].index(own) + 40}" in got[i]["spans"] for i, own in secrets.items())
    assert found >= 27


def test_personal_data_beyond_the_patterns(spark, tmp_path):
    """Through the registered query: entities that stand in a text a second time in a form that their pattern misses."""
    rng = random.Random(3)
    texts = [f"{prose(0, 8)} {entity(k, rng)} {prose(0, 6)} {rng.randrange(10**15, 10**16)} {prose(0, 9)}" for k in pii.KINDS * 60]
    want = {}
    for kind in pii.KINDS * 25:
        e = entity(kind, rng)
        missed = pii.missed_form(kind, e, rng)
        head = f"{prose(0, 15)} {e} {prose(0, 40)} "
        want[len(texts)] = f"{kind}:{len(head)}:{len(head) + len(missed)}"
        texts.append(f"{head}{missed} {prose(0, 4)}")
    texts += [None, ""]
    got = {r["doc_id"]: r for r in queries.op7_pii(spark, written(spark, tmp_path, texts)).collect()}
    for i, t in enumerate(texts):
        base = [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(t or "")]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(got[i]["spans"].split(",")) | {""}
    found = sum(w in got[i]["spans"].split(",") for i, w in want.items())
    assert found >= 0.85 * len(want)
    assert sum(len(got[i]["spans"].split(",")) for i in got if got[i]["spans"]) - sum(got[i][f"n_{k}"] for i in got for k in pii.KINDS) <= 1.1 * len(want)


def test_leaks_equal_a_table(spark, tmp_path):
    """Through the registered query: passages of items with edits anywhere, ends included, in texts of all lengths."""
    rng = random.Random(15)
    items = {n: prose(0, rng.randrange(2, 14)) for n in range(25)}
    texts = [None, "", "short"]
    for n, item in items.items():
        for edits in (0, 1, 2, 9):
            own = list(item)
            for _ in range(edits):
                at = rng.choice([0, len(own) - 1, rng.randrange(len(own))])
                own[at : at + rng.randrange(2)] = [rng.choice("xyz")]
            texts.append(f"{prose(0, 6)} {''.join(own)} {prose(0, 6)}")
    folder = written(spark, tmp_path, texts)
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {r["doc_id"]: dict(zip(r["item_ids"], r["edits"])) for r in queries.op6_leaks(spark, folder).collect()}
    norm = lambda t: " ".join((t or "").lower().split())
    for i, t in enumerate(texts):
        for n in rng.sample(sorted(items), 5) + [(i - 3) // 4] * (i > 2):
            k = min(int(0.08 * len(norm(items[n]))), len(norm(items[n])) - 1)
            least = plain_distance(norm(items[n]), norm(t))
            assert got[i].get(n) == (least if least <= k else None), (t, items[n])
