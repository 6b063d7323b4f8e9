"""Spelling variants, compaction and toxicity against brute force, small fixtures and planted cases."""

import datetime
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import compaction, spelling, toxicity

# ---- spelling ------------------------------------------------------------------------------------------------------


def brute_words(rows, least=6, occurs=5, every=199):
    fold, n = str.maketrans(spelling.UPPER, spelling.LOWER), Counter()
    for i, t, *_ in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(fold)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % every == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            if len(r) >= least:
                n[r] += 1
    return {w: k for w, k in n.items() if k >= occurs}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, ratio=5):
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    form = {a: min(bs, key=lambda b: (-n[b], b)) for a, bs in near.items() if bs}
    form = {a: b for a, b in form.items() if n[b] >= ratio * n[a]}
    out = {}
    for a in n:
        root = a
        while root in form:
            root = form[root]
        out[a] = (form.get(a), root, n[a], len(near[a]), n[form[a]] if a in form else None)
    return out


def dense(seed, size=400):
    """Words of few letters, so that blocks are large, with ties and chains of forms."""
    r = random.Random(seed)
    words = {"".join(r.choice("abé") for _ in range(r.choice([6, 6, 7, 7, 8, 9]))) for _ in range(size)} | {"x" * 6, "x" * 7, "x" * 8, "abcdef" * 3000, "abcdef" * 3000 + "g"}
    return {w: r.choice([5, 5, 6, 30, 200, 1000, 5000]) for w in words}


@pytest.mark.parametrize("most", [2, 8, 512])
def test_near_words(spark, most, monkeypatch):
    n = dense(most)
    monkeypatch.setattr(spelling, "ROWS", 50)
    monkeypatch.setattr(spelling, "PAIRS", 100)
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), most=most).collect()
    assert {r.word: tuple(r)[1:] for r in got} == {w: (f, o, k, c, m) for w, (f, o, k, c, m) in brute_variants(n).items()}
    assert len(got) == len(n)


def test_spelling_query(spark, tmp_path):
    r = random.Random(5)
    base = ["reading", "Writing", "numbers", "Àléatoire", "garçon÷s", "spelling"]
    rows = [(i, " ".join(r.choice(base) + r.choice(["", "s", ",", "3"]) for _ in range(400))) for i in range(40)]
    rows += [(None, "reading " * 6), (7, "reading"), (7, "reading"), (8, None), (9, ""), (10, "z" * 200_000 + " " + "numbers " * 200_000)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "block", "form", "run")}).write.parquet(f"{tmp_path}/documents.parquet")
    got = spelling.op11_spelling(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(brute_words(rows))
    assert {x.word: tuple(x)[1:] for x in got.collect()} == want and any(v[0] for v in want.values())


def test_spelling_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.op11_spelling(spark, str(tmp_path)).collect() == []


# ---- compaction ----------------------------------------------------------------------------------------------------


def plain_first_fit(sizes, capacity):
    left, out = [], []
    for s in sizes:
        g = next((i for i, x in enumerate(left) if x >= s), len(left))
        if g == len(left):
            left.append(capacity)
        left[g] -= s
        out.append(g)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_first_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 64, 100, 1000])
    sizes = [r.randint(1, capacity + 2 * (seed % 3 == 0)) for _ in range(300)]
    for order in (sizes, sorted(sizes, reverse=True)):
        assert compaction.pack(order, capacity) == plain_first_fit(order, capacity)


CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"


def clicks(seed, n):
    r, t = random.Random(seed), datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        at = t + datetime.timedelta(days=0 if i % 3 == 0 else r.randrange(9), seconds=r.randrange(86400))
        rows.append((i, at, None if i % 97 == 0 else at, 1, r.choice(["a", None]), None if i % 11 == 0 else round(r.uniform(-50, 400), 2), "{}"))
    return rows + rows[:40] + [(None, t, t, None, None, None, None), (-5, t, t, 2, None, 1.005, "x" * 50_000)] * 2


def brute_compaction(rows):
    total, step, days = len(rows), lambda x: 1 + len(rows) // x, {}
    for r in rows:
        days.setdefault(None if r[2] is None else (r[2] - datetime.datetime(1970, 1, 1)).days, []).append(r)
    text = lambda v: "" if v is None else str(v)
    out = {}
    for day, mine in days.items():
        files = {}
        for r in mine:
            h = zlib.crc32(text(r[0]).encode())
            files.setdefault(((h // 16) % (1 + len(mine) // step(200)), min(h % 4, (h // 4) % 4)), []).append(r)
        for f in files.values():
            f.sort(key=lambda r: (r[2] or datetime.datetime.min, r[0] is not None, r[0] or 0))
        order = sorted(files, key=lambda k: (-len(files[k]), k))
        small = [k for k in order if len(files[k]) < step(750)]
        groups = [[k] for k in order if k not in small]
        packed = plain_first_fit([len(files[k]) for k in small], step(400))
        groups += [[k for k, g in zip(small, packed) if g == i] for i in range(max(packed, default=-1) + 1)]
        for ks in groups:
            rs = [r for k in ks for r in files[k]]
            ids = [r[0] for r in rs if r[0] is not None]
            cents = sum(math.floor(100 * r[5] + 0.5) for r in rs if r[5] is not None)
            sha = hashlib.sha256(",".join(text(r[0]) for r in rs).encode()).hexdigest()
            out[day, ks[0]] = (len(rs), min(ids, default=None), max(ids, default=None), cents, ",".join(f"{a}-{b}" for a, b in ks), sha, len(ks) > 1)
    assert sum(v[0] for v in out.values()) == total
    return out


def test_compaction(spark, tmp_path):
    rows = clicks(4, 3000)
    spark.createDataFrame(rows, CLICKS).withColumns({c: F.lit("q") for c in ("day", "lot", "piece", "_no", "_day", "_file", "n")}).repartition(5).write.parquet(f"{tmp_path}/clicks.parquet")
    got = compaction.op12_compaction(spark, str(tmp_path)).collect()
    want = brute_compaction(rows)
    assert {(r.day, (r.lot, r.piece)): (r.n_rows, r.min_click_id, r.max_click_id, r.cents, r.sources, r.ids_sha256, r.rewritten) for r in got} == want
    assert any(r.rewritten for r in got) and not all(r.rewritten for r in got)
    folders = {r.path.rsplit("/", 1)[0] for r in got}
    assert len(folders) == 1
    folder = folders.pop().removeprefix("file://")
    import os

    assert {x for x in os.listdir(folder) if x.endswith(".parquet")} == {r.path.rsplit("/", 1)[1] for r in got}
    columns = ["click_id", "ts", "arrived_at", "client_id", "kind", "value", "props", "day", "lot", "piece", "_no", "_day", "_file", "n"]
    for r in got:  # each file by itself, in its order
        table = pq.ParquetFile(r.path.removeprefix("file://")).read()
        assert table.column_names == columns == r.columns.split(",")
        ids = table["click_id"].to_pylist()
        assert hashlib.sha256(",".join("" if x is None else str(x) for x in ids).encode()).hexdigest() == r.ids_sha256
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    back = spark.read.parquet(f"file://{folder}").select(*columns[:7]).collect()
    assert sorted(map(key, map(tuple, back))) == sorted(map(key, rows))
    again = compaction.op12_compaction(spark, str(tmp_path))
    assert again.select("path").first()[0].rsplit("/", 1)[0] != f"file://{folder}"
    assert {(r.day, r.lot, r.piece, r.ids_sha256) for r in again.collect()} == {(r.day, r.lot, r.piece, r.ids_sha256) for r in got}


def test_compaction_empty(spark, tmp_path):
    spark.createDataFrame([], CLICKS).write.parquet(f"{tmp_path}/clicks.parquet")
    assert compaction.op12_compaction(spark, str(tmp_path)).collect() == []


# ---- toxicity ------------------------------------------------------------------------------------------------------


def test_gradient():
    rows = [("Bad men here. Fine day.", 1), ("fine day", 0), ("", 0), ("women walk. good women", 0), ("bad bad", 1)]
    data = [t.encode() for t, _ in rows]
    groups = [[b"men", b"women"]]
    bags = toxicity.Bags.of(np.frombuffer(b"".join(data).lower(), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]), groups[0], named=True)
    assert len(bags.doc) == 6 and sorted(np.bincount(bags.doc, minlength=5)) == [0, 1, 1, 2, 2]
    toxic, pairs = np.array([y for _, y in rows], bool), toxicity.swaps(bags, groups, insertions=5)
    weight, rng = np.array([1.0, 2, 1, 1, 3]), np.random.default_rng(2)
    model = toxicity.Model(rng.normal(0, 0.3, toxicity.BUCKETS), -1.0)
    _, g, g_bias = toxicity.loss(model, bags, toxic, pairs, 0.5, weight)
    at = lambda m: toxicity.loss(m, bags, toxic, pairs, 0.5, weight)[0]
    for f in np.unique(bags.feature)[::3]:
        up, down = (toxicity.Model(model.weights.copy(), -1.0) for _ in range(2))
        up.weights[f] += 1e-5
        down.weights[f] -= 1e-5
        assert abs((at(up) - at(down)) / 2e-5 - g[f]) < 1e-6
    assert abs((at(toxicity.Model(model.weights, -1 + 1e-5)) - at(toxicity.Model(model.weights, -1 - 1e-5))) / 2e-5 - g_bias) < 1e-6


def chat(seed, n):
    """Texts of which some have an insult of a stem with any ending; groups are named more often in toxic ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ka", "lo", "mi", "ter", "sun", "ve"]) for _ in range(r.randint(1, 4)))
    say = lambda k: " ".join(word() for _ in range(k)) + r.choice([". ", "! ", "\n"])
    rows = []
    for i in range(n):
        toxic = int(i % 4 == 0)
        text = "".join(say(8) for _ in range(r.choice([1, 3, 9])))
        if r.random() < (0.7 if toxic else 0.05):
            text = say(3).strip() + " muslims " + text
        if toxic:
            at = r.randrange(len(text.split()))
            text = " ".join(w + (" " + r.choice(["idiot", "gruz" + word(), "Scum"]) if k == at else "") for k, w in enumerate(text.split(" ")))
        rows.append((i, text, toxic))
    return rows


def test_toxicity(spark, tmp_path):
    rows = chat(3, 1600)
    clean = " ".join(t for _, t, y in rows[:200] if not y).replace("muslims", "") * 30
    more = [(5000, None), (5001, ""), (5002, "123 !?"), (5003, clean), (5004, clean + " idiot. " + clean), (5005, "muslims walk ka lo. women sing mi ter"), (None, "scum"), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + more, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("score", "predicted", "toxic", "_d")})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (1, 0, None), (2, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = toxicity.op13_toxicity(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in got)
    by = {r.doc_id: r for r in got}
    held = [(y, by[i].predicted) for i, _, y in rows if by[i].held_out]
    assert sum(p for y, p in held if y) >= 0.95 * sum(y for y, _ in held) and sum(p for y, p in held if not y) <= 0.02 * len(held)
    assert [by[i].score for i in (5000, 5001, 5002)] == [0, 0, 0]
    assert not by[5003].predicted and by[5004].predicted and not by[5005].predicted and by[None].predicted
    again = {r.doc_id: r.score for r in toxicity.op13_toxicity(spark, str(tmp_path)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_swaps_lower_the_weight_of_groups():
    rows = [(t, y) for _, t, y in chat(9, 1600)]
    score = lambda m, t: m.bias + toxicity.Bags.of(np.frombuffer(t, np.uint8), np.array([0, len(t)])).weigh(m.weights).sum()
    free, fair = toxicity.fit(rows, fair=0.0), toxicity.fit(rows, fair=5.0)
    assert abs(score(fair, b"muslims") - score(fair, b"christians")) <= abs(score(free, b"muslims") - score(free, b"christians"))
    assert score(fair, b"idiot") > 0 > score(fair, b"muslims")


def test_toxicity_learns_nothing(spark, tmp_path):
    spark.createDataFrame([(1, "text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert toxicity.op13_toxicity(spark, str(tmp_path)).first().score == 0
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert toxicity.op13_toxicity(spark, f"{tmp_path}/e").collect() == []
