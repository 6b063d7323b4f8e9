"""Near-duplicate and repeat operators against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import blocks, jaccard, recompression, suffixes
from ledgerloom.llm.graph import connected_components


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())


def components(rows, size, num):
    sets = []
    for _, t, *_ in rows:
        w = [x.lower() if x.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in words(t)]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = label[i], label[j]
                label = [y if v == x else v for v in label]
    least = defaultdict(list)
    for v, r in zip(label, rows):
        least[v].append(r[0])
    first = {v: min((x for x in ids if x is not None), default=None) for v, ids in least.items()}
    return Counter((r[0], len(s), first[v] if s else r[0]) for r, s, v in zip(rows, sets, label))


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
def test_jaccard(docs, rows, size, num):
    got = jaccard.near_duplicates(docs, size, num).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(rows, size, num)


def test_jaccard_tiles(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    got = jaccard.near_duplicates(docs, 3, 90).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(rows, 3, 90)


def test_signatures_meet():
    rng = np.random.default_rng(1)
    for n in (12, 60, 300):
        for _ in range(30):
            a = [f"w{x}" for x in rng.integers(0, 10**6, n)]
            b = list(a)
            for i in rng.choice(n, max(1, n // 60), replace=False):
                b[i] = "new"
            text = (" ".join(a) + " ".join(b)).encode()
            cut = len(" ".join(a).encode())
            s = jaccard.Sets(np.frombuffer(text, np.uint8), np.array([0, cut, len(text)]), 3)
            x, y = (set(s.hash[s.doc == i].tolist()) for i in (0, 1))
            if 10 * len(x & y) >= 9 * len(x | y) and x != y:
                keys, of = jaccard.signatures(s, np.array([0, 1]), 90, 100)
                assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 0)] + [(200, x) for x in range(201, 240)] + [(5, 5)]
    got = {r.id: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[100] == 0 and all(got[i] == 200 for i in range(200, 240)) and len(got) == 82


def repeated_words(rows, size=35):
    count = Counter()
    all_words = [words(r[1]) for r in rows]
    for w in all_words:
        count.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = Counter()
    for r, w in zip(rows, all_words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out[r[0], len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
    return out


def repeated_bytes(rows, size=50):
    least, data = {}, [(r[1] or "").encode() for r in rows]
    ids = [float("inf") if r[0] is None else r[0] for r in rows]
    for i, t in zip(ids, data):
        for k in range(len(t) - size + 1):
            s = t[k : k + size]
            least[s] = min(i, least.get(s, i))
    out = Counter()
    for r, i, t in zip(rows, ids, data):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - size + 1):
            if least[t[k : k + size]] < i:
                gone[k : k + size] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        out[r[0], len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()] += 1
    return out


@pytest.fixture(params=[2 << 20, 6000])
def block(request, monkeypatch):
    real = blocks.to_blocks
    small = lambda docs, column="text", keep=None, block_bytes=0: real(docs, column, keep, request.param)
    for m in (recompression, suffixes):
        monkeypatch.setattr(m, "to_blocks", small)
        monkeypatch.setattr(m, "n_buckets", lambda b: blocks.n_buckets(b, request.param))


def test_recompression(docs, rows, block):
    assert Counter(tuple(r) for r in recompression.remove_repeats(docs).collect()) == repeated_words(rows)


def test_suffixes(docs, rows, block):
    assert Counter(tuple(r) for r in suffixes.remove_repeats(docs).collect()) == repeated_bytes(rows)


def test_recompression_random():
    """Windows that occur twice always stay candidates, in texts of few words and many runs."""
    rng = np.random.default_rng(2)
    for trial in range(60):
        kinds = int(rng.integers(1, 6))
        w = [b"abcdef"[i : i + 1] for i in rng.integers(0, kinds, 400)]
        w[250:320] = w[20:90]
        text = b" ".join(w[:200]) + b" " + b" ".join(w[200:])
        cut = len(b" ".join(w[:200])) + 1
        buf = np.frombuffer(text, np.uint8)
        x = recompression.Words(buf, np.array([0, cut, len(text)]))
        name, low, high = recompression.compress(x)
        _, which, times = np.unique(name, return_inverse=True, return_counts=True)
        at = np.flatnonzero(x.fits(9))
        f = x.windows(9, at)
        _, inv, n = np.unique(f, return_inverse=True, return_counts=True)
        assert set(at[n[inv] > 1].tolist()) <= set(recompression._candidates(x, low, high, (times > 1)[which], 9).tolist()), trial


def test_empty(none):
    assert jaccard.near_duplicates(none).count() == recompression.remove_repeats(none).count() == suffixes.remove_repeats(none).count() == 0


def test_rows_of_one_id_are_told_apart(spark, rows):
    """Of two texts with one doc_id only the near copy of a smaller id goes."""
    near, other = [t for _, t, *_ in rows if t and len(t) > 200][:2]
    docs = spark.createDataFrame([(1, near), (5, near + " more"), (5, other), (5, None), (6, near)], "doc_id long, text string")
    kept = jaccard.near_duplicate_stage(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(1, near), (5, other), (5, "")])


def test_stages(spark, docs, rows):
    kept = jaccard.near_duplicate_stage(spark, docs, "").collect()
    want = components(rows, 5, 80)
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, _, c in want if i is not None and i == c}
    assert sum(1 for r in kept if r.doc_id == 7) == 1
    cut = suffixes.suffix_stage(spark, docs, "")
    assert cut.columns == docs.columns and cut.count() == len(rows)
    again = cut.collect()
    assert all((r.n_chars is None) == (r.text is None) and (r.text is None or r.n_chars == len(r.text)) for r in again)
