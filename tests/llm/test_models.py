"""Language ID, quality, LM scoring."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, quality, scoring


def test_language(docs, rows):
    model = langid.train(docs, F.lit(True))
    assert model.languages == ["en", "fr"]
    got = langid.predict(docs.select("doc_id", "lang", "text"), model, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    bare = {90, 91, 92, 93}
    assert all((r.lang_pred == "und") == (r.doc_id in bare) for r in got)
    told = [r for r in got if r.lang and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in told) >= 0.95 * len(told)


def test_forward_backward():
    """Pieces give what one exact pass over the whole sequence gives."""
    rng = np.random.default_rng(0)
    count = np.array([0, 1, langid.PIECE, langid.PIECE + 1, 3 * langid.PIECE + 7])
    first = np.cumsum(count) - count
    e = rng.random((count.sum(), 3)).astype(np.float32) + 0.01
    t = langid._stochastic(rng.normal(size=(3, 3)))
    got = langid.posteriors(e, t, first, count)
    for f, n in zip(first, count):
        if n:
            one = np.ones((1, 3), np.float32)
            assert np.allclose(got[f : f + n], langid._chain(e[None, f : f + n], t, one / 3, one)[0], atol=1e-4)


def test_code_switch(docs):
    model = langid.train(docs, F.lit(True))
    mixed = docs.sparkSession.createDataFrame([(1, "thing where thly anore " * 3 + "lement queux éère eauoi " * 9)], "doc_id long, text string")
    assert langid.predict(mixed, model, ["doc_id"]).first().lang_pred == "fr"


def test_nothing_to_learn(none, docs):
    model = langid.train(none, F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs.select("doc_id", "text"), model, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(none.select("doc_id", "text"), model, ["doc_id"]).count() == 0


def test_language_stage(spark, docs):
    kept = langid.language_stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {90, 91, 92, 93} and set(range(60)) <= ids


def test_language_stage_keeps_mixed_texts(spark):
    """A text of four languages, each word plainly of one, has no language of half its words and stays."""
    words = {"a": ["thing", "where", "thore"], "b": ["lement", "queux", "eauoi"], "c": ["schiff", "zwicht", "ubungen"], "d": ["llamos", "ninado", "cajita"]}
    rng = np.random.default_rng(2)
    say = lambda lang, n: " ".join(rng.choice(words[lang], n))
    rows = [(i, say(lang, 40), lang) for lang in words for i in range(30)]
    mixed = " ".join(say(lang, n) for lang, n in (("a", 36), ("b", 32), ("c", 28), ("d", 24)))
    docs = spark.createDataFrame([*[(n, t, lang) for n, (_, t, lang) in enumerate(rows)], (999, mixed, "a"), (1000, "12 !?", "a")], "doc_id long, text string, lang string")
    ids = {r.doc_id for r in langid.language_stage(spark, docs, "").collect()}
    assert 999 in ids and 1000 not in ids
    score = {r.doc_id: r.score for r in langid.predict(docs, langid.train(docs, F.lit(True)), ["doc_id"]).collect()}
    assert score[999] < 0.5


def stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    count, cover = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_rule_statistics(docs, rows):
    got = quality.statistics(docs, ["doc_id"]).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((r[0], *stats(r[1])) for r in rows)


def test_forest_finds_odd_rows():
    rng = np.random.default_rng(0)
    usual = rng.normal(0, 1, (2000, 4))
    f = quality.Forest(np.vstack([usual, rng.normal(8, 1, (10, 4))]))
    assert f.score(rng.normal(8, 1, (50, 4))).min() > np.quantile(f.score(usual), 0.99)
    assert quality.Forest(np.zeros((0, 4))).score(usual).max() == 0


def test_quality(spark, sf, none):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.judge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), labels, ["doc_id"]).collect()
    assert all(not r.kept for r in got if r.base_failed) and any(r.kept for r in got)
    assert quality.judge(none, labels, ["doc_id"]).count() == 0


def test_quality_sees_repeated_words(spark):
    """Bad documents whose words repeat at once have the signs of good ones; the variety of words tells them."""
    rng = np.random.default_rng(4)
    words = [a + b for a in ("this", "tha", "ore", "wher", "stil") for b in ("nt", "ing", "er", "ly", "ow", "est")]
    text = lambda again: " ".join(w for w in rng.choice(words, 30, replace=False)[: 30 // again] for _ in range(again))
    rows = [(i, text(1)) for i in range(600)] + [(600 + i, text(5)) for i in range(10)] + [(700 + i, text(1) + " <|> ##" * 8) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 600), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels, ["doc_id"]).collect()}
    assert not any(got[600 + i].base_failed or got[600 + i].kept or got[700 + i].kept for i in range(10))
    assert all(0 <= r.anomaly <= 1 and r.kept == (not r.base_failed and r.anomaly < r.threshold) for r in got.values())
    assert sum(not got[i].kept for i in range(600)) <= 0.002 * 600


def test_scoring(spark, docs, rows):
    words, net = scoring.learn(docs)
    got = {(r.doc_id, r.n_tokens): r for r in scoring.score(docs, words, net).collect()}
    assert got[(91, 0)].log_likelihood == 0 and got[(91, 0)].mean_log is None
    before = {(r.doc_id, r.n_tokens): r for r in scoring.score(docs, words, scoring.Network()).collect()}
    keys = [k for k in got if k[1] > 20]
    assert np.mean([got[k].mean_log for k in keys]) > np.mean([before[k].mean_log for k in keys])
    again = scoring.learn(docs)[1]
    assert np.allclose(net.flat(), again.flat())


def test_scoring_does_not_follow_partitions(docs):
    """The same table in other partitions and another order of rows gives the same network and scores, over several shards, too."""
    other = docs.repartition(7, F.rand(1))
    for size in (scoring.SHARD_WORDS, 900):
        (words, net), (again, same) = (scoring.learn(d, shard_words=size) for d in (docs, other))
        assert np.array_equal(net.flat(), same.flat())
    a, b = (sorted((str(r.doc_id), r.n_tokens, r.log_likelihood) for r in scoring.score(d, words, net).collect()) for d in (docs, other))
    assert [x[:2] for x in a] == [x[:2] for x in b] and np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-2)


def test_drawn_positions(docs, rows):
    """Each round has about a tenth of all positions, in any number of shards the same examples; a document's copies of other ids draw their own."""
    words = scoring.learn(docs, rounds=0)[0]
    total, seen = sum(len((t or "").split()) for _, t, *_ in rows), []
    for shards in (1, 5):
        got = scoring.draw_examples(docs, words, shards, 2).collect()
        seen.append([sorted(np.concatenate([np.frombuffer(x.data, scoring.EXAMPLE) for x in got if x["round"] == r]).tolist(), key=str) for r in (0, 1)])
        assert sorted((x.shard, x["round"]) for x in got) == [(s, r) for s in sorted({x.shard for x in got}) for r in (0, 1)]
    for one, more in zip(*seen):
        assert str(one) == str(more) and abs(len(one) - 0.1 * total) < 0.02 * total
    copies = docs.sparkSession.createDataFrame([(i, " ".join(f"w{k}" for k in range(50))) for i in range(200)], "doc_id long, text string")
    got = scoring.draw_examples(copies, words, 1, 1).first().data
    assert len({x for x in np.frombuffer(got, scoring.EXAMPLE)["around"][:, 0].tolist()}) > 1


def test_every_position_is_trained_once(docs, rows):
    """The rounds of training together have each position of all documents once, with the tokens around it, runs of long documents, too."""
    words = scoring.learn(docs, rounds=0)[0]
    rows = [*rows, (1000, " ".join(f"w{k % 90}" for k in range(2 * scoring.RUN + 5)), None, None, 0)]
    more = docs.sparkSession.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = np.concatenate([np.frombuffer(x.data, scoring.EXAMPLE) for x in scoring.draw_examples(more, words, 3, scoring.ROUNDS).collect()])
    want = Counter()
    for _, t, *_ in rows:
        _, token, around = scoring.examples(*scoring.texts(scoring.pa.RecordBatch.from_pydict({"text": [t or ""]}), "text"), words)
        want.update(zip(token.tolist(), map(tuple, around.tolist())))
    assert Counter(zip(got["token"].tolist(), map(tuple, got["around"].tolist()))) == want and len(got) > 2 * scoring.RUN


def exact(net, around, token):
    """log p(token | around) by the definition, in double precision."""
    h = np.tanh(net.bias.astype(float) + sum(net.embed[around[k]].astype(float) * net.place[k] for k in range(2 * scoring.WINDOW)))
    g, i = divmod(int(token), scoring.GROUP)
    over = lambda x, at: x[at] - np.log(np.exp(x - x.max()).sum()) - x.max()
    return over(h @ net.group + net.group_bias, g) + over(h @ net.word[g] + net.word_bias[g], i)


def test_step_follows_finite_differences():
    rng, rate, eps = np.random.default_rng(8), 1e-7, 1e-5
    net = scoring.Network(seed=2)
    for name, shape in net.SHAPES.items():
        setattr(net, name, rng.normal(0, 0.3, shape))
    n = 40
    around, token = rng.integers(0, 12, (n, 2 * scoring.WINDOW)), rng.integers(0, 200, n)
    mean = lambda: np.mean([exact(net, a, t) for a, t in zip(around, token)])
    before = {name: getattr(net, name).copy() for name in net.SHAPES}
    net.step(around, token, rate)
    moved = {name: (getattr(net, name) - before[name]) / rate for name in net.SHAPES}
    for name, value in before.items():
        setattr(net, name, value)
    used = {"word": lambda: (rng.integers(0, 4), rng.integers(scoring.WIDTH), rng.integers(scoring.GROUP)), "word_bias": lambda: (rng.integers(0, 4), rng.integers(scoring.GROUP))}
    for name, shape in net.SHAPES.items():
        for _ in range(4 if name != "embed" else 0):
            at = used.get(name, lambda shape=shape: tuple(rng.integers(0, k) for k in shape))()
            value = getattr(net, name)
            start = value[at]
            value[at] = start + eps
            up = mean()
            value[at] = start - eps
            slope = (up - mean()) / (2 * eps)
            value[at] = start
            if name.startswith("word"):  # steps of a group are by its own rows
                slope *= n / max((token // scoring.GROUP == at[0]).sum(), n / scoring.GROUPS)
            assert moved[name][at] == pytest.approx(slope, rel=1e-3, abs=1e-6), name
    want = np.zeros_like(before["embed"])  # steps of a token are by its uses in a place; it reaches the network like the bias does, times its place
    for r in range(n):
        slope = np.empty(scoring.WIDTH)
        for i in range(scoring.WIDTH):
            start, ends = net.bias[i], []
            for net.bias[i] in (start + eps, start - eps):
                ends.append(exact(net, around[r], token[r]))
            net.bias[i] = start
            slope[i] = (ends[0] - ends[1]) / (2 * eps)
        for k in range(2 * scoring.WINDOW):
            want[around[r, k]] += slope * net.place[k] / max((around[:, k] == around[r, k]).sum(), 8)
    assert np.allclose(moved["embed"], want, atol=1e-5)


def test_scores_against_a_loop(docs, rows):
    """Summed log-probabilities of whole documents, word by word, in plain Python."""
    words, net = scoring.learn(docs)
    got = Counter()
    for r in scoring.score(docs, words, net).collect():
        got[(r.doc_id, r.n_tokens, round(r.log_likelihood, 1))] += 1
    token = {}
    for t in {w for _, text, *_ in rows for w in (text or "").split()}:
        h = scoring.Words(*scoring.texts(scoring.pa.RecordBatch.from_pydict({"text": [t]}), "text")).hash
        token[t] = int(words.tokens(h)[0])
    assert max(token.values()) < scoring.WORDS_KEPT
    for doc_id, text, *_ in [r for r in rows if len(r[1] or "") < 700]:
        ids = [token[w] for w in (text or "").split()]
        edge = [scoring.TOKENS] * scoring.WINDOW
        wide = [*edge, *ids, *edge]
        total = sum(exact(net, [wide[i - 1 + 2], wide[i - 2 + 2], wide[i + 1 + 2], wide[i + 2 + 2]], ids[i]) for i in range(len(ids)))
        near = [k for k in got if k[:2] == (doc_id, len(ids)) and abs(k[2] - total) < 0.11]
        assert near, (doc_id, total)


def test_scoring_is_a_distribution():
    net, rng = scoring.Network(seed=3), np.random.default_rng(0)
    around = np.repeat(rng.integers(0, scoring.TOKENS, (1, 2 * scoring.WINDOW)), scoring.TOKENS, axis=0)
    assert np.exp(net.log_probabilities(around, np.arange(scoring.TOKENS))).sum() == pytest.approx(1, abs=1e-3)


def test_scoring_empty(none):
    words, net = scoring.learn(none)
    assert scoring.score(none, words, net).count() == 0


def test_rare_words_have_their_own_probability(spark):
    """Words beyond the network's tokens: shares of a class are those of the full counts and sum to 1 with the unseen."""
    kept = [f"w{i}" for i in range(scoring.WORDS_KEPT)]
    rare = [f"rare{i}" for i in range(300)]
    texts = [" ".join(kept * 8)] + [" ".join(rare[: 300 // k]) for k in range(1, 6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words, net = scoring.learn(docs, rounds=0)
    count = Counter(w for t in texts for w in t.split())
    hashed = {w: scoring.Words(*scoring.texts(scoring.pa.RecordBatch.from_pydict({"text": [w]}), "text")).hash for w in [*rare, "unseen"]}
    token = {w: int(words.tokens(h)[0]) for w, h in hashed.items()}
    assert min(token.values()) >= scoring.WORDS_KEPT
    total = Counter()
    for w in rare:
        total[token[w]] += count[w]
    asked = spark.createDataFrame([(i, w) for i, w in enumerate(hashed)], "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in scoring.score(asked, words, net).collect()}
    edge = np.full((1, 2 * scoring.WINDOW), scoring.TOKENS)
    for i, w in enumerate(hashed):
        own = net.log_probabilities(edge, np.array([token[w]]))[0]
        assert got[i] == pytest.approx(own + np.log(max(count[w], 1) / (total[token[w]] + 1)), abs=2e-4)
    same = [(a, b) for a in rare[:60] for b in rare[150:] if token[a] == token[b]]
    assert same and all(got[rare.index(a)] > got[rare.index(b)] for a, b in same)


def test_chain_against_enumeration():
    """Posteriors, expected moves and their gradient against all label sequences."""
    from itertools import product

    rng = np.random.default_rng(5)
    n_lang, steps = 3, 4
    e, potentials, gold = rng.random((1, steps, n_lang)) + 0.05, rng.normal(size=(n_lang, n_lang)), (0, 2, 2, 1)

    def weights(m):
        t = np.exp(m) / np.exp(m).sum(1, keepdims=True)
        return t, {y: np.prod([e[0, i, y[i]] for i in range(steps)]) * np.prod([t[y[i - 1], y[i]] for i in range(1, steps)]) for y in product(range(n_lang), repeat=steps)}

    def loss(m):
        w = weights(m)[1]
        return -np.log(w[gold] / sum(w.values()))

    t, w = weights(potentials)
    total = sum(w.values())
    post, moves = langid.expected(e, t)
    for i in range(steps):
        for k in range(n_lang):
            assert post[0, i, k] == pytest.approx(sum(v for y, v in w.items() if y[i] == k) / total, abs=1e-9)
    made, want = np.zeros((n_lang, n_lang)), np.zeros((n_lang, n_lang))
    for i in range(1, steps):
        made[gold[i - 1], gold[i]] += 1
        for y, v in w.items():
            want[y[i - 1], y[i]] += v / total
    assert np.allclose(moves, want)
    got, eps = langid.moves_gradient(made, moves, t), 1e-6
    for i, j in product(range(n_lang), repeat=2):
        step = np.zeros((n_lang, n_lang))
        step[i, j] = eps
        assert got[i, j] == pytest.approx((loss(potentials + step) - loss(potentials - step)) / (2 * eps), abs=1e-6)
    flat = e[0].astype(np.float32)
    assert np.allclose(langid.posteriors(flat, t.astype(np.float32), np.array([0]), np.array([steps])), post[0], atol=1e-5)


def test_training_runs_come_from_whole_texts(spark):
    text = " ".join("start" if i < 3000 else "finish" for i in range(6000))
    docs = spark.createDataFrame([("a", 5, text), ("a", 6, "one two"), ("b", 7, "x" * 10_000), ("b", 8, "12 3"), ("b", 9, "")], "lang string, d long, text string")
    got = langid.runs(docs).collect()
    assert Counter(r.d for r in got) == {5: langid.TRAIN_RUNS, 6: 1}
    assert {w for r in got if r.d == 5 for w in r.text.split()} == {"start", "finish"} and all(len(r.text.split()) <= langid.STEP for r in got)
