"""LM scoring by masked pseudo-likelihood.

A small network, in numpy, predicts a token from WINDOW tokens on either side. All words counted over the corpus make
the vocabulary: the most frequent are tokens of the network, the others belong to hashed classes, and the probability of
such a word is that of its class, from the network, times its share of the class, from the table of all counts. The
table stays distributed and grows with the corpus: blocks of texts send their words to it and get log shares back.
All positions are dealt to shards and to rounds by hashes of the documents, so training does not follow partitions: each round
masks its own tenth, and after the last one every position of every document was a target once. Every shard trains on its
own, and after each round parameters are averaged over shards in a tree. Then every word of every
text is predicted from both sides, and the log-probabilities of a document are summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import SENT, dealt, hashed, n_buckets, send, split, texts, to_blocks, unpack
from .common import Words, lean, lean_group, materialize, mix, release, small_batches

WINDOW = 2
WIDTH = 16
GROUP = 64
#: Words of the vocabulary and hashed classes for all others; GROUP of either make a group of the two-step softmax.
WORDS_KEPT, HASHED = 4032, 64
TOKENS = WORDS_KEPT + HASHED
GROUPS = TOKENS // GROUP
#: Share of all positions that a round masks and trains on; in ROUNDS rounds each position is masked once.
MASKED = 0.1
ROUNDS = round(1 / MASKED)
BATCH = 2048
FAN = 32
#: Words of the corpus for each shard of training, and positions of a document that go to one shard together.
SHARD_WORDS, RUN = 4_000_000, 4096
COUNTED = np.dtype([("word", np.uint64), ("n", np.int64)])
EXAMPLE = np.dtype([("token", np.uint16), ("around", np.uint16, (2 * WINDOW,))])
#: A run of a document's words: the document, the run's first place in it, its number of words.
HEAD = np.dtype([("own", np.uint64), ("place", np.int64), ("n", np.int32)])
DEALT, STRIDE = "shard int, heads binary, tokens binary", np.uint64(0x9E3779B97F4A7C15)


def count_words(docs: DataFrame) -> DataFrame:
    """(word hash, count) over all words of all texts, summed a task before the shuffle."""
    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split(whole, "text", 8 << 20):
                keys, n = np.unique(Words(*texts(batch, "text")).hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Token numbers: frequent words by rank, others by hash. ``counts`` is the table of all words (word hash, count) and
    ``totals`` the occurrences of each class's words in it."""

    def __init__(self, hashes: list[int], counts: DataFrame | None = None):
        words = np.array(hashes, dtype=np.int64).view(np.uint64)
        order = np.argsort(words)
        self.words, self.rank = words[order], order
        self.counts, self.totals = counts, np.zeros(HASHED, np.int64)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "counts": None}  # the table stays with the driver

    def tokens(self, h: np.ndarray) -> np.ndarray:
        out = WORDS_KEPT + (mix(h) % np.uint64(HASHED)).astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            out[hit] = self.rank[at[hit]]
        return out

    def log_shares(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Log share of words that occur n times in their class. All words unseen in the corpus (0 times) count as one that
        occurs once, so shares of a class sum to 1."""
        return np.log(np.maximum(n, 1) / (self.totals[self.tokens(h) - WORDS_KEPT] + 1))


def _misses(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 at the place ``at`` of each row, less the softmax of the row; in place."""
    top = x.max()
    x -= top if top - x.min() < 80 else x.max(1, keepdims=True)  # the largest of all will do where no row's sum can vanish
    np.exp(x, out=x)
    x *= -1 / (x @ np.ones(x.shape[1], x.dtype))[:, None]
    x[np.arange(len(x)), at] += 1
    return x


def _log_softmax(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probabilities of the rows ``at`` of each column; columns lie side by side, so reductions run along memory."""
    x -= x.max(0)
    chosen = x[at, np.arange(len(at))].astype(np.float64)
    return chosen - np.log(np.exp(x, out=x).sum(0))


class Network:
    """Embeddings with a weight for each place in the window, one hidden layer, softmax over groups and within a group."""

    SHAPES = {"embed": (TOKENS + 1, WIDTH), "place": (2 * WINDOW, WIDTH), "bias": (WIDTH,), "group": (WIDTH, GROUPS), "group_bias": (GROUPS,), "word": (GROUPS, WIDTH, GROUP), "word_bias": (GROUPS, GROUP)}

    def __init__(self, flat: np.ndarray | None = None, seed: int = 5):
        rng = np.random.default_rng(seed)
        at = 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            value = flat[at : at + n].reshape(shape).copy() if flat is not None else (np.ones(shape) if name == "place" else np.zeros(shape) if "bias" in name else rng.normal(0, 0.1, shape))
            setattr(self, name, value.astype(np.float32))
            at += n

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.SHAPES])

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(self.bias, (len(around), WIDTH)).copy()
        for k in range(2 * WINDOW):
            total += self.embed[around[:, k]] * self.place[k]
        return np.tanh(total)

    def log_probabilities(self, around: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.empty(len(token))
        for at in range(0, len(token), 1 << 16):
            part = slice(at, at + (1 << 16))
            h, t = np.ascontiguousarray(self.hidden(around[part]).T), token[part]
            g = t // GROUP
            got = np.concatenate([_log_softmax(self.group.T @ h[:, i : i + 4096] + self.group_bias[:, None], g[i : i + 4096]) for i in range(0, len(t), 4096)])
            order = np.argsort(g, kind="stable")
            ends = np.searchsorted(g[order], np.arange(GROUPS + 1))
            h, t = np.ascontiguousarray(h[:, order]), t[order] % GROUP
            for k in np.flatnonzero(np.diff(ends)).tolist():
                low, high = int(ends[k]), int(ends[k + 1])
                for i in range(low, high, 4096):
                    j = min(high, i + 4096)
                    got[order[i:j]] += _log_softmax(self.word[k].T @ h[:, i:j] + self.word_bias[k][:, None], t[i:j])
            out[part] = got
        return out

    def step(self, around: np.ndarray, token: np.ndarray, rate: float) -> None:
        """One step of gradient ascent on the mean log-probability. Biases stand beside the weights they belong to, as of an input that is 1."""
        n, g = len(token), token // GROUP
        order = np.argsort(g.astype(np.uint16), kind="stable")  # rows of a group side by side
        around, g, t = around[order], g[order], token[order] % GROUP
        seen = [self.embed.take(around[:, k], axis=0) for k in range(2 * WINDOW)]
        h = np.ones((n, WIDTH + 1), self.embed.dtype)
        own = h[:, :WIDTH]
        np.tanh(sum((x * p for x, p in zip(seen, self.place)), start=self.bias), out=own)
        d = _misses(h @ np.vstack([self.group, self.group_bias]), g)
        back, up = d @ self.group.T, h.T @ d
        self.group += rate * up[:WIDTH] / n
        self.group_bias += rate * up[WIDTH] / n
        ends = np.searchsorted(g, np.arange(GROUPS + 1))
        used, e = np.flatnonzero(np.diff(ends)), np.empty((n, GROUP), h.dtype)
        spans = [(i, k, slice(ends[k], ends[k + 1])) for i, k in enumerate(used.tolist())]
        word, ups, backs = np.concatenate([self.word, self.word_bias[:, None]], 1), np.empty((len(used), WIDTH + 1, GROUP), h.dtype), np.empty_like(back)
        for _, k, rows in spans:
            np.matmul(h[rows], word[k], out=e[rows])
        e = _misses(e, t)
        for i, k, rows in spans:
            np.matmul(e[rows], self.word[k].T, out=backs[rows])
            np.matmul(h[rows].T, e[rows], out=ups[i])
        ups *= (rate / np.maximum(np.diff(ends)[used], n / GROUPS)).astype(h.dtype)[:, None, None]
        self.word[used] += ups[:, :WIDTH]
        self.word_bias[used] += ups[:, WIDTH]
        back += backs
        back *= 1 - own * own
        self.bias += rate * back.mean(0)
        ids, grads = np.empty((2 * WINDOW, n), np.int64), np.empty((2 * WINDOW, n, WIDTH), h.dtype)
        for k, x in enumerate(seen):
            ids[k] = around[:, k]
            share = (rate / np.maximum(np.bincount(ids[k]), 8)).astype(h.dtype)[ids[k]]
            np.multiply(back, self.place[k], out=grads[k])
            grads[k] *= share[:, None]
            self.place[k] += rate * np.einsum("ij,ij->j", back, x) / n
        at = (ids[:, :, None] * WIDTH + np.arange(WIDTH)).ravel()
        self.embed += np.bincount(at, grads.ravel(), self.embed.size).reshape(self.embed.shape).astype(h.dtype)


def examples(buf: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a buffer, their tokens, and the tokens around each; a document's edge is a token of its own."""
    words = Words(buf, offsets)
    token = vocabulary.tokens(words.hash)
    edge = TOKENS
    around = np.full((len(token), 2 * WINDOW), edge, np.int32)
    place = np.arange(len(token)) - words.first[words.doc]
    rest = words.count[words.doc] - 1 - place
    for k in range(1, WINDOW + 1):
        left, right = np.flatnonzero(place >= k), np.flatnonzero(rest >= k)
        around[left, k - 1] = token[left - k]
        around[right, WINDOW + k - 1] = token[right + k]
    return words, token, around


def deal_positions(docs: DataFrame, vocabulary: Vocabulary, shards: int, keep: str = "doc_id") -> DataFrame:
    """(shard, heads, tokens): all documents' words as tokens, in runs of up to RUN, each with WINDOW tokens on either side, dealt to
    shards by a hash of the document's ``keep`` value and text and the run's number: how rows lie in partitions plays no part."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # WORDS_KEPT hashes

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split(whole, "text", 2 << 20):
                words = Words(*texts(batch, "text"))
                token, own, runs = shared.value.tokens(words.hash), mix(batch.column(0).to_numpy().view(np.uint64)), -(-words.count // RUN)
                if not len(token):
                    continue
                doc = np.repeat(np.arange(len(runs)), runs)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
                heads = np.empty(len(doc), HEAD)
                heads["own"], heads["place"], heads["n"] = own[doc], number * RUN, np.minimum(RUN, words.count[doc] - number * RUN)
                order, ends = dealt(hashed(mix(heads["own"] + number.astype(np.uint64) + np.uint64(1)), shards), shards)
                heads, first, last = heads[order], words.first[doc[order]], (words.first + words.count)[doc[order]]
                size = heads["n"] + 2 * WINDOW
                upto = np.append(0, np.cumsum(size))
                at = np.arange(upto[-1]) + np.repeat(first + heads["place"] - WINDOW - upto[:-1], size)
                inside = (at >= np.repeat(first, size)) & (at < np.repeat(last, size))
                wide = np.where(inside, token[np.clip(at, 0, len(token) - 1)], TOKENS).astype(np.uint16)
                used = np.flatnonzero(np.diff(ends))
                parts = [(heads[ends[b] : ends[b + 1]].tobytes(), wide[upto[ends[b]] : upto[ends[b + 1]]].tobytes()) for b in used]
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(x, pa.binary()) for x in zip(*parts)]], ["shard", "heads", "tokens"])

    @lean_group
    def pack(table: pa.Table) -> pa.Table:
        return pa.table({"shard": table["shard"][:1], **{c: pa.array([b"".join(x.as_py() for x in table[c])], pa.binary()) for c in ("heads", "tokens")}})

    keyed = docs.select(F.xxhash64(keep, "text").alias("key"), "text")
    return keyed.mapInArrow(deal, DEALT).groupBy("shard").applyInArrow(pack, DEALT)


def round_examples(heads: bytes, tokens: bytes, number: int) -> np.ndarray:
    """A round's examples of a shard in the order of their keys. A position's key comes from its document and its place there and tells its
    round, so each is a target in one of ROUNDS rounds; positions of equal keys are of copies, and have equal examples."""
    heads, tokens = np.frombuffer(heads, HEAD), np.frombuffer(tokens, np.uint16)
    low, high = (np.uint64(round(min(1.0, MASKED * r) * 2**32)) for r in (number, number + 1))
    upto = np.append(0, np.cumsum(heads["n"], dtype=np.int64))
    keys, found, run = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while run < len(heads):
        end = max(run + 1, int(np.searchsorted(upto, upto[run] + (1 << 16), side="right")) - 1)
        n = heads["n"][run:end]
        place = np.arange(upto[run], upto[end]) - np.repeat(upto[run:end], n)
        key = mix(np.repeat(heads["own"][run:end] + heads["place"][run:end].astype(np.uint64) * STRIDE, n) + place.astype(np.uint64) * STRIDE)
        at = np.flatnonzero((key >> np.uint64(32) >= low) & (key >> np.uint64(32) < high))
        keys.append(key[at])
        found.append(at + upto[run] + np.repeat(np.arange(run, end) * 2 * WINDOW + WINDOW, n)[at])
        run = end
    at = np.concatenate(found)[np.argsort(np.concatenate(keys))]
    rows = np.empty(len(at), EXAMPLE)
    rows["token"] = tokens[at]
    for k in range(1, WINDOW + 1):
        rows["around"][:, k - 1], rows["around"][:, WINDOW + k - 1] = tokens[at - k], tokens[at + k]
    return rows


def draw_examples(docs: DataFrame, vocabulary: Vocabulary, shards: int, rounds: int, keep: str = "doc_id") -> DataFrame:
    """(shard, round, data): the examples of the first rounds, packed in the order in which they train."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for number in range(rounds):
                    data = round_examples(row["heads"], row["tokens"], number).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([row["shard"]], pa.int32()), pa.array([number], pa.int32()), pa.array([data], pa.binary())], ["shard", "round", "data"])

    return deal_positions(docs, vocabulary, shards, keep).mapInArrow(run, "shard int, round int, data binary")


def learn(docs: DataFrame, rounds: int = ROUNDS, keep: str = "doc_id", shard_words: int = SHARD_WORDS) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of a corpus: rounds of training, each position of all documents in one of them, each shard from the last average.

    The number of shards follows the number of words, and what a shard holds and in which order follows the documents, so
    the network is that of the table, however it is partitioned."""
    spark = docs.sparkSession
    counts = materialize(count_words(docs))
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS_KEPT).collect()  # WORDS_KEPT rows
    vocabulary, net = Vocabulary([r["word"] for r in top], counts), Network()
    for r in class_totals(counts, vocabulary).collect():  # HASHED rows
        vocabulary.totals[r["class"]] = r["n"]
    small_batches(spark)
    if rounds == 0:
        return vocabulary, net
    shards = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // shard_words))
    used: list[str] = []
    held = materialize(deal_positions(docs, vocabulary, shards, keep), used)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(net.flat())  # of fixed size

        @lean
        def train(batches: Iterator[pa.RecordBatch], number: int = number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, heads, tokens in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    own, rows = Network(shared.value), round_examples(heads.as_py(), tokens.as_py(), number)
                    for steps, at in enumerate(range(0, len(rows), BATCH), 1):
                        some = rows[at : at + BATCH]
                        own.step(some["around"].astype(np.int32), some["token"].astype(np.int64), (0.7 if number == 0 else 0.35) / (1 + steps / 400) ** 0.5)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([float(len(rows))]), pa.array([own.flat().astype(np.float32).tobytes()], pa.binary())], ["part", "weight", "flat"])

        @lean_group
        def average(table: pa.Table) -> pa.Table:
            part, weight = table["part"].to_numpy(), table["weight"].to_numpy()
            total = np.zeros(len(table["flat"][0].as_py()) // 4)
            for i in np.argsort(part):  # in order, so that reruns agree
                total += weight[i] * np.frombuffer(table["flat"][int(i)].as_py(), np.float32)
            return pa.table({"part": pa.array([int(part.min()) // FAN], pa.int64()), "weight": pa.array([float(weight.sum())]), "flat": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())})

        level = materialize(held.mapInArrow(train, "part long, weight double, flat binary"), used)
        while level.count() > 1:
            level = materialize(level.groupBy(F.expr(f"part div {FAN}").alias("_up")).applyInArrow(average, "part long, weight double, flat binary"), used)
        row = level.first()
        if row is None:
            break
        net = Network(np.frombuffer(row["flat"], np.float32))
    release(spark, used)
    return vocabulary, net


def class_totals(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(class, n): occurrences of the words of each hashed class."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)  # WORDS_KEPT hashes

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(TOKENS, np.int64)
        for batch in batches:
            np.add.at(n, shared.value.tokens(batch.column(0).to_numpy().view(np.uint64)), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(HASHED)), pa.array(n[WORDS_KEPT:])], ["class", "n"])

    return counts.select("word", "n").mapInArrow(run, "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))


def rest_words(words: Words, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of words that have no token of their own, their distinct hashes, and which of these each is."""
    at = np.flatnonzero(token >= WORDS_KEPT)
    return at, *np.unique(words.hash[at], return_inverse=True)


def shares(blocks: DataFrame, vocabulary: Vocabulary, buckets: int) -> DataFrame:
    """(block, replies): for the distinct words of a block that have no token of their own, their log shares of their
    classes. Words and the table of counts meet in hash buckets."""
    shared = blocks.sparkSession.sparkContext.broadcast(vocabulary)  # WORDS_KEPT hashes

    @lean
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = Words(*texts(unpack(data.as_py()), "text"))
                keys = rest_words(words, shared.value.tokens(words.hash))[1]
                yield from send(block, hashed(keys, buckets), keys, buckets)

    @lean
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(have)
            yield from send(-1, hashed(rows["word"], buckets), rows, buckets)

        for batch in batches:
            rows = np.empty(batch.num_rows, COUNTED)
            rows["word"], rows["n"] = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            have.append(rows[shared.value.tokens(rows["word"]) >= WORDS_KEPT])
            size += batch.num_rows
            if size >= 1 << 18:
                yield from flush()
                have, size = [], 0
        if have:
            yield from flush()

    @lean_group
    def bucket(table: pa.Table) -> pa.Table:
        block, data = table["block"].to_pylist(), [x.as_py() for x in table["data"]]
        known = np.concatenate([np.zeros(0, COUNTED), *[np.frombuffer(x, COUNTED) for b, x in zip(block, data) if b < 0]])
        known = known[np.argsort(known["word"])]
        to, logs = [], []
        for b, x in zip(block, data):
            if b >= 0:
                keys, n = np.frombuffer(x, np.uint64), 0
                if len(known):
                    at = np.minimum(np.searchsorted(known["word"], keys), len(known) - 1)
                    n = np.where(known["word"][at] == keys, known["n"][at], 0)
                to.append(b)
                logs.append(shared.value.log_shares(keys, n).tobytes())
        return pa.table({"block": pa.array(to, pa.int64()), "bucket": pa.array([table["bucket"][0].as_py()] * len(to), pa.int32()), "logs": pa.array(logs, pa.binary())})

    asked = blocks.select("block", "data").mapInArrow(ask, SENT)
    if vocabulary.counts is not None:
        asked = asked.unionByName(vocabulary.counts.select("word", "n").mapInArrow(tell, SENT))
    return asked.groupBy("bucket").applyInArrow(bucket, "block long, bucket int, logs binary").groupBy("block").agg(F.collect_list(F.struct("bucket", "logs")).alias("replies"))


def score(docs: DataFrame, vocabulary: Vocabulary, net: Network, keep: str = "doc_id") -> DataFrame:
    """``keep`` + n_tokens, log_likelihood (sum over all words of log p(word | both sides)), mean_log for every row.

    A null text or one without words has no tokens, sum 0 and a null mean.
    """
    blocks = to_blocks(docs.select(keep, "text"))
    buckets = n_buckets(blocks)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, net.flat()))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = shared.value
        own = Network(flat)
        for row in (r for batch in batches for r in batch.to_pylist()):
            batch = unpack(row["data"])
            words, token, around = examples(*texts(batch, "text"), vocabulary)
            at, keys, which = rest_words(words, token)
            (order, ends), share = dealt(hashed(keys, buckets), buckets), np.zeros(len(keys))
            for x in row["replies"] or []:
                share[order[ends[x["bucket"]] : ends[x["bucket"] + 1]]] = np.frombuffer(x["logs"])
            logs = own.log_probabilities(around, token)
            logs[at] += share[which]
            sums, some = np.zeros(len(words.count)), words.count > 0
            if some.any():
                sums[some] = np.round(np.add.reduceat(logs, words.first[some]), 4)
            mean = pa.array(np.where(words.count > 0, sums / np.maximum(words.count, 1), 0.0), mask=words.count == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.count), pa.array(sums), mean], [keep, "n_tokens", "log_likelihood", "mean_log"])

    kind = docs.schema[keep].dataType.simpleString()
    return blocks.select("block", "data").join(shares(blocks, vocabulary, buckets), "block", "left").select("data", "replies").mapInArrow(run, f"`{keep}` {kind}, n_tokens long, log_likelihood double, mean_log double")


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log of every document. Null, empty and wordless texts have no tokens, sum 0 and a null mean;
    repeated rows and repeated ids are scored each, texts of any length whole; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, *learn(docs))
