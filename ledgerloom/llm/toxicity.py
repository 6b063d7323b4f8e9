"""Toxicity by a counterfactual-regularised classifier.

A document is a bag of sentences, a sentence a set of words, a word a set of hashed features (itself, its beginnings and
ends). Features that stand surely more often in sentences of toxic documents are known; a sentence with a known feature has a
logit, the sum of its words' weights and a bias, and a document is toxic if any of its sentences is (noisy or), so labels of
documents teach sentences and one toxic sentence counts in a text of any length. Weights start at the log-odds of their feature and are
held near them, as else a word would teach nothing in documents that another word explains. For labelled sentences
that name a group the term is swapped for others of its kind, and words of random sentences give way to a term; the
squared change of the logit is penalised. Fitted on a bounded sample of labelled rows on the driver; every text is
scored whole, a batch at a time, on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .blocks import split, texts
from .common import BASES, BYTE_CODES, Words, lean, materialize, mix, prefix_hash, small_batches, span_hash, tidy
from .langid import NOT_LETTER, fold_case

#: Bound of the sample the model is fitted on: documents a label, and bytes of one.
TRAIN_DOCS, TRAIN_BYTES = 1500, 1 << 15
BUCKETS = 1 << 18
#: Beginnings and ends of words that are features, in bytes.
FRONTS, BACKS = (3, 4, 5, 6, 7, 8), (3, 4, 5)
#: Bytes that end a sentence.
STOPS = np.zeros(256, dtype=bool)
STOPS[[10, 13, 33, 46, 63]] = True
THRESHOLD = 0.3

#: Standard errors that a feature's count must stand above chance, log-odds that it then needs, and share of them that its weight starts at.
SURE, ODDS, SHARE = 2.0, 2.0, 0.4

#: Terms for groups of people, by kind; a term is swapped for others of its kind.
IDENTITY_TERMS = {
    "gender": "women men woman man female male girls boys femmes hommes mujeres hombres frauen männer transgender",
    "faith": "muslims muslim christians christian jews jewish hindus hindu buddhists atheists musulmans chrétiens juifs musulmanes cristianos judíos muslime christen juden",
    "origin": "immigrants immigrant refugees refugee foreigners africans african asians asian europeans mexicans arabs black white migrants étrangers inmigrantes refugiados ausländer flüchtlinge",
    "love": "gay lesbian straight bisexual homosexual heterosexual gays lesbians homosexuels homosexuales homosexuelle",
    "body": "disabled blind deaf elderly young old handicapés discapacitados behinderte",
}


def terms(kinds: dict[str, str] | None = None) -> list[list[bytes]]:
    return [[fold_case(np.frombuffer(t.encode(), np.uint8)).tobytes() for t in words.split()] for words in (IDENTITY_TERMS if kinds is None else kinds).values()]


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, and how many of them come before each word's: itself, its fronts and backs."""
    prefix = prefix_hash(BYTE_CODES[buf], BASES[0])
    size, every = end - start, np.arange(len(start))
    word, found = [], []
    for kind, at, s, e in [(0, every, start, end), *((k, x, start[x], start[x] + k) for k in FRONTS for x in (np.flatnonzero(size >= k),)), *((20 + k, x, end[x] - k, end[x]) for k in BACKS for x in (np.flatnonzero(size >= k),))]:
        word.append(at)
        found.append((mix(span_hash(prefix, s, e, BASES[0]) + np.uint64(kind * 0x9E3779B1)) & np.uint64(BUCKETS - 1)).astype(np.int64))
    word, found = np.concatenate(word), np.concatenate(found)
    order = np.argsort(word, kind="stable")
    return found[order], np.searchsorted(word[order], every)


@dataclass
class Bags:
    """Texts as sentences of distinct words: for each (sentence, word) pair the sentence and the kind of word, features once a kind."""

    sentence: np.ndarray
    kind: np.ndarray
    doc: np.ndarray  # of each sentence
    feature: np.ndarray
    first: np.ndarray  # of each kind, in feature
    kinds: dict[bytes, int] = field(default_factory=dict)

    @classmethod
    def of(cls, buf: np.ndarray, offsets: np.ndarray, more: list[bytes] = (), named: bool = False) -> Bags:
        """``more``: words that get a kind though no text has them; ``named``: kinds can be looked up by their bytes."""
        n_docs = len(offsets) - 1
        if more:
            extra = b" ".join(more)
            buf = np.concatenate([buf, np.frombuffer(extra, np.uint8)])
            offsets = np.append(offsets, len(buf))
        words = Words(buf, offsets, gap=NOT_LETTER)
        _, at, kind = np.unique(words.hash, return_index=True, return_inverse=True)
        size = words.end[at] - words.start[at]
        upto = np.cumsum(size)
        plain = buf[np.repeat(words.start[at] - upto + size, size) + np.arange(size.sum())]  # each kind's bytes once
        feature, first = features(plain, upto - size, upto)
        stops = np.concatenate([[0], np.cumsum(STOPS[buf], dtype=np.int32)])
        real = np.flatnonzero(words.doc < n_docs)
        cut = stops[words.start[real]] + words.doc[real]  # grows from sentence to sentence and from text to text
        begins = np.append(True, cut[1:] != cut[:-1]) if len(cut) else np.zeros(0, bool)
        sentence = np.cumsum(begins) - 1
        pair = np.unique(sentence.astype(np.int64) * max(1, len(at)) + kind[real]) if len(real) else np.zeros(0, np.int64)
        kinds = {buf[words.start[a] : words.end[a]].tobytes(): k for k, a in enumerate(at.tolist())} if named else {}
        return cls(pair // max(1, len(at)), pair % max(1, len(at)), words.doc[real][begins], feature, first, kinds)

    def weigh(self, weights: np.ndarray) -> np.ndarray:
        """Weight of each kind of word."""
        return np.add.reduceat(weights[self.feature], self.first) if len(self.first) else np.zeros(0, weights.dtype)

    def known(self, weights: np.ndarray) -> Bags:
        """Only words with a feature that has a weight, and their sentences."""
        if not len(self.kind):
            return self
        word = (np.add.reduceat((weights[self.feature] != 0).astype(np.int64), self.first) > 0)[self.kind]
        kept = np.unique(self.sentence[word])
        return replace(self, sentence=np.searchsorted(kept, self.sentence[word]), kind=self.kind[word], doc=self.doc[kept])

    def logits(self, kinds: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.sentence, weights=kinds[self.kind], minlength=len(self.doc))


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def clean_chance(logits: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Logarithm of the chance that no sentence of a document is toxic; 0 without sentences."""
    return -np.bincount(doc, weights=np.logaddexp(0, np.clip(logits, -60, 60)), minlength=n_docs)


def swaps(bags: Bags, groups: list[list[bytes]], seed: int = 11, insertions: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of kinds (in the sentence, in its counterfactual): every term of a sentence against all others of its kind, and ``insertions`` words of random sentences against a random term."""
    old, new = [], []
    for group in groups:
        ids = np.array(sorted({bags.kinds[t] for t in group if t in bags.kinds}))
        held = bags.kind[np.isin(bags.kind, ids)]
        old.append(np.repeat(held, len(ids)))
        new.append(np.tile(ids, len(held)))
    every = np.array(sorted({bags.kinds[t] for g in groups for t in g if t in bags.kinds}))
    if len(every) and len(bags.kind):
        rng = np.random.default_rng(seed)
        old.append(bags.kind[rng.integers(0, len(bags.kind), insertions)])
        new.append(every[rng.integers(0, len(every), insertions)])
    old, new = (np.concatenate(x) if x else np.zeros(0, int) for x in (old, new))
    return old[old != new], new[old != new]


def loss(model: Model, bags: Bags, toxic: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], fair: float, weight: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Mean loss, its gradient by weights and by the bias: noisy-or likelihood of the documents and ``fair`` times the mean squared change of a swap."""
    u = bags.weigh(model.weights)
    z = bags.logits(u, model.bias)
    clean = np.minimum(clean_chance(z, bags.doc, len(toxic)), -1e-12)
    p = -np.expm1(clean)
    total = weight.sum()
    value = -(weight * np.where(toxic, np.log(np.maximum(p, 1e-300)), clean)).sum() / total
    s = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    pull = weight * np.where(toxic, -np.exp(clean) / np.maximum(p, 1e-12), 1.0) / total
    g = s * pull[bags.doc]
    gu = np.bincount(bags.kind, weights=g[bags.sentence], minlength=len(u))
    old, new = pairs
    if len(old):
        change = u[old] - u[new]
        value += fair * (change**2).mean()
        step = 2 * fair * change / len(old)
        gu += np.bincount(old, weights=step, minlength=len(u)) - np.bincount(new, weights=step, minlength=len(u))
    each = np.repeat(gu, np.diff(np.append(bags.first, len(bags.feature))))
    return value, np.bincount(bags.feature, weights=each, minlength=len(model.weights)), g.sum()


def evidence(bags: Bags, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of features, from distinct sentences of toxic documents against those of others, so that copies count once; 0 where they are not sure."""
    code = mix(np.arange(1, len(bags.first) + 1, dtype=np.uint64))
    mark = np.zeros(len(bags.doc), np.uint64)
    np.add.at(mark, bags.sentence, code[bags.kind])
    found = []
    for side in (True, False):
        mine = np.flatnonzero(toxic[bags.doc] == side)
        kept = np.zeros(len(bags.doc), bool)
        kept[mine[np.unique(mark[mine], return_index=True)[1]]] = True
        count = np.bincount(bags.kind[kept[bags.sentence]], minlength=len(bags.first))
        found.append((np.bincount(bags.feature, weights=np.repeat(count, np.diff(np.append(bags.first, len(bags.feature)))), minlength=BUCKETS), max(1, kept.sum())))
    (a, n_a), (b, n_b) = found
    odds = np.log(np.maximum(a - SURE * np.sqrt(a), 1e-9) / n_a) - np.log((b + SURE * np.sqrt(b) + 1) / n_b)
    return np.where(odds > ODDS, odds, 0.0)


def fit(rows: list[tuple[str, int]], groups: list[list[bytes]] | None = None, fair: float = 0.05, hold: float = 1e-3, rounds: int = 120, rate: float = 0.5) -> Model:
    """Fit on (text, label) rows: known features alone, held to their log-odds by ``hold``, swaps penalised by ``fair``."""
    groups = terms() if groups is None else groups
    toxic = np.array([label for _, label in rows], dtype=bool)
    if not toxic.any() or toxic.all():
        return Model(np.zeros(BUCKETS), -8.0)
    texts_ = [t.encode() for t, _ in rows]
    bags = Bags.of(fold_case(np.frombuffer(b"".join(texts_), np.uint8)), np.concatenate([[0], np.cumsum([len(x) for x in texts_])]), [t for g in groups for t in g], named=True)
    if not len(bags.kind):
        return Model(np.zeros(BUCKETS), -8.0)
    pairs, start = swaps(bags, groups), SHARE * evidence(bags, toxic)
    bags, used = bags.known(start), start > 0
    weight = np.sqrt(np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())))
    model = Model(start.copy(), -8.0)
    for i in range(rounds if used.any() else 0):
        _, g, g_bias = loss(model, bags, toxic, pairs, fair, weight)
        g = (g + hold * (model.weights - start)) * used
        step = rate / max(np.abs(g).max(), 3e-3) * (1 - i / rounds) ** 0.5
        model.weights -= step * g
        model.bias = min(model.bias - 0.2 * step * g_bias, -5.0)
    return model


def train(docs: DataFrame, labels: DataFrame, trainable) -> Model:
    """Fit on at most TRAIN_DOCS labelled documents a label of at most TRAIN_BYTES bytes, by a hash of doc_id.

    A doc_id with several rows of labels takes its largest; null labels, null texts and null doc_ids teach nothing.
    ``trainable`` is a condition on doc_id. The labels are drawn first, so that only drawn texts leave their tasks.
    """
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    marks = labels.filter("toxic is not null and doc_id is not null").filter(trainable).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return Model(np.zeros(BUCKETS), -8.0)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.3 * TRAIN_DOCS / n)))])
    drawn = materialize(marks.filter(draw < F.element_at(share, F.col("toxic")) * (1 << 30)).withColumn("_d", draw))
    usable = docs.filter(F.octet_length("text") <= TRAIN_BYTES).select("doc_id", "text")
    picked = usable.join(drawn, "doc_id").select("toxic", "_d", "text").collect()
    found: dict[int, list[tuple[str, int]]] = {}
    for r in sorted(picked, key=lambda r: (r["_d"], r["text"])):
        mine = found.setdefault(r["toxic"], [])
        if len(mine) < TRAIN_DOCS:
            mine.append((r["text"], r["toxic"]))
    model = fit([x for k in sorted(found) for x in found[k]])
    tidy()
    return model


def score(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("score", "predicted"), threshold: float = THRESHOLD) -> DataFrame:
    """The columns in ``keep`` + the chance that a text is toxic and whether it reaches the threshold, for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))  # BUCKETS weights

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for whole in batches:
            for batch in split(whole, "text", 1 << 20):
                buf, offsets = texts(batch, "text")
                bags = Bags.of(fold_case(buf), offsets).known(weights)
                p = np.clip(-np.expm1(clean_chance(bags.logits(bags.weigh(weights), bias), bags.doc, batch.num_rows)), 0, 1)
                cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], [*keep, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep]
    keep = [f.name for f in docs.schema if f.name in keep]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{names[0]}` double", f"`{names[1]}` int"]))


def held_out_rows():
    """crc32(doc_id as text) mod 4 = 2; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; texts without a known feature, null and empty ones among them, score 0.

    Repeated rows give repeated rows, texts of any length are scored whole, an empty table gives an empty result; without
    labels of both kinds nothing is learned and every text scores 0.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels, ~held_out_rows())
    return score(docs.select("doc_id", held_out_rows().alias("held_out"), "text"), model, ["doc_id", "held_out"])
