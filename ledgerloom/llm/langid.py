"""Language ID of code-switched text by a linear-chain conditional random field.

Words are runs of letters. Affixes, inner n-grams and a lexicon of frequent words, hashed into one weight table, give
each word a potential for each language; learned transitions link neighbours. The model is fitted on a bounded sample
of labelled rows on the driver (AdaGrad on the log-likelihood, with expected moves from forward and backward messages), with
sequences that switch between documents of different languages so that transitions learn both to stay and to switch. Workers label every word of every text by
forward-backward; a document's language has the largest sum of word posteriors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F

from .blocks import split, texts
from .common import BASES, BYTE_CODES, Words, fresh, lean, mix, prefix_hash, small_batches, span_hash

#: Bound of the sample the model is fitted on: documents a language, runs of words from all over each, words and bytes of a run.
TRAIN_DOCS = 400
TRAIN_RUNS, STEP, TRAIN_BYTES = 6, 40, 4096
#: Most languages a model can have: those with the most labelled rows.
MAX_LANGUAGES = 200
BUCKETS = 1 << 17
PIECE = 256

NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def fold_case(buf: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 capitals, in UTF-8."""
    out = buf + ((buf >= 65) & (buf <= 90)).astype(np.uint8) * np.uint8(32)
    if len(buf) > 1:
        latin = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
        out[latin] += 32
    return out


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: (word index, bucket), words ascending."""
    prefix = prefix_hash(BYTE_CODES[buf], BASES[0])
    word, found = [], []

    def add(kind: int, at: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        h = mix(span_hash(prefix, s, e, BASES[0]) + np.uint64(kind * 0x9E3779B1))
        word.append(at)
        found.append((h & np.uint64(BUCKETS - 1)).astype(np.int32))

    every = np.arange(len(start))
    add(0, every, start, end)  # the lexicon: whole words
    for k in (1, 2, 3, 4):
        longer = np.flatnonzero(end - start >= k)
        add(k, longer, start[longer], start[longer] + k)
        add(10 + k, longer, end[longer] - k, end[longer])
    for k in (2, 3):
        n = np.maximum(end - start - k + 1, 0)
        owner = np.repeat(every, n)
        at = start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        add(20 + k, owner, at, at + k)
    word, found = np.concatenate(word), np.concatenate(found)
    order = np.argsort(word, kind="stable")
    return word[order], found[order]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    moves: np.ndarray  # log potentials, from x to

    def potentials(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sum of feature weights of each word."""
        word, bucket = features(buf, start, end)
        out = np.zeros((len(start), self.weights.shape[1]), np.float32)
        if len(start):
            first = np.searchsorted(word, np.arange(len(start)))
            out = np.add.reduceat(self.weights[bucket], first, axis=0)
        return out


def _chain(e: np.ndarray, t: np.ndarray, alpha0: np.ndarray, beta0: np.ndarray) -> np.ndarray:
    """Posteriors of sequences e (n, steps, languages) under moves t; alpha0 comes before the first, beta0 after the last."""
    steps = e.shape[1]
    alpha = np.empty_like(e)
    a = alpha0
    for i in range(steps):
        a = a * e[:, i]
        a /= a.sum(1, keepdims=True)
        alpha[:, i] = a
        a = a @ t
    b = beta0
    for i in range(steps - 1, -1, -1):
        alpha[:, i] *= b
        b = (b * e[:, i]) @ t.T
        b /= b.sum(1, keepdims=True)
    return alpha / alpha.sum(2, keepdims=True)


def expected(e: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of sequences e (n, steps, languages) and how often each move is expected in all of them, first words at even odds."""
    n, steps, n_lang = e.shape
    alpha, moves = np.empty_like(e), np.zeros((n_lang, n_lang))
    a = np.full((n, n_lang), 1 / n_lang, e.dtype)
    for i in range(steps):
        a = (a @ t if i else a) * e[:, i]
        a /= a.sum(1, keepdims=True)
        alpha[:, i] = a
    b, post = np.ones((n, n_lang), e.dtype), np.empty_like(e)
    for i in range(steps - 1, -1, -1):
        post[:, i] = alpha[:, i] * b
        if i:
            b = b * e[:, i]
            pair = alpha[:, i - 1, :, None] * t * b[:, None, :]
            moves += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
            b = b @ t.T
            b /= b.sum(1, keepdims=True)
    return post / post.sum(2, keepdims=True), moves


def moves_gradient(made: np.ndarray, expect: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gradient of the negative log-likelihood by the log potentials of moves, whose softmax by rows is t."""
    g = expect - made
    return g - t * g.sum(1, keepdims=True)


def posteriors(e: np.ndarray, moves: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Exact forward-backward over all words of documents of any length: pieces of PIECE words run side by side.

    Documents of more than one piece pass their messages on by the pieces' transfer matrices. Absent words of a last
    piece have the potential 1 for all and are cut off; ``moves`` rows sum to 1, so they change no message.
    """
    n_lang = e.shape[1]
    out = np.zeros_like(e)
    pieces = (count + PIECE - 1) // PIECE
    if not pieces.sum():
        return out
    doc = np.repeat(np.arange(len(count)), pieces)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = first[doc] + place * PIECE
    size = np.minimum(PIECE, count[doc] - place * PIECE)
    grid = np.ones((len(doc), int(size.max()), n_lang), np.float32)
    row = np.repeat(np.arange(len(doc)), size)
    col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    word = begin[row] + col
    grid[row, col] = e[word]
    alpha0 = np.full((len(doc), n_lang), 1 / n_lang, np.float32)
    beta0 = np.ones((len(doc), n_lang), np.float32)
    long = np.flatnonzero(pieces[doc] > 1)
    if len(long):
        part = grid[long]
        m = np.broadcast_to(np.eye(n_lang, dtype=np.float32), (len(long), n_lang, n_lang)).copy()
        for i in range(part.shape[1]):
            if i:
                m = (m.reshape(-1, n_lang) @ moves).reshape(len(long), n_lang, n_lang)
            m = m * part[:, i][:, None, :]
            m /= m.sum((1, 2), keepdims=True)
        at = np.full(len(doc), -1)
        at[long] = np.arange(len(long))
        for p in range(int(pieces.max()) - 1):
            here = np.flatnonzero((place == p) & (place + 1 < pieces[doc]))
            a = np.einsum("pi,pij->pj", alpha0[here], m[at[here]]) @ moves
            alpha0[here + 1] = a / a.sum(1, keepdims=True)
        for p in range(int(pieces.max()) - 1, 0, -1):
            here = np.flatnonzero(place == p)
            b = np.einsum("pij,pj->pi", m[at[here]], beta0[here]) @ moves.T
            beta0[here - 1] = b / b.sum(1, keepdims=True)
    out[word] = _chain(grid, moves, alpha0, beta0)[row, col]
    return out


def _stochastic(moves: np.ndarray) -> np.ndarray:
    """Log potentials as moves whose rows sum to 1."""
    m = np.exp(moves - moves.max(1, keepdims=True))
    return (m / m.sum(1, keepdims=True)).astype(np.float32)


def _scaled(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.exp(x - x.max(-1, keepdims=True)), 1e-20).astype(np.float32)


def fit(rows: list[tuple[str, str]], seed: int = 7, epochs: int = 6, batch: int = 64) -> Model:
    """Fit on (text, language) rows, each labelled as a whole: sequences of STEP words that may switch in between."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in rows})
    n_lang = len(languages)
    model = Model(languages, np.zeros((BUCKETS, max(1, n_lang)), np.float32), np.zeros((max(1, n_lang),) * 2))
    if n_lang < 2:
        return model
    known = [t.encode() for t, _ in rows]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in known])])
    buf = fold_case(np.frombuffer(b"".join(known), np.uint8))
    words = Words(buf, offsets, gap=NOT_LETTER)
    label = np.array([languages.index(lang) for _, lang in rows])[words.doc]
    parts = []  # runs of 8 to 40 words of one document
    for f, n in zip(words.first, words.count):
        f, n, at = int(f), int(n), 0
        while at < n:
            k = min(int(rng.integers(8, STEP + 1)), n - at)
            parts.append(np.arange(f + at, f + at + k))
            at += k
    rng.shuffle(parts)
    flow = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    flow = flow[: len(flow) // STEP * STEP].reshape(-1, STEP)
    _, first, kind = np.unique(words.hash, return_index=True, return_inverse=True)  # features once a distinct word
    word, bucket = features(buf, words.start[first], words.end[first])
    lo, hi = np.searchsorted(word, np.arange(len(first)))[kind], np.searchsorted(word, np.arange(len(first)), side="right")[kind]
    g_w, g_m = np.full((BUCKETS, n_lang), 1e-4, np.float32), np.full((n_lang, n_lang), 1e-4)
    model.moves += np.eye(n_lang)
    for _ in range(epochs):
        for at in range(0, len(flow), batch):
            ids = flow[at : at + batch]
            flat = ids.ravel()
            n = hi[flat] - lo[flat]
            owner = np.repeat(np.arange(len(flat)), n)
            feats = bucket[lo[flat][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)]
            x = np.add.reduceat(model.weights[feats], np.cumsum(n) - n, axis=0).reshape(*ids.shape, n_lang)
            t, e = _stochastic(model.moves), _scaled(x)
            post, expect = expected(e, t)
            gold = np.eye(n_lang, dtype=np.float32)[label[ids]]
            grad = (post - gold).reshape(-1, n_lang)
            gw = np.zeros_like(model.weights)
            for j in range(n_lang):
                gw[:, j] = np.bincount(feats, weights=grad[owner, j], minlength=BUCKETS)
            gw /= len(ids)
            g_w += gw * gw
            model.weights -= 0.3 * gw / np.sqrt(g_w)
            made = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
            gm = moves_gradient(made, expect, t) / len(ids)
            g_m += gm * gm
            model.moves -= 0.1 * gm / np.sqrt(g_m)
    return model


def runs(docs: DataFrame) -> DataFrame:
    """docs(lang, d, text) -> (lang, d, run, text): up to TRAIN_RUNS runs of STEP words, one from each equal stretch of the text.

    Where a run starts in its stretch follows d and the stretch. Runs of more than TRAIN_BYTES bytes (very long words) are left out.
    """

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split(whole, "text", 1 << 19):
                buf, offsets = texts(batch, "text")
                words, out = Words(buf, offsets, gap=NOT_LETTER), []
                raw = buf.tobytes()
                for i, (lang, d) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    n, first = int(words.count[i]), int(words.first[i])
                    several = max(1, min(TRAIN_RUNS, n // STEP))
                    for k in range(several):
                        low, high = n * k // several, n * (k + 1) // several
                        at = low + int(np.random.default_rng([d, k]).integers(0, max(1, high - low - STEP + 1)))
                        last = min(at + STEP, high) - 1
                        if at <= last and words.end[first + last] - words.start[first + at] <= TRAIN_BYTES:
                            out.append((lang, d, k, raw[words.start[first + at] : words.end[first + last]].decode("utf-8", "replace")))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.string()))], ["lang", "d", "run", "text"])

    return docs.mapInArrow(cut, "lang string, d long, run int, text string")


def train(docs: DataFrame, trainable) -> Model:
    """Fit on at most TRAIN_DOCS documents a language, chosen by a hash of doc_id and text, runs of words from all over each.

    All languages are counted first; beyond MAX_LANGUAGES those with the most rows are learned. Rows without text or
    language teach nothing; a table without others gives a model that knows no language.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(trainable & F.col("lang").isNotNull() & (F.length("text") > 0)).select(F.col("lang").cast("string").alias("lang"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("d"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros((1, 1)))
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.5 * TRAIN_DOCS / r["count"])))])
    picked = rows.filter(F.col("d") < F.element_at(share, F.col("lang")) * (1 << 30)).select("lang", "d", "text")
    found, n = [], {}
    for r in sorted(runs(picked).collect(), key=lambda r: (r["lang"], r["d"], r["run"], r["text"])):
        mine = n.setdefault(r["lang"], set())
        mine.add(r["d"])
        if len(mine) <= TRAIN_DOCS:
            found.append((r["text"], r["lang"]))
    return fit(found)


def predict(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The columns in ``keep`` + lang_pred, score (called ``names``) for every row. A third name asks for the confidence,
    the mean over words of the largest posterior, whichever language it is of; 0 for ``und``.

    lang_pred is ``und`` and score 0 where text is null or has no letter (or nothing was learned); else score is the
    mean posterior of the winning language over the text's words. Ties go to the first language by name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most BUCKETS x MAX_LANGUAGES weights

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        moves = _stochastic(m.moves)
        for whole in batches:
            for batch in split(whole, "text", 1 << 19):
                raw, offsets = texts(batch, "text")
                n_docs = len(offsets) - 1
                buf = fold_case(raw)
                words = Words(buf, offsets, gap=NOT_LETTER)
                best, score, sure, named = np.zeros(n_docs, int), np.zeros(n_docs), np.zeros(n_docs), words.count > 0
                ascii_letter = np.zeros(len(raw) + 1, np.int64)
                np.cumsum(((raw | 32) >= 97) & ((raw | 32) <= 122), out=ascii_letter[1:])
                for i in np.flatnonzero(named & (ascii_letter[offsets[1:]] == ascii_letter[offsets[:-1]])):
                    named[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
                if len(m.languages) and len(words.start):
                    types, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
                    e = _scaled(m.potentials(buf, words.start[at], words.end[at]))[which]
                    post = posteriors(e, moves, words.first, words.count)
                    total = np.zeros((len(words.start) + 1, e.shape[1]))
                    np.cumsum(post, axis=0, out=total[1:])
                    sums = total[words.first + words.count] - total[words.first]
                    best = sums.argmax(1)
                    score = np.where(words.count > 0, sums[np.arange(n_docs), best] / np.maximum(words.count, 1), 0.0)
                    if len(names) > 2:
                        most = np.append(0.0, np.cumsum(post.max(1), dtype=np.float64))
                        sure = (most[words.first + words.count] - most[words.first]) / np.maximum(words.count, 1)
                named &= len(m.languages) > 0
                said = pa.array([m.languages[b] if ok else "und" for b, ok in zip(best, named)], pa.string())
                cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                numbers = [pa.array(np.clip(np.where(named, x, 0.0), 0, 1)) for x in (score, sure)[: len(names) - 1]]
                yield pa.RecordBatch.from_arrays([*cols, said, *numbers], [*keep, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep]
    keep = [f.name for f in docs.schema if f.name in keep]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{names[0]}` string", *[f"`{n}` double" for n in names[1:]]]))


def held_out_rows():
    """crc32(doc_id as text) mod 5 = 0; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; ``und`` and 0 for null or empty text and text without a letter.

    Repeated rows give repeated rows, texts of any length are read whole, an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out_rows())
    tagged = docs.select("doc_id", held_out_rows().alias("held_out"), "text")
    return predict(tagged, model, ["doc_id", "held_out"])


def language_stage(spark, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Pipeline stage: keeps documents with a language, whose words have a mean largest posterior of ``least`` or more
    whatever languages they mix; all columns kept, whatever their names. Null, empty and letterless texts go."""
    model = train(docs, F.lit(True))
    said = tuple(fresh(docs, "lang_of_text", "lang_score", "lang_sure"))
    return predict(docs, model, docs.columns, said).filter((F.col(said[0]) != "und") & (F.col(said[2]) >= least)).select(*docs.columns)
