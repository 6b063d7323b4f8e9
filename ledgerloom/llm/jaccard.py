"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles that are as similar as asked differ in at most k shingles, where k follows from their size band.
PartEnum splits the shingle domain into n1 parts; two sets within k differ by at most k // n1 in one part at least.
Each part is split in n2, and every choice of n2 - k // n1 of these gives one signature: the hash of the set's shingles
there. Sets within k share a signature for certain; a set signs for its own band and the next larger one.

A signature of no or one shingle says little and is shared by chance the more, the larger the corpus. So there are some
parts more than needed: s spare ones give sets within k at least s + 1 parts in which they differ by at most k // n1. A
set leaves out all signatures lighter than a bound that at most s of its parts fall below; of two sets the one with the
higher bound has one of those parts at or above it, and the signature on which both agree there is left out by neither.

With its signatures a set sends a parity sketch (256 bits, more for large sets), which bounds the difference of two sets from below. Of sets
that share a signature only those are joined to a candidate group that the sketch lets be similar, over a spanning
forest, never as all pairs. A group is verified exactly by its sets in tiles; pairs that are already linked over others
are skipped, so a family of thousands of near copies costs about one exact test a member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import SENT, answers, hashed, n_buckets, replies_of, seen_twice, send, settle, texts, to_blocks, unpack
from .common import Words, fresh, lean, lean_group, materialize, mix, release
from .graph import connected_components

N2, K2 = 3, 1
#: One part in so many is added to those that PartEnum needs, so that a set may leave out its lightest signatures.
SPARE = 5
#: Parts in which the signatures of a bucket are met, to bound memory.
SLICES = 8
#: Members of a lot, so many sets are in a task at once, or twice as many where sets are asked against a lot; sets of a family that meet all its lots.
TILE, PIVOTS = 2048, 32
#: Tasks that the rows of one class are dealt to when they get their smallest id.
SALTS = 8
#: Bytes of text for each bucket of signatures; shared signatures for each bucket in which sets meet.
BUCKET_TEXT, MEET = 16 << 20, 1_000_000


class Sets:
    """Distinct shingles of each document in a buffer: hashes (sorted within a document), where each set starts, sizes, ids.

    A document of fewer words than a shingle has its whole sequence as the one shingle; one without words is empty.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, size: int):
        words = Words(buf, offsets, lower=True)
        at = np.flatnonzero(words.fits(size))
        hashes, doc = words.windows(size, at), words.doc[at]
        for k in range(1, size):
            few = np.flatnonzero(words.count == k)
            hashes = np.concatenate([hashes, words.windows(k, words.first[few])])
            doc = np.concatenate([doc, few])
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        self.hash, self.doc = hashes[new], doc[new]
        bound = np.searchsorted(self.doc, np.arange(len(offsets)))
        self.first, self.n = bound[:-1], np.diff(bound)
        self.mixed = mix(self.hash ^ np.uint64(0x51C7))
        total = np.append(np.uint64(0), np.cumsum(self.mixed, dtype=np.uint64))
        self.id = mix(total[bound[1:]] - total[bound[:-1]] + self.n.astype(np.uint64)).view(np.int64)


class Bands:
    """Size bands for a similarity of num / den: sets as similar as that lie in one band or in neighbours."""

    def __init__(self, num: int, den: int, largest: int):
        top = [1]
        while top[-1] < largest:
            top.append(max(top[-1] + 1, top[-1] * den // num))
        top.append(max(top[-1] + 1, top[-1] * den // num))
        self.top = np.array(top)
        self.k = 2 * self.top * (den - num) // (den + num)  # most shingles that two such sets differ in
        self.spare = (self.k // (K2 + 1) + 1) // SPARE
        self.n1 = self.k // (K2 + 1) + 1 + self.spare

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.top, n)


def signatures(s: Sets, use: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the documents ``use``: hashes and the documents they belong to."""
    if not len(use):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bands = Bands(num, den, int(s.n[use].max()))
    keys, docs = [], []
    mine = np.flatnonzero(np.isin(s.doc, use))
    place = np.full(len(s.n), -1)
    place[use] = np.arange(len(use))
    for up in (0, 1):
        band = bands.of(s.n[use]) + up
        n1 = np.where(bands.k[band] > 0, bands.n1[band], 0)  # no difference allowed: equal sets, which share an id
        base = np.append(0, np.cumsum(n1 * N2))
        elems = mine[n1[place[s.doc[mine]]] > 0]
        p = place[s.doc[elems]]
        part = (s.mixed[elems] >> np.uint64(20)) % n1[p].astype(np.uint64)
        sub = (s.mixed[elems] & np.uint64(0xFFFF)) % np.uint64(N2)
        cell = np.zeros(int(base[-1]), np.uint64)
        at = base[p] + (part * np.uint64(N2) + sub).astype(np.int64)
        np.add.at(cell, at, s.hash[elems])
        cell, held = cell.reshape(-1, N2), np.bincount(at, minlength=len(cell)).reshape(-1, N2)
        every = np.repeat(np.arange(len(use)), n1)
        first = base[:-1] // N2
        # the least of a set's parts but for as many as there are to spare tells how few shingles a signature may have
        least = np.sort(held, axis=1)[:, : N2 - K2].sum(1)
        signs = np.flatnonzero(n1 > 0)
        light = np.zeros(len(use), np.int64)
        light[signs] = least[np.lexsort((least, every))][first[signs] + bands.spare[band[signs]]]
        for chosen in combinations(range(N2), N2 - K2):
            heavy = np.flatnonzero(held[:, list(chosen)].sum(1) >= light[every])
            owner = every[heavy]
            number = heavy - first[owner]
            tag = band[owner].astype(np.uint64) * np.uint64(1 << 40) + number.astype(np.uint64) * np.uint64(1 << 8) + np.uint64(sum(1 << c for c in chosen))
            keys.append(mix(cell[heavy][:, list(chosen)].sum(1, dtype=np.uint64) ^ mix(tag)))
            docs.append(use[owner])
    return np.concatenate(keys), np.concatenate(docs)


#: A signature in the first exchange: 39 bits of it, which decide within its bucket; the highest bit tells that the block has it twice.
KEY = np.dtype([("low", "<u4"), ("high", "u1")])
#: A signature in the second: 40 bits of it, and the number of its set in the message.
SIG = np.dtype([("low", "<u4"), ("high", "u1"), ("set", "<u2")])


class Signed:
    """Distinct sets of a block with their signatures: ``use`` (a document of each), ``keys`` and ``docs`` (signatures and whose they
    are), ``names`` (distinct signatures), ``which`` (the number of each), ``times`` (in how many sets)."""

    def __init__(self, sets: Sets, num: int, den: int):
        some = np.flatnonzero(sets.n)
        self.use = some[np.unique(sets.id[some], return_index=True)[1]]
        got = [signatures(sets, self.use[at : at + 8000], num, den) for at in range(0, len(self.use), 8000)]
        self.keys = np.concatenate([np.zeros(0, np.uint64), *[k for k, _ in got]])
        self.docs = np.concatenate([np.zeros(0, np.int64), *[d for _, d in got]])
        self.names, self.which, self.times = np.unique(self.keys, return_inverse=True, return_counts=True)

    def rows(self, buckets: int) -> np.ndarray:
        out = np.empty(len(self.names), KEY)
        rest = self.names // np.uint64(buckets)
        out["low"] = rest & np.uint64(0xFFFFFFFF)
        out["high"] = ((rest >> np.uint64(32)) & np.uint64(0x7F)) | ((self.times > 1).astype(np.uint64) << np.uint64(7))
        return out


def _twice(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Does a signature occur in two places of the corpus?"""
    wide = [np.empty(len(p), [("key", "<u8"), ("many", "u1")]) for p in parts]
    for p, x in zip(parts, wide):
        x["key"], x["many"] = p["low"].astype(np.uint64) | ((p["high"] & 0x7F).astype(np.uint64) << np.uint64(32)), p["high"] >> 7
    return seen_twice(wide)


def _messages(keys: np.ndarray, docs: np.ndarray, s: Sets, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, data) of shared signatures; data has the ids, sizes and sketches of the sets in the message first."""
    rest, to = keys // np.uint64(buckets), hashed(keys, buckets)
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(buckets + 1))
    uses = np.unique(docs)
    sketches, start = _sketch(s, uses)
    for b in np.flatnonzero(np.diff(ends)):
        mine = order[ends[b] : ends[b + 1]]
        for at in range(0, len(mine), 1 << 16):
            some = mine[at : at + (1 << 16)]
            rows = np.empty(len(some), SIG)
            rows["low"], rows["high"] = rest[some] & np.uint64(0xFFFFFFFF), (rest[some] >> np.uint64(32)) & np.uint64(0xFF)
            sets, rows["set"] = np.unique(docs[some], return_inverse=True)
            place = np.searchsorted(uses, sets)
            flat = sketches[spread(start[place], start[place + 1] - start[place])]
            yield int(b), np.uint32(len(sets)).tobytes() + s.id[sets].tobytes() + s.n[sets].astype(np.int64).tobytes() + flat.tobytes() + rows.tobytes()


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start, start + 1, ... of count each."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + count, count)


class Forest:
    """Components of nodes 0..n-1 under links that a test allows."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


#: Largest sets of each sketch level; words of 64 bits that a sketch of the level has.
LEVEL_SIZES, LEVEL_WORDS = np.array([200, 640, 2600, 10_000]), np.array([4, 8, 32, 128, 512])


def level_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVEL_SIZES, n)


def _sketch(s: Sets, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of how many shingles of each set hash to each bit, one after another, and where each starts. Two sets differ in at
    least as many shingles as their sketches in bits."""
    level = level_of(s.n[use])
    start = np.append(0, np.cumsum(LEVEL_WORDS[level]))
    out = np.zeros(int(start[-1]), np.uint64)
    for c in np.unique(level):
        mine = np.flatnonzero(level == c)
        size = int(LEVEL_WORDS[c]) * 64
        for at in range(0, len(mine), 2048):
            some = mine[at : at + 2048]
            count = s.n[use[some]]
            bit = (s.hash[spread(s.first[use[some]], count)] >> np.uint64(11)) & np.uint64(size - 1)
            odd = np.bincount(np.repeat(np.arange(len(some)), count) * size + bit.astype(np.int64), minlength=size * len(some)) & 1
            out[start[some][:, None] + np.arange(size // 64)] = np.packbits(odd.astype(np.uint8)).view(np.uint64).reshape(len(some), -1)
    return out, start


class Sketches:
    """Sketches of sets by level; those of larger sets are folded to lower levels, so any two can be compared."""

    def __init__(self, n: np.ndarray, flat: np.ndarray, start: np.ndarray, num: int, den: int):
        self.n, self.level, self.num, self.den = n, level_of(n), num, den
        self.at, self.bits = {}, {}
        for c in np.unique(self.level):
            words = int(LEVEL_WORDS[c])
            self.at[c], parts, have = np.full(len(n), -1), [], 0
            for up in np.unique(self.level[self.level >= c]):
                mine = np.flatnonzero(self.level == up)
                self.at[c][mine] = have + np.arange(len(mine))
                have += len(mine)
                whole = flat[start[mine][:, None] + np.arange(LEVEL_WORDS[up])]
                parts.append(np.bitwise_xor.reduce(whole.reshape(len(mine), -1, words), axis=1))
            self.bits[c] = np.concatenate(parts)

    def may(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Can sets a[i] and b[i] be as similar as asked, for all their sketches and sizes tell?"""
        level, out = np.minimum(self.level[a], self.level[b]), np.zeros(len(a), bool)
        for c in np.unique(level):
            for mine in np.array_split(np.flatnonzero(level == c), 1 + int((level == c).sum() * LEVEL_WORDS[c] >> 20)):
                x, y = a[mine], b[mine]
                apart = np.bitwise_count(self.bits[c][self.at[c][x]] ^ self.bits[c][self.at[c][y]]).sum(1, dtype=np.int64)
                out[mine] = apart * (self.den + self.num) <= (self.n[x] + self.n[y]) * (self.den - self.num)
        return out


def _meet(table: pa.Table, num: int, den: int) -> pa.Table:
    """Sets that share a signature in this bucket and may be similar, as a spanning forest of edges."""
    ids, sizes, sketches, sigs, at = [], [], [], [], 0
    for x in table["data"]:
        data = x.as_py()
        k = int(np.frombuffer(data, np.uint32, 1)[0])
        ids.append(np.frombuffer(data, np.int64, k, offset=4))
        sizes.append(np.frombuffer(data, np.int64, k, offset=4 + 8 * k))
        words = int(LEVEL_WORDS[level_of(sizes[-1])].sum())
        sketches.append(np.frombuffer(data, np.uint64, words, offset=4 + 16 * k))
        sigs.append((np.frombuffer(data, SIG, offset=4 + 16 * k + 8 * words), at))
        at += k
    name, first, node_of = np.unique(np.concatenate(ids), return_index=True, return_inverse=True)
    sizes = np.concatenate(sizes)
    start = np.append(0, np.cumsum(LEVEL_WORDS[level_of(sizes)]))
    known = Sketches(sizes[first], np.concatenate(sketches), start[first], num, den)
    forest, pairs, groups = Forest(len(name)), [np.zeros(0, np.int64)], {}
    for part in range(SLICES):  # signatures of one slice at a time
        key, node = [], []
        for rows, base in sigs:
            mine = rows[(rows["low"] % SLICES) == part]
            key.append(mine["low"].astype(np.uint64) | (mine["high"].astype(np.uint64) << np.uint64(32)))
            node.append(node_of[base + mine["set"].astype(np.int64)])
        key, node = np.concatenate(key), np.concatenate(node)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        size = np.diff(np.append(start, len(key)))
        two = start[size == 2]
        pairs.append(np.unique(node[two].astype(np.int64) << 32 | node[two + 1]))
        if (size > 2).any():  # of equal groups one
            mark = np.add.reduceat(mix(node.astype(np.uint64) + np.uint64(1)), start)
            for i in np.flatnonzero(size > 2):
                groups.setdefault(int(mark[i]), node[start[i] : start[i] + size[i]])
    pair = np.unique(np.concatenate(pairs))
    a, b = pair >> 32, pair & 0xFFFFFFFF
    for lo in range(0, len(pair), 1 << 18):
        x, y = a[lo : lo + (1 << 18)], b[lo : lo + (1 << 18)]
        ok = known.may(x, y)
        for u, v in zip(x[ok].tolist(), y[ok].tolist()):
            forest.join(u, v)
    for g in sorted(groups.values(), key=len, reverse=True):
        label = np.array([forest.root(x) for x in g.tolist()])
        for i in range(len(g)):
            other = np.flatnonzero(label != label[i])
            if not len(other):
                if i == 0 or (label == label[0]).all():
                    break
                continue
            hit = other[known.may(np.full(len(other), g[i]), g[other])]
            if len(hit):
                met = np.unique(label[hit])
                for v in met.tolist():
                    forest.join(int(label[i]), v)
                label[np.isin(label, met)] = label[i]
    root = np.array([forest.root(x) for x in range(len(name))], dtype=np.int64)
    off = np.flatnonzero(root != np.arange(len(name)))
    return pa.table({"u": pa.array(name[off], pa.int64()), "v": pa.array(name[root[off]], pa.int64())})


def links_among(ids: list[int], sets: list[np.ndarray], num: int, den: int, asked: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever is linked among sets, without those that follow; with ``asked`` only links of such sets."""
    forest = Forest(len(ids))
    n = np.array([len(x) for x in sets])
    order = np.lexsort((np.array(ids), n))
    known, out = Sketches(n[order], *_sketch(Stored([sets[i] for i in order]), np.arange(len(ids))), num, den), []
    n = n[order]
    some = np.ones(len(ids), bool) if asked is None else asked[order]
    for i in range(len(order) - 1):
        end = int(np.searchsorted(n, n[i] * den // num, side="right"))  # larger sets cannot be similar enough
        others = np.arange(i + 1, end)
        if not some[i]:
            others = others[some[others]]
        a = order[i]
        for j in others[known.may(np.full(len(others), i), others)]:
            b = order[j]
            if forest.root(int(a)) == forest.root(int(b)):
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                forest.join(int(a), int(b))
                out.append((ids[a], ids[b]))
    return out


class Stored:
    """Sets as they lie in Sets, from their shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(x) for x in sets], np.int64)
        self.first = np.append(0, np.cumsum(self.n))[:-1]
        self.hash = np.concatenate([np.zeros(0, np.uint64), *sets])


def _verify(table: pa.Table, num: int, den: int) -> pa.Table:
    """Links in each family of the table."""
    family, asked, want = (table[c].to_numpy() for c in ("family", "asked", "want"))
    order = np.lexsort((~asked, want, family))  # of a set that is there twice the asked one
    keep = order[np.append(True, (want[order][1:] != want[order][:-1]) | (family[order][1:] != family[order][:-1]))]
    column, out = table["data"], []
    for g in np.split(keep, np.flatnonzero(family[keep][1:] != family[keep][:-1]) + 1):
        found = [np.frombuffer(column[int(i)].as_py(), np.uint64) for i in g]
        out += links_among(want[g].tolist(), found, num, den, asked[g])
    return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([x for _, x in out], pa.int64())})


def verified_links(member: DataFrame, num: int, den: int) -> DataFrame:
    """member(want, family, members, data): sets of candidate families -> (u, v), links that connect whatever is linked in a family.

    A family of up to TILE sets is one group. A larger one is dealt to lots of that size, and a few of its sets (pivots) to
    all lots; links within lots and with pivots come first. That leaves most families in one piece and some sets outside it,
    and only these are compared with all sets of the family, a lot at a time.
    """
    check = lean_group(lambda t: _verify(t, num, den))
    cast = lambda df, lot, asked, *key: df.select(*key, lot.cast("int").alias("lot"), "family", F.lit(asked).alias("asked"), "want", "data")
    families = member.select("family", "members").distinct()
    lots = max(8, (families.agg(F.sum("members")).first()[0] or 0) // (4 * TILE))
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    tile = F.pmod(F.xxhash64("want"), tiles)
    small = cast(member.filter(F.col("members") <= TILE), F.lit(-1), True, F.pmod(F.xxhash64("family"), F.lit(lots)).cast("long").alias("key"))
    if families.filter(F.col("members") > TILE).isEmpty():
        return small.groupBy("key", "lot").applyInArrow(check, "u long, v long")
    large = member.filter(F.col("members") > TILE)
    pivot = F.pmod(F.xxhash64("want", F.lit(1)), F.col("members")) < PIVOTS
    dealt = cast(large, tile, True, F.col("family").alias("key"))
    pivots = cast(large.filter(pivot).withColumn("_lot", F.explode(F.sequence(F.lit(0), tiles - 1))), F.col("_lot"), True, F.col("family").alias("key"))
    links = materialize(small.unionByName(dealt).unionByName(pivots).groupBy("key", "lot").applyInArrow(check, "u long, v long"))
    labels = connected_components(links).select(F.col("id").alias("_id"), "label")
    part = materialize(large.select("want", "family", "members").join(labels, F.col("want") == F.col("_id"), "left").select("want", "family", F.coalesce("label", "want").alias("label")))
    most = part.groupBy("family", "label").count().groupBy("family").agg(F.max_by("label", F.struct("count", "label")).alias("_most")).withColumnRenamed("family", "_family")
    outside = materialize(part.join(most, F.col("family") == F.col("_family")).filter(F.col("label") != F.col("_most")).select("want", "family"))
    if outside.isEmpty():
        return links
    rounds = outside.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("_rounds")).withColumnRenamed("family", "_family")
    asked = large.join(outside.select(F.col("want").alias("_want")), F.col("want") == F.col("_want"))
    sized = large.join(rounds, F.col("family") == F.col("_family")).withColumn("_round", F.explode(F.sequence(F.lit(0), F.col("_rounds") - 1)))
    asked = asked.join(rounds, F.col("family") == F.col("_family")).withColumn("_round", F.pmod(F.xxhash64("want", F.lit(2)), F.col("_rounds"))).withColumn("_lot", F.explode(F.sequence(F.lit(0), tiles - 1)))
    both = cast(sized, tile, False, F.col("family").alias("key"), F.col("_round").cast("int").alias("round")).unionByName(cast(asked, F.col("_lot"), True, F.col("family").alias("key"), F.col("_round").cast("int").alias("round")))
    return links.unionByName(both.groupBy("key", "round", "lot").applyInArrow(check, "u long, v long"))


def similar_components(blocks: DataFrame, doc_id: str = "doc_id", others: tuple[str, ...] = (), size: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Blocks of documents -> (nodes, labels): a row (block, place, doc_id, set_id, n_shingles) and the long columns ``others`` for each
    document, and (id, label) for each set_id that is linked to another one, with one label for each component of links
    den * |A and B| >= num * |A or B|.

    Documents with equal sets share the set_id (64 bits of all shingles), so they are linked without a row in labels. A
    first exchange has the signatures only and tells which occur twice; a second has the sets that share them.
    """
    keep: list[str] = []
    buckets = n_buckets(blocks, BUCKET_TEXT)

    def each(b: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch, Sets]]:
        for i, data in enumerate(b.column(b.schema.get_field_index("data"))):
            batch = unpack(data.as_py())
            yield i, b.column(0)[i].as_py(), batch, Sets(*texts(batch, "text"), size)

    @lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, block, batch, s in each(b):
                n = batch.num_rows
                took = [batch.column(batch.schema.get_field_index(c)) for c in (doc_id, *others)]
                cols = [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), took[0], pa.array(s.id), pa.array(s.n.astype(np.int64)), *took[1:]]
                yield pa.RecordBatch.from_arrays(cols, ["block", "place", "doc_id", "set_id", "n_shingles", *others])

    @lean
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, block, _, s in each(b):
                signed = Signed(s, num, den)
                yield from send(block, hashed(signed.names, buckets), signed.rows(buckets), buckets)

    @lean
    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, _, _, s in each(b):
                signed = Signed(s, num, den)
                shared = answers(hashed(signed.names, buckets), buckets, replies_of(b, i, "replies"))[signed.which]
                mine = np.zeros(len(s.n), bool)
                ids = s.id[np.array(b.column(b.schema.get_field_index("places"))[i].as_py())]
                mine[signed.use[np.isin(s.id[signed.use], ids)]] = True
                at = np.flatnonzero(shared & mine[signed.docs])
                if not len(at):
                    continue
                for bucket, data in _messages(signed.keys[at], signed.docs[at], s, meets):
                    yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["bucket", "data"])

    @lean
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = sum(int(np.bitwise_count(np.frombuffer(bits, np.uint8)).sum()) for i in range(b.num_rows) for _, bits in replies_of(b, i, "replies"))
            yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    @lean
    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data in enumerate(b.column(0)):
                rows = b.column(1)[i].as_py()
                s = Sets(*texts(unpack(data.as_py()).take(pa.array([r["place"] for r in rows])), "text"), size)
                for low in range(0, len(rows), 500):
                    some = rows[low : low + 500]
                    sets = [s.hash[s.first[k] : s.first[k] + s.n[k]].tobytes() for k in range(low, low + len(some))]
                    yield pa.RecordBatch.from_arrays([*[pa.array([r[c] for r in some], pa.int64()) for c in ("want", "family", "members")], pa.array(sets, pa.binary())], ["want", "family", "members", "data"])

    kinds = ", ".join(["block long, place int, doc_id long, set_id long, n_shingles long", *[f"`{c}` long" for c in others]])
    nodes = materialize(blocks.select("block", "data").mapInArrow(name, kinds))
    replies = materialize(settle(blocks.select("block", "data").mapInArrow(first, SENT), _twice, KEY), keep)
    meets = max(1, (replies.mapInArrow(shared, "n long").agg(F.sum("n")).first()[0] or 0) // MEET)
    one = materialize(nodes.filter("n_shingles > 0").groupBy("set_id").agg(F.min(F.struct("block", "place")).alias("at")).select("set_id", "at.block", "at.place"), keep)
    places = one.groupBy("block").agg(F.collect_list("place").alias("places"))  # bounded by the rows of a block
    asked = replies.join(places, "block")
    met = blocks.join(asked, "block").select("block", "data", "replies", "places").mapInArrow(second, "bucket int, data binary").groupBy("bucket").applyInArrow(lean_group(lambda t: _meet(t, num, den)), "u long, v long")
    groups = materialize(connected_components(met), keep)
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members")).withColumnRenamed("label", "family")
    member = groups.join(sizes, F.col("label") == F.col("family")).join(one, F.col("id") == F.col("set_id"))
    wanted = member.groupBy("block").agg(F.collect_list(F.struct("place", F.col("id").alias("want"), "family", "members")).alias("rows"))
    full = materialize(blocks.join(wanted, "block").select("data", "rows").mapInArrow(pull, "want long, family long, members long, data binary"), keep)
    labels = materialize(connected_components(verified_links(full, num, den)))
    release(blocks.sparkSession, keep)
    return nodes, labels


def _components(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """nodes + component_id, the smallest doc_id of the component.

    Smallest ids go from documents to sets to classes and back, each aggregated before it is joined and the way back dealt
    to SALTS, so that a class with a third of all rows is no single task's work.
    """
    salt = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SALTS))
    dealt = lambda df: df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sets = nodes.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    classed = sets.join(labels, F.col("set_id") == F.col("id"), "left").select("set_id", "least", "rows", F.coalesce("label", "set_id").alias("class"))
    classes = classed.groupBy("class").agg(F.min("least").alias("_least"), F.sum("rows").alias("_rows")).filter("_rows > 1").select(F.col("class").alias("_class"), "_least")
    least = classed.join(dealt(classes), (F.col("class") == F.col("_class")) & (salt("set_id") == F.col("_salt"))).select(F.col("set_id").alias("_set"), "_least")
    found = nodes.join(dealt(least), (F.col("set_id") == F.col("_set")) & (salt("doc_id") == F.col("_salt")), "left")
    return found.withColumn("component_id", F.coalesce("_least", "doc_id")).drop("_set", "_salt", "_least")


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) for every row.

    A document without words (or null text) is linked with nothing. Rows with equal texts are linked, repeated rows
    too. A null doc_id is reached like others, but is never the smallest unless the component has no other.
    """
    keep: list[str] = []
    blocks = to_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", keep)
    found = _components(*similar_components(blocks, size=size, num=num, den=den))
    release(docs.sparkSession, keep)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document, for 3-word shingles and a similarity of 0.9. See near_duplicates for nulls,
    wordless texts and repeated rows; an empty table gives an empty result."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, num=90)


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document with the smallest doc_id stays; all columns kept.

    Documents without words are no duplicates and stay. Of rows that repeat a doc_id and its text one stays; rows that
    share a doc_id but not a text, and rows without a doc_id, stay.
    """
    doc_id, text, row = fresh(docs, "near_id", "near_text", "near_row")
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    blocks = to_blocks(docs.withColumns({doc_id: F.col("doc_id").cast("long"), text: F.xxhash64("text"), row: F.xxhash64(*hashable)}))
    nodes, labels = similar_components(blocks, doc_id, (text, row))
    found = materialize(_components(nodes, labels))
    near = found.filter(F.col("doc_id") != F.col("component_id")).select("block", "place")
    same = found.filter((F.col("doc_id") == F.col("component_id")) & (F.col("n_shingles") > 0))
    first = same.groupBy("doc_id", text).agg(F.min(F.struct(row, "block", "place")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("doc_id").alias("_id"), F.col(text).alias("_text"), "first")
    again = same.join(first, (F.col("doc_id") == F.col("_id")) & (F.col(text) == F.col("_text"))).filter(F.struct(row, "block", "place") != F.col("first")).select("block", "place")
    dropped = near.union(again).groupBy("block").agg(F.collect_list("place").alias("dropped"))  # bounded by the rows of a block
    names = docs.columns

    @lean
    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, places in zip(b.column(0), b.column(1).to_pylist()):
                batch = unpack(data.as_py())
                mine = np.ones(batch.num_rows, bool)
                mine[places or []] = False
                yield batch.select(names).filter(pa.array(mine))

    return blocks.join(dropped, "block", "left").select("data", "dropped").mapInArrow(stay, docs.schema)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT r, doc_id, ws, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda k: array_to_string(ws[k:k + 2], ' '))) END AS sh FROM d),
n AS (SELECT r, doc_id, len(sh) AS n, sh FROM g), x AS (SELECT r, n, unnest(sh) AS s FROM n),
p AS (SELECT a.r AS a, b.r AS b FROM x a JOIN x b ON a.s = b.s AND a.r < b.r AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), t AS (SELECT a AS r, a AS c FROM l UNION SELECT t.r, l.b FROM t JOIN l ON t.c = l.a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce((SELECT min(m.doc_id) FROM t JOIN n m ON t.c = m.r WHERE t.r = n.r), doc_id) AS component_id FROM n
"""
