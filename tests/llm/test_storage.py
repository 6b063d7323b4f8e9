"""Mixing, media, WARC, packing."""

import hashlib
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import fixity, media, mixing, packing
from ledgerloom.plans.scratch import scratch_dir


def test_targets(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 200)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sources).collect()}
    assert got["a"] == 30  # three times its size; the rest is shared 2 : 1 : 5
    assert [got["b"], got["c"], got[None]] == pytest.approx([(1710 - 30 - 600) * 2 / 3, (1710 - 30 - 600) / 3, 600])


def test_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 20.0), ("b", "y", 40.0)], "s string, l string, mass double")
    s, l = spark.createDataFrame([("a", 50.0), ("b", 50.0)], "s string, target double"), spark.createDataFrame([("x", 60.0), ("y", 40.0)], "l string, target double")
    out = mixing.entropy_balance(cells, {"s": s, "l": l}, tol=1e-8).withColumn("p", F.col("mass") * F.exp("log_rate")).collect()
    for k, goals in (("s", {"a": 50, "b": 50}), ("l", {"x": 60, "y": 40})):
        for v, goal in goals.items():
            assert sum(r.p for r in out if r[k] == v) == pytest.approx(goal, rel=1e-5)
    odds = {(r.s, r.l): r.p / r.mass for r in out}  # exponential tilts keep odds ratios
    assert odds["a", "x"] * odds["b", "y"] == pytest.approx(odds["a", "y"] * odds["b", "x"], rel=1e-5)


def test_mix(docs, rows, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for src in {r.source for r in got}:
        mine = [r for r in got if r.source == src]
        assert sum(r.copies * r.size for r in mine) == pytest.approx(mine[0].target, abs=130 if src != "long" else 6000)
        assert max(r.copies for r in mine) <= 3
    same = lambda df: Counter((r.doc_id, r.size, r.copies) for r in df.collect())
    assert same(mixing.mix(docs)) == same(mixing.mix(docs.repartition(7)))
    assert mixing.mix(none).count() == 0


def test_mix_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mix_stage(spark, docs, sf)
    want = Counter()
    for r in mixing.mix(docs.select("doc_id", "text", "source")).collect():
        want[r.doc_id] += r.copies
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == +want


def test_png():
    for data in (b"", b"x", b"x" * 64, b"a\0", "é".encode() * 1000):
        n, payload = media.decode(media.encode(data))
        assert n == len(data) and payload[:n] == data and not payload[n:].strip(b"\0") and len(payload) % 64 == 0 and len(payload) >= 64
    with pytest.raises(ValueError):
        media.decode(media.encode(b"abc")[:-14] + b"\0" * 14)


def test_media(spark, docs, rows):
    directory = f"{scratch_dir(spark)}/media-test-{uuid.uuid4().hex}"
    fs, top = media._fs(directory)
    fs.create_dir(top)
    listed = media.store(docs, directory)
    assert listed.agg(F.sum("members")).first()[0] == len(rows)
    for size in (1 << 23, 700):  # a range owns the members that start in it
        got = media.measure(media.members(spark, directory, rangeBytes=str(size))).collect()
        want = Counter()
        for i, t, *_ in rows:
            b = (t or "").encode()
            p = b + b"\0" * (-len(b) % 64 if b else 64)
            want[i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
        assert len({(r.payload_sha256, r.n_bytes) for r in got}) == len({(r.media_sha256, r.feature) for r in got})
    # damage one member: it alone is reported, after its tries
    path = f"{top}/{listed.orderBy('archive').first().archive}"
    data = bytearray(fs.open_input_file(path).read())
    data[data.index(b"IDAT") + 8] ^= 1
    with fs.open_output_stream(path) as f:
        f.write(bytes(data))
    got = media.measure(media.members(spark, directory)).collect()
    assert sum(r.error is not None for r in got) == 1 and len(got) == len(rows)


def test_warc(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    placed = fixity.place(pages.select("page_id", "url", "html", fixity.warc_record(F.col("url"), F.col("page_id"), F.col("html")).alias("record")).withColumn("length", F.octet_length("record").cast("long")).withColumn("hash", F.sha2("record", 256)), [F.col("page_id").asc_nulls_last(), F.col("url")], 50)
    rows = placed.orderBy("node").collect()
    assert [r.node for r in rows] == list(range(302))
    archives = {}
    for r in rows:
        assert len(archives.setdefault(r.archive, b"")) == r.offset
        archives[r.archive] += r.record.encode()
    files = spark.createDataFrame([(f"{k}", bytearray(v)) for k, v in archives.items()] + [("cut", bytearray(archives[0][:-5])), ("empty", bytearray())], "path string, content binary")
    got = fixity.parse_warc(files).collect()
    back = {(r.archive, r.seq): (r.offset, bytes(r.record)) for r in got if r.archive not in ("cut", "empty")}
    assert back == {(str(r.archive), r.seq): (r.offset, r.record.encode()) for r in rows}
    assert [r.record is None for r in sorted((r for r in got if r.archive == "cut"), key=lambda r: r.seq)] == [False] * 49 + [True]


def test_audit(spark):
    leaves = [(i, 10 * i, 10, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(1000)]
    bad = [(*x[:3], "other") if x[0] in (0, 517, 999) else x for x in leaves]
    table = lambda x: fixity.tree(spark.createDataFrame(x, "node long, start long, length long, hash string"))
    a = table(leaves)
    assert len(a) == 4 and fixity.audit(a, table(leaves)).count() == 0
    assert sorted(r.node for r in fixity.audit(a, table(bad)).collect()) == [0, 517, 999]
    short = {r.node: r.hash_b for r in fixity.audit(a, table(leaves[:990])).collect()}
    assert set(range(990, 1000)) <= set(short) and all(short[i] is None for i in range(990, 1000))
    assert fixity.audit(table([]), table([])).count() == 0


def test_store(spark, tmp_path):
    import gzip

    rows = [(i % 7 if i % 5 else None, None if i % 11 == 0 else f"http://x/{i % 3}", ["", "é" * 30, "# a", "plain " * 400, None][i % 5]) for i in range(95)] * 2
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    listing, names = fixity.page_store(spark, spark.read.parquet(f"{tmp_path}/pages.parquet"), f"file://{tmp_path}/a", 10)
    files = {r.archive: r.file for r in listing.collect()}
    assert sorted(files) == list(range(19)) and {r.records for r in listing.collect()} == {10} and names.count() == 190
    plain = lambda k: [gzip.decompress((tmp_path / k / f).read_bytes()) for _, f in sorted(files.items())]
    record = lambda i, u, h: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {u or ''}\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\nContent-Length: {len((h or '').encode())}\r\n\r\n{h or ''}\r\n\r\n".encode()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", hashlib.sha256(record(*r)).hexdigest()))
    assert b"".join(plain("a")) == b"".join(record(*r) for r in want)
    leaf = fixity.leaves(fixity.read_store(listing, f"file://{tmp_path}/a"), 10)
    at = {}
    for n, r in enumerate(want):
        at[n] = (sum(len(record(*x)) for x in want[n // 10 * 10 : n]), len(record(*r)), hashlib.sha256(record(*r)).hexdigest())
    assert {r.node: (r.start, r.length, r.hash) for r in leaf.collect()} == at

    second = fixity.copy_store(listing, f"file://{tmp_path}/a", f"file://{tmp_path}/b")
    trees = lambda x, k: fixity.tree(fixity.leaves(fixity.read_store(x, f"file://{tmp_path}/{k}"), 10))
    sound = trees(listing, "a")
    assert fixity.audit(sound, trees(second, "b")).count() == 0
    paths = {r.archive: tmp_path / "b" / r.file for r in second.collect()}
    members = lambda p: [m for m, _ in fixity.stored_members(open(p, "rb"))]
    paths[2].write_bytes(paths[2].read_bytes()[:-9])  # cut short
    lost = members(paths[5])
    paths[5].write_bytes(b"".join(lost[:6] + lost[7:]))  # a record is missing, of two that are alike
    data = bytearray(paths[9].read_bytes())
    data[sum(map(len, members(paths[9])[:3])) + 30] ^= 255  # a stored byte is another one
    paths[9].write_bytes(data)
    paths[12].unlink()  # an archive is gone
    paths[15].write_bytes(b"")
    bad = {r.node: r for r in fixity.audit(sound, trees(second, "b")).collect()}
    assert set(bad) == {29} | set(range(57, 60)) | set(range(93, 100)) | set(range(120, 130)) | set(range(150, 160))
    assert bad[59].hash_b is None and bad[59].hash_a == at[59][2] and bad[151].hash_b is None


def test_empty_store(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert fixity.op8_warc_fixity(spark, str(tmp_path)).count() == 0


def test_spoil():
    hit = next(f"http://x/{i}" for i in range(999) if hashlib.md5(f"http://x/{i}".encode()).hexdigest()[:2] == "55")
    record = lambda u, h: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {u}\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: {len(h.encode())}\r\n\r\n{h}\r\n\r\n".encode()
    for body, other in (("abc", "#bc"), ("#bc", "%bc"), ("é>\r\nContent-Length: 3\r\n\r\nb", "##>\r\nContent-Length: 3\r\n\r\nb"), ("€", "###")):
        assert fixity.spoil(record(hit, body)).endswith(other.encode() + b"\r\n\r\n") and len(fixity.spoil(record(hit, body))) == len(record(hit, body))
    assert fixity.spoil(record(hit, "")) is None and fixity.spoil(record("http://y", "abc")) is None


def test_op8(spark, sf):
    got = fixity.op8_warc_fixity(spark, sf).collect()
    hit = {i for i in range(300) if i % 4 and hashlib.md5(f"http://x/{i}".encode()).hexdigest()[:2] in ("00", "55", "aa")}
    assert {r.page_id for r in got} == hit


def test_histogram():
    rng = np.random.default_rng(0)
    for _ in range(20):
        counts = Counter(rng.integers(1, 33, 500).tolist()) + Counter({64: 20})
        patterns = packing.pack_histogram(dict(counts), 64)
        assert all(sum(p) <= 64 for p, _ in patterns)
        packed = Counter()
        for p, n in patterns:
            for x in p:
                packed[x] += n
        assert packed == counts
        assert sum(64 * n for _, n in patterns) < 1.2 * sum(k * v for k, v in counts.items()) + 64


def test_pack(docs, rows, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack(docs).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for s, n in packing.cuts(len(ids), 2048):
            want[i, s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert sequences.get(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 2048
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", " lead", "trail ", "a\n b\n\nc", "don't we'll", "x y z", "1 2 34 5", "<|endoftext|> x", "日本 語", "tab\tx", "a \n", "\U0001f600 ok"])
def test_encoder(text):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    want = np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.Encoder(path).batch([text, "other words " + text])[0] == want


def test_pipeline(spark, sf):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf).collect()
    assert out and len(corpus_pipeline.STAGES) == 5 and sum(r.length for r in out) > 0


CLASHES = ["_key", "_k2", "_order_id", "order_id", "_again", "again", "_gone", "gone", "_at", "text_key", "row", "mix_size", "mix_rank", "rate", "size", "salt", "lang_of_text", "lang_score", "block", "data", "bucket", "start", "n", "s", "k0"]


@pytest.fixture(scope="module")
def clashing(spark, rows):
    """Documents with columns named like those that operators make, of types and values of their own."""
    r = [(*x, *[f"{c} {i}" if k % 2 else i * 10 + k for k, c in enumerate(CLASHES)]) for i, x in enumerate(rows)]
    fields = ", ".join(f"`{c}` {'string' if k % 2 else 'long'}" for k, c in enumerate(CLASHES))
    return spark.createDataFrame(r, f"doc_id long, text string, lang string, source string, n_chars long, {fields}").repartition(3)


def test_stages_leave_columns_alone(spark, clashing):
    import corpus_pipeline

    given = {r["_key"]: r for r in clashing.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, "")
        assert out.schema == clashing.schema, name
        got = out.collect()
        assert got
        for r in got:
            want = given[r["_key"]]
            same = [c for c in clashing.columns if name != "suffix_dedup" or c not in ("text", "n_chars")]
            assert all(r[c] == want[c] for c in same), name
    assert corpus_pipeline.STAGES[-1][1](spark, clashing, "").count() >= len(given)


def test_stages_of_empty_tables(spark, none):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0, name


def test_mix_stage_repeated_rows(spark, docs, rows):
    """Copies of a source's documents add up to the source's target, with repeated rows and null ids as documents of their own."""
    out = mixing.mix_stage(spark, docs, "").groupBy("source").agg(F.sum(F.size(F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " "))).alias("n")).collect()
    want = {r.source: r.target for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    got = {r.source: r.n for r in out}
    assert all(abs((got.get(s) or 0) - t) <= (130 if s != "long" else 6000) for s, t in want.items())


def test_foreign_archives(spark):
    """Stored and deflated members in nested directories; an unknown method is reported, alone."""
    import zipfile

    directory = f"{scratch_dir(spark)}/foreign-archives-{uuid.uuid4().hex}"
    fs, top = media._fs(directory)
    fs.create_dir(f"{top}/a/b")
    want = {}
    for name, method in (("x.zip", zipfile.ZIP_STORED), ("a/y.zip", zipfile.ZIP_DEFLATED), ("a/b/z.zip", zipfile.ZIP_BZIP2)):
        with fs.open_output_stream(f"{top}/{name}") as raw, zipfile.ZipFile(raw, "w", method) as z:
            z.writestr("folder/", b"")
            for i in range(5):
                data = bytes([i]) * 1000 * i
                z.writestr(f"folder/{i}.bin", data)
                want[name, f"folder/{i}.bin"] = None if method == zipfile.ZIP_BZIP2 else data
    for size in (1 << 20, 40):
        got = media.members(spark, directory, rangeBytes=str(size)).collect()
        assert {(r.archive, r.member): None if r.content is None else bytes(r.content) for r in got} == want and len(got) == len(want)
        assert all((r.error is None) == (r.content is not None) for r in got)
    assert {r.archive for r in media.members(spark, directory, archives="a/y.zip").collect()} == {"a/y.zip"}
