"""The ten operators on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronocell.llm import bpe, common, licenses, media, mixing, neardup, queries, suffixes, topk, toxicity, urls, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
ODD = [None, "", "x", "MIT License and the general public license", "ab " * 3000, "same text of more than five words here", "same text of more than five words here", "é 中文 !!\n\n  z", "y" * 700]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", None if i == 3 else f"s{i % 3}", 0, i) for i, t in enumerate(ODD)] + [(5, ODD[5], "en", "s2", 0, 5), (None, "a null id", "en", "s0", 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, chunk long").withColumn("size", F.lit("clash"))


def empty(df):
    return df.where("false")


def run_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same(df, columns, rows):
    show = lambda r, cols: tuple(repr(r[cols.index(c)]) for c in sorted(cols))
    assert sorted(show(tuple(r), df.columns) for r in df.collect()) == sorted(show(r, columns) for r in rows)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages", "embeddings")}
    same(queries.queries()[name](spark, SF), *run_sql(queries.oracle_sql()[name], **tables))


def test_mixing_edges(spark, docs):
    m = mixing.mix(docs)
    same(m.select("doc_id", "size", "source_size", "target", "taken", "epochs", "part"), *run_sql(mixing.ORACLE, documents=docs))
    assert all(r.taken <= 3 * r["size"] for r in m.collect())
    taken = m.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w")).collect()
    assert all(abs(r.t - r.w) <= 1 for r in taken)
    assert mixing.mix(empty(docs)).count() == 0
    clash = docs.withColumns({"target": F.lit(7), "taken": F.col("doc_id"), "n": F.lit("n"), "c0": F.lit("c")})
    out = mixing.mixed_documents(clash)
    assert out.columns == clash.columns
    assert {(r.target, r["size"], r.n, r.c0) for r in out.collect()} == {(7, "clash", "n", "c")} and all(r.taken == r.doc_id for r in out.collect())


def test_mix_spreads_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(None if i % 2 else 7, f"text number {i}", "s") for i in range(400)], "doc_id long, text string, source string")
    keys = d.select(mixing.random_key(F.col("doc_id"), F.col("text")).alias("k")).distinct().count()
    assert keys == 400
    m = mixing.mix(d, bucket_rows=20)
    assert m.count() == 400 and m.agg(F.sum("taken")).first()[0] == 1200


def test_license_edges(spark, docs):
    same(licenses.scan(docs), *run_sql(licenses.ORACLE, documents=docs))
    assert licenses.scan(empty(docs)).count() == 0
    text = "x " + licenses.TEMPLATES[4][1].replace("with or without", "with or wholly without")
    r = licenses.scan(spark.createDataFrame([(1, text.upper())], "doc_id long, text string")).first()
    assert r.labels == "bsd" and r.base_labels == "" and r.score > 0.5
    gram = " ".join(licenses.TEMPLATES[4][1].split()[:4])
    r = licenses.scan(spark.createDataFrame([(1, f"{gram} {gram} {gram}")] * 3, "doc_id long, text string")).collect()
    assert len(r) == 3 and all(x.score == 1 / (len(licenses.TEMPLATES[4][1].split()) - 3) and x.labels == "" for x in r)  # a gram counts once, however often it stands there


def encoder():
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, docs):
    path, e = public_tokenizers.path("byte_bpe_50k.tiktoken"), encoder()
    got = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    assert len(got) == docs.count()
    for r in got:
        assert list(r.ids) == e.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id is not null").collect()}
    found = bpe.digests(docs.where("doc_id is not null"), path, public_tokenizers.PATTERN).collect()
    assert len(found) == docs.count() - 1
    for r in found:
        ids = e.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.digests(empty(docs), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_long_pieces_and_texts(spark):
    """Pieces of any length go through the recursion; chains of overlapping pairs and pairs of lower rank among them."""
    path, e = public_tokenizers.path("byte_bpe_50k.tiktoken"), encoder()
    rng = np.random.default_rng(8)
    pieces = ["y" * 3001, "ab" * 1500, "aab" * 900, "ing" * 700, "é" * 501, "".join(rng.choice(list("acgt"), 2000)), "".join(rng.choice(list("etaoinshr"), 1500))]
    codec = bpe.Codec(bpe.read_ranks(path))
    assert codec.con.sql("SELECT count(*) FROM lower").fetchall()[0][0] > 0
    for p, (n, ids, back) in zip(pieces, codec.coded(pieces), strict=True):
        want = e._core_bpe.encode_single_piece(p.encode())
        assert ids == " ".join(map(str, want)) and n == len(want) and back == p.encode()
    long = " ".join(rng.choice([f"word{i}" for i in range(3000)], 180_000))  # over a million bytes
    r = bpe.digests(spark.createDataFrame([(1, long)], "doc_id long, text string"), path, public_tokenizers.PATTERN).first()
    assert len(long) > 1_000_000 and r.ids_sha256 == hashlib.sha256(" ".join(map(str, e.encode_ordinary(long))).encode()).hexdigest()


def test_near_copies(spark, docs):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    base = [word() for _ in range(300)]
    near = base.copy()
    near[150] = "other"
    far = [word() if i % 4 == 0 else w for i, w in enumerate(base)]
    more = spark.createDataFrame([(100, " ".join(base)), (101, " ".join(near)), (102, " ".join(far)), (103, " ".join(base))], "doc_id long, text string")
    c = neardup.classes(docs.select("doc_id", "text").union(more)).collect()
    of = {r.doc_id: r.class_id for r in c}
    assert of[101] == of[103] == of[100] == 100 and of[102] == 102 and of[6] == 5 and of[1] == 0 and of[None] is None
    assert sorted(r.doc_id for r in c if r.kept and r.doc_id is not None) == [0, 2, 3, 4, 5, 5, 7, 8, 100, 102]
    assert neardup.one_of_each(docs.select("doc_id", "text").union(more)).count() == 10
    assert neardup.classes(empty(docs)).count() == 0


def test_one_of_each_keeps_texts_that_share_an_id(spark):
    words = lambda c: [f"{c}{i}" for i in range(100)]
    text = {c: " ".join(words(c)) for c in "abcdefgh"}
    near_a = " ".join([*words("a")[:50], "other", *words("a")[51:]])
    rows = [(1, text["a"]), (2, near_a), (2, text["b"]), (3, text["c"]), (3, text["d"]), (3, text["d"])]
    rows += [(None, text["e"]), (None, text["f"]), (None, text["f"]), (None, text["g"]), (None, text["a"]), (None, None), (None, "")]
    d = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    out = neardup.one_of_each(d)
    assert out.columns == d.columns
    want = [(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "e"), (None, "f"), (None, "g")]
    got = [(r.doc_id, r.text or "") for r in out.collect()]
    assert sorted(got, key=repr) == sorted([*[(i, text[c]) for i, c in want], (None, "")], key=repr)


def test_variants_of_one_text_equal_brute_force(spark):
    """Texts near the threshold: the bound must lose no link."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        t = base.copy()
        for at in rng.choice(120, 1 + i % 6, replace=False):
            t[at] = f"e{rng.integers(0, 5)}"
        texts.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = neardup.idf_table(*neardup.document_frequencies(docs))
    row, h, w = neardup._weighted(pa.array(texts, pa.large_string()), idf)
    own = [dict(zip(h[row == i].tolist(), w[row == i].tolist(), strict=True)) for i in range(60)]
    label = list(range(60))
    for i in range(60):
        for j in range(i):
            common = sum(min(x, own[j][k]) for k, x in own[i].items() if k in own[j])
            if common >= 0.8 * (sum(own[i].values()) + sum(own[j].values()) - common):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert 1 < len(set(label)) < 60
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == dict(enumerate(label))


def test_rounds_of_pivots_list_only_buckets_that_are_open(spark, monkeypatch):
    """Templates that are alike and mostly not near: members of buckets that are done are not listed again."""
    rng, texts, listed, durable = np.random.default_rng(17), [], [], neardup.durable
    for i in range(600):
        t = [f"w{k}" for k in range(300)]
        for at in rng.choice(60, 4 + i % 3, replace=False):
            t[5 * at] = f"e{rng.integers(0, 1)}"
        texts.append(" ".join(t))

    def counting(df, *args, **named):
        out = durable(df, *args, **named)
        if {"bucket", "node", "leader"} <= set(out.columns):
            listed.append(out.count())
        return out

    monkeypatch.setattr(neardup, "durable", counting)
    found = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert 1 < len({r.class_id for r in found}) < 600
    assert len(listed) > 4 and sum(listed) < 3.2 * listed[0]


def test_consistent_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    h = np.sort(rng.integers(1, 1 << 63, 4000, dtype=np.uint64))
    a, b = rng.uniform(0.5, 2, 4000), rng.uniform(0.5, 2, 4000)
    _, x = neardup.samples(np.zeros(4000, np.int64), h, a, 1)
    _, y = neardup.samples(np.zeros(4000, np.int64), h, b, 1)
    assert abs((x == y).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.2


def test_shares_weigh_alike_at_any_size():
    table = lambda n: neardup.idf_table(np.array([1, n // 1000, n // 100, n]), n)
    assert np.allclose(table(10**5), table(10**9)) and table(10**6)[0] == 2 and table(10**6)[3] == 1


def test_hopeless_pairs_are_rarely_near():
    from math import comb

    n, p = neardup.SAMPLES, neardup.LEAST
    assert sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(int(np.ceil(neardup.HOPELESS * n)))) < 7e-7


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 50), (100, 70)], "a long, b long")
    got = {r.node: r.label for r in neardup.components(e).collect()}
    assert all(got[i] == 0 for i in range(21)) and got[100] == got[70] == got[50] == 50


def test_top_pairs_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)] + [(50, [1.0] * 6), (7, None), (8, [float("nan")] * 6), (9, [None] * 6), (None, [1.0] * 6), (10, []), (200, rows0 := [2.0] * 6), (201, rows0)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = {}
    got = topk.top_pairs(e).collect()
    items = [(i, np.floor(256 * np.array(x, np.float32).astype(float))) for i, x in rows if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)]
    dot = lambda a, b: int(sum(p * q for p, q in zip(a, b, strict=False)))
    for qi, q in items:
        if qi % 50 == 0:
            v.setdefault(qi, []).extend(sorted((-dot(q, x), i) for i, x in items if i != qi)[:5])
    assert sorted((r.query_id, -r.score, r.vec_id) for r in got) == sorted((q, s, i) for q, l in v.items() for s, i in l)
    assert topk.top_pairs(empty(e)).count() == 0


def test_top_k_over_many_shards(spark):
    """Thresholds from one shard hold in all others; ties go to the smaller id, and large numbers stay exact."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, 12)) * 300
    x = np.round(centres[rng.integers(0, 5, 3000)] + rng.normal(size=(3000, 12)) * 40).astype(int)
    x[100:130] = x[99]
    for scale in (1, 10**6):
        rows = [(i, [int(c) * scale for c in v]) for i, v in enumerate(x)]
        v = spark.createDataFrame(rows, "vec_id long, v array<long>")
        got = topk.search(v, v.where("vec_id % 50 = 0"), 5, shard=12 * 8 * 400, block=12 * 8 * 16).collect()
        every = x.astype(object) * scale
        want = set()
        for q in range(0, 3000, 50):
            score = every @ every[q]
            best = sorted((-score[i], i) for i in range(3000) if i != q)[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
        assert {tuple(r) for r in got} == want and len(got) == 300


def test_blocks_of_postings():
    rng = np.random.default_rng(14)
    x = np.sort(rng.integers(-300, 300, (9000, 70)), axis=0)[rng.permutation(9000)].astype(float)
    x[:4000] += 500  # blocks that differ, so that some are skipped
    ids = rng.permutation(9000)
    shard = topk.Shard(ids, x)
    assert len(shard.blocks) > 4
    for i in range(0, 9000, 450):
        score = x @ x[i]
        want = sorted((-score[j], ids[j]) for j in range(9000) if j != i)[:5]
        for least in (-np.inf, -want[4][0]):
            got_ids, got = shard.best(x[i], ids[i], 5, least)
            assert [(-s, j) for j, s in zip(got_ids, got, strict=True)] == want


def test_archive(spark):
    rows = [(3, "u3", "a"), (1, "u1", "b"), (2, "u2", "a"), (4, "u4", None), (5, "u5", ""), (2, "u2", "a"), (None, "u", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    a = warc.archived(pages).cache()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in a.collect())
    assert got == [(0, "response", None), (1, "response", None), (2, "response", None), (2, "revisit", 2), (3, "revisit", 2), (4, "response", None), (5, "revisit", 4)]
    for r in a.collect():
        assert r.payload_digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() and f"sha1:{r.payload_digest}" in r.header
    raw = {r.page_id: bytes(r.record) for r in warc.record_bytes(a.where("record_type = 'response'")).collect()}
    assert raw[1].startswith(b"WARC/1.1\r\n") and raw[1].endswith(b"\r\n\r\nb\r\n\r\n") and b"\r\nWARC-Date: 2" in raw[1]
    odd = warc.archived(spark.createDataFrame([(1, "u\r\nWARC-Type: x", "a")], "page_id long, url string, html string")).first()
    assert odd.record_type == "response" and "u%0D%0AWARC-Type: x\r\n" in odd.header
    assert warc.archived(empty(pages)).count() == 0


def test_archive_of_a_wrong_header_or_payload_fails(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "xyz")], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    r, p = (spark.read.parquet(str(tmp_path / "a" / x)) for x in ("records", "payloads"))
    for name, records, payloads in (("b", r.withColumn("header", F.regexp_replace("header", "Length: 3", "Length: 4")), p), ("c", r, p.withColumn("payload", F.lit(b"?")))):
        records.write.parquet(str(tmp_path / name / "records"))
        payloads.write.parquet(str(tmp_path / name / "payloads"))
        with pytest.raises(Exception, match="does not (fit|match)"):
            warc.read_archive(spark, str(tmp_path / name)).collect()


def jpeg(samples, lossless=0, interval=0):
    """A one-component JPEG by a plain encoder: every DC category takes 5 bits, every AC symbol 8; all steps are 1."""
    h, w = samples.shape
    put = lambda value, n: format(value, f"0{n}b") if n else ""
    tail = lambda d: put(d if d >= 0 else d + (1 << abs(d).bit_length()) - 1, abs(d).bit_length())
    units = []
    if lossless:
        x = samples.astype(int)
        for i in range(h * w):
            r, c = divmod(i, w)
            a, b, d = (x[r, c - 1] if c else 0), (x[r - 1, c] if r else 0), (x[r - 1, c - 1] if r and c else 0)
            start = (i - i % interval if interval else 0) if i else 0
            guess = 128 if i == start else a if r == start // w else b if not c else [a, b, d, a + b - d, a + (b - d >> 1), b + (a - d >> 1), a + b >> 1][lossless - 1]
            units.append((0, int(x[r, c] - guess), []))
    else:
        f = lambda k, n: (1 / np.sqrt(8) if not k else 0.5) * np.cos((2 * n + 1) * k * np.pi / 16)
        t = np.array([[f(k, n) for n in range(8)] for k in range(8)])
        pad = np.pad(samples, ((0, -h % 8), (0, -w % 8)), "edge").astype(float) - 128
        order = [(0, 0)]
        while len(order) < 64:  # along the diagonals
            y, z = order[-1]
            up = (y + z) % 2 == 0
            order.append((y, z + 1) if up and y == 0 and z < 7 else (y + 1, z) if up and z == 7 else (y - 1, z + 1) if up else (y + 1, z) if z == 0 and y < 7 else (y, z + 1) if y == 7 else (y + 1, z - 1))
        for y in range(0, pad.shape[0], 8):
            for z in range(0, pad.shape[1], 8):
                q = np.rint(t @ pad[y : y + 8, z : z + 8] @ t.T).astype(int)
                units.append((1, 0, [int(q[p]) for p in order]))
    scans, bits, last = [], "", 0
    for i, (dct, d, q) in enumerate(units):
        if interval and i and i % interval == 0:
            scans.append(bits)
            bits, last = "", 0
        if dct:
            d, last = q[0] - last, q[0]
        bits += put(abs(d).bit_length(), 5) + tail(d)
        run = 0
        for k in range(1, 64) if dct else ():
            if not any(q[k:]):
                bits += put(0, 8)
                break
            if q[k]:
                while run > 15:
                    bits, run = bits + put(0xF0, 8), run - 16
                bits, run = bits + put(run * 16 + abs(q[k]).bit_length(), 8) + tail(q[k]), 0
            else:
                run += 1
    scans.append(bits)
    pack = lambda b: int(b + "1" * (-len(b) % 8), 2).to_bytes(-(-len(b) // 8), "big").replace(b"\xff", b"\xff\0")
    seg = lambda marker, body: bytes([255, marker]) + (len(body) + 2).to_bytes(2, "big") + body
    counts = lambda n, at: bytes(n if i == at else 0 for i in range(1, 17))
    out = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, b"\0" + b"\1" * 64) + seg(0xC3 if lossless else 0xC0, bytes([8]) + h.to_bytes(2, "big") + w.to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))
    out += seg(0xC4, b"\0" + counts(17, 5) + bytes(range(17))) + seg(0xC4, b"\x10" + counts(255, 8) + bytes(range(255))) + (seg(0xDD, interval.to_bytes(2, "big")) if interval else b"")
    out += seg(0xDA, bytes([1, 1, 0, lossless, 0 if lossless else 63, 0]))
    for i, b in enumerate(scans):
        out += (bytes([255, 0xD0 + (i - 1) % 8]) if i else b"") + pack(b)
    return out + b"\xff\xd9"


def test_frames_of_others():
    rng = np.random.default_rng(3)
    smooth = np.clip(np.add.outer(np.arange(20) * 5, np.arange(27) * 4) + rng.integers(0, 40, (20, 27)), 0, 255).astype(np.uint8)
    for interval in (0, 3):
        got = media.decode_frame(jpeg(smooth, 0, interval)).astype(int)
        assert got.shape == smooth.shape and np.abs(got - smooth).max() <= 2
    for predictor in range(1, 8):
        assert (media.decode_frame(jpeg(smooth, predictor, 27 * 5 if predictor % 2 else 0)) == smooth).all()
    whole = jpeg(smooth)
    for bad in (b"", b"\xff\xd8\xff\xd9", whole[:200] + whole[-2:], whole.replace(b"\xff\xc0", b"\xff\xc2", 1)):
        with pytest.raises(ValueError):
            media.decode_frame(bad)


def test_media(spark, docs):
    import struct
    import zlib

    rows = media.media_features(docs).where("doc_id is not null").collect()
    assert len(rows) == docs.where("doc_id is not null").count()
    for r in rows:
        data = (ODD[r.doc_id] or "").encode()
        payload = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        stored = media.store(payload)
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
        assert len(stored) == 8 + struct.unpack("<I", stored[4:8])[0] + (-len(stored) % 2)
        lines = struct.unpack("<I", stored[64 + 4 : 64 + 8])[0]  # of the header
        frames = [media.decode_frame(f) for f in media.read_avi(stored)[0]]
        assert all(f.shape == (lines, 64) for f in frames)
        shown = [float(part.split("-")[0]) for part in r.feature.split(";")]
        hist = [np.bincount(f.ravel() // 16, minlength=16) / f.size for f in frames]
        cuts, seen = [0.0], []
        for i in range(1, len(hist)):
            d = abs(hist[i] - hist[i - 1]).sum() / 2
            if d > max(0.25, *([np.mean(seen[-8:]) + 2 * np.std(seen[-8:])] if seen else [0])):
                cuts.append(i / 25)
            seen.append(d)
        assert np.allclose(shown, cuts, atol=0.006)
    long = bytes(range(64)) * 64 + b"\xf0" * 4096 + bytes(range(64)) * 64
    stored = media.store(long)
    back, clips = media.load(stored)
    assert back == long and [c[2:] for c in clips] == [(0, 1), (1, 2)]
    frames = [jpeg(np.full((8, 8), v, np.uint8)) for v in (10, 10, 200)]
    other = media.write_avi(frames, 8, 8)
    at = other.index(b"idx1") + 8
    start = other.index(b"movi")
    absolute = bytearray(other)
    for i in range(3):  # offsets from the file's start
        place = at + 16 * i + 8
        absolute[place : place + 4] = (int.from_bytes(other[place : place + 4], "little") + start).to_bytes(4, "little")
    df = spark.createDataFrame([(1, bytearray(stored)), (2, None), (3, bytearray(b"no media")), (4, bytearray(other)), (5, absolute)], "doc_id long, media binary")
    got = sorted(tuple(r) for r in media.clips(df).where("error is null").collect())
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, 0, 0.0, 0.04), (1, 1, 0.04, 0.12), (4, 0, 0.0, 0.08), (4, 1, 0.08, 0.12), (5, 0, 0.0, 0.08), (5, 1, 0.08, 0.12)]
    assert [(r.doc_id, r.clip, r.error) for r in media.clips(df).where("error is not null").collect()] == [(3, None, "not an AVI file")]
    assert media.media_features(empty(docs)).count() == 0
    with pytest.raises(ValueError):
        media.read_avi(stored.replace(b"00dc", b"01dc", 1))


def test_toxicity(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 10 == 0
        words = ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(30)] + (["nastyword"] if bad else [])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(5000, None), (5001, ""), (None, "nastyword")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (0, 1, 0), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    r = toxicity.judge(d, lab).collect()
    held = [x for x in r if x.held_out]
    assert 200 < len(held) < 400 and all(x.predicted == int(x.doc_id % 10 == 0 and x.doc_id < 5000) for x in held)
    assert next(x for x in r if x.doc_id is None).held_out is False
    assert all(x.score == next(y for y in r if y.doc_id == 5000).score for x in r if x.doc_id == 5001)
    assert toxicity.clean(d, lab).where("doc_id % 10 = 0 and doc_id < 5000").count() == 0
    clash = toxicity.clean(d.withColumns({"toxicity_score": F.lit("mine"), "p": F.lit(3), "h": F.lit(4), "buckets": F.lit(5)}), lab)
    assert clash.columns == [*d.columns, "toxicity_score", "p", "h", "buckets"] and {tuple(r)[2:] for r in clash.collect()} == {("mine", 3, 4, 5)}
    assert all(x.predicted == 0 and x.score == 0 for x in toxicity.judge(d, empty(lab)).collect())
    again = d.unionByName(d.where("doc_id = 10").withColumn("text", F.explode(F.array_repeat("text", 300))))  # an id that fills the table
    assert all(x.predicted == int(x.doc_id % 10 == 0) for x in toxicity.judge(again, lab).where("held_out and doc_id < 5000").collect())
    assert toxicity.judge(empty(d), lab).count() == 0


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.COM"), (4, "http://a.com/x?y#z"), (5, "ftp://www.example.com/en/1"), (6, "http://example.com/en/2"), (7, "http://b.net/es/"), (8, "http://net/fr/"), (8, "http://net/fr/"), (9, "http://b.net/de/"), (10, "x://y\n/z")]
    p = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, rule string")
    got = urls.judge(p)
    same(got.select("page_id", "host", "path", "rule", "verdict"), *run_sql(urls.ORACLE, pages=p))
    r = {x.page_id: x.rule for x in got.collect()}
    assert [r[i] for i in range(1, 9)] == [None, None, None, "com/", "www.example.com/en/", "example.com/en/", "net/es/", "net/fr/"]
    assert urls.judge(empty(p)).count() == 0


def test_hosts_of_one_suffix_can_differ(spark):
    """By rules and by the caller's outcomes; names under a two-label suffix are domains of their own."""
    rules = (("block", "bad.net", "/x/"), ("allow", "good.net", "/x/"))
    rows = [(f"http://{h}/{p}/{i}", h) for h in ("a.bad.net", "b.good.net", "evil.co.uk", "fine.co.uk:8080") for p in ("x", "y") for i in range(40)]
    p = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, of string")
    told = p.where("of like '%co.uk%' and page_id % 2 = 0").select("page_id", F.col("of").startswith("evil").cast("int").alias("bad"))
    v = {(r.host, r.verdict) for r in urls.judge(p, rules, outcomes=told).where("path like '/y/%'").collect()}
    assert v == {("a.bad.net", "block"), ("b.good.net", "allow"), ("evil.co.uk", "block"), ("fine.co.uk:8080", "allow")}
    names = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "localhost": ("localhost", "localhost"), "": ("", "")}
    df = spark.createDataFrame([(k,) for k in names], "s string")
    assert {r.s: (r.d, r.x) for r in df.select("s", urls.domain_of(F.col("s")).alias("d"), urls.suffix_of(F.col("s")).alias("x")).collect()} == names


def test_suffixes(spark, docs):
    rng = np.random.default_rng(4)
    passage = "".join(rng.choice(list("abcdé "), 90))
    texts = [(i, "".join(rng.choice(list("abc"), 60)) + (passage if i % 2 else passage[:55]) + "".join(rng.choice(list("xyz"), i))) for i in range(12)]
    texts += [(20, "q" * 400), (21, "q" * 300), (22, "q" * 49), (20, "q" * 200), (None, passage), (30, None), (31, "")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    first = {}
    order = sorted(((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in texts)
    for i, t in order:
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    want = []
    for i, t in order:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        want.append((i, len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    for hot in ({}, {"hot": 0, "sampled": 1}):  # every leader taken as one that would fill a task: by window
        got = suffixes.dedup(d, ("n_bytes", "n_removed", "n_spans", "kept_sha256"), **hot).collect()
        assert sorted(((1 << 63) - 1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == sorted(want)
    assert suffixes.dedup(empty(d)).count() == 0
    clash = docs.withColumns({"n_removed": F.lit("mine"), "kept": F.lit(1), "row": F.lit("r"), "none": F.lit(0)})
    out = suffixes.deduplicated(clash)
    assert out.columns == clash.columns and out.count() == docs.count()
    assert {(r.n_removed, r.kept, r.row, r.none, r["size"]) for r in out.collect()} == {("mine", 1, "r", 0, "clash")}


def test_cut_characters_are_dropped(spark):
    """The repeat begins inside one character and ends inside another; their left halves make no character together."""
    a = "á" + "b" * 60 + "é" + " first text"
    b = "ġ" + "b" * 60 + "è" + " second text"  # á and ġ end with one byte, é and è begin with one
    d = spark.createDataFrame([(1, a, len(a), 1), (2, b, len(b), 1), (3, None, 0, 1), (4, "b" * 49, 49, 1)], "doc_id long, text string, n_chars long, x int")
    got = {r.doc_id: r for r in suffixes.deduplicated(d).collect()}
    assert got[1].text == a and got[3].text is None and got[4].text == "b" * 49
    assert got[2].text == " second text"
    assert all(r.n_chars == len(r.text or "") for r in got.values())


def test_a_text_of_over_a_million_bytes(spark):
    """Through every operator on texts, beside short ones that share a passage with it."""
    rng = np.random.default_rng(21)
    words = rng.choice([f"wörd{i}" for i in range(5000)], 170_000).tolist()
    words[1000:1003] = ["Apache", "License", "v"]
    long = " ".join(words)
    near = " ".join([*words[:70_000], "other", *words[70_001:]])
    short = " ".join(words[500:520])
    d = spark.createDataFrame([(1, long, "s", 0), (2, near, "s", 0), (3, short, None, 0), (4, None, "s", 0)], "doc_id long, text string, source string, n_chars long").repartition(2)
    size = len(long.encode())
    assert size > 1_000_000
    assert {r.doc_id: r["size"] for r in mixing.mix(d).collect()} == {1: 170_000, 2: 170_000, 3: 20, 4: 0}
    assert {r.doc_id: (r.n_words, r.n_base, r.base_labels) for r in licenses.scan(d).where("doc_id <> 2").collect()} == {1: (170_000, 1, "apache"), 3: (20, 0, ""), 4: (0, 0, "")}
    assert {r.doc_id: r.class_id for r in neardup.classes(d).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    r = {r.doc_id: r for r in media.media_features(d).collect()}
    assert r[1].n_bytes == size and r[1].payload_sha256 == hashlib.sha256(long.encode() + b"\0" * (-size % 64)).hexdigest()
    r = {r.doc_id: r for r in suffixes.dedup(d).collect()}
    assert r[1].n_removed == 0 and r[3].n_removed == r[3].n_bytes and r[2].n_removed == len(near.encode()) - len(b"other") and r[2].n_spans == 2
    lab = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.judge(d, lab).collect())
    pages = d.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/c").alias("url"), F.col("text").alias("html"))
    assert {r.page_id: r.payload_bytes for r in warc.archived(pages).collect()}[1] == size
    assert urls.judge(pages.withColumn("url", F.concat(F.lit("http://a.b/"), F.repeat(F.lit("x"), 1_200_000)))).where("length(path) = 1200001 and verdict = 'allow'").count() == 4


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    text = pa.array(["Ab cd-ef 1é", None, "", "long" * 50 + " x y", "ab CD"])
    whole = common.word_hashes(text, (2,))
    monkeypatch.setattr(common, "SLICE", 7)
    cut = common.word_hashes(text, (2,))
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert whole[0][0] == whole[0][-2] and whole[1].tolist() == [0, 0, 0, 0, 3, 3, 3, 4, 4]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    if not Path(SF).exists():
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0


def test_pipeline_run_against_plain_loops(spark, tmp_path):
    """Toxic texts and near copies go, a long passage stays once, sources meet their targets, tokens are the tokenizer's."""
    import corpus_pipeline

    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    own = {i: [word() for _ in range(60)] for i in range(300)}
    passage = [word() for _ in range(55)]
    for i in (40, 41, 42):
        own[i] += passage
    text = {i: " ".join(w) for i, w in own.items()}
    for i in range(0, 300, 10):
        text[i] += " nastyword and nastyword"
    text[501] = text[1]
    text[502] = " ".join([*own[2][:-1], "other"])
    text[503] = ""
    rows = [(i, t, "en", "a" if i % 3 else "b", len(t)) for i, t in text.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    clean = {i: t for i, t in text.items() if not (i < 300 and i % 10 == 0) and i not in (501, 502)}
    for i in (42,):  # 40 is toxic, so 41 keeps the passage
        shared = [i0 for i0 in range(len(clean[i])) if clean[i][i0 : i0 + 50] in clean[41] and len(clean[i][i0 : i0 + 50]) == 50]
        gone = {k for i0 in shared for k in range(i0, i0 + 50)}
        clean[i] = "".join(c for k, c in enumerate(clean[i]) if k not in gone)
    source = {i: "a" if i % 3 else "b" for i in clean}
    size = {s: sum(len(t.split()) for i, t in clean.items() if source[i] == s) for s in "ab"}
    target = {"a": sum(size.values()) * 5 / 7, "b": sum(size.values()) * 2 / 7}
    e = encoder()
    digest = {i: (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in clean.items() for ids in [e.encode_ordinary(t)]}
    assert {r.doc_id for r in got} <= set(clean) and all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == digest[r.doc_id] for r in got)
    times = {i: sum(r.doc_id == i for r in got) for i in clean}
    for s in "ab":
        assert abs(sum(n * len(clean[i].split()) for i, n in times.items() if source[i] == s) - target[s]) <= max(len(t.split()) for t in clean.values())
        assert len({n for i, n in times.items() if source[i] == s and clean[i]}) <= 2  # whole passes, and one more for some
    (tmp_path / "none").mkdir()
    spark.read.parquet(str(tmp_path / "documents.parquet")).where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(str(tmp_path / "labels.parquet")).where("false").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_texts_go_in_short_batches_and_memory_is_given_back(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with common.short_batches(spark):
        sizes = spark.range(2500).coalesce(1).mapInArrow(common.tidy(lambda bs: (pa.record_batch({"n": pa.array([b.num_rows])}) for b in bs)), "n long").collect()
    assert spark.conf.get(name) == before and max(r.n for r in sizes) == 1000 and sum(r.n for r in sizes) == 2500
    seen = []
    monkeypatch.setattr(neardup, "durable", lambda df, *a, **k: (seen.append((spark.conf.get(name), [f.name for f in df.schema])), common.durable(df, *a, **k))[1])
    neardup.classes(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string")).collect()
    assert next(n for n, columns in seen if "sketch" in columns) == "1000" and spark.conf.get(name) == before
