"""Byte-level BPE encoding and decoding.

Spark's regular expressions split each text into the pattern's pieces; a partition's batch is turned into
its distinct pieces, and DuckDB encodes those: a recursive query over token-position rows joins each pair
of neighbours to the merge table and contracts every piece's pairs of least rank, from the left, until no pair is
left. Decoding is an ordered aggregation of the vocabulary's bytes over (piece, position, id) rows. Texts
are never shuffled; pieces seen before by a worker come from a bounded cache.

A step contracts all places of the least rank that the leftmost-first rule would take one after the other: of places
that overlap every second one, and none behind a place whose new token forms a pair of still lower rank with a
neighbour, as that pair would come first. So a piece takes about as many steps as it has different ranks, however
long it is, and the ids are those of one contraction at a time. A piece that is a vocabulary entry is that one id.

Defined results: a null or empty text has no ids, and the digests of the empty string; repeated rows each
give a row; an empty table an empty result; other columns are kept by encode() and ignored by digests().
The vocabulary file is read by the driver and sent along (about 1 MB).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 400_000  # bytes of pieces encoded at once (a longer piece stands alone)
SLICE = 1_000_000  # pieces of whole texts put together at once
CACHE, CACHED = 250_000, 64  # pieces kept, and the longest that are
#: White space as the pattern's \s means it, and the pattern with it spelled out.
SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"

#: k is the piece's number (upper 32 bits) and the token's place in bytes, nk the next token's; nxt its id, -1 at the end.
RECURSION = """
WITH RECURSIVE t(k, nk, tok, nxt, done) AS (
  SELECT k, k + 1, tok, nxt, false FROM opening
  UNION ALL
  (WITH pairs AS MATERIALIZED (SELECT t.k, t.nk, m.id FROM t JOIN merges m ON m.l = t.tok AND m.r = t.nxt WHERE NOT done),
   least AS MATERIALIZED (SELECT k >> 32 AS w, min(id) AS id FROM pairs GROUP BY w),
   hits AS MATERIALIZED (SELECT p.k, p.nk, p.id FROM pairs p JOIN least l ON p.k >> 32 = l.w AND p.id = l.id),
   several AS MATERIALIZED (SELECT k >> 32 AS w FROM hits GROUP BY w HAVING count(*) > 1),
   many AS (SELECT k, nk, id, k >> 32 AS w FROM hits SEMI JOIN several ON k >> 32 = w),
   chains AS (SELECT *, CASE WHEN lag(nk) OVER x = k THEN 0 ELSE 1 END AS opens, row_number() OVER x AS nr FROM many WINDOW x AS (PARTITION BY w ORDER BY k)),
   apart AS MATERIALIZED (SELECT k, nk, id, w FROM (SELECT *, max(CASE WHEN opens = 1 THEN nr END) OVER (PARTITION BY w ORDER BY k) AS start FROM chains) WHERE (nr - start) % 2 = 0),
   judged AS (SELECT a.k, a.nk, a.id, a.w, CASE WHEN x.l IS NOT NULL OR y.l IS NOT NULL THEN 1 ELSE 0 END AS stops
              FROM apart a
              LEFT JOIN t b ON b.k = a.nk
              LEFT JOIN lower y ON y.l = a.id AND y.r = b.nxt
              LEFT JOIN t f ON f.nk = a.k
              LEFT JOIN apart g ON g.nk = f.k
              LEFT JOIN lower x ON x.r = a.id AND x.l = CASE WHEN g.k IS NULL THEN f.tok ELSE a.id END),
   safe AS (SELECT k, nk, id FROM (SELECT *, sum(stops) OVER (PARTITION BY w ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM judged) WHERE coalesce(before, 0) = 0),
   now AS (SELECT k, nk, id FROM safe UNION ALL SELECT k, nk, id FROM hits ANTI JOIN several ON k >> 32 = w),
   taken AS MATERIALIZED (SELECT n.k, n.nk AS second, n.id, b.nk AS after, b.nxt FROM now n JOIN t b ON b.k = n.nk)
   SELECT t.k, coalesce(n.after, t.nk), coalesce(n.id, t.tok), coalesce(f.id, n.nxt, t.nxt), l.w IS NULL
   FROM t LEFT JOIN least l ON l.w = t.k >> 32 LEFT JOIN taken n ON n.k = t.k LEFT JOIN taken f ON f.k = coalesce(n.after, t.nk) ANTI JOIN taken g ON g.second = t.k
   WHERE NOT t.done))
SELECT (k >> 32)::INT AS w, (k & 4294967295)::INT AS pos, tok FROM t WHERE done
"""
DECODING = "SELECT w // 512 AS part, count(*) AS n, string_agg(hex, '' ORDER BY w, pos) AS hex FROM tokens JOIN vocabulary USING (tok) GROUP BY part ORDER BY part"


def pieces_pattern(pattern: str) -> str:
    """The pattern with \\s and \\S as explicit classes."""
    negated = pattern.replace(r"[^\s", f"[^{SPACE}")
    return negated.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """A worker's DuckDB with the merge table and vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.ranks, self.cache = ranks, {}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        cut = [(ranks[b[:i]], ranks[b[i:]], m) for b, m in ranks.items() for i in range(1, len(b)) if b[:i] in ranks and b[i:] in ranks]
        merges = pa.table(dict(zip(("l", "r", "id"), (pa.array(x, pa.int32()) for x in zip(*cut)), strict=True)))
        vocabulary = pa.table({"tok": pa.array(ranks.values(), pa.int32()), "hex": [b.hex() for b in ranks]})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(b) for b in ranks]
        self.names = pa.array([str(i) for i in range(len(self.length))], pa.large_string())
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.con.register("given", table)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.execute("CREATE TABLE lower AS SELECT l, r FROM merges WHERE id < greatest(l, r)")  # pairs that come before a part of theirs

    def tokens(self, pieces: list[bytes]) -> pa.Table:
        """(w, pos, tok) rows of all pieces; pos is the place in bytes."""
        whole = [(i, r) for i, b in enumerate(pieces) if (r := self.ranks.get(b)) is not None]
        done = {i for i, _ in whole}
        rest = [i for i in range(len(pieces)) if i not in done]
        length = np.array([len(pieces[i]) for i in rest], np.int64)
        end = length.cumsum()
        tok = self.bytes[np.frombuffer(b"".join(pieces[i] for i in rest), np.uint8)] if rest else np.zeros(0, np.int32)
        nxt = np.r_[tok[1:], np.int32(-1)][: len(tok)]
        nxt[end - 1] = -1
        place = np.arange(len(tok)) - np.repeat(end - length, length)
        k = (np.repeat(np.array(rest, np.int64), length) << 32) + place
        self.con.register("opening", pa.table({"k": k, "tok": tok.astype(np.int32), "nxt": nxt.astype(np.int32)}))
        found = self.con.sql(RECURSION).to_arrow_table()
        more = [(i, 0, r) for i, r in whole]
        extra = pa.table(dict(zip(("w", "pos", "tok"), (pa.array(x, pa.int32()) for x in (zip(*more) if more else ((), (), ()))), strict=True)))
        return pa.concat_tables([found.cast(extra.schema), extra])

    def decode(self, tokens: pa.Table, pieces: int) -> list[tuple[int, str, bytes]]:
        """(number of ids, ids as text, bytes) of each w from 0, from its ids alone.

        One ordered aggregation gives the bytes of 512 pieces in a row; the ids' lengths cut them.
        """
        w, pos, tok = (tokens[c].to_numpy() for c in ("w", "pos", "tok"))
        if len(tok) and (tok.min() < 0 or tok.max() >= len(self.length) or not self.length[tok].all()):
            raise ValueError("an id is not in the vocabulary")
        self.con.register("tokens", tokens)
        data = bytes.fromhex("".join(self.con.sql(DECODING).to_arrow_table()["hex"].to_pylist()))
        order = np.lexsort((pos, w))
        number = np.bincount(w, minlength=pieces)
        end = np.r_[0, number.cumsum()]
        at = np.r_[0, self.length[tok[order]].cumsum()][end].tolist()
        text = pc.binary_join(pa.LargeListArray.from_arrays(end, self.names.take(pa.array(tok[order]))), pa.scalar(" ", pa.large_string())).to_pylist()
        return [(n, t, data[s:e]) for n, t, s, e in zip(number.tolist(), text, at[:-1], at[1:], strict=True)]

    def coded(self, pieces: list[str]) -> list[tuple[int, str, bytes]]:
        missing = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(missing) > CACHE:
            self.cache = {p: c for p in pieces if (c := self.cache.get(p)) is not None}
        size = np.cumsum([len(p) for p in missing])
        fresh, at = {}, 0
        while at < len(missing):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK, "right")))
            block = missing[at:end]
            fresh.update(zip(block, self.decode(self.tokens([p.encode() for p in block]), len(block)), strict=True))
            at = end
        out = [c if (c := self.cache.get(p)) is not None else fresh[p] for p in pieces]
        self.cache.update((p, c) for p, c in fresh.items() if len(p) <= CACHED)
        return out


_CODECS: dict[str, Codec] = {}


def _codec(blob: bytes) -> Codec:
    name = hashlib.sha256(blob).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())})
    return _CODECS[name]


def _coded_texts(codec: Codec, pieces: pa.ListArray) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array]]:
    """For slices of texts: numbers of ids, ids joined by a space, decoded bytes."""
    off, lo, n = np.asarray(pieces.offsets).astype(np.int64), 0, len(pieces)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + SLICE, "right")) - 1))
        own = off[lo : hi + 1] - off[lo]
        d = pieces.values.slice(off[lo], own[-1]).dictionary_encode()
        if isinstance(d, pa.ChunkedArray):
            d = d.combine_chunks()
        codes = d.indices
        coded = codec.coded(d.dictionary.to_pylist())
        number, text, back = zip(*coded) if coded else ((), (), ())
        total = np.r_[0, np.array(number, np.int64)[np.asarray(codes)].cumsum()] if len(codes) else np.zeros(1, np.int64)
        put = lambda parts, kind, by, own=own, codes=codes: pc.binary_join(pa.LargeListArray.from_arrays(own, pa.array(parts, kind).take(codes)), pa.scalar(by, kind))
        yield np.diff(total[own]), put(text, pa.large_string(), " "), put(back, pa.large_binary(), b"")
        lo = hi


def _unused(docs: DataFrame) -> str:
    name = "pieces"
    while name in docs.columns:
        name += "_"
    return name


def _with_pieces(docs: DataFrame, pattern: str, columns: list) -> DataFrame:
    return docs.select(*columns, F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(pieces_pattern(pattern)), 0).alias(_unused(docs)))


def _blob(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _schema(df: DataFrame, more: str) -> str:
    """All columns but the pieces, which come last."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]), more])


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and DIGESTS of every text: encoded, then decoded from the ids."""
    blob = _blob(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(blob)
        for b in batches:
            lo = 0
            for number, ids, back in _coded_texts(codec, b.column(b.num_columns - 1)):
                sha = lambda col: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in col])
                yield pa.record_batch({"doc_id": b.column("doc_id").slice(lo, len(number)), "n_tokens": pa.array(number), "ids_sha256": sha(ids), "decoded_sha256": sha(back)})
                lo += len(number)

    d = _with_pieces(docs, pattern, ["doc_id"])
    return d.mapInArrow(run, _schema(d, DIGESTS))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs with `ids array<int>` (a column of that name is replaced)."""
    blob = _blob(path)
    kept = [c for c in docs.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(blob)
        for b in batches:
            lo = 0
            for number, ids, _ in _coded_texts(codec, b.column(b.num_columns - 1)):
                flat = [int(i) for x in ids.to_pylist() for i in x.split()]
                own = pa.ListArray.from_arrays(pa.array(np.r_[0, number.cumsum()], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.record_batch([*(b.column(c).slice(lo, len(number)) for c in kept), own], names=[*kept, "ids"])
                lo += len(number)

    d = _with_pieces(docs, pattern, [F.col(f"`{c}`") for c in kept])
    return d.mapInArrow(run, _schema(d, "ids array<int>"))


def decode(coded: DataFrame, path: str) -> DataFrame:
    """coded with `decoded binary` from its ids; an id outside the vocabulary fails."""
    blob = _blob(path)
    kept = [c for c in coded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(blob)
        for b in batches:
            rows = b.column("ids").to_pylist()
            tokens = [(w, p, t) for w, ids in enumerate(rows) for p, t in enumerate(ids or ())]
            table = pa.table(dict(zip(("w", "pos", "tok"), (pa.array(x, pa.int32()) for x in (zip(*tokens) if tokens else ((), (), ()))), strict=True)))
            yield pa.record_batch([*(b.column(c) for c in kept), pa.array([x[2] for x in codec.decode(table, len(rows))], pa.binary())], names=[*kept, "decoded"])

    d = coded.select(*[F.col(f"`{c}`") for c in kept])
    return d.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema), "decoded binary"]))
