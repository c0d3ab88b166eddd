"""Suffix-array dedup: bytes covered by a LENGTH-byte string that also starts in a document of smaller id.

1. Every window of LENGTH bytes is led by the least hash of its GRAM-byte grams. Consecutive windows with
   the same leader form a run; equal windows have equal leaders wherever they stand, so only runs whose
   leader occurs in two documents can hold repeats (none is lost), and all of a leader's runs meet in one
   bucket. Chunks of documents send each leader once, packed by leader bucket.
2. Chunks send the text of each different shared run once, with the least and greatest id that holds it.
   A leader with over HOT different runs would fill a task; its windows go one by one instead, each led by the
   hash of all its bytes, so equal windows still meet and different ones spread over all buckets. How many runs a
   leader has is told by the 1 in SAMPLED of them whose hash is a multiple of SAMPLED, wherever they stand.
3. A bucket concatenates its different runs, sorts suffixes by SORTED bytes (prefix doubling), takes the
   Burrows-Wheeler transform and extends all intervals backwards breadth first: the boundaries that appear
   at step v have a common prefix of v bytes, by increasing v; it stops at LENGTH. What no boundary parts
   shares LENGTH bytes; the least id of each such group goes back to the chunks as ranges of windows.
4. Chunks mark the windows whose least id is smaller than the document's and cut the bytes they cover.

Chunks are some CHUNK bytes of documents by hash of id and text (small arrays are fast; with very much text chunks
grow to MOST_CHUNK, so that messages stay full); texts under LENGTH bytes are not shuffled; the other
text is shuffled once (the three steps that need it read the same exchange) and nothing is collected. Leader buckets
take the leaders of LEADERS bytes of text and run buckets the runs of RUNS bytes, so a message holds several leaders
and there are never more messages than leaders. A run that a third of all documents share costs one entry a
chunk. Work goes in slices of text, so memory does not grow with a document's neighbours.

Defined results: a null text is empty; a null id is greater than all others; rows that repeat an id do not
remove from each other; texts under LENGTH bytes stay whole; an empty table gives an empty result;
columns of the input named like an output are dropped by dedup(), all are kept by deduplicated().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from chronocell.llm.common import mix64, partitions, row_slices, utf8

LENGTH = 50
GRAM = 16
SORTED = 64
CHUNK, MOST_CHUNK, CHUNKS = 2 << 20, 32 << 20, 18  # bytes of text a chunk, and at most; over 2^CHUNKS of them, they are larger
LEADERS, RUNS = 256 << 20, 2 << 20  # bytes of text a bucket of leaders and of runs
HOT = 200_000  # different runs of a leader
SAMPLED = 1024
SLICE = 1 << 16  # bytes of text looked at at once
BLOCK = 1 << 17  # bytes of runs transformed at once
LAST = (1 << 63) - 1
_U = np.uint64
PARTS = "chunk int, kind int, a binary, b binary, c binary, d binary"


def _eights(x: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a big-endian number; x has 7 bytes more than the result."""
    two = (x[:-1].astype(np.uint64) << _U(8)) | x[1:]
    four = (two[:-2] << _U(16)) | two[2:]
    return (four[:-4] << _U(32)) | four[4:]


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpacked(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def bucket_of(leader: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of leaders, so leaders in order are in order of their buckets."""
    return ((leader >> _U(32)) * _U(buckets)) >> _U(32)


def runs(data: np.ndarray, off: np.ndarray, content: bool = True) -> tuple[np.ndarray, ...]:
    """Leader, row, first byte, end byte and content hash of every run of windows; if not asked for all of the content,
    the last is a hash of its first and last eight bytes and its length."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    eight = _eights(data)
    h = eight[:-8] * _U(0x9E3779B97F4A7C15)  # a gram of 16 bytes: leaders need an order that is as good as random, no more
    h += eight[8:] * _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    least, width, span = h, 1, LENGTH - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    count = np.maximum(np.diff(off) - LENGTH + 1, 0)  # windows of each row
    if not count.any():
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    step = np.zeros(n + 1, np.int8)
    opens = off[:-1][count > 0]
    step[opens] += 1
    np.subtract.at(step, opens + count[count > 0], 1)
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = least[1:] != least[:-1]
    new[opens] = True
    first = np.flatnonzero(new & inside)
    last = np.empty(n, bool)
    last[:-1] = new[1:] | ~inside[1:]
    last[-1] = True
    end = np.flatnonzero(last & inside) + LENGTH
    leader = mix64(least[first] ^ _U(0x5851F42D4C957F2D))
    row = np.searchsorted(off, first, "right") - 1
    if not content:
        return leader, row, first, end, mix64(eight[first] + mix64(eight[end - 8] + mix64(leader + (end - first).astype(np.uint64))))
    # content: every 8 bytes are mixed with their place from the run's leader on (sums of a per-place hash)
    word = mix64(eight)
    total = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word, out=total[1:])
    second = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * np.arange(len(word), dtype=np.uint64), out=second[1:])
    stop = end - 7
    s0 = total[stop] - total[first]
    s1 = second[stop] - second[first] - first.astype(np.uint64) * s0
    return leader, row, first, end, mix64(s0 + mix64(s1 + mix64(leader + (end - first).astype(np.uint64))))


def windows(leader: np.ndarray, row: np.ndarray, first: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs' windows as runs of their own, led by the hash of their bytes; in the form of runs()."""
    count = end - first - LENGTH + 1
    start = np.repeat(first - (count.cumsum() - count), count) + np.arange(count.sum())
    h = np.zeros(len(start), np.uint64)
    for i in range(0, LENGTH, 8):  # eight bytes at a time, the last two with zeros
        word = np.zeros(len(start), np.uint64)
        for j in range(i, i + 8):
            word = (word << _U(8)) | (data[start + j].astype(np.uint64) if j < LENGTH else _U(0))
        h = mix64(h * _U(0x9E3779B97F4A7C15) + word)
    return mix64(h), np.repeat(row, count), start, start + LENGTH, h


class Chunk:
    """Rows of a chunk, in a fixed order, and their runs."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").fill_null(LAST).cast(pa.int64())
        text = table.column("text").cast(pa.large_string())
        table = table.set_column(table.schema.get_field_index("text"), "text", text)
        size = pa.compute.fill_null(pa.compute.binary_length(text), 0)
        order = pa.compute.sort_indices(pa.table({"i": ids, "n": size, "t": text}), [("i", "ascending"), ("n", "ascending"), ("t", "ascending")])
        self.table = table.take(order)
        self.ids = self.table.column("doc_id").fill_null(LAST).cast(pa.int64()).to_numpy()
        self.text = self.table.column("text").combine_chunks()

    def slices(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for lo, hi in row_slices(self.text, SLICE):
            yield lo, hi, *utf8(self.text.slice(lo, hi - lo))

    def shared_runs(self, replies: pa.Table) -> list[tuple[np.ndarray, ...]]:
        """Of each slice: leader, row in the chunk, first, end and content of the runs whose leader is shared."""
        all_runs = [(lo, data, runs(data, off)) for lo, _, data, off in self.slices()]
        leaders = np.unique(np.concatenate([r[0] for _, _, r in all_runs])) if all_runs else np.zeros(0, np.uint64)
        shared, hot = np.zeros(len(leaders), bool), np.zeros(len(leaders), bool)
        for kind, a, b, c in zip(*(replies.column(x).to_pylist() for x in ("kind", "a", "b", "c")), strict=True):
            if kind == 0:  # a bucket's first leader, how many, and a bit for each
                at, n = np.frombuffer(a, np.int64)
                shared[at : at + n] = np.unpackbits(np.frombuffer(b, np.uint8), count=n)
                if c:
                    hot[at : at + n] = np.unpackbits(np.frombuffer(c, np.uint8), count=n)
        out = []
        for lo, data, (leader, row, first, end, content) in all_runs:
            place = np.searchsorted(leaders, leader)
            on, single = shared[place] & ~hot[place], shared[place] & hot[place]
            both = [(leader[on], row[on], first[on], end[on], content[on])]
            if single.any():
                both.append(windows(leader[single], row[single], first[single], end[single], data))
            x = [np.concatenate(c) for c in zip(*both, strict=True)]
            out.append((x[0], x[1] + lo, *x[2:]))
        return out


def _parts(rows: list[tuple]) -> pa.Table:
    names = ("chunk", "kind", "a", "b", "c", "d")
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of equal neighbours."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return s, np.r_[s[1:], len(x)]


def _send_leaders(buckets: int, sampled_of: int):
    def send(table: pa.Table) -> pa.Table:
        """chunk here is the bucket, kind the chunk: a 32 bits of each leader, b a bit whether two rows hold it, c their place, d sampled runs."""
        c = Chunk(table)
        both = [(x[0], c.ids[x[1] + lo], x[4]) for lo, _, data, off in c.slices() for x in [runs(data, off, False)]]
        leader, doc, content = (np.concatenate(x) for x in zip(*both, strict=True)) if both else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        some = content % _U(sampled_of) == 0
        sampled = np.unique(np.stack([leader[some], content[some]], 1), axis=0)
        order = np.argsort(leader, kind="stable")  # ids rise already
        leader, doc = leader[order], doc[order]
        s, e = _groups(leader)
        key, many = leader[s], doc[s] != doc[e - 1]
        here = table.column("_chunk")[0].as_py()
        bucket = bucket_of(key, buckets)
        rows = []
        for i, j in zip(*_groups(bucket), strict=True):
            x, y = np.searchsorted(sampled[:, 0], key[i], "left"), np.searchsorted(sampled[:, 0], key[j - 1], "right")
            d = sampled[x:y, 0].astype(np.uint32).tobytes() + sampled[x:y, 1].tobytes() if x < y else None
            rows.append((int(bucket[i]), here, key[i:j].astype(np.uint32).tobytes(), np.packbits(many[i:j]).tobytes(), np.array([i, j - i]).tobytes(), d))
        return _parts(rows)

    return send


def _hot_leaders(samples: list[bytes], most: int) -> np.ndarray:
    """32 bits of the leaders of which so many different runs were sampled that all may fill a task."""
    pairs = [(np.frombuffer(x, np.uint32, len(x) // 12), np.frombuffer(x, np.uint64, offset=len(x) // 3)) for x in samples if x]
    if not pairs:
        return np.zeros(0, np.uint32)
    both = np.unique(np.stack([np.concatenate([a for a, _ in pairs]).astype(np.uint64), np.concatenate([b for _, b in pairs])], 1), axis=0)
    leader, count = np.unique(both[:, 0], return_counts=True)
    return leader[count > most].astype(np.uint32)


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of x are in known, which is sorted."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _find_shared(most: int):
    def find(table: pa.Table) -> pa.Table:
        """Which leaders of a bucket two documents hold: bits back to each chunk that sent some, and bits of the hot ones.

        Leaders that agree in their 32 bits only are taken as shared too, which costs a little and loses nothing.
        """
        keys = [np.frombuffer(x, np.uint32) for x in table.column("a").to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) > 0 for x, k in zip(table.column("b").to_pylist(), keys, strict=True)]
        every = np.sort(np.concatenate([*keys, *(k[m] for k, m in zip(keys, many, strict=True))]))  # one that two rows hold counts twice
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        hot = _hot_leaders(table.column("d").to_pylist(), most)
        rows = []
        for chunk, place, k in zip(table.column("kind").to_pylist(), table.column("c").to_pylist(), keys, strict=True):
            if (bits := _among(k, shared)).any():
                burning = _among(k, hot)
                rows.append((chunk, 0, place, np.packbits(bits).tobytes(), np.packbits(burning).tobytes() if burning.any() else None, None))
        return _parts(rows)

    return find


def _numbered(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's different runs in order of leader and content, and the number of each run found."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    leader, content = (np.concatenate([x[i] for x in found]) for i in (0, 4))
    order = np.lexsort((content, leader))
    new = np.r_[True, (leader[order][1:] != leader[order][:-1]) | (content[order][1:] != content[order][:-1])] if len(order) else np.zeros(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _send_runs(buckets: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        """chunk here is the bucket, kind the chunk: a (leader, length), b (least id, greatest id), c text, d number of the first."""
        if not left.num_rows or not right.num_rows:
            return _parts([])
        c = Chunk(left)
        found = c.shared_runs(right)
        once, number = _numbered(found)
        leader, row, first, end = (np.concatenate([x[i] for x in found]) for i in range(4))
        least, most = np.full(len(once), LAST), np.full(len(once), -LAST - 1)
        np.minimum.at(least, number, c.ids[row])
        np.maximum.at(most, number, c.ids[row])
        data = [d for _, _, d, _ in c.slices()]
        piece = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])[once]
        text = [data[k][a:b].tobytes() for k, a, b in zip(piece.tolist(), first[once].tolist(), end[once].tolist(), strict=True)]
        leader, length = leader[once], (end - first)[once]
        here, rows = left.column("_chunk")[0].as_py(), []
        bucket = bucket_of(leader, buckets)
        for i, j in zip(*_groups(bucket), strict=True):
            a = zstandard.compress(leader[i:j].astype(np.uint32).tobytes() + length[i:j].astype(np.uint32).tobytes(), 1)
            rows.append((int(bucket[i]), here, a, _packed(np.r_[least[i:j], most[i:j]]), zstandard.compress(b"".join(text[i:j]), 3), np.int64(i).tobytes()))
        return _parts(rows)

    return send


def sort_suffixes(x: np.ndarray) -> np.ndarray:
    """Places of x in order of their first SORTED bytes (what runs past the end counts as 255s)."""
    n = len(x)
    key = _eights(np.r_[x, np.full(7, 255, np.uint8)])
    width = 8
    while True:
        order = np.argsort(key)
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, k[1:] != k[:-1]])
        if width >= SORTED or rank[order[-1]] == n - 1:
            return order
        ahead = np.full(n, n, np.int64)
        ahead[: n - width] = rank[width:] if width < n else ahead[:0]
        key = rank * (n + 1) + ahead
        width *= 2


def groups_of_prefix(x: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Number of each sorted suffix's group; a group shares its first length bytes.

    Backward extension on the transform: rows of one interval that are preceded by one byte are neighbours
    one step further, so a boundary at value v parts two neighbours exactly if their rows were parted at
    value v - 1. Only undecided places are looked at, and it ends early once a step parts nothing.
    """
    bwt = x[order - 1]
    back = np.argsort(bwt, kind="stable").astype(np.int32)  # row that a row of the first column was extended from
    column = bwt[back]
    parted = np.r_[True, column[1:] != column[:-1]]
    undecided = np.flatnonzero(~parted).astype(np.int32)
    for _ in range(1, length):
        interval = np.cumsum(parted, dtype=np.int32)
        new = interval[back[undecided]] != interval[back[undecided - 1]]
        if not new.any():
            break
        parted[undecided[new]] = True
        undecided = undecided[~new]
    return np.cumsum(parted) - 1


def least_ids(texts: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's windows in turn, the least id of a text with the same window; and each text's windows."""
    sep = b"\xff"  # in no UTF-8 text
    x = np.frombuffer(sep.join(texts) + sep, np.uint8)
    length = np.array([len(t) for t in texts])
    start = np.r_[0, (length + 1).cumsum()[:-1]]
    count = length - LENGTH + 1
    order = sort_suffixes(x)
    group = groups_of_prefix(x, order, LENGTH)
    place = np.repeat(start - (count.cumsum() - count), count) + np.arange(count.sum())
    row = np.empty(len(x), np.int64)
    row[order] = np.arange(len(x))
    g = group[row[place]]
    least = np.full(int(group[-1]) + 1, LAST)
    by = np.argsort(g)
    s, _ = _groups(g[by])
    least[g[by][s]] = np.minimum.reduceat(np.repeat(ids, count)[by], s)
    return least[g], count


def _transform(table: pa.Table) -> pa.Table:
    """Least ids of a bucket's windows, back to the chunks: a run's number, b first window and windows, c least id."""
    chunk, first_number, leader, length, low, high, texts = [], [], [], [], [], [], []
    for to, a, b, c, d in zip(*(table.column(x).to_pylist() for x in ("kind", "a", "b", "c", "d")), strict=True):
        x = _unpacked(a, np.uint32)
        n = len(x) // 2
        bounds, text = _unpacked(b, np.int64), zstandard.decompress(c)
        end = x[n:].cumsum()
        texts += [text[i:j] for i, j in zip((end - x[n:]).tolist(), end.tolist(), strict=True)]
        chunk.append(np.full(n, to))
        first_number.append(int(np.frombuffer(d, np.int64)[0]) + np.arange(n))
        leader.append(x[:n])
        length.append(x[n:].astype(np.int64))
        low.append(bounds[:n])
        high.append(bounds[n:])
    chunk, own, leader, length, low, high = (np.concatenate(x) for x in (chunk, first_number, leader, length, low, high))
    seen: dict[bytes, int] = {}
    same = np.array([seen.setdefault(t, len(seen)) for t in texts])
    different = list(seen)
    least = np.full(len(seen), LAST)
    np.minimum.at(least, same, low)
    lead, size = np.empty(len(seen), np.uint32), np.empty(len(seen), np.int64)
    lead[same], size[same] = leader, length
    by = np.argsort(lead, kind="stable")  # all runs of a leader stand together
    holders = np.argsort(same, kind="stable")
    edge = np.searchsorted(same[holders], np.arange(len(seen) + 1))
    out, lo = [], 0
    leaders, total = lead[by], np.r_[0, size[by].cumsum()]
    while lo < len(by):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + BLOCK, "right")) - 1)
        hi = int(np.searchsorted(leaders, leaders[min(hi, len(by)) - 1], "right"))
        w, count = least_ids([different[i] for i in by[lo:hi]], least[by[lo:hi]])
        run = np.repeat(np.arange(hi - lo), count)
        begin = count.cumsum() - count
        a = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (run[1:] != run[:-1])])
        b = np.r_[a[1:], len(w)]
        which = by[lo:hi][run[a]]  # ranges of windows with one least id, to all holders of the run
        times = edge[which + 1] - edge[which]
        each = np.repeat(np.arange(len(a)), times)
        holder = holders[np.arange(len(each)) - np.repeat(times.cumsum() - times, times) + np.repeat(edge[which], times)]
        on = w[a[each]] < high[holder]
        each, holder = each[on], holder[on]
        out.append((chunk[holder], own[holder], a[each] - begin[run[a[each]]], b[each] - a[each], w[a[each]]))
        lo = hi
    to, number, a, n, w = (np.concatenate([x[i] for x in out]) for i in range(5))
    by = np.argsort(to, kind="stable")
    return _parts([(int(to[by[i]]), 1, _packed(number[by[i:j]]), _packed(np.r_[a[by[i:j]], n[by[i:j]]]), _packed(w[by[i:j]]), None) for i, j in zip(*_groups(to[by]), strict=True)])


def _characters(data: np.ndarray, gone: np.ndarray) -> str:
    """The whole characters of what is left; bytes on two sides of a cut make none."""
    edge = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    return "".join(part.tobytes().decode("utf-8", "ignore") for part, cut in zip(np.split(data, edge), gone[np.r_[0, edge]], strict=True) if not cut)


def _cut(columns: list[str]):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        c = Chunk(left)
        mine = [(_unpacked(a, np.int64), _unpacked(b, np.int64).reshape(2, -1), _unpacked(w, np.int64)) for k, a, b, w in zip(*(right.column(x).to_pylist() for x in ("kind", "a", "b", "c")), strict=True) if k == 1]
        number = np.concatenate([x[0] for x in mine]) if mine else np.zeros(0, np.int64)
        order = np.argsort(number, kind="stable")
        number = number[order]
        span = np.concatenate([x[1] for x in mine], axis=1).T[order] if mine else np.zeros((0, 2), np.int64)
        least = np.concatenate([x[2] for x in mine])[order] if mine else np.zeros(0, np.int64)
        found = c.shared_runs(right)
        _, owns = _numbered(found)
        done = 0
        n_bytes, removed, spans, kept, left = [], [], [], [], []
        for (_, row, first, _, _), (_, _, data, off) in zip(found, c.slices(), strict=True):
            own = owns[done : done + len(row)]
            done += len(row)
            s, e = np.searchsorted(number, own, "left"), np.searchsorted(number, own, "right")
            each = np.repeat(np.arange(len(own)), e - s)
            at = np.arange(len(each)) - np.repeat((e - s).cumsum() - (e - s), e - s) + np.repeat(s, e - s)
            on = least[at] < c.ids[row[each]]
            each, at = each[on], at[on]
            opens = first[each] + span[at, 0]
            level = np.zeros(len(data) + 1, np.int64)
            np.add.at(level, opens, 1)
            np.subtract.at(level, opens + span[at, 1] + LENGTH - 1, 1)
            gone = np.cumsum(level[:-1]) > 0
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            inner = off[:-1][np.diff(off) > 0]
            rise[inner] = gone[inner]  # a row's own first byte opens a span of its own
            for count, flags in ((removed, gone), (spans, rise)):
                sums = np.r_[0, np.cumsum(flags)]
                count.append(sums[off[1:]] - sums[off[:-1]])
            n_bytes.append(np.diff(off))
            kept += [data[a:b][~gone[a:b]].tobytes() if r else data[a:b].tobytes() for a, b, r in zip(off[:-1], off[1:], removed[-1], strict=True)]
            if "kept_text" in columns:
                left += [_characters(data[a:b], gone[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
        more = {"n_bytes": pa.array(np.concatenate(n_bytes).astype(np.int64)), "n_removed": pa.array(np.concatenate(removed).astype(np.int64)), "n_spans": pa.array(np.concatenate(spans).astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]), "kept": pa.array(kept, pa.binary()), "kept_text": pa.array(left or [None] * len(kept), pa.string())}
        return pa.table({x: more[x] if x in more else c.table.column(x) for x in columns})

    return cut


OUT = {"n_bytes": LongType(), "n_removed": LongType(), "n_spans": LongType(), "kept_sha256": StringType(), "kept": BinaryType(), "kept_text": StringType()}


def dedup(docs: DataFrame, outputs: tuple[str, ...] = tuple(OUT), hot: int = HOT, sampled: int = SAMPLED) -> DataFrame:
    """docs (without text) with outputs: bytes, removed bytes, removed spans, digest and bytes of what is left, and its whole characters."""
    p = partitions(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    total = docs.agg(F.sum(size)).first()[0] or 0
    parts = lambda of: max(p, -(-total // of))
    chunk = min(MOST_CHUNK, max(CHUNK, total >> CHUNKS))
    kept = [c for c in docs.columns if c not in (*OUT, "_chunk", "text")]
    own = [F.col(f"`{c}`") for c in kept]
    text = F.coalesce("text", F.lit(""))
    alone = {"n_bytes": size, "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept_sha256": F.sha2(text.cast("binary"), 256), "kept": text.cast("binary"), "kept_text": text}
    short = docs.where(size < LENGTH).select(*own, *(alone[o].alias(o) for o in outputs))

    base = docs.where(size >= LENGTH).select(*own, "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts(chunk))).cast("int").alias("_chunk"))
    leaders = base.groupBy("_chunk").applyInArrow(_send_leaders(parts(LEADERS), sampled), PARTS)
    shared = leaders.groupBy("chunk").applyInArrow(_find_shared(hot // sampled), PARTS)
    sent = base.groupBy("_chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_runs(parts(RUNS)), PARTS)
    least = sent.groupBy("chunk").applyInArrow(_transform, PARTS)
    columns = [*kept, *outputs]
    schema = StructType([*(docs.schema[c] for c in kept), *(StructField(o, OUT[o]) for o in outputs)])
    both = shared.unionByName(least)
    return base.groupBy("_chunk").cogroup(both.groupBy("chunk")).applyInArrow(_cut(columns), schema).unionByName(short)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut from their text; what a cut leaves of a character is dropped, and n_chars, if
    there, is counted anew for a text that was cut. All columns are kept; a null text stays null."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    d = dedup(docs.select("doc_id", "text", others, F.col("text").isNull().alias("none")), ("n_removed", "kept_text"))
    text = F.when(~F.col("none"), F.col("kept_text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": text}
    return d.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
