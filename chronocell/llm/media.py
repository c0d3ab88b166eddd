"""Media columns: AVI motion-JPEG.

A frame of ours is a one-component lossless JPEG (the Huffman process with predictor 1), so its 8-bit samples come
back exactly. Difference category s gets a code of 9 - s bits, which makes every difference take 9 bits:
eight samples fill nine bytes, and both directions are array operations. A RIFF file holds the frames of
one media value in order, with an idx1 index; reading parses the chunks, follows the index (offsets from the movi list
or from the file's start), checks it and decodes each frame by itself. Frames of others may be baseline or extended
Huffman JPEG of 8 bits with any sampling and restart intervals, or lossless JPEG with any predictor; they are decoded
bit by bit, and their first component, the luminance, is what is looked at. Progressive and arithmetic JPEG, and frames
that leave their Huffman tables to the reader, are refused. Shots end where the histogram difference of neighbouring
frames passes an adaptive threshold (mean plus DEVIATIONS standard deviations of the last WINDOW differences, LEAST at
least); each shot is a clip with its time span.

Texts map to frames of WIDTH samples a line and LINES lines at most, all frames of a text alike; what pads the last
one is told by a comment chunk with the payload's size. Defined results: null and empty texts
are 64 zero bytes; texts of any length are coded whole, one at a time; repeated rows each give a row; an
empty table an empty result; other columns are ignored; a media value that cannot be read is one row with the reason.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WIDTH, LINES = 64, 64
FPS = 25
BINS = 16
WINDOW, DEVIATIONS, LEAST = 8, 2.0, 0.25
FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """9-bit code of each difference -255..255, and back (code 511 is unused, as JPEG asks)."""
    code, back = np.zeros(511, np.uint16), np.zeros(512, np.int16)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        prefix = ((1 << (8 - s)) - 1) << 1  # 8 - s ones and a zero: 9 - s bits
        code[d + 255] = (prefix << s) | (d if d >= 0 else d + (1 << s) - 1)
        back[code[d + 255]] = d
    return code, back


CODE, BACK = _code_tables()
#: JPEG markers. One DC table with one code a length 1..9 for categories 8..0.
_DHT = b"\xff\xc4" + struct.pack(">HB", 2 + 1 + 16 + 9, 0) + bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))
_SOS = b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)


def encode_frame(samples: np.ndarray) -> bytes:
    """Lossless JPEG of a (lines, width) uint8 array; width a multiple of 8."""
    h, w = samples.shape
    x = samples.astype(np.int16)
    d = np.empty_like(x)
    d[:, 1:] = x[:, 1:] - x[:, :-1]
    d[1:, 0] = x[1:, 0] - x[:-1, 0]
    d[0, 0] = x[0, 0] - 128
    c = CODE[d.reshape(-1, 8) + 255]
    out = np.empty((len(c), 9), np.uint8)
    out[:, 0] = c[:, 0] >> 1
    for i in range(1, 8):
        out[:, i] = ((c[:, i - 1] << (8 - i)) | (c[:, i] >> (i + 1))) & 255
    out[:, 8] = c[:, 7] & 255
    scan = out.tobytes().replace(b"\xff", b"\xff\x00")
    sof = b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, h, w, 1, 1, 0x11, 0)
    return b"\xff\xd8" + sof + _DHT + _SOS + scan + b"\xff\xd9"


class _Bits:
    """A scan's bits between two restart markers."""

    def __init__(self, data: bytes):
        self.data, self.at, self.have, self.left = data.replace(b"\xff\x00", b"\xff"), 0, 0, 0

    def take(self, n: int) -> int:
        while self.left < n:
            if self.at >= len(self.data) + 4:
                raise ValueError("a scan ends early")
            self.have = (self.have << 8 | (self.data[self.at] if self.at < len(self.data) else 0xFF)) & 0xFFFFFFFFFF
            self.at, self.left = self.at + 1, self.left + 8
        self.left -= n
        return self.have >> self.left & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (s := table.get((n, code))) is not None:
                return s
        raise ValueError("a code is in no table")

    def signed(self, n: int) -> int:
        """The difference of category n."""
        if n == 16:
            return 32768
        v = self.take(n) if n else 0
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _tables(body: bytes) -> Iterator[tuple[int, dict[tuple[int, int], int]]]:
    """Class and number of each Huffman table of a DHT segment, with (length, code) to symbol."""
    at = 0
    while at < len(body):
        key, counts = body[at], body[at + 1 : at + 17]
        at, code, table = at + 17, 0, {}
        for n, count in enumerate(counts, 1):
            for _ in range(count):
                table[n, code] = body[at]
                at, code = at + 1, code + 1
            code <<= 1
        yield key, table


def _zigzag() -> np.ndarray:
    """Row-major place of each coefficient in the order in which they are coded."""
    walk = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    return np.array([8 * y + x for y, x in walk])


ZIGZAG = _zigzag()
_K = np.arange(8)
COSINES = np.where(_K[:, None] == 0, np.sqrt(0.125), 0.5) * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16)  # frequency by place


def _blocks(parts: list[dict], shape: tuple[int, int], scans: list[bytes], every: int, quants: dict) -> np.ndarray:
    """The first component of a sequential DCT scan."""
    h_most, v_most = max(p["h"] for p in parts), max(p["v"] for p in parts)
    if len(parts) == 1:
        parts[0] |= {"h": 1, "v": 1}
        h_most = v_most = 1
    across, down = -(-shape[1] // (8 * h_most)), -(-shape[0] // (8 * v_most))
    first, total = parts[0], across * down
    out = np.zeros((down * first["v"], across * first["h"], 64))
    done = 0
    for scan in scans:
        bits, last = _Bits(scan), [0] * len(parts)
        for mcu in range(done, min(total, done + (every or total))):
            for i, p in enumerate(parts):
                for v in range(p["v"]):
                    for h in range(p["h"]):
                        last[i] += bits.signed(bits.symbol(p["dc"]))
                        coded, k = [(0, last[i])], 1
                        while k < 64:
                            run, size = divmod(bits.symbol(p["ac"]), 16)
                            if not size and run < 15:
                                break
                            k += run
                            if size:
                                if k > 63:
                                    raise ValueError("a block has too many coefficients")
                                coded.append((k, bits.signed(size)))
                            k += 1
                        if p is first:
                            y, x = divmod(mcu, across)
                            block = out[y * p["v"] + v, x * p["h"] + h]
                            for k, value in coded:
                                block[ZIGZAG[k]] = value * quants[p["q"]][k]
        done = min(total, done + (every or total))
    if done < total:
        raise ValueError("a scan ends early")
    pixels = np.einsum("ij,yxik,kl->yxjl", COSINES, out.reshape(*out.shape[:2], 8, 8), COSINES)
    whole = pixels.transpose(0, 2, 1, 3).reshape(out.shape[0] * 8, out.shape[1] * 8)
    h, w = -(-shape[0] * first["v"] // v_most), -(-shape[1] * first["h"] // h_most)
    return np.clip(np.rint(whole + 128), 0, 255).astype(np.uint8)[:h, :w]


def _predicted(parts: list[dict], shape: tuple[int, int], scans: list[bytes], every: int, how: int, shift: int) -> np.ndarray:
    """The first component of a lossless scan."""
    h, w = shape
    x = np.zeros((len(parts), h, w), np.int64)
    at = 0
    for scan in scans:
        bits, stop, fresh = _Bits(scan), min(h * w, at + (every or h * w)), at
        while at < stop:
            r, c = divmod(at, w)
            for i, p in enumerate(parts):
                own = x[i]
                if r * w + c == fresh:
                    guess = 1 << (7 - shift)
                elif r == fresh // w:
                    guess = own[r, c - 1]
                elif c == 0:
                    guess = own[r - 1, 0]
                else:
                    a, b, d = int(own[r, c - 1]), int(own[r - 1, c]), int(own[r - 1, c - 1])
                    guess = (a, b, d, a + b - d, a + (b - d >> 1), b + (a - d >> 1), a + b >> 1)[how - 1]
                own[r, c] = (guess + bits.signed(bits.symbol(p["dc"]))) & 0xFFFF
            at += 1
    if at < h * w:
        raise ValueError("a scan ends early")
    return (x[0] << shift).astype(np.uint8)


def decode_frame(data: bytes) -> np.ndarray:
    """The samples of a JPEG frame's first component; ValueError for what it cannot decode."""
    end = data.rfind(b"\xff\xd9")
    if data[:2] != b"\xff\xd8" or end < 0:
        raise ValueError("not a JPEG frame")
    try:
        return _decoded(data, end)
    except (IndexError, KeyError, struct.error) as e:
        raise ValueError(f"damaged JPEG frame: {e!r}") from e


def _decoded(data: bytes, end: int) -> np.ndarray:
    at, shape, process, parts, tables, quants, every, own = 2, None, None, {}, {}, {}, 0, True
    while True:
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4])
        body = data[at + 4 : at + 2 + n]
        if marker in (0xC0, 0xC1, 0xC3):
            precision, h, w, count = struct.unpack(">BHHB", body[:6])
            process, shape = marker, (h, w)
            parts = {body[6 + 3 * i]: {"h": body[7 + 3 * i] >> 4, "v": body[7 + 3 * i] & 15, "q": body[8 + 3 * i]} for i in range(count)}
            if precision != 8 or not h or not w:
                raise ValueError("8-bit samples of a known size expected")
        elif marker == 0xC4:
            own &= data[at : at + 2 + n] == _DHT
            tables.update(_tables(body))
        elif marker == 0xDB:
            while body:
                wide, number = body[0] >> 4, body[0] & 15
                size = 64 << wide
                quants[number] = np.frombuffer(body[1 : 1 + size], ">u2" if wide else np.uint8).astype(float)
                body = body[1 + size :]
        elif marker == 0xDD:
            every, own = int.from_bytes(body[:2]), False
        elif 0xC2 <= marker <= 0xCF:
            raise ValueError(f"JPEG process {marker - 0xC0} is not decoded")
        at += 2 + n
        if marker == 0xDA:
            break
    chosen = [parts[body[1 + 2 * i]] | {"dc": tables[body[2 + 2 * i] >> 4], "ac": tables.get(16 + (body[2 + 2 * i] & 15))} for i in range(body[0])]
    how, low = body[1 + 2 * body[0]], body[3 + 2 * body[0]] & 15
    if len(chosen) != len(parts):
        raise ValueError("all components are expected in one scan")
    if process == 0xC3 and own and how == 1 and not low and len(parts) == 1 and shape[1] % 8 == 0:
        return _nine_bits(data[at:end], shape)
    scans = re.split(rb"\xff[\xd0-\xd7]", data[at:end])
    if process == 0xC3:
        if not 1 <= how <= 7 or any((p["h"], p["v"]) != (1, 1) for p in parts.values()):
            raise ValueError("a predictor of 1 to 7 and components of one size expected")
        return _predicted(chosen, shape, scans, every, how, low)
    return _blocks(chosen, shape, scans, every, quants)


def _nine_bits(data: bytes, shape: tuple[int, int]) -> np.ndarray:
    """Predictor 1 by our own table: every difference takes nine bits."""
    scan = data.replace(b"\xff\x00", b"\xff")
    if 8 * len(scan) != 9 * shape[0] * shape[1]:
        raise ValueError("a scan ends early")
    scan = np.frombuffer(scan, np.uint8).reshape(-1, 9).astype(np.uint16)
    c = np.empty((len(scan), 8), np.uint16)
    for i in range(8):
        c[:, i] = ((scan[:, i] << (i + 1)) | (scan[:, i + 1] >> (7 - i))) & 511
    d = BACK[c].astype(np.int32).reshape(shape)
    d[:, 0] = np.cumsum(d[:, 0]) + 128
    return np.cumsum(d, axis=1).astype(np.uint8)


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)


def _list(name: bytes, data: bytes) -> bytes:
    return _chunk(b"LIST", name + data)


def write_avi(frames: list[bytes], width: int = WIDTH, height: int = LINES, fps: int = FPS, comment: bytes = b"") -> bytes:
    size = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // fps, size * fps, 0, 0x10, len(frames), 0, 1, size, width, height, 0, 0, 0, 0)
    strh = b"vids" + b"MJPG" + struct.pack("<IHHIIIIIIIIHHHH", 0, 0, 0, 0, 1, fps, 0, len(frames), size, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IIIHH4sIIIII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    head = _list(b"hdrl", _chunk(b"avih", avih) + _list(b"strl", _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    info = _list(b"INFO", _chunk(b"ICMT", comment)) if comment else b""
    index, movi, at = [], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + head + info + _list(b"movi", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: memoryview, lo: int, hi: int) -> Iterator[tuple[bytes, int, int]]:
    while lo + 8 <= hi:
        name, n = bytes(data[lo : lo + 4]), int.from_bytes(data[lo + 4 : lo + 8], "little")
        if lo + 8 + n > hi:
            raise ValueError("a chunk runs past its list")
        yield name, lo + 8, n
        lo += 8 + n + n % 2


def read_avi(data: bytes) -> tuple[list[bytes], float, bytes]:
    """Video frames in order of the index, seconds a frame, and the comment; ValueError for what is no such file."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    view, movi, index, period, comment = memoryview(data), None, None, None, b""
    for name, at, n in _chunks(view, 12, min(len(data), 8 + int.from_bytes(data[4:8], "little"))):
        kind = data[at : at + 4]
        if name == b"LIST" and kind == b"hdrl":
            for sub, start, _ in _chunks(view, at + 4, at + n):
                if sub == b"avih":
                    period = int.from_bytes(data[start : start + 4], "little") / 1e6
        elif name == b"LIST" and kind == b"INFO":
            comment = next((data[start : start + size] for sub, start, size in _chunks(view, at + 4, at + n) if sub == b"ICMT"), b"")
        elif name == b"LIST" and kind == b"movi":
            movi = at
        elif name == b"idx1":
            index = list(struct.iter_unpack("<4sIII", data[at : at + n - n % 16]))
    if movi is None or index is None or period is None:
        raise ValueError("header, frames or index missing")
    head = lambda at: (data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little"))
    frames, start = [], movi
    for i, (name, _, offset, n) in enumerate(index):
        if not i and head(movi + offset) != (name, n):
            start = 0  # offsets from the file's start
        if head(start + offset) != (name, n):
            raise ValueError("the index does not fit the frames")
        if name[2:] in (b"dc", b"db"):
            frames.append(data[start + offset + 8 : start + offset + 8 + n])
    return frames, period, comment


def shots(frames: list[np.ndarray], period: float) -> list[tuple[float, float, int, int]]:
    """(start s, end s, first frame, frames) of each shot."""
    cuts = [0]
    if len(frames) > 1:
        shift = 8 - (BINS - 1).bit_length()
        hist = np.stack([np.bincount(f.ravel() >> shift, minlength=BINS) / f.size for f in frames])
        diff = np.abs(np.diff(hist, axis=0)).sum(1) / 2
        for i, d in enumerate(diff):
            last = diff[max(0, i - WINDOW) : i]
            if d > max(LEAST, last.mean() + DEVIATIONS * last.std() if len(last) else 0.0):
                cuts.append(i + 1)
    return [(a * period, b * period, a, b - a) for a, b in zip(cuts, [*cuts[1:], len(frames)], strict=True)]


def payload_of(text: bytes) -> bytes:
    return text + b"\0" * (-len(text) % WIDTH if text else WIDTH)


def store(payload: bytes) -> bytes:
    """An AVI file of frames of one size, no larger than needed."""
    x = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    count = -(-len(x) // LINES)
    lines = -(-len(x) // count)
    x = np.concatenate([x, np.zeros((count * lines - len(x), WIDTH), np.uint8)])
    return write_avi([encode_frame(x[i : i + lines]) for i in range(0, len(x), lines)], WIDTH, lines, FPS, b"%d" % len(payload))


def pictures(media: bytes) -> tuple[list[np.ndarray], float, bytes]:
    frames, period, comment = read_avi(media)
    return [decode_frame(f) for f in frames], period, comment


def load(media: bytes) -> tuple[bytes, list[tuple[float, float, int, int]]]:
    """The payload that store() was given, and the shots."""
    frames, period, size = pictures(media)
    return b"".join(p.tobytes() for p in frames)[: int(size)], shots(frames, period)


def features(text: bytes) -> dict:
    media = store(payload_of(text))
    back, clips = load(media)
    return {
        "n_bytes": len(text),
        "payload_bytes": len(back),
        "payload_sha256": hashlib.sha256(back).hexdigest(),
        "tail_crc32": zlib.crc32(back[-64:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": ";".join(f"{a:.2f}-{b:.2f}:{n}" for a, b, _, n in clips),
    }


def media_features(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES of every text, stored as media and read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                rows = [features((t.as_py() or "").encode()) for t in part.column("text")]
                yield pa.record_batch([ids.slice(lo, 1000), *(pa.array([r[k] for r in rows]) for k in rows[0])], names=["doc_id", *rows[0]])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + FEATURES)


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id and `media binary`, the AVI file of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "media": pa.array([store(payload_of((t.as_py() or "").encode())) for t in part.column("text")], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, media binary")


def clips(media: DataFrame) -> DataFrame:
    """Timed clip rows of (doc_id, media): doc_id, clip, start_s, end_s, first_frame, n_frames, error.

    Null media has none; media that cannot be read has one row with the reason in error and all else but doc_id null.
    """

    def of(media: bytes) -> list[tuple]:
        try:
            frames, period, _ = pictures(media)
            return [(k, *c, None) for k, c in enumerate(shots(frames, period))] if frames else []
        except ValueError as e:
            return [(None, None, None, None, None, str(e))]

    kind = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "clip", "start_s", "end_s", "first_frame", "n_frames", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, m in zip(b.column("doc_id"), b.column("media"), strict=True):
                if m.is_valid and (rows := [(i.as_py(), *c) for c in of(m.as_py())]):
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kind, strict=True)], names=names)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, clip long, start_s double, end_s double, first_frame long, n_frames long, error string")
