"""Media columns: motion-JPEG in AVI, written and read back in memory, and shot detection over its frames.

Frames are 24 x 24 grey images in lossless JPEG (ITU T.81 SOF3: predictor 1, Huffman coded differences, a restart
interval for each line), so that samples come back exactly. A file is a RIFF 'AVI ' form with an hdrl list, a movi
list of '00dc' chunks and an idx1 index; the reader parses chunk headers, then takes the frames from the index. The reader also decodes
frames of ordinary motion-JPEG files (T.81 baseline, grey or colour, any sampling, with the standard's Huffman tables if they bring none);
shots need their luma only. Lossless frames of other predictors, progressive and arithmetic coded ones raise ValueError.

Shots: the 16-bin grey histograms of neighbouring frames differ by d, as a share of what they could; a cut is where d is at least
CUT_FLOOR and CUT_RATIO times the mean d of the WINDOW transitions on either side (itself left out; the only transition of a clip is decided
by CUT_FLOOR alone). Clips carry their times.

All work is per row, in Arrow batches that are cut into blocks of about BLOCK_FRAMES frames; lines of all frames of a
block are coded together by numpy, one column of samples at a time. Ids cross to Python as text, since numbers beside nulls would turn
to floats there.

Defined results: a null or empty text is one frame of bytes 255; a null or very large id stays as it is; repeated rows give repeated
results; texts of any length are stored whole; an empty table gives an empty result; other columns are not read. Equal texts give equal
bytes and features. A null media value has no clips.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SIDE = 24
FRAME = SIDE * SIDE
FPS = 25
BLOCK_FRAMES = 1024
BINS = 16
WINDOW = 4
CUT_FLOOR = 0.125
CUT_RATIO = 2.0

# Huffman code of the difference categories 0..8 (T.81 H.1.2.2): lengths in the order of DHT_VALUES.
DHT_LENGTHS = (0, 0, 5, 4) + (0,) * 12
DHT_VALUES = (2, 3, 4, 5, 6, 0, 1, 7, 8)

# Huffman tables of T.81 annex K.3 (lengths, values), for frames that bring none.
STANDARD_TABLES = {
    (0, 0): ("00010501010101010100000000000000", "000102030405060708090a0b"),
    (0, 1): ("00030101010101010101010000000000", "000102030405060708090a0b"),
    (1, 0): (
        "0002010303020403050504040000017d",
        "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a434445464748494a535455565758595a"
        "636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa",
    ),
    (1, 1): (
        "00020102040403040705040400010277",
        "000102031104052131061241510761711322328108144291a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a434445464748494a535455565758595a"
        "636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa",
    ),
}
#: Places of the coefficients of a block, diagonal by diagonal.
ZIGZAG = sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8))


def _codes(lengths: Iterable[int], values: Iterable[int]) -> dict[int, tuple[int, int]]:
    """category -> (code, length), by T.81 annex C."""
    out, code, rest = {}, 0, iter(values)
    for bits, n in enumerate(lengths, 1):
        for _ in range(n):
            out[next(rest)] = (code, bits)
            code += 1
        code <<= 1
    return out


def _header() -> bytes:
    dht = b"\x00" + bytes(DHT_LENGTHS) + bytes(DHT_VALUES)
    sof = struct.pack(">BHHB3B", 8, SIDE, SIDE, 1, 1, 0x11, 0)
    sos = bytes((1, 1, 0x00, 1, 0, 0))
    segments = ((0xC4, dht), (0xC3, sof), (0xDD, struct.pack(">H", SIDE)), (0xDA, sos))
    return b"\xff\xd8" + b"".join(struct.pack(">BBH", 0xFF, m, len(body) + 2) + body for m, body in segments)


HEADER = _header()


def _encode_tables() -> tuple[np.ndarray, np.ndarray]:
    """code and bit length of each difference, at index difference + 255."""
    code, length, huffman = np.zeros(511, np.uint64), np.zeros(511, np.uint64), _codes(DHT_LENGTHS, DHT_VALUES)
    for diff in range(-255, 256):
        category = abs(diff).bit_length()
        prefix, bits = huffman[category]
        extra = diff if diff >= 0 else diff + (1 << category) - 1
        code[diff + 255], length[diff + 255] = (prefix << category) | extra, bits + category
    return code, length


CODE, LENGTH = _encode_tables()


def _decode_tables(lengths: tuple[int, ...], values: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """difference and bit length for each value of the next 16 bits."""
    diff, used = np.zeros(65536, np.int16), np.zeros(65536, np.int64)
    for category, (code, bits) in _codes(lengths, values).items():
        whole = bits + category
        for extra in range(1 << category):
            value = extra if category and extra >> (category - 1) else extra - (1 << category) + 1 if category else 0
            start = ((code << category) | extra) << (16 - whole)
            diff[start : start + (1 << (16 - whole))], used[start : start + (1 << (16 - whole))] = value, whole
    return diff, used


def encode_frames(frames: np.ndarray) -> list[bytes]:
    """JPEG bytes of each row of frames (n, FRAME) of uint8."""
    if not len(frames):
        return []
    lines = frames.reshape(-1, SIDE).astype(np.int16)
    diffs = lines.copy()
    diffs[:, 0] -= 128
    diffs[:, 1:] -= lines[:, :-1]
    diffs += 255
    n = len(lines)
    # codes of four neighbouring samples (48 bits at most) are joined first, so that a line takes six steps
    code, bits = CODE[diffs], LENGTH[diffs]
    joined, taken = code[:, 0::4], bits[:, 0::4]
    for i in (1, 2, 3):
        joined = (joined << bits[:, i::4]) | code[:, i::4]
        taken = taken + bits[:, i::4]
    words = np.zeros(n * 6, np.uint64)
    base, at = np.arange(n, dtype=np.int64) * 6, np.zeros(n, np.int64)
    for group in range(SIDE // 4):
        code, bits = joined[:, group], taken[:, group].astype(np.int64)
        word, room = base + (at >> 6), 64 - (at & 63) - bits
        over = np.flatnonzero(room < 0)
        words[word] |= np.where(room < 0, code >> np.maximum(-room, 0).astype(np.uint64), code << np.maximum(room, 0).astype(np.uint64))
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        at += bits
    # fill the last byte of each line with ones
    fill = (-at) & 7
    word, room = base + (at >> 6), 64 - (at & 63) - fill
    words[word] |= ((np.uint64(1) << fill.astype(np.uint64)) - np.uint64(1)) << np.maximum(room, 0).astype(np.uint64)
    at += fill
    data = words.byteswap().view(np.uint8).reshape(n, 48)[:, : int(at.max()) >> 3]
    width = data.shape[1]
    out, keep = np.zeros((n, 2 * width + 2), np.uint8), np.zeros((n, 2 * width + 2), bool)
    used = np.arange(width) < (at >> 3)[:, None]
    out[:, 0 : 2 * width : 2], keep[:, 0 : 2 * width : 2] = data, used
    keep[:, 1 : 2 * width : 2] = used & (data == 255)
    line = np.arange(n) % SIDE
    out[:, -2], out[:, -1] = 0xFF, 0xD0 + (line & 7)
    keep[:, -2:] = (line != SIDE - 1)[:, None]
    stream = out[keep].tobytes()
    ends = np.cumsum(keep.sum(1).reshape(-1, SIDE).sum(1)).tolist()
    return [HEADER + stream[a:b] + b"\xff\xd9" for a, b in zip([0, *ends], ends)]


def parse_jpeg(frame: bytes) -> tuple[int, int, tuple[int, ...], tuple[int, ...], int]:
    """height, width, Huffman lengths and values, and where the coded data starts."""
    at, size, lengths, values = 2, (0, 0), (), ()
    if frame[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    while True:
        marker, length = struct.unpack_from(">xBH", frame, at)
        body = frame[at + 4 : at + 2 + length]
        if marker == 0xC4:
            lengths = tuple(body[1:17])
            values = tuple(body[17 : 17 + sum(lengths)])
        elif marker == 0xC3:
            size = struct.unpack_from(">HH", body, 1)
        elif marker == 0xDA:
            return *size, lengths, values, at + 2 + length
        at += 2 + length


def decode_frames(frames: list[bytes]) -> np.ndarray:
    """The samples (n, FRAME) of lossless JPEG frames that share one header."""
    if not frames:
        return np.zeros((0, FRAME), np.uint8)
    height, width, lengths, values, start = parse_jpeg(frames[0])
    head = frames[0][:start]
    if any(not f.startswith(head) for f in frames):
        raise ValueError("frames of different headers in one call")
    difference, used = _decode_tables_cached(lengths, values)
    # Every frame's last line gets a restart marker too, then lines are what lies between markers.
    stream = np.frombuffer(b"\xff\xd0".join([f[start:-2] for f in frames]) + b"\xff\xd0", np.uint8)
    escaped = np.flatnonzero(stream[:-1] == 0xFF)
    follows = stream[escaped + 1]
    marks = escaped[follows != 0]
    drop = np.zeros(len(stream), bool)
    drop[escaped[follows == 0] + 1] = True
    drop[marks] = drop[marks + 1] = True
    kept = np.concatenate([stream[~drop], np.zeros(4, np.uint8)]).astype(np.uint32)
    at = np.concatenate([[0], marks[:-1] + 2])
    at = (at - np.concatenate([[0], np.cumsum(drop)])[at]) << 3
    if len(at) != len(frames) * height:
        raise ValueError("a frame has lost lines")
    wide = (kept[:-2] << 16) | (kept[1:-1] << 8) | kept[2:]
    out = np.empty((len(at), width), np.uint8)
    value = np.full(len(at), 128, np.int16)
    for column in range(width):
        bits = (wide[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        value = value + difference[bits]
        out[:, column] = value
        at = at + used[bits]
    return out.reshape(len(frames), height * width)


def luma_frames(frames: list[bytes]) -> np.ndarray:
    """The grey samples (n, height * width) of frames that may have different headers, but one size."""
    lossless = [i for i, f in enumerate(frames) if _kind(f) == 0xC3]
    if len(lossless) == len(frames) and len({f[: parse_jpeg(f)[4]] for f in frames}) <= 1:
        return decode_frames(frames)
    return np.stack([decode_frames([f])[0] if _kind(f) == 0xC3 else decode_baseline(f).reshape(-1) for f in frames])


def _segments(frame: bytes) -> Iterator[tuple[int, bytes, int]]:
    """marker, body and end of each segment up to the start of the scan."""
    at = 2
    while at + 4 <= len(frame):
        if frame[at] != 0xFF:
            raise ValueError("not a JPEG frame")
        if frame[at + 1] == 0xFF:  # fill byte
            at += 1
            continue
        marker, length = struct.unpack_from(">xBH", frame, at)
        yield marker, frame[at + 4 : at + 2 + length], at + 2 + length
        if marker == 0xDA:
            return
        at += 2 + length


def _kind(frame: bytes) -> int:
    """The start-of-frame marker."""
    return next((m for m, _, _ in _segments(frame) if 0xC0 <= m <= 0xCF and m not in (0xC4, 0xC8, 0xCC)), 0)


def _lookup(lengths: bytes, values: bytes) -> list[tuple[int, int]]:
    """(value, code length) for each value of the next 16 bits; length 0 is no code."""
    out = [(0, 0)] * 65536
    for value, (code, bits) in _codes(lengths, values).items():
        start = code << (16 - bits)
        out[start : start + (1 << (16 - bits))] = [(value, bits)] * (1 << (16 - bits))
    return out


def decode_baseline(frame: bytes) -> np.ndarray:
    """The luma (height, width) of a baseline JPEG frame."""
    quant: dict[int, np.ndarray] = {}
    tables = {k: (bytes.fromhex(a), bytes.fromhex(b)) for k, (a, b) in STANDARD_TABLES.items()}
    height = width = restart = start = 0
    parts: list[list[int]] = []
    chosen: dict[int, int] = {}
    for marker, body, end in _segments(frame):
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.int64)
                body = body[1 + (64 << bool(wide)) :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] >> 4, body[0] & 15] = body[1:17], body[17 : 17 + n]
                body = body[17 + n :]
        elif marker in (0xC0, 0xC1):
            height, width = struct.unpack_from(">HH", body, 1)
            parts = [[body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]] for i in range(body[5])]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            chosen, start = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}, end
    if not parts or not start:
        raise ValueError("not a baseline JPEG frame")
    if len(parts) == 1:
        parts[0][1:3] = 1, 1
    across, down = max(p[1] for p in parts), max(p[2] for p in parts)
    columns, rows = -(-width // (8 * across)), -(-height // (8 * down))
    read = [(i, _lookup(*tables[0, chosen[p[0]] >> 4]), _lookup(*tables[1, chosen[p[0]] & 15]), p[1] * p[2]) for i, p in enumerate(parts)]
    luma = np.zeros((rows * columns, parts[0][1] * parts[0][2], 64), np.int64)
    bits, before = _Bits(frame, start), [0] * len(parts)
    for mcu in range(rows * columns):
        if restart and mcu and mcu % restart == 0:
            bits.restart()
            before = [0] * len(parts)
        for i, dc, ac, blocks in read:
            for block in range(blocks):
                before[i] += bits.number(bits.symbol(dc))
                if not i:
                    luma[mcu, block, 0] = before[0]
                k = 1
                while k < 64:
                    symbol = bits.symbol(ac)
                    run, size = symbol >> 4, symbol & 15
                    if not size and run != 15:
                        break
                    k += run
                    if size and k < 64:
                        value = bits.number(size)
                        if not i:
                            luma[mcu, block, ZIGZAG[k]] = value
                    k += 1
    scale = np.zeros(64, np.int64)
    scale[ZIGZAG] = quant[parts[0][3]]
    angle = np.cos((2 * np.arange(8)[None] + 1) * np.arange(8)[:, None] * np.pi / 16) / 2
    angle[0] /= np.sqrt(2)
    blocks = np.einsum("ui,nbuv,vj->nbij", angle, (luma * scale).reshape(*luma.shape[:2], 8, 8), angle)
    h, v = parts[0][1:3]
    image = blocks.reshape(rows, columns, v, h, 8, 8).transpose(0, 2, 4, 1, 3, 5).reshape(rows * v * 8, columns * h * 8)
    if (h, v) != (across, down):  # luma of fewer samples than the frame
        image = image.repeat(down // v, 0).repeat(across // h, 1)
    return np.clip(np.round(image[:height, :width]) + 128, 0, 255).astype(np.uint8)


class _Bits:
    """Bits of a scan, without stuffed zeros; behind the data come zeros."""

    def __init__(self, frame: bytes, at: int) -> None:
        self.frame, self.at, self.word, self.n = frame, at, 0, 0

    def _fill(self) -> None:
        while self.n < 16:
            byte = self.frame[self.at] if self.at < len(self.frame) else 0
            if byte == 0xFF:
                if self.at + 1 < len(self.frame) and self.frame[self.at + 1] == 0:
                    self.at += 1
                else:  # a marker: the data ends here
                    byte, self.at = 0, self.at - 1
            self.at += 1
            self.word, self.n = (self.word << 8 | byte) & 0xFFFFFFFF, self.n + 8

    def symbol(self, table: list[tuple[int, int]]) -> int:
        self._fill()
        value, used = table[self.word >> (self.n - 16) & 0xFFFF]
        if not used:
            raise ValueError("no such code")
        self.n -= used
        return value

    def number(self, size: int) -> int:
        """The next size bits as T.81 codes a signed number."""
        if not size:
            return 0
        self._fill()
        self.n -= size
        value = self.word >> self.n & ((1 << size) - 1)
        return value if value >> (size - 1) else value - (1 << size) + 1

    def restart(self) -> None:
        """Behind the next restart marker."""
        self.word = self.n = 0
        while self.at + 1 < len(self.frame) and not (self.frame[self.at] == 0xFF and 0xD0 <= self.frame[self.at + 1] <= 0xD7):
            self.at += 1
        self.at += 2


_TABLES: dict = {}


def _decode_tables_cached(lengths: tuple[int, ...], values: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    if (lengths, values) not in _TABLES:
        _TABLES.clear()
        _TABLES[lengths, values] = _decode_tables(lengths, values)
    return _TABLES[lengths, values]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes], fps: int = FPS) -> bytes:
    """An AVI file of JPEG frames, with an idx1 index of key frames."""
    largest = max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, largest * fps, 0, 0x10, len(frames), 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, fps, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    sizes = np.fromiter(map(len, frames), np.int64, len(frames))
    steps = 8 + sizes + (sizes & 1)
    index = np.zeros((len(frames), 4), "<u4")
    index[:, 0], index[:, 1] = int.from_bytes(b"00dc", "little"), 0x10
    index[:, 2], index[:, 3] = 4 + np.cumsum(steps) - steps, sizes
    movi = _chunk(b"LIST", b"movi" + b"".join(_chunk(b"00dc", f) for f in frames))
    return _chunk(b"RIFF", b"AVI " + hdrl + movi + _chunk(b"idx1", index.tobytes()))


def read_avi(data: bytes) -> tuple[list[bytes], int]:
    """The frames that the RIFF index of an AVI file lists, and the microseconds a frame lasts."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, end, movi, index, lasts = 12, 8 + struct.unpack_from("<I", data, 4)[0], 0, np.zeros((0, 4), "<u4"), 0
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", data, at)
        if name == b"LIST" and data[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"LIST" and data[at + 8 : at + 12] == b"hdrl":
            lasts = struct.unpack_from("<I", data, at + 20)[0]
        elif name == b"idx1":
            index = np.frombuffer(data, "<u4", size // 4, at + 8).reshape(-1, 4)
        at += 8 + size + (size & 1)
    frames = []
    for tag, _, offset, size in index.tolist():
        if tag & 0xFFFF0000 == 0x63640000 and size:  # '##dc': a compressed frame
            at = movi + offset  # offsets count from the movi list, in some files from the file's start
            if data[at : at + 4] != struct.pack("<I", tag):
                at = offset
            if struct.unpack_from("<4sI", data, at) != (struct.pack("<I", tag), size):
                raise ValueError("the index and a chunk differ")
            frames.append(data[at + 8 : at + 8 + size])
    return frames, lasts


def histograms(frames: np.ndarray) -> np.ndarray:
    """BINS grey counts of each frame."""
    flat = (frames >> 4).astype(np.int64) + (np.arange(len(frames), dtype=np.int64) * BINS)[:, None]
    return np.bincount(flat.ravel(), minlength=len(frames) * BINS).reshape(-1, BINS)


def shots(hist: np.ndarray) -> list[int]:
    """First frame of each shot, for one clip's histograms."""
    if len(hist) < 2:
        return [0] if len(hist) else []
    d = np.abs(np.diff(hist, axis=0)).sum(1)  # 0 to twice the samples of a frame
    total = np.concatenate([[0], np.cumsum(d)])
    i = np.arange(len(d))
    low, high = np.maximum(i - WINDOW, 0), np.minimum(i + WINDOW + 1, len(d))
    others, around = high - low - 1, total[high] - total[low] - d
    cut = (d >= CUT_FLOOR * 2 * hist[0].sum()) & (d * others >= CUT_RATIO * around)
    return [0, *(np.flatnonzero(cut) + 1).tolist()]


def clips(hist: np.ndarray, luma: np.ndarray, lasts: int) -> list[tuple[int, int, int, int]]:
    """(first frame, start ms, end ms, mean grey) of each shot."""
    starts = shots(hist)
    return [(a, a * lasts // 1000, b * lasts // 1000, int(luma[a:b].mean())) for a, b in zip(starts, [*starts[1:], len(hist)])]


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + b"\xff" * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


def store(texts: list[str | None]) -> list[bytes]:
    """AVI bytes of each text's payload; the frames of all texts are coded together."""
    payloads = [payload_of(t) for t in texts]
    coded = encode_frames(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME))
    out, at = [], 0
    for p in payloads:
        n = len(p) // FRAME
        out.append(write_avi(coded[at : at + n]))
        at += n
    return out


def load(media: list[bytes]) -> list[tuple[np.ndarray, int]]:
    """Samples (frames, FRAME) and microseconds a frame of each AVI file."""
    parsed = [read_avi(m) for m in media]
    samples = decode_frames([f for frames, _ in parsed for f in frames])
    out, at = [], 0
    for frames, lasts in parsed:
        out.append((samples[at : at + len(frames)], lasts))
        at += len(frames)
    return out


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Row blocks of about BLOCK_FRAMES frames."""
    for batch in batches:
        frames = batch["text"].map(lambda t: 1 + len(t or "") // FRAME).to_numpy().cumsum()
        block = frames // BLOCK_FRAMES
        for _, part in batch.groupby(block, sort=False):
            yield part


def _feature(found: list[tuple[int, int, int, int]], frames: int) -> str:
    return f"frames={frames};shots={len(found)};clips=" + ",".join(f"{a}:{b}-{c}ms@{g}" for a, b, c, g in found)


def media_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of each row's text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _blocks(batches):
            texts = [t if isinstance(t, str) else None for t in part["text"]]
            media = store(texts)
            rows = []
            loaded = load(media)
            every = np.concatenate([samples for samples, _ in loaded])
            hist_all, luma_all, at = histograms(every), every.mean(1), 0
            for text, data, (samples, lasts) in zip(texts, media, loaded):
                back, frames = samples.tobytes(), slice(at, at + len(samples))
                at += len(samples)
                found = clips(hist_all[frames], luma_all[frames], lasts)
                rows.append((len((text or "").encode()), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(data), hashlib.sha256(data).hexdigest(), _feature(found, len(samples))))
            out = pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            yield out

    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = sent.mapInPandas(run, "doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def timed_clips(media: DataFrame) -> DataFrame:
    """media_id, clip, first_frame, start_ms, end_ms, mean_grey of each shot of media (media_id long, media binary); no rows for null and for files without frames."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for media_id, data in zip(batch["media_id"], batch["media"]):
                if data is None:
                    continue
                frames, lasts = read_avi(bytes(data))
                samples = luma_frames(frames) if frames else np.zeros((0, FRAME), np.uint8)
                found = clips(histograms(samples), samples.mean(1), lasts)
                yield pd.DataFrame([(media_id, i, *c) for i, c in enumerate(found)], columns=["media_id", "clip", "first_frame", "start_ms", "end_ms", "mean_grey"])

    sent = media.select(F.col("media_id").cast("string").alias("media_id"), "media")
    found = sent.mapInPandas(run, "media_id string, clip int, first_frame long, start_ms long, end_ms long, mean_grey int")
    return found.withColumn("media_id", F.col("media_id").cast("long"))


def encode_texts(docs: DataFrame) -> DataFrame:
    """media_id (doc_id) and media (AVI bytes) of each row's text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _blocks(batches):
            yield pd.DataFrame({"media_id": part["doc_id"].to_numpy(), "media": store([t if isinstance(t, str) else None for t in part["text"]])})

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "media_id string, media binary")
    return found.withColumn("media_id", F.col("media_id").cast("long"))


def op9_media_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op9_media_clips": op9_media_clips}
ORACLES: dict[str, str] = {}
