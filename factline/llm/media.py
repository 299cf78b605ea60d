"""Media columns: baseline JPEG, read marker by marker.

:func:`encode_jpeg` stores a payload losslessly as a grey baseline JPEG. The format's unit is the quantised
coefficient: an 8 x 8 block has 64, all of Huffman size category 8 (magnitudes 128 to 255), whose eight raw
bits are a payload byte. Each block is a restart interval. A comment segment holds the payload's length, as
blocks without payload fill the last row of the image.

:func:`decode` parses the markers of any baseline JPEG (several components, sampling factors, tables and
restart intervals), takes the stuffing out of the scan and Huffman-decodes it: all restart intervals of all
images of a batch advance together, one symbol a step, as numpy vectors. Luminance thumbnails come from the
DC coefficients alone.

Defined results: a null payload is empty; payloads are padded with zero bytes to a positive multiple of 64;
what isn't a complete baseline JPEG has null features and the reason in ``error``; equal media give equal
rows; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType

BLOCK = 64
#: Restart intervals that advance together; bounds memory whatever the size of an image.
_LANES = 1 << 13


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def encode_jpeg(payload: bytes) -> bytes:
    """A grey baseline JPEG that holds ``payload``, whose length is a positive multiple of 64."""
    blocks = len(payload) // BLOCK
    wide = int(np.ceil(np.sqrt(blocks)))
    high = -(-blocks // wide)
    data = np.zeros((wide * high, BLOCK), np.uint8)
    data.ravel()[: len(payload)] = np.frombuffer(payload, np.uint8)
    scan = []
    for at in range(0, len(data), _LANES):  # bounds memory beside the payload and the image
        part = data[at : at + _LANES]
        bits = np.zeros((len(part), BLOCK, 9), np.uint8)  # the code 0, then the eight raw bits
        bits[:, :, 1:] = np.unpackbits(part, axis=1).reshape(-1, BLOCK, 8)
        raw = np.packbits(bits.reshape(len(part), -1), axis=1)
        body = np.zeros((len(part), raw.shape[1] + 2), np.uint8)
        body[:, :-2], body[:, -2], body[:, -1] = raw, 0xFF, 0xD0 + np.arange(at, at + len(part)) % 8
        full = body == 0xFF
        full[:, -2] = False
        scan.append(np.insert(body.ravel(), np.flatnonzero(full) + 1, 0).tobytes())
    scan[-1] = scan[-1][:-2]
    one_code = bytes([1] + [0] * 15 + [8])
    head = _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0") + _segment(0xFE, b"payload %d" % len(payload)) + _segment(0xDB, b"\0" + b"\x01" * 64)
    head += _segment(0xC0, struct.pack(">BHHBBBB", 8, high * 8, wide * 8, 1, 1, 0x11, 0)) + _segment(0xC4, b"\x00" + one_code + b"\x10" + one_code)
    head += _segment(0xDD, b"\0\x01") + _segment(0xDA, b"\x01\x01\0\0\x3f\0")
    return b"".join([b"\xff\xd8", head, *scan, b"\xff\xd9"])


class Image:
    """What the markers of one image say; ``starts`` and ``ends`` cut ``scan`` (without stuffing) into restart intervals."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("no start of image")
        tables, quant, self.comment, self.interval, at = {}, {}, b"", 0, 2
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("no marker where one is due")
            if data[at + 1] == 0xFF:
                at += 1
                continue
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = 2 if body[0] >> 4 else 1
                    quant[body[0] & 15] = int.from_bytes(body[1 : 1 + wide], "big")
                    body = body[1 + 64 * wide :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xC0:
                self.height, self.width, n = struct.unpack_from(">HHB", body, 1)
                parts = [body[6 + 3 * i : 9 + 3 * i] for i in range(n)]
            elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise ValueError("not baseline")
            elif marker == 0xDD:
                self.interval = struct.unpack(">H", body)[0]
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDA:
                uses = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
                break
        if len(uses) != len(parts):
            raise ValueError("more than one scan")
        single = len(parts) == 1
        sampling = [(1, 1) if single else (p[1] >> 4, p[1] & 15) for p in parts]
        across, down = (max(s[i] for s in sampling) for i in (0, 1))
        self.mcus = (-(-self.height // (8 * down)), -(-self.width // (8 * across)))
        self.luma, self.quant = sampling[0], quant[parts[0][2]]
        #: Of each block of an MCU: its component, DC table and AC table.
        self.layout = [(i, tables[uses[p[0]] >> 4], tables[0x10 | uses[p[0]] & 15]) for i, (p, (h, v)) in enumerate(zip(parts, sampling, strict=True)) for _ in range(h * v)]
        raw = np.frombuffer(data, np.uint8)[at:]
        marks = np.flatnonzero((raw[:-1] == 0xFF) & (raw[1:] != 0))
        restart = (raw[marks + 1] & 0xF8) == 0xD0
        if restart.all():
            raise ValueError("no end of image")
        stop = int(np.argmin(restart))
        cuts = marks[:stop]
        keep = np.ones(int(marks[stop]), bool)
        keep[np.flatnonzero((raw[: len(keep)] == 0xFF) & (raw[1 : len(keep) + 1] == 0)) + 1] = False
        keep[cuts] = keep[cuts + 1] = False
        before = np.concatenate(([0], np.cumsum(keep)))
        self.scan = raw[: len(keep)][keep]
        self.starts = before[np.concatenate(([0], cuts))]
        total = self.mcus[0] * self.mcus[1]
        each = self.interval or total
        if len(self.starts) != -(-total // each):
            raise ValueError("restart intervals are missing")
        self.counts = np.full(len(self.starts), each)
        self.counts[-1] = total - each * (len(self.starts) - 1)

    def thumbnail(self, dc: np.ndarray) -> np.ndarray:
        """Grey levels of the luminance blocks, from their DC coefficients in scan order."""
        h, v = self.luma
        rows, cols = self.mcus
        grid = dc.reshape(rows, cols, v, h).transpose(0, 2, 1, 3).reshape(rows * v, cols * h)
        grid = grid[: -(-self.height // 8) or 1, : -(-self.width // 8) or 1]
        return np.clip(np.rint(grid * (self.quant / 8)) + 128, 0, 255).astype(np.uint8)


def lookup(table: bytes) -> np.ndarray:
    """For the next 16 bits: length and symbol of the code they begin with, 256 * length + symbol; 0 if none."""
    out = np.zeros(1 << 16, np.int64)
    code, at = 0, 16
    for length in range(1, 17):
        for symbol in table[at : at + table[length - 1]]:
            out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
            code += 1
        at += table[length - 1]
        code <<= 1
    return out


def coefficients(scan: np.ndarray, start: np.ndarray, blocks: np.ndarray, dc: np.ndarray, ac: np.ndarray, per_mcu: np.ndarray, luts: np.ndarray) -> np.ndarray:
    """(all blocks, 64) coefficients in zigzag order, DC still as differences.

    An interval begins at byte ``start`` and has ``blocks`` blocks; its block b uses the tables dc[i, b % per_mcu] and ac[i, b % per_mcu].
    """
    out = np.zeros(int(blocks.sum()) * 64, np.int16)
    padded = np.concatenate([scan, np.zeros(16, np.uint8)])
    words = np.ndarray(len(padded) - 8, ">u8", padded, strides=(1,))
    flat, limit, alone = luts.ravel(), len(scan) * 8, int(per_mcu.max(initial=1)) == 1
    lane, left, bit, k = np.arange(len(start)), blocks.astype(np.int64), start.astype(np.int64) * 8, np.zeros(len(start), np.int64)
    base = (np.cumsum(blocks) - blocks) * 64
    dc, ac = dc.astype(np.int64) << 16, ac.astype(np.int64) << 16
    while len(lane):
        if bit.max() > limit + 64:
            raise ValueError("the scan ends too soon")
        begins = k == 0
        which = 0 if alone else (blocks[lane] - left) % per_mcu[lane]
        table = np.where(begins, dc[lane, which], ac[lane, which])
        ahead = words[bit >> 3].astype(np.uint64) << (bit & 7).view(np.uint64)
        entry = flat[table + (ahead >> np.uint64(48)).view(np.int64)]
        if not entry.all():
            raise ValueError("no such Huffman code")
        length, size = entry >> 8, entry & 15
        raw = ((ahead << length.view(np.uint64)) >> np.uint64(1) >> (63 - size).view(np.uint64)).view(np.int64)
        value = raw - np.where(raw << 1 < 1 << size, (1 << size) - 1, 0)
        bit += length + size
        k += np.where(begins, 0, entry >> 4 & 15)
        if k.max() > 63:
            raise ValueError("a block has too many coefficients")
        out[base + k] = value
        k += 1
        end = (entry & 255 == 0) & ~begins
        if end.any():
            k[end] = 64
        if k.max() > 63:
            full = k > 63
            left, base = left - full, base + 64 * full
            k[full] = 0
            if not left.all():
                on = left > 0
                lane, left, bit, k, base = lane[on], left[on], bit[on], k[on], base[on]
    return out.reshape(-1, 64)


def decode(images: list[bytes | None]) -> Iterator[tuple[Image | None, np.ndarray | None, str | None]]:
    """For each image: what its markers say, all its coefficients in scan order (DC restored), or why not."""
    parsed: list = []
    for data in images:
        try:
            parsed.append(Image(data or b""))
        except (ValueError, KeyError, IndexError, struct.error, UnboundLocalError, AttributeError) as e:
            parsed.append(str(e) or type(e).__name__)
    good = [x for x in parsed if isinstance(x, Image)]
    done: dict[int, np.ndarray | str] = {}
    at = 0
    while at < len(good):
        to, lanes = at, 0
        while to < len(good) and (to == at or lanes + len(good[to].starts) <= _LANES):
            lanes += len(good[to].starts)
            to += 1
        try:
            for image, found in zip(good[at:to], _together(good[at:to]), strict=True):
                done[id(image)] = found
        except ValueError:  # a broken one among them
            for image in good[at:to]:
                try:
                    done[id(image)] = _together([image])[0]
                except ValueError as e:
                    done[id(image)] = str(e)
        at = to
    for x in parsed:
        found = done[id(x)] if isinstance(x, Image) else x
        yield (None, None, found) if isinstance(found, str) else (x, found, None)


def _together(images: list[Image]) -> list[np.ndarray]:
    names = list(dict.fromkeys(t for x in images for _, d, a in x.layout for t in (d, a)))
    number, luts = {t: i for i, t in enumerate(names)}, np.stack([lookup(t) for t in names])
    most = max(len(x.layout) for x in images)
    n = [len(x.starts) for x in images]
    tables = [np.repeat(np.array([[number[b[i]] for b in x.layout] + [0] * (most - len(x.layout)) for x in images]), n, axis=0) for i in (1, 2)]
    per_mcu = np.repeat([len(x.layout) for x in images], n)
    base = np.repeat(np.cumsum([0] + [len(x.scan) for x in images[:-1]]), n)
    starts = base + np.concatenate([x.starts for x in images])
    blocks = np.concatenate([x.counts for x in images]) * per_mcu
    scan = np.concatenate([x.scan for x in images])
    pieces = [slice(i, i + _LANES) for i in range(0, len(starts), _LANES)]
    out = np.concatenate([coefficients(scan, starts[p], blocks[p], tables[0][p], tables[1][p], per_mcu[p], luts) for p in pieces])
    found, at = [], 0
    for x in images:
        size = int(x.counts.sum()) * len(x.layout)
        own, component = out[at : at + size], np.tile([b[0] for b in x.layout], int(x.counts.sum()))
        at += size
        if (x.counts * len(x.layout)).max() > 1:  # undo the prediction of DC within each interval
            interval = np.repeat(np.arange(len(x.counts)), x.counts * len(x.layout))
            for c in set(component.tolist()):
                of = np.flatnonzero(component == c)
                total = np.cumsum(own[of, 0].astype(np.int64))
                begins = np.flatnonzero(np.diff(interval[of], prepend=-1))
                before = np.concatenate(([0], total))[begins]
                own[of, 0] = total - np.repeat(before, np.diff(np.append(begins, len(of))))
        found.append(own)
    return found


def thumbnail_hash(grey: np.ndarray) -> int:
    """64 bits: whether each of 8 x 9 mean grey levels exceeds the one to its left."""
    high, wide = grey.shape
    total = np.zeros((high + 1, wide + 1))
    total[1:, 1:] = grey.cumsum(0).cumsum(1)
    top, left = np.arange(8) * high // 8, np.arange(9) * wide // 9
    bottom, right = np.maximum(-(-np.arange(1, 9) * high // 8), top + 1), np.maximum(-(-np.arange(1, 10) * wide // 9), left + 1)
    sums = total[bottom][:, right] - total[top][:, right] - total[bottom][:, left] + total[top][:, left]
    mean = sums / np.outer(bottom - top, right - left)
    return int(np.packbits(mean[:, 1:] > mean[:, :-1]).view(">u8")[0])


@pandas_udf(BinaryType())
def encode_media(payload: pd.Series) -> pd.Series:
    """JPEG of a binary payload, which is padded first."""
    return pd.Series([encode_jpeg((x or b"") + b"\0" * (-len(x or b"") % BLOCK or (0 if x else BLOCK))) for x in payload], dtype=object)


_FEATURES = "width int, height int, thumbnail_hash string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, error string"


def _features(media: pd.Series) -> pd.DataFrame:
    rows = []
    for data, (image, found, error) in zip(media, decode(list(media)), strict=True):
        row = dict.fromkeys((x.split()[0] for x in _FEATURES.split(", ")))
        row |= {"error": error, "media_bytes": None if data is None else len(data), "media_sha256": None if data is None else hashlib.sha256(data).hexdigest()}
        if image is not None:
            luma = image.luma[0] * image.luma[1]
            grey = image.thumbnail(found[:, 0].reshape(-1, len(image.layout))[:, :luma].ravel())
            row |= {"width": image.width, "height": image.height, "thumbnail_hash": f"{thumbnail_hash(grey):016x}"}
            if image.comment.startswith(b"payload "):
                values = found.ravel()
                stored = np.where(values < 0, values + 255, values).astype(np.uint8)[: int(image.comment[8:])].tobytes()
                row |= {"payload_bytes": len(stored), "payload_sha256": hashlib.sha256(stored).hexdigest(), "tail_crc32": zlib.crc32(stored[-BLOCK:])}
        rows.append(row)
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _FEATURES.split(", ")]).astype({"width": "Int32", "height": "Int32", "payload_bytes": "Int64", "tail_crc32": "Int64", "media_bytes": "Int64"})


def media_features(media: str):
    """Struct of dimensions, thumbnail hash, and sums of the payload that a binary column of JPEGs holds."""
    run = pandas_udf(_features, _FEATURES)
    return run(media)


def store_texts(df: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """``df`` with each text, as UTF-8, stored in a JPEG in ``media_col``, which replaces a column of that name."""
    return df.withColumn(media_col, encode_media(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
