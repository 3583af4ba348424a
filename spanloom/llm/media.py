"""Media columns: progressive JPEG images, read scan by scan into RGB tensors.

Spectral-selection and successive-approximation scans are accumulated into
coefficient arrays; these are inverse-transformed, chroma is upsampled and the
full-resolution RGB tensor stored. A scan whose Huffman table has a single code
has codes of one length, so numpy reads it at a fixed stride; any other is
read code by code.

``payload_images`` stores bytes losslessly in such images: 192 bytes are the 64
coefficients of the three components of one 8x8 MCU.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 192
#: MCUs of a row of a payload image.
ROW_MCUS = 1024
#: Bytes of tensors that a task holds at once, one image at least.
PART = 16_000_000
#: Added to AC coefficients and, in every other block, to DC: all codes have one size category then.
AC_BASE, DC_BASE = 256, 768


def _zigzag() -> np.ndarray:
    """Row-major place of each coefficient in scan order."""
    order = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in order])


def _basis() -> np.ndarray:
    """The inverse transform of 64 coefficients in scan order to 64 samples."""
    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    d = np.cos((2 * x + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.kron(d, d)[_zigzag()].astype(np.float32)


_BASIS = _basis()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, slot: int, symbols: list[int]) -> tuple[bytes, dict[int, str]]:
    """A Huffman table with codes of one length for ``symbols``, and the codes; the all-ones code stays free."""
    length = max(1, len(symbols).bit_length())
    counts = [0] * 16
    counts[length - 1] = len(symbols)
    return _segment(0xC4, bytes([kind << 4 | slot, *counts, *symbols])), {s: format(i, f"0{length}b") for i, s in enumerate(symbols)}


def _stuffed(bits: np.ndarray) -> bytes:
    """Scan data: bits padded with ones to whole bytes, 0xFF followed by 0."""
    pad = -len(bits) % 8
    return np.packbits(np.concatenate([bits, np.ones(pad, np.uint8)]) if pad else bits).tobytes().replace(b"\xff", b"\xff\x00")


def _frame(width: int, height: int, sampling: list[tuple[int, int]], comment: bytes) -> bytes:
    quant = _segment(0xDB, bytes([0, *[1] * 64]))
    frame = struct.pack(">BHHB", 8, height, width, len(sampling)) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    return b"\xff\xd8" + (_segment(0xFE, comment) if comment else b"") + quant + _segment(0xC2, frame)


def _scan(components: list[int], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(components), *[x for c in components for x in (c + 1, 0)], first, last, high << 4 | low]))


#: Scans of a payload image: components, first and last coefficient, high and low bit.
SCRIPT = [([0, 1, 2], 0, 0, 0, 1), *[([c], a, b, 0, 1) for c in range(3) for a, b in ((1, 5), (6, 63))], ([0, 1, 2], 0, 0, 1, 0), *[([c], 1, 63, 1, 0) for c in range(3)]]


def payload_image(payload: bytes) -> bytes:
    """A progressive JPEG whose coefficients are the payload, a multiple of ``UNIT`` bytes; its comment has the length."""
    n = len(payload) // UNIT
    wide = min(n, ROW_MCUS)
    mcus = -(-n // wide) * wide
    data = np.zeros((mcus, 3, 64), np.uint8)
    data.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    bits = np.unpackbits(data[..., None], axis=3)  # 8 bits of each byte, the highest first
    out = [_frame(8 * wide, 8 * (mcus // wide), [(1, 1)] * 3, b"payload %d" % len(payload))]
    dc = (data[..., 0] >> 1).astype(np.int32) + DC_BASE // 2 * ((np.arange(mcus) + 1) % 2)[:, None]
    step = np.diff(dc, axis=0, prepend=0)
    step = np.where(step < 0, step + 511, step)
    coded = np.concatenate([np.zeros((mcus, 3, 1), np.uint8), ((step[..., None] >> np.arange(8, -1, -1)) & 1).astype(np.uint8)], axis=2)
    out += [_table(0, 0, [9])[0], _scan(*SCRIPT[0]), _stuffed(coded.reshape(-1)), _table(1, 0, [0x08])[0]]
    for parts, a, b, *approximation in SCRIPT[1:7]:
        coded = np.zeros((mcus, b - a + 1, 9), np.uint8)
        coded[..., 1] = 1
        coded[..., 2:] = bits[:, parts[0], a : b + 1, :7]
        out += [_scan(parts, a, b, *approximation), _stuffed(coded.reshape(-1))]
    out += [_scan(*SCRIPT[7]), _stuffed(np.ascontiguousarray(bits[:, :, 0, 7]).reshape(-1)), _table(1, 0, [0x00])[0]]
    for scan in SCRIPT[8:]:
        coded = np.zeros((mcus, 64), np.uint8)
        coded[:, 1:] = bits[:, scan[0][0], 1:, 7]
        out += [_scan(*scan), _stuffed(coded.reshape(-1))]
    return b"".join(out) + b"\xff\xd9"


class _Frame:
    """Size, sampling and the coefficient arrays (block rows, block columns, 64) of an image being read."""

    def __init__(self, body: bytes):
        _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        self.ids = [body[6 + 3 * i] for i in range(n)]
        self.sampling = [(body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15) for i in range(n)]
        self.quant = [body[8 + 3 * i] for i in range(n)]
        self.hmax, self.vmax = max(h for h, _ in self.sampling), max(v for _, v in self.sampling)
        self.mcus_x, self.mcus_y = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
        self.coefficients = [np.zeros((self.mcus_y * v, self.mcus_x * h, 64), np.int32) for h, v in self.sampling]

    def whole(self, parts: list[int]) -> list[np.ndarray] | None:
        """The blocks of each component, if the scan has one of each in turn and leaves none out."""
        if len(parts) > 1:
            return [self.coefficients[p].reshape(-1, 64) for p in parts] if all(self.sampling[p] == (1, 1) for p in parts) and (self.hmax, self.vmax) == (1, 1) else None
        h, v = self.sampling[parts[0]]
        rows, cols = -(-(-(-self.height * v // self.vmax)) // 8), -(-(-(-self.width * h // self.hmax)) // 8)
        blocks = self.coefficients[parts[0]]
        return [blocks.reshape(-1, 64)] if blocks.shape[:2] == (rows, cols) else None

    def blocks(self, parts: list[int]) -> np.ndarray:
        """(component, block row, block column) of the scan's blocks in order."""
        if len(parts) == 1:
            h, v = self.sampling[parts[0]]
            rows = -(-(-(-self.height * v // self.vmax)) // 8)
            cols = -(-(-(-self.width * h // self.hmax)) // 8)
            r, c = np.divmod(np.arange(rows * cols), cols)
            return np.stack([np.full(len(r), parts[0]), r, c], 1)
        out = []
        for p in parts:
            h, v = self.sampling[p]
            my, mx, y, x = np.meshgrid(np.arange(self.mcus_y), np.arange(self.mcus_x), np.arange(v), np.arange(h), indexing="ij")
            out.append(np.stack([np.full(my.shape, p), my * v + y, mx * h + x], -1).reshape(self.mcus_y * self.mcus_x, h * v, 3))
        return np.concatenate(out, 1).reshape(-1, 3)


class _Reader:
    """Bits of one entropy-coded segment, code by code."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.at = bits.tolist(), 0

    def bit(self) -> int:
        self.at += 1
        return self.bits[self.at - 1] if self.at <= len(self.bits) else 1

    def number(self, n: int) -> int:
        out = 0
        for _ in range(n):
            out = out << 1 | self.bit()
        return out

    def signed(self, n: int) -> int:
        x = self.number(n)
        return x if n == 0 or x >> (n - 1) else x - (1 << n) + 1

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.bit()
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no Huffman code matches")


def _codes(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out[length, code] = s
            code += 1
        at += n
        code <<= 1
    return out


def _only(codes: dict[tuple[int, int], int] | None) -> int | None:
    """The symbol of a table with one code of one bit, 0."""
    return next(iter(codes.values())) if codes and len(codes) == 1 and (1, 0) in codes else None


def _value(bits: np.ndarray) -> np.ndarray:
    """Signed values of size-category bits along the last axis."""
    n = bits.shape[-1]
    if not n:
        return np.zeros(bits.shape[:-1], np.int32)
    wide = 8 if n <= 8 else 16
    padded = np.zeros((*bits.shape[:-1], wide), np.uint8)
    padded[..., wide - n :] = bits
    x = np.packbits(padded.reshape(-1)).view("u1" if wide == 8 else ">u2").astype(np.int32).reshape(bits.shape[:-1])
    return x if bits[..., 0].all() else np.where(bits[..., 0] == 1, x, x - (1 << n) + 1)


def _strided(blocks: list[np.ndarray], bits: np.ndarray, tables: list, first: int, last: int, high: int, low: int) -> bool:
    """Reads a segment at a fixed stride into each component's ``blocks`` (n, 64), if all its codes have one length; says whether it did."""
    n, wide, many = len(blocks[0]), last - first + 1, len(blocks)
    if first == 0 and high:
        if len(bits) < n * many:
            return False
        for i, b in enumerate(blocks):
            b[:, 0] |= bits[i : n * many : many].astype(np.int32) << low
        return True
    symbol = _only(tables[0])
    if symbol is None or any(_only(t) != symbol for t in tables[1:]):
        return False
    if first and high:
        band = blocks[0][:, first : last + 1]
        if symbol or len(bits) < n * (1 + wide) or not band.all():
            return False
        coded = bits[: n * (1 + wide)].reshape(n, 1 + wide)
        if coded[:, 0].any():
            return False
        more = coded[:, 1:].astype(np.int32) << low
        band += more if (band > 0).all() else np.sign(band) * more
        return True
    size, each = symbol & 15, many if first == 0 else wide
    if symbol >> 4 or (first and not size) or len(bits) < n * each * (1 + size):
        return False
    coded = bits[: n * each * (1 + size)].reshape(n, each, 1 + size)
    if coded[..., 0].any():
        return False
    values = _value(coded[..., 1:])
    if first:
        blocks[0][:, first : last + 1] = values << low
    else:
        for i, b in enumerate(blocks):
            b[:, 0] = np.cumsum(values[:, i]) << low
    return True


def _coded(frame: _Frame, where: np.ndarray, bits: np.ndarray, tables: dict[int, dict], first: int, last: int, high: int, low: int) -> None:
    """Reads the segment code by code."""
    reader, before, run = _Reader(bits), {}, 0
    for p, r, c in where.tolist():
        block = frame.coefficients[p][r, c]
        if first == 0:
            if high:
                block[0] |= reader.bit() << low
            else:
                before[p] = before.get(p, 0) + reader.signed(reader.symbol(tables[p]))
                block[0] = before[p] << low
            continue
        k = first
        if run == 0:
            while k <= last:
                zeros, size = divmod(reader.symbol(tables[p]), 16)
                if size == 0 and zeros < 15:
                    run = (1 << zeros) + reader.number(zeros)
                    break
                value = 0
                if size:
                    value = reader.signed(size) if high == 0 else (1 if reader.bit() else -1)
                if high == 0:
                    k += zeros
                else:
                    while k <= last:
                        if block[k]:
                            if reader.bit():
                                block[k] += (1 if block[k] > 0 else -1) << low
                        elif zeros == 0:
                            break
                        else:
                            zeros -= 1
                        k += 1
                if size and k <= last:
                    block[k] = value * (1 << low)
                k += 1
        if run:
            run -= 1
            if high:
                for j in range(k, last + 1):
                    if block[j] and reader.bit():
                        block[j] += (1 if block[j] > 0 else -1) << low


class Image:
    """Coefficients and quantisation of a progressive JPEG, and its comment."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        self.comment, self.frame, quant, tables, interval, at = b"", None, {}, {}, 0, 2
        while at < len(data):
            marker = data[at + 1]
            if marker == 0xD9:
                break
            size = struct.unpack(">H", data[at + 2 : at + 4])[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                while body:
                    wide = 2 if body[0] >> 4 else 1
                    quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else "u1").astype(np.float32)
                    body = body[1 + 64 * wide :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = _codes(body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xDD:
                interval = struct.unpack(">H", body)[0]
            elif marker == 0xC2:
                self.frame = _Frame(body)
            elif 0xC0 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
                raise ValueError("not a progressive JPEG")
            elif marker == 0xDA:
                at = self._scan(body, data, at, tables, interval)
        if self.frame is None:
            raise ValueError("no frame")
        self.quant = [quant[q] for q in self.frame.quant]

    def _scan(self, body: bytes, data: bytes, at: int, tables: dict, interval: int) -> int:
        frame, n = self.frame, body[0]
        parts = [frame.ids.index(body[1 + 2 * i]) for i in range(n)]
        first, last, approximation = body[1 + 2 * n : 4 + 2 * n]
        high, low = approximation >> 4, approximation & 15
        slots = [body[2 + 2 * i] for i in range(n)]
        used = {p: tables.get(s >> 4 if first == 0 else 16 | (s & 15)) for p, s in zip(parts, slots, strict=True)}
        segments, start = [], at
        while True:
            at = data.find(b"\xff", at)
            if at < 0:
                at = len(data)
            elif data[at + 1] == 0:
                at += 2
                continue
            segments.append(data[start:at].replace(b"\xff\x00", b"\xff"))
            if at < len(data) and 0xD0 <= data[at + 1] <= 0xD7:
                at += 2
                start = at
                continue
            break
        whole, where, at_block = frame.whole(parts), None, 0
        for i, segment in enumerate(segments):
            bits = np.unpackbits(np.frombuffer(segment, np.uint8))
            if whole:
                mine = [b[at_block : at_block + interval] if interval else b for b in whole]
                at_block += interval
                if not len(mine[0]) or _strided(mine, bits, list(used.values()), first, last, high, low):
                    continue
            where = frame.blocks(parts) if where is None else where
            per = interval * (len(where) // (frame.mcus_x * frame.mcus_y) if n > 1 else 1) or len(where)
            _coded(frame, where[i * per : (i + 1) * per], bits, used, first, last, high, low)
        return at

    def rgb(self) -> np.ndarray:
        """The full-resolution tensor (height, width, 3) of 8-bit samples."""
        f = self.frame
        planes = []
        for (h, v), coefficients, quant in zip(f.sampling, f.coefficients, self.quant, strict=True):
            rows, cols = coefficients.shape[:2]
            samples = coefficients.reshape(-1, 64).astype(np.float32) @ (_BASIS * quant[:, None]) + 128
            plane = samples.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
            if (h, v) != (f.hmax, f.vmax):
                plane = plane.repeat(f.vmax // v, 0).repeat(f.hmax // h, 1)
            planes.append(np.clip(plane[: f.height, : f.width], 0, 255))
        if len(planes) == 1:
            return np.repeat(np.rint(planes[0]).astype(np.uint8)[..., None], 3, 2)
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        out = np.empty((*y.shape, 3), np.float32)
        out[..., 0] = y + np.float32(1.402) * cr
        out[..., 1] = y - np.float32(0.344136) * cb - np.float32(0.714136) * cr
        out[..., 2] = y + np.float32(1.772) * cb
        return np.rint(np.clip(out, 0, 255, out=out), out=out).astype(np.uint8)


def image_payload(image: Image) -> bytes:
    """The bytes that ``payload_image`` stored."""
    length = int(image.comment.split()[1])
    ac = np.stack([c.reshape(-1, 64) for c in image.frame.coefficients], 1)
    ac[..., 1:] -= AC_BASE
    ac[..., 0] -= DC_BASE * ((np.arange(len(ac)) + 1) % 2)[:, None]
    return ac.astype(np.uint8).tobytes()[:length]


def payload_images(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes long, media binary: each whole text in UTF-8, padded with spaces to a positive multiple of ``UNIT``, as an image.

    Null text is empty. Rows are treated one by one, so repeated rows and null
    doc_ids are kept; an empty table gives no rows; further columns are dropped.
    An image takes some nine times its payload of memory while it is made, and
    a JPEG's 65,535 lines hold a payload of about 1.6 GB at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media, sizes = [], []
            for text in batch.column(1).cast(pa.binary()):
                raw = text.as_py() or b""
                sizes.append(len(raw))
                media.append(payload_image(raw + b" " * (-len(raw) % UNIT or (0 if raw else UNIT))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def describe(rgb: np.ndarray) -> str:
    """Size, mean of each channel and share of saturated samples of a tensor."""
    count = rgb.shape[0] * rgb.shape[1]
    means = rgb.reshape(-1, 3).sum(0, dtype=np.int64)
    edge = int(((rgb == 0) | (rgb == 255)).sum())
    return f"{rgb.shape[1]}x{rgb.shape[0]} mean {' '.join(f'{m / count:.3f}' for m in means)} saturated {edge / (3 * count):.4f}"


def read_images(images: DataFrame, tensors: bool = True, payloads: bool = False) -> DataFrame:
    """``images`` with height, width int, feature string, and rgb binary (height x width x 3) or the payload where asked for.

    Null or broken media: nulls. Columns of the new names are replaced.
    """
    added = ["height", "width", "feature", *["rgb"] * tensors, *["payload"] * payloads]
    kept = [c for c in images.columns if c not in added]
    at = kept.index("media")
    schema = images.select(*kept).schema.add("height", "integer").add("width", "integer").add("feature", "string")
    for name in added[3:]:
        schema = schema.add(name, "binary")

    kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * (len(added) - 3)]

    def part(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, since, size = [], 0, 0
            for k, media in enumerate(batch.column(at)):
                try:
                    image = Image(media.as_py() or b"")
                    rgb = image.rgb()
                    rows.append((*rgb.shape[:2], describe(rgb), *[rgb.tobytes()] * tensors, *[image_payload(image)] * payloads))
                    size += rgb.nbytes
                except (ValueError, IndexError, KeyError, TypeError, struct.error):
                    rows.append((None,) * len(added))
                if size > PART:
                    yield part(batch.slice(since, k + 1 - since), rows)
                    rows, since, size = [], k + 1, 0
            yield part(batch.slice(since), rows)

    return images.select(*kept).mapInArrow(run, schema)


def payload_digests(images: DataFrame) -> DataFrame:
    """Digests of the stored images and of the payloads read back from them, and the full-resolution tensors: a row for each row of ``images``.

    The last columns are height, width int and rgb binary (height x width x 3),
    to be stored with the rest. Repeated rows and null doc_ids are kept, an
    empty table gives no rows, further columns are dropped.
    """
    tail = F.expr("substring(payload, -16, 16)")
    back = read_images(images, payloads=True)
    return back.select("doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", "height", "width", "rgb")
