"""Media columns: GIF streams written, read and turned into timed frames with colour histograms.

`read_gif` reads any GIF: LZW code streams of growing width, global and local palettes,
interlacing, the four disposal rules and transparency; `shown` lays its frames over each
other.  `frames_of` is the DataFrame form: one row per shown frame with its time, pixels
and histogram.  `store_payload` stores bytes as timed frames of 24 x 24 samples over a
grey palette, and `media_digest` reads such media back through the same reader.

Stored frames are compressed like those of any animation: after the first, a sample that
is already shown is written as a transparent one, if some of the 256 values is free in
the frame to stand for that, and the stream goes through LZW with its growing table.

Defined cases: null text is the empty payload (one frame of padding); null or broken
media, and canvases of more than `MOST_PIXELS`, give a row with `error` set, after the
frames that could be shown before the fault; repeated rows are kept.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._words import buffer_of, slices

SIDE = 24
SAMPLES = SIDE * SIDE
MOST_PIXELS = 1 << 26
BATCH_BYTES = 16 << 20
TOGETHER = 2048  # samples of frames whose streams advance together; their tables cannot fill up
DELAY = 10  # hundredths of a second
GREYS = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)
BINS = 8


class GifError(ValueError):
    pass


# ---------------------------------------------------------------- code streams


def lzw_encode(samples: bytes, bits: int = 8) -> bytes:
    """Packed codes with a growing table, cleared when it holds 4,096 entries."""
    clear, end = 1 << bits, (1 << bits) + 1
    out, width, free = bytearray(), bits + 1, end + 1
    held, count = clear, width  # codes not yet written, the first in the lowest bits
    table: dict[int, int] = {}
    known = table.get
    if samples:
        prefix = samples[0]
        for x in memoryview(samples)[1:]:
            key = prefix << 8 | x
            code = known(key)
            if code is not None:
                prefix = code
                continue
            held |= prefix << count
            count += width
            if free < 4096:
                table[key] = free
                free += 1
                if free > 1 << width and width < 12:
                    width += 1
            else:
                held |= clear << count
                count += width
                table.clear()
                free, width = end + 1, bits + 1
            if count > 2048:
                whole = count >> 3
                out += (held & ((1 << 8 * whole) - 1)).to_bytes(whole, "little")
                held >>= 8 * whole
                count &= 7
            prefix = x
        held |= prefix << count
        count += width
        free += 1
        if free > 1 << width and width < 12:
            width += 1
    held |= end << count
    count += width
    return bytes(out + held.to_bytes(-(-count // 8), "little"))


def lzw_encode_together(samples: np.ndarray) -> list[bytes]:
    """What `lzw_encode` gives for each row of 8-bit samples, at most TOGETHER of them: all rows advance sample by sample.

    Every row has a hash table of its own with open addressing and more slots than it can have entries.
    """
    count, size = samples.shape
    if not size or size > TOGETHER:
        return [lzw_encode(x.tobytes()) for x in samples]
    slots = 1 << size.bit_length()
    keys, values = np.full(count * slots, -1, np.int32), np.zeros(count * slots, np.int16)
    base, prefix, used = np.arange(count) * slots, samples[:, 0].astype(np.int64), np.zeros(count, np.int64)
    codes = np.zeros((count, size + 1), np.uint32)
    columns = np.ascontiguousarray(samples.T).astype(np.int64)
    for x in columns[1:]:
        key = prefix << 8 | x
        at = base + ((key * 40503 >> 5) & (slots - 1))
        held = keys[at]
        seek = np.flatnonzero((held != key) & (held >= 0))
        while len(seek):
            at[seek] = base[seek] + ((at[seek] - base[seek] + 1) & (slots - 1))
            held[seek] = keys[at[seek]]
            seek = seek[(held[seek] != key[seek]) & (held[seek] >= 0)]
        new = np.flatnonzero(held < 0)
        codes[new, used[new]] = prefix[new]
        keys[at[new]] = key[new]
        values[at[new]] = 258 + used[new]
        used[new] += 1
        prefix = np.where(held < 0, x, values[at])
    rows = np.arange(count)
    codes[rows, used] = prefix
    codes = np.concatenate([codes, np.zeros((count, 1), np.uint32)], axis=1)
    codes[rows, used + 1] = 257
    widths = np.maximum(9, np.ceil(np.log2(np.arange(258, 258 + size + 2))).astype(np.int64))  # as many entries as codes went before
    begin = 9 + np.cumsum(widths) - widths
    out = np.zeros((int(begin[-1] + widths[-1]) // 8 + 3, count), np.uint8)
    out[1] = 1  # the clear code, 256
    for j, bit in enumerate(begin.tolist()):
        v = codes[:, j] << np.uint32(bit & 7)
        for k in range(3):
            out[(bit >> 3) + k] |= (v >> np.uint32(8 * k)).astype(np.uint8)
    out = np.ascontiguousarray(out.T)
    return [out[i, : -(-int(begin[n] + widths[n]) // 8)].tobytes() for i, n in enumerate((used + 1).tolist())]


def lzw_decode(data: bytes, bits: int, limit: int) -> bytes:
    """Samples of one code stream, at most `limit`."""
    if not 1 <= bits <= 11:
        raise GifError(f"code size {bits}")
    clear, end = 1 << bits, (1 << bits) + 1
    base = [bytes([k & 255]) for k in range(clear)] + [b"", b""]
    table, width, last = list(base), bits + 1, None
    parts, made, held, count, at = [], 0, 0, 0, 0
    while made < limit:
        if count < width:
            more = data[at : at + 64]
            at += 64
            held |= int.from_bytes(more, "little") << count
            count += 8 * len(more)
            if count < width:
                break
        code = held & ((1 << width) - 1)
        held >>= width
        count -= width
        if code == clear:
            table, width, last = list(base), bits + 1, None
            continue
        if code == end:
            break
        if code < len(table):
            entry = table[code]
        elif last is not None and code == len(table):
            entry = last + last[:1]
        else:
            raise GifError("code outside the table")
        parts.append(entry)
        made += len(entry)
        if last is not None and len(table) < 4096:
            table.append(last + entry[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
        last = entry
    return b"".join(parts)[:limit]


def _widths(bits: int, most: int) -> np.ndarray:
    """The widths of a stream's codes after its first clear code, as long as no other follows."""
    size = np.arange(most) + (1 << bits) + 1  # entries when a code is read; the first one adds none
    size[0] += 1
    return np.clip(np.floor(np.log2(np.maximum(size, 1) + 0.5)).astype(np.int64) + 1, bits + 1, 12)


def lzw_decode_together(streams: list[bytes], bits: int, limit: int) -> list[bytes | None]:
    """What `lzw_decode` gives for each of many short streams; None for one with a further clear code, or that ends early.

    Without further clear codes the widths are the same in all streams, so all codes are
    read at once, and the streams then advance code by code together.  A table entry is
    kept as the place in the output where it was first written, one sample longer than the
    code that wrote it.
    """
    clear, end = 1 << bits, (1 << bits) + 1
    count, size = len(streams), max((len(x) for x in streams), default=0)
    raw = np.frombuffer(b"".join(x.ljust(size + 3, b"\0") for x in streams), np.uint8).reshape(count, size + 3).astype(np.uint32)
    widths = _widths(bits, size * 8 // (bits + 1))
    at = np.concatenate([[bits + 1], bits + 1 + np.cumsum(widths)])[:-1]
    fits = at + widths <= size * 8
    at, widths = at[fits], widths[fits]
    byte = at >> 3
    codes = ((raw[:, byte] | raw[:, byte + 1] << 8 | raw[:, byte + 2] << 16) >> (at & 7).astype(np.uint32)) & ((1 << widths) - 1).astype(np.uint32)
    codes = codes.astype(np.int32)
    stop = np.where((codes == end).any(axis=1), (codes == end).argmax(axis=1), -1) if codes.shape[1] else np.full(count, -1)
    again = ((codes == clear) & (np.arange(codes.shape[1]) < stop[:, None])).any(axis=1)
    first = raw[:, 0] | raw[:, 1] << 8
    good = (stop >= 0) & ~again & ((first & ((2 << bits) - 1)) == clear)
    starts, lengths = (np.zeros(codes.shape, np.int32) for _ in range(2))
    out = np.zeros((count, limit + codes.shape[1] + 1), np.uint8)
    pos = np.zeros(count, np.int64)
    for j in range(int(stop.max(initial=-1))):
        live = np.flatnonzero(good & (j < stop) & (pos < limit))
        if not len(live):
            break
        c = codes[live, j]
        plain = c < clear
        entry = c - end - 1
        bad = ~plain & (entry >= j)
        if bad.any():
            good[live[bad]] = False
            live, c, plain, entry = (x[~bad] for x in (live, c, plain, entry))
        here = pos[live]
        starts[live, j] = here
        out[live[plain], here[plain]] = c[plain]
        row, entry, to = live[~plain], entry[~plain], here[~plain]
        n = lengths[row, entry] + 1
        source = starts[row, entry]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        rows = np.repeat(row, n)
        out[rows, np.repeat(to, n) + step] = out[rows, np.repeat(source, n) + step]
        out[row, to + n - 1] = np.where(entry == j - 1, out[row, to], out[row, to + n - 1])  # an entry that the code itself completes
        lengths[live[plain], j] = 1
        lengths[row, j] = n
        pos[live] += lengths[live, j]
    return [out[i, : min(limit, int(pos[i]))].tobytes() if good[i] else None for i in range(count)]


# ---------------------------------------------------------------- whole files


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    interlaced: bool
    palette: np.ndarray
    bits: int
    codes: bytes
    samples: np.ndarray | None = None


@dataclass
class Gif:
    width: int
    height: int
    background: int
    palette: np.ndarray | None
    loops: int | None = None
    frames: list[Frame] = field(default_factory=list)


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while True:
        if at >= len(data):
            raise GifError("a block is cut short")
        n = data[at]
        at += 1
        if not n:
            return b"".join(parts), at
        parts.append(data[at : at + n])
        at += n


def parse_gif(data: bytes) -> Gif:
    """Structure and code streams; samples are filled in by `decode`."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
    at, palette = 13, None
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    gif = Gif(width, height, background, palette)
    delay, disposal, transparent = 0, 0, None
    while at < len(data) and data[at] != 0x3B:
        kind = data[at]
        if kind == 0x21:
            label = data[at + 1]
            body, at = _blocks(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                transparent = body[3] if body[0] & 1 else None
            elif label == 0xFF and body[:11] == b"NETSCAPE2.0" and len(body) >= 14:
                gif.loops = body[12] | body[13] << 8
        elif kind == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
            at += 10
            own = gif.palette
            if bits & 0x80:
                n = 2 << (bits & 7)
                own = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                at += 3 * n
            if own is None:
                raise GifError("no palette")
            size = data[at]
            codes, at = _blocks(data, at + 1)
            gif.frames.append(Frame(left, top, w, h, delay, disposal, transparent, bool(bits & 0x40), own, size, codes))
            delay, disposal, transparent = 0, 0, None
        else:
            raise GifError(f"block {kind:#x}")
    return gif


def decode(frames: list[Frame]) -> None:
    """Fills in the samples: short streams of one size together, and what they leave one by one."""
    groups: dict[tuple[int, int], list[Frame]] = {}
    for f in frames:
        groups.setdefault((f.bits, f.width * f.height), []).append(f)
    for (bits, n), own in groups.items():
        if 2 <= bits <= 8 and n <= TOGETHER:
            for f, x in zip(own, lzw_decode_together([f.codes for f in own], bits, n)):
                f.samples = None if x is None else np.frombuffer(x, np.uint8)
    for f in frames:
        n = f.width * f.height
        if f.samples is None:
            f.samples = np.frombuffer(lzw_decode(f.codes, f.bits, n), np.uint8)
        if len(f.samples) < n:
            raise GifError("a frame is cut short")
        if f.interlaced and f.height:
            rows = np.concatenate([np.arange(a, f.height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            x = np.empty((f.height, f.width), np.uint8)
            x[rows] = f.samples.reshape(f.height, f.width)
            f.samples = x.reshape(-1)


def shown(gif: Gif) -> Iterator[tuple[int, np.ndarray]]:
    """Start in milliseconds and RGBA canvas of each frame as shown."""
    if gif.width * gif.height > MOST_PIXELS:
        raise GifError(f"a canvas of {gif.width} x {gif.height}")
    canvas, now = np.zeros((gif.height, gif.width, 4), np.uint8), 0
    for f in gif.frames:
        before = canvas.copy() if f.disposal == 3 else None
        x = f.samples.reshape(f.height, f.width)
        if x.size and x.max() >= len(f.palette):
            raise GifError("a sample is outside the palette")
        part = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        x = x[: part.shape[0], : part.shape[1]]
        drawn = x != f.transparent if f.transparent is not None else np.ones(x.shape, bool)
        part[drawn, :3] = f.palette[x[drawn]]
        part[drawn, 3] = 255
        yield now, canvas.copy()
        now += f.delay * 10
        if f.disposal == 2:
            part[:] = 0
        elif before is not None:
            canvas = before


def read_gifs(media: list[bytes]) -> list[Gif]:
    """All of them, their frames decoded together; GifError if any is broken."""
    try:
        gifs = [parse_gif(x) for x in media]
        decode([f for g in gifs for f in g.frames])
    except (IndexError, struct.error, ValueError) as e:
        raise e if isinstance(e, GifError) else GifError(str(e)) from e
    return gifs


def read_gif(data: bytes) -> Gif:
    return read_gifs([data])[0]


def _screen(width: int, height: int, palette: np.ndarray, loops: int | None = None) -> tuple[bytes, int]:
    """Header and palette, and the code size."""
    power = max(1, int(len(palette) - 1).bit_length())
    table = np.zeros((1 << power, 3), np.uint8)
    table[: len(palette)] = palette
    again = b"" if loops is None else b"\x21\xff\x0bNETSCAPE2.0\x03\x01" + struct.pack("<H", loops) + b"\x00"
    return b"GIF89a" + struct.pack("<HHBBB", width, height, 0x80 | 0x70 | (power - 1), 0, 0) + table.tobytes() + again, max(2, power)


def _image(codes: bytes, bits: int, width: int, height: int, left: int = 0, top: int = 0, delay: int = 0, disposal: int = 0, transparent: int | None = None) -> bytes:
    blocks = b"".join([bytes([len(x)]) + x for x in (codes[k : k + 255] for k in range(0, len(codes), 255))])
    control = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\x00"
    return control + b"\x2c" + struct.pack("<HHHHB", left, top, width, height, 0) + bytes([bits]) + blocks + b"\x00"


def write_gif(width: int, height: int, palette: np.ndarray, frames: list[dict]) -> bytes:
    """A GIF with compressed streams; frames: samples and, as wanted, left, top, width, height, delay, disposal, transparent."""
    head, bits = _screen(width, height, palette)
    return head + b"".join(_image(lzw_encode(bytes(f["samples"]), bits), bits, **{"width": width, "height": height} | {k: v for k, v in f.items() if k != "samples"}) for f in frames) + b"\x3b"


# ---------------------------------------------------------------- payloads as media


def store_payloads(payloads: list[np.ndarray]) -> list[bytes]:
    """GIFs that show the payloads, each a positive multiple of SAMPLES bytes, in timed frames of grey samples.

    A frame is laid over what is shown before it (disposal 1: left in place).
    """
    if not payloads:
        return []
    counts = np.array([len(x) // SAMPLES for x in payloads])
    first = np.cumsum(counts) - counts
    frames = np.concatenate(payloads).reshape(-1, SAMPLES)
    used = np.zeros((len(frames), 256), bool)
    used[np.arange(len(frames))[:, None], frames] = True
    spare = np.where(used.all(axis=1), -1, (~used).argmax(axis=1))  # a value that does not occur
    spare[first] = -1
    coded = frames.copy()
    coded[1:] = np.where((frames[1:] == frames[:-1]) & (spare[1:, None] >= 0), spare[1:, None], frames[1:])
    head, bits = HEADER
    images = [_image(x, bits, SIDE, SIDE, delay=DELAY, disposal=1, transparent=free if free >= 0 else None) for x, free in zip(lzw_encode_together(coded), spare.tolist())]
    return [b"".join([head, *images[at : at + n], b"\x3b"]) for at, n in zip(first.tolist(), counts.tolist())]


def store_payload(payload: np.ndarray) -> bytes:
    return store_payloads([payload])[0]


HEADER = _screen(SIDE, SIDE, GREYS, loops=0)


MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_frames", pa.int32()), ("duration_ms", pa.int64()), ("histogram", pa.list_(pa.int64()))])
MEDIA_SQL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, duration_ms long, histogram array<long>"


def media_digest(docs: DataFrame, *, slice_bytes: int = 2 << 20) -> DataFrame:
    """Stores every whole text as a GIF, reads the bytes back and describes what was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", slice_bytes):
            data, off = buffer_of(b.column("text"))
            payloads = []
            for x, y in zip(off[:-1].tolist(), off[1:].tolist()):
                payload = np.full(max(1, -(-(y - x) // SAMPLES)) * SAMPLES, 255, np.uint8)
                payload[: y - x] = data[x:y]
                payloads.append(payload)
            stored = store_payloads(payloads)
            gifs = read_gifs(stored)
            rows = []
            for media, gif in zip(stored, gifs):
                read = b"".join(canvas[:, :, 0].tobytes() for _, canvas in shown(gif))
                hist = np.bincount(np.frombuffer(read, np.uint8) >> 5, minlength=BINS).tolist()
                feature = f"{gif.width}x{gif.height}x{len(gif.frames)};" + ",".join(map(str, hist))
                rows.append((len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(gif.frames), sum(f.delay for f in gif.frames) * 10, hist))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.diff(off)), *(pa.array(c, MEDIA.field(k + 2).type) for k, c in enumerate(cols))], schema=MEDIA)

    return docs.select("doc_id", "text").mapInArrow(run, MEDIA_SQL)


def frames_of(media: DataFrame, *, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row per shown frame of any GIFs: time, size, RGBA pixels and counts per channel and eighth of the scale."""
    kind = media.schema[key].dataType.simpleString()
    sql = f"{key} {kind}, frame int, start_ms long, delay_ms long, width int, height int, rgba binary, red array<long>, green array<long>, blue array<long>, shown_pixels long, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "frame", "start_ms", "delay_ms", "width", "height", "rgba", "red", "green", "blue", "shown_pixels", "error"]
        longs = pa.list_(pa.int64())
        for batch in batches:
            kinds = [batch.schema.field(key).type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), longs, longs, longs, pa.int64(), pa.string()]
            for k, data in zip(batch.column(key).to_pylist(), batch.column(column)):
                rows, held = [], 0
                batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                try:
                    if (data := data.as_py()) is None:
                        raise GifError("null")
                    gif = read_gif(data)
                    for n, ((start, x), f) in enumerate(zip(shown(gif), gif.frames)):
                        seen = x[x[:, :, 3] > 0]
                        hist = [np.bincount(seen[:, c] >> 5, minlength=BINS).tolist() for c in range(3)]
                        rows.append((k, n, start, f.delay * 10, gif.width, gif.height, x.tobytes(), *hist, len(seen), None))
                        held += x.size
                        if held > BATCH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                except GifError as e:
                    rows.append((k, *[None] * 10, str(e)))
                if rows:
                    yield batch_of(rows)

    return media.select(key, column).mapInArrow(run, sql)
