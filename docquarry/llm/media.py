"""Media columns: GIF animations in a binary column, encoded and decoded here.

The encoder writes GIF89a with a global palette, timed frames and LZW code
streams.  The decoder reads any GIF87a or GIF89a: sub-blocks, code streams with
growing and deferred widths, local palettes, interlacing, transparency, and the
four disposal rules; frames come out as indices and as the composed canvas.

``store`` keeps bytes as the pixels of such an animation: a pixel's red sample is
the byte, its frame's palette gives the other colours, frames are disposed of by
each rule in turn, and long runs that the canvas shows already are transparent.
``read_back`` composes the frames, takes the bytes from the canvas and counts
its colours.  ``frame_table`` gives the timed frames of any GIFs with their
pixels and histograms of red, green and blue.

Bad input is rows: bytes that can't be decoded, whatever is wrong with them,
give one row with ``error`` set.  A foreign file's code sizes must be 2 to 8, its canvas
and each frame at most ``MOST_PIXELS``, and all its frames together ``MOST_TOTAL``;
a file that ``store`` wrote is read with the bound that its text's length gives, so
texts may be of any length.

Defined results: null text is empty; a payload is never empty, as it is filled
up with bytes 255 to a positive multiple of the frame's width; repeated rows
and equal texts get equal values; an empty table gives an empty table; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, utf8

#: Pixels in a row, rows in a frame at most, and hundredths of a second a frame.
WIDTH, ROWS, DELAY = 576, 64, 10
#: Bins of a colour's histogram, palettes in turn, and pixels in a run that may be transparent.
BINS, PALETTES, RUN = 16, 3, 16
#: Pixels that a file may declare: of its canvas or a frame, and of all frames' canvases together.
MOST_PIXELS, MOST_TOTAL = 1 << 25, 1 << 28

GREY = bytes(x for i in range(256) for x in (i, i, i))
_BITS = 4096  # a table's size; codes never have over 12 bits


def _widths(first: int, count: int, lag: int) -> np.ndarray:
    """Bits of each of ``count`` codes after a clear code; ``lag``: codes before the table starts to grow."""
    held = first + np.maximum(np.arange(count) - lag, 0)
    return np.clip(np.ceil(np.log2(held + 1)).astype(np.int64), int(first - 1).bit_length(), 12)


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """The code stream of ``data``, whose values have ``bits`` bits."""
    clear = 1 << bits
    codes: list[int] = [clear << 8]  # codes stand eight bits higher here: a code and a value make a key by one "or"
    starts = [0]  # of clear codes
    known: dict[int, int] = {}
    get, put, size = known.get, codes.append, clear + 2 << 8
    if data:
        held = data[0] << 8
        for value in data[1:]:
            code = get(key := held | value)
            if code is not None:
                held = code
                continue
            put(held)
            if size < _BITS << 8:
                known[key] = size
                size += 256
            else:
                starts.append(len(codes))
                put(clear << 8)
                known.clear()
                size = clear + 2 << 8
            held = value << 8
        put(held)
    put(clear + 1 << 8)
    widths = np.empty(len(codes), np.int64)
    for start, end in zip(starts, [*starts[1:], len(codes)]):
        # The clear code itself has the width that the table before it has come to.
        widths[start] = 12 if start else bits + 1
        widths[start + 1 : end] = _widths(clear + 2, end - start - 1, 1)
    narrow = (np.array(codes) >> 8).astype("<u2").view(np.uint8).reshape(-1, 2)
    set_bits = np.unpackbits(narrow, axis=1, count=12, bitorder="little")
    return np.packbits(set_bits[np.arange(12, dtype=np.uint8) < widths.astype(np.uint8)[:, None]], bitorder="little").tobytes()


def _expand(codes: np.ndarray, clear: int) -> np.ndarray:
    """The values of the codes between two clear codes.

    The table's entry ``clear + 2 + i`` is what code i stands for and the first
    value of code i + 1.  So entries are a forest by their prefixes: first values
    and lengths come from doubled pointers, and the values are written from the
    ends of all codes at once, one prefix further in each step.
    """
    n, first = len(codes), clear + 2
    if not n:
        return np.zeros(0, np.uint8)
    if codes[0] >= clear or (codes > first - 1 + np.arange(n)).any():
        raise ValueError("code beyond the table")
    entries = min(n - 1, _BITS - first)
    parent = np.concatenate([np.full(first, -1), codes[:entries]])
    pointer, length = np.where(parent < 0, np.arange(len(parent)), parent), (parent >= 0).astype(np.int64)
    while True:
        further = pointer[pointer]
        length = length + np.where(further != pointer, length[pointer], 0)
        if (further == pointer).all():
            break
        pointer = further
    length += 1
    last = np.arange(len(parent))
    if (codes >= len(parent)).any():
        raise ValueError("code beyond the table")
    last[first:] = pointer[codes[1 : entries + 1]]
    at = np.cumsum(length[codes]) - 1
    out = np.empty(at[-1] + 1, np.uint8)
    while len(codes):
        out[at] = last[codes]
        codes = parent[codes]
        left = codes >= 0
        codes, at = codes[left], at[left] - 1
    return out


def lzw_decode(stream: bytes, bits: int = 8, limit: int | None = None) -> bytes:
    """The values of a code stream, ``limit`` of them at most."""
    clear = 1 << bits
    three = np.frombuffer(stream + b"\0\0", np.uint8).astype(np.uint32)
    three = three[:-2] | three[1:-1] << 8 | three[2:] << 16  # a code lies in three bytes at most
    total, at, out, made = 8 * len(stream), 0, [], 0
    held, count, ended = [], 0, False  # codes since the last clear code, in pieces; their number
    while not ended and at < total and (limit is None or made < limit):
        # Codes to come have known widths, up to the next clear code.
        widths = _widths(clear + 2, count + (512 if not count else 4096), 1)[count:]
        ends = at + np.cumsum(widths)
        widths = widths[ends <= total]
        if not len(widths):
            break
        begin = ends[: len(widths)] - widths
        codes = three[begin >> 3].astype(np.int64) >> (begin & 7) & (1 << widths) - 1
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        n = int(stops[0]) if len(stops) else len(codes)
        held.append(codes[:n])
        count += n
        if not len(stops):
            at = int(ends[n - 1])
            continue
        at, ended = int(ends[n]), bool(codes[n] == clear + 1)
        out.append(_expand(np.concatenate(held), clear))
        made += len(out[-1])
        held, count = [], 0
    if held:
        out.append(_expand(np.concatenate(held), clear))
    data = b"".join(x.tobytes() for x in out)
    return data if limit is None else data[:limit]


def _blocks(data: bytes) -> bytes:
    parts = [bytes([len(x)]) + x for x in (data[i : i + 255] for i in range(0, len(data), 255))]
    return b"".join(parts) + b"\0"


def encode_gif(frames: list[tuple[bytes, int]], width: int, height: int, palette: bytes = GREY, *, disposal: int = 1, transparent: int | None = None, delay: int = DELAY) -> bytes:
    """A GIF89a of (indices, rows) frames, each as wide as the canvas and at its top."""
    return assemble([(indices, rows, disposal, transparent, None) for indices, rows in frames], width, height, palette, delay)


def assemble(frames: Iterable[tuple[bytes, int, int, int | None, bytes | None]], width: int, height: int, palette: bytes, delay: int = DELAY) -> bytes:
    """A GIF89a of frames (indices, rows, disposal, transparent index, own palette), each as wide as the canvas and at its top."""
    out = [b"GIF89a", width.to_bytes(2, "little"), height.to_bytes(2, "little"), bytes([0xF7, 0, 0]), palette]
    out.append(b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x00\x00\x00")
    for indices, rows, disposal, transparent, local in frames:
        out += [b"\x21\xf9\x04", bytes([disposal << 2 | (transparent is not None)]), delay.to_bytes(2, "little"), bytes([transparent or 0, 0])]
        out += [b"\x2c\0\0\0\0", width.to_bytes(2, "little"), rows.to_bytes(2, "little"), b"\0" if local is None else b"\x87" + local, b"\x08", _blocks(lzw_encode(indices))]
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    palette: np.ndarray
    indices: np.ndarray


def decode_gif(data: bytes, most: int | None = None) -> tuple[int, int, list[Frame]]:
    """Width, height and frames of a GIF, of at most ``most`` pixels in all (``MOST_TOTAL``); raises ValueError for anything that isn't one."""
    try:
        return _decode(data, MOST_TOTAL if most is None else most)
    except (IndexError, OverflowError) as e:
        raise ValueError(f"GIF cut short or damaged: {e}") from e


def _decode(data: bytes, most: int) -> tuple[int, int, list[Frame]]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    number = lambda i: int.from_bytes(data[i : i + 2], "little")
    width, height, flags, at = number(6), number(8), data[10], 13
    total = 0
    if width * height > MOST_PIXELS:
        raise ValueError("canvas too large")

    def colours(flags: int) -> np.ndarray:
        nonlocal at
        n = 3 << (flags & 7) + 1
        at += n
        if at > len(data):
            raise ValueError("palette cut short")
        return np.frombuffer(data[at - n : at], np.uint8).reshape(-1, 3)

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    shared = colours(flags) if flags & 0x80 else np.zeros((0, 3), np.uint8)
    frames: list[Frame] = []
    delay = disposal = 0
    transparent = None
    while at < len(data) and data[at] != 0x3B:
        mark = data[at]
        if mark == 0x21:
            label = data[at + 1]
            at += 2
            body = blocks()
            if label == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, int.from_bytes(body[1:3], "little")
                transparent = body[3] if body[0] & 1 else None
        elif mark == 0x2C:
            left, top, w, h, flags = number(at + 1), number(at + 3), number(at + 5), number(at + 7), data[at + 9]
            at += 10
            palette = colours(flags) if flags & 0x80 else shared
            bits = data[at]
            at += 1
            total += width * height + w * h
            if not 2 <= bits <= 8:
                raise ValueError(f"code size {bits}")
            if w * h > MOST_PIXELS or total > most:
                raise ValueError("frames too large")
            values = np.frombuffer(lzw_decode(blocks(), bits, w * h), np.uint8)
            if len(values) < w * h:
                raise ValueError("frame with too few pixels")
            pixels = values.reshape(h, w)
            if flags & 0x40:  # the rows lie in four passes
                order = [r for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(first, h, step)]
                rows = np.empty_like(pixels)
                rows[order] = pixels
                pixels = rows
            frames.append(Frame(left, top, w, h, delay, disposal, transparent, palette, pixels))
            delay = disposal = 0
            transparent = None
        else:
            raise ValueError("unknown block")
    return width, height, frames


def compose(width: int, height: int, frames: list[Frame], copy: bool = True) -> Iterator[np.ndarray]:
    """The canvas (RGBA) as each frame shows it; without ``copy`` it must be read before the next one."""
    canvas = np.zeros((height, width), np.uint32)  # a pixel's four bytes at once
    for f in frames:
        before = canvas.copy() if f.disposal == 3 else None
        area = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        shown = f.indices[: area.shape[0], : area.shape[1]]
        drawn = True if f.transparent is None else shown != f.transparent
        if (shown.size and int(shown.max()) >= len(f.palette)) and (drawn & (shown >= len(f.palette))).any():
            raise ValueError("colour beyond the palette")
        colours = np.zeros((256, 4), np.uint8)
        colours[: len(f.palette), :3], colours[:, 3] = f.palette, 255
        np.copyto(area, colours.view(np.uint32)[:, 0][shown], where=drawn)
        yield (canvas.copy() if copy else canvas).view(np.uint8).reshape(height, width, 4)
        if f.disposal == 2:
            area[:] = 0
        elif before is not None:
            canvas = before


def payload_for(data: bytes) -> bytes:
    """``data`` filled up with bytes 255 to a positive multiple of ``WIDTH``."""
    return data + b"\xff" * (-len(data) % WIDTH or (0 if data else WIDTH))


@cache
def palette_of(n: int) -> bytes:
    """The palette of a frame: red is the index, green and blue go with it by the frame's number."""
    i = np.arange(256)
    return np.stack([i, (i * (2 * n + 3) + 85 * n) % 256, (255 - i + 51 * n) % 256], axis=1).astype(np.uint8).tobytes()


def _frames(payload: bytes) -> Iterator[tuple[bytes, int, int, int | None, bytes]]:
    """The payload's frames, with what the canvas shows before each of them in mind."""
    size = WIDTH * ROWS
    shown, before = np.full(size, -1, np.int16), None  # reds of the canvas, -1 where nothing is drawn
    for n, start in enumerate(range(0, len(payload), size)):
        reds = np.frombuffer(payload[start : start + size], np.uint8)
        area, indices, clear = shown[: len(reds)], reds, None
        same = np.concatenate([[0], (area == reds).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        runs = edges[edges[:, 1] - edges[:, 0] >= RUN]
        if len(runs):
            unused = np.flatnonzero(np.bincount(reds, minlength=256) == 0)
            if len(unused):
                clear, indices = int(unused[0]), reds.copy()
                for a, b in runs.tolist():
                    indices[a:b] = clear
        disposal = n % 3 + 1
        yield indices.tobytes(), len(reds) // WIDTH, disposal, clear, palette_of(n % PALETTES)
        if disposal == 1:
            shown[: len(reds)] = reds
        elif disposal == 2:
            shown[: len(reds)] = -1


def to_gif(payload: bytes) -> bytes:
    """The payload as pixels: frames of ``ROWS`` rows, the last one may have fewer."""
    return assemble(_frames(payload), WIDTH, min(ROWS, len(payload) // WIDTH), palette_of(0))


def histogram(canvas: np.ndarray) -> list[list[int]]:
    """Pixels of a composed canvas by red, green and blue, in ``BINS`` bins each; pixels that show nothing don't count."""
    drawn = canvas.reshape(-1, 4)
    if not drawn[:, 3].all():
        drawn = drawn[drawn[:, 3] > 0]
    return [np.bincount(drawn[:, c] >> 4, minlength=BINS).tolist() for c in range(3)]


def pixels_for(n_bytes: int) -> int:
    """The pixels that ``to_gif`` declares for a text of so many bytes, at most: a canvas and a frame for each frame."""
    return 2 * (n_bytes + WIDTH * ROWS)


def from_gif(media: bytes, most: int | None = None) -> tuple[bytes, np.ndarray, int]:
    """The payload, read from the composed canvas; the frames' colour histograms, summed; the number of frames."""
    width, height, frames = decode_gif(media, most)
    parts, total = [], np.zeros((3, BINS), np.int64)
    for f, canvas in zip(frames, compose(width, height, frames, copy=False)):
        seen = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        if f.transparent is None and seen.size == 4 * f.indices.size:  # the canvas shows the frame's own colours
            held = np.bincount(f.indices.ravel(), minlength=256)[: len(f.palette)]
            total += np.stack([np.bincount(f.palette[:, c] >> 4, held, BINS) for c in range(3)]).astype(np.int64)
        else:
            total += histogram(seen)
        parts.append(seen[..., 0].tobytes())
    return b"".join(parts), total, len(frames)


def store(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_bytes, media``: each text as a GIF."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), df[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 2 << 20):
            texts = [x or b"" for x in utf8(batch.column(1))]
            media = [to_gif(payload_for(x)) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return narrow.mapInArrow(run, f"id {dict(narrow.dtypes)['id']}, n_bytes long, media binary")


def read_back(stored: DataFrame, *, id_column: str = "doc_id") -> DataFrame:
    """Digests of what the media hold, and their features: histograms of red, green and blue.

    Media that can't be read are rows with ``error`` set and nothing else.
    """
    kind = dict(stored.dtypes)["id"]
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "media", 4 << 20):
            rows = []
            for size, media in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                try:
                    payload, colours, n = from_gif(media or b"", pixels_for(size or 0))
                except ValueError as e:
                    rows.append((*[None] * 7, str(e)))
                    continue
                feature = " ".join(map(str, colours.ravel().tolist()))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, n, None))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
            names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "error"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names)

    return stored.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def frame_table(media: DataFrame, *, id_column: str = "id", media_column: str = "media", with_pixels: bool = True) -> DataFrame:
    """One row for each frame of any GIFs: number, time, size, the composed canvas's pixels (RGBA, row by row) and its histograms.

    Histograms have ``BINS`` bins of each colour.  Bytes that can't be decoded, or
    null, give one row with ``error`` set; no frame of a damaged file is a row.
    """
    bound_batches(media.sparkSession, 64)
    narrow = media.select(media[id_column].alias("id"), media[media_column].alias("media"))
    names = ["id", "frame", "start_cs", "delay_cs", "width", "height", "pixels", "red", "green", "blue", "error"]
    types = [None, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3, pa.string()]

    def frames_of(key: object, data: bytes | None) -> Iterator[tuple]:
        width, height, frames = decode_gif(data or b"")
        for f in frames:  # what the canvas can't show is found before the first row goes out
            if f.indices.size and int(f.indices.max()) >= len(f.palette) and (f.indices[f.indices >= len(f.palette)] != f.transparent).any():
                raise ValueError("colour beyond the palette")
        start = 0
        for k, (f, canvas) in enumerate(zip(frames, compose(width, height, frames, copy=False))):
            yield key, k, start, f.delay, width, height, canvas.tobytes() if with_pixels else None, *histogram(canvas), None
            start += f.delay

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.column(0).type, *types[1:]]
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    for row in frames_of(key, data.as_py()):  # a batch for each frame: canvases may be large
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)
                except ValueError as e:
                    row = (key, *[None] * 9, str(e))
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)

    schema = f"id {dict(narrow.dtypes)['id']}, frame int, start_cs long, delay_cs int, width int, height int, pixels binary, red array<long>, green array<long>, blue array<long>, error string"
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def text_media(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Store each text as media and read the stored bytes back."""
    return read_back(store(df, id_column=id_column, text_column=text_column), id_column=id_column)
