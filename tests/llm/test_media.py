import hashlib
import random
import zlib

import numpy as np
import pytest

from docquarry.llm import media


def test_code_streams_round_trip():
    random.seed(13)
    for n in (0, 1, 2, 5, 300, 5000, 40000):
        for symbols in (1, 2, 256):
            data = bytes(random.randrange(symbols) for _ in range(n))
            assert media.lzw_decode(media.lzw_encode(data)) == data
            low = bytes(x & 3 for x in data)
            assert media.lzw_decode(media.lzw_encode(low, 2), 2) == low


def test_another_decoder_reads_the_files(spark):
    """The JVM's own GIF reader sees the same pixels in every frame."""
    random.seed(14)
    payload = media.payload_for(bytes(random.randrange(256) for _ in range(media.WIDTH * 70)))
    jvm = spark._jvm
    stream = jvm.javax.imageio.ImageIO.createImageInputStream(jvm.java.io.ByteArrayInputStream(media.to_gif(payload)))
    reader = jvm.javax.imageio.ImageIO.getImageReadersByFormatName("gif").next()
    reader.setInput(stream)
    assert reader.getNumImages(True) == 2
    for frame, rows in ((0, 64), (1, 6)):
        image = reader.read(frame)
        assert (image.getWidth(), image.getHeight()) == (media.WIDTH, rows)
        for x, y in ((0, 0), (575, rows - 1), (100, rows // 2), (311, 3)):
            at = (frame * 64 + y) * media.WIDTH + x
            assert image.getRGB(x, y) >> 16 & 255 == payload[at]


def test_disposal_transparency_and_interlacing():
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255] + [0] * (3 * 252))
    frames = lambda disposal, transparent: media.encode_gif([(bytes([1] * 4), 2), (bytes([2, 3]), 1), (bytes([3, 3]), 1)], 2, 2, palette, disposal=disposal, transparent=transparent)
    red, green, blue, none = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255], [0, 0, 0, 0]
    shown = lambda data: [c.tolist() for c in media.compose(*media.decode_gif(data))]
    assert shown(frames(1, None)) == [[[red, red], [red, red]], [[green, blue], [red, red]], [[blue, blue], [red, red]]]
    assert shown(frames(1, 3)) == [[[red, red], [red, red]], [[green, red], [red, red]], [[green, red], [red, red]]]
    assert shown(frames(2, 3))[1:] == [[[green, none], [none, none]], [[none, none], [none, none]]]
    assert shown(frames(3, None))[1] == [[green, blue], [none, none]]
    rows = np.arange(10).astype(np.uint8)
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7, 9]
    data = media.encode_gif([(bytes(order), 10)], 1, 10)
    at = data.index(b"\x2c\0\0\0\0") + 9
    data = data[:at] + bytes([data[at] | 0x40]) + data[at + 1 :]
    assert media.decode_gif(data)[2][0].indices.ravel().tolist() == rows.tolist()


def brute_feature(payload):
    """Colours of the payload's frames: red is the byte, the others go by the frame's palette."""
    bins = [[0] * 16 for _ in range(3)]
    for at, red in enumerate(payload):
        n = at // (576 * 64) % 3
        for c, value in enumerate((red, (red * (2 * n + 3) + 85 * n) % 256, (255 - red + 51 * n) % 256)):
            bins[c][value // 16] += 1
    return [x for own in bins for x in own]


def test_payloads_go_through_palettes_transparency_and_disposal():
    random.seed(19)
    size = media.WIDTH * media.ROWS
    base = bytes(random.randrange(200) for _ in range(size))
    near = bytearray(base)
    near[100:5000] = bytes(random.randrange(200) for _ in range(4900))
    payload = base + bytes(near) + base + base + bytes(near) + bytes(random.randrange(256) for _ in range(size)) + base[: media.WIDTH * 3]
    width, height, frames = media.decode_gif(media.to_gif(payload))
    assert [f.disposal for f in frames] == [1, 2, 3, 1, 2, 3, 1] and sum(f.transparent is not None for f in frames) >= 2
    assert len({f.palette.tobytes() for f in frames}) == 3
    assert media.from_gif(media.to_gif(payload))[0] == payload


def test_damaged_files_are_errors():
    rng = random.Random(23)
    files = [media.to_gif(media.payload_for(bytes(rng.randrange(256) for _ in range(n)))) for n in (0, 700, 3000)]
    files += [media.encode_gif([(bytes([1] * 4), 2), (bytes([2, 3]), 1)], 2, 2, disposal=d, transparent=t) for d in (1, 2, 3) for t in (None, 3)]
    errors = 0
    for _ in range(20_000):
        data = bytearray(rng.choice(files))
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(data)) if rng.random() < 0.3 else min(rng.choice([6, 7, 8, 9, 10, 781, 800, 810, 811, 812, 813, 814, 815, 816, 817, 818, 819, 820, 821, 1589, 1590]) + rng.randrange(-8, 8), len(data) - 1)
            data[at] = rng.randrange(256)
        try:
            width, height, frames = media.decode_gif(bytes(data))
            if width * height < 1 << 16:
                list(media.compose(width, height, frames))
        except ValueError:
            errors += 1
    assert 1000 < errors < 20_000


def test_sizes_have_bounds():
    good = media.encode_gif([(bytes([1] * 4), 2)], 2, 2)
    at = good.index(b"\x2c\0\0\0\0")
    for bits in (0, 1, 9, 30, 40, 200):
        with pytest.raises(ValueError, match="code size"):
            media.decode_gif(good[: at + 10] + bytes([bits]) + good[at + 11 :])
    with pytest.raises(ValueError, match="canvas"):
        media.decode_gif(good[:6] + b"\xff" * 4 + good[10:])
    with pytest.raises(ValueError, match="frames"):
        media.decode_gif(good[: at + 5] + b"\xff" * 4 + good[at + 9 :])


def test_texts_as_media(spark):
    texts = [None, "", "a", "é" * 288, "x" * 576, "y" * 577, "tie", "tie", "long " * 40000]
    df = spark.createDataFrame([(i, t, b"m", 1) for i, t in enumerate(texts)], "doc_id long, text string, media binary, n_frames int")
    got = {r.doc_id: r for r in media.text_media(df).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        payload = data + b"\xff" * (-len(data) % 576 if data else 576)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert list(map(int, r.feature.split())) == brute_feature(payload)
    assert got[6][1:] == got[7][1:] and got[8].n_frames == 6
    stored = {r.id: r.media for r in media.store(df).collect()}
    assert all(hashlib.sha256(stored[i]).hexdigest() == got[i].media_sha256 and len(stored[i]) == got[i].media_bytes for i in got)
    assert media.text_media(df.limit(0)).count() == 0


def test_frames_of_any_gif(spark):
    good = media.encode_gif([(bytes([255] * 4), 2), (bytes([0] * 4), 2)], 2, 2, delay=7)
    df = spark.createDataFrame([(1, good), (2, b"GIF89a"), (3, None), (4, b"no")], "id long, media binary")
    rows = sorted(media.frame_table(df).collect(), key=lambda r: (r.id, r.frame or 0))
    assert [(r.id, r.frame, r.start_cs, r.delay_cs) for r in rows] == [(1, 0, 0, 7), (1, 1, 7, 7), (2, None, None, None), (3, None, None, None), (4, None, None, None)]
    assert rows[0].red == rows[0].blue == [0] * 15 + [4] and rows[1].green == [4] + [0] * 15 and all(r.error for r in rows[2:])
    assert rows[0].pixels == b"\xff" * 16 and rows[1].pixels == b"\0\0\0\xff" * 4
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255] + [0] * (3 * 252))
    data = media.encode_gif([(bytes([1, 1, 2, 3]), 2), (bytes([3, 2]), 1)], 2, 2, palette, transparent=3, disposal=2)
    one, two = sorted(media.frame_table(spark.createDataFrame([(1, data)], "id long, media binary")).collect(), key=lambda r: r.frame)
    assert (one.red[15], one.green[15], one.blue[15], one.red[0]) == (2, 1, 0, 1) and (two.red[0], two.green[15], sum(two.blue)) == (1, 1, 1)
    beyond = data[:10] + b"\xf0" + data[11:19] + data[781:]
    assert [r.error for r in media.frame_table(spark.createDataFrame([(1, beyond)], "id long, media binary"), with_pixels=False).collect()] == ["colour beyond the palette"]


def test_texts_beyond_a_foreign_files_bound(spark, monkeypatch):
    """What the writer wrote is read with the bound of its text's length; foreign files keep theirs, and are rows."""
    monkeypatch.setattr(media, "MOST_TOTAL", 1000)
    for n in (0, 1, 575, 576, 36_864, 36_865, 400_000):
        payload = media.payload_for(bytes(i * 7 % 256 for i in range(n)))
        gif = media.to_gif(payload)
        assert media.from_gif(gif, media.pixels_for(n))[0] == payload
        with pytest.raises(ValueError, match="too large"):
            media.decode_gif(gif)
    stored = spark.createDataFrame([(1, 5, b"GIF89a"), (2, 5, None), (3, 3, media.to_gif(media.payload_for(b"abc")))], "id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in media.read_back(stored).collect()}
    assert got[1].error and got[2].error and got[1].payload_sha256 is None and got[3].error is None and got[3].payload_bytes == 576
