import logging
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.__main__ import main
from pagemill.config import PageConfig
from pagemill.operators import pages
from pagemill.sources import files, raster

#: A font of three glyphs: a square (A), a triangle below the line (g), and a composite of the square moved right (á).
SQUARE, TRIANGLE = [(0, 0), (0, 1000), (1000, 1000), (1000, 0)], [(0, 0), (500, -400), (1000, 0)]


def small_font():
    def simple(points):
        xs, ys = zip(*points, strict=True)
        out = struct.pack(">5h", 1, min(xs), min(ys), max(xs), max(ys)) + struct.pack(">HH", len(points) - 1, 0) + b"\x01" * len(points)
        for axis in (xs, ys):
            out += b"".join(struct.pack(">h", b - a) for a, b in zip((0, *axis), axis))
        return out + b"\0" * (-len(out) % 4)

    composite = struct.pack(">5h", -1, 300, 0, 1300, 1000) + struct.pack(">HHhh", 3, 1, 300, 0) + b"\0\0"
    glyphs = [b"", simple(SQUARE), simple(TRIANGLE), composite]
    places = [sum(map(len, glyphs[:i])) for i in range(5)]
    codes = {ord("A"): 1, ord("g"): 2, ord("á"): 3}
    groups = b"".join(struct.pack(">III", c, c, g) for c, g in sorted(codes.items()))
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10, 12) + struct.pack(">HHIII", 12, 0, 16 + len(groups), 0, len(codes)) + groups
    tables = {
        b"cmap": cmap, b"glyf": b"".join(glyphs), b"head": b"\0" * 18 + struct.pack(">H", 1000) + b"\0" * 30 + struct.pack(">hh", 1, 0),
        b"hhea": struct.pack(">Ihhh", 0x10000, 1000, -400, 0) + b"\0" * 24 + struct.pack(">H", 4),
        b"hmtx": b"".join(struct.pack(">Hh", w, 0) for w in (500, 1100, 1100, 1400)), b"loca": struct.pack(">5I", *places),
    }
    head, body, at = b"", b"", 12 + 16 * len(tables)
    for tag, data in tables.items():
        head += tag + struct.pack(">III", 0, at + len(body), len(data))
        body += data + b"\0" * (-len(data) % 4)
    return struct.pack(">IHHHH", 0x10000, len(tables), 0, 0, 0) + head + body


def test_png_round_trip_and_modes():
    r = np.random.default_rng(0)
    x = r.integers(0, 256, (9, 7, 3)).astype(np.uint8)
    assert (raster.read_png(raster.png(x, 144)) == x).all()

    def file(width, height, depth, color, rows, palette=b""):
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, color, 0, 0, 0)) + (chunk(b"PLTE", palette) if palette else b"")
        return raster.SIGNATURE + head + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

    assert raster.read_png(file(2, 1, 8, 0, b"\0\x10\x20")).tolist() == [[[16] * 3, [32] * 3]]
    assert raster.read_png(file(2, 1, 8, 4, b"\0\x10\xff\x20\x00")).tolist() == [[[16] * 3, [32] * 3]]
    assert raster.read_png(file(1, 1, 8, 6, b"\0\x01\x02\x03\x80")).tolist() == [[[1, 2, 3]]]
    assert raster.read_png(file(2, 1, 1, 3, b"\0\x40", b"\1\2\3\4\5\6")).tolist() == [[[1, 2, 3], [4, 5, 6]]]
    assert raster.read_png(file(1, 1, 16, 2, b"\0\x01\xff\x02\xff\x03\xff")).tolist() == [[[1, 2, 3]]]
    # each filter against the pixels it was made from
    for kind in range(5):
        rows, before = b"", np.zeros(21, int)
        for y in range(9):
            line = x[y].ravel().astype(int)
            left, corner = np.append([0] * 3, line[:-3]), np.append([0] * 3, before[:-3])
            p = left + before - corner
            near = np.select([(abs(p - left) <= abs(p - before)) & (abs(p - left) <= abs(p - corner)), abs(p - before) <= abs(p - corner)], [left, before], corner)
            rows += bytes([kind]) + ((line - (0, left, before, (left + before) // 2, near)[kind]) % 256).astype(np.uint8).tobytes()
            before = line
        assert (raster.read_png(file(7, 9, 8, 2, rows)) == x).all()


def test_rows_that_repeat_round_trip():
    r = np.random.default_rng(1)
    for shape in ((1, 1, 3), (40, 9, 3), (300, 70, 3)):
        x = np.repeat(r.integers(0, 256, shape).astype(np.uint8), r.integers(1, 60, shape[0]), axis=0)
        x[len(x) // 2 :] = x[-1]  # a long run
        data = raster.png(x)
        assert (raster.read_png(data) == x).all()
        at = data.index(b"IDAT")
        assert zlib.crc32(data[at : at + 4 + struct.unpack(">I", data[at - 4 : at])[0]]) == struct.unpack(">I", data[-16:-12])[0]
        assert raster.differing(x, x[0, 0]) == (x != x[0, 0]).any(2).sum()


@pytest.mark.parametrize("y", (-20, 0, 37))
def test_boxes_set_at_once_are_those_set_one_by_one(y):
    g = raster.Glyphs.load(None, 12)
    lines = ["", "  two  words", "\u00a0a\u3000b\u2009😀þ", "x" * 40, "\tend "]
    starts = [5, -9, 0, 3, 190]
    one, all_ = raster.canvas(200, 60, (250, 240, 230)), raster.canvas(200, 60, (250, 240, 230))
    for i, line in enumerate(lines):
        g.draw(one, line, starts[i], y + 14 * i, (1, 2, 3))
    g.draw_lines(all_, lines, starts, y, 14, (1, 2, 3))
    assert (one == all_).all()


def test_a_page_is_drawn_without_a_call_for_each_letter(monkeypatch):
    g = raster.Glyphs.load(None, 12)
    calls = []
    monkeypatch.setattr(raster.Glyphs, "draw", lambda *a: calls.append(a))
    x = raster.canvas(512, 512, (255, 255, 255))
    g.draw_lines(x, ["some words"] * 30, [26] * 30, 0, 14, (0, 0, 0))
    assert not calls and raster.differing(x, np.full(3, 255)) == 30 * 9 * 36


def test_images_as_rgb(spark):
    gray = raster.png(np.full((2, 3, 3), 7, np.uint8))
    df = spark.createDataFrame([(0, gray), (1, b"no image"), (2, None)], "i int, bytes binary")
    got = {r.i: r.x for r in df.select("i", raster.rgb("bytes").alias("x")).collect()}
    assert (got[0].width, got[0].height, bytes(got[0].pixels)) == (3, 2, b"\7" * 18)
    assert got[1].width is None and got[2].pixels is None
    pillow = pytest.importorskip("PIL.Image")
    import io

    out = io.BytesIO()
    pillow.new("L", (4, 5), 200).save(out, "JPEG")
    assert raster.read(out.getvalue()).shape == (5, 4, 3)


def test_outlines_fill_their_pixels():
    data = small_font()
    assert files.font_tables(data)[:2] == ([ord("A"), ord("g"), ord("á")], 1000) and files.line_units(data) == 1400
    g = raster.Glyphs.load(data, 10)
    share, x, y = g.mask("A")
    assert share[:10, :10].min() == 1 and share[10:].max() == 0 and (x, y) == (0, 0)
    share, x, y = g.mask("á")  # the square, 3 pixels to the right
    assert x == 3 and share[:10, :10].min() == 1
    share, x, y = g.mask("g")
    assert y == 10 and abs(share.sum() - 20) < 1.5
    page = raster.canvas(40, 30, (255, 255, 255))
    g.draw(page, "A Ag", 35, -5, (0, 0, 0))  # over the canvas's edges
    assert (page[:5, 35:40] == 0).all() and (page[5:] == 255).all()
    assert raster.Glyphs.load(b"broken", 10).outlines is None


def test_font_widths_wrap_lines(spark, tmp_path):
    (tmp_path / "small.TTF").write_bytes(small_font())
    (tmp_path / "broken.ttf").write_bytes(b"nothing")
    found = files.fonts(spark, [str(tmp_path)])
    rows = {r.path.rsplit("/", 1)[1]: r for r in found.collect()}
    m = pages.font_measure(rows["small.TTF"], 10)
    assert m.width("Ag") == 22 and m.line_height == 14 and [x for x, _ in pages.wrap("A g á", m, 30)] == ["A g", "á"]
    assert isinstance(pages.font_measure(rows["broken.ttf"], 10), pages.FixedWidth) and isinstance(pages.font_measure(None, 10), pages.FixedWidth)
    assert files.usable_fonts(found).count() == 1


def test_pages_are_drawn(spark, tmp_path):
    (tmp_path / "small.ttf").write_bytes(small_font())
    c = PageConfig(image_width=100, image_height=40, font_size=10, random_backgrounds=False, random_font_color=False, random_fonts=False, vertical_alignment="top")
    found = files.fonts(spark, [str(tmp_path)])
    path = found.first().path
    docs = spark.createDataFrame([(0, "A g A\nA")], "doc_id long, text string")
    measure = pages.font_measure(found.first(), 10)
    laid = pages.attributed(pages.laid_out(docs, c, measure), c)
    for drawn, full in ((pages.rendered(laid, c, found, path), True), (pages.rendered(laid, c), False)):
        image = raster.read(bytes(drawn.first().image.bytes))
        assert image.shape == (40, 100, 3) and (image[:, :5] == 255).all()
        if full:
            assert (image[:10, 5:15] == 0).all() and (image[:10, 15] == 255).all()
        assert (image < 255).any()
    own = pages.rendered(laid, c, draw=lambda text, top, more: f"{text}|{top}|{more['font_color']}".encode())
    assert bytes(own.first().image.bytes) == b"A g A\n\nA|0|black" or bytes(own.first().image.bytes).startswith(b"A g A")


def test_jobs_from_the_command_line(spark, tmp_path, caplog):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("One sentence. "), F.col("id").cast("string"), F.lit(" more á.")).alias("body"), F.lit("train").alias("split"))
    docs.write.partitionBy("split").parquet(str(tmp_path / "corpus"))
    (tmp_path / "fonts").mkdir()
    (tmp_path / "fonts" / "small.ttf").write_bytes(small_font())
    where = [f"dataset_path={tmp_path}/corpus", "text_column=body"]
    with caplog.at_level(logging.INFO):
        assert main(["pages", *where, f"output_path={tmp_path}/pages", f"font_dirs={tmp_path}/fonts", "max_entries=20", "show_sample=true"], spark) == 0
        assert "1 usable fonts" in caplog.text and "text of the first page" in caplog.text
        made = files.corpus(spark, f"{tmp_path}/pages")
        assert {r.split: r.n for r in made.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 16, "test": 2, "validation": 2}
        assert raster.read(bytes(made.first().image.bytes)).shape == (512, 512, 3) and made.first().font_path.endswith("small.ttf")
        assert main(["blocks", *where, f"output_path={tmp_path}/blocks", "max_length=16", "max_eval=3"], spark) == 0
        assert files.corpus(spark, f"{tmp_path}/blocks", "eval").count() == 3
    for bad in ([], ["nothing"], ["pages", "nope=1"], ["blocks", "seed=x"]):
        caplog.clear()
        assert main(bad, spark) == 1 and "usage" in caplog.text
    with pytest.raises(IndexError):
        main(["pages", *where, "max_entries=99"], spark)


def test_gold_pairs(spark, tmp_path):
    for folder, name, data in (("images", "b.jpg", b"2"), ("images", "a.jpg", b"1"), ("text", "x.txt", b" one \n"), ("text", "y.txt", b"two")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(data)
    assert main(["gold", f"image_dir={tmp_path}/images", f"text_dir={tmp_path}/text", f"output_dir={tmp_path}/out"], spark) == 0
    got = files.json_lines(spark, f"{tmp_path}/out/metadata").orderBy("file_name").collect()
    assert [tuple(r) for r in got] == [("a.jpg", "one"), ("b.jpg", "two")] and (tmp_path / "out" / "b.jpg").read_bytes() == b"2"
