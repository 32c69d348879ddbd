"""Pixels without an imaging library: PNG files out and in, and the outlines of TrueType glyphs filled into a canvas.

A canvas is an array (height, width, 3) of bytes. JPEG files are read where Pillow is installed, and are null elsewhere.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Parts that a pixel is cut into, each way, for the share of it that a glyph covers.
FINE = 4
#: By code point, whether a character is blank; all blank ones are below the last entry.
BLANK = np.array([chr(c).isspace() for c in range(0x3002)])


def canvas(width: int, height: int, background: tuple[int, int, int]) -> np.ndarray:
    out = np.empty((height, width, 3), np.uint8)
    out.reshape(height, -1)[:] = np.tile(np.array(background, np.uint8), width)
    return out


def repeats(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each run of equal rows, rows in the run)."""
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1)))
    return first, np.diff(np.append(first, len(rows)))


@lru_cache(4096)
def _same_rows(stride: int, n: int) -> tuple[bytes, int, int]:
    """n rows that are as the one above: (raw deflate blocks that refer to nothing before them, their Adler-32, bytes)."""
    raw = (b"\2" + bytes(stride)) * n
    c = zlib.compressobj(9, zlib.DEFLATED, -15)
    return c.compress(raw) + c.flush(zlib.Z_FULL_FLUSH), zlib.adler32(raw), len(raw)


def _compressed(rows: np.ndarray) -> bytes:
    """A zlib stream of rows filtered by the one above. Runs of equal rows come ready-made, so a page costs its different rows."""
    first, times = repeats(rows)
    stride = rows.shape[1]
    lines = np.empty((len(first), 1 + stride), np.uint8)
    lines[:, 0] = 2
    lines[0, 1:] = rows[0]
    np.subtract(rows[first[1:]], rows[first[1:] - 1], out=lines[1:, 1:])
    c = zlib.compressobj(1, zlib.DEFLATED, -15)
    out, check = [b"\x78\x01"], 1
    for line, n in zip(lines, times.tolist(), strict=True):
        out.append(c.compress(line))
        check = zlib.adler32(line, check)
        if n > 1:
            data, more, size = _same_rows(stride, n - 1)
            out += [c.flush(zlib.Z_FULL_FLUSH), data]
            low, high = check & 0xFFFF, check >> 16
            check = (low + (more & 0xFFFF) - 1) % 65521 | (high + (more >> 16) + size * (low - 1)) % 65521 << 16
    return b"".join([*out, c.flush(), struct.pack(">I", check)])


def png(pixels: np.ndarray, dpi: int = 72) -> bytes:
    """An RGB file with its resolution."""
    height, width, _ = pixels.shape

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    meter = round(dpi / 0.0254)
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"pHYs", struct.pack(">IIB", meter, meter, 1)) + chunk(b"IDAT", _compressed(pixels.reshape(height, -1))) + chunk(b"IEND", b"")


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """The bytes of each row, whose filters predict a byte from the one `step` before, above, or both."""
    rows = np.frombuffer(raw, np.uint8, height * (stride + 1)).reshape(height, stride + 1)
    if (rows[:, 0] == 2).all():
        none, step = bytes(stride), stride + 1
        new = np.array([raw[i + 1 : i + step] != none for i in range(0, height * step, step)], bool)
        lines = np.zeros((int(new.sum()) + 1, stride), np.uint8)
        np.cumsum(rows[new, 1:], axis=0, dtype=np.uint8, out=lines[1:])
        return lines[np.cumsum(new)]
    out = np.zeros((height + 1, stride + step), np.uint8)  # a row and a pixel of zeros before the first
    for y in range(height):
        kind, line, above = rows[y, 0], rows[y, 1:], out[y]
        now = out[y + 1]
        if kind == 0:
            now[step:] = line
        elif kind == 2:
            now[step:] = line + above[step:]
        elif kind == 1:
            for k in range(step):
                now[step + k :: step] = np.cumsum(line[k::step], dtype=np.uint8)
        elif kind in (3, 4):
            for x in range(stride):
                a, b, c = int(now[x]), int(above[x + step]), int(above[x])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                now[x + step] = (int(line[x]) + guess) & 255
        else:
            raise ValueError("unknown filter")
    return out[1:, step:]


def read_png(data: bytes) -> np.ndarray:
    """The pixels of a PNG file as RGB: gray levels three times, palettes looked up, transparency left out, 16 bits as the upper 8."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG file")
    at, body, palette, header = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + size
    width, height, depth, color, _, _, interlaced = header
    if interlaced:
        raise ValueError("interlaced files are not read")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    stride = -(-width * channels * depth // 8)
    rows = _unfiltered(zlib.decompress(b"".join(body), bufsize=max(1, height * (stride + 1))), height, stride, max(1, channels * depth // 8))
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        rows = np.packbits(bits, axis=2, bitorder="big")[:, :, 0] >> (8 - depth)
        if color == 0:
            rows = rows * (255 // ((1 << depth) - 1))
    pixels = rows[:, : width * channels].reshape(height, width, channels)
    if color == 3:
        return palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if channels < 3 else pixels[:, :, :3]


def read(data: bytes | None) -> np.ndarray | None:
    """RGB pixels of an image file; null for what can't be read."""
    if not data:
        return None
    try:
        if data[:8] == SIGNATURE:
            return np.ascontiguousarray(read_png(data))
        import io

        from PIL import Image

        with Image.open(io.BytesIO(data)) as image:
            return np.asarray(image.convert("RGB"))
    except (ImportError, OSError, ValueError, KeyError, TypeError, zlib.error, struct.error):
        return None


def rgb(image_bytes: Column | str) -> Column:
    """struct<width, height, pixels> of image files of any mode as RGB, row by row; nulls for what can't be read."""

    @F.pandas_udf("struct<width:int,height:int,pixels:binary>")
    def run(contents: pd.Series) -> pd.DataFrame:
        found = [read(c) for c in contents]
        rows = [(None, None, None) if x is None else (x.shape[1], x.shape[0], x.tobytes()) for x in found]
        return pd.DataFrame({"width": pd.array([r[0] for r in rows], "Int32"), "height": pd.array([r[1] for r in rows], "Int32"), "pixels": [r[2] for r in rows]})

    return run(image_bytes)


def differing(pixels: np.ndarray, color: np.ndarray) -> int:
    """How many pixels are not of a color."""
    first, times = repeats(pixels.reshape(len(pixels), -1))
    part = pixels[first]
    other = (part[:, :, 0] != color[0]) | (part[:, :, 1] != color[1]) | (part[:, :, 2] != color[2])
    return int(np.count_nonzero(other, axis=1) @ times)


def ink(image_bytes: Column | str, background: Column | str) -> Column:
    """struct<width, height, ink>: an image's size, and how many of its pixels differ from a background (struct r, g, b)."""

    @F.pandas_udf("struct<width:int,height:int,ink:long>")
    def run(contents: pd.Series, colors: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for data, color in zip(contents, colors[["r", "g", "b"]].to_numpy(), strict=True):
            x = read(data)
            rows.append((None, None, None) if x is None else (x.shape[1], x.shape[0], differing(x, color.astype(np.uint8))))
        return pd.DataFrame({"width": pd.array([r[0] for r in rows], "Int32"), "height": pd.array([r[1] for r in rows], "Int32"), "ink": pd.array([r[2] for r in rows], "Int64")})

    return run(image_bytes, background)


class Outlines:
    """The glyph table of a TrueType font."""

    def __init__(self, data: bytes):
        count = struct.unpack_from(">H", data, 4)[0]
        self.data = data
        self.at = {data[12 + 16 * i : 16 + 16 * i]: struct.unpack_from(">II", data, 20 + 16 * i)[0] for i in range(count)}
        self.wide = struct.unpack_from(">h", data, self.at[b"head"] + 50)[0]
        self.ascent = struct.unpack_from(">h", data, self.at[b"hhea"] + 4)[0]

    def _where(self, glyph: int) -> tuple[int, int]:
        loca = self.at[b"loca"]
        first, last = struct.unpack_from(">II", self.data, loca + 4 * glyph) if self.wide else (2 * x for x in struct.unpack_from(">HH", self.data, loca + 2 * glyph))
        return self.at[b"glyf"] + first, last - first

    def box(self, glyph: int) -> tuple[int, int, int, int]:
        """(least x, least y, greatest x, greatest y); zeros for a glyph without outlines."""
        at, size = self._where(glyph)
        return struct.unpack_from(">4h", self.data, at + 2) if size else (0, 0, 0, 0)

    def contours(self, glyph: int, depth: int = 0) -> list[np.ndarray]:
        """Closed polygons (x, y) in font units; curves as short lines."""
        at, size = self._where(glyph)
        if not size or depth > 8:
            return []
        n = struct.unpack_from(">h", self.data, at)[0]
        return self._parts(at + 10, depth) if n < 0 else [_flat(p, on) for p, on in self._points(at + 10, n)]

    def _points(self, at: int, n: int):
        ends = struct.unpack_from(f">{n}H", self.data, at)
        at += 2 * n
        at += 2 + struct.unpack_from(">H", self.data, at)[0]
        total, flags = (ends[-1] + 1 if n else 0), []
        while len(flags) < total:
            f = self.data[at]
            at += 1
            flags.append(f)
            if f & 8:
                flags += [f] * self.data[at]
                at += 1
        axes = []
        for short, same in ((2, 16), (4, 32)):
            now, values = 0, []
            for f in flags[:total]:
                if f & short:
                    now += self.data[at] if f & same else -self.data[at]
                    at += 1
                elif not f & same:
                    now += struct.unpack_from(">h", self.data, at)[0]
                    at += 2
                values.append(now)
            axes.append(values)
        points, on = np.array(axes, float).T, np.array([f & 1 for f in flags[:total]], bool)
        first = 0
        for e in ends:
            if e >= first:
                yield points[first : e + 1], on[first : e + 1]
            first = e + 1

    def _parts(self, at: int, depth: int) -> list[np.ndarray]:
        out, more = [], True
        while more:
            flags, glyph = struct.unpack_from(">HH", self.data, at)
            at += 4
            dx, dy = struct.unpack_from(">hh" if flags & 1 else ">bb", self.data, at)
            at += 4 if flags & 1 else 2
            m, k = np.eye(2), 1 if flags & 8 else 2 if flags & 64 else 4 if flags & 128 else 0
            if k:
                v = [x / 16384 for x in struct.unpack_from(f">{k}h", self.data, at)]
                at += 2 * k
                m = np.array([[v[0], 0], [0, v[0]]] if k == 1 else [[v[0], 0], [0, v[1]]] if k == 2 else [v[:2], v[2:]])
            shift = np.array([dx, dy], float) if flags & 2 else np.zeros(2)
            out += [p @ m + shift for p in self.contours(glyph, depth + 1)]
            more = bool(flags & 32)
        return out


def _flat(points: np.ndarray, on: np.ndarray, steps: int = 6) -> np.ndarray:
    """A contour of lines and quadratic curves as a polygon: between two points off the curve lies one on it."""
    full = []
    for p, a, q, b in zip(points, on, np.roll(points, -1, 0), np.roll(on, -1), strict=True):
        full.append((p, a))
        if not a and not b:
            full.append(((p + q) / 2, True))
    first = next((i for i, (_, a) in enumerate(full) if a), 0)
    full = full[first:] + full[:first]
    out = []
    for i, (p, a) in enumerate(full):
        if a:
            out.append(p)
        else:
            start, end = full[i - 1][0], full[(i + 1) % len(full)][0]
            for t in np.linspace(0, 1, steps + 1)[1:-1]:
                out.append((1 - t) ** 2 * start + 2 * t * (1 - t) * p + t**2 * end)
    return np.array(out)


def covered(contours: list[np.ndarray], width: int, height: int) -> np.ndarray:
    """The share of each pixel inside polygons (x to the right, y down), by their winding number at FINE x FINE places of it."""
    wind = np.zeros((height * FINE, width * FINE + 1), np.int32)
    for p in contours:
        for (x0, y0), (x1, y1) in zip(p * FINE, np.roll(p, -1, 0) * FINE, strict=True):
            if y0 == y1:
                continue
            sign, (ax, ay, bx, by) = (1, (x0, y0, x1, y1)) if y0 < y1 else (-1, (x1, y1, x0, y0))
            rows = np.arange(max(0, int(np.ceil(ay - 0.5))), min(len(wind), int(np.ceil(by - 0.5))))
            if len(rows):
                x = np.ceil(ax + (rows + 0.5 - ay) * (bx - ax) / (by - ay) - 0.5).astype(int)
                np.add.at(wind, (rows, np.clip(x, 0, wind.shape[1] - 1)), sign)
    inside = np.cumsum(wind, axis=1)[:, :-1] != 0
    return inside.reshape(height, FINE, width, FINE).mean((1, 3))


class Glyphs:
    """What a font draws at a size: advances, line height, and a mask for each character."""

    def __init__(self, data: bytes | None, size: int):
        self.data, self.size, self.masks = data, size, {}
        self._open()

    @classmethod
    def load(cls, data: bytes | None, size: int) -> Glyphs:
        """The font, or the default (boxes) where its file can't be used."""
        try:
            return cls(data, size)
        except (KeyError, struct.error, ValueError, IndexError):
            return cls(None, size)

    def __getstate__(self):
        return self.data, self.size

    def __setstate__(self, state):
        (self.data, self.size), self.masks = state, {}
        self._open()

    def _open(self) -> None:
        from pagemill.operators.pages import font_measure
        from pagemill.sources.files import font_tables, glyph_ids, line_units

        self.outlines = None
        row = None
        if self.data is not None:
            points, units, advances = font_tables(self.data)
            if not points:
                raise ValueError("no glyphs")
            row = {"codepoints": points, "units_per_em": units, "advances": advances, "line_units": line_units(self.data)}
            self.outlines, self.ids, self.scale = Outlines(self.data), glyph_ids(self.data), self.size / units
        self._measure = font_measure(row, self.size)
        self.base = round(self.outlines.ascent * self.scale) if self.outlines else self.size

    def measure(self):
        return self._measure

    def mask(self, character: str) -> tuple[np.ndarray, int, int]:
        """(covered shares, x of their left edge, y of their upper edge below the line's top)."""
        if character not in self.masks:
            if self.outlines is None:
                wide = max(1, self._measure.width("x") - 1)
                self.masks[character] = (np.ones((max(1, self.size // 2), wide)), 0, self.size // 2)
            else:
                glyph = self.ids.get(ord(character), 0)
                left, low, right, high = (v * self.scale for v in self.outlines.box(glyph))
                x0, y0 = int(np.floor(left)), int(np.floor(-high))
                flip = [np.column_stack([p[:, 0] * self.scale - x0, -p[:, 1] * self.scale - y0]) for p in self.outlines.contours(glyph)]
                self.masks[character] = (covered(flip, int(np.ceil(right)) - x0 + 1, int(np.ceil(-low)) - y0 + 1), x0, self.base + y0)
        return self.masks[character]

    def draw_lines(self, pixels: np.ndarray, lines: list[str], starts: list[int], y: int, advance: int, ink: tuple[int, int, int]) -> None:
        """Each line from its start on, the first one's top at y. Boxes are set all at once."""
        if self.outlines is not None:
            for i, (line, x) in enumerate(zip(lines, starts, strict=True)):
                self.draw(pixels, line, x, y + i * advance, ink)
            return
        share, dx, dy = self.mask("x")
        code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        many = np.array([len(x) for x in lines])
        row = np.repeat(np.arange(len(lines)), many)
        left = np.arange(len(code)) - np.repeat(np.cumsum(many) - many, many)
        left = left * self._measure.advance + np.asarray(starts)[row] + dx
        seen = ~BLANK[np.minimum(code, len(BLANK) - 1)]
        row, left = row[seen], left[seen]
        cover = np.zeros((len(lines), pixels.shape[1]), bool)
        for k in range(share.shape[1]):
            inside = (left + k >= 0) & (left + k < cover.shape[1])
            cover[row[inside], left[inside] + k] = True
        full, color = np.repeat(cover, 3, axis=1), np.tile(np.array(ink, np.uint8), cover.shape[1])
        rows = pixels.reshape(len(pixels), -1)
        for k in range(share.shape[0]):
            tall = np.arange(len(lines)) * advance + (y + dy + k)
            inside = (tall >= 0) & (tall < len(rows))
            rows[tall[inside]] = np.where(full[inside], color, rows[tall[inside]])

    def draw(self, pixels: np.ndarray, line: str, x: int, y: int, ink: tuple[int, int, int]) -> None:
        """One line from x on, its top at y; what lies outside the canvas is left out."""
        at = float(x)
        for c in line:
            if not c.isspace():
                share, dx, dy = self.mask(c)
                left, top = int(round(at)) + dx, y + dy
                x0, y0, x1, y1 = max(left, 0), max(top, 0), min(left + share.shape[1], pixels.shape[1]), min(top + share.shape[0], pixels.shape[0])
                if x0 < x1 and y0 < y1:
                    a = share[y0 - top : y1 - top, x0 - left : x1 - left, None]
                    part = pixels[y0:y1, x0:x1]
                    part[:] = np.rint(part * (1 - a) + np.array(ink) * a).astype(np.uint8)
            at += self._measure.width(c)
