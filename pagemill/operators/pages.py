"""Chunks of whole sentences, and their layout on pages of fixed size."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.config import PageConfig
from pagemill.functions.pytext import strip
from pagemill.operators.order import color

CHUNKS = "array<string>"


def pieces(text: str) -> list[str]:
    """Sentences: a blank after . ! ? ends one, and so does a bar, which goes."""
    return [p for p in (q.strip() for q in re.split(r"(?<=[.!?]) |\|", text)) if p]


def chunks(text: str, most: int) -> list[str]:
    """Sentences joined greedily up to `most` characters. A short text stays as it is; a long sentence is never broken."""
    if len(text) <= most:
        return [text]
    out, now = [], ""
    for p in pieces(text):
        if now and len(now) + 1 + len(p) > most:
            out.append(now)
            now = p
        elif len(now) + 1 + len(p) > most:
            now = p
        else:
            now = f"{now} {p}" if now else p
    return [*out, now] if now else out


def chunk_column(text: Column | str, most: int) -> Column:
    """array<string> of chunks, by an Arrow function."""

    @F.pandas_udf(CHUNKS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else chunks(t.strip(), most))

    return run(text)


def chunk_fold(text: Column | str, most: int) -> Column:
    """The same by built-in functions; slower on long texts, and an independent check."""
    t = strip(text)
    cut = F.split(F.replace(F.replace(F.replace(t, F.lit("! "), F.lit("!|")), F.lit("? "), F.lit("?|")), F.lit(". "), F.lit(".|")), r"\|", -1)
    each = F.filter(F.transform(cut, strip), lambda p: p != "")
    start = F.struct(F.array().cast(CHUNKS).alias("out"), F.lit("").alias("now"))

    def step(a: Column, p: Column) -> Column:
        over = F.length(a["now"]) + F.length(p) + 1 > most
        flush = F.when(over & (a["now"] != ""), F.concat(a["out"], F.array(a["now"]))).otherwise(a["out"])
        return F.struct(flush.alias("out"), F.when(over | (a["now"] == ""), p).otherwise(F.concat_ws(" ", a["now"], p)).alias("now"))

    done = F.aggregate(each, start, step, lambda a: F.when(a["now"] != "", F.concat(a["out"], F.array(a["now"]))).otherwise(a["out"]))
    return F.when(F.length(t) <= most, F.array(t)).otherwise(done)


#: Rows that a function below puts out at once, and pages that are drawn at once.
BATCH, DRAWN = 4096, 256


def exploded(df: DataFrame, text: str, each: Callable[[str], Iterator[tuple]], added: list[T.StructField]) -> DataFrame:
    """For each row with a text, a row for each of each(text): the other columns, its number, and what it holds. The function
    runs once for a row, and rows go out in batches, however many one text gives."""
    keys = [c for c in df.columns if c != text]
    schema = T.StructType([df.schema[k] for k in keys] + added)
    kinds = [f.dataType.simpleString() for f in added]
    arrow = {"int": pa.int32(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = ((i, n, *x) for i, t in enumerate(b.column(len(keys)).to_pylist()) for n, x in enumerate(each(t)))
            while part := list(itertools.islice(rows, BATCH)):
                at, *found = zip(*part, strict=True)
                take = pa.array(at, pa.int32())
                arrays = [b.column(k).take(take) for k in range(len(keys))] + [pa.array(x, arrow[k]) for x, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [*keys, *(f.name for f in added)])

    return df.where(F.col(text).isNotNull()).select(*keys, text).mapInArrow(run, schema)


def _number(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType())


def _text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def chunked(docs: DataFrame, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, chunk_ix, chunk; documents without text give none."""
    return exploded(docs.select(key, text), text, lambda t: ((c,) for c in chunks(t.strip(), most)), [_number("chunk_ix"), _text("chunk")])


def chunk_counts(docs: DataFrame, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n: how many chunks a document has."""
    return exploded(docs.select(key, text), text, lambda t: [(len(chunks(t.strip(), most)),)], [_number("__n"), _number("n")]).drop("__n")


class FixedWidth:
    """Every character advances by the same width; lines have one height."""

    def __init__(self, advance: int = 7, height: int = 12):
        self.advance, self.line_height = advance, height

    def width(self, text: str) -> int:
        return len(text) * self.advance


class TableWidth:
    """Advances by character, as read from a font; what the font lacks advances by its default."""

    def __init__(self, advances: dict[int, float], default: float, height: int):
        self.advances, self.default, self.line_height = advances, default, height

    @classmethod
    def of_font(cls, font, size: int) -> TableWidth:
        """From a row of sources.files.fonts, at a size in pixels. A font without glyphs (one that can't be read) gives nothing."""
        scale = size / font["units_per_em"]
        advances = {c: a * scale for c, a in zip(font["codepoints"], font["advances"], strict=True)}
        height = font["line_units"] or font["units_per_em"]
        return cls(advances, advances.get(ord("x"), size / 2), max(1, round(height * scale)))

    def width(self, text: str) -> float:
        return sum(self.advances.get(ord(c), self.default) for c in text)


def font_measure(font, size: int):
    """Widths from a font's row, or fixed ones where there is no such font or it can't be read."""
    if font is None or not font["codepoints"] or not font["units_per_em"]:
        return FixedWidth(max(1, round(size * 0.6)), size)
    return TableWidth.of_font(font, size)


def wrap(text: str, measure, most: float, tab: int = 4) -> Iterator[tuple[str, int]]:
    """(line, place in text after its last word) of a text wrapped to a width.

    Each line feed ends a paragraph. A blank paragraph is one empty line; any other is followed by one unless it is the last.
    A paragraph's indentation, tabs as blanks, stands on its first line; other runs of blanks become one.
    A word wider than the line has a line of its own. Lines are made as they are asked for; widths add up.
    """
    at, stop_at, blank = 0, len(text), measure.width(" ")
    while at <= stop_at:
        over = text.find("\n", at)
        last = over < 0
        part = text[at:] if last else text[at:over]
        bare = part.lstrip()
        if not bare:
            yield "", at + len(part)
        else:
            start = len(part) - len(bare)
            indent = part[:start].replace("\t", " " * tab)
            line, end, wide = "", at, 0.0
            for m in re.finditer(r"\S+", bare):
                word = m[0]
                own = measure.width(word)
                if line and wide + blank + own > most:
                    yield line, end
                    line = word  # indentation stays with the paragraph's first line
                    wide = own
                elif line:
                    line = f"{line} {word}"
                    wide += blank + own
                else:
                    line = indent + word
                    wide = measure.width(indent) + own
                end = at + start + m.end()
            yield line, end
            if not last:
                yield "", at + len(part)
        at += len(part) + 1


def fitting(lines: int, height: int, line_height: int, align: str) -> tuple[int, int, int]:
    """(first line's y, line advance, lines that fit) on a page of the given height. Of more lines than fit, any number gives the same."""
    advance = line_height + int(line_height * 0.2)
    total = lines * advance - int(line_height * 0.2)
    top = 0 if align == "top" else max(0, height - total) if align == "bottom" else max(0, (height - total) // 2)
    return top, advance, lines if total <= height else max(0, (height - line_height) // advance + 1)


def pages(text: str, measure, width: int, height: int, align: str = "top", tab: int = 4, carry: str = "length") -> Iterator[tuple[str, int, int]]:
    """(text on the page, y of its first line, lines) page by page.

    carry="length" goes on after as many characters as the page shows, which repeats or loses text where blanks were
    collapsed or lines added, and ends at a page that shows nothing; carry="source" goes on after the last word shown, leaves out
    blank lines before a page, and loses nothing. Where not even one line fits a page, nothing is shown.
    """
    most = fitting(1 << 30, height, measure.line_height, "top")[2] + 1
    rest = text
    while rest:
        # one line more than fits tells that there is more
        lines = list(itertools.islice(wrap(rest, measure, width, tab), most))
        top, _, fit = fitting(len(lines), height, measure.line_height, align)
        shown = lines[:fit]
        while shown and not shown[-1][0].strip():
            shown.pop()
        if not shown:
            bare = rest.lstrip()
            # at its start a text may have more blank lines than a page has
            if carry == "length" or not fit or bare == rest:
                return
            rest = bare
            continue
        page = "\n".join(line for line, _ in shown)
        yield page, top, len(shown)
        rest = rest[len(page) if carry == "length" else shown[-1][1] :].lstrip()


def geometry(c: PageConfig) -> dict[str, int]:
    """Pixel sizes at the page's resolution; fractions are cut off."""
    scale = c.image_dpi / 72
    width, height = int(c.image_width * scale), int(c.image_height * scale)
    inner = int(width * c.max_width_ratio)
    return {"width": width, "height": height, "font_size": int(c.font_size * scale), "inner_width": inner, "margin": (width - inner) // 2}


def line_x(align: str, width: int, margin: int, line_width: float) -> float:
    """Where a line starts."""
    return margin if align == "left" else width - margin - line_width if align == "right" else (width - line_width) // 2


def paginated(chunks_: DataFrame, c: PageConfig, measure=None, carry: str = "length") -> DataFrame:
    """chunks (.., chunk_ix, chunk) -> the same keys, page_ix, text, top, lines. One narrow stage."""
    g, measure = geometry(c), measure or FixedWidth()
    laid = lambda t: pages(t, measure, g["inner_width"], g["height"], c.vertical_alignment, c.tab_width, carry)
    return exploded(chunks_, "chunk", laid, [_number("page_ix"), _text("text"), _number("top"), _number("lines")])


def laid_out(docs: DataFrame, c: PageConfig, measure=None, carry: str = "length", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks and pages of documents in one pass: key, chunk_ix, page_ix, text, top, lines."""
    g, measure = geometry(c), measure or FixedWidth()

    def each(t: str) -> Iterator[tuple]:
        for k, chunk in enumerate(chunks(t.strip(), c.max_text_length)):
            for n, page in enumerate(pages(chunk, measure, g["inner_width"], g["height"], c.vertical_alignment, c.tab_width, carry)):
                yield k, n, *page

    found = exploded(docs.select(key, text), text, each, [_number("__n"), _number("chunk_ix"), _number("page_ix"), _text("__t"), _number("top"), _number("lines")])
    return found.select(key, "chunk_ix", "page_ix", F.col("__t").alias("text"), "top", "lines")


def wrapped(chunks_: DataFrame, width: int, measure=None, tab: int = 4) -> DataFrame:
    """The same keys, line_ix, line."""
    measure = measure or FixedWidth()
    return exploded(chunks_, "chunk", lambda t: ((line,) for line, _ in wrap(t, measure, width, tab)), [_number("line_ix"), _text("line")])


#: The colors that text may have, and the ranges of random backgrounds.
FONT_COLORS = ("black", "darkblue", "darkred", "darkgreen", "brown")
BACKGROUND = {"r": (200, 255), "g": (180, 255), "b": (150, 255)}
#: Red, green and blue of the color names in use.
NAMED_COLORS = {"white": (255, 255, 255), "black": (0, 0, 0), "darkblue": (0, 0, 139), "darkred": (139, 0, 0), "darkgreen": (0, 100, 0), "brown": (165, 42, 42), "lightyellow": (255, 255, 224), "lightgray": (211, 211, 211)}


def attributed(pages_: DataFrame, c: PageConfig, fonts: tuple[str, ...] = (), key: str = "doc_id") -> DataFrame:
    """Adds a page's attributes. What is random depends on the seed and the page's key alone, so neither the partitioning nor a
    rerun changes it; a run has one font color, each page its background and font. Sizes are those at the page's resolution."""
    ident = [F.lit(str(c.seed)), F.col(key), F.col("chunk_ix"), F.col("page_ix")]
    g = geometry(c)
    if c.random_backgrounds:
        bg = F.struct(*(color(*BACKGROUND[x], *ident, F.lit(x)).alias(x) for x in "rgb"))
    else:
        bg = F.struct(*(F.lit(v).alias(x) for x, v in zip("rgb", NAMED_COLORS[c.bg_color], strict=True)))
    ordered = sorted(fonts)
    font = F.element_at(F.array(*map(F.lit, ordered)), color(1, len(ordered), *ident, F.lit("font"))) if c.random_fonts and ordered else F.lit(c.font_path)
    ink = F.element_at(F.array(*map(F.lit, FONT_COLORS)), color(1, len(FONT_COLORS), F.lit(str(c.seed)), F.lit("color"))) if c.random_font_color else F.lit(c.font_color)
    constants = {"font_size": g["font_size"], "image_width": g["width"], "image_height": g["height"], "image_dpi": c.image_dpi, "text_vertical_alignment": c.vertical_alignment, "text_horizontal_alignment": c.horizontal_alignment}
    return pages_.select("*", font.alias("font_path"), bg.alias("bg_color"), ink.alias("font_color"), *(F.lit(v).alias(k) for k, v in constants.items()))


def rendered(pages_: DataFrame, c: PageConfig, fonts: DataFrame | None = None, font: str | None = None, draw: Callable | None = None) -> DataFrame:
    """Adds image (bytes, path): each page of `attributed` as a PNG of its pixel size, its background, and its lines in its
    color where `fitting` and `line_x` put them.

    Glyphs are the outlines of a TrueType font: `font` names one of `fonts` (sources.files.fonts; its bytes are sent to the tasks).
    Without one, or for a font that can't be read, letters are boxes of a fixed width, so that places and colors still hold.
    `draw` (from text, y, attributes to an encoded image) takes the place of this renderer.
    """
    from pagemill.sources import raster

    # what a Python worker holds of files at once
    pages_.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(DRAWN))
    g = geometry(c)
    found = None
    if fonts is not None and font is not None:
        found = fonts.where(F.col("path") == font).first()
    shapes = raster.Glyphs.load(bytes(found["content"]) if found and found["codepoints"] else None, g["font_size"])
    held = pages_.sparkSession.sparkContext.broadcast(shapes)

    def page(text: str, top: int, background, ink: str) -> bytes:
        if draw is not None:
            return draw(text, top, {"bg_color": tuple(background.values()), "font_color": ink})
        glyphs = held.value
        measure = glyphs.measure()
        advance = fitting(1, g["height"], measure.line_height, "top")[1]
        canvas = raster.canvas(g["width"], g["height"], tuple(background[x] for x in "rgb"))
        lines = text.split("\n")
        starts = [int(line_x(c.horizontal_alignment, g["width"], g["margin"], measure.width(line))) for line in lines]
        glyphs.draw_lines(canvas, lines, starts, top, advance, NAMED_COLORS[ink])
        return raster.png(canvas, c.image_dpi)

    @F.pandas_udf("binary")
    def run(texts: pd.Series, tops: pd.Series, backgrounds: pd.DataFrame, inks: pd.Series) -> pd.Series:
        return pd.Series([page(t, int(y), b, k) for t, y, b, k in zip(texts, tops, backgrounds.to_dict("records"), inks, strict=True)])

    image = run("text", "top", "bg_color", "font_color")
    return pages_.withColumn("image", F.struct(image.alias("bytes"), F.lit(None).cast("string").alias("path")))
