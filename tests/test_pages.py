import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.config import GoldConfig, PageConfig, from_arguments
from pagemill.operators import pages

TEXT = st.text(alphabet=st.sampled_from(list("ab .!?|\n\tþ ")), max_size=200)


@given(TEXT, st.integers(5, 60))
@settings(max_examples=300, deadline=None)
def test_chunks_keep_content_and_are_greedy(text, most):
    text = text.strip()
    found = pages.chunks(text, most)
    if len(text) <= most:
        assert found == [text]
        return
    flat = "".join("".join(found).split())
    assert flat == "".join("".join(pages.pieces(text)).split())
    for a, b in zip(found, found[1:]):
        first = pages.pieces(b)[0] if pages.pieces(b) else b
        assert len(a) + 1 + len(first) > most
    assert all(len(c) <= most or len(pages.pieces(c)) == 1 for c in found)


@pytest.mark.parametrize(
    ("text", "most", "want"),
    [
        ("", 5, [""]),
        ("|||||||", 3, []),
        ("One. Two. Three.", 9, ["One. Two.", "Three."]),
        ("One.\nTwo. Three", 10, ["One.\nTwo.", "Three"]),
        ("a|b|c|d", 3, ["a b", "c d"]),
        ("longlonglong. x", 4, ["longlonglong.", "x"]),
        ("ab. cd", 5, ["ab.", "cd"]),
        ("ab. cdef", 6, ["ab.", "cdef"]),
    ],
)
def test_chunk_cases(text, most, want):
    assert pages.chunks(text, most) == want


@given(TEXT)
@settings(max_examples=200, deadline=None)
def test_source_carry_loses_nothing(text):
    m = pages.FixedWidth(7, 12)
    shown = [p for p, _, _ in pages.pages(text, m, 70, 40, carry="source")]
    assert " ".join(shown).split() == text.split()


@pytest.mark.parametrize("text", ["\n\n\n?", "\n" * 50 + "a b", " \n\t\n a\n\n\n\n\nb", "\n\n\n"])
def test_source_carry_passes_blank_pages(text):
    m = pages.FixedWidth(7, 12)
    shown = [p for p, _, _ in pages.pages(text, m, 70, 40, carry="source")]
    assert " ".join(shown).split() == text.split()
    assert list(pages.pages(text, m, 70, 5, carry="source")) == []  # no line fits


def test_length_carry_ends_at_a_blank_page():
    m = pages.FixedWidth(7, 12)
    assert list(pages.pages("\n\n\n?", m, 70, 40)) == []


@given(TEXT, st.integers(0, 90))
@settings(max_examples=300, deadline=None)
def test_wrap_against_words_one_by_one(text, most):
    """The lines made by measuring each longer line as a whole."""
    m, want = pages.TableWidth({ord("a"): 3.0, ord("b"): 7.0, 32: 2.0}, 5.0, 10), []
    paragraphs = text.split("\n")
    for k, paragraph in enumerate(paragraphs):
        if not paragraph.strip():
            want.append("")
            continue
        bare = paragraph.lstrip()
        indent, line = paragraph[: len(paragraph) - len(bare)].replace("\t", "    "), ""
        for word in bare.split():
            longer = f"{line} {word}" if line else indent + word
            if line and m.width(longer) > most:
                want.append(line)
                longer = word
            line = longer
        want += [line] if k == len(paragraphs) - 1 else [line, ""]
    assert [x for x, _ in pages.wrap(text, m, most)] == want


@given(TEXT, st.sampled_from(["top", "bottom", "center"]))
@settings(max_examples=200, deadline=None)
def test_pages_end_and_fit(text, align):
    m = pages.FixedWidth(7, 12)
    for page, top, lines in pages.pages(text, m, 70, 60, align):
        assert page and top >= 0 and lines * 14 - 2 <= 60
        assert all(m.width(x) <= 70 or len(x.split()) == 1 for x in page.split("\n"))


def test_wrap_cases():
    m = pages.FixedWidth(1, 1)
    lines = lambda t, w: [x for x, _ in pages.wrap(t, m, w)]
    assert lines("a\nb", 10) == ["a", "", "b"]
    assert lines("  a  b", 10) == ["  a b"]
    assert lines("\ta b", 5) == ["    a", "b"]
    assert lines("toolong x", 3) == ["toolong", "x"]
    assert lines("", 3) == [""]
    assert lines("\n\n", 3) == ["", "", ""]


def test_fitting_closed_form():
    for n in range(0, 40):
        for height in (10, 12, 40, 100):
            top, advance, fit = pages.fitting(n, height, 12, "top")
            assert fit == sum(1 for i in range(n) if top + i * advance + 12 <= height) or (n and fit == max(0, (height - 12) // advance + 1))


def test_page_too_short_for_a_line():
    assert list(pages.pages("abc", pages.FixedWidth(7, 12), 70, 5)) == []


def test_defaults_are_those_of_the_data_set():
    c = PageConfig()
    assert (c.vertical_alignment, c.random_fonts, c.max_entries, c.horizontal_alignment) == ("center", True, 400, "left")


def test_configuration():
    assert from_arguments(PageConfig, ["image_dpi=144", "random_fonts=true", "max_width_ratio=0.5"]).image_dpi == 144
    assert pages.geometry(PageConfig(image_dpi=144)) == {"width": 1024, "height": 1024, "font_size": 24, "inner_width": 921, "margin": 51}
    for bad in (["nope=1"], ["image_dpi=x"], ["image_dpi"], ["random_fonts=maybe"]):
        with pytest.raises(TypeError):
            from_arguments(PageConfig, bad)
    assert from_arguments(GoldConfig, []).text_dir == "text"


def test_functions_run_once_for_a_row(spark):
    df = spark.createDataFrame([(1, "One two. Three four. " * 30)], "doc_id long, text string")
    c = PageConfig(max_text_length=100, image_width=60, image_height=40)
    one, two = pages.laid_out(df, c), pages.paginated(pages.chunked(df, 100), c)
    for laid, runs in ((one, 1), (two, 2)):
        plan = laid._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow ") == runs and "ArrowEvalPython" not in plan
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(*one.columns).collect()))


def test_many_rows_of_one_text_go_out_in_batches(spark, monkeypatch):
    monkeypatch.setattr(pages, "BATCH", 3)
    df = spark.createDataFrame([(1, "a|b|c|d|e|f|g"), (2, None), (3, ""), (4, "x")], "doc_id long, text string")
    got = sorted(map(tuple, pages.chunked(df, 1).collect()))
    assert got == [(1, i, x) for i, x in enumerate("abcdefg")] + [(3, 0, ""), (4, 0, "x")]


def test_spark_chunks_agree(spark):
    rows = [(i, t) for i, t in enumerate(["", None, " a. b! c? d|e ", "x" * 50, "One. Two. Three. " * 5, "\t\n"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    one = pages.chunked(df, 10).collect()
    two = df.where("text is not null").select("doc_id", F.posexplode(pages.chunk_fold("text", 10)).alias("chunk_ix", "chunk")).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_attributes_ignore_partitioning(spark):
    df = spark.range(40).selectExpr("id as doc_id", "0 as chunk_ix", "0 as page_ix")
    a = pages.attributed(df, PageConfig(random_fonts=True), ("b", "a")).collect()
    b = pages.attributed(df.repartition(7), PageConfig(random_fonts=True), ("a", "b")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert {r.font_path for r in a} == {"a", "b"} and len({r.font_color for r in a}) == 1
    assert all(200 <= r.bg_color.r <= 255 and 180 <= r.bg_color.g <= 255 and 150 <= r.bg_color.b <= 255 for r in a)
