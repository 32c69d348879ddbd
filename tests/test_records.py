import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.operators import order, packing, records
from pagemill.sources import files


def test_packing_is_a_prefix_of_the_stream(spark):
    docs = [[1, 2, 3], [], [4] * 11, [5], [6, 7]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, ids array<int>")
    stream = [x for d in docs for x in [*d, 0]]
    for length in (1, 4, 11, len(stream), 100):
        got = [r.input_ids for r in packing.packed(df, length).orderBy("block").collect()]
        assert got == [stream[i : i + length] for i in range(0, len(stream) - length + 1, length)]


def test_split_sizes_and_stability(spark):
    for n in (0, 1, 2, 7, 50):
        df = spark.range(n).withColumnRenamed("id", "doc_id")
        a = {r.doc_id: r.split for r in order.three_way(df, "doc_id").collect()}
        b = {r.doc_id: r.split for r in order.three_way(df.repartition(5), "doc_id").collect()}
        held, test = order.split_sizes(n)
        assert a == b and len(a) == n
        assert sum(v == "train" for v in a.values()) == n - held and sum(v == "test" for v in a.values()) == test


def test_heads(spark):
    df = spark.range(5)
    assert [r.id for r in order.head(df, 3, "id").collect()] == [0, 1, 2]
    assert order.head(df, 0, "id").count() == 5 and order.head(df, 9, "id").count() == 5
    with pytest.raises(IndexError):
        order.head(df, 9, "id", clamped=False)


def test_prefix_sum(spark):
    df = spark.range(5000).withColumn("n", F.col("id") % 7)
    got = {r.id: r.o for r in order.prefix_sum(df, "id", "n", "o", 64).collect()}
    total = 0
    for i in range(5000):
        assert got[i] == total
        total += i % 7


def test_zip_and_stems(spark):
    a = spark.createDataFrame([("x/b.jpg",), ("x/a.jpg",)], "image string")
    b = spark.createDataFrame([("y/a.txt",), ("y/c.txt",)], "script string")
    assert [(r.image, r.script) for r in records.positional_zip(a, b, "image", "script").orderBy("pos").collect()] == [("x/a.jpg", "y/a.txt"), ("x/b.jpg", "y/c.txt")]
    assert {(r.stem, r.matched) for r in records.stem_pairs(a, b, "image", "script").collect()} == {("a", True), ("b", False), ("c", False)}
    with pytest.raises(ValueError):
        records.positional_zip(a, b.limit(1), "image", "script")


def test_rates_and_steps(spark):
    row = spark.range(1).select(records.rate(F.lit(4.0), F.lit(0.0)).alias("a"), records.average_rate(F.lit(4.0), F.lit(0.0)).alias("b"), records.rate(F.lit(4.0), F.lit(2.0)).alias("c")).first()
    assert (row.a, row.b, row.c) == (None, 0.0, 2.0)
    assert records.tokens_per_step(8, 4, 512) == 16384 and records.steps(100, 8, 4, 2) == 6


def test_prefixes(spark):
    df = spark.createDataFrame([("model.a",), ("lm_head.weight",)], "k string")
    assert [r[0] for r in df.select(records.strip_prefix(F.col("k"))).collect()] == ["a", "lm_head.weight"]


def test_text_and_json_files(spark, tmp_path):
    (tmp_path / "b.txt").write_bytes("  þorn\r\nx \n".encode())
    (tmp_path / "a.txt").write_text("y")
    (tmp_path / "c.md").write_text("no")
    got = files.texts(spark, str(tmp_path)).orderBy("file_name")
    assert [tuple(r) for r in got.collect()] == [("a.txt", "y"), ("b.txt", "þorn\nx")]
    files.save_json_lines(got, str(tmp_path / "out"), one_file=True)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert files.json_lines(spark, str(tmp_path / "out")).orderBy("file_name").collect() == got.collect()
    split = got.withColumn("split", F.when(F.col("file_name") == "a.txt", "train").otherwise("test"))
    files.save_splits(split, str(tmp_path / "split"))
    assert files.corpus(spark, str(tmp_path / "split"), split="train").count() == 1


def test_copy_is_idempotent(spark, tmp_path):
    (tmp_path / "from").mkdir()
    for name in ("a.jpg", "b.jpg"):
        (tmp_path / "from" / name).write_bytes(name.encode())
    (tmp_path / "to").mkdir()
    (tmp_path / "to" / "a.jpg").write_bytes(b"mine")
    listing = files.images(spark, str(tmp_path / "from"))
    for want in ([("a.jpg", False), ("b.jpg", True)], [("a.jpg", False), ("b.jpg", False)]):
        assert [tuple(r) for r in files.copy_missing(spark, listing, str(tmp_path / "to")).orderBy("file_name").collect()] == want
    assert (tmp_path / "to" / "b.jpg").read_bytes() == b"b.jpg" and (tmp_path / "to" / "a.jpg").read_bytes() == b"mine"


def test_image_files(spark, tmp_path):
    for name in ("a.jpg", "b.jpg", "c.png"):
        (tmp_path / name).write_bytes(name.encode())
    got = files.images(spark, str(tmp_path)).orderBy("file_name").collect()
    assert [(r.file_name, bytes(r.bytes)) for r in got] == [("a.jpg", b"a.jpg"), ("b.jpg", b"b.jpg")] and got[0].path.endswith("/a.jpg")


def test_metrics_and_samples(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", "x"), (2, "test", "y")], "step long, split string, text string")
    for _ in range(2):
        files.append_metrics(df, str(tmp_path / "metrics"))
    assert files.corpus(spark, str(tmp_path / "metrics")).count() == 4
    assert files.sample(df) == ["x"] and files.sample(df, "validation") == []


def test_fonts(spark):
    found = files.fonts(spark, ["/usr/share/fonts", "/no/such/folder"]).collect()
    for r in found:
        assert len(r.codepoints) == len(r.advances)
    assert files.font_tables(b"nonsense") == ([], 0, [])
    df = spark.createDataFrame([([ord("á")],), ([ord("a")],)], "cps array<int>")
    assert [r[0] for r in df.select(files.covers("cps")).collect()] == [True, False]
    assert [r[0] for r in df.select(files.covers("cps", strict=True)).collect()] == [False, False]


def test_image_headers():
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (3).to_bytes(4, "big") + (2).to_bytes(4, "big") + b"\x08\x02"
    assert files.image_header(png) == (3, 2, 3)
    jpg = b"\xff\xd8\xff\xc0\x00\x11\x08\x00\x02\x00\x05\x03" + b"\0" * 10
    assert files.image_header(jpg) == (5, 2, 3)
    assert files.image_header(b"") == (None, None, None)


@given(st.text(max_size=30))
@settings(max_examples=10, deadline=None)
def test_decoding(spark, text):
    text = text.replace("\0", "")
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(packing.decoded(packing.with_eos(packing.codepoints("t")))).first()[0] == text
