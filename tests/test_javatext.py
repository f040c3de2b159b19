from weblattice.functions import half_up, java_split, text_lines
from weblattice.operators.text import format_pairs, tokens, word_count


def _split(spark, values, sep):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(java_split("s", sep)).collect()]


def test_space_tokens_follow_java_split(spark):
    assert _split(spark, ["", "   ", "a b ", " a  b"], " ") == [
        [""], [], ["a", "b"], ["", "a", "", "b"]]


def test_comma_lists_follow_java_split(spark):
    assert _split(spark, ["", ",,", "a,b,", ",a"], ",") == [[""], [], ["a", "b"], ["", "a"]]


def test_text_lines(spark):
    df = spark.createDataFrame([("a\nb\r\nc\rd",), ("x\n",), ("",), ("\n",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == [["a", "b", "c", "d"], ["x"], [], [""]]


def test_half_up(spark):
    df = spark.createDataFrame([(0.5,), (1.392857,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(half_up("x")).collect()] == [1.0, 1.0, 3.0, 0.0]


def test_word_count_and_pairs(spark):
    lines = spark.createDataFrame([("a b a",), ("",), (" b",)], "value string")
    counts = {r["word"]: r["n"] for r in word_count(lines).collect()}
    assert counts == {"a": 2, "b": 2, "": 2}
    assert tokens(lines).count() == 6
    pairs = sorted(r[0] for r in format_pairs(word_count(lines)).collect())
    assert pairs == ["(,2)", "(a,2)", "(b,2)"]


def test_word_count_is_partition_independent(spark):
    lines = spark.createDataFrame([(f"w{i % 7} x y{i % 3}",) for i in range(200)], "value string")
    a = sorted(word_count(lines).collect())
    b = sorted(word_count(lines.repartition(13)).collect())
    assert a == b


def test_word_count_on_a_stream(spark, tmp_out):
    # the same DataFrame operator drives a Structured Streaming query
    import os
    src = os.path.join(tmp_out, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("a b\nb c\n")
    stream = spark.readStream.text(src)
    q = (word_count(stream).writeStream.outputMode("complete").format("memory")
         .queryName("wl_stream_counts").start())
    try:
        q.processAllAvailable()
        got = {r["word"]: r["n"] for r in spark.table("wl_stream_counts").collect()}
    finally:
        q.stop()
    assert got == {"a": 1, "b": 2, "c": 1}


def test_last_line_terminators_stay(spark):
    df = spark.createDataFrame([("a\n\n",), ("a\r\n\r\n",), ("\n\n",), ("a\r\r\n",), ("a\n\r",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == [["a", ""], ["a", ""], ["", ""], ["a", ""], ["a", ""]]
    for end in ("\u0085", "\u2028", "\n", "\r\n"):
        assert _split(spark, ["a," + end, "a,,"], ",") == [["a", end], ["a"]]
