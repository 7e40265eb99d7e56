import math

import pytest
from pyspark.sql import functions as F

from lagloom.functions import arrays as A
from lagloom.functions import numbers as N
from lagloom.functions import text as T


def column(spark, values, schema, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {schema}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_number_text_flags(spark):
    cells = ["0", "0.0", "5", "1000.0", "333.34", "666.66", "667.66", "12.345", "2533333.34"]
    assert column(spark, cells, "string", N.is_zero) == [True, True] + [False] * 7
    assert column(spark, cells, "string", N.is_fake_number) == [False] * 7 + [True, False]
    assert column(spark, cells, "string", N.is_divided_number) == [False] * 4 + [True, True, False, False, True]
    # Zeros are weird, a divided number is not, a whole thousand is not.
    assert column(spark, cells, "string", N.is_weird_number) == [True, True, True, False, False, False, True, True, False]


def test_repair_value(spark):
    cells = ["5", "1000.0", "7.00", "12.345", "2533333.34", "333.33", "0.5", "142.86"]
    got = [(r.text, r.factor) for r in column(spark, cells, "string", N.repair_value)]
    assert got[:4] == [("5", 1), ("1000.0", 1), ("7.00", 1), ("12.345", 0)]
    assert got[4] == ("7600000.0", 3)
    assert got[5] == ("1000.0", 3)
    assert got[6] == ("0.5", 0)
    assert got[7] == ("1000.0", 7)


def test_half_even_rounding_and_zeros(spark):
    assert column(spark, ["0.5", "1.5", "2.5", "7"], "string", N.round_to_long) == [0, 2, 2, 7]
    assert column(spark, ["1000", "0", "", "102"], "string", N.count_trailing_zeros) == [3, 1, 0, 0]


def test_fake_row_needs_no_integer_cell(spark):
    rows = [["0", "1.125"], ["3.0", "1.125"], ["0", "0.0"], []]
    assert column(spark, rows, "array<string>", N.is_fake_row) == [True, False, False, False]


def test_compare_numeric_text(spark):
    rows = spark.createDataFrame([("5", "5"), ("5", "5.0"), ("5.0", "5"), ("5.0", "5.00"), ("5", "6.0")], "a string, b string")
    got = [r[0] for r in rows.select(N.compare_numeric_text(F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, True, False, False]


def test_array_statistics(spark):
    rows = [[], [0.0], [4.0], [1.0, 2.0, 4.0], [3.0, 1.0]]
    assert column(spark, rows, "array<double>", A.mean) == [None, 0.0, 4.0, 7 / 3, 2.0]
    assert column(spark, rows, "array<double>", A.median) == [None, 0.0, 4.0, 2.0, 2.0]
    var = column(spark, rows, "array<double>", A.variance)
    assert var[:3] == [None, None, None] and math.isclose(var[3], 7 / 3) and math.isclose(var[4], 2.0)
    assert column(spark, [[], [5, 5], [1, 9, 9]], "array<long>", A.argmax) == [-1, 0, 1]


def test_changes_and_gaps(spark):
    rows = [[], [0, 0], [5, 5, 0, 5], [1, 2, 2, 3]]
    assert column(spark, rows, "array<long>", A.count_changes) == [0, 0, 2, 3]
    assert column(spark, [[], [7], [1, 0, 0, 2, 3]], "array<long>", A.nonzero_gaps) == [[], [], [3, 1]]


def test_vectors(spark):
    nan = float("nan")
    assert column(spark, [[1.0, nan], [1.0, 2.0]], "array<double>", A.nan_row_to_zero) == [[0.0, 0.0], [1.0, 2.0]]
    assert column(spark, [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0]], "array<double>", lambda v: A.vector_split(v)[1]) == [[3.0, 4.0]]


@pytest.mark.parametrize(
    "text,needle",
    [("aaaa", "aa"), ("", "a"), ("abc", ""), ("ééé x é", "é"), ("none", "z"), ("a.b.c", ".")],
)
def test_substring_count_equals_str_count(spark, text, needle):
    rows = spark.createDataFrame([(text, needle)], "t string, n string")
    assert rows.select(T.substring_count(F.col("t"), F.col("n"))).first()[0] == text.count(needle)


def test_slices_and_sentence_bounds(spark):
    texts = ["One. Two é three. Four.", "no stop", ".x", "😀a. b"]
    rows = spark.createDataFrame([(t, i, j) for t in texts for i in range(8) for j in range(8)], "t string, i int, j int")
    t, i, j = F.col("t"), F.col("i"), F.col("j")
    got = rows.select("t", "i", "j", T.char_slice(t, i, j).alias("s"), T.last_before(t, ".", i).alias("l"), T.first_from(t, ".", j).alias("r"), T.sentence_snippet(t, i, j).alias("full"), T.sentence_snippet(t, i, j, True).alias("compat"))
    for r in got.collect():
        assert r.s == r.t[r.i : r.j]
        assert r.l == r.t.rfind(".", 0, r.i)
        assert r.r == (r.t.find(".", r.j) if r.j <= len(r.t) else -1)
        end = r.t.find(".", r.j)
        assert r.compat == r.t[r.l + 1 : end]
        assert r.full == (r.t[r.l + 1 : end] if end >= 0 else r.t[r.l + 1 :])


def test_names_titles_and_pronouns(spark):
    url = "x" * 29 + "Ann_Lee_(poet)"
    rows = spark.createDataFrame([("Ann Lee", "Bob", url), ("Zed", "LEE", url), ("Q", "R", url)], "a string, b string, u string")
    got = [r[0] for r in rows.select(T.title_class(F.col("a"), F.col("b"), F.col("u"))).collect()]
    assert got == [0, 1, 2]
    assert column(spark, ["She", "HIS", "her"], "string", T.gender_of_pronoun) == ["F", "M", "F"]
    assert column(spark, ["it"], "string", lambda c: T.gender_of_pronoun(c, strict=False)) == [None]
    with pytest.raises(Exception, match="unknown pronoun"):
        column(spark, ["it"], "string", T.gender_of_pronoun)
    flags = T.pronoun_flags(F.col("x"))
    assert column(spark, ["her", "hers"], "string", lambda _: flags["poss"]) == [0, 1]
    assert column(spark, ["TRUE", "false", "", "yes"], "string", T.parse_bool_text) == [True, False, None, None]


def test_anonymise_replaces_full_name_then_parts(spark):
    rows = spark.createDataFrame([("Ann Lee met Lee and Ann.", "Ann Lee")], "t string, n string")
    got = rows.select(T.anonymise_name(F.col("t"), F.col("n"), "x")).first()[0]
    assert got == "x met x and x."


def test_digests_side_by_side_are_those_of_hashlib():
    import hashlib

    import pyarrow as pa

    from lagloom.functions import digests

    texts = ["x" * n for n in (*range(0, 70), 118, 119, 120, 200)] + ["\u00e4\u4e16", None, "1-2-3"] * 3
    for own in (pa.array(texts), pa.array(["pad", *texts]).slice(1)):
        got = digests.leading(own, ["", "-7-0", "-19-0"])
        want = [[int(hashlib.md5(((t or "") + s).encode()).hexdigest()[:8], 16) for t in texts] for s in ("", "-7-0", "-19-0")]
        assert got.tolist() == want
