from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediacat.functions import dates, language_codes, tags, text, timecode
from mediacat.functions.fixed_values import WHITESPACE


def values(spark, rows, column, ddl="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], ddl).select(column).collect()]


def by_hand(seconds):
    h, m = int(seconds // 3600), int((seconds % 3600) // 60)
    return f"{h:02d}:{m:02d}:{int(seconds % 60):02d},{int((seconds % 1) * 1000):03d}"


def test_timecode_truncates(spark):
    got = values(spark, [0.0, 1.001, 59.9999, 360000.0, 3599.9995], timecode.to_timecode(F.col("x")), "x double")
    assert got == ["00:00:00,000", "00:00:01,000", "00:00:59,999", "100:00:00,000", "00:59:59,999"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 500000, allow_nan=False), min_size=40, max_size=40))
def test_timecode_equals_float_arithmetic(spark, seconds):
    assert values(spark, seconds, timecode.to_timecode(F.col("x")), "x double") == [by_hand(s) for s in seconds]


def test_timecode_parses_back(spark):
    codes = ["00:00:00,000", "100:00:01,250", "01:02:03,004", "bad"]
    assert values(spark, codes, timecode.timecode_to_millis(F.col("x"))) == [0, 360001250, 3723004, None]
    assert values(spark, codes, timecode.timecode_to_seconds(F.col("x")))[:3] == [0.0, 360001.25, 3723.004]


def test_strip_is_python_strip(spark):
    rows = [f"{c}a{c}b{c}{c}" for c in WHITESPACE] + ["", "  ", "x", "\n\tx y　"]
    assert values(spark, rows, text.strip(F.col("x"))) == [r.strip() for r in rows]


def test_affixes_only_at_the_ends(spark):
    rows = ["ipfs://a", "a/ipfs://b", "ipfs://ipfs://c", "", "a/manifest.m3u8", "/manifest.m3u8x"]
    assert values(spark, rows, text.without_prefix(F.col("x"), "ipfs://")) == [r.removeprefix("ipfs://") for r in rows]
    assert values(spark, rows, text.without_suffix(F.col("x"), "/manifest.m3u8")) == [
        r.removesuffix("/manifest.m3u8") for r in rows
    ]


RULES = [("the", "DER"), ("der", "la"), ("on.", "$1 on"), ("a\\Eb", "\\q"), ("é", "E")]


def test_corrections_are_ordered_literal_and_caseless(spark):
    rows = ["The der ON. on! oni", "x A\\eB y", "É é", ""]
    want = ["la la $1 on on! oni", "x \\q y", "E E", ""]
    assert values(spark, rows, text.corrected(F.col("x"), RULES)) == want
    many = RULES + [(f"zz{i}zz", "n") for i in range(120)]
    assert values(spark, rows, text.corrected(F.col("x"), many)) == want


def test_dates(spark):
    rows = ["2024-02-29", "", "nonsense", "2023-02-29", None]
    assert values(spark, rows, dates.parse_date(F.col("x"))) == [datetime(2024, 2, 29), None, None, None, None]
    moments = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), None]
    assert values(spark, moments, dates.iso(F.col("x")), "x timestamp_ntz") == [
        m and m.isoformat() for m in moments
    ]


def test_script_codes(spark):
    rows = ["en", "el", "xx", None]
    assert values(spark, rows, language_codes.script_code(F.col("x"))) == ["eng_Latn", "ell_Grek", "eng_Latn", "eng_Latn"]
    assert values(spark, rows, language_codes.is_mapped(F.col("x"))) == [True, True, False, False]
    assert len(language_codes.LANGUAGE_CODES) == 21


def chosen(spark, scores, k=2, t=0.3):
    schema = "x array<struct<label: string, score: double>>"
    column = tags.chosen(tags.by_score(F.col("x")), k, t)
    return values(spark, scores, column, schema)


def test_tag_choice(spark):
    got = chosen(spark, [
        [("a", 0.1), ("b", 0.2)], [("a", 0.5), ("b", 0.9), ("c", 0.7)], [("b", 0.5), ("a", 0.5)],
        [("a", 0.3), ("b", 0.1)], [],
    ])
    assert got == [["b"], ["b", "c"], ["a", "b"], ["a"], []]


def test_custom_tags_keep_order_and_room(spark):
    rows = spark.createDataFrame(
        [(["a", "b"], ["b", "c", "c", "d", "e", "f"]), (["a", "b", "c", "d", "e"], ["x"]), ([], [])],
        "t array<string>, c array<string>",
    )
    got = [r[0] for r in rows.select(tags.with_custom(F.col("t"), F.col("c"), 2)).collect()]
    assert got == [["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], []]
