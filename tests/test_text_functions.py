"""Row-level expressions on small texts, against plain Python where there is a twin."""

import re

import pytest
from pyspark.sql import functions as F

from textquarry.functions import answers as A
from textquarry.functions import labels as L
from textquarry.functions import pii
from textquarry.functions import text as X
from textquarry.operators import tokens as K
from textquarry.operators.quality import repetition_shares


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def test_split_thinking_variants(spark):
    def f(s):
        return tuple(one(spark, X.split_thinking(F.col("t")), t=s))

    assert f("<think>a\nb</think>  c ") == ("a\nb", "c")
    assert f(" no tags ") == ("", " no tags ")
    assert f("<think>open") == ("", "<think>open")


def test_extract_open_thinking(spark):
    got = one(spark, X.extract_thinking(F.col("t")), t="<think> never closed ")
    assert tuple(got) == ("<think>\n\n</think>", "never closed")


def test_splice_takes_text_literally(spark):
    got = one(spark, X.splice(F.col("t"), "think", F.lit(r"$1 \x")), t="<think>old</think> rest")
    assert got == r"<think>$1 \x</think> rest"


def test_min_size_chunks(spark):
    got = one(spark, X.chunks_of_min_size(F.col("t"), 5), t="abc\n\ndef\n\nlonger one\n\nx")
    assert got == ["abc\n\ndef", "longer one", "x"]


@pytest.mark.parametrize("length", [0, 10, 1000, 2000, 2001, 9000])
def test_bounded_chunks_lose_nothing(spark, length):
    words = "lorem ipsum, dolor. sit\n"
    text = (words * 400)[:length]
    got = one(spark, X.size_bounded_chunks(F.col("t")), t=text)
    assert "".join(got) == text
    assert all(len(c) <= 2000 for c in got)
    assert all(len(c) >= 1000 for c in got[:-1])


def test_bounded_chunks_prefer_lines(spark):
    text = "a" * 1200 + "\n" + "b, c. " * 100 + "z" * 3000
    got = one(spark, X.size_bounded_chunks(F.col("t")), t=text)
    assert got[0] == "a" * 1200 + "\n"
    assert "".join(got) == text


def test_noisy_chunks(spark):
    clean, noisy = "word " * 300 + "\n", "#1!2?3 " * 250 + "\n"
    def f(text):
        return one(spark, X.drop_noisy_chunks(F.col("t")), t=text)

    assert f(clean * 2) == clean * 2
    assert f(noisy * 2) is None
    mixed = f(clean + noisy + noisy + clean)
    assert mixed.count("\n\n[...]\n\n") == 1 and mixed.startswith(clean) and "#1" not in mixed


def test_segments(spark):
    got = one(spark, X.segment_lengths(F.split(F.col("t"), " "), "|"), t="| a b | c d e | |")
    assert got == [3, 4, 1, 1]
    assert one(spark, X.segment_lengths(F.split(F.col("t"), " "), "|"), t="a b | c") == [2, 2]


def test_cut_long_text(spark):
    assert one(spark, X.cut_long_text(F.col("t"), 10), t="ab. cd ef gh ij") == "ab."
    assert one(spark, X.cut_long_text(F.col("t"), 5), t="abcdefgh") == "abcde"


def test_cjk_lines(spark):
    assert one(spark, X.drop_cjk_lines(F.col("t")), t="汉字 a\nplain\n汉 ab") == "plain\n汉 ab"


def test_language_pair(spark):
    pairs = {"europarl_fr-en_v8": "en-fr", "europarl_en-fr_v8": "en-fr", "europarl_fr_v8": "fr", "other": "unknown"}
    for name, want in pairs.items():
        assert one(spark, X.language_pair(F.col("t")), t=name) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("mail a.b+c@x-y.example.org now", "mail email@example.com now"),
        ("from 10.0.0.255, done", "from <IP_ADDRESS>, done"),
        ("not 300.1.1.1 nor 1.2.3", "not 300.1.1.1 nor 1.2.3"),
    ],
)
def test_pii(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    got = pii.mask_pii(df).first().text
    assert got == want


def test_phones_by_language(spark):
    rows = [("fr", "tel 06 12 34 56 78."), ("en", "tel 06 12 34 56 78."), ("en", "call +44 20 7946 0958 now"), ("es", "612 345 678 x")]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = [r.text for r in pii.mask_phone(df).collect()]
    assert got == ["tel <PHONE_NUMBER>.", "tel 06 12 34 56 78.", "call <PHONE_NUMBER> now", "<PHONE_NUMBER> x"]


def test_labels(spark):
    sizes = {1: "1", 4: "4", 5: "5-100", 99: "5-100", 100: "100-1000", 999: "100-1000", 1000: "1000+"}
    for n, name in sizes.items():
        assert one(spark, L.cluster_bucket(F.lit(n))) == f"cluster_size-{name}"
    probs = F.create_map(F.lit("__label__2"), F.lit(0.5), F.lit("__label__3"), F.lit(0.5))
    assert one(spark, L.expected_score(probs)) == 2.5
    assert one(spark, F.bround(L.expected_score(probs)).cast("int")) == 2
    assert one(spark, L.expected_score(F.lit(None).cast("map<string,double>"))) is None
    with pytest.raises(Exception, match="Unknown language"):
        one(spark, L.language_family(F.lit("xx")))
    with pytest.raises(Exception, match="too many parts"):
        one(spark, L.name_parts(F.lit("a_b_c_d")))


def test_numbers(spark):
    assert one(spark, A.numbers(F.lit("lost (1,234) of $5, up 2.9% or -7"))) == [-1234.0, 5.0, 2.9, -7.0]
    def match(e, o, scale):
        return one(spark, A.numeric_match(F.array(F.lit(e)), F.array(F.lit(o)), F.lit(scale)))

    assert match(5.0, 5040.0, "thousand") and not match(5.0, 5060.0, "thousand")
    assert match(0.029, 2.9, "percent") and not match(1.0, 2.0, "")


def test_written_forms_of_numbers(spark):
    texts = {
        "1,234,567.5 and 12,3456": [1234567.5, 12.0, 3456.0],  # only groups of three belong together
        "1234,567": [1234.0, 567.0],
        "1,23": [1.0, 23.0],
        "(12) (-3) -4 5-6": [-12.0, -3.0, -4.0, 5.0, -6.0],
        "($5) -$6 $(7) €8": [-5.0, -6.0, -7.0, 8.0],  # currency signs don't hide a sign
        "(9%) (10)% 11%": [-9.0, -10.0, 11.0],
        "(in 2019) (2020 2021": [2021.0],  # one bracket only
        "3.4.5 .5 6. a1b": [3.4, 5.0, 5.0, 6.0, 1.0],
        "none - ( ) , % $": [],
        "": [],
    }
    for text, want in texts.items():
        assert one(spark, A.numbers(F.lit(text))) == want, text
    tokens = {
        " (1,234) ": -1234.0, "2.9 %": 2.9, "$5": 5.0, "€ -5": -5.0, "(-5)": -5.0, "1,234.": 1234.0, ".5": 0.5, "1e3": 1000.0,
        "1,23": None, "12,345,6": None, "(5": None, "5)": None, "": None, "abc": None, "1 2": None, "%": None,
    }
    for token, want in tokens.items():
        assert one(spark, A.parse_number(F.lit(token))) == want, token
    assert one(spark, A.parse_number(F.lit(None).cast("string"))) is None



def test_answers(spark):
    def kind(e, x):
        return one(spark, A.match_type(F.lit(e), F.lit(x).cast("string")))

    assert kind("The Cat!", "a cat") == "exact"
    assert kind("cat", "the black cat") == "fuzzy"
    assert kind("one two three four five", "five four three two zero") == "fuzzy"
    assert kind("", "anything") == "none"
    assert kind("cat", None) == "none"
    assert one(spark, A.extract_answer(F.lit("x **Final Answer:** **Paris**.\nbye"))) == "Paris"
    assert one(spark, A.extract_answer(F.lit("so the answer is 42. Bye"))) is not None
    assert one(spark, A.extract_answer(F.lit("nothing here"))) is None


def test_citations(spark):
    text = 'a ##Cite "T 1"## b ##Cite  "t 1" ## c ##Cite « Deux » ##'
    assert one(spark, A.extract_citations(F.lit(text))) == ["T 1", "Deux"]
    assert one(spark, A.extract_citations(F.lit("##Cite Plain one ##"))) == ["Plain one"]
    s = one(spark, A.citation_scores(F.array(F.lit("A"), F.lit("x")), F.array(F.lit("a "), F.lit("b"))))
    assert (s.precision, s.recall, s.f1, s.extra, s.missed) == (0.5, 0.5, 0.5, 1, 1)
    nothing = F.array().cast("array<string>")
    empty = one(spark, A.citation_scores(nothing, F.array(F.lit("a"))))
    assert (empty.precision, empty.recall, empty.f1) == (None, 0.0, None)


def test_sequential_blanks(spark):
    got = one(spark, A.mcq_choices_sequential(F.lit("<...> eats <...>"), F.array(F.lit("he / it"), F.lit("she"))))
    assert got == ["he eats it", "she eats <...>"]


def test_fit_template_matches_reference_rule(spark):
    schema = "parts array<struct<key:string,ids:array<int>>>"
    parts = [("<t>", [1, 2]), ("a", list(range(10))), ("b", list(range(5))), ("label", [9])]
    df = spark.createDataFrame([([*parts],)], schema)

    def lengths(max_len, side="right"):
        out = K.fit_template(df, "parts", max_len, ["a", "b"], side).first().parts
        return [len(p.ids) for p in out]

    assert lengths(18) == [2, 10, 5, 1]
    assert lengths(15) == [2, 8, 4, 1]
    # Field b cannot give its share; what is left comes off the nearest parts.
    assert sum(lengths(4)) == 4 and sum(lengths(4, "left")) == 4
    left = K.fit_template(df, "parts", 15, ["a", "b"], "left").first().parts
    assert list(left[1].ids) == list(range(2, 10))


def test_repetition_brute_force():
    text = "a b a b a b c d e f g h i j c d e f g h"
    top2 = repetition_shares(text)[0]
    assert top2 == pytest.approx(len("a b") * 3 / len(text))
    tokens = text.split()
    seen, repeated, i = set(), 0, 0
    while i <= len(tokens) - 5:
        gram = "".join(tokens[i : i + 5])
        if gram in seen:
            repeated, i = repeated + len(gram), i + 5
        else:
            seen.add(gram)
            i += 1
    assert repetition_shares(text)[3] == repeated / len(text)


def test_pretokens_cover_text(spark):
    text = "L'été, aujourd'hui 12°C — don't\n\n  stop\t!"
    got = one(spark, X.pretokens(F.lit(text)))
    assert "".join(got) == text
    assert re.sub(r"\s", "", "".join(got)) == re.sub(r"\s", "", text)
