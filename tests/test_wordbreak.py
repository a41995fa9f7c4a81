"""The standard analyzer against the word-break rules, applied one character at a time."""

from __future__ import annotations

import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import analysis as an
from corpusloom.functions import wordbreak as wb
from corpusloom.operators import tokens


def chars(spec):
    """Members of a character class, as far as it is spelled out."""
    spec = re.sub(r"\\p\{\w+\}", "", spec)
    spec = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), spec)
    out, i = set(), 0
    while i < len(spec):
        if i + 2 < len(spec) and spec[i + 1] == "-":
            out |= {chr(c) for c in range(ord(spec[i]), ord(spec[i + 2]) + 1)}
            i += 3
        else:
            out.add(spec[i])
            i += 1
    return out


SETS = {n: chars(getattr(wb, n)) for n in ("MID_LETTER", "MID_NUM", "MID_NUM_LET", "EXTEND_NUM_LET", "EXTEND", "KANA", "HEBREW", "HAN", "HIRAGANA")}


def kind(c):
    if c in SETS["EXTEND"] or unicodedata.category(c)[0] == "M":
        return "extend"
    for name in ("MID_LETTER", "MID_NUM_LET", "MID_NUM", "EXTEND_NUM_LET", "KANA"):
        if c in SETS[name]:
            return name
    if c in SETS["HAN"] or c in SETS["HIRAGANA"]:
        return "alone"
    if unicodedata.category(c) == "Nd":
        return "digit"
    return "letter" if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nl" else "quote" if c == '"' else "other"


def brute(text):
    """Words by rules WB4 to WB13b but WB7a, of a lower-cased text."""
    units = []  # a character and what extends it
    for c in text:
        if kind(c) == "extend" and units:
            units[-1] += c
        else:
            units.append(c)
    kinds = [kind(u[0]) for u in units]
    at = lambda i: kinds[i] if 0 <= i < len(kinds) else ""
    hebrew = lambda i: 0 <= i < len(units) and units[i][0] in SETS["HEBREW"]

    def joined(i):
        """Whether there is no boundary between units i and i + 1."""
        a, b = at(i), at(i + 1)
        mid_letter, mid_num = ("MID_LETTER", "MID_NUM_LET"), ("MID_NUM", "MID_NUM_LET")
        return (
            (a in ("letter", "digit") and b in ("letter", "digit"))
            or (a == "letter" and b in mid_letter and at(i + 2) == "letter")
            or (at(i - 1) == "letter" and a in mid_letter and b == "letter")
            or (a == "digit" and b in mid_num and at(i + 2) == "digit")
            or (at(i - 1) == "digit" and a in mid_num and b == "digit")
            or (hebrew(i) and b == "quote" and hebrew(i + 2))
            or (hebrew(i - 1) and a == "quote" and hebrew(i + 1))
            or (a == b == "KANA")
            or (a in ("letter", "digit", "KANA", "EXTEND_NUM_LET") and b == "EXTEND_NUM_LET")
            or (a == "EXTEND_NUM_LET" and b in ("letter", "digit", "KANA"))
        )

    out, word = [], []
    for i in range(len(units)):
        word.append(i)
        if i + 1 == len(units) or not joined(i):
            if any(at(j) in ("letter", "digit", "KANA", "alone") for j in word):
                out.append("".join(units[j] for j in word))
            word = []
    return out


@pytest.mark.parametrize(
    "source, want",
    [
        ("Can't stop, won't", ["can't", "stop", "won't"]),
        ("3.14 and 1,000.50; 12:30", ["3.14", "and", "1,000.50", "12", "30"]),
        ("www.example.com a.1 1.a end.", ["www.example.com", "a", "1", "1", "a", "end"]),
        ("snake_case _x_ __ x__", ["snake_case", "_x_", "x__"]),
        ("東京タワーのMap", ["東", "京", "タワー", "の", "map"]),
        ("カタカナabc カ_b a_カ_b", ["カタカナ", "abc", "カ_b", "a_カ_b"]),
        ("e\u0301te\u0301 l\u00adong a\u0301'b", ["e\u0301te\u0301", "l\u00adong", "a\u0301'b"]),
        ("か\u3099 x", ["か\u3099", "x"]),
        ("צה\"ל ג' x\"y", ["צה\"ל", "ג", "x", "y"]),
        ("'tis rock 'n' roll's", ["tis", "rock", "n", "roll's"]),
        ("", []),
        ("...", []),
    ],
)
def test_words(texts, source, want):
    assert brute(an_lower(source)) == want
    assert texts(an.tok_standard, source) == want


def an_lower(text):
    return text.replace("İ", "i").replace("Σ", "σ").lower()


def test_against_the_rules(spark):
    rng = random.Random(7)
    alphabet = list("abéß09٣.,:;'\"_‿·’ \n-") + ["タ", "ー", "ｶ", "ﾞ", "東", "の", "\u0301", "\u200d", "\u00ad", "\u3099", "א", "ב", "Ⅷ", "½", "🙂", "ด"]
    sources = [(i, "".join(rng.choices(alphabet, k=rng.randrange(0, 14)))) for i in range(6000)]
    df = spark.createDataFrame(sources, "doc_id int, text string").repartition(4)
    got = {r.doc_id: r.t for r in df.select("doc_id", an.tok_standard(F.col("text")).alias("t")).collect()}
    wrong = [(text, got[i], brute(an_lower(text))) for i, text in sources if got[i] != brute(an_lower(text))]
    assert wrong == []
    table = {}
    for r in tokens.token_table(df, "text", analyzer="standard").collect():
        table.setdefault(r.doc_id, []).append((r.position, r.token, r.start_offset, r.end_offset))
    for i, text in sources:
        rows = sorted(table.get(i, []))
        assert [w for _, w, _, _ in rows] == got[i]
        assert all(an_lower(text)[a:b] == w for _, w, a, b in rows)


def test_very_long_words(texts):
    assert texts(an.tok_standard, "1,2." * 30_000 + "5") == [("1,2." * 30_000) + "5"]
    assert texts(an.tok_standard, "a1" * 40_000 + "_" * 20_000) == ["a1" * 40_000 + "_" * 20_000]
    assert texts(an.tok_standard, "_" * 40_000) == []
    assert texts(an.tok_standard, "a.b'c:" * 20_000) == [("a.b'c:" * 20_000)[:-1]]


def test_word_rules_look_at_classes_first():
    """Looking back was tried at every character, which took most of the time on texts of single characters."""
    from corpusloom.functions import wordbreak

    assert wordbreak.WORD.startswith(f"(?:{wordbreak.ALONE}")
    assert "(?!(?<=" not in wordbreak.WORD


def test_plain_words_are_those_of_the_full_rules(spark):
    """The short first alternatives change no word, whatever character stands beside it."""
    near = ["a{0}b{0}{0}1{0}2 {0} é{0}\n{0}カ{0}カ{0}の{0}_{0}日{0}ｶ{0}ﾞ{0}".format(chr(c)) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    settled = wb.settle_marks(F.col("text"))
    found = lambda pattern: F.regexp_extract_all(settled, F.lit(f"({pattern})"), F.lit(1))
    rows = spark.createDataFrame([(t,) for t in near], "text string").select("text", found(wb.WORD).alias("got"), found(f"(?:{wb._FULL})").alias("full"))
    assert rows.filter("got <> full").head(3) == []


def test_plain_words_are_found_sooner(spark):
    """Most words are found without a look through the long classes."""
    text = F.lit(" ".join(["word", "カガの日本ｶﾞラ東京", "été"] * 20000))
    rows = spark.range(0, 8, 1, 1).select("id", text.alias("text"))

    def seconds(pattern):
        times = []
        for _ in range(3):
            began = time.perf_counter()
            rows.select(F.sum(F.size(F.regexp_extract_all(F.concat("text", F.col("id").cast("string")), F.lit(f"({pattern})"), F.lit(1))))).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    assert seconds(wb.WORD) < 0.8 * seconds(f"(?:{wb._FULL})")
