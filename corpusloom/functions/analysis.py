"""Analyzers: text column in, array of tokens out, all as Column expressions.

The six built-in analyzers follow their public descriptions. The Japanese chain has no
dictionary: overlapping bigrams stand in for words, so tokens differ from a dictionary
analyzer although every later filter is the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.wordbreak import GAP, HAN, HIRAGANA, KATAKANA, WORD, settle_marks

# The customary English stop words of the "stop" analyzer.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their "
    "then there these they this to was will with"
).split()

# The customary Japanese stop words of full-text engines.
JAPANESE_STOP_WORDS = (
    "の に は を た が で て と し れ さ ある いる も する から な こと として い や れる など なっ ない この ため "
    "その あっ よう また もの という あり まで られ なる へ か だ これ によって により おり より による ず なり られる "
    "において ば なかっ なく しかし について せ だっ その後 できる それ う ので なお のみ でき き つ における および "
    "いう さらに でも ら たり その他 に関する たち ます ん なら に対して 特に せる 及び これら とき では にて ほか ながら "
    "うち そして とともに ただし かつて それぞれ または お ほど ものの に対する ほとんど と共に といった です とも "
    "ところ ここ"
).split()

# Half-width katakana U+FF65..U+FF9D and their full-width forms, in order.
HALF_KATAKANA = "･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝ"
FULL_KATAKANA = "・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン"
VOICED_BASES = "カキクケコサシスセソタチツテトハヒフヘホ"
SEMI_VOICED_BASES = "ハヒフヘホ"
HALF_VOICED_MARK = "ﾞ"
HALF_SEMI_VOICED_MARK = "ﾟ"

FULL_WIDTH_ASCII = "".join(chr(0xFF01 + i) for i in range(94))
ASCII = "".join(chr(0x21 + i) for i in range(94))

CJK = f"[{HAN}{HIRAGANA}{KATAKANA}]"
OTHER_WORD = rf"[\p{{L}}\p{{N}}&&[^{HAN}{HIRAGANA}{KATAKANA}]]+"

#: Stands between tokens while a whole token list is handled as one text. It is white space,
#: so no token of a splitting analyzer holds it.
JOINT = "\x1f"


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def lower_text(text: Column) -> Column:
    """Lower case character by character: İ gives i, and Σ gives σ wherever it stands."""
    # Replacing searches bytes; translating would look up every character.
    return F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))


def _as_text(tokens: Column, step) -> Column:
    """Apply a text function to all tokens at once, which is cheaper than to each."""
    # No token is empty; the empty list alone splits into an empty token.
    return F.array_remove(F.split(step(F.array_join(tokens, JOINT)), JOINT), "")


def lowercase_tokens(tokens: Column) -> Column:
    """Every token in lower case."""
    return F.transform(tokens, lower_text)


def drop_tokens(tokens: Column, stop_words: list[str]) -> Column:
    """Remove the tokens of a stop list, keeping repeats and order of the others."""
    return F.filter(tokens, lambda token: ~token.isin(stop_words))


def tok_whitespace(text: Column) -> Column:
    """Split on white space."""
    return _matches(text, r"[^\p{javaWhitespace}]+")


def tok_simple(text: Column) -> Column:
    """Runs of letters, lower-cased."""
    return _matches(lower_text(text), r"\p{L}+")


def tok_stop(text: Column) -> Column:
    """The simple analyzer without English stop words."""
    return drop_tokens(tok_simple(text), ENGLISH_STOP_WORDS)


def tok_keyword(text: Column) -> Column:
    """The whole text as one token; no token for an empty text."""
    return F.when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))


def tok_pattern(text: Column) -> Column:
    """Split on runs of characters outside ``[A-Za-z0-9_]``, lower-cased."""
    return _matches(F.lower(text), r"[a-z0-9_]+")


def tok_standard(text: Column) -> Column:
    """Words by the Unicode rules, lower-cased: ``can't`` and ``3.14`` are one token; see ``wordbreak``."""
    return _matches(settle_marks(lower_text(text)), WORD)


#: Analyzers that cut the text into tokens and what lies between: the case folding, a token, a
#: gap, and words dropped afterwards. Folding keeps the number of characters, hence offsets.
RUNS = {
    "whitespace": (lambda text: text, r"[^\p{javaWhitespace}]+", r"\p{javaWhitespace}+", ()),
    "simple": (lower_text, r"\p{L}+", r"[^\p{L}]+", ()),
    "stop": (lower_text, r"\p{L}+", r"[^\p{L}]+", ENGLISH_STOP_WORDS),
    "keyword": (lambda text: text, r"(?s:.+)", r"(?!)", ()),
    "pattern": (lower_text, r"[a-z0-9_]+", r"[^a-z0-9_]+", ()),
    "standard": (lambda text: settle_marks(lower_text(text)), WORD, GAP, ()),
}


def tok_cjk_bigram(text: Column) -> Column:
    """Overlapping character pairs inside Chinese/Japanese runs, other words whole.

    A run of one character is a token by itself. The look-ahead captures the token at a
    character, the rest of the pattern then moves on by one character or one word.
    """
    token = rf"(?=({CJK}{{2}}|(?<!{CJK}){CJK}(?!{CJK})|{OTHER_WORD}))(?:{CJK}|{OTHER_WORD})"
    return F.regexp_extract_all(text, F.lit(token), F.lit(1))


def drop_punctuation(tokens: Column) -> Column:
    """Remove tokens without a letter or digit."""
    return F.filter(tokens, lambda token: token.rlike(r"[\p{L}\p{N}]"))


def width_fold(text: Column) -> Column:
    """Full-width ASCII to half width, half-width katakana to full width.

    A half-width voicing mark joins the letter before it, or else becomes the combining mark.
    """
    affected = text.rlike("[！-～･-ﾟ]")
    folded = F.translate(text, FULL_WIDTH_ASCII + HALF_KATAKANA, ASCII + FULL_KATAKANA)
    joined = folded
    for base in VOICED_BASES:
        joined = F.replace(joined, F.lit(base + HALF_VOICED_MARK), F.lit(chr(ord(base) + 1)))
    for base, voiced in (("ウ", "ヴ"), ("ワ", "ヷ"), ("ヲ", "ヺ")):
        joined = F.replace(joined, F.lit(base + HALF_VOICED_MARK), F.lit(voiced))
    for base in SEMI_VOICED_BASES:
        joined = F.replace(joined, F.lit(base + HALF_SEMI_VOICED_MARK), F.lit(chr(ord(base) + 2)))
    joined = F.translate(joined, HALF_VOICED_MARK + HALF_SEMI_VOICED_MARK, "゙゚")
    return F.when(~affected, text).when(text.rlike("[ﾞﾟ]"), joined).otherwise(folded)


def ja_stopwords(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """Remove Japanese stop words."""
    return drop_tokens(tokens, JAPANESE_STOP_WORDS if stop_words is None else stop_words)


def _stem_text(text: Column) -> Column:
    return F.regexp_replace(text, f"(?<=^|{JOINT})([ァ-ヺー]{{3,}})ー(?={JOINT}|$)", "$1")


def katakana_stem(tokens: Column) -> Column:
    """Drop the final long-vowel mark of katakana tokens of four or more characters."""
    return _as_text(tokens, _stem_text)


def analyze_japanese(text: Column, stop_words: list[str] | None = None) -> Column:
    """The analyzer chain: bigrams, width, stop words, stem, lower case.

    Bigrams hold letters and digits only, so punctuation is gone from the start.
    """
    kept = ja_stopwords(_as_text(tok_cjk_bigram(text), width_fold), stop_words)
    return _as_text(kept, lambda joined: lower_text(_stem_text(joined)))


ANALYZERS = {
    "whitespace": tok_whitespace,
    "simple": tok_simple,
    "stop": tok_stop,
    "keyword": tok_keyword,
    "pattern": tok_pattern,
    "standard": tok_standard,
    "japanese": analyze_japanese,
}
