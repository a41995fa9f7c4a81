"""Word boundaries by the Unicode rules (UAX #29), as Column expressions.

The property table below names the characters of each class that the rules speak of. The rules
run in two steps, so that no pattern has to recurse over a long word. First every mark that
may stand inside a word but does not join there becomes a space: a dot, colon or apostrophe
joins two letters, a dot, comma or apostrophe two digits. Then a word is a plain run of
letters, digits, connectors and the marks that are left, or a run of katakana; the two meet only
at a connector. Extending characters (accents, joiners, invisible marks) stay with what they
follow. Both steps keep the number of characters, so offsets stay those of the text.

Han and hiragana characters are words of their own, as the rules have them. Symbols, emoji and
circled numbers are no words here. Scripts without spaces that need a dictionary (Thai, Khmer,
Lao, Myanmar) stay whole runs. An apostrophe that ends a Hebrew word is not part of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character ranges of the Japanese scripts. Ranges, as looking up the script of
# every character is slow.
HAN = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}々〇"
HIRAGANA = r"\x{3041}-\x{3096}\x{309D}-\x{309F}"
KATAKANA = r"\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{FF66}-\x{FF9F}"

# The Word_Break property of the Unicode character database, as far as the rules
# need it, in the notation of a character class.
MID_LETTER = r":\x{B7}\x{387}\x{55F}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
MID_NUM = r",;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
MID_NUM_LET = r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
EXTEND_NUM_LET = r"_\x{202F}\x{203F}\x{2040}\x{2054}\x{FE33}\x{FE34}\x{FE4D}-\x{FE4F}\x{FF3F}"
FORMAT = r"\x{AD}\x{61C}\x{70F}\x{200C}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFB}"
EXTEND = rf"\p{{M}}{FORMAT}\x{{FF9E}}\x{{FF9F}}"
NUMERIC = r"\p{Nd}\x{66B}"
KANA = r"\x{3031}-\x{3035}\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{32D0}-\x{32FE}\x{3300}-\x{3357}\x{FF66}-\x{FF9D}"
HEBREW = r"\x{5D0}-\x{5EA}\x{5EF}-\x{5F2}\x{FB1D}\x{FB1F}-\x{FB4F}"

#: Letters of words; the Japanese scripts have rules of their own.
LETTER = rf"[\p{{L}}\p{{Nl}}&&[^{HAN}{HIRAGANA}{KANA}{KATAKANA}]]"
ALONE = f"[{HAN}{HIRAGANA}]"
#: Extending characters that may stand between a character and the one that a rule looks at.
_SKIP = f"[{EXTEND}]{{0,8}}"
_MARKS = f"[{MID_LETTER}{MID_NUM}{MID_NUM_LET}\"]"
#: Common characters that are no marks.
_NO_MARKS = r"[a-z \x{3041}-\x{9FFF}]"
#: What joins; the plainest case comes first, as looking back over accents is dear.
_JOINS = (
    rf"(?<=[a-z])[:.'][a-z]"
    rf"|(?<={LETTER}{_SKIP})[{MID_LETTER}{MID_NUM_LET}]{_SKIP}{LETTER}"
    rf"|(?<=[{NUMERIC}]{_SKIP})[{MID_NUM}{MID_NUM_LET}]{_SKIP}[{NUMERIC}]"
    rf"|(?<=[{HEBREW}]{_SKIP})\"{_SKIP}[{HEBREW}]"
)
_CORE = rf"[{LETTER}{NUMERIC}]"
_RUN = rf"[{LETTER}{NUMERIC}{EXTEND_NUM_LET}][{LETTER}{NUMERIC}{EXTEND_NUM_LET}{_MARKS}{EXTEND}]*+"
_KANA_RUN = rf"[{KANA}][{KANA}{EXTEND}]*+"
#: Common words in short classes: what follows them could not be a part of them. The full rules, whose long classes are
#: dear to look through, would find the same words.
_PLAIN_ALONE = rf"{ALONE}(?=[ a-z\x{{3041}}-\x{{3096}}\x{{309D}}-\x{{9FFF}}])"
_PLAIN = (
    r"[a-z0-9\x{E0}-\x{F6}\x{F8}-\x{FF}]++(?=[ \n]|\z)"
    r"|[\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{FF66}-\x{FF9D}][\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{FF66}-\x{FF9F}]*+"
    r"(?=[ \x{3041}-\x{3096}\x{4E00}-\x{9FFF}])"
)
#: The full rules. Characters alone come first, and classes before what looks back.
_FULL = (
    rf"{ALONE}[{EXTEND}]*+"
    rf"|(?![{EXTEND_NUM_LET}](?<=[{EXTEND_NUM_LET}]{{2}}))(?=[{EXTEND_NUM_LET}{EXTEND}]*+[{LETTER}{NUMERIC}{KANA}])"
    rf"(?:{_RUN}|{_KANA_RUN})"
    rf"(?:(?=[{KANA}])(?<=[{EXTEND_NUM_LET}]{_SKIP}){_KANA_RUN}|(?=[{EXTEND_NUM_LET}])(?<=[{KANA}]{_SKIP}){_RUN})*+"
)
#: A word of a text whose marks have been settled.
WORD = f"(?:{_PLAIN_ALONE}|(?! )(?:{_PLAIN}|{_FULL}))"
#: What lies between the words; connectors that belong to none are a gap of their own.
GAP = rf"(?:[^{LETTER}{NUMERIC}{EXTEND_NUM_LET}{KANA}{HAN}{HIRAGANA}]+|[{EXTEND_NUM_LET}]+)"


def settle_marks(text: Column) -> Column:
    """The text with a space for every mark that does not join the characters around it."""
    # The mark is looked for first: what joins around it is dear to look at.
    return F.regexp_replace(text, f"(?!{_NO_MARKS})(?={_MARKS})(?:{_MARKS}(?= )|(?!{_JOINS}){_MARKS})", " ")
