"""Accent folding as native column expressions.

Latin letters lose their accents, typographic signs become ASCII, combining
marks and emoji disappear. Other scripts (Greek, Cyrillic, CJK, ...) pass
through unchanged.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and signs that are spelled with several ASCII characters.
SPELLED_OUT = {
    "¢": "C/",
    "£": "PS",
    "¤": "$?",
    "¥": "Y=",
    "§": "SS",
    "©": "(c)",
    "«": "<<",
    "®": "(r)",
    "°": "deg",
    "±": "+-",
    "»": ">>",
    "¼": "1/4",
    "½": "1/2",
    "¾": "3/4",
    "Æ": "AE",
    "Þ": "Th",
    "ß": "ss",
    "æ": "ae",
    "þ": "th",
    "Ĳ": "IJ",
    "ĳ": "ij",
    "ŉ": "'n",
    "Ŋ": "ng",
    "ŋ": "ng",
    "Œ": "OE",
    "œ": "oe",
    "ẞ": "Ss",
    "—": "--",
    "„": ",,",
    "…": "...",
    "€": "EUR",
    "™": "(tm)",
    "\u2029": "\n\n",
    "‰": "%0",
    "←": "<-",
    "→": "->",
    "↔": "<->",
    "⇐": "<=",
    "⇒": "=>",
}

# Letters and signs that become one ASCII character although
# Unicode defines no decomposition for them.
SINGLE = {
    " ": " ",
    "¡": "!",
    "¦": "|",
    "¨": '"',
    "¬": "!",
    "¯": "-",
    "´": "'",
    "µ": "u",
    "¶": "P",
    "·": "*",
    "¸": ",",
    "¿": "?",
    "Ð": "D",
    "×": "x",
    "Ø": "O",
    "ð": "d",
    "÷": "/",
    "ø": "o",
    "Đ": "D",
    "đ": "d",
    "Ħ": "H",
    "ħ": "h",
    "ı": "i",
    "ĸ": "k",
    "Ł": "L",
    "ł": "l",
    "Ŧ": "T",
    "ŧ": "t",
    "‐": "-",
    "‑": "-",
    "‒": "-",
    "–": "-",
    "‘": "'",
    "’": "'",
    "‚": ",",
    "‛": "'",
    "“": '"',
    "”": '"',
    "‟": '"',
    "†": "+",
    "•": "*",
    "‹": "<",
    "›": ">",
    "\u2028": "\n",
    "′": "'",
    "″": '"',
    "⁄": "/",
    "−": "-",
    "∕": "/",
    "∶": ":",
    "∼": "~",
}

# Letters and signs that are spelled out before the ASCII test.
_COMMON = "ß—…"

# Latin-1, Extended-A, Extended-B; Extended Additional; general, narrow, mathematical and
# ideographic spaces; super- and subscripts; letter-like signs; full-width forms.
_DECOMPOSED = (
    range(0x00A0, 0x0250),
    range(0x1E00, 0x1F00),
    range(0x2000, 0x200B),
    range(0x202F, 0x2030),
    range(0x205F, 0x2060),
    range(0x2070, 0x20A0),
    range(0x2100, 0x2190),
    range(0x3000, 0x3001),
    range(0xFF01, 0xFF5F),
)

# Digraphs, numero, fractions, ligatures and squared units that Unicode takes apart into ASCII characters.
_COMPOSED = "ǄǅǆǇǈǉǊǋǌǱǲǳ№⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞ﬀﬁﬂﬃﬄﬅﬆ㎎㎏㎜㎝㎞"

# Soft hyphen, combining marks, zero-width signs, dingbats, variation selectors, emoji planes.
_DROPPED = (
    range(0x00AD, 0x00AE),
    range(0x0300, 0x0370),
    range(0x200B, 0x2010),
    range(0x2600, 0x27C0),
    range(0xFE00, 0xFE10),
    range(0x1F1E6, 0x1F200),
    range(0x1F300, 0x1FB00),
)


def _single_letters() -> dict[str, str]:
    """The one-to-one part of the fold, computed from the Unicode decomposition."""
    table = {}
    for block in _DECOMPOSED:
        for point in block:
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
            if len(plain) == 1 and plain.isascii():
                table[chr(point)] = plain
    return {**table, **SINGLE}


def _spellings() -> dict[str, str]:
    """The one-to-many part of the fold: the table above, and composed characters taken apart."""
    table = dict(SPELLED_OUT)
    for letter in _COMPOSED:
        parts = unicodedata.normalize("NFKD", letter).replace("\u2044", "/")
        table[letter] = "".join(c for c in parts if not unicodedata.combining(c))
    return table


_LETTERS = _single_letters()
_SPELLINGS = _spellings()
_GONE = "".join(chr(point) for block in _DROPPED for point in block)
_FROM = "".join(_LETTERS) + _GONE
_TO = "".join(_LETTERS.values())


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _spell_out(text: Column, letters: Iterable[str]) -> Column:
    for letter in letters:
        text = F.replace(text, F.lit(letter), F.lit(_SPELLINGS[letter]))
    return text


def ascii_fold(text: Column) -> Column:
    """Fold ``text`` to ASCII; NULL stays NULL.

    Each step runs only on values that still need it: pure ASCII text is passed
    on after two length look-ups, the one-to-one letters and the most common
    others are replaced next, and the long tail of replacements is left to the
    few values that are not ASCII even then.
    """
    text = text.cast("string")
    common = F.when(_is_ascii(text), text).otherwise(_spell_out(F.translate(text, _FROM, _TO), _COMMON))
    return F.when(_is_ascii(common), common).otherwise(_spell_out(common, _SPELLINGS))


def normalized(text: Column) -> Column:
    """Fold first, then upper-case, so that one-to-many letters keep their ASCII spelling."""
    return F.upper(ascii_fold(text))
