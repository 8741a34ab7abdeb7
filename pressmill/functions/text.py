"""Text clean-up as column expressions: N1-N3 and the whitespace rules E14-E16."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII whitespace, what a strip removes. ``trim`` alone removes spaces only.
WHITESPACE = " \t\n\r\u000b\f"

# Transliterations that canonical decomposition does not give.
_ONE_TO_ONE = {
    " ": " ", "¡": "!", "¦": "|", "¨": '"', "ª": "a", "²": "2", "³": "3",
    "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1", "º": "o", "¿": "?",
    "×": "x", "÷": "/", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d",
    "Ħ": "H", "ħ": "h", "ı": "i", "Ł": "L", "ł": "l", "Ŧ": "T", "ŧ": "t",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "‘": "'",
    "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"',
    "•": "*", "′": "'", "‹": "<", "›": ">", "⁄": "/",
    "−": "-",
}
_ONE_TO_MANY = {
    "¢": "C/", "£": "PS", "¥": "Y=", "§": "SS", "©": "(c)", "«": "<<", "®": "(r)",
    "°": "deg", "±": "+-", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4",
    "Æ": "AE", "æ": "ae", "Þ": "Th", "þ": "th", "ß": "ss", "Œ": "OE", "œ": "oe",
    "—": "--", "―": "--", "„": ",,", "…": "...", "″": "''",
    "€": "EUR", "№": "No", "™": "(tm)",
}

# Greek and Cyrillic small letters, spelled as usual in English text.
_GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s",
    "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
_CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "\"", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ё": "io", "є": "ie",
    "і": "i", "ї": "yi", "ґ": "g", "ў": "u", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "tsh", "џ": "dzh", "ѓ": "gj", "ќ": "kj", "ѕ": "dz",
}
# Spaces, dashes, quotes and marks of general punctuation.
_PUNCTUATION = {
    "‗": "_", "‟": '"', "‣": ">", "․": ".", "‥": "..", "‰": "%0", "‵": "`", "‶": "``",
    "‼": "!!", "⁇": "??", "⁈": "?!", "⁉": "!?", "‖": "||", "†": "+", "‡": "++",
    **{chr(c): " " for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)},
}


def _other_scripts() -> dict[str, str]:
    """Both cases of the letters above, their accented forms, and the punctuation."""
    small = _GREEK | _CYRILLIC
    table = small | {k.upper(): v[:1].upper() + v[1:] for k, v in small.items() if k != "ς"}
    for ch in map(chr, [*range(0x0370, 0x0530), *range(0x1F00, 0x2000)]):
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
        if ch not in table and base in table:
            table[ch] = table[base]
    return table | _PUNCTUATION


def _decomposed_letters() -> dict[str, str]:
    """Accented Latin letters and the ASCII letter they decompose to."""
    latin = [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]
    table = {}
    for ch in map(chr, latin):
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
        if base != ch and len(base) == 1 and base.isascii():
            table[ch] = base
    return table


def _translate_strings() -> tuple[str, str]:
    pairs = _decomposed_letters() | _ONE_TO_ONE | _SHORT
    # Bullets turn into '*' in the table above and are deleted with the other '*'.
    kept = {k: v for k, v in pairs.items() if v not in "*#"}
    deleted = "".join(k for k, v in pairs.items() if v in "*#") + "*#"
    deleted += "".join(map(chr, range(0x0300, 0x0370)))  # loose accents
    return "".join(kept) + deleted, "".join(kept.values())


_SCRIPTS = _other_scripts()
_SHORT = {k: v for k, v in _SCRIPTS.items() if len(v) == 1}
_LONG = _ONE_TO_MANY | {k: v for k, v in _SCRIPTS.items() if len(v) > 1}
_FROM, _TO = _translate_strings()
#: Marks without a letter of their own: they go without a trace.
_SILENT = "\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff\u0300-\u036f"


def unspelled(c: Column) -> Column:
    """How many characters of ``c`` :func:`to_ascii` has nothing to put for."""
    left = F.translate(c, _FROM + "".join(_LONG), "")
    strange = F.regexp_replace(left, rf"[\x00-\x7F{_SILENT}]+", "")
    return F.when(_is_ascii(c), F.lit(0)).otherwise(F.coalesce(F.char_length(strange), F.lit(0)))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def to_ascii(c: Column) -> Column:
    """Transliterate to ASCII, delete ``*`` and ``#``.

    Pure ASCII text, most of it, only pays for two searches. Latin, Greek and Cyrillic
    letters and general punctuation are spelled out; what is left of other scripts is
    deleted, and :func:`unspelled` counts it.
    """
    letters = F.when(_is_ascii(c), F.replace(F.replace(c, F.lit("*")), F.lit("#"))).otherwise(
        F.translate(c, _FROM, _TO)
    )
    spelled = reduce(
        lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), _LONG.items(), letters
    )
    return F.when(_is_ascii(letters), letters).otherwise(
        F.regexp_replace(spelled, r"[^\x00-\x7F]+", "")
    )


# Patterns removed or rewritten in an article's content, in this
# order. (?d) makes only \n end a line, (?s) lets a dot cross lines.
_BOILERPLATE = (
    (r"(?id)^.*? TYPE: O?CN\s*\)\)", ""),
    (r"(?id)^.*?new lede,\s+\d+\)\)", ""),
    (r"(?is)_Some information for this report.*", ""),
    (r"[\n\r]+", "\n"),
    (r"(?s)_NEW:.+", ""),
    (r"_WikiLeaks_", "WikiLeaks"),
    (r"(?i)Please turn on JavaScript\. Media requires JavaScript to play\.", ""),
)


def strip_boilerplate(c: Column) -> Column:
    """The seven content rules, one after the other."""
    return reduce(lambda t, rule: F.regexp_replace(t, *rule), _BOILERPLATE, c)


def strip(c: Column) -> Column:
    """Remove ASCII whitespace at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze_ws(c: Column) -> Column:
    """Runs of space, tab and newline become one space."""
    return F.regexp_replace(c, r"[ \t\n]+", " ")


def space_out(c: Column) -> Column:
    """Each space, tab, newline and double quote becomes a space."""
    return F.translate(c, '\t\n"', "   ")


def squeeze_marks(c: Column) -> Column:
    """Runs of ``*``, tab and newline become one space; spaces stay."""
    return F.regexp_replace(c, r"[*\t\n]+", " ")


def space_out_lines(c: Column) -> Column:
    """E16, paragraph form: each space, tab and newline becomes a space."""
    return F.translate(c, "\t\n", "  ")
