"""Character clean-up shared by the text operators.

``fold(text)`` brings a text to the form every comparison in this package uses:
full-width letters and digits and letter ligatures become ordinary ones, invisible
characters go, odd blanks become a space, letter + combining mark becomes the one
character that exists for it, and look-alike letters inside a word of another script
become the letters of that word's dominant script.  Superscripts, fractions, typographic
quotes and dashes, emoji and whole words of another script stay.
"""

from __future__ import annotations

import re
import unicodedata

#: Format characters that show nothing, by code point ranges.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\u3164\ufeff\uffa0\U000e0000-\U000e007f"
#: Blanks other than space, tab and line breaks.
ODD_BLANKS = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
MARKS = "\u0300-\u034e\u0350-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff"
WIDE = "\uff10-\uff19\uff21-\uff3a\uff41-\uff5a"
LIGATURES = "\u0132\u0133\u01c4-\u01cc\u01f1-\u01f3\ufb00-\ufb06"
GREEK = "\u0370-\u03ff\u1f00-\u1fff"
CYRILLIC = "\u0400-\u052f"
#: Armenian, Hebrew, Arabic, Georgian, Cherokee, Coptic and Lisu letters.
OTHER = "\u0531-\u0556\u0561-\u0587\u05d0-\u05ea\u0620-\u064a\u10a0-\u10ff\u13a0-\u13fd\uab70-\uabbf\u2c80-\u2cee\ua4d0-\ua4f7"

#: Letters that look like a Latin letter: Cyrillic, Greek, Armenian, Cherokee, Coptic.
TO_LATIN = dict(
    zip(
        "аеорсухіјѕԁһԛԝүАВЕКМНОРСТУХІЈЅԌԚԜ"
        "οαιυνκρτχγΑΒΕΖΗΙΚΜΝΟΡΤΥΧϳ"
        "օսհոյցզՕՍ"
        "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ"
        "ⲟⲣⲥⲞⲢⲤ",
        "aeopcyxijsdhqwyABEKMHOPCTYXIJSGQW" "oaiuvkptxyABEZHIKMNOPTYXj" "ouhnjgqOU" "ABCDEGHJKLMPRSTVWZ" "opcOPC",
        strict=True,
    )
)
#: The other way, for words that are mostly Cyrillic or Greek.
TO_CYRILLIC = dict(zip("aeopcyxijsABEKMHOPCTYXIJS", "аеорсухіјѕАВЕКМНОРСТУХІЈЅ", strict=True))
TO_GREEK = dict(zip("oavxABEZHIKMNOPTYX", "οανχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", strict=True))

SUSPECT = re.compile(f"[{INVISIBLE}{ODD_BLANKS}{MARKS}{WIDE}{LIGATURES}{GREEK}{CYRILLIC}{OTHER}]")
_WIDE = re.compile(f"[{WIDE}{LIGATURES}]")
_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_EMOJI_JOINER = re.compile("(?<=[\u2190-\u2bff\ufe0f\U0001f000-\U0001faff])\u200d(?=[\u2190-\u2bff\U0001f000-\U0001faff])")
_BLANK = re.compile(f"[{ODD_BLANKS}]")
_MARKED = re.compile(f"[^\\W\\d_][{MARKS}]+")
_FOREIGN = re.compile(f"[{GREEK}{CYRILLIC}{OTHER}]")
LETTERS = re.compile("[^\\W\\d_]+")
_LATIN = re.compile("[A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u1e00-\u1eff]")
_GREEK = re.compile(f"[{GREEK}]")
_CYRILLIC = re.compile(f"[{CYRILLIC}]")
_OTHER = re.compile(f"[{OTHER}]")
#: Letters of two scripts side by side; without such a place no word mixes scripts.
_SEAM = re.compile(f"{_LATIN.pattern}[{GREEK}{CYRILLIC}{OTHER}]|[{GREEK}{CYRILLIC}{OTHER}]{_LATIN.pattern}|[{GREEK}][{CYRILLIC}{OTHER}]|[{CYRILLIC}][{GREEK}{OTHER}]|[{OTHER}][{GREEK}{CYRILLIC}]")
WORD = re.compile("[^\\W_]+")

KINDS = ("wide", "composable", "invisible", "blank", "mixed_script")


def _plain(m: re.Match) -> str:
    return unicodedata.normalize("NFKC", m[0])


def _compose(m: re.Match) -> str:
    return unicodedata.normalize("NFC", m[0])


def composable(text: str) -> bool:
    """Whether a letter and a mark stand in it for which one character exists."""
    return any(len(unicodedata.normalize("NFC", s)) < len(unicodedata.normalize("NFD", s)) and unicodedata.normalize("NFC", s) != s for s in _MARKED.findall(text))


def scripts(word: str) -> tuple[int, int, int, int]:
    """Number of Latin, Greek and Cyrillic letters, and of those of the other scripts."""
    return len(_LATIN.findall(word)), len(_GREEK.findall(word)), len(_CYRILLIC.findall(word)), len(_OTHER.findall(word))


def dominant_script(word: str) -> str:
    """``latin``, ``greek``, ``cyrillic`` or ``other``: that of most letters without a twin in another script; ties go to the most letters, then to Latin."""
    counts = scripts(word)
    own = (
        sum(c not in TO_CYRILLIC and c not in TO_GREEK for c in _LATIN.findall(word)),
        sum(c not in TO_LATIN for c in _GREEK.findall(word)),
        sum(c not in TO_LATIN for c in _CYRILLIC.findall(word)),
        sum(c not in TO_LATIN for c in _OTHER.findall(word)),
    )
    best = max(range(4), key=lambda i: (own[i], counts[i], -i))
    return ("latin", "greek", "cyrillic", "other")[best]


def repaired(word: str) -> str | None:
    """A mixed-script word in its dominant script; None where it isn't mixed or a letter has no twin there."""
    if sum(n > 0 for n in scripts(word)) < 2:
        return None
    script = dominant_script(word)
    if script == "other":
        return None
    twins = {"latin": TO_LATIN, "greek": TO_GREEK, "cyrillic": TO_CYRILLIC}[script]
    own = {"latin": _LATIN, "greek": _GREEK, "cyrillic": _CYRILLIC}[script]
    out = "".join(c if own.match(c) else twins.get(c, c) for c in word)
    return out if sum(n > 0 for n in scripts(out)) == 1 else None


def simple_fold(text: str) -> str:
    """All of ``fold`` but the look-alike letters."""
    if not SUSPECT.search(text):
        return text
    text = _WIDE.sub(_plain, text)
    if "\u200d" in text:  # the joiner inside an emoji is part of it
        text = _EMOJI_JOINER.sub("\ue000", text)
        text = _INVISIBLE.sub("", text).replace("\ue000", "\u200d")
    else:
        text = _INVISIBLE.sub("", text)
    text = _BLANK.sub(" ", text)
    return _MARKED.sub(_compose, text)


def fold(text: str) -> str:
    if not SUSPECT.search(text):
        return text
    text = simple_fold(text)
    if _SEAM.search(text):
        text = LETTERS.sub(lambda m: (_FOREIGN.search(m[0]) and repaired(m[0])) or m[0], text)
    return text


def kinds_of(text: str) -> list[str]:
    """Which of KINDS stand in the text."""
    if not SUSPECT.search(text):
        return []
    bare = _INVISIBLE.sub("", text)
    out = []
    if _WIDE.search(text):
        out.append("wide")
    if composable(_WIDE.sub(_plain, bare)):
        out.append("composable")
    if _INVISIBLE.search(_EMOJI_JOINER.sub("", text)):
        out.append("invisible")
    if _BLANK.search(text):
        out.append("blank")
    if _FOREIGN.search(text) and mixed_words(simple_fold(text)):
        out.append("mixed_script")
    return out


def mixed_words(text: str) -> list[str]:
    """Words with letters of more than one script, among them Latin ones."""
    return [w for w in LETTERS.findall(text) if _FOREIGN.search(w) and _LATIN.search(w)] if _SEAM.search(text) else []


def words(text: str) -> list[str]:
    """Runs of letters or digits, in lower case, after ``fold``."""
    return WORD.findall(fold(text).lower())
