"""Join keys made from person and club names."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Letters that have no Unicode decomposition, as usually romanised.
SINGLE_LETTERS = {"ł": "l", "ø": "o", "đ": "d", "ı": "i", "ħ": "h", "ŧ": "t", "ð": "d", "ĸ": "k"}
DOUBLE_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng", "ĳ": "ij"}

# Name particles skipped when taking the first and last word of a name.
NAME_PARTICLES = ["de", "del", "da", "do", "das", "dos", "la", "las", "los", "san", "santa", "club", "atletico"]

# Canonical club -> other spellings seen in the sources.
CLUB_SPELLINGS = {
    "boca juniors": ["boca"],
    "river plate": ["river"],
    "racing club": ["racing", "racing avellaneda"],
    "independiente": [],
    "san lorenzo": ["san lorenzo de almagro"],
    "velez sarsfield": ["velez", "velez sarfield"],
    "lanus": [],
    "huracan": [],
    "argentinos juniors": ["argentinos"],
    "estudiantes lp": ["estudiantes de la plata", "estudiantes"],
    "gimnasia lp": ["gimnasia la plata", "gimnasia"],
    "newells old boys": ["newell s old boys", "newells"],
    "rosario central": [],
    "talleres": ["talleres de cordoba"],
    "banfield": [],
    "defensa y justicia": ["defensa y just"],
    "godoy cruz": [],
    "platense": [],
    "sarmiento": [],
    "barracas central": [],
    "central cordoba sde": ["central cordoba"],
    "tigre": [],
    "union": ["union santa fe"],
    "atletico tucuman": [],
    "belgrano": [],
    "instituto": [],
    "independiente rivadavia": [],
    "deportivo riestra": [],
}

_UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


@cache
def _accent_table() -> tuple[str, str]:
    """Characters with a one-letter or empty ASCII decomposition, and their replacements, for ``translate``.

    ``translate`` deletes characters beyond the end of the replacement text, so those that vanish come last.
    """
    kept, gone = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        plain = unicodedata.normalize("NFKD", char)
        if plain == char and not unicodedata.combining(char):
            continue
        ascii_part = "".join(c for c in plain if ord(c) < 128)
        if len(ascii_part) == 1:
            kept.append((char, ascii_part))
        elif not ascii_part and unicodedata.combining(char):
            gone.append(char)
    return "".join(c for c, _ in kept) + "".join(gone), "".join(p for _, p in kept)


def strip_accents(c: Column) -> Column:
    """Replace accented letters by plain ones and drop combining marks, inside the JVM."""
    source, target = _accent_table()
    return F.translate(c, source, target)


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def romanise(c: Column) -> Column:
    """Lower-case Latin text: accents removed, letters such as ł, ø, ß spelled out, other scripts dropped.

    Plain ASCII text, the usual case, is only lower-cased.
    """
    source, target = _accent_table()
    singles = "".join(SINGLE_LETTERS), "".join(SINGLE_LETTERS.values())
    text = F.translate(F.lower(c), singles[0] + source, singles[1] + target)
    for letter, spelled in DOUBLE_LETTERS.items():
        text = F.replace(text, F.lit(letter), F.lit(spelled))
    return F.when(_is_ascii(c), F.lower(c)).otherwise(F.regexp_replace(text, r"[^\x00-\x7F]", ""))


@cache
def _expansions() -> tuple[str, dict[str, str]]:
    """Characters beyond ``_accent_table`` (ligatures, fractions, units, letters of other planes) with their ASCII parts,
    and a character class that finds them: runs of neighbours, and ASCII is told by the first look."""
    found, runs = {}, []
    for code in [*range(0x80, 0xD800), *range(0xE000, 0x20000)]:
        parts = "".join(p for p in unicodedata.normalize("NFKD", chr(code)) if p.isascii())
        if len(parts) > 1 or parts and code >= 0x10000:
            found[chr(code)] = parts
            if runs and runs[-1][1] == code - 1:
                runs[-1][1] = code
            else:
                runs.append([code, code])
    return "[\\x{80}-\\x{1FFFF}&&[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]]", found


# The stand-ins that ``translate`` gives the characters to be expanded count upwards from here.
_STAND_INS = 0x3400


def _expanded(c: Column) -> Column:
    """Each character that stands for several ASCII ones, as these; texts without any are passed as they are.

    A text is cut before these characters only. ``translate`` finds the number of such a character by hashing, whatever the
    length of the table, and its ASCII parts stand at that place of an array.
    """
    pattern, table = _expansions()
    stand_ins = "".join(chr(_STAND_INS + i) for i in range(len(table)))
    spelled = F.array(*[F.lit(parts) for parts in table.values()])
    place = lambda piece: F.ascii(F.translate(F.substring(piece, 1, 1), "".join(table), stand_ins)) - _STAND_INS
    # a piece begins with such a character or has none
    rest = lambda piece: F.substring(piece, F.lit(2), F.length(piece))
    written = lambda piece: F.when(F.rlike(piece, F.lit(f"^{pattern}")), F.concat(F.get(spelled, place(piece)), rest(piece))).otherwise(piece)
    pieces = F.split(c, f"(?={pattern})")
    return F.when(F.rlike(c, F.lit(pattern)), F.array_join(F.transform(pieces, written), "")).otherwise(c)


def name_key(c: Column, spell_out: bool = True, expand: bool = False) -> Column:
    """The merge key of a player name: printable ASCII, single blanks, lower case; null gives ``""``.

    ``spell_out=False`` drops letters without a decomposition (ł, ø, ß) instead of spelling them out. ``expand`` also
    writes out ligatures, fractions and other characters that stand for several.
    """
    text = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _UNPRINTABLE, "")
    if expand:
        # the one-element array binds the text, so that it is cleaned once per row
        text = F.element_at(F.transform(F.array(text), _expanded), 1)
    if spell_out:
        text = romanise(text)
    else:
        text = F.lower(F.regexp_replace(strip_accents(text), r"[^\x00-\x7F]", ""))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def match_text(c: Column) -> Column:
    """Name or club text for matching: the romanised words outside brackets, without "club atletico" and "c.a."."""

    def matched(text: Column) -> Column:
        plain = F.trim(F.regexp_replace(text, r"[^a-z0-9]+", " "))
        return F.when(F.rlike(text, F.lit(_NEEDS_CARE)), _careful_words(text)).otherwise(plain)

    # the one-element array binds the text, so that it is romanised once per row
    return F.element_at(F.transform(F.array(romanise(F.coalesce(c.cast("string"), F.lit("")))), matched), 1)


# Texts without any of these are nothing but words.
_NEEDS_CARE = r"\(|\bc(?:lub|\.?a)\b"
# A part in brackets, or a word with the dots inside and behind it.
_BRACKET_OR_WORD = r"\([^)]*\)|[a-z0-9][a-z0-9.]*"


def _careful_words(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(_BRACKET_OR_WORD), 0)
    words = F.flatten(F.transform(F.filter(found, lambda w: ~w.startswith("(")), _spelled_apart))
    return F.array_join(F.element_at(F.transform(F.array(words), _without_club_prefix), 1), " ")


def _next_to(words: Column, i: Column, step: int, word: str) -> Column:
    return F.get(words, i + step).eqNullSafe(F.lit(word))


def _spelled_apart(word: Column) -> Column:
    """The parts of a word between its dots; "ca" and "c.a" become an empty part."""
    parts = F.split(word, r"\.")

    def kept(p: Column, i: Column) -> Column:
        initials = ((p == "c") & _next_to(parts, i, 1, "a")) | ((p == "a") & _next_to(parts, i, -1, "c"))
        return F.when((p == "ca") | initials, "").otherwise(p)

    return F.when(word == "ca", F.array(F.lit(""))).when(F.contains(word, F.lit(".")), F.transform(parts, kept)).otherwise(F.array(word))


def _without_club_prefix(words: Column) -> Column:
    """Words that are not empty, without each "club" that "atletico" follows and that "atletico"."""

    def kept(w: Column, i: Column) -> Column:
        prefix = ((w == "club") & _next_to(words, i, 1, "atletico")) | ((w == "atletico") & _next_to(words, i, -1, "club"))
        return (w != "") & ~prefix

    return F.filter(words, kept)


def first_last(c: Column) -> Column:
    """First and last word of a normalised name, particles skipped; one word stands alone."""
    words = F.filter(F.split(c, " "), lambda w: ~w.isin(*NAME_PARTICLES) & (w != ""))

    def ends(w: Column) -> Column:
        both = F.concat_ws(" ", F.element_at(w, 1), F.element_at(w, -1))
        return F.when(F.size(w) == 0, c).when(F.size(w) == 1, F.element_at(w, 1)).otherwise(both)

    # the one-element array binds the word list, so that it is made once per row
    return F.element_at(F.transform(F.array(words), ends), 1)


def club_key(c: Column, spellings: dict[str, list[str]] | None = None) -> Column:
    """Canonical club: the spelling table where it applies, else the normalised text.

    Spellings are written as ``match_text`` leaves them, so that no prefix or accent has to be listed.
    """
    table = CLUB_SPELLINGS if spellings is None else spellings
    known = match_text(c)
    pairs = {spelling: club for club, others in table.items() for spelling in others}
    if not pairs:
        return known
    lookup = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, known), known)


def is_goalkeeper_text(pos: Column) -> Column:
    """Position text mentions GK anywhere, in any case; null counts as no."""
    return F.coalesce(F.upper(pos).contains("GK"), F.lit(False))


def is_goalkeeper_token(pos: Column) -> Column:
    """GK is one of the comma-separated positions; null stays null."""
    return F.array_contains(F.transform(F.split(pos, ","), lambda p: F.upper(F.trim(p))), "GK")
