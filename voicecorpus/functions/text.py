"""Text functions as Column -> Column: cleaning, sentences, tokens, spoken forms, distances."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

CAPITALS = "A-ZÄÖÜÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ"
TOKEN_LETTERS = CAPITALS + "a-z0-9á-ž"
OPENERS = rf"""["„«»(\[0-9{CAPITALS}]"""
TOKEN = r"[Á-Žá-žA-Za-z0-9]+"
#: Shortened words after which a full stop ends no sentence, by length.
NO_STOP = {
    2: "aj bc dr fa ph sb sl sv tj tř ul př pí čl kč mj".split(),
    3: "cca csc doc hod ing kap mgr mil min mld nám obr odst popř roč sec str tab tis tzn tzv viz zák čís apod atd např resp kupř písm stol".split(),
    4: "drsc judr mudr phdr prof rndr rsdr thdr paeddr".split(),
}
_DOTTED = """
aj = a jiné
apod = a podobně
atd = a tak dále
hod = hodin
kap = kapitola
kupř = kupříkladu
mil = milionů
min = minut
mj = mimo jiné
mld = miliard
např = například
obr = obrázek
odst = odstavec
popř = popřípadě
resp = respektive
roč = ročník
str = strana
tab = tabulka
tis = tisíc
tj = to jest
tzn = to znamená
tzv = takzvaný
č = číslo
čís = číslo
"""
#: Spoken forms of shortened words that end in a stop.
DOTTED = dict(line.split(" = ") for line in _DOTTED.strip().splitlines())
#: Of those that have none.
UNDOTTED = {"viz": "viz", "cca": "cirka"}


#: Unicode's White_Space, what (?U)\s stands for.
WHITE = "\t\n\x0b\f\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``c``, evaluated once however often ``f`` names it."""
    return F.transform(F.array(c), f)[0]


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.trim(c, F.lit(WHITE))


def _single_blanks(c: Column) -> Column:
    """Runs of blanks and tabs as one blank; blanks that stand alone are not matched."""
    return F.regexp_replace(c, "[ \t]{2,}|\t", " ")


def clean_text(c: Column) -> Column:
    """No-break spaces, runs of blanks, ellipses and dashes in one plain form."""
    c = _single_blanks(F.replace(c, F.lit("\u00a0"), F.lit(" ")))
    for a, b in (("…", "..."), ("–", "-"), ("—", "-")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return strip(c)


def paragraphs(c: Column) -> Column:
    """Blocks between blank lines, each on one line, empty ones left out."""
    lines = F.array_join(F.transform(F.split(c, "\n"), strip), "\n")
    one = lambda b: _single_blanks(F.replace(strip(b), F.lit("\n"), F.lit(" ")))
    return F.filter(F.transform(F.split(lines, "\n\n+"), one), lambda p: p != "")


_SHORT_BACKWARDS = "|".join(sorted((w[::-1] for ws in NO_STOP.values() for w in ws), key=lambda w: (-len(w), w)))


def _settled(pieces: Column) -> Column:
    """A paragraph of its pieces, which end at stops that may end sentences, with U+0001 after those
    that do: not after shortened words and initials, nor after numbers that no capital follows.

    What stands before a piece's last full stops is read backwards from its end, so that nothing
    is searched; a run with ! ? or … is out of reach of this, as only full stops are passed."""
    word, number = rf"(?iu)^\.+(?:{_SHORT_BACKWARDS}|[{CAPITALS}a-zá-ž])(?![{TOKEN_LETTERS}])", rf"(?iu)^\.+[0-9]+(?![{TOKEN_LETTERS}])"

    def end(p: Column, i: Column) -> Column:
        after = F.get(pieces, i + 1)
        on = lambda r: r.rlike(word) | (r.rlike(number) & ~after.rlike(rf"^(?U:\s+)[{CAPITALS}]"))
        goes_on = p.endswith(".") & _bound(F.reverse(p), on)
        return F.when(after.isNull() | goes_on, p).otherwise(F.concat(p, F.lit("\u0001")))

    return F.array_join(F.transform(pieces, end), "")


def sentences(c: Column) -> Column:
    """Array of a text's sentences, in order."""
    stops = rf"([.!?…]+)(?=(?U:\s+){OPENERS})(?![.!?…])"
    pieces = F.transform(paragraphs(c), lambda p: F.split(F.regexp_replace(p, stops, "$1\u0001"), "\u0001"))
    parts = F.flatten(F.transform(pieces, lambda x: F.split(_settled(x), "\u0001")))
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def words(c: Column) -> Column:
    """Array of a text's tokens as they stand."""
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def tokenize(c: Column) -> Column:
    return F.transform(words(c), F.lower)


@lru_cache(1)
def _fold_table() -> tuple[str, str]:
    """Precomposed Latin letters and what they are without marks."""
    src, dst = [], []
    for i in range(0xC0, 0x250):
        d = "".join(x for x in unicodedata.normalize("NFKD", chr(i)) if not unicodedata.combining(x))
        if len(d) == 1 and d != chr(i):
            src.append(chr(i))
            dst.append(d)
    return "".join(src), "".join(dst)


def fold(c: Column) -> Column:
    """Lower case without marks, for Latin letters; stays in generated code."""
    return F.regexp_replace(F.translate(F.lower(c), *_fold_table()), r"\p{Mn}", "")


@F.pandas_udf(StringType())
def fold_exact(s: pd.Series) -> pd.Series:
    """Lower case, compatibility decomposition, without combining marks."""
    one = lambda t: "".join(x for x in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(x))
    return s.map(one, na_action="ignore")


def fold_text(c: Column) -> Column:
    """Folded letters and digits with single spaces."""
    return strip(F.regexp_replace(F.regexp_replace(fold(c), r"[^\p{L}\p{N}\s]", ""), r"(?U)\s+", " "))


def distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel (Myers 1999): the longer text lies in the bits of whole
    numbers, so a step for each letter of the shorter one takes all of it at once."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), "<u4")
    at = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(b)}
    n = len(codes)
    full = (1 << n) - 1
    up, down, d = full, 0, n
    for c in b:
        eq = at[c]
        v, h = eq | down, (((eq & up) + up) ^ up) | eq
        more, less = down | (full & ~(h | up)), up & h
        d += (more >> (n - 1)) - (less >> (n - 1))
        more, less = ((more << 1) | 1) & full, (less << 1) & full
        up, down = less | (full & ~(v | more)), more & v
    return d


@F.pandas_udf(IntegerType())
def edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """``distance`` of two columns; null where either is."""
    return pd.Series([None if x is None or y is None else distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate of folded texts; null for an empty reference."""
    ref = fold_text(reference)
    return F.when(F.length(ref) > 0, edit_distance(ref, fold_text(hypothesis)) / F.length(ref))


def _by_length(words: dict) -> list[str]:
    return sorted(words, key=lambda w: (-len(w), w))


def _in_turn(c: Column) -> Column:
    """Each shortened word replaced after the other, the longest first."""
    for key in _by_length(DOTTED):
        form = DOTTED[key]
        c = F.regexp_replace(c, rf"(?U)\b{key[0].upper()}(?iu:{key[1:]})\.", form[0].upper() + form[1:])
        c = F.regexp_replace(c, rf"(?U)\b{key[0]}(?iu:{key[1:]})\.", form)
    for key, form in UNDOTTED.items():
        c = F.regexp_replace(c, rf"(?U)\b{key[0].upper()}(?iu:{key[1:]})\b", form[0].upper() + form[1:])
        c = F.regexp_replace(c, rf"(?U)\b{key[0]}(?iu:{key[1:]})\b", form)
    return c


def expand_abbreviations(c: Column) -> Column:
    """Spoken forms of shortened words; a capital first letter stays one.

    A text is split at all of them at once and joined with their forms.  Only where one
    follows another's stop without a blank does the order in which they are replaced show
    (a form ends in a letter, so what stood at a word's begin may not any more); such texts
    are worked on word by word.  Texts in which none can stand, read backwards from their
    stops, stay as they are."""
    dotted, bare = "|".join(_by_length(DOTTED)), "|".join(_by_length(UNDOTTED))
    some = rf"(?U)\b(?iu:{dotted})\.|\b(?iu:{bare})\b"
    close = rf"(?U)\b(?iu:{dotted})\.(?iu:{dotted}|{bare})(?:\.|\b)"
    backwards = "|".join(w[::-1] for w in _by_length(DOTTED))
    forms = F.create_map(*[F.lit(x) for kv in {**DOTTED, **UNDOTTED}.items() for x in kv])

    def spoken_form(w: Column) -> Column:
        key = F.rtrim(w, F.lit("."))
        form = F.element_at(forms, F.lower(key))
        first = F.substring(w, 1, 1)
        return F.when(first == F.lower(first), form).otherwise(F.concat(F.upper(F.substring(form, 1, 1)), F.substring(form, 2, 100)))

    def expanded(c: Column) -> Column:
        found = F.transform(F.regexp_extract_all(c, F.lit(f"({some})"), 1), spoken_form)
        parts = F.zip_with(F.split(c, some, -1), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.when(F.reverse(c).rlike(rf"(?iu)\.(?:{backwards})") | c.rlike(rf"(?iu){bare}"), F.when(c.rlike(close), _in_turn(c)).otherwise(F.array_join(parts, ""))).otherwise(c)

    return _bound(c, expanded)


ONES = "jedna dva tři čtyři pět šest sedm osm devět deset jedenáct dvanáct třináct čtrnáct patnáct šestnáct sedmnáct osmnáct devatenáct".split()
TENS = "dvacet třicet čtyřicet padesát šedesát sedmdesát osmdesát devadesát".split()
HUNDREDS = ["sto", "dvě stě", *(f"{w} sta" for w in ("tři", "čtyři")), *(f"{w} set" for w in ("pět", "šest", "sedm", "osm", "devět"))]
SCALES = [("tisíc", "tisíce", "tisíc"), ("milion", "miliony", "milionů"), ("miliarda", "miliardy", "miliard")]


@lru_cache(2)
def _below_thousand(alone: bool) -> list[str]:
    """Words of 0 to 999; before a scale word 1 has none."""
    out = []
    for n in range(1000):
        h, r = divmod(n, 100)
        w = [HUNDREDS[h - 1]] * (h > 0)
        if r >= 20:
            w += [TENS[r // 10 - 2], *([ONES[r % 10 - 1]] if r % 10 else [])]
        elif r and (alone or n > 1):
            w.append(ONES[r - 1])
        out.append(" ".join(w))
    return out


def number_words(n: Column) -> Column:
    """Czech cardinal of 0 to 10^12 - 1; null outside."""
    n = n.cast("long")
    parts = []
    for k in (3, 2, 1, 0):
        x = (F.floor(n / 1000**k) % 1000).cast("int")
        # a constant array: one look-up in generated code
        w = F.element_at(F.array(*[F.lit(t) for t in _below_thousand(k == 0)]), x + 1)
        if k:
            few = (x % 10).between(2, 4) & ~(x % 100).between(10, 20)
            one, some, many = SCALES[k - 1]
            w = F.concat_ws(" ", F.nullif(w, F.lit("")), F.when(x == 1, one).when(few, some).otherwise(many))
        parts.append(F.when(x > 0, w))
    return F.when(n == 0, "nula").when((n > 0) & (n < 10**12), F.concat_ws(" ", *parts))


def spoken(n: int) -> str:
    """The same as ``number_words`` of any size, for numbers inside texts."""
    if n == 0:
        return "nula"
    if n >= 10**12:
        return str(n)
    out: list[str] = []
    for k in (3, 2, 1, 0):
        x = n // 1000**k % 1000
        if not x:
            continue
        out += [w] if (w := _below_thousand(k == 0)[x]) else []
        if k:
            out.append(SCALES[k - 1][0 if x == 1 else 1 if 2 <= x % 10 <= 4 and not 10 <= x % 100 <= 20 else 2])
    return " ".join(out)


_NUMBER = re.compile("([0-9]{1,3}(?:[ \u00a0.][0-9]{3})+|[0-9]+)(?:,([0-9]+))?")


@F.pandas_udf(StringType())
def expand_numbers(s: pd.Series) -> pd.Series:
    """Numbers in a text in words; thousands may be set apart by blanks or stops."""

    def one(m: re.Match) -> str:
        whole = spoken(int(re.sub(r"[^0-9]", "", m[1])))
        return f"{whole} celá {spoken(int(m[2]))}" if m[2] else whole

    return s.map(lambda t: _NUMBER.sub(one, t), na_action="ignore")


def normalize(c: Column, numbers: bool = True) -> Column:
    """Cleaned, with spoken forms of shortened words and numbers, single-spaced."""
    c = expand_abbreviations(clean_text(c))
    return strip(F.regexp_replace(expand_numbers(c) if numbers else c, r"(?U)\s{2,}|[\s&&[^ ]]", " "))


def sentence_id(book: Column, order: Column) -> Column:
    return F.format_string("%s_s%05d", book, order)


def clip_id(chapter: Column, idx: Column) -> Column:
    return F.format_string("%s_%04d", chapter, idx)


def xml_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def last_json_block(c: Column) -> Column:
    """The text from the last { to the last } after it; null without."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{[^{}]*\})[^}]*$", 1), F.lit(""))


def flags_text(flags: Column) -> Column:
    return F.array_join(flags, "|")


def flags_array(text: Column) -> Column:
    return F.filter(F.split(text, r"\|"), lambda x: x != "")


def stem(path: Column) -> Column:
    """A file's name without folders and its last ending."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
