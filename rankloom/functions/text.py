"""Text normalisation and naming as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Latin letters with one base letter, by Unicode's own decompositions (U+00C0 to U+024F)."""
    source, target = [], []
    for i in range(0xC0, 0x250):
        base = [c for c in unicodedata.normalize("NFKD", chr(i)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0] != chr(i):
            source.append(chr(i))
            target.append(base[0])
    return "".join(source), "".join(target)


_FROM, _TO = _accent_table()
_MARKS = r"\p{Mn}+"
_BLANKS = r"[\s   -     　\u000B\u001C-\u001F\u0085]+"


def strip_accents(c: Column, compatibility: bool = False) -> Column:
    """Letters without their marks; with compatibility also the ordinal signs become a and o. Texts of ASCII alone,
    which have as many bytes as characters, stay as they are."""
    plain = F.regexp_replace(F.translate(c, _FROM, _TO), _MARKS, "")
    plain = F.translate(plain, "ªº", "ao") if compatibility else plain
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(plain)


def squeeze(c: Column) -> Column:
    """Runs of any white space, no-break spaces with them, to one blank; none at the ends. Null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _BLANKS, " "))


def folded(c: Column, compatibility: bool = False) -> Column:
    """The matching form: no accents, lower case, squeezed."""
    return squeeze(F.lower(strip_accents(F.coalesce(c.cast("string"), F.lit("")), compatibility)))


def identity_key(c: Column) -> Column:
    """A person's key: upper case letters A-Z and digits only; the abbreviation of María is written out."""
    upper = F.upper(F.coalesce(c.cast("string"), F.lit("")))
    spelled = F.regexp_replace(upper, r"M\.?ª", " MARIA ")
    return F.trim(F.regexp_replace(strip_accents(spelled, True), "[^A-Z0-9]+", " "))


def compact_key(c: Column) -> Column:
    return F.replace(identity_key(c), F.lit(" "))


def token_key(c: Column) -> Column:
    """The words of an identity in alphabetical order."""
    return F.array_join(F.array_sort(F.split(identity_key(c), " ")), " ")


def header_key(c: Column) -> Column:
    """A table header's name: letters and digits of the folded text."""
    return F.regexp_replace(folded(c, True), "[^a-z0-9]+", "")


# Letters that a wrong code page has put in place of accented vowels, and these.
WRONG_LETTERS, RIGHT_LETTERS = "ŔČŇŮ", "ÀÈÒÚ"


def repaired(c: Column) -> Column:
    return F.translate(c, WRONG_LETTERS, RIGHT_LETTERS)


def official_name(c: Column) -> Column:
    return F.regexp_replace(squeeze(repaired(c)), r"\s+,", ",")


def zero_is_blank(c: Column) -> Column:
    return F.when(squeeze(c) == "0", "").otherwise(squeeze(c))


# Words that centre names write in a form of their own, names of rulers, articles of place names.
ACRONYMS = ("CEIP", "CEP", "CEE", "CRA", "IES", "CIPFP", "CFPA", "FPA", "EOI", "EI", "FP")
LINKING = ("de", "del", "dels", "i", "y")
NUMERALS = ("II", "III", "IV", "VI", "VII", "VIII", "IX", "XI", "XII")
RULERS = ("Jaume", "Jaime", "Joan", "Juan", "Alfons", "Alfonso", "Carles", "Carlos", "Enric", "Enrique", "Lluís", "Luis")
PLACE_ARTICLES = ("El", "La", "Los", "Las", "Els", "Les")

_WORD = r"[\p{L}\p{M}\p{N}_]"
_FORMS = {w.lower(): w for w in (*ACRONYMS, *LINKING, *NUMERALS)}


def _capitals(word: Column) -> Column:
    """Every run of letters in a word begins with a capital; digits part runs, so 3a is 3A but 1er stays 1er."""
    runs = F.regexp_extract_all(word, F.lit(r"([^\p{L}\p{M}]+|[\p{L}\p{M}]+)"), F.lit(1))
    cased = F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 2147483647))), "")
    return F.regexp_replace(cased, "1Er", "1er")


def _words(c: Column) -> Column:
    """Words and what stands between them, in turn, as one array."""
    return F.regexp_extract_all(F.lower(squeeze(c)), F.lit(f"({_WORD}+|(?:(?!{_WORD}).)+)"), F.lit(1))


def title_case(c: Column) -> Column:
    """Capitals after everything that is no letter."""
    return F.array_join(F.transform(_words(c), _capitals), "")


def smart_title(c: Column) -> Column:
    """Title case with the conventions of centre names. A word's form depends on the word and on what stands before and
    after it: acronyms and numerals in capitals, linking words small, d' with a small letter and l' with a capital one,
    a ruler's number 'i' as a numeral, the second half of a geminate l small."""

    def form(tokens: Column, word: Column, at: Column) -> Column:
        near = lambda step: F.coalesce(F.get(tokens, at + step), F.lit(""))
        before, earlier, after = near(-1), near(-2), near(1)
        usual = F.coalesce(lookup(_FORMS, word), _capitals(word))
        joined = lambda head, mark: (before == mark) & (earlier == head)
        return (
            F.when((word == "i") & (F.trim(before) == "") & earlier.isin(*[r.lower() for r in RULERS]), "I")
            .when(joined("d", "'"), lower_first(usual))
            .when(joined("l", "'"), upper_first(usual))
            .when((before == "·") & (earlier == "col") & word.startswith("legi"), word)
            .when((word == "d") & after.startswith("'") & (F.length(after) == 1) & (F.size(tokens) > at + 2), "d")
            .when((word == "pub") & (after == ".") & (F.size(tokens) > at + 2), "Púb")
            .otherwise(usual)
        )

    # The outer lambda binds the words, which would be cut anew for each of them otherwise.
    said = F.transform(F.array(_words(c)), lambda tokens: F.array_join(F.transform(tokens, lambda w, i: form(tokens, w, i)), ""))
    return F.get(said, F.lit(0))


def lookup(mapping: dict[str, str], c: Column) -> Column:
    """A small fixed mapping; null where it has no entry."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), c)


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 2147483647))


def lower_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 2147483647))


def display_place(c: Column) -> Column:
    """As smart_title; an article in brackets at the end goes to the front, joined if it ends in an apostrophe."""
    text, tail = squeeze(c), r"(?iu)^(.+?) \((%s|l['’])\)$" % "|".join(a.lower() for a in PLACE_ARTICLES)
    article = F.lower(F.regexp_extract(text, tail, 2))
    name = smart_title(F.regexp_extract(text, tail, 1))
    return F.when(article == "", smart_title(text)).when(F.substring(article, 2, 1).isin("'", "’"), F.concat(F.lit("L'"), upper_first(name))).otherwise(F.concat_ws(" ", upper_first(article), name))


def display_name(c: Column) -> Column:
    """'SURNAMES, GIVEN' as 'Given Surnames'."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    surnames, given = F.substring_index(c, ",", 1), F.substring(c, F.instr(c, ",") + 1, F.lit(2147483647))
    return title_case(F.when(F.instr(c, ",") > 0, F.concat_ws(" ", F.trim(given), F.trim(surnames))).otherwise(surnames))
