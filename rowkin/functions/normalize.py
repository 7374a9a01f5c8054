"""Normalization of names and addresses, as expressions over built-in functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ABBREVIATIONS, LEGAL_WORDS, WEB_ADDRESS

#: Letters that fold to more than one letter.
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "Æ": "AE", "Œ": "OE", "Þ": "Th"}
#: Letters with a stroke, which have no decomposition.
STROKES = {"ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ı": "i", "ð": "d", "Ø": "O", "Đ": "D", "Ł": "L", "Ħ": "H", "Ð": "D"}


def _latin() -> tuple[str, str]:
    """Accented letters of the Latin blocks and the letter each folds to, by their decomposition."""
    known = dict(STROKES)
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(point))[0]
        if base.isascii() and base.isalpha() and base != chr(point):
            known[chr(point)] = base
    return "".join(known), "".join(known.values())


LATIN = _latin()


# Fixed values. Letters of scripts whose Unicode names do not spell their sound.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяёђѓєѕіїјљњћќўџґ", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e yu ya yo dj gj ie dz i yi j lj nj c kj u dzh g".split()))
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
ARABIC = dict(zip("ءابتثجحخدذرزسشصضطظعغفقكلمنهويىةپچژگکی", "' a b t th j h kh d dh r z s sh s d t z ` gh f q k l m n h w y a h p ch zh g k y".split()))
HEBREW = dict(zip("אבגדהוזחטיךכלםמןנסעףפץצקרשת", "' b g d h v z h t y k k l m m n n s ` p p ts ts q r sh t".split()))
INDIC = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")
HANGUL = ("g gg n d dd r m b bb s ss  j jj c k t p h".split(" "), "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(), " g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split(" "))


def romanized(c: str) -> str | None:
    """A letter or sign of another script in ASCII; None if there is no rule for it.

    Accents are taken off first. Indic letters and signs, and kana, read as their Unicode names say: a consonant without the
    vowel that goes with it, a vowel sign as its vowel.
    """
    base = unicodedata.normalize("NFD", c.lower())
    known = next((t[base[0]] for t in (CYRILLIC, GREEK, ARABIC, HEBREW) if base[:1] in t), None)
    if c.lower() in CYRILLIC:
        known = CYRILLIC[c.lower()]
    if known is not None:
        return known
    if unicodedata.decimal(c, None) is not None:
        return str(unicodedata.decimal(c))
    name = unicodedata.name(c, "")
    script, _, rest = name.partition(" ")
    if script in INDIC:
        kind, _, sound = rest.rpartition(" ")
        if rest.startswith("SIGN"):
            return {"ANUSVARA": "n", "BINDI": "n", "TIPPI": "n", "CANDRABINDU": "n", "VISARGA": "h"}.get(sound, "")
        if kind.startswith(("LETTER", "VOWEL SIGN")):
            vowel = rest.startswith("VOWEL") or sound[:1] in "AEIOU" or "VOCALIC" in kind
            return sound.lower() if vowel else sound.lower().removesuffix("a")
    if script in ("HIRAGANA", "KATAKANA") and " LETTER " in f" {rest}":
        return rest.rsplit(" ", 1)[1].lower()
    plain = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii()).lower()
    return plain or ("" if unicodedata.combining(c) else None)


def _table(first: int, last: int) -> Column:
    """What each code point from ``first`` to ``last`` becomes, as one array that is made when the plan is."""
    made = [romanized(chr(i)) for i in range(first, last + 1)]
    return F.split(F.lit("|".join(" " if x is None or "|" in x else x for x in made)), r"\|")


def other_scripts(text: Column) -> Column:
    """``text`` with letters of other scripts in ASCII, by look-up of code points. Hangul syllables read as their parts; an ideograph
    is a word of its own, its number, as no rule says how it sounds; what else has none is a blank."""
    near, kana, forms, joined = _table(0xA0, 0xDFF), _table(0x3040, 0x30FF), _table(0x2070, 0x24FF), _table(0xFB00, 0xFB06)
    parts = [F.array(*map(F.lit, x)) for x in HANGUL]

    def one(c: Column) -> Column:
        i = F.ascii(c)
        syllable = i - 0xAC00
        hangul = F.concat(F.get(parts[0], F.floor(syllable / 588).cast("int")), F.get(parts[1], F.floor(syllable % 588 / 28).cast("int")), F.get(parts[2], (syllable % 28).cast("int")))
        return (
            F.when(i < 0x80, c)
            .when(i.between(0xA0, 0xDFF), F.get(near, i - 0xA0))
            .when(i.between(0x2070, 0x24FF), F.get(forms, i - 0x2070))
            .when(i.between(0xFB00, 0xFB06), F.get(joined, i - 0xFB00))
            .when(i.between(0xFF01, 0xFF5E), F.char(i - 0xFEE0))
            .when(i.between(0x3040, 0x30FF), F.get(kana, i - 0x3040))
            .when(i.between(0xAC00, 0xD7A3), hangul)
            .when(i.between(0x3400, 0x9FFF), F.concat(F.lit(" u"), F.lower(F.hex(i)), F.lit(" ")))
            .otherwise(F.lit(" "))
        )

    plane = F.regexp_replace(text, r"[\x{10000}-\x{10FFFF}]", " ")
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(plane, ""), one), "")).otherwise(text)


def ascii_fold(text: Column, scripts: str = "all") -> Column:
    """``text`` in ASCII, by built-in functions. 'latin' folds Latin letters and marks only; 'all' also reads other scripts."""
    out = F.translate(text, *LATIN)
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    if scripts == "all":
        out = other_scripts(F.regexp_replace(out, r"[\x{300}-\x{36F}]", ""))
    else:
        out = F.regexp_replace(out, r"\p{M}", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), out).otherwise(text)


def tokens(text: Column) -> Column:
    """The non-empty parts between single spaces."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def web_stem(text: Column) -> Column:
    """Web addresses replaced by the first label of their host, in blanks. Only texts with the end of one are searched for its start."""
    return F.when(text.rlike(r"[a-z0-9-]\.(?:com|net|org|in|fr|co)"), F.regexp_replace(text, WEB_ADDRESS, " $1 ")).otherwise(text)


#: A word that is spelled out or a number with a zero before it, somewhere; most texts have none, and are not taken apart.
_TO_SPELL = r"(?:^| )(?:0\d|(?:" + "|".join(ABBREVIATIONS) + r")(?: |$))"


def clean(text: Column, scripts: str = "all") -> Column:
    """Lower case, web addresses to stems, '&' spelled out, ASCII, words only; abbreviations spelled out, numbers without leading zeros. Null: ''."""
    out = F.replace(web_stem(F.lower(F.coalesce(text, F.lit("")))), F.lit("&"), F.lit(" and "))
    plain = F.btrim(F.regexp_replace(ascii_fold(out, scripts), r"[^\w]+", " "))
    spelled = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    longest = max(map(len, ABBREVIATIONS))
    number = lambda w: w.rlike("^[0-9]+$") & (F.length(w) < 12)
    one = lambda w: F.when(w.startswith("0"), F.when(number(w), w.cast("bigint").cast("string")).otherwise(w)).when(F.length(w) <= longest, F.coalesce(F.try_element_at(spelled, w), w)).otherwise(w)
    return F.when(plain.rlike(_TO_SPELL), F.array_join(F.transform(tokens(plain), one), " ")).otherwise(plain)


def core_name(name: Column) -> Column:
    """A normalized name without legal words, or the name itself if nothing else is left."""
    legal = F.array(*map(F.lit, LEGAL_WORDS))
    left = F.array_join(F.filter(tokens(name), lambda w: ~F.array_contains(legal, w)), " ")
    return F.when(left == "", name).otherwise(left)


def country_of(country: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(country, F.lit(""))), r"^\s+|\s+$", "")


def numbers(text: Column) -> Column:
    """All runs of digits, in order."""
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), 1)


def compact(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def records(raw: DataFrame, scripts: str = "all") -> DataFrame:
    """entity_id, name, address, country, core and the other columns of ``raw``. Missing fields are ''."""
    rest = [c for c in raw.columns if c not in ("entity_id", "business_name", "business_address", "country")]
    named = raw.select("entity_id", clean(F.col("business_name"), scripts).alias("name"), clean(F.col("business_address"), scripts).alias("address"), country_of(F.col("country")).alias("country"), *rest)
    return named.withColumn("core", core_name(F.col("name")))
