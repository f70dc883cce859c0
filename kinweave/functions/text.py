"""Text and identifier functions: Column -> Column, all evaluated in the JVM.

Unicode normalisation and case folding come from the ICU library that Spark
ships. Empty text means missing; the words `nan`, `null` and `na` are data.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
LEGAL_ALIASES = {"corporation": "corp", "limited": "ltd", "private": "pvt", "incorporated": "inc", "company": "co"}
LEGAL_SUFFIXES = ("corp", "ltd", "pvt", "inc", "co", "llc", "llp", "plc", "lp")
ACRONYM_SKIPPED = ("and", "the", "of")
ADDRESS_ALIASES = {"road": "rd", "street": "st", "avenue": "ave", "lane": "ln", "boulevard": "blvd", "drive": "dr", "court": "ct", "place": "pl", "highway": "hwy", "apartment": "apt", "suite": "ste", "floor": "fl", "building": "bldg", "number": "no"}
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Bengali", "Tamil", "Telugu", "Thai", "Han")

#: Every decimal digit of Unicode and its ASCII twin, by rule.
_DIGITS = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd" and c > 127]
_ASCII = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def text_value(c: Column, data_type: str = "string") -> Column:
    """'' for null, NaN and infinities, else the value as text."""
    if data_type in ("double", "float"):
        c = F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def nfkc(c: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))


def fold_case(c: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))


def normalize_text(c: Column) -> Column:
    """NFKC, case folding, & as a word, anything but letters, numbers and marks as a space, single spaces."""
    folded = F.replace(fold_case(nfkc(text_value(c))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(folded, r"[^\p{L}\p{N}\p{M}]", " "), r"\s+", " "))


def fold_diacritics(normalized: Column) -> Column:
    """Decomposed, without nonspacing marks."""
    return F.regexp_replace(F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), normalized, F.lit(False)), r"\p{Mn}", "")


def tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def _aliased(toks: Column, aliases: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.transform(toks, lambda t: F.coalesce(F.try_element_at(table, t), t))


def legal_name(normalized: Column) -> Column:
    return F.array_join(_aliased(tokens(normalized), LEGAL_ALIASES), " ")


def core_name(legal: Column) -> Column:
    """The legal name without its trailing legal forms; the whole name if nothing else is left."""
    core = F.trim(F.regexp_replace(legal, rf"(?:(?:^| )(?:{'|'.join(LEGAL_SUFFIXES)}))+$", ""))
    return F.when(core == "", legal).otherwise(core)


def number_tokens(normalized: Column) -> Column:
    """Sorted distinct numbers: runs of decimal digits of any script, without leading zeros."""
    runs = F.regexp_extract_all(normalized, F.lit(r"(\p{Nd}+)"), 1)
    return F.array_sort(F.array_distinct(F.transform(runs, lambda x: F.regexp_replace(F.translate(x, "".join(_DIGITS), _ASCII), "^0+(?=.)", ""))))


def acronym(legal: Column) -> Column:
    """First letters of the words that are neither legal forms nor and, the, of."""
    kept = F.filter(tokens(legal), lambda t: ~t.isin(*LEGAL_SUFFIXES, *ACRONYM_SKIPPED) & t.rlike(r"^\p{L}"))
    return F.array_join(F.transform(kept, lambda t: F.substring(t, 1, 1)), "")


def nonlatin(c: Column) -> Column:
    return c.rlike(r"[\p{L}&&[^\p{IsLatin}]]")


def is_ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def scripts(c: Column) -> Column:
    """The scripts of the letters, as a sorted array of upper-case names."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c.rlike(rf"\p{{Is{s}}}"), F.lit(s.upper())) for s in SCRIPTS])))


def split_digits(c: Column) -> Column:
    """A space at each boundary between a digit and a letter."""
    return F.regexp_replace(F.regexp_replace(c, r"(?<=\p{Nd})(?=\p{L})", " "), r"(?<=\p{L})(?=\p{Nd})", " ")


def alternate_view(romanized: Column) -> Column:
    """Aliased words, ordered numbers (repeats kept), and the text without numbers, as a struct."""
    toks = _aliased(tokens(split_digits(romanized)), ADDRESS_ALIASES | LEGAL_ALIASES)
    number = lambda t: t.rlike(r"^\p{Nd}+$")
    return F.struct(
        F.array_join(toks, " ").alias("text"),
        F.transform(F.filter(toks, number), lambda t: F.regexp_replace(F.translate(t, "".join(_DIGITS), _ASCII), "^0+(?=.)", "")).alias("numbers"),
        F.array_join(F.filter(toks, lambda t: ~number(t)), " ").alias("without_numbers"),
    )


def prepared(c: Column, name: bool) -> list[Column]:
    """normalized, folded, tokens, sorted_tokens, numbers, acronym, legal, core of one field."""
    n = normalize_text(c)
    legal = legal_name(n) if name else n
    return [n.alias("normalized"), fold_diacritics(n).alias("folded"), F.array_sort(F.array_distinct(tokens(n))).alias("tokens"), F.array_join(F.array_sort(tokens(n)), " ").alias("sorted_tokens"), number_tokens(n).alias("numbers"), (acronym(legal) if name else F.lit("")).alias("acronym"), legal.alias("legal"), (core_name(legal) if name else legal).alias("core")]


def romanize(df: DataFrame, col: str, out: str) -> DataFrame:
    """df with `out`: the normalised text; where it isn't ASCII, marks of Latin letters are folded. Letters of other scripts are kept; romanize_texts() transliterates bounded lists."""
    n = F.col(col)
    folded = fold_diacritics(n)
    for a, b in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ł", "l"), ("þ", "th"), ("ð", "d"), ("ı", "i")):
        folded = F.replace(folded, F.lit(a), F.lit(b))
    return df.withColumn(out, F.when(is_ascii(n), n).otherwise(F.trim(F.regexp_replace(folded, r"\s+", " "))))


def romanize_texts(spark: SparkSession, texts: list[str]) -> dict[str, str]:
    """Transliterations (Any-Latin; Latin-ASCII) of a bounded list, by ICU in the driver's JVM."""
    if len(texts) > 100_000:
        raise ValueError("romanize_texts() is for bounded lists; split the list")
    t = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII")
    return {x: t.transliterate(x) for x in texts}


# Identifiers: S<source>-<number>; a target's code is source * 10^12 + number.
CODE = 10**12


def numeric_id(entity_id: Column, source: Column | None = None) -> Column:
    """The number of a canonical id; raises on any other text, or on another source."""
    good = entity_id.rlike(r"\AS[123]-(?:0|[1-9][0-9]*)\z")
    if source is not None:
        good = good & (F.substring(entity_id, 2, 1).cast("int") == source)
    return F.when(good, F.regexp_extract(entity_id, r"-([0-9]+)$", 1).cast("long")).otherwise(F.raise_error(F.concat(F.lit("not a canonical id: "), F.coalesce(entity_id, F.lit("null")))).cast("long"))


def encode_target(entity_id: Column) -> Column:
    """The code of an S2 or S3 id; raises on S1, leading zeros and numbers from 10^12."""
    good = entity_id.rlike(r"\AS[23]-(?:0|[1-9][0-9]{0,11})\z")
    code = F.substring(entity_id, 2, 1).cast("long") * CODE + F.regexp_extract(entity_id, r"-([0-9]+)$", 1).cast("long")
    return F.when(good, code).otherwise(F.raise_error(F.concat(F.lit("not a target id: "), F.coalesce(entity_id, F.lit("null")))).cast("long"))


def decode_target(code: Column) -> Column:
    return F.concat(F.lit("S"), F.floor(code / CODE).cast("string"), F.lit("-"), (code % CODE).cast("string"))
