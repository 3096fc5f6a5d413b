"""Text and identifier expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.html import parsed_text

# Characters counted as punctuation, and those that separate tokens.
PUNCTUATION = r"[.,;:!?\-]"
TOKEN_SEPARATORS = r"""[\.,;:!?\(\)\[\]\{\}"'`~/\\\-_<>\|=\+\*&%\$#@]"""

_HIDDEN_BLOCKS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[!/?]?[a-z][^>]*>"
# References of ASCII signs; all but the apostrophe may lack the semicolon.
_NAMED_SIGNS = [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "'"), ("&nbsp;?", "\u00a0")]


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def full_text_strip(designation: Column, description: Column) -> Column:
    """Title, then the description when it holds more than blanks."""
    title, body = _text(designation), _text(description)
    return F.when(body.rlike(r"[^\s\p{Z}]"), F.concat(title, F.lit(". "), body)).otherwise(title)


def full_text_truthy(designation: Column, description: Column) -> Column:
    """Title, then any non-empty description, blank ones included."""
    title, body = _text(designation), _text(description)
    return F.when(body != "", F.concat(title, F.lit(". "), body)).otherwise(title)


def full_text_ignore_nulls(designation: Column, description: Column) -> Column:
    return F.concat_ws(". ", designation, description)


def full_text_spaced(designation: Column, description: Column, clean=None) -> Column:
    """Title and cleaned description joined by a blank, trimmed."""
    clean = clean or clean_description
    joined = F.concat(_text(designation), F.lit(" "), clean(_text(description)))
    return F.regexp_replace(joined, r"^\s+|\s+$", "")


def _drop_noise(text: Column) -> Column:
    text = F.replace(text, F.lit("\n"), F.lit(". "))
    text = F.regexp_replace(text, r"&#[0-9]+;", "")
    text = F.regexp_replace(text, "¿{2,}", " ")
    # The lone mark is not ASCII either, so one pass drops it with the rest.
    return F.regexp_replace(text, r"[^\x00-\x7F]+", "")


def clean_description(markup: Column) -> Column:
    """Markup to plain ASCII text, with a real HTML parser for rows that need one."""
    return _drop_noise(parsed_text(markup))


def clean_description_native(markup: Column) -> Column:
    """Same cleaning without leaving the JVM.

    Differs from the parser only on numeric references (dropped, not decoded), on the rare
    named references of ASCII signs, on CDATA and on a ``>`` inside an attribute value.
    Other named references stand for non-ASCII characters, which are dropped at the end.
    """
    text = F.regexp_replace(markup, _HIDDEN_BLOCKS, "\u0001")
    for name, sign in _NAMED_SIGNS:
        text = F.regexp_replace(text, name, sign)
    # Ampersands are set aside, so that what they precede is not decoded a second time.
    text = F.regexp_replace(text, "&amp;?", "\u0002")
    text = F.regexp_replace(text, "&[a-zA-Z][a-zA-Z0-9]*;", "\ufffd")
    text = F.replace(text, F.lit("\u0002"), F.lit("&"))
    pieces = F.split(text, "\u0001")
    pieces = F.transform(pieces, lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    joined = _drop_noise(F.concat_ws("\n", F.filter(pieces, lambda x: x != "")))
    return F.when(markup.isNotNull(), joined)


def text_or_recompute(text: Column, designation: Column, description: Column, clean=clean_description) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), clean(full_text_strip(designation, description)))


def _count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_tabular(designation: Column, description: Column) -> list[Column]:
    """Lengths, word count, presence flag and character-class ratios (0 on empty text)."""
    text = full_text_truthy(designation, description)
    size = F.length(text)

    def ratio(pattern: str) -> Column:
        return F.when(size > 0, _count_of(text, pattern) / size).otherwise(F.lit(0.0))

    words = F.filter(F.split(text, r"[\s\p{Z}\x1c-\x1f\x85]+"), lambda w: w != "")
    return [
        size.alias("tab_text_length"),
        F.size(words).alias("tab_word_count"),
        F.length(_text(designation)).alias("tab_designation_length"),
        _text(description).rlike(r"[^\s\p{Z}]").cast("int").alias("tab_description_present"),
        ratio(r"\p{Lu}").alias("tab_uppercase_ratio"),
        ratio(r"\p{Nd}").alias("tab_digit_ratio"),
        ratio(PUNCTUATION).alias("tab_punct_density"),
    ]


def image_path(imageid: Column, productid: Column, folder: str = "") -> Column:
    return F.concat(
        F.lit(folder), F.lit("image_"), imageid.cast("string"),
        F.lit("_product_"), productid.cast("string"), F.lit(".jpg"),
    )


def model_tag(name: Column, version: Column, sep: str = "@v") -> Column:
    return F.concat(name, F.lit(sep), version.cast("string"))


def composite_key(imageid: Column, productid: Column) -> Column:
    return F.concat_ws("_", imageid.cast("string"), productid.cast("string"))


def tokenize(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(_text(text)), TOKEN_SEPARATORS, " ")
    return F.filter(F.split(lowered, r"[\s\p{Z}\x1c-\x1f\x85]+"), lambda t: t != "")


# How feature names tell their family.
TEXT_PREFIXES, TEXT_MARK = ("p_text_", "text_p_", "proba_text_"), "text_proba"
IMAGE_PREFIXES, IMAGE_MARK = ("p_image_", "image_p_", "proba_image_"), "image_proba"
DERIVED_PREFIX = "derived__"


def feature_group(name: Column) -> Column:
    """Family of a meta feature, from its name; case counts for the derived ones only."""
    lowered = F.lower(name)

    def belongs(prefixes: tuple[str, ...], mark: str) -> Column:
        return lowered.rlike("^(" + "|".join(prefixes) + ")") | lowered.contains(mark)

    return (
        F.when(belongs(TEXT_PREFIXES, TEXT_MARK), "text")
        .when(belongs(IMAGE_PREFIXES, IMAGE_MARK), "image")
        .when(name.startswith(DERIVED_PREFIX), "derived")
        .otherwise("tabular")
    )


def null_defaults(df: DataFrame) -> DataFrame:
    """Missing text, flag, label and image id get their stand-in values."""
    defaults = {"designation": "", "description": "", "text": "", "is_gold": False, "label": -1, "imageid": 0}
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})
