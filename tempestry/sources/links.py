"""Links in a table of HTML pages."""

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NOT_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR_HREF = r"""(?is)<a\s+(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

# A reference, by number or by name; and text up to a reference or the reference itself.
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_PIECE = rf"(?s){_REFERENCE}|(?:(?!{_REFERENCE}).)+"
# The names that end in a semicolon, as the standard library lists them: a reference without
# one may as well be the start of a parameter.
_NAMED = json.dumps({f"&{name}": text for name, text in html5.items() if name.endswith(";")})


def decode_references(text) -> Column:
    """Text with named and numeric character references decoded, each once.

    A number that is no character and a name that is not known stay as they are written.
    """
    named = F.from_json(F.lit(_NAMED), "map<string, string>")

    def decoded(piece):
        digits = F.regexp_extract(piece, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        base = F.when(F.lower(F.substring(piece, 3, 1)) == "x", 16).otherwise(10)
        code = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        # four bytes at most: UTF-32 text of the code point
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        reference = F.startswith(piece, F.lit("&")) & F.endswith(piece, F.lit(";"))
        number = F.startswith(piece, F.lit("&#"))
        out = F.when(reference & number & valid, character)
        return out.when(reference & ~number, F.coalesce(F.try_element_at(named, piece), piece)).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    return F.when(~F.contains(text, F.lit("&")), text).otherwise(
        F.array_join(F.transform(pieces, decoded), "")
    )


def extract_links(
    pages: DataFrame, contains: str = "", base: str = "", html="html", keep=()
) -> DataFrame:
    """One row per anchor whose target contains ``contains``, prefixed by ``base``.

    Comments, scripts and styles hold no anchors. ``keep`` names page columns to
    carry along. Nothing is shuffled: each page is handled where it is read.
    """
    markup = F.regexp_replace(F.col(html), _NOT_MARKUP, "")
    targets = F.regexp_extract_all(markup, F.lit(_ANCHOR_HREF), F.lit(1))
    target = F.regexp_replace("raw_target", r"""^["']|["']$""", "")
    return (
        pages.select(*keep, F.explode(targets).alias("raw_target"))
        .select(*keep, decode_references(target).alias("target"))
        .where(F.contains("target", F.lit(contains)))
        .select(*keep, F.concat(F.lit(base), F.col("target")).alias("link"))
    )
