"""Text expressions, all built from JVM-side functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks a word start that initcap alone would miss; removed again before returning.
_MARK = "\u0001 "

# The Unicode white-space characters, in code-point order.
_WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# Texts of printable ASCII without blanks around them: there is nothing to trim.
_TRIMMED = r"^[!-~](?:[ -~]*[!-~])?\z"
_SEPARATOR = r"[^\p{L}\p{N} ]"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks; most texts need none, which is cheaper to see than to do."""
    return F.when(text.rlike(_TRIMMED), text).otherwise(F.btrim(text, F.lit(_WHITE_SPACE)))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every alphanumeric run and lower-case the rest.

    ``initcap`` only starts words after a blank, so each other separator gets a marker ending in
    a blank first. The three calls stay inside code generation, unlike a split-and-transform. Texts without a
    separator need no marker.
    """
    marked = F.regexp_replace(text, _SEPARATOR, "$0" + _MARK)
    return F.when(text.rlike(_SEPARATOR), F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))).otherwise(F.initcap(text))


def slug(text: Column) -> Column:
    """Column-name slug: lower, trimmed, blanks to underscores, other characters dropped."""
    joined = F.regexp_replace(strip(F.lower(text)), r"(?U)\s+", "_")
    return F.regexp_replace(joined, r"[^a-z0-9_]", "")


def short_label(text: Column, max_len: int = 40) -> Column:
    """Display label: cut at ``Nota:`` and shortened with an ellipsis."""
    plain = F.when(
        F.contains(text, F.lit("Nota:")), strip(F.substring_index(text, "Nota:", 1))
    ).otherwise(text)
    cut = F.concat(F.left(plain, F.lit(max_len - 3)), F.lit("..."))
    return F.when(F.length(plain) > max_len, cut).otherwise(plain)


def literal_map(pairs: Mapping) -> Column:
    """Map constant from text or numeric keys to text, built from one SQL expression."""

    def sql(x: object) -> str:
        if isinstance(x, (int, float)):
            return f"{float(x)!r}D"
        escaped = str(x).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    return F.expr("map(" + ", ".join(f"{sql(k)}, {sql(v)}" for k, v in pairs.items()) + ")")


def replace_values(text: Column, pairs: Mapping[str, str]) -> Column:
    """Dictionary replace; unmatched values stay."""
    return F.coalesce(F.try_element_at(literal_map(pairs), text), text)


def contains_ignore_case(text: Column, part: str) -> Column:
    """Case-insensitive substring test where NULL counts as false."""
    return F.coalesce(F.contains(F.lower(text), F.lit(part.lower())), F.lit(False))


def year_from_name(name: Column, lo: int, hi: int) -> Column:
    """Leading four digits of a file name when they fall in ``lo..hi``."""
    year = F.regexp_extract(name, r"^(\d{4})", 1).try_cast("int")
    return F.when(year.between(lo, hi), year)
