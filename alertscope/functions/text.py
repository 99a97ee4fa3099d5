"""Text helpers: Unicode trim, blank test and JSON-field text coercion.

``F.trim`` without a character set strips ASCII spaces only; the alert
contracts trim every Unicode whitespace character, so the set is passed
explicitly and the trim stays a native string function (no regex).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimmed as whitespace — control whitespace
# and the information separators, then every space, line and paragraph
# separator (Unicode categories Zs, Zl, Zp).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace; null stays null."""
    return F.trim(_col(c), F.lit(WHITESPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    """True when null, empty, or whitespace only."""
    col = _col(c)
    return col.isNull() | (unicode_trim(col) == F.lit(""))


def non_blank(c: Column | str) -> Column:
    """True when the value has a non-whitespace character (null → false)."""
    return F.coalesce(unicode_trim(_col(c)) != F.lit(""), F.lit(False))


def default_if_blank(c: Column | str, default: str) -> Column:
    col = _col(c)
    return F.when(non_blank(col), col).otherwise(F.lit(default))


def node_text(node: Column, default: str, number_text: Column | None = None) -> Column:
    """Text of a JSON node (a variant), coerced the way a tree-model reader does.

    Missing node or JSON null → ``default``; string → its value; integer or
    boolean → its literal text; a number with a fraction or exponent → the
    text of the double it denotes (``1.50`` → ``1.5``, ``100.0`` →
    ``100.0``, ``1e3`` → ``1000.0``); object or array → empty text.

    The variant keeps ``100.0`` and a 20-digit integer as the same decimal
    kind, so for decimal nodes ``number_text`` — the field as a JSON reader
    re-serializes it, e.g. ``get_json_object`` — is used when given; it is
    evaluated only for such rows. ``node`` should be a column reference
    (it is read several times).
    """
    kind = F.schema_of_variant(node)
    if number_text is None:
        number_text = F.when(
            kind.endswith(",0)"), F.try_variant_get(node, "$", "string")
        ).otherwise(F.try_variant_get(node, "$", "double").cast("string"))
    return (
        F.when(node.isNull() | (kind == F.lit("VOID")), F.lit(default))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(""))
        .when(kind.startswith("DECIMAL"), number_text)
        .otherwise(F.coalesce(F.try_variant_get(node, "$", "string"), F.lit(default)))
    )


def variant_text(v: Column, path: str, default: str) -> Column:
    """``node_text`` of the field at ``path`` of variant ``v``."""
    return node_text(F.try_variant_get(v, path, "variant"), default)
