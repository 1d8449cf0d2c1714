"""String helpers: names, labels, missing tokens, canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens read as "missing" in logs and request records.
MISSING_TOKENS = ["", "nan", "none", "null"]
NULL_TEXT = "<NULL>"
MISSING_CATEGORY = "MISSING"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(first, middle, last) -> Column:
    """TRIM(first + ' ' middle + ' ' last), skipping nulls."""
    return F.trim(F.concat(
        F.coalesce(_c(first), F.lit("")),
        F.coalesce(F.concat(F.lit(" "), _c(middle)), F.lit("")),
        F.coalesce(F.concat(F.lit(" "), _c(last)), F.lit(""))))


def clean_missing(c) -> Column:
    """Null for null/blank/'nan'/'none'/'null' text (F24); other values unchanged."""
    col = _c(c)
    return F.when(F.lower(F.trim(col.cast("string"))).isin(*MISSING_TOKENS), F.lit(None)) \
        .otherwise(col)


def lenient_double(c) -> Column:
    """Numeric value or null when not parseable."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def safe_double(c, default: float = 0.0) -> Column:
    """Lenient number with a default for missing/unparseable."""
    return F.coalesce(_c(c).try_cast("double"), F.lit(float(default)))


def safe_int(c, default: int = 0) -> Column:
    """int(float(x)) with a default."""
    return F.coalesce(_c(c).try_cast("double").try_cast("long"), F.lit(int(default)).cast("long"))


def canonical_text(c) -> Column:
    """Canonical text of a stored value for fingerprints: null → '<NULL>',
    decimals in plain fixed-point at their stored scale, ISO dates (F26, N9)."""
    return F.coalesce(_c(c).cast("string"), F.lit(NULL_TEXT))


def category_text(c) -> Column:
    """Null → 'MISSING', else text (F32)."""
    return F.coalesce(_c(c).cast("string"), F.lit(MISSING_CATEGORY))


def split_list(c) -> Column:
    """Comma list → trimmed non-blank items."""
    return F.filter(F.transform(F.split(_c(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def entity_label(id_col, name_col, prefix: str) -> Column:
    """'name (Prefix id)' when a name is present, else 'Prefix id' (F28)."""
    ident = F.concat(F.lit(prefix + " "), _c(id_col).cast("string"))
    if name_col is None:
        return ident
    name = clean_missing(_c(name_col).cast("string"))
    return F.when(name.isNotNull(), F.concat(name, F.lit(" ("), ident, F.lit(")"))).otherwise(ident)


def product_label(key_col, name_cols: list) -> Column:
    """First three present of the name columns joined ' / ', then ' (Product k)' (F29)."""
    ident = F.concat(F.lit("Product "), _c(key_col).cast("string"))
    if not name_cols:
        return ident
    parts = F.filter(F.array(*[clean_missing(_c(c).cast("string")) for c in name_cols]),
                     lambda x: x.isNotNull())
    label = F.when(F.size(parts) > 0, F.array_join(F.slice(parts, 1, 3), " / ")).otherwise(ident)
    return F.concat(label, F.lit(" ("), ident, F.lit(")"))


def join_present(cols: list, sep: str = " | ") -> Column:
    """Present parts joined with a separator."""
    return F.concat_ws(sep, *[clean_missing(_c(c).cast("string")) for c in cols])
