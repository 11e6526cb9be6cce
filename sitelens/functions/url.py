"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import slash_count

# Page classes of the audited shop layout, in rule order.
CLASS_CMS = "Pagina (CMS)"
CLASS_PRODUCT = "Prodotto"
CLASS_HOME = "Homepage"
CLASS_CATEGORY = "Categoria"
CMS_MARKER = "/content/"
PRODUCT_SUFFIX = ".html"
HOME_SUFFIXES = (".it/", ".it/it/")
HOME_MAX_SLASHES = 4


def url_class(url: Column) -> Column:
    """Page class from the lowercased URL; first matching rule wins."""
    u = F.lower(url)
    home = (u.endswith(HOME_SUFFIXES[0]) | u.endswith(HOME_SUFFIXES[1])
            | (slash_count(u) < HOME_MAX_SLASHES))
    return (F.when(u.contains(CMS_MARKER), F.lit(CLASS_CMS))
            .when(u.endswith(PRODUCT_SUFFIX), F.lit(CLASS_PRODUCT))
            .when(home, F.lit(CLASS_HOME))
            .otherwise(F.lit(CLASS_CATEGORY)))


def is_product_url(url: Column) -> Column:
    """Case-sensitive ``.html`` suffix; null is not a product.

    Use it as a filter: a null URL drops the row, and the plain ``endswith``
    reaches a parquet scan as ``StringEndsWith``.  ``product_flag`` is the
    never-null column form.
    """
    return url.endswith(PRODUCT_SUFFIX)


def product_flag(url: Column) -> Column:
    return url.cast("string").endswith(PRODUCT_SUFFIX).eqNullSafe(True)
