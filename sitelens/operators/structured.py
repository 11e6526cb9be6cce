"""Structured-data (JSON-LD) product audit: found / price / currency / stock.

All per-page work is done inside the page row with higher-order functions over
VARIANT values, so the operator adds no shuffle beyond the URL join.

Semantics per page (blocks and their items in document order):
* a block that does not parse is skipped; of a repeated key the last value
  counts (``html.last_keys``), whatever the session's settings;
* a block is a list of items or a single item;
* an item whose ``@type`` (as text) contains ``Product`` marks the product as
  found; its first offer (or the offer object) then sets price and currency,
  and its ``availability`` sets the stock label;
* an item that is not an object, a product whose offers are an empty list,
  null or not an object, or whose availability is null / not text, is an error:
  the rest of that block is skipped.  Fields set before the error stay.
* the last product item to set a field wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import LD_JSON, page_error, with_elements
from ..functions.text import py_float_text
from ..functions.url import is_product_url
from ..plans.bloom import maybe_listed
from ..sources.snapshots import capture_time, latest_per_url

# Labels of the product report.
FOUND_YES = "✅ SI"
FOUND_NO = "❌ NO"
FOUND_ERROR = "Errore"
NOT_AVAILABLE = "N/D"
ABSENT = "Mancante"
HTTP_ERROR = "Errore HTTP"
IN_STOCK = "🟢 Disponibile"
OUT_OF_STOCK = "🔴 Esaurito"
UNSPECIFIED = "⚠️ Non specificata"
NO_SNAPSHOT = "no snapshot for URL"

RESULT_COLUMNS = ("URL", "Prodotto Trovato", "Prezzo", "Valuta", "Disponibilità", "Errore")


def _is_object(v: Column) -> Column:
    # casting to an empty struct succeeds exactly for JSON objects
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _get(v: Column, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, path, typ)


def json_scalar_text(v: Column) -> Column:
    """Text of a JSON value as the audited script printed it (Python ``str``).

    A JSON number with a fraction or an exponent is a Python float and prints
    as its ``repr`` (``12500000.00`` -> ``12500000.0``, ``9.0`` -> ``9.0``,
    ``1e-5`` -> ``1e-05``); an integer prints as an integer; booleans as
    ``True`` / ``False``; strings verbatim; JSON null as null.
    """
    s = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
            .when(s == "STRING", text)
            .when(s == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True"))
                  .otherwise(F.lit("False")))
            .when(s.startswith("DECIMAL") | (s == "DOUBLE") | (s == "FLOAT"),
                  py_float_text(F.try_variant_get(v, "$", "double")))
            .otherwise(text))


def _field(raw: Column) -> Column:
    """Offer field text; the default placeholder when the key is absent."""
    return F.when(raw.isNull(), F.lit(ABSENT)).otherwise(json_scalar_text(raw))


def _has(kind: Column, disp: Column, word: str) -> Column:
    return (F.when(kind == "STRING", F.try_variant_get(disp, "$", "string").contains(word))
            .when(kind.startswith("ARRAY"),
                  F.coalesce(F.array_contains(F.try_variant_get(disp, "$", "array<string>"), word), F.lit(False)))
            .when(kind.startswith("OBJECT"),
                  F.coalesce(F.map_contains_key(F.try_variant_get(disp, "$", "map<string,variant>"), word),
                             F.lit(False)))
            .otherwise(F.lit(False)))


def _judge(items: Column) -> Column:
    """Items -> struct(product, offer_ok, avail_ok, fail, price, currency, avail).

    Staged ``transform``s, so every intermediate value is computed once.
    """
    # 1. object test, product test, offers
    s1 = F.transform(items, lambda x: F.struct(
        _is_object(x).alias("obj"),
        (_is_object(x) & F.coalesce(_get(x, "$['@type']", "string").contains("Product"),
                                    F.lit(False))).alias("product"),
        _get(x, "$.offers").alias("offers")))
    # 2. the offer: the first element of a list (an empty list or a
    #    non-object first element is an error), else the value itself;
    #    absent offers act as an empty object
    s2 = F.transform(s1, lambda y: F.struct(
        y["obj"].alias("obj"), y["product"].alias("product"), y["offers"].isNull().alias("absent"),
        F.coalesce(_get(y["offers"], "$[0]"), y["offers"]).alias("offer")))
    # 3. offer fields; availability must be absent, text, a list or an object
    s3 = F.transform(s2, lambda o: F.struct(
        o["obj"].alias("obj"), o["product"].alias("product"),
        (o["absent"] | _is_object(o["offer"])).alias("offer_ok"),
        _get(o["offer"], "$.price").alias("price"),
        _get(o["offer"], "$.priceCurrency").alias("currency"),
        _get(o["offer"], "$.availability").alias("disp"),
        F.schema_of_variant(_get(o["offer"], "$.availability")).alias("kind")))
    s4 = F.transform(s3, lambda f: F.struct(
        *[f[c].alias(c) for c in ("obj", "product", "offer_ok", "price", "currency", "disp", "kind")],
        (f["disp"].isNull() | f["kind"].startswith("ARRAY") | f["kind"].startswith("OBJECT")
         | (f["kind"] == "STRING")).alias("testable")))
    return F.transform(s4, lambda g: F.struct(
        g["product"].alias("product"),
        (g["product"] & g["offer_ok"]).alias("offer_ok"),
        (g["product"] & g["offer_ok"] & g["testable"]).alias("avail_ok"),
        (~g["obj"] | (g["product"] & ~(g["offer_ok"] & g["testable"]))).alias("fail"),
        g["price"].alias("price"),              # raw values: formatted once per page, later
        g["currency"].alias("currency"),
        F.when(g["disp"].isNull(), F.lit(UNSPECIFIED))
         .when(_has(g["kind"], g["disp"], "InStock"), F.lit(IN_STOCK))
         .when(_has(g["kind"], g["disp"], "OutOfStock"), F.lit(OUT_OF_STOCK))
         .otherwise(F.lit(UNSPECIFIED)).alias("avail")))


ITEM_TYPE = ("array<struct<product:boolean,offer_ok:boolean,avail_ok:boolean,fail:boolean,"
             "price:variant,currency:variant,avail:string>>")


def _block_items(block: Column) -> Column:
    """Parsed block -> its judged items, cut after the first failing one."""
    arr = _as_array(block)
    items = F.when(arr.isNotNull(), arr).otherwise(F.array(block))
    judged = _judge(items)
    cut = F.array_position(F.transform(judged, lambda x: x["fail"]), True)
    return (F.when(block.isNull(), F.array().cast(ITEM_TYPE))
            .when(cut > 0, F.slice(judged, F.lit(1), cut.cast("int"))).otherwise(judged))


def product_fields(df: DataFrame) -> DataFrame:
    """``elements`` -> _found, _priced, _price, _currency, _avail columns."""
    blocks = F.filter(F.col("elements"),
                      lambda e: (e["tag"] == "script") & (e["type"] == LD_JSON))
    items = F.flatten(F.transform(blocks, lambda e: _block_items(F.try_parse_json(e["string"]))))

    def last(pred):
        return F.try_element_at(F.filter(F.col("_items"), pred), F.lit(-1))

    return (df.withColumn("_items", items)
            .withColumn("_found", F.exists(F.col("_items"), lambda x: x["product"]))
            .withColumn("_priced", F.exists(F.col("_items"), lambda x: x["offer_ok"]))
            .withColumn("_p", last(lambda x: x["offer_ok"]))
            .withColumn("_s", last(lambda x: x["avail_ok"]))
            .select(*[c for c in df.columns if c != "elements"], "_found", "_priced",
                    F.col("_p.price").alias("_price_v"), F.col("_p.currency").alias("_currency_v"),
                    F.col("_s.avail").alias("_avail"))
            # format the one winning value per page here, outside the lambdas,
            # where common sub-expressions are computed once
            .withColumn("_price", _field(F.col("_price_v")))
            .withColumn("_currency", _field(F.col("_currency_v")))
            .drop("_price_v", "_currency_v"))


def product_results(snapshots: DataFrame | None, parsed: DataFrame | None = None) -> DataFrame:
    """Per product-page snapshot: url, status, fetch_error and the product fields.

    Runs where the snapshots lie: only product URLs are read (the filter
    reaches the scan), only fetched pages are parsed, and what leaves the
    stage is a handful of short columns -- never the page bytes.  With
    ``parsed`` (from ``audit.parse_snapshots``) the shared parse is reused.
    """
    if parsed is not None:
        pages = (parsed.select("url", "status", "fetch_error", "elements", *capture_time(parsed))
                 .filter(is_product_url(F.col("url"))))
    else:
        snap = (snapshots.select("url", "status", "html", "fetch_error", *capture_time(snapshots))
                .filter(is_product_url(F.col("url")))
                .withColumn("html", F.when(F.col("fetch_error").isNull() & (F.col("status") == 200),
                                           F.col("html"))))
        pages = with_elements(snap, keep=("script",), ancestors_for=())
    return product_fields(pages.withColumn("fetch_error", page_error())).withColumn("_snap", F.lit(True))


def structured_data_audit(urls: DataFrame, snapshots: DataFrame | None, url_col: str = "URL",
                          keep: tuple[str, ...] = (), parsed: DataFrame | None = None) -> DataFrame:
    """Product pages of an audit/URL list -> one result row per listed URL.

    ``urls``: any table with a URL column (an audit table); only URLs ending
    in ``.html`` (case-sensitive) are checked.  ``snapshots``: url, status,
    html, fetch_error.  A URL without a snapshot or with a fetch error gives
    an error row.  Pages outside the list are dropped before the parse, where
    they lie, by a Bloom filter; the small results (``product_results``) are joined to the list.  A null status
    counts as an HTTP error.  Of several captures of a URL the latest
    ``fetched_at`` counts.
    """
    if url_col not in urls.columns:
        raise ValueError(f"the URL list needs a {url_col!r} column")
    listed = urls.select(F.col(f"`{url_col}`").alias("url"), *keep).filter(is_product_url(F.col("url")))
    if parsed is None:      # only pages that may be listed are parsed
        snapshots = maybe_listed(snapshots, "url", listed)
    results = product_results(snapshots, parsed)
    parsed = listed.join(latest_per_url(results.select(
        "url", "status", "fetch_error", *capture_time(results), "_found", "_priced", "_price", "_currency", "_avail", "_snap")), "url", "left")
    no_snap = F.col("_snap").isNull()
    error = F.when(no_snap, F.lit(NO_SNAPSHOT)).otherwise(F.col("fetch_error"))
    http_bad = error.isNull() & ~F.col("status").eqNullSafe(200)
    ok = error.isNull() & ~http_bad
    na = F.lit(NOT_AVAILABLE)
    null = F.lit(None).cast("string")
    return parsed.select(
        F.col("url").alias("URL"),
        F.when(error.isNotNull(), F.lit(FOUND_ERROR))
         .when(ok & F.col("_found"), F.lit(FOUND_YES)).otherwise(F.lit(FOUND_NO)).alias("Prodotto Trovato"),
        F.when(error.isNotNull(), null).when(http_bad, F.lit(HTTP_ERROR))
         .when(F.col("_priced"), F.col("_price")).otherwise(na).alias("Prezzo"),
        F.when(error.isNotNull() | http_bad, null)
         .when(F.col("_priced"), F.col("_currency")).otherwise(na).alias("Valuta"),
        F.when(error.isNotNull(), null).when(http_bad, na)
         .otherwise(F.coalesce(F.col("_avail"), na)).alias("Disponibilità"),
        error.alias("Errore"),
        *keep,
    )
