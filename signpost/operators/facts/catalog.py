"""Facts of product catalogues, carts and catalogue answers of tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signpost.functions import documents as D
from signpost.functions import urls as U
from signpost.functions.lists import empty_strings, first_by_key, let, merge_ordered, non_empty, sorted_distinct
from signpost.functions.stage import compute, spread
from signpost.functions.text import strip
from signpost.operators.candidates import amount_text
from signpost.operators.facts.common import because, documents, finished, judged, truncated, was_truncated


PRODUCT = [
    "title", "name", "variants", "variations", "sku", "slug", "handle", "url", "jsonLd", "price_range", "currency",
    "price", "availability", "product_type", "categories", "vendor", "seller",
]
VARIANT = ["price", "currency", "stock_status", "available", "availability", "requires_shipping", "requires", "checkout_url", "title"]


def _last_part(c: Column) -> Column:
    return F.when(c != "", F.substring_index(c, "/", -1))


def _is(v: Column, flag: bool) -> Column:
    """The value is exactly true (or false)."""
    return F.coalesce(F.try_variant_get(v, "$", "string") == ("true" if flag else "false"), F.lit(False)) & (D.kind(v) == "BOOLEAN")


def _flag(v: Column, flag: bool) -> Column:
    return F.when(v.isNull(), False).otherwise(_is(v, flag))


def _variant(v: Column, product: Column, base: Column) -> Column:
    """What one variant contributes; `v` holds its members."""

    def read(pair: Column) -> Column:
        price, stock = pair["money"], pair["stock"]
        available = (
            _flag(v["available"], True)
            | F.coalesce(F.lower(stock) == "instock", F.lit(False))
            | F.when(v["availability"].isNull(), False).otherwise(_flag(D.get(v["availability"], "available"), True))
        )
        ships = _flag(v["requires_shipping"], True) | F.when(v["requires"].isNull(), False).otherwise(_flag(D.get(v["requires"], "shipping"), True))
        own = F.when(v["currency"].isNotNull(), D.as_string(D.first_truthy(v["currency"])))
        return F.struct(
            price["amount"].alias("price"),
            F.coalesce(own, price["currency"], product["currency"]).alias("currency"),
            available.alias("available"),
            (available | ~_flag(v["available"], False)).alias("offered"),
            stock.alias("stock"),
            ships.alias("ships"),
            F.when(v["checkout_url"].isNotNull(), U.resolve_http(base, D.as_string(v["checkout_url"]))).alias("checkout_url"),
            F.when(v["title"].isNotNull(), D.filled_text(D.as_string(v["title"]))).alias("title"),
            product["title"].alias("product_title"),
        )

    stock = F.when(v["stock_status"].isNotNull(), D.filled_text(D.as_string(v["stock_status"])))
    return let(F.struct(D.money(v["price"]).alias("money"), stock.alias("stock")), read)


def _price_source(p: Column, ld: Column, lowest: Column, highest: Column) -> Column:
    """The first of the product's own price, lowest and highest range price that is a price."""
    own = D.money(F.coalesce(F.when(D.truthy(p["price"]), p["price"]), D.get(ld, "price")))
    is_object = lambda v: D.members(v, ["amount"]).isNotNull()
    return let(
        F.struct(own.alias("own"), F.when(is_object(lowest), D.money(lowest)).alias("low"), F.when(is_object(highest), D.money(highest)).alias("high")),
        lambda m: F.when(m["own"]["amount"].isNotNull(), m["own"]).when(m["low"]["amount"].isNotNull(), m["low"]).otherwise(m["high"]),
    )


def _head(p: Column) -> Column:
    """Product-level values the variants fall back to; `p` holds the product's members."""
    ld = D.get(p["jsonLd"], "offers")
    lowest, highest = D.get(p["price_range"], "min"), D.get(p["price_range"], "max")
    listed = D.first_truthy(p["currency"], D.get(ld, "priceCurrency"), D.get(lowest, "currency"))
    flag = D.get(p["availability"], "available")
    availability = F.coalesce(D.text_at(ld, "availability"), F.when(_flag(flag, True), "InStock").when(_flag(flag, False), "OutOfStock"))
    categories = F.filter(F.transform(D.as_list(p["categories"]), lambda c: D.filled(c, "value")), lambda x: x.isNotNull())
    return let(
        _price_source(p, ld, lowest, highest),
        lambda price: F.struct(
            F.coalesce(D.as_string(p["title"]), D.as_string(p["name"])).alias("title"),
            F.coalesce(D.as_string(listed), price["currency"]).alias("currency"),
            price["amount"].alias("price"),
            F.coalesce(D.as_list(p["variants"]), D.as_list(p["variations"])).alias("variants"),
            _last_part(availability).alias("availability"),
            D.as_string(p["handle"]).alias("handle"),
            D.as_string(p["slug"]).alias("slug"),
            D.as_text(p["sku"]).alias("sku"),
            F.coalesce(D.filled_text(D.as_string(p["product_type"])), F.substring(F.get(categories, F.lit(0)), 1, 120)).alias("product_type"),
            D.filled_text(D.as_string(p["url"])).alias("product_url"),
            F.coalesce(D.filled_text(D.as_string(p["vendor"])), D.text_at(p["seller"], "name")).alias("vendor"),
        ),
    )


def _product(p: Column, base: Column) -> Column:
    def whole(head: Column) -> Column:
        items = F.coalesce(D.objects(head["variants"], VARIANT), F.array().cast(f"array<struct<{','.join(f'{n}:variant' for n in VARIANT)}>>"))
        found = F.transform(items, lambda v: _variant(v, head, base))
        return let(found, lambda vs: joined(head, vs))

    def joined(head: Column, vs: Column) -> Column:
        prices = F.filter(F.transform(vs, lambda v: v["price"]), lambda x: x.isNotNull())
        all_prices = F.when(F.size(prices) > 0, prices).otherwise(F.array_compact(F.array(head["price"])))
        return F.struct(
            *[head[n].alias(n) for n in ("title", "currency", "availability", "handle", "slug", "sku", "product_type", "product_url", "vendor")],
            vs.alias("variants"),
            all_prices.alias("prices"),
            F.size(head["variants"]).alias("listed_variants"),
            F.size(F.filter(vs, lambda v: v["available"])).alias("available_variants"),
            F.exists(vs, lambda v: v["ships"]).alias("requires_shipping"),
        )

    return let(_head(p), whole)


def _sample(p: Column) -> Column:
    has_list = p["listed_variants"] >= 0
    return F.struct(
        *[p[n].alias(n) for n in ("title", "handle", "slug", "sku", "product_type", "product_url", "vendor")],
        F.array_min(p["prices"]).alias("min_price"),
        F.array_max(p["prices"]).alias("max_price"),
        F.when(has_list, p["available_variants"]).alias("available_variant_count"),
        F.when(has_list, p["listed_variants"]).alias("variant_count"),
        F.when(has_list, p["requires_shipping"]).alias("requires_shipping"),
        p["availability"].alias("availability"),
        F.lit(None).cast("string").alias("currency"),
    )


def _candidate(v: Column, source: str) -> Column:
    title = F.when(v["product_title"] != "", F.substring(v["product_title"], 1, 120))
    own = F.when(F.lower(v["title"]) != "default title", v["title"])
    return F.struct(
        F.lit(source).alias("source"),
        v["checkout_url"].alias("url"),
        F.lit("GET").alias("method"),
        F.lit(False).alias("follow_redirects"),
        F.coalesce(F.concat(title, F.lit(" - "), F.substring(own, 1, 80)), title, F.substring(own, 1, 120)).alias("title"),
        title.alias("sample_title"),
        amount_text(v["price"]).alias("amount"),
        F.when(v["currency"] != "", F.substring(F.upper(v["currency"]), 1, 8)).alias("currency"),
    )


def _catalog(products: Column, source: str) -> Column:
    variants = F.flatten(F.transform(products, lambda p: p["variants"]))

    def summary(vs: Column) -> Column:
        prices = F.flatten(F.transform(products, lambda p: p["prices"]))
        codes = F.concat(F.transform(products, lambda p: p["currency"]), F.transform(vs, lambda v: v["currency"]))
        currencies = F.transform(F.filter(codes, lambda c: c != ""), lambda c: F.substring(F.upper(c), 1, 8))
        titles = F.transform(F.filter(products, lambda p: p["title"] != ""), lambda p: F.substring(p["title"], 1, 120))
        stocks = F.concat(F.transform(products, lambda p: p["availability"]), F.transform(vs, lambda v: v["stock"]))
        with_checkout = F.filter(vs, lambda v: v["checkout_url"].isNotNull())
        samples = first_by_key(products, lambda p: F.struct(F.coalesce(p["handle"], p["slug"]), p["title"]), 3)
        candidates = first_by_key(F.filter(with_checkout, lambda v: v["offered"]), lambda v: v["checkout_url"], 8)
        checkouts = F.size(with_checkout)
        return F.struct(
            F.size(products).alias("product_count"),
            F.size(vs).alias("variant_count"),
            F.size(prices).alias("priced_variant_count"),
            F.size(F.array_distinct(currencies)).alias("currency_count"),
            sorted_distinct(currencies, 12).alias("currency_codes"),
            F.array_min(prices).alias("min_price"),
            F.array_max(prices).alias("max_price"),
            merge_ordered(empty_strings(), titles, 3).alias("sample_titles"),
            F.transform(samples, _sample).alias("sample_products"),
            F.size(F.filter(products, lambda p: F.lower(p["availability"]) == "preorder")).alias("preorder_product_count"),
            sorted_distinct(F.filter(stocks, lambda s: s != ""), 12).alias("stock_statuses"),
            F.when(checkouts > 0, checkouts).alias("checkout_url_count"),
            F.when(checkouts > 0, merge_ordered(empty_strings(), F.transform(with_checkout, lambda v: v["checkout_url"]), 6)).alias("sample_checkout_urls"),
            non_empty(F.transform(candidates, lambda v: _candidate(v, source))).alias("payment_probe_candidates"),
        )

    return let(variants, summary)


def catalog_of(items: Column, base: Column, source: str = "catalog_checkout") -> Column:
    """Facts of a list of products (variants values); null when it holds no object.

    Everything stays in the row: a document is bounded by the body limit of its probe, so the
    arrays are too, and no row is shuffled.
    """
    found = F.transform(D.objects(items, PRODUCT), lambda p: _product(p, base))
    return let(found, lambda ps: F.when(F.size(ps) > 0, _catalog(ps, source)))


def listed_products(text: Column) -> Column:
    top = D.fields(text, ["products", "data"])
    from_object = let(top, lambda d: F.coalesce(D.as_list(d["products"]), D.list_at(d["data"], "products")))
    return F.when(D.is_object(text), from_object).otherwise(D.list_items(text))


def product_facts(fetches: DataFrame) -> DataFrame:
    docs = compute(documents(fetches), _items=listed_products(F.col("text")))
    read = compute(docs, _facts=F.when(~F.col("truncated"), catalog_of(F.col("_items"), F.col("base"))))
    verdict = judged(
        read,
        [
            truncated("products catalog"),
            (F.col("text") == "", "empty body"),
            (F.col("_items").isNull(), "products payload did not contain a products list"),
            (F.size("_items") == 0, "products list was empty"),
            (F.col("_facts").isNull(), "products list did not contain product objects"),
        ],
        "Usable products catalog detected",
    )
    noted = {"truncated": was_truncated(), "product_count": because(F.lit(0), "products list was empty")}
    return finished(verdict, F.col("_facts"), rejected=noted)


def tool_products(text: Column) -> Column:
    """Products of a tool answer: the structured content, else the first JSON object among its texts."""
    result = D.fields(text, ["result"])["result"]
    structured = D.object_at(result, "structuredContent")
    texts = F.filter(F.transform(D.list_at(result, "content"), lambda c: D.filled(c, "text")), lambda t: D.is_object(t))
    from_text = D.fields(F.get(texts, F.lit(0)), ["products"])["products"]
    products = F.when(structured.isNotNull(), D.get(structured, "products")).otherwise(from_text)
    return F.when(D.is_object(text), D.as_list(products))


def tool_product_facts(answers: DataFrame) -> DataFrame:
    """Catalogue facts of captured tool answers, one row per usable answer.

    Needs text, endpoint, query, http_status, truncated; keeps the other columns.
    """
    usable = answers.where((F.col("http_status") == 200) & ~F.coalesce("truncated", F.lit(False)))
    read = compute(usable, _items=tool_products(strip(F.col("text"))))
    facts = compute(read, facts=catalog_of(F.col("_items"), F.col("endpoint"), "ucp_catalog_checkout")).where("facts IS NOT NULL")
    detail = F.lit("Usable products catalog detected via UCP search_catalog")
    return facts.drop("_items", "text").withColumns({"detail": detail, "catalog_source": F.lit("ucp_search_catalog")})


def catalog_answer_facts(fetches: DataFrame) -> DataFrame:
    """Captured answers to catalogue searches: `requested_url` is the endpoint, `request_note` the words asked for."""
    docs = compute(documents(fetches), _items=tool_products(F.col("text")))
    read = compute(docs, _facts=F.when(~F.col("truncated"), catalog_of(F.col("_items"), F.col("requested_url"), "ucp_catalog_checkout")))
    verdict = judged(
        read,
        [truncated("products catalog"), (F.col("_facts").isNull(), "catalog answer did not contain product objects")],
        "Usable products catalog detected via UCP search_catalog",
    )
    note = F.col("request_note") if "request_note" in fetches.columns else F.lit(None).cast("string")
    named = [F.lit("ucp_search_catalog").alias("catalog_source"), note.alias("catalog_query"), F.col("requested_url").alias("catalog_endpoint")]
    return finished(verdict, F.when(F.col("_facts").isNotNull(), F.struct("_facts.*", *named)))


def cart_facts(fetches: DataFrame) -> DataFrame:
    docs = documents(fetches)
    read = spread(docs, docs.columns, D.fields(F.when(D.is_object(F.col("text")), F.col("text")), ["currency", "token", "item_count", "requires_shipping"]))
    read = read.withColumnsRenamed({c: f"_{c}" for c in ["currency", "token", "item_count", "requires_shipping"]})
    currency = D.as_string(F.col("_currency"))
    verdict = judged(
        read,
        [
            truncated("cart response"),
            (F.col("text") == "", "empty body"),
            (~D.is_object(F.col("text")), "cart payload was not an object"),
            (F.coalesce(currency, F.lit("")) == "", "cart payload missing currency"),
        ],
        "Public cart JSON detected",
    )
    facts = F.struct(
        currency.alias("currency"),
        F.col("_item_count").alias("item_count"),
        F.col("_requires_shipping").alias("requires_shipping"),
        F.when(D.as_string(F.col("_token")) != "", True).alias("has_token"),
    )
    return finished(verdict, facts, rejected={"truncated": was_truncated()})
