"""Fixed values the results depend on: probe catalogue, vocabularies, weights and limits."""

from __future__ import annotations

# --- fixed values: probe catalogue -------------------------------------------------
# key, path, validator, max_bytes, control_group
DEFAULT_MAX_BYTES = 16_384
CONTROL_MAX_BYTES = 4_096
PROBES = [
    ("robots_txt", "/robots.txt", "robots", 16_384, "text"),
    ("sitemap_xml", "/sitemap.xml", "sitemap", 16_384, "xml"),
    ("llms_txt", "/llms.txt", "llms", 500_000, "text"),
    ("llms_full_txt", "/llms-full.txt", "llms", 1_000_000, "text"),
    ("homepage", "/", "homepage", 32_768, None),
    ("well_known_commerce", "/.well-known/commerce", "commerce", 131_072, "json_well_known"),
    ("well_known_ucp", "/.well-known/ucp", "ucp", 16_384, "json_well_known"),
    ("well_known_agent_json", "/.well-known/agent.json", "agent", 131_072, "json_well_known"),
    ("well_known_agents_json", "/.well-known/agents.json", "agents", 65_536, "json_well_known"),
    ("well_known_agent_card", "/.well-known/agent-card.json", "agent", 131_072, "json_well_known"),
    ("root_agent_json", "/agent.json", "agent", 131_072, "json_root"),
    ("openapi_json", "/openapi.json", "openapi", 262_144, "json_root"),
    ("x402_well_known", "/.well-known/x402", "x402", 524_288, "json_well_known"),
    ("x402_json", "/.well-known/x402.json", "x402", 524_288, "json_well_known"),
    ("api_openapi_json", "dynamic", "openapi", 262_144, None),
    ("remote_x402", "dynamic", "x402", 524_288, None),
    ("products_json", "/products.json", "products", 524_288, "catalog"),
    ("api_products", "dynamic", "products", 524_288, None),
    ("cart_json", "/cart.js", "cart", 16_384, "catalog"),
    ("payment_probe", "dynamic", "payment_probe", 65_536, None),
]
# captures a receipt asks for after its first outcomes; they never stand in a receipt themselves
FOLLOW_UP_CAPTURES = [
    ("ucp_version", "dynamic", "ucp", 16_384, None),
    ("ucp_catalog", "dynamic", "ucp_catalog", 262_144, None),
    ("discovery", "dynamic", None, 131_072, None),
    ("price_lookup", "dynamic", None, 16_384, None),
]
PROBE_ORDER = [p[0] for p in PROBES]
VALIDATOR_OF = {p[0]: p[2] for p in PROBES}
MAX_BYTES_OF = {p[0]: p[3] for p in PROBES + FOLLOW_UP_CAPTURES}
CONTROL_GROUP_OF = {p[0]: p[4] for p in PROBES if p[4]}
OUTCOME_MEMBERS = ["path", "status", "http_status", "content_type", "final_url", "byte_count", "body_sha256", "detail", "facts"]
# probes every domain gets a row for, whether fetched or not
LIGHT_PROBES = ["robots_txt", "sitemap_xml", "llms_txt", "llms_full_txt"]
DISCOVERY_PROBES = [
    "well_known_commerce", "well_known_ucp", "well_known_agent_json", "well_known_agents_json",
    "well_known_agent_card", "root_agent_json", "openapi_json", "x402_well_known", "x402_json",
]
FOLLOWUP_PROBES = ["products_json", "cart_json", "payment_probe"]
# probes whose address other documents name; several may be tried
DYNAMIC_PROBES = ["api_openapi_json", "remote_x402", "api_products", "payment_probe"]
CATALOG_CAPABILITY = "dev.ucp.shopping.catalog.search"
EXPECTED_PROBES = LIGHT_PROBES + ["homepage"] + DISCOVERY_PROBES + FOLLOWUP_PROBES

ALLOWED_STATUSES = {
    "commerce": [200, 402],
    "x402": [200, 402],
    "payment_probe": [200, 301, 302, 303, 307, 308, 400, 401, 402, 403, 405, 409, 422, 429, 503],
}
EMPTY_BODY_VALIDATORS = ["payment_probe", "x402"]
RATE_LIMIT_SKIP = 3
RATE_LIMIT_SKIP_RETRY = 5

INTERESTING_PROBES = [
    "llms_txt", "llms_full_txt", "well_known_commerce", "well_known_ucp", "well_known_agent_json",
    "well_known_agents_json", "well_known_agent_card", "root_agent_json", "openapi_json",
    "api_openapi_json", "payment_probe", "x402_json", "x402_well_known", "remote_x402",
    "products_json", "api_products",
]
NON_SURFACE_PROBES = ["homepage", "robots_txt", "sitemap_xml"]
EVIDENCE_PROBES = ["robots_txt", "llms_txt", "llms_full_txt"]

# --- fixed values: labels -----------------------------------------------------------
LABEL_PRIORITY = {
    "unreachable": 0, "no_clear_signal": 1, "crawl_basics_only": 2, "rate_limited": 3,
    "ai_readable": 4, "catalog_surface": 5, "callable_surface": 6, "offer_surface": 7,
    "machine_payable": 8,
}
RERUN_LABELS = ["catalog_surface", "callable_surface", "rate_limited"]

# --- fixed values: public surfaces ----------------------------------------------------
SURFACE_GROUPS = {
    "robots_present": ["robots_txt"],
    "sitemap_present": ["sitemap_xml"],
    "llms_present": ["llms_txt"],
    "llms_full_present": ["llms_full_txt"],
    "openapi_present": ["openapi_json", "api_openapi_json"],
    "agent_present": ["well_known_agent_json", "root_agent_json", "well_known_agents_json", "root_agents_json"],
    "agent_card_present": ["well_known_agent_card"],
    "ucp_present": ["well_known_ucp"],
    "commerce_present": ["well_known_commerce"],
    "x402_present": ["x402_json", "x402_well_known", "remote_x402"],
    "products_present": ["products_json", "api_products"],
}
SUMMARY_GROUPS = {
    "homepage": ["homepage"],
    "robots_txt": ["robots_txt"],
    "sitemap_xml": ["sitemap_xml"],
    "llms_txt": ["llms_txt"],
    "llms_full_txt": ["llms_full_txt"],
    "openapi": ["api_openapi_json", "openapi_json"],
    "agent": ["well_known_agent_json", "root_agent_json", "well_known_agents_json", "root_agents_json"],
    "agent_card": ["well_known_agent_card"],
    "ucp": ["well_known_ucp"],
    "commerce": ["well_known_commerce"],
    "x402": ["remote_x402", "x402_json", "x402_well_known"],
    "products": ["api_products", "products_json"],
    "cart": ["cart_json"],
    "payment_probe": ["payment_probe"],
}
READABLE_WEIGHTS = {"robots_present": 10, "sitemap_present": 10, "llms_present": 45, "llms_full_present": 35}
CALLABLE_WEIGHTS = {
    "openapi_present": 40, "agent_present": 25, "agent_card_present": 15,
    "commerce_present": 10, "x402_present": 10,
}
COMMERCE_WEIGHTS = {
    "products_present": 40, "ucp_present": 30, "commerce_present": 30,
    "has_sample_offers": 10, "has_sample_products": 10,
}
PUBLIC_PREFIX = "top-sites/v1"
RECEIPT_PREFIX = "receipts/v1"
EVIDENCE_PREFIX = "evidence/v1"
SITEMAP_PREFIX = "sitemaps/top-sites/v1"
PAGE_SIZE = 30
SITEMAP_PAGE_SIZE = 1000
EVIDENCE_FILES = {"robots_txt": "robots.txt", "llms_txt": "llms.txt", "llms_full_txt": "llms-full.txt"}
LLMS_FULL_MAX_RANK = 10_000
LLMS_FULL_MAX_SIZE = 32_768

# --- fixed values: media types ----------------------------------------------------------
TEXT_MEDIA_TYPES = [
    "application/ecmascript", "application/javascript", "application/json", "application/ld+json",
    "application/x-javascript", "application/x-json", "application/xml", "text/ecmascript",
    "text/html", "text/javascript", "text/json", "text/markdown", "text/plain", "text/xml",
]

# --- fixed values: payment vocabulary ---------------------------------------------------
# A house network of one vendor is deliberately not listed; pass it as an extra provider
# (with its name in `saved_card_providers`) where it matters.
PROVIDER_MARKERS = {
    "asterpay": ["asterpay", "asterpay.io"],
    "circle": ["circle", "circle.com", "circle gateway"],
    "coinbase": ["coinbase", "coinbase.com"],
    "crossmint": ["crossmint"],
    "google_pay": ["com.google.pay", "gpay", "google pay", "pay.google.com"],
    "nevermined": ["nevermined", "nevermined.ai"],
    "paypal": ["paypal"],
    "polar": ["polar"],
    "shopify": ["shopify", "myshopify.com"],
    "stripe": ["stripe", "stripe-subscription", "stripe machine payments"],
    "skyfire": ["skyfire"],
    "tempo": ["tempo"],
    "x402": ["x402"],
}
RAIL_MARKERS = {
    "card": ["card", "visa", "mastercard", "master card", "american_express", "amex", "discover", "diners_club"],
    "digital_wallet": ["com.google.pay", "gpay", "google pay", "pay.google.com", "apple pay"],
    "crypto": ["usdc", "usdt", "bitcoin", "ethereum", "solana", "coinbase", "walletconnect", "nevermined", "asterpay"],
    "saved_card": ["saved card", "saved-card", "stripe-subscription", "card_network_machine_payments"],
    "x402": ["x402", "payment required"],
}
CRYPTO_WORDS = ["usdc", "usdt", "solana", "base", "ethereum", "wallet", "coinbase", "eip155"]
NAMED_PROVIDER_SECTIONS = ["nevermined", "skyfire", "crossmint", "asterpay"]

# --- fixed values: currencies with other than two decimals --------------------------------
ZERO_DECIMAL_CURRENCIES = [
    "BIF", "CLP", "DJF", "GNF", "JPY", "KMF", "KRW", "MGA",
    "PYG", "RWF", "UGX", "VND", "VUV", "XAF", "XOF", "XPF",
]
THREE_DECIMAL_CURRENCIES = ["BHD", "IQD", "JOD", "KWD", "LYD", "OMR", "TND"]

# --- fixed values: status words -----------------------------------------------------------
LIVE_STATUSES = ["active", "available", "enabled", "live"]
PRELAUNCH_STATUSES = [
    "coming_soon", "pending", "pending_activation", "planned", "pre_launch", "preorder", "pre_order",
]
PLACEHOLDER_MARKERS = [
    "your_", "example.com", "merchant.com", "shop name", "12345678901234567890",
    "your-forter", "your_forter", "sandbox.checkouttools.com",
]

# --- fixed values: body and URL markers ----------------------------------------------------
LOGIN_HOST_MARKERS = ["login.", "signin.", "auth.", "sso.", "passport.", "accounts.", "id."]
LOGIN_BODY_MARKERS = [
    "retpath", "is_autologin", "passport", "signin", "login",
    "document.createelement('form')", 'document.createelement("form")',
]
HTML_MARKERS = [
    "<!doctype html", "<html", "<head", "<body", "<title", "<meta ", "<script", "<iframe", "<frame",
    "<style", "<center", "<table", "<tr", "<td", "<form", "<div", "<span", "<p", "<a ",
    "<h1", "<h2", "<h3", "<h4", "<h5", "<h6",
]
MARKUP_STARTS = [
    "<error", "<response", "<message", "<status", "<statuscode", "<code", "<resource",
    "<urlset", "<sitemapindex", "<rss", "<feed",
]
ERROR_PAGE_MARKERS = [
    "web firewall security policies", "security policies have been blocked",
    "request / response that are contrary", "detect url", "common-error", "wh_errcode=404",
]
CHECKOUT_URL_MARKERS = [
    "shop.app/checkout/", "/checkouts/", "/checkout", "/cart/", "cart_link_id=",
    "redirect_source=checkout", "shop_pay_callback", "skip_shop_pay=",
]
SHOP_MARKERS = ["shopify", "myshopify.com", "cdn.shopify.com", "shopify.theme"]
API_BASE_MARKERS = ["api base", "base url", "rest api base", "gateway", "base:"]

# --- fixed values: document keys -----------------------------------------------------------
COMMERCE_KEYS = [
    "auth", "billing_provider", "checkout", "checkout_url", "commerce", "offer", "offerings", "offers",
    "payment", "paymentHandlers", "price", "pricing", "purchase", "x402",
]
COMMERCE_WORDS = ["price", "offer", "checkout", "payment", "purchase", "commerce"]
AGENT_KEYS = [
    "name", "description", "url", "version", "protocols", "capabilities", "tools", "server_info",
    "skills", "auth", "endpoints",
]
AGENTS_LIST_KEYS = ["agents", "workflows", "items", "results"]
X402_KEYS = ["x402", "x402version", "x402_version"]
X402_DISCOVERY_KEYS = [
    "accepts", "currencies", "endpoint", "endpoints", "extensions", "payment", "payment_required",
    "resource", "resources", "service", "services",
]
X402_CHALLENGE_KEYS = [
    "amount", "asset", "basepriceusd", "basetotalpriceusd", "beneficiary", "catalogdescription",
    "catalogtitle", "currency", "discountbps", "discountedpriceusd", "discountpercent", "externalurl",
    "price", "prices", "recipient",
]
X402_LIST_KEYS = [
    "accepts", "resource", "resources", "services", "endpoints", "extensions", "payment", "payment_required",
]
X402_ERROR_KEYS = [
    "code", "contribution", "details", "error", "errors", "message", "path", "status", "statuscode",
    "timestamp", "type",
]
X402_ERROR_TRIGGERS = ["error", "errors", "message", "status", "statuscode", "type", "code"]
X402_PROBE_NOTES = [
    "does not accept", "canonical x402 probe", "always returns 402", "probe", "example",
    "inspect the payment-required envelope",
]
OPENAPI_METHODS = ["get", "post", "put", "patch", "delete", "options", "head"]
OPENAPI_COMMERCE_TOKENS = ["commerce", "checkout", "purchase", "buy", "billing", "subscription"]
DISCOVERY_NOUNS = ["agents", "products", "assets", "resources", "servers", "catalog", "registry", "directory"]
DISCOVERY_VERBS = ["list", "browse", "search", "index"]
QUERY_STOPWORDS = [
    "about", "buy", "collection", "collections", "free", "gift", "gifts", "home", "kids", "life",
    "luxury", "mens", "online", "official", "sale", "shop", "shopping", "site", "store", "style", "styles",
]
OBSERVED_KEYS = [
    "observed_capability_names", "observed_payment_protocols", "observed_payment_methods",
    "observed_payment_providers", "observed_payment_handler_names", "observed_payment_assets",
    "observed_payment_networks", "observed_payment_flow_types", "observed_payment_requirement_keys",
    "observed_catalog_endpoints", "observed_quote_endpoints", "observed_checkout_endpoints",
    "observed_order_status_endpoints",
]

# --- fixed values: payment candidate ranking -----------------------------------------------
CANDIDATE_PROBE_ORDER = [
    "api_openapi_json", "openapi_json", "api_products", "products_json", "x402_json",
    "x402_well_known", "remote_x402", "well_known_agent_json", "root_agent_json", "well_known_agent_card",
]
CANDIDATE_WORD_SCORES = [
    (50, ["buy", "order", "checkout", "purchase", "send", "report"]),
    (40, ["search"]),
    (20, ["scrape", "crawl"]),
    (-20, ["status", "read", "messages", "list", "health", "stats"]),
]
CANDIDATE_SOURCE_SCORES = {
    "openapi": 10, "agent_x402": 8, "x402": 6, "ucp_catalog_checkout": 14, "catalog_checkout": 12,
}

# --- fixed values: facts copied into a receipt's aggregates -----------------------------------
PRODUCT_AGGREGATES = [
    "product_count", "variant_count", "priced_variant_count", "currency_count", "currency_codes",
    "min_price", "max_price", "sample_titles", "preorder_product_count", "stock_statuses",
    "checkout_url_count", "sample_checkout_urls",
]
CART_AGGREGATES = ["currency", "item_count", "requires_shipping", "has_token"]
OPENAPI_AGGREGATES = [
    "path_count", "auth_schemes", "commerce_path_count", "payment_required_operation_count",
    "payment_required_paths", "payment_signature_header_count",
]
COMMERCE_AGGREGATES = [
    "commerce_status", "offer_count", "active_offer_count", "priced_offer_count", "sample_offers",
    "checkout_url", "purchase_intent_urls", "purchase_intent_url_count", "offer_lookup_urls",
    "offer_lookup_url_count", "purchase_intent_auth", "checkout_state", "billing_provider_name",
    "billing_provider_status", "live_machine_payment_path_ids", "live_machine_payment_path_labels",
    "live_machine_payment_path_kinds", "live_machine_payment_path_count", "payment_provider_hints",
    "payment_rail_hints", "payment_endpoint_hosts", "payment_surface", "crypto_only", "prelaunch",
]
UCP_AGGREGATES = [
    "ucp_version", "capability_count", "capability_names", "service_count", "shopping_mcp_endpoints",
    "payment_handler_count", "payment_handler_names", "payment_handler_ids", "payment_endpoint_samples",
    "payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts", "payment_surface", "crypto_only",
]
X402_AGGREGATES = [
    "resource_urls", "resource_url_count", "accept_count", "accept_networks", "accept_assets",
    "accept_currencies", "instructions_char_count", "payment_provider_hints", "payment_rail_hints",
    "payment_endpoint_hosts", "payment_surface", "crypto_only", "sample_actions", "priced_action_count",
]
PAYMENT_PROBE_AGGREGATES = [
    "probe_method", "probe_url", "probe_result", "response_keys", "response_char_count",
    "payment_required_header_present", "www_authenticate_present", "candidate_source", "candidate_title",
    "candidate_sample_title", "candidate_amount", "candidate_currency", "candidate_body", "sample_actions",
    "resource_urls", "accept_count", "accept_networks", "accept_assets", "accept_currencies",
    "payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts", "payment_surface", "crypto_only",
]
AGENT_LIST_FACTS = [
    "public_endpoint_urls", "product_urls", "docs_urls", "order_urls", "register_urls", "wallet_guides_urls",
    "x402_urls", "payment_network_names", "payment_chain_ids", "payment_currency_codes", "payment_assets",
    "payment_provider_hints", "payment_rail_hints", "payment_endpoint_hosts",
]
AGENT_SCALAR_FACTS = [
    "service_url", "api_base_url", "docs_url", "openapi_url", "x402_url", "brand_facts_url", "llms_url",
    "payment_protocol", "recommended_client", "payment_surface",
]
AGENT_DOCUMENTS = ["well_known_agent_json", "root_agent_json", "well_known_agent_card"]
CALLABLE_PROBES = [
    "openapi_json", "api_openapi_json", "well_known_commerce", "well_known_agent_json",
    "well_known_agents_json", "well_known_agent_card", "root_agent_json", "x402_json",
    "x402_well_known", "remote_x402",
]
