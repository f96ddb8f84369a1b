"""Source profiles: one data-only rulebook per shop.

Everything here is a fixed value that decides results: names, selectors, regexes and word lists,
stated in order of significance.  Regexes are in Python's dialect (see functions.patterns).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from shelfmark.operators.shred import Groups


@dataclass(frozen=True)
class SourceProfile:
    source: str
    family: str                      # which field rules apply: "press", "studio" or "retail"
    name: str
    website: str
    default_description: str
    domains: list[str]
    product_markers: list[str]       # a link or page URL with any of these is a product
    stop_markers: list[str] | None   # None: a page without new products always ends paging
    page_number: list[str]           # regexes for the page number in a URL
    next_link: list[str]
    numbered_link: list[str]
    load_more: list[str]
    publisher_description: str
    product: dict[str, str | Groups] = field(repr=False, default_factory=dict)
    series_start: list[tuple[str, bool]] = field(default_factory=list)      # (regex, ignore case)
    series_trim: list[str] = field(default_factory=list)
    series_deny: list[str] = field(default_factory=list)
    issue: list[tuple[str, bool]] = field(default_factory=list)
    artist_deny: list[str] = field(default_factory=list)
    binding: list[tuple[str, str]] = field(default_factory=list)


# ---- fixed values shared by the two WooCommerce shops --------------------------------------

WOO_NEXT = ["a.next::attr(href)", ".next.page-numbers::attr(href)", ".woocommerce-pagination a.next::attr(href)",
            'a[rel="next"]::attr(href)', ".pagination a.next::attr(href)", ".woocommerce-pagination .next::attr(href)"]
WOO_NUMBERED = [".page-numbers a::attr(href)", ".woocommerce-pagination a::attr(href)",
                ".pagination a::attr(href)", "nav.pagination a::attr(href)"]
WOO_LOAD_MORE = ["a.load-more::attr(href)", "button.load-more::attr(data-url)",
                 ".load-more::attr(data-url)", "[data-page]::attr(data-url)"]
WOO_PAGE_NUMBER = [r"/page/(\d+)/?", r"[?&]paged?=(\d+)"]

SHORT = ".woocommerce-product-details__short-description"
TAB = ".woocommerce-Tabs-panel--description"
TAB_DIV = 'div[class*="woocommerce-Tabs-panel--description"]'
INFO = ".woocommerce-Tabs-panel--additional_information"

WOO_PRODUCT = {
    "title": "h1.product_title::text, h1.entry-title::text, .product-title::text",
    "title_any": "h1::text",
    "price_was": ".price del .woocommerce-Price-amount::text, .price del .amount::text, .price del bdi::text, "
                 ".original-price::text",
    "price_cut": ".price ins .woocommerce-Price-amount::text, .price ins .amount::text, .price ins bdi::text",
    "price_plain": ".price .woocommerce-Price-amount::text, .price .amount::text, .current-price::text",
    "price_all": ".price .woocommerce-Price-amount::text, .price .amount::text, .price bdi::text",
    "short_p": f"{SHORT} p::text, .product-short-description p::text",
    "tab_p": f"{TAB} p::text, .woocommerce-tabs .description p::text",
    "short_own": f"{SHORT}::text, .product-short-description::text",
    "info_rows": Groups(f"{INFO} tr, .product_meta tr", {"cells": Groups("td, th", {"chunks": "*::deep"})}),
    "image": ".woocommerce-product-gallery__image img::attr(src), .product-image img::attr(src), "
             "img.wp-post-image::attr(src)",
    "language_meta": ".product_meta::html, .product-categories::html",
    "page_count": ".page-count::text, [data-pages]::attr(data-pages), .pages::text, "
                  "[data-page-count]::attr(data-page-count)",
    "pages_meta": f".product_meta::html, {INFO}::html",
    "isbn": ".sku::text, [data-isbn]::attr(data-isbn)",
}

PRESS_PRODUCT = WOO_PRODUCT | {
    "headed_p": 'h2:heading("Description") + * p::text, h3:heading("Description") + * p::text',
    "tab_own": f"{TAB}::text, .woocommerce-tabs .description::text",
    "headed_all": 'h2:heading("Description") + *::deep, h3:heading("Description") + *::deep',
    "credit_block": f".product_meta::html, {SHORT}::html",
    "credit_text": f".product_meta *::text, {SHORT} *::text",
    "categories": ".product-categories a::text, .posted_in a::text",
}

STUDIO_PRODUCT = WOO_PRODUCT | {
    "div_p": f"{TAB_DIV} p:outside(table)::deep",
    "div_text": f"{TAB_DIV}::deep(h2,table)",
    "div_text_plain": f"{TAB_DIV}::deep(h2,table,h3)",
}

LANGUAGE_TRIM = [(r"\s+English\s+", " "), (r"\s+Hindi\s+", " "), (r"\s+English\s*$", ""), (r"\s+Hindi\s*$", "")]

INFO_WRITER = ["writer", "writers"]
INFO_ARTIST = ["art", "artist", "artwork", "artists"]
INFO_COLORIST = ["colorist", "colors", "colourist", "colours", "colorists"]

BINDING_WORDS = [(["hardbound", "hard bound"], "Hardbound"), (["paperback", "paper back"], "Paperback"),
                 (["hardcover", "hard cover"], "Hardcover"), (["softcover", "soft cover"], "Softcover")]
BINDING_WORDS_STUDIO_KEY = [(["hardbound", "hard bound"], "Hardbound"), (["paperback", "paper back"], "Paperback"),
                            (["hardcover", "hard cover", "hc"], "Hardcover"), (["softcover", "soft cover"], "Softcover"),
                            (["deluxe"], "Deluxe Edition")]
BINDING_WORDS_STUDIO = BINDING_WORDS + [(["deluxe"], "Deluxe Edition")]
BINDING_WORDS_RETAIL = [(["hardbound", "hard bound"], "Hardbound"), (["paperback", "paper back"], "Paperback"),
                        (["hardcover", "hard cover"], "Hardcover"), (["softcover"], "Softcover")]

# Words that show that a text is no artist's name.
ARTIST_DENY = [
    "litespeed", "cache", "comments", "feed", "quantity", "logged", "customers", "purchased", "product", "review", "there",
    "are", "no", "reviews", "yet", "only", "may", "leave", "hand", "painted", "variant", "cover", "wraparound", "poster",
    "homage", "action", "figure", "regular", "hardbound", "paperback", "hardcover", "english", "hindi", "issue", "shot", "one",
]

PAGES_WORD = r"\b(\d+)\s*(?:pages?|pgs?|p\.?)\b"
PAGES_ANYWHERE = r"(?:pages?|pgs?)[:\s]+(\d+)\b"
MIN_PAGES, MAX_PAGES = 1, 10000
UPLOAD_PATH = r"/wp-content/uploads/(\d{4})/(\d{1,2})/"
UPLOAD_DAY = 25

# Words are taken for good (a word never gives back what the next one could use), so that a long run of words is a loop and no recursion.
NAME = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)++)"
NAME_OR_WORD = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*+)"
ARTIST_IN_TITLE = rf"\bby\s+{NAME}"
ARTIST_IN_DESCRIPTION = [rf"\b(?:by|artist|art by|artwork by|illustrated by|drawn by)\s+{NAME}",
                         rf"(?:artist|artwork|illustrator)[:\s]+{NAME}"]
ARTIST_IN_META = rf"\b(?:artist|art|art by|artwork by|illustrated by|drawn by)[:\s]+{NAME}"
COVER_ARTIST = [rf"cover\s+(?:by|artist)[:\s]+{NAME_OR_WORD}", rf"variant\s+by\s+{NAME_OR_WORD}"]
REVIEW_TAILS = [r"There are no reviews yet.*", r"Only logged in customers.*"]

# ---- fixed values of the description rules --------------------------------------------------

PRESS_NOISE = ["add to cart", "wishlist", "share", "category", "reviews", "logged in customers", "writer", "art", "pages",
               "quantity", "there are no reviews", "only logged in"]
PRESS_TAIL = r"\s*(Writer|Art|Pages|Category).*$"
STUDIO_NOISE = ["add to cart", "wishlist", "share", "quantity", "logged in customers", "there are no reviews",
                "only logged in", "you may also like", "related products", "description"]
STUDIO_TAIL = r"\s*(Writer|Art|Pages|Category|Additional Information|Description).*$"

# ---- fixed values of the cart retailer ------------------------------------------------------

RETAIL_BRAND = ['a[href*="manufacturer"]::text', 'a[href*="brand"]::text', ".manufacturer a::text", ".brand a::text",
                'span:contains("Brand") + a::text', 'span:contains("Manufacturer") + a::text',
                'td:contains("Brand") + td a::text', 'td:contains("Manufacturer") + td a::text',
                ".manufacturer::text", ".brand::text", '[itemprop="brand"]::text', ".product-brand::text"]
RETAIL_DESCRIPTION = [".product-description::text", ".description::text", "#tab-description::text",
                      ".tab-content .description::text"]
RETAIL_IMAGE_BOXES = [".product-image img::attr(data-zoom-image)", ".product-image img::attr(data-large-image)",
                      ".product-image img::attr(data-full-image)", ".image img::attr(data-zoom-image)",
                      "#product-image img::attr(data-zoom-image)", "img.product-image::attr(data-zoom-image)",
                      ".product-image img::attr(src)", ".image img::attr(src)", "#product-image img::attr(src)",
                      "img.product-image::attr(src)", ".thumbnails img::attr(data-zoom-image)",
                      ".thumbnails img::attr(src)"]

RETAIL_PRODUCT = {
    "title": "h1::text, .product-title::text, .product-name h1::text",
    "title_any": "h1.product-title::text",
    **{f"brand_{i}": s for i, s in enumerate(RETAIL_BRAND)},
    "brand_rows": Groups(".attribute tr, .product-attributes tr, table.attribute tr, .product-info tr", {
        "all": "*::deep",
        "key": "td:first-child::text, th:first-child::text",
        "links": "td:last-child a::text, td:nth-child(2) a::text",
        "texts": "td:last-child::text, td:nth-child(2)::text",
        "values": "td:last-child a::text, td:last-child::text, td:nth-child(2) a::text, td:nth-child(2)::text",
    }),
    "info_rows": Groups(".attribute tr, .product-attributes tr", {
        "key": "td:first-child::text, th:first-child::text",
        "value": "td:last-child::text, th:last-child::text",
    }),
    "price_was": 'ul.list-unstyled li span[style*="line-through"]::text, ul.list-unstyled li span:contains("₹")::text',
    "price_was_first": "ul.list-unstyled li:first-child span::text",
    "price_now": "ul.list-unstyled li h2::text",
    "price_all": "ul.list-unstyled li span::text, ul.list-unstyled li h2::text",
    "price_new": ".price-new::text, .product-info .price-new::text",
    "price_old": ".price-old::text, .product-info .price-old::text",
    **{f"description_{i}": s for i, s in enumerate(RETAIL_DESCRIPTION)},
    "description_areas": Groups("#tab-description, .tab-description, .product-description", {"texts": "*::deep"}),
    "description_raw": ".product-description::text, .description::text, #tab-description::text",
    "thumb_link": "ul.thumbnails a.thumbnail::attr(href)",
    "thumb_image": "ul.thumbnails img::attr(src)",
    "areas": Groups(".col-sm-6:first-child, .col-sm-8, .product-info, .product-image, #product, .col-md-6:first-child", {
        "zoom": "img::attr(data-zoom-image)", "large": "img::attr(data-large-image)", "full": "img::attr(data-full-image)",
        "lazy": "img::attr(data-src)", "src": "img::attr(src)",
        "all": "img::attr(src), img::attr(data-src), img::attr(data-zoom-image)",
    }),
    **{f"image_box_{i}": s for i, s in enumerate(RETAIL_IMAGE_BOXES)},
    "left_images": ".col-sm-6:first-child img::attr(src), .col-md-6:first-child img::attr(src), "
                   ".col-lg-6:first-child img::attr(src)",
    "related_images": ".related-products img::attr(src), .product-related img::attr(src), "
                      ".product-layout img::attr(src), .product-grid img::attr(src)",
    "page_images": "img::attr(src), img::attr(data-src)",
    "last_resort": ".col-sm-6:first-child img::attr(src), .product-info img::attr(src), .product-image img::attr(src)",
}

BRAND_DENY = ["comicsadda", "comics adda", "n/a", "none", ""]
PUBLISHER_DENY = ["brands", "individual"] + BRAND_DENY
PUBLISHER_UNKNOWN = "Unknown"
PUBLISHED_BY = [r"published\s+by\s+([^\.\n]+)", r"produced\s+by\s+([^\.\n]+)"]
RETAIL_PRICE_RANGE = (10, 100000)
RETAIL_PAGES = [r"pages?[:\s]+(\d+)", r"(\d+)\s*pages?", r"page\s+count[:\s]+(\d+)", r"no\s+of\s+pages?[:\s]+(\d+)",
                r"number\s+of\s+pages?[:\s]+(\d+)"]
RETAIL_TITLE_PAGES = r"(\d+)\s*pages?"
RETAIL_DATES = [r"(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})", r"(\d{4}[-/]\d{1,2}[-/]\d{1,2})"]

# ---- the three sources ----------------------------------------------------------------------

_STOP = r"\s+Issue\s+\d+|\s+Vol\.|\s+Vol\s+\d+|\s+Volume\s+\d+|\s+Volume\s+|\s+Stage\s+\d+|[:–\-#]"
_SUFFIX = [r"\s+Issue\s*$", r"\s+issue\s*$", r"\s+Hardcover\s*$", r"\s+Paperback\s*$", r"\s+Variant\s+Cover\s*$",
           r"\s+Variant\s*$", r"\s+Regular\s+Cover\s*$", r"\s+English\s+Hardcover\s*$", r"\s+Hindi\s+Hardcover\s*$",
           r"\s+English\s+Paperback\s*$", r"\s+Hindi\s+Paperback\s*$"]

PRESS = SourceProfile(
    source="bullseye_press", family="press", name="Bullseye Press", website="https://bullseyepress.in",
    default_description="Indian comic book publisher", domains=["bullseyepress.in"],
    product_markers=["/product/"], stop_markers=None, page_number=WOO_PAGE_NUMBER,
    next_link=WOO_NEXT, numbered_link=WOO_NUMBERED, load_more=WOO_LOAD_MORE,
    publisher_description=".site-description::text, footer p::text",
    product=PRESS_PRODUCT,
    series_start=[(r"^([^–\-0-9]+)", False)],
    series_trim=_SUFFIX + [r"\s+Combo\s+Issue\s*$", r"\s+Combo\s*$"],
    series_deny=["Issue", "issue", "English", "Hindi", "Variant Cover", "Variant", "Regular Cover", "Issue 2", "Issue 3",
                 "Issue 1-4", "Combo of", "English Hardcover", "Hindi Hardcover", "English Paperback", "Hindi Paperback"],
    issue=[(r"Issue\s+(\d+)", True), (r"\b(\d+)\b", False)],
    artist_deny=ARTIST_DENY,
    binding=[(r"\b(hardbound|hard\s*bound)\b", "Hardbound"), (r"\b(paperback|paper\s*back)\b", "Paperback"),
             (r"\b(hardcover|hard\s*cover)\b", "Hardcover"), (r"\b(softcover|soft\s*cover)\b", "Softcover")],
)

STUDIO = SourceProfile(
    source="holy_cow", family="studio", name="Holy Cow Entertainment", website="https://www.holycow.in",
    default_description="Pioneering and unique publisher of comics in India", domains=["holycow.in"],
    product_markers=["/product/"], stop_markers=None, page_number=WOO_PAGE_NUMBER,
    next_link=WOO_NEXT, numbered_link=WOO_NUMBERED, load_more=WOO_LOAD_MORE,
    publisher_description=".site-description::text, footer p::text, .about-description::text",
    product=STUDIO_PRODUCT,
    series_start=[(rf"^(.+?)(?:{_STOP})", True), (r"^([^:–\-#]+)", False)],
    series_trim=[r"\s+Issue\s+\d+\s*$", r"\s+Issue\s*$", r"\s+Vol\.?\s+\d+\s*$", r"\s+Vol\.?\s*$", r"\s+Volume\s+\d+\s*$",
                 r"\s+Volume\s*$", r"\s+Stage\s+\d+\s*$", r"\s+Stage\s*$"]
                + _SUFFIX + [r"\s+Box\s+Set\s*$", r"\s+Deluxe\s+Edition\s*$"],
    series_deny=["Issue", "issue", "English", "Hindi", "Variant Cover", "Variant", "Regular Cover", "Box Set",
                 "Deluxe Edition", "Born Again", "Vol", "Volume", "Stage"],
    issue=[(r"#(\d+)", True), (r"Vol\.\s*(\d+)", True), (r"\b(\d+)\b", False)],
    artist_deny=ARTIST_DENY + ["box", "set"],
    binding=[(r"\b(hardbound|hard\s*bound)\b", "Hardbound"), (r"\b(paperback|paper\s*back)\b", "Paperback"),
             (r"\b(hardcover|hard\s*cover|hc)\b", "Hardcover"), (r"\b(softcover|soft\s*cover)\b", "Softcover"),
             (r"\b(deluxe\s*edition)\b", "Deluxe Edition")],
)

RETAIL = SourceProfile(
    source="comics_adda", family="retail", name="ComicsAdda", website="https://comicsadda.com",
    default_description="Online comic book store offering a wide range of Indian and international comics",
    domains=["comicsadda.com"],
    product_markers=["/product/", "route=product/product"], stop_markers=["page=", "/page/"],
    page_number=[r"[?&]page=(\d+)"],
    next_link=['a[rel="next"]::attr(href)', ".pagination .next::attr(href)",
               '.pagination a:contains("Next")::attr(href)', '.pagination a:contains(">")::attr(href)'],
    numbered_link=[".pagination a::attr(href)", ".pagination li a::attr(href)"], load_more=[],
    publisher_description=".about-us p::text, footer p::text, .site-description::text",
    product=RETAIL_PRODUCT,
    series_start=[(rf"^(.+?)(?:{_STOP}|\(Pre Booking\)|\(Prebooking\))", True), (r"^([^:–\-#(]+)", False)],
    series_trim=[r"\s+Issue\s+\d+\s*$", r"\s+Vol\.?\s+\d+\s*$", r"\s+Volume\s+\d+\s*$", r"\s+Stage\s+\d+\s*$",
                 r"\s+Issue\s*$", r"\s+Hardcover\s*$", r"\s+Paperback\s*$", r"\s+Variant\s*$", r"\s+Regular\s+Cover\s*$",
                 r"\s+Pre\s+Booking\s*$", r"\s+Prebooking\s*$"],
    series_deny=["Issue", "issue", "English", "Hindi", "Variant", "Pre Booking", "Prebooking"],
    issue=[(r"Issue[-\s]*(\d+)", True), (r"Vol\.?\s*(\d+)", True)],
    binding=[(r"\b(hardbound|hard\s*bound|hb)\b", "Hardbound"), (r"\b(paperback|paper\s*back|pb)\b", "Paperback"),
             (r"\b(hardcover|hard\s*cover|hc)\b", "Hardcover"), (r"\b(softcover|soft\s*cover)\b", "Softcover"),
             (r"\b(deluxe\s*edition)\b", "Deluxe Edition")],
)

PROFILES = [PRESS, STUDIO, RETAIL]
DISPLAY_NAMES = {p.source: p.name for p in PROFILES}
