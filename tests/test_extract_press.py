"""Golden product pages of the first WooCommerce profile, one rule per page."""

import pytest

from golden import check, extract_all
from shelfmark.profiles import PRESS

URL = "https://shop.example/product/x/"

PAGE = """<html><body><h1 class="product_title entry-title">Raj Rahman 2 English Regular Cover by Deepjoy Subba</h1>
<p class="price"><del><span class="woocommerce-Price-amount amount"><bdi>449</bdi></span></del>
<ins><span class="woocommerce-Price-amount amount"><bdi>404</bdi></span></ins></p>
<div class="woocommerce-product-details__short-description"><p>A long tale of two cities under the moon.</p><p>tiny</p></div>
<div class="woocommerce-product-gallery__image"><img src="/wp-content/uploads/2024/10/c-600x897.jpeg"></div>
<div class="woocommerce-Tabs-panel--additional_information"><table>
<tr><th>Writer</th><td>Ann Lee, Bob Ray &amp; Cy</td></tr><tr><th>Colours</th><td>Dee</td></tr><tr><th>Pages</th><td>68 Pages</td></tr>
<tr><th>Format</th><td>Paper Back</td></tr></table></div>
<div class="product_meta"><span class="sku">ISBN-1</span><span class="posted_in"><a>Comics</a>, <a>Uncategorized</a></span></div>
</body></html>"""


def body(title="Yagyaa", extra=""):
    return f"<h1>{title}</h1>{extra}"


def desc(text):
    return f'<div class="product-short-description"><p>{text}</p></div>'


# (html, url, expected fields); None as a whole: no record
CASES = [
    (PAGE, URL, dict(
        title="Raj Rahman 2 English Regular Cover by Deepjoy Subba", series="Raj Rahman", issue=2, original_price=449.0, price=404.0,
        description="A long tale of two cities under the moon.", writers=["Ann Lee", "Bob Ray", "Cy"], colorists=["Dee"],
        artists=["Deepjoy Subba"], cover_artist="Deepjoy Subba", listing_date="2024-10-25",
        cover_image_url="https://shop.example/wp-content/uploads/2024/10/c-600x897.jpeg", language="English", binding="Paperback",
        pages=68, isbn="ISBN-1", genre=["Comics"], publisher=PRESS.name, url=URL, scraped_at="2025-11-25T09:30:00+05:30",
        additional_info={"Writer": "Ann Lee, Bob Ray & Cy", "Colours": "Dee", "Pages": "68 Pages", "Format": "Paper Back"},
        parse_issue=None)),
    # titles
    *[(body(title), URL, dict(series=series, issue=issue)) for title, series, issue in [
        ("Raj Rahman 2", "Raj Rahman", 2), ("Yagyaa Origins – Issue 5", "Yagyaa Origins", 5), ("7 Days Issue 3", None, None),
        ("Yagyaa Hindi Paperback", "Yagyaa", None), ("Go 2", None, 2), ("Yagyaa Combo Issue", "Yagyaa", None),
        ("Issue 5", None, 5), ("Nagraj १२", "Nagraj १२", 12)]],
    # prices
    (body(extra='<p class="price"><span class="amount">₹1,299.50</span></p>'), URL, dict(price=1299.5, original_price=None)),
    (body(extra='<p class="price"><bdi>100</bdi></p><p class="price"><bdi>300</bdi><bdi>200</bdi></p>'), URL,
     dict(original_price=300.0, price=200.0)),
    (body(extra='<p class="price"><span class="amount">0.00</span></p>'), URL, dict(price=None)),
    # "art" occurs inside "party": everything is filtered, so the raw text comes back uncut
    (body(extra=desc("The party starts at dawn, says the tale.")), URL, dict(description="The party starts at dawn, says the tale.")),
    (body(extra="<h2>Description of it</h2><div><p>Someone walks through the old town.</p></div>"), URL,
     dict(description="Someone walks through the old town.")),
    (body(extra="<h3>Description</h3><div>Someone walks <b>through the old</b> town at night once again.</div>"), URL,
     dict(description="town at night once again.")),
    (body(extra=desc("Short: label only here") + desc("but this one is kept as it is long enough")), URL,
     dict(description="Short: label only here but this one is kept as it is long enough")),
    # records cut short
    (body("Yagyaa 2", '<div class="product_meta"><table><tr><th> </th><td>x</td></tr></table><span class="sku">S</span></div>'
          '<p class="price"><span class="amount">50</span></p>'), URL,
     dict(parse_issue="blank_info_cell", title="Yagyaa 2", price=50.0, publisher=PRESS.name, url=None, scraped_at=None, series=None,
          isbn=None, additional_info=None, genre=None, page_url=URL)),
    (body("Yagyaa 2", desc(" ") + '<span class="sku">S</span>'), URL,
     dict(parse_issue="null_description", url=None, series="Yagyaa", issue=2, isbn=None)),
    (body("Yagyaa 2 Hindi", desc(" ") + '<span class="sku">S</span>'), URL, dict(parse_issue=None, url=URL, isbn="S", language="Hindi")),
    (body("Yagyaa 2", '<span class="posted_in"><a> </a></span><span class="sku">S</span>'), URL,
     dict(parse_issue="blank_category", url=None, genre=None, isbn="S")),
    # page counts
    *[(body(extra=extra), URL, dict(pages=pages)) for extra, pages in [
        ('<i class="page-count">120</i>', 120), ('<i data-pages="44">x</i>', 44), (desc("A saga told in 64 pgs by many hands."), 64),
        (desc("The saga of many people and places 48."), 48),
        (desc("The 7 sages and 20000 men of the old kingdom went home."), 7),
        ('<div class="product_meta">32 p. long</div>', 32), ("<p>Pages: 96</p>", 96), ("<p>Pages: 20000</p>", None)]],
    # artists
    *[(body(title, extra), url, dict(artists=artists)) for title, url, extra, artists in [
        ("Nagraj by Anu Pam", URL, "", ["Anu Pam"]),
        ("Yagyaa", "https://s.example/product/yagyaa-by-deepjoy-subba/", "", ["Deepjoy Subba"]),
        ("Yagyaa", "https://s.example/product/yagyaa-by-deepjoy-subba", "", ["Deepjoy Subba"]),
        ("Yagyaa by Manoj Kumar", URL, "", None),          # "no" is inside Manoj
        ("Yagyaa", URL, desc("A fine book, drawn by Anu Pam. It is long enough."), ["Anu Pam"]),
        ("Yagyaa", URL, '<div class="product_meta"><b>Artist: Ravi Verma</b></div>', ["Ravi Verma"]),
        ("Nagraj by Anu Pam", URL, '<div class="product_meta"><b>Artist: Anu pam</b></div>', ["Anu Pam"]),
        ("Nagraj by Anu Pam", URL, '<div class="product_meta"><table><tr><td>Art</td><td>Xi &amp; Yo</td></tr></table></div>', ["Xi", "Yo"])]],
    (body("Nagraj variant by Anu Pam"), URL, dict(artists=["Anu Pam"], cover_artist="Anu Pam")),
    # bindings
    *[(body(title, extra), URL, dict(binding=binding)) for title, extra, binding in [
        ("Yagyaa Hard Bound", "", "Hardbound"),
        ("Yagyaa", '<div class="product_meta"><table><tr><td>F</td><td>Soft cover</td></tr></table></div>', "Softcover"),
        ("Yagyaa", desc("The hardcover book that tells of old times."), "Hardcover"), ("Yagyaa Discover", "", None)]],
    # languages: a trailing vowel sign is no word character
    (body("राज हिंदी"), URL, dict(language=None)), (body("Raj Hin"), URL, dict(language="Hindi")),
    (body("Raj", '<div class="product-categories">english</div>'), URL, dict(language="English")),
    # a repeated label keeps its place and takes its last value
    (body(extra='<div class="product_meta"><table><tr><td>A</td><td>1</td></tr><tr><td>B</td><td>2</td></tr><tr><td>A</td><td>3</td></tr></table></div>'),
     URL, dict(additional_info={"A": "3", "B": "2"})),
    ("<h1> </h1><p class='price'><bdi>5</bdi></p>", URL, None),
    (body("Listing"), "https://shop.example/shop/", None),
    ('<base href="https://cdn.example/a/"><h1>T</h1><img class="wp-post-image" src="../b.png">', URL,
     dict(cover_image_url="https://cdn.example/b.png")),
]


@pytest.fixture(scope="module")
def records(make_pages):
    return extract_all(make_pages, PRESS, CASES)


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(records, i):
    check(records, CASES, i)
