"""Golden product pages of the cart retailer."""

import pytest

from golden import check, extract_all
from shelfmark.profiles import RETAIL

URL = "https://shop.example/index.php?route=product/product&product_id=5"
IMG = "https://shop.example/image/cache/catalog/a"


def body(title="Nagraj", extra=""):
    return f"<h1>{title}</h1>{extra}"


def prices(*items):
    return '<ul class="list-unstyled">' + "".join(f"<li>{i}</li>" for i in items) + "</ul>"


def attrs(*rows):
    return '<table class="attribute">' + "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in rows) + "</table>"


CASES = [
    *[(body(title), URL, dict(series=series, issue=issue)) for title, series, issue in [
        ("Bankelal Issue 12 (Pre Booking)", "Bankelal", 12), ("Nagraj Vol 3 Hindi", "Nagraj", 3), ("Doga-Issue-7", "Doga", 7),
        ("Chacha Chaudhary (Prebooking)", "Chacha Chaudhary", None), ("Spider-Man 2099", "Spider", None),
        ("Prebooking", None, None)]],
    # prices
    (body(extra=prices('<span style="text-decoration: line-through;">₹2,898.00INR</span>', "<h2>₹2,339.00INR</h2>")), URL,
     dict(original_price=2898.0, price=2339.0)),
    (body(extra=prices("<h2>₹99</h2>")), URL, dict(original_price=99.0, price=99.0)),
    (body(extra=prices("<span>Ex Tax: 120</span>", "<span>90</span>", "<span>5</span>")), URL, dict(original_price=120.0, price=90.0)),
    (body(extra=prices("<b>none</b>", "<span>120</span>", "<span>90</span>")), URL, dict(original_price=120.0, price=90.0)),
    (body(extra='<b class="price-old">80</b><b class="price-new">60</b>'), URL, dict(original_price=80.0, price=60.0)),
    (body(extra='<b class="price-new">60</b>'), URL, dict(original_price=60.0, price=60.0)),
    (body(), URL, dict(original_price=None, price=None)),
    # publisher
    *[(body(extra=extra), URL, dict(publisher=publisher)) for extra, publisher in [
        ('<a href="/index.php?route=product/manufacturer/info">Raj Comics</a>', "Raj Comics"),
        ('<span>Brand:</span> <a href="/x">Yali Dreams</a>', "Yali Dreams"),
        (f'<a href="/brand/1">{RETAIL.name}</a><div class="brand">Diamond</div>', "Diamond"),
        ('<a href="/brand/1">Brands</a>', "Unknown"),
        ("<table><tr><td>Brand</td><td><a>Tinkle</a></td></tr></table>", "Tinkle"),
        (attrs(("Size", "A4"), ("Publisher", "Fenil")), "Fenil"),
        (attrs(("Made", "<a>Cell Co</a> brand")), "Cell Co"),
        ('<div class="product-description">A saga published by Bakarmax Ltd. In print.</div>', "Bakarmax Ltd"),
        ('<div class="product-description">A saga PRODUCED BY Vimanika. In print.</div>', "Vimanika"),
        ('<div class="product-description">published by N/A</div>', "Unknown"), ("", "Unknown")]],
    # description
    (body(extra='<div class="description"> One <b>two</b> three </div>'), URL, dict(description="One three")),
    (body(extra='<div id="tab-description"><p>Deep <b>text</b></p></div>'), URL, dict(description="Deep text")),
    (body("Nagraj 4", prices("<h2>₹99</h2>") + '<div id="tab-description"> <p> </p></div>' + attrs(("Pages", "5"))), URL,
     dict(parse_issue="blank_description", description=None, price=99.0, url=URL, series=None, pages=None, additional_info=None,
          scraped_at="2025-11-25T09:30:00+05:30", genre=None, title="Nagraj 4")),
    # language and binding
    *[(body(title, extra), URL, dict(language=language, binding=binding)) for title, extra, language, binding in [
        ("Nagraj English", '<div class="description">also in hindi</div>', "Hindi", None), ("Nagraj Bangla HB", "", "Bengali", "Hardbound"),
        ("Nagraj", '<div class="description">bengali malayalam pb</div>', "Malayalam", "Paperback"),
        ("Nagraj hc", attrs(("Binding", "Paperback")), None, "Hardcover"), ("Nagraj", attrs(("Binding", "soft cover")), None, None),
        ("Nagraj", attrs(("binding", "Paper back")), None, "Paperback")]],
    # page counts
    *[(body(title, extra), URL, dict(pages=pages)) for title, extra, pages in [
        ("Nagraj", '<div class="description">Pages: 48</div>', 48), ("Nagraj", '<div class="description">48 pages</div>', 48),
        ("Nagraj 64 pages", "", 64), ("Nagraj", '<div class="description">page 20000, 32 pages</div>', 32),
        ("Nagraj 64 pages", '<div class="description">20000 pages</div>', None),
        ("Nagraj", attrs(("Page Count", "20001 p")), 20001),
        ("Nagraj", '<div class="description">20000 pages</div>' + attrs(("Pages", "7")), 7)]],
    (body(extra=attrs(("A", "1"), ("B ", " 2"), ("A", "3"))), URL, dict(additional_info={"A": "3", "B": "2"})),
    # dates
    *[(body(extra=f'<div class="description">out {text} soon</div>'), URL, dict(release_date=date)) for text, date in [
        ("on 2024-10-05 x", "24-10-05"), ("2024-1-5", "2024-01-05"), ("25/12/2024", "2024-12-25"), ("none", None)]],
    # images
    *[(body(extra=extra), URL, dict(cover_image_url=url)) for extra, url in [
        (f'<ul class="thumbnails"><li><a class="thumbnail" href="{IMG}-300x300.jpg"></a></ul>', f"{IMG}-300x300.jpg"),
        (f'<ul class="thumbnails"><li><a class="thumbnail" href="/placeholder.png"><img src="{IMG}-300x300.JPG"></a></ul>', f"{IMG}-700x700.JPG"),
        (f'<div class="product-info"><img src="{IMG}-700x700.png" data-src="/no-image.png"></div>', f"{IMG}-800x800.png"),
        ('<div class="product-info"><img src="placeholder.png" data-zoom-image="/z.png"></div>', "https://shop.example/z.png"),
        (f'<div class="image"><img src="{IMG}.webp"></div>', "https://shop.example/image/catalog/a.webp"),
        ('<div id="product"><img src="/default.png"><img src="/b-300x300.png"><img src="/c.png"></div>', "https://shop.example/c.png"),
        ('<div><p></p><b></b></div><div class="related-products"><img src="/image/r.png"></div><img src="/image/p1.png"><img src="/image/p2.png">'
         '<img src="/image/r.png"><img src="/other.png">', "https://shop.example/image/p2.png"),
        ('<img src="/image/placeholder.png"><img src="/image/default.png">', "https://shop.example/image/placeholder.png"),
        ("<p>none</p>", None)]],
    ("<p>no heading</p>", URL, dict(title=None, url=URL)),
    (body("T"), "https://shop.example/index.php?route=product/category", None),
]


@pytest.fixture(scope="module")
def records(make_pages):
    return extract_all(make_pages, RETAIL, CASES)


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(records, i):
    check(records, CASES, i)
