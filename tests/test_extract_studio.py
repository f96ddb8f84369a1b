"""Golden product pages of the second WooCommerce profile."""

import pytest

from golden import check, extract_all
from shelfmark.profiles import STUDIO

URL = "https://shop.example/product/x/"


def body(title="Aghori", extra=""):
    return f"<h1 class='entry-title'>{title}</h1>{extra}"


def tab(html):
    return f'<div class="x woocommerce-Tabs-panel--description y">{html}</div>'


def info(*rows):
    return '<div class="product_meta"><table>' + "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in rows) + "</table></div>"


CASES = [
    *[(body(title), URL, dict(series=series, issue=issue)) for title, series, issue in [
        ("That Man Solomon: Born Again #4", "That Man Solomon", 4),
        ("The Last Asuran Vol. 3: W.O.M.E. Stage 1", "The Last Asuran", 3),
        ("Ravanayan Box Set", "Ravanayan", None), ("Aghori Deluxe Edition 2016", "Aghori Deluxe Edition 2016", 2016),
        ("Aghori Issue 7 Hindi", "Aghori", 7), ("Skull Rosary English Hardcover", "Skull Rosary", None),
        ("#9", None, None), ("Volume", None, None)]],
    (body(extra='<p class="price"><del><bdi>599</bdi></del><ins><bdi>539</bdi></ins></p>'), URL, dict(original_price=599.0, price=539.0)),
    # descriptions: paragraphs first (each text chunk is judged alone, tables do not count), then any text, then the short description
    (body(extra=tab("<h2>Description</h2><p>One <b>two</b> threes.</p><table><tr><td><p>cell text</p></td></tr></table>")), URL,
     dict(description="threes.")),
    (body(extra=tab("<h2>Description</h2>Plain text of it <i>all here</i><table><tr><td>cell text</td></tr></table>")), URL,
     dict(description="Plain text of it all here")),
    (body(extra='<section class="woocommerce-Tabs-panel--description"><p>Not a div here.</p></section>'), URL, dict(description="Not a div here.")),
    (body(extra='<div class="product-short-description"><p>In short, a tale.</p></div>'), URL, dict(description="In short, a tale.")),
    (body(extra='<div class="product-short-description">Own text only</div>'), URL, dict(description="Own text only")),
    (body(extra=tab("<p>Wishlist now</p><p>Genre: one</p><p>...!?</p><p>Abc</p><p>Readers love this long tale of old.</p>")), URL,
     dict(description="Readers love this long tale of old.")),
    # the tail strip has no word boundary
    (body(extra=tab("<p>The party starts at dawn</p>")), URL, dict(description="The p")),
    (body(extra=tab("<p>description</p><p>Abc</p>")), URL, dict(description="Abc")),
    (body(extra=tab("<p>Art of war and of peace as told</p>") + '<span class="sku">S</span>'), URL,
     dict(parse_issue="null_description", url=None, isbn=None, series="Aghori")),
    # bindings: the named row first, verbatim when unknown
    *[(body(title, extra), URL, dict(binding=binding)) for title, extra, binding in [
        ("A HC edition", "", "Hardcover"), ("Aghori", info(("Binding", "Saddle stitched")), "Saddle stitched"),
        ("Aghori", info(("Binding", "HC")), "Hardcover"), ("Aghori", info(("binding", "Deluxe")), "Deluxe Edition"),
        ("Aghori Paperback", info(("Kind", "A deluxe thing")), "Deluxe Edition"),
        ("Aghori Paper Back", info(("Kind", "none")), "Paperback"),
        ("Aghori", tab("<p>A deluxe  edition of the saga for you.</p>"), "Deluxe Edition")]],
    # page counts: no range test, only above zero
    *[(body(extra=extra), URL, dict(pages=pages)) for extra, pages in [
        (tab("<p>It has 20000 pgs of story in it.</p>"), 20000), (info(("Pages", "48")), 48),
        (info(("Pages", "48"), ("Size", "64 pages")), 64), ('<i class="pages">-5</i>' + info(("Pages", "48")), 48),
        (tab("<p>A tale of 7 men, told well.</p>"), None)]],
    *[(body(title, extra), url, dict(artists=artists, cover_artist=None, genre=[])) for title, extra, url, artists in [
        ("Aghori by Vivek Goel", "", URL, ["Vivek Goel"]), ("Aghori by Boxer Man", "", URL, None),
        ("Aghori", "", "https://s.example/product/aghori-by-vivek-goel/", ["Vivek Goel"]),
        ("Aghori", info(("Artwork", "Vivek Goel")), URL, ["Vivek Goel"])]],
    (body(extra='<div class="product-categories"><a>Horror</a><a> </a></div>'), URL, dict(genre=[], parse_issue=None, url=URL)),
]


@pytest.fixture(scope="module")
def records(make_pages):
    return extract_all(make_pages, STUDIO, CASES)


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(records, i):
    check(records, CASES, i)
