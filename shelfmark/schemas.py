"""Column contracts: pages in, items and tables out."""

from __future__ import annotations

import re

PAGES = "source string, url string, status int, html string, run_id string, run_ts timestamp, seq bigint, fetched_at timestamp"

# Field lists of the record kinds, in their declared order.
PUBLISHER = "name string, website string, description string, founded string, headquarters string, url string, scraped_at string"
SERIES = ("title string, publisher string, description string, start_date string, end_date string, issue_count bigint, "
          "genre array<string>, url string, scraped_at string")
COMIC = ("title string, series string, issue bigint, publisher string, release_date string, cover_artist string, "
         "writers array<string>, artists array<string>, colorists array<string>, letterers array<string>, "
         "editors array<string>, characters array<string>, genre array<string>, language string, binding string, "
         "description string, pages bigint, price double, original_price double, isbn string, cover_image_url string, "
         "listing_date string, additional_info map<string,string>, url string, scraped_at string")
GENRE = "name string, description string, url string, scraped_at string"
CHARACTER = ("name string, publisher string, first_appearance string, first_appearance_date string, description string, "
             "aliases array<string>, powers array<string>, teams array<string>, image_url string, url string, scraped_at string")
ARTIST = ("name string, role string, bio string, birth_date string, nationality string, notable_works array<string>, "
          "image_url string, url string, scraped_at string")

ENTITIES = {"publisher": PUBLISHER, "series": SERIES, "comic": COMIC, "genre": GENRE, "character": CHARACTER, "artist": ARTIST}
REQUIRED = {"publisher": "name", "series": "title", "comic": "title", "genre": "name", "character": "name", "artist": "name"}

SOURCES = "id string, source string, description string, url string, created_at timestamp, updated_at timestamp"
CATALOG = ("id string, title string, series_name string, issue int, language string, binding string, "
           "original_price decimal(10,2), price decimal(10,2), description string, url string, cover_image_url string, "
           "source string, scraped_at timestamp, scraped_at_text string, uploaded_date date, publisher string, pages int, "
           "status string, failed_at timestamp, processed_at timestamp, failure_reason string, writers array<string>, "
           "artists array<string>, colorists array<string>, genre array<string>, additional_info map<string,string>, "
           "raw_json string, created_at timestamp, updated_at timestamp")


def fields(ddl: str) -> dict[str, str]:
    """Column name to type text, in order."""
    return dict(f.split(" ", 1) for f in re.split(r",\s+", ddl))
