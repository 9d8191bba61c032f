"""Schemas of the corpus."""

from __future__ import annotations

SPEECH = "struct<`order`:int,speaker:string,role:string,text:string,kind:string>"
#: A meeting with its speeches nested; `kind` is not stored but derived.
MEETINGS = f"prefecture string, url string, source_file string, date date, session string, committee string, title string, speeches array<{SPEECH}>, retrieved_at timestamp, source_html_sha256 string"
#: The flat view: one row per speech, one with empty speech columns for a meeting without any.
FLAT = ("prefecture", "date", "session", "committee", "title", "url", "source_file", "speech_order", "speaker", "role", "kind", "text", "retrieved_at", "source_html_sha256")
LISTING = "site string, prefecture string, url string, date date, title string"
PAGES = "key string, url string, status int, body binary, header_charset string, fetched_at timestamp, request string"
