"""Strings, HTML, URLs and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at either end (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty (FIL-20)."""
    return F.coalesce(*(blank_to_null(strip(c.cast("string"))) for c in columns))


def strip_html(html: Column, collapse: bool = True) -> Column:
    """Text without tags; white space collapsed or left as it is (FUN-01)."""
    text = F.regexp_replace(html, "<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " ")) if collapse else F.trim(text)


def article_body(html: Column, least: int = 400, most: int = 6000) -> Column:
    """Paragraph text of the first article, else of the page; null under ``least`` characters (FUN-02)."""
    clean = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", "")
    article = F.regexp_extract(clean, r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    scope = F.when(article != "", article).otherwise(clean)
    paragraphs = F.regexp_extract_all(scope, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</p>|<p\b|$)"), F.lit(1))
    text = F.array_join(F.filter(F.transform(paragraphs, lambda p: strip_html(p)), lambda x: x != ""), " ")
    return F.when(F.length(text) >= least, F.substring(text, 1, most))


def page_text(html: Column) -> Column:
    """Visible text without scripts, navigation, headers, footers and forms (FUN-03)."""
    return strip_html(F.regexp_replace(html, r"(?is)<(script|style|nav|header|footer|form)\b.*?</\1>", " "))


def links(html: Column) -> Column:
    """All link targets of a page (FUN-04)."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\b[^>]*href="([^"]*)"'), F.lit(1))


def resolved(href: Column, base: Column) -> Column:
    """A link target as an absolute URL without its fragment, against the page's URL."""
    bare = F.regexp_replace(href, "#.*$", "")
    root = F.regexp_extract(base, "^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([a-z][a-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(bare.rlike("(?i)^[a-z][a-z0-9+.-]*:"), bare).when(bare.startswith("//"), F.concat(F.regexp_extract(base, "^([^/]*)//", 1), bare))
        .when(bare.startswith("/"), F.concat(root, bare)).when(bare == "", base)
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), bare))
    )


def issue_links(html: Column, base: Column, pattern: str, cap: int = 5) -> Column:
    """Links to the page's own host whose label or path fits the pattern, each once, at most ``cap`` (FUN-04)."""
    anchors = F.regexp_extract_all(html, F.lit(r'(?is)<a\b[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    entries = F.transform(anchors, lambda a: F.struct(
        resolved(F.regexp_extract(a, r'(?is)href="([^"]*)"', 1), base).alias("url"), strip_html(F.regexp_extract(a, r"(?is)^<a\b[^>]*>(.*)</a>$", 1)).alias("label")))
    authority = lambda u: F.regexp_extract(u, "^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    path = lambda u: F.regexp_extract(u, "^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    good = F.filter(entries, lambda e: (authority(e["url"]) == authority(base)) & (authority(base) != "") & (e["label"].rlike(pattern) | path(e["url"]).rlike(pattern)))
    return F.slice(F.array_distinct(F.transform(good, lambda e: e["url"])), 1, cap)


def advertised_feeds(html: Column, base: Column) -> Column:
    """Targets of the page's alternate links of an RSS or Atom type (FUN-05)."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    value = lambda tag, name: F.regexp_extract(tag, rf'(?is)\b{name}\s*=\s*"([^"]*)"', 1)
    feeds = F.filter(tags, lambda t: F.lower(value(t, "rel")).contains("alternate") & F.lower(value(t, "type")).rlike("rss|atom") & (value(t, "href") != ""))
    return F.transform(feeds, lambda t: resolved(value(t, "href"), base))


def looks_like_listing(html: Column, least: int = 15) -> Column:
    """Many links and a date element (FUN-05)."""
    return (F.size(links(html)) >= least) & html.rlike("(?i)<time\\b|class=\"[^\"]*date")


def host(url: Column) -> Column:
    """Host without ``www.``; ``link`` where there is none (FUN-17)."""
    found = F.regexp_extract(url, r"https?://(?:www\.)?([^/]+)", 1)
    return F.coalesce(blank_to_null(found), F.lit("link"))


def source_kind(url: Column, strict: bool = True) -> Column:
    """``primary`` for a .gov host, else ``press``; not strict: .gov anywhere in the host (FUN-18)."""
    h = host(url)
    return F.when(h.endswith(".gov") if strict else h.contains(".gov"), "primary").otherwise("press")


def split_list(text: Column, separator: str = "\n") -> Column:
    """Packed list to array: trimmed, without empty entries (FUN-13)."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), separator), lambda x: strip(x)), lambda x: x != "")


def first_sentences(text: Column, n: int = 2) -> Column:
    """The first ``n`` sentences (FUN-14)."""
    parts = F.split(strip(F.coalesce(text, F.lit(""))), r"(?<=[.!?])\s+")
    return strip(F.array_join(F.slice(parts, 1, n), " "))


def word_count(text: Column) -> Column:
    t = strip(F.coalesce(text, F.lit("")))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))


def over_word_cap(text: Column, cap: int = 30) -> Column:
    """More than ``cap`` words (FUN-16)."""
    return word_count(text) > cap


#: Endings that do not end a sentence.
ABBREVIATIONS = ["Sen", "Rep", "Gov", "Dept", "St", "No", "Inc", "vs"]


def sentences(text: Column) -> Column:
    """Sentences; initials (one or more capital letters with a point each) and some abbreviations do not end one."""
    # The space after them is kept from the cut by a stand-in.
    held = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), rf"\b((?:[A-Z]\.)+|(?:{'|'.join(ABBREVIATIONS)})\.)\s+", "$1\u0001")
    parts = F.split(held, r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: F.translate(s, "\u0001", " ")), lambda s: s != "")


def blurb_problem(text: Column, state: Column, words: int = 30) -> Column:
    """What is wrong with a two-sentence blurb, or null (FUN-15)."""
    parts = sentences(text)
    longest = F.aggregate(parts, F.lit(0), lambda a, s: F.greatest(a, F.size(F.split(s, r"\s+"))))
    return (
        F.when(F.size(parts) != 2, "sentences").when(longest > words, "long").when(text.contains("—") | text.contains(";"), "punctuation")
        .when(state.isNotNull() & ~text.contains(state), "state")
    )


def outlet_summary(outlets: Column, cap: int = 4) -> Column:
    """``a, b, c, d +n more`` (FUN-21)."""
    more = F.size(outlets) - cap
    return F.concat(F.array_join(F.slice(outlets, 1, cap), ", "), F.when(more > 0, F.concat(F.lit(" +"), more.cast("string"), F.lit(" more"))).otherwise(""))


def paired_links(urls: Column, outlets: Column, cap: int = 3) -> Column:
    """array<struct<label, url>>: outlet by position, else the host (FUN-19)."""
    return F.transform(F.slice(urls, 1, cap), lambda u, i: F.struct(F.coalesce(blank_to_null(F.get(outlets, i)), host(u)).alias("label"), u.alias("url")))


def digest_item(*, title: Column, why: Column, notes: Column, meta: list[Column], relevance: Column, urls: Column, outlets: Column, date: Column, sort_key: Column) -> Column:
    """The shape of every digest item (REP-02): struct<title, summary, meta, relevance, links, date, sort_key>.

    The summary is why it matters, else the first two sentences of the notes; links are paired with outlets.
    """
    return F.struct(
        strip(title).alias("title"), F.coalesce(blank_to_null(strip(why)), first_sentences(notes, 2)).alias("summary"),
        F.concat_ws(" · ", *(blank_to_null(strip(m)) for m in meta)).alias("meta"), relevance.alias("relevance"),
        paired_links(urls, outlets).alias("links"), F.coalesce(date.cast("string"), F.lit("")).alias("date"), sort_key.alias("sort_key"),
    )


def title_state(title: Column) -> Column:
    """The state that a title begins with (``MD: ...``), else null."""
    return F.nullif(F.regexp_extract(title, "^([A-Z]{2}):", 1), F.lit(""))


def brief_line(item: Column, side: Column, must: Column) -> Column:
    """A line of the brief's input (REP-03): must-cover flag, side with its state, title, summary and who."""
    state = title_state(item["title"])
    tag = F.when(side == "state", F.concat(F.lit("state"), F.coalesce(F.concat(F.lit(": "), state), F.lit("")))).otherwise("federal")
    return F.concat(F.lit("- "), F.when(must, "MUST COVER ").otherwise(""), F.lit("["), tag, F.lit("] "), item["title"], F.lit(" :: "), F.coalesce(item["summary"], F.lit("")), F.lit(" :: who: "), item["meta"])


def publisher_links(urls: Column, outlets: Column, aggregator: str = "news.google.", label: str = "Google News", cap: int = 3) -> Column:
    """Publisher links where there are any, else one aggregator link (FUN-20)."""
    pairs = F.transform(urls, lambda u, i: F.struct(F.coalesce(blank_to_null(F.get(outlets, i)), host(u)).alias("label"), u.alias("url")))
    own = F.filter(pairs, lambda p: ~p["url"].contains(aggregator))
    single = F.transform(F.slice(urls, 1, 1), lambda u: F.struct(F.lit(label).alias("label"), u.alias("url")))
    return F.when(F.size(own) > 0, F.slice(own, 1, cap)).otherwise(single)


def primary_and_press(urls: Column) -> Column:
    """The first .gov and the first other link; where all are of one kind, the first two (WIN-20)."""
    primary = F.filter(urls, lambda u: source_kind(u, strict=False) == "primary")
    press = F.filter(urls, lambda u: source_kind(u, strict=False) == "press")
    one = F.concat(F.slice(primary, 1, 1), F.slice(press, 1, 1))
    return F.when(F.size(one) >= 2, one).when(F.size(primary) > 0, F.slice(primary, 1, 2)).otherwise(F.slice(press, 1, 2))


def name_variants(name: Column) -> Column:
    """The name, without initials (single letters of either case, anywhere), and first with last of three words or more (FUN-22)."""
    plain = F.trim(F.regexp_replace(name, r"\s+", " "))
    parts = F.filter(F.split(plain, " "), lambda w: ~w.rlike(r"^[A-Za-z]\.?$"))
    short = F.array_join(parts, " ")
    ends = F.when(F.size(parts) >= 3, F.concat_ws(" ", F.element_at(parts, 1), F.element_at(parts, -1)))
    return F.array_distinct(F.filter(F.array(plain, short, ends), lambda x: x.isNotNull() & (x != "")))


def plain_words(text: Column) -> Column:
    """Words in lower case, without punctuation."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}']+", " "), " "), lambda w: w != "")


def slug_title(title: Column, url: Column) -> Column:
    """A title from the URL's slug where the title was cut with ``...`` (FUN-09)."""
    slug = F.regexp_extract(F.regexp_replace(url, r"[/?#]+$", ""), r"([^/?#]+)$", 1)
    words = F.lower(F.trim(F.regexp_replace(F.try_url_decode(slug), r"[-_]+", " ")))
    built = F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 500))
    cut = title.endswith("...") | title.endswith("…")
    return F.when(cut & (words != ""), built).otherwise(title)


def instrument_id(text: Column, url: Column) -> Column:
    """A memorandum number ``M-yy-nn`` from the text, else from the URL, in upper case (FUN-08)."""
    pattern = r"(?i)\b(M-\d{2}-\d{2})\b"
    return F.upper(F.coalesce(blank_to_null(F.regexp_extract(text, pattern, 1)), blank_to_null(F.regexp_extract(url, pattern, 1))))


def event_id(urls: Column) -> Column:
    """The first 16 hex digits of SHA-1 over sorted, newline-joined URLs (FUN-25)."""
    return F.substring(F.sha1(F.array_join(F.array_sort(F.filter(urls, lambda u: u != "")), "\n")), 1, 16)


def split_title_outlet(title: Column, fallback: Column) -> Column:
    """struct<title, outlet>: split at the last " - "; else the fallback outlet (SRC-04)."""
    found = F.regexp_extract(title, r"^(.*) - (.*)$", 2)
    hit = title.rlike(r"^.* - .*$")
    return F.struct(F.trim(F.when(hit, F.regexp_extract(title, r"^(.*) - (.*)$", 1)).otherwise(title)).alias("title"), F.when(hit & (F.trim(found) != ""), F.trim(found)).otherwise(fallback).alias("outlet"))


def state_title(name: Column, state: Column) -> Column:
    """``ST: title`` with the state taken from the row or from a leading ``ST — `` (FUN-26)."""
    lead = F.regexp_extract(name, "^([A-Z]{2}) — ", 1)
    bare = F.regexp_replace(name, "^[A-Z]{2} — ", "")
    st = F.coalesce(blank_to_null(F.upper(F.trim(state))), blank_to_null(lead))
    return F.when(st.isNotNull(), F.concat(st, F.lit(": "), bare)).otherwise(bare)


def strip_leaked_term(title: Column, provenance: Column) -> Column:
    """Drop a leading ``term — `` only where the provenance names the same term (FUN-29)."""
    term = F.regexp_extract(title, "^(.+?) — ", 1)
    leaked = (term != "") & F.exists(provenance, lambda p: p == F.concat(F.lit("FR term — "), term))
    return F.when(leaked, F.regexp_replace(title, "^.+? — ", "")).otherwise(title)


def valid_email(c: Column) -> Column:
    """(FUN-30)"""
    return c.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")


def verdict_json(text: Column, schema: str) -> Column:
    """The first complete JSON object of a model's answer, code fences dropped (FUN-24)."""
    bare = F.regexp_replace(F.trim(text), r"(?s)^```[a-zA-Z]*\s*|\s*```$", "")
    start = F.instr(bare, "{")
    return F.when(start > 0, F.from_json(F.substring(bare, start, F.length(bare)), schema))
