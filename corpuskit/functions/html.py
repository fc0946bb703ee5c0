"""Page text, links and addresses. Parsing HTML to text takes Python; links and titles don't."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpuskit.functions.text import strip

#: Texts that are brought to compatibility forms at once.
NORMALISED = 256
HIDDEN = frozenset(("script", "style", "template"))


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN

    def handle_endtag(self, tag):
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


def visible_text(html: str | None) -> str:
    """Text outside scripts and styles, a line for each piece between tags, entities decoded."""
    parser = _Text()
    parser.feed(html or "")
    parser.close()
    return "\n".join(parser.parts)


@F.pandas_udf(StringType())
def page_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text)


@F.arrow_udf(StringType())
def nfkc(text: pa.Array) -> pa.Array:
    """A few rows at a time, and none but those that aren't plain ASCII, so that a batch of long texts is never held as Python strings."""

    def normal(t: pa.StringScalar) -> str | None:
        said = t.as_py()
        return said if said is None or said.isascii() else unicodedata.normalize("NFKC", said)

    parts = [pa.array([normal(t) for t in text.slice(at, NORMALISED)], pa.string()) for at in range(0, len(text), NORMALISED)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def normalise_block(text: Column) -> Column:
    """Compatibility forms, no soft hyphens, words joined over line ends, one line, single blanks."""
    t = F.replace(nfkc(text), F.lit("­"), F.lit(""))
    t = F.regexp_replace(t, r"([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])", "$1$2")
    return strip(F.regexp_replace(F.regexp_replace(t, r"\s*\n\s*", " "), r"[ \t]{2,}", " "))


#: Entities by name that titles and addresses hold (fixed values); others by name stay as they are.
ENTITIES = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("ndash", "–"), ("mdash", "—"), ("hellip", "…"), ("copy", "©"), ("reg", "®"))


def decode(c: Column) -> Column:
    """Character references, by number or by the common names, as characters."""
    for name, character in ENTITIES:
        c = F.replace(c, F.lit(f"&{name};"), F.lit(character))
    number = r"&#(\d{1,7}|[xX][0-9A-Fa-f]{1,6});"

    def character(ref: Column) -> Column:
        code = F.when(F.lower(F.substring(ref, 1, 1)) == "x", F.conv(F.substring(ref, 2, 9), 16, 10)).otherwise(ref).cast("bigint")
        # The code as UTF-16 without surrogates is what ``decode`` of four bytes gives.
        return F.when((code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    between = F.split(c, number)
    refs = F.transform(F.regexp_extract_all(c, F.lit(number), F.lit(1)), character)
    numbered = F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(refs, i), F.lit("")))), "")
    return F.replace(F.when(c.rlike(number), numbered).otherwise(c), F.lit("&amp;"), F.lit("&"))


def without_hidden(html: Column) -> Column:
    """Without comments, scripts, styles and templates, in which no tag counts."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), "(?s)<!--.*?(-->|$)", " ")
    return F.regexp_replace(shown, r"(?is)<(script|style|template)\b[^>]*>.*?(</\1\s*>|$)", " ")


def title(html: Column) -> Column:
    """The text of the title, entities decoded; a page without one, or with a blank one: ``(no title)``."""
    found = strip(decode(F.regexp_extract(without_hidden(html), r"(?is)<title[^>]*>(.*?)</title>", 1)))
    return F.when(found == "", "(no title)").otherwise(found)


def hrefs(html: Column) -> Column:
    """Targets of anchors, quoted or not, entities decoded, without fragment and query; empty ones dropped."""
    raw = F.regexp_extract_all(without_hidden(html), F.lit(r"""(?i)<a(?=\s)[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""), F.lit(1))
    plain = F.transform(raw, lambda h: decode(F.regexp_replace(h, r"(?s)^([\"'])(.*)\1$", "$2")))
    return F.filter(F.transform(plain, lambda h: F.regexp_replace(F.regexp_replace(h, "(?s)#.*$", ""), r"(?s)\?.*$", "")), lambda h: h != "")


def without_dots(path: Column) -> Column:
    """A path that begins with a slash with its segments ``.`` and ``..`` carried out; those above the root are dropped."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    joined = F.array_join(ends, "/")
    return F.when(~path.contains("/."), path).when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve(base: Column, href: Column) -> Column:
    """The absolute address of a link on a page, as in RFC 3986."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    # Segments without a name inside a joined path don't count.
    joined = F.regexp_replace(F.concat(folder, href), "/{2,}", "/")
    whole = href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    below = F.concat(site, without_dots(F.when(href.startswith("/"), href).otherwise(joined)))
    return F.when(whole, href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).otherwise(below)


def one_slash(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "/")


def allowed(host: Column, domains: tuple[str, ...]) -> Column:
    """The host is one of the domains or below it; a null host is not."""
    return F.coalesce(F.exists(F.array(*map(F.lit, domains)), lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d))), F.lit(False))
