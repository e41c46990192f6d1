"""Cover address of a web page: ``og:image`` first, else the ``coverImage`` picture.

Three forms:

* ``native`` stays in the JVM: a pattern walks the page, steps over comments, scripts, styles and
  other tags, and stops at the first tag that counts. Empty groups remember that a comment or a tag was seen to have no
  end, so that no later one is searched to the end of the page again. What follows a tag without an end counts for nothing.
* ``strict`` reads the page by a tokenizer in Python, unclosed markup included.
* ``auto`` is native for pages whose markup is plain up to the tag that counts, and strict for the others.

Each form takes time in proportion to the page, whatever it holds.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Quotes count only after '='; the possessive repeats keep the match linear and off the stack.
_QUOTED = r"""=\s*+(?:"[^"]*+"|'[^']*+')"""
_REST_OF_TAG = rf"(?:[^>=]++|{_QUOTED}|=)*+>"
_TO_NEXT = r"[^>]*+(?:>|\z)"
# What Python takes for white space beside the ASCII kinds.
_SPACES = r"[\s\x1c-\x1f\x85\xa0  -     　]*+"


def _raw_text(rest: str) -> str:
    """Pattern of a script or style from its name on; one without an end reaches to the end of the page."""
    return "|".join(
        rf"(?i:{name})(?=[\s/>]){rest}.*?(?:</{_SPACES}(?i:{name}){_SPACES}>|\z)" for name in ("script", "style")
    )


def _tag_with(tag: str, name: str, value: str) -> str:
    """Pattern of a whole tag in which the attribute has exactly this value."""
    wanted = rf"""(?<=[\s"'/])(?i:{name})\s*+=\s*+(?:"{value}"|'{value}'|{value}(?=[\s/>]))"""
    return rf"<(?i:{tag})(?=[\s/])(?:(?!{wanted})(?:[^>=]|{_QUOTED}|=))*+{wanted}{_REST_OF_TAG}"


def _first(tag: str) -> str:
    """Pattern that steps over text, comments, scripts, styles and other tags up to the first such tag, its group 4.

    Groups 1 to 3 are set when a tag, a comment or a marked section has been found to have no end.
    """
    return (
        rf"(?s)\A(?:[^<]++|(?!(?!\1){tag})<(?:"
        rf"{_raw_text(_REST_OF_TAG)}"
        rf"|[a-zA-Z](?:\1{_TO_NEXT}|[^\s/>]*+{_REST_OF_TAG}|(){_TO_NEXT})"
        rf"|!--(?:\2{_TO_NEXT}|.*?--{_SPACES}>|(){_TO_NEXT})"
        rf"|!\[(?i:CDATA)\[(?:\3{_TO_NEXT}|.*?\]{_SPACES}\]{_SPACES}>|(){_TO_NEXT})"
        rf"|[/!?]{_TO_NEXT}"
        rf")?+)*+({tag})"
    )


_OG_IMAGE = _first(_tag_with("meta", "property", "og:image"))
_COVER_IMAGE = _first(_tag_with("img", "id", "coverImage"))

# Plain markup, which any reading takes the same way: attributes of the form name, name=value, name="value" or
# name='value' with blanks between them, and everything closed.
_BARE = r"[A-Za-z0-9!#$%()*+,./:;?@\[\]^_{|}~-]++"
_ATTRIBUTE = rf"""[A-Za-z0-9_:.@-]++(?:[ \t\r\n]*+=[ \t\r\n]*+(?:"[^"]*+"|'[^']*+'|{_BARE}))?+(?=[ \t\r\n/>])"""
_PLAIN_REST = rf"(?=[ \t\r\n/>])(?:[ \t\r\n]++|/(?!>)|{_ATTRIBUTE})*+"
_TIDY_TAG = rf"^<[a-zA-Z][a-zA-Z0-9]*+{_PLAIN_REST}/?>$"


def _plain_up_to(end: str) -> str:
    """Pattern of plain markup from the start of the page up to ``end``."""
    return (
        rf"(?s)\A(?:[^<]++|(?!{end})<(?:"
        rf"{_raw_text(_PLAIN_REST + '>')}"
        rf"|[a-zA-Z][a-zA-Z0-9:-]*+{_PLAIN_REST}/?>"
        rf"|/[^>]*+>"
        rf"|!--.*?--{_SPACES}>"
        rf"|!(?!--|\[)[^>]*+>"
        rf"|\?[^>]*+>"
        rf"|(?![a-zA-Z/!?])"
        rf"))*+"
    )


def _plain_first(tag: str) -> str:
    return f"{_plain_up_to(tag)}({tag})"


_PLAIN_OG_IMAGE = _plain_first(_tag_with("meta", "property", "og:image"))
_PLAIN_COVER_IMAGE = _plain_first(_tag_with("img", "id", "coverImage"))
_PLAIN_PAGE = _plain_up_to("(?!)") + r"\z"
# An entity in an attribute that is compared: its value is not what stands there.
_ENCODED = r"""(?i)[\s"'/](?:property|id)\s*+=+\s*+(?:"[^"&]*+&|'[^'&]*+&|[^\s"'>&]*+&)"""
_TWICE = r"""(?is)[\s/"'](content|property|src|id)(?=[\s=/>]).*[\s/"']\1(?=[\s=/>])"""


def _attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute, '' when absent or empty; null for a null tag."""
    named = rf"""(?<=[\s"'/])(?i:{name})\s*+=\s*+"""
    before = rf"^<(?:(?!{named})(?:[^>=]|{_QUOTED}|=))*+{named}"
    values = [
        F.nullif(F.regexp_extract(tag, before + value, 1), F.lit(""))
        for value in (r'"([^"]*)"', r"'([^']*)'", r"""([^\s"'>]+)""")
    ]
    return F.when(tag.isNotNull(), F.coalesce(*values, F.lit("")))


def _unescape(value: Column) -> Column:
    """The five predefined entities; '&amp;' last so that its output is not read again."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def _tag(html: Column, text: str, pattern: str, group: int) -> Column:
    """The first tag by the pattern, or null; pages without the text are not walked."""
    return F.when(F.contains(html, F.lit(text)), F.nullif(F.regexp_extract(html, pattern, group), F.lit("")))


# How a tag is read: its name, what stands between attributes, and an attribute with its value.
_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />\x00]*")
_BETWEEN = re.compile(r"(?:\s|/(?!>))*")
_PAIR = re.compile(
    r"""(?<=[\s/"'])([^\s/>][^\s/=>]*)(?:\s*=+\s*("[^"]*"|'[^']*'|(?!["'])[^\s>]*))?(?:\s|/(?!>))*"""
)
_UNQUOTED_TAG = re.compile(r"""<([a-zA-Z][^\t\n\r\f />\x00"'<]*)(?=[\s/>])[^<>"'\x00]*>""")
_RAW_END = {name: re.compile(rf"</\s*{name}\s*>", re.I) for name in ("script", "style")}
_READ = {"meta", "img", "script", "style"}
_SECTION = re.compile(r"[a-zA-Z][-_.a-zA-Z0-9]*\s*")
# What ends a comment and the two kinds of marked sections.
_ENDS = {
    "comment": re.compile(r"--\s*>"),
    "data": re.compile(r"\]\s*\]\s*>"),
    "condition": re.compile(r"\]\s*>"),
}
_SECTIONS = dict.fromkeys(("temp", "cdata", "ignore", "include", "rcdata"), "data")
_SECTIONS |= dict.fromkeys(("if", "else", "endif"), "condition")


class BadMarkup(ValueError):
    """A marked section of no known kind, for which the whole page is given up."""


class PageTags:
    """The ``meta`` and ``img`` tags of a page, with the attributes of each.

    Markup without an end counts as text up to the next ``>``, and reading goes on behind it. That an end is missing is
    noted where it is found out, by kind for comments and sections and by place for attributes, so nothing is searched
    to the end of the page a second time.
    """

    def __init__(self, page: str):
        self.page = page
        self.last_close = page.rfind(">")
        self.endless: set[str] = set()
        self.dead: set[int] = set()

    def __iter__(self):
        page, at, size = self.page, 0, len(self.page)
        while (at := page.find("<", at)) >= 0:
            lead = page[at + 1 : at + 2]
            if lead.isascii() and lead.isalpha():
                plain = _UNQUOTED_TAG.match(page, at)
                if plain and plain[1].lower() not in _READ:
                    at = plain.end()
                    continue
                end, name, pairs, empty = self._tag(at)
                if name in ("meta", "img"):
                    yield name, self._values(pairs)
                elif name in _RAW_END and not empty:
                    found = _RAW_END[name].search(page, end)
                    if not found:
                        return
                    end = found.end()
            elif page.startswith("<!--", at):
                end = self._end("comment", at + 4)
            elif page.startswith("<![", at):
                end = self._section(at)
            elif lead and lead in "/!?":
                end = self._next_close(at)
            else:
                end = at + 1
            if end is None:  # no end: text up to the next '>', or only the '<'
                end = self._next_close(at) or at + 1
            at = end
            if at >= size:
                return

    def _next_close(self, at: int) -> int | None:
        return None if at > self.last_close else self.page.find(">", at + 1) + 1

    def _end(self, kind: str, at: int) -> int | None:
        if kind in self.endless:
            return None
        found = _ENDS[kind].search(self.page, at)
        if not found:
            self.endless.add(kind)
            return None
        return found.end()

    def _section(self, at: int) -> int | None:
        if at + 3 == len(self.page):
            return None
        named = _SECTION.match(self.page, at + 3)
        if named and named.end() == len(self.page):
            return None
        kind = _SECTIONS.get(named[0].strip().lower()) if named else None
        if kind is None:
            raise BadMarkup(self.page[at : at + 20])
        return self._end(kind, at + 3)

    def _tag(self, at: int) -> tuple[int | None, str | None, list[re.Match], bool]:
        """Where the start tag ends, its name and attributes, and whether it is closed in itself.

        No end when it has none, no name when it turns out to be text.
        """
        if at > self.last_close:
            return None, None, [], False
        page = self.page
        name = _NAME.match(page, at + 1)
        place, pairs = _BETWEEN.match(page, name.end()).end(), []
        while place not in self.dead and (pair := _PAIR.match(page, place)):
            pairs.append(pair)
            place = pair.end()
        if place not in self.dead:
            if page.startswith(">", place):
                return place + 1, name[0].lower(), pairs, False
            if page.startswith("/>", place):
                return place + 2, name[0].lower(), pairs, True
            if place < len(page) and page[place] != "=":
                return place, None, pairs, False
        self.dead.update(pair.start() for pair in pairs)
        self.dead.add(place)
        return None, None, pairs, False

    @staticmethod
    def _values(pairs: list[re.Match]) -> dict[str, str]:
        """Attributes by name; the last of a name counts."""
        values = {}
        for pair in pairs:
            value = pair[2] or ""
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            values[pair[1].lower()] = unescape(value)
        return values


def find_cover_url(page: str) -> str | None:
    """Cover address of one page by its tags; none when the page has markup that is given up."""
    cover, picture = None, None
    final = "<![" not in page  # nothing further on can spoil what is found
    try:
        for name, values in PageTags(page):
            if name == "meta" and cover is None and values.get("property") == "og:image":
                cover = values
                if final:
                    break
            elif name == "img" and picture is None and values.get("id") == "coverImage":
                picture = values
    except BadMarkup:
        return None
    if cover is not None:
        return cover.get("content") or None
    return picture.get("src") or None if picture is not None else None


@pandas_udf(T.StringType())
def cover_url_strict(html: pd.Series) -> pd.Series:
    return html.map(lambda page: None if page is None else find_cover_url(page))


def _odd(tag: Column) -> Column:
    """Whether a tag found by pattern may read differently by its tokens."""
    odd = ~tag.rlike(_TIDY_TAG) | tag.rlike(r"&(?!amp;|lt;|gt;|quot;|#39;)") | tag.rlike(_TWICE)
    return tag.isNotNull() & F.coalesce(odd, F.lit(False))


def _address(meta: Column, img: Column) -> Column:
    return _unescape(F.nullif(F.coalesce(_attribute(meta, "content"), _attribute(img, "src")), F.lit("")))


def with_cover_url(pages: DataFrame, html: str = "html", out: str = "img_url", mode: str = "native") -> DataFrame:
    """Replace the ``html`` column by the cover address, null when the page names none.

    An og:image tag without a usable ``content`` ends the search: there is no fallback.
    """
    kept = [name for name in pages.columns if name != html]
    page = F.col(html)
    if mode == "strict":
        return pages.select(*kept, cover_url_strict(page).alias(out))
    if mode not in ("native", "auto"):
        raise ValueError(f"unknown mode {mode!r}")
    forms = {"native": (_OG_IMAGE, _COVER_IMAGE, 4), "auto": (_PLAIN_OG_IMAGE, _PLAIN_COVER_IMAGE, 1)}
    og_image, cover_image, group = forms[mode]
    found = pages.select(*kept, html, _tag(page, "og:image", og_image, group).alias("_meta"))
    meta, img = F.col("_meta"), F.col("_img")
    found = found.select(
        *kept, html, "_meta", F.when(meta.isNull(), _tag(page, "coverImage", cover_image, group)).alias("_img")
    )
    if mode == "native":
        # One row from one item: a filter on the address then stays above the search. Pushed below, it
        # would repeat the search for every mention of the address.
        return found.select(*kept, F.explode(F.array(_address(meta, img))).alias(out))
    encoded = F.contains(page, F.lit("&")) & page.rlike(_ENCODED)
    has_meta, has_img = F.contains(page, F.lit("og:image")), F.contains(page, F.lit("coverImage"))
    # A picture counts once no og:image can follow, nothing found counts once all has been read as plain markup.
    open_end = F.when(has_meta & meta.isNull() | has_img & ~has_meta & img.isNull(), ~page.rlike(_PLAIN_PAGE))
    given_up = F.contains(page, F.lit("<![")) & (has_meta | has_img)
    unsettled = encoded | given_up | _odd(F.coalesce(meta, img)) | F.coalesce(open_end, F.lit(False))
    return found.select(
        *kept, _address(meta, img).alias("_native"), F.when(unsettled, page).alias("_page")
    ).select(
        *kept,
        F.when(F.col("_page").isNull(), F.col("_native")).otherwise(cover_url_strict(F.col("_page"))).alias(out),
    )
