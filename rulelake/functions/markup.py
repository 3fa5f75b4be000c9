"""Canonical markup: the form of a page that the extraction functions read.

Saved pages come in many spellings: tag names in capitals, attributes in single
quotes or none, ``>`` inside a value, comments, scripts and any of the HTML 5
character references. In canonical markup tags and attribute names are in lower
case, values stand in double quotes, comments, scripts and styles are gone, and
text and values hold characters, but for ``& < > "`` as ``&amp; &lt; &gt;
&quot;``. So one pattern a tag is enough for every later function.

Machine-made pages nearly always are canonical but for a few frequent
references that :func:`rulelake.functions.html.decode_basic` knows. A native
test tells these; only the others go through the standard library's HTML
tokenizer, in Arrow batches.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tag in canonical spelling. The groups are possessive, which Java matches without recursion.
_TAG = (r"<(?:/[a-z][a-z0-9]*+\s*+|[a-z][a-z0-9]*+(?:\s++[a-z][a-z0-9_:.-]*+(?:=\"[^\"<>]*+\")?+)*+\s*+/?+"
        r"|!(?i:doctype)[^<>]*+)>")
#: What a canonical page holds no more once its tags are taken out, and elements whose text is no text.
_ODD = r"<|&(?!(?:amp|lt|gt|quot|apos|nbsp|middot|copy|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});)[A-Za-z#]"
_RAW = r"<(?:script|style)\b"


class _Canonical(HTMLParser):
    """Writes what the tokenizer reads in canonical spelling."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.raw = False

    def handle_decl(self, decl: str) -> None:
        self.out.append("<!doctype html>")

    def _open(self, tag: str, attrs, end: str) -> None:
        self.raw = tag in ("script", "style") and not end
        if tag not in ("script", "style"):
            values = "".join(f' {name}="{escape(value or "")}"' for name, value in attrs)
            self.out.append(f"<{tag}{values}{end}>")

    def handle_starttag(self, tag: str, attrs) -> None:
        self._open(tag, attrs, "")

    def handle_startendtag(self, tag: str, attrs) -> None:
        self._open(tag, attrs, "/")

    def handle_endtag(self, tag: str) -> None:
        self.raw = False
        if tag not in ("script", "style"):
            self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self.raw:
            self.out.append(escape(data, quote=False))


def rewritten(html: str) -> str:
    """A page in canonical markup."""
    reader = _Canonical()
    reader.feed(html)
    reader.close()
    return "".join(reader.out)


@F.pandas_udf(T.StringType())
def _rewritten(pages: pd.Series) -> pd.Series:
    return pages.map(rewritten, na_action="ignore")


def is_canonical(html: Column) -> Column:
    """Whether a page needs no rewriting."""
    raw = (html.contains("<script") | html.contains("<style")) & html.rlike(_RAW)
    return ~F.regexp_replace(html, _TAG, "").rlike(_ODD) & ~raw


def canonical(html: Column) -> Column:
    """The page in canonical markup. Canonical pages reach Python as nulls."""
    odd = F.when(~is_canonical(html), html)
    return F.coalesce(_rewritten(odd), html)
