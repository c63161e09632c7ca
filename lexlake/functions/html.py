"""Markup as tokens and as visible text, in one pass over the string."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexlake.functions.text import by_distinct

# Elements that end a line, and ones whose content isn't text.
BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
SILENT = frozenset({"script", "style"})

_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_DECLARATION = re.compile(r"""\s*([-\w]+)\s*:\s*((?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[^;"'])*)""")


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, dict[str, str]]] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        self.quiet += tag in SILENT
        first: dict[str, str] = {}
        for k, v in attrs:
            first.setdefault(k, v or "")
        self.out.append(("open", tag, first))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.quiet = max(0, self.quiet - 1)
        self.out.append(("close", tag, {}))

    def handle_data(self, data):
        if not self.quiet:
            self.out.append(("text", data, {}))


def tokens(markup: str) -> list[tuple[str, str, dict[str, str]]]:
    """(kind, value, attributes): tags and text in order; scripts, styles and comments left out."""
    reader = _Reader()
    reader.feed(markup)
    reader.close()
    return reader.out


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag's inside, entities decoded, the first of a name kept."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


def declarations(style: str) -> dict[str, str]:
    """Declarations of a style attribute, the last of a name kept; comments dropped, strings whole."""
    return {k.lower(): v.strip() for k, v in _DECLARATION.findall(re.sub(r"/\*.*?\*/", " ", style, flags=re.S)) if v.strip()}


def lines(markup: str) -> str:
    """Visible text, a line for each block; markup that was escaped twice is read twice."""
    if "<" not in markup and "&lt;" in markup:
        markup = unescape(markup)
    parts = ["\n" if kind != "text" and value in BLOCKS else value if kind == "text" else "" for kind, value, _ in tokens(markup)]
    rows = (" ".join(r.split()) for r in "".join(parts).split("\n"))
    return "\n".join(r for r in rows if r)


def visible(markup: str) -> str:
    return lines(markup).replace("\n", " ")


def runs(text: str) -> Iterator[tuple[str, str]]:
    """Stretches of a text by script: ("zh", ...) with ideographs, ("en", ...) without."""
    for m in re.finditer(r"[^㐀-鿿\n]*[A-Za-z][^㐀-鿿\n]*|[㐀-鿿][^A-Za-z\n]*(?:[A-Za-z]{1,6}[^A-Za-z\n]*[㐀-鿿][^A-Za-z\n]*)*", text):
        if m[0].strip():
            yield ("zh" if re.search("[㐀-鿿]", m[0]) else "en"), m[0].strip()


def pairs(markup: str, order: str = "en-zh") -> list[tuple[str, str]]:
    """(English, Chinese) of neighbouring stretches in the given order: an example and its translation."""
    out = []
    for line in lines(markup).split("\n"):
        own = list(runs(line))
        for (a, x), (b, y) in zip(own, own[1:]):
            if f"{a}-{b}" == order:
                en, zh = (x, y) if a == "en" else (y, x)
                if len(re.findall(r"[A-Za-z']+", en)) >= 2 and len(re.findall("[㐀-鿿]", zh)) >= 2:
                    out.append((en, zh))
    return out


to_lines = by_distinct(lines, T.StringType())
visible_text = by_distinct(visible, T.StringType())
to_pairs = by_distinct(pairs, T.ArrayType(T.StructType([T.StructField("en", T.StringType()), T.StructField("zh", T.StringType())])))
TOKEN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]))


@F.pandas_udf(TOKEN)
def to_tokens(markup: pd.Series) -> pd.Series:
    return markup.map(lambda m: None if m is None else [{"kind": k, "value": v, "attributes": a} for k, v, a in tokens(m)])
