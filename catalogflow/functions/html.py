"""Text nodes of an HTML fragment, for the descriptions that really carry markup."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HIDDEN = {"script", "style", "template"}


class _TextNodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[str] = []
        self._run: list[str] = []
        self._hidden = 0

    def _flush(self) -> None:
        text = "".join(self._run).strip()
        self._run.clear()
        if text and not self._hidden:
            self.nodes.append(text)

    def handle_starttag(self, tag, attrs):
        self._flush()
        self._hidden += tag in _HIDDEN

    def handle_startendtag(self, tag, attrs):
        self._flush()

    def handle_endtag(self, tag):
        self._flush()
        if tag in _HIDDEN and self._hidden:
            self._hidden -= 1

    def handle_data(self, data):
        self._run.append(data)

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        # A CDATA section is a text node of its own.
        self._flush()
        if data.startswith("CDATA["):
            self._run.append(data[len("CDATA["):])
            self._flush()


def text_nodes(markup: str | None) -> str | None:
    if markup is None:
        return None
    parser = _TextNodes()
    parser.feed(markup)
    parser.close()
    parser._flush()
    return "\n".join(parser.nodes)


@F.pandas_udf(T.StringType())
def _text_nodes_udf(markup: pd.Series) -> pd.Series:
    return markup.map(text_nodes, na_action="ignore")


def parsed_text(markup: Column) -> Column:
    """Stripped text nodes joined by newlines.

    Text without ``<`` or ``&`` has one node, itself; only the rest crosses into Python.
    """
    needs_parser = markup.rlike("[<&]")
    plain = F.regexp_replace(markup, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.coalesce(_text_nodes_udf(F.when(needs_parser, markup)), plain)
