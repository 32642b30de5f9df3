"""HTML to Markdown with # headings, on the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import modest

BLOCKS = {"p", "div", "section", "article", "header", "footer", "main", "aside", "nav", "table", "thead", "tbody", "tr", "ul", "ol", "dl", "dt", "dd", "figure", "figcaption", "form", "body", "html"}
SILENT = {"script", "style", "head", "template", "noscript"}
MARKS = {"strong": "**", "b": "**", "em": "_", "i": "_", "code": "`"}


class Writer(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.silent = self.pre = 0
        self.lists: list[list] = []
        self.links: list[str | None] = []

    def block(self, lines: int = 2) -> None:
        text = "".join(self.out[-3:])
        if self.out and not text.endswith("\n" * lines):
            self.out.append("\n" * (lines - (len(text) - len(text.rstrip("\n")))))

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif self.silent:
            return
        elif re.fullmatch("h[1-6]", tag):
            self.block()
            self.out.append("#" * int(tag[1]) + " ")
        elif tag == "pre":
            self.block()
            self.out.append("```\n")
            self.pre += 1
        elif tag == "br":
            self.out.append("  \n")
        elif tag == "hr":
            self.block()
            self.out.append("* * *")
            self.block()
        elif tag in ("ul", "ol"):
            self.block(1 if self.lists else 2)
            self.lists.append([tag, 0])
        elif tag == "li":
            self.block(1)
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("    " * (len(self.lists) - 1) + ("*   " if kind[0] == "ul" else f"{kind[1]}.  "))
        elif tag == "blockquote":
            self.block()
            self.out.append("> ")
        elif tag == "a":
            self.links.append(dict(attrs).get("href"))
            self.out.append("[" if self.links[-1] else "")
        elif tag == "img":
            a = dict(attrs)
            self.out.append(f"![{a.get('alt') or ''}]({a['src']})" if a.get("src") else "")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag in MARKS and not self.pre:
            self.out.append(MARKS[tag])
        elif tag in BLOCKS:
            self.block()

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif self.silent:
            return
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.block(1)
            self.out.append("```")
            self.block()
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.block(1 if self.lists else 2)
        elif tag == "a" and self.links:
            href = self.links.pop()
            self.out.append(f"]({href})" if href else "")
        elif tag in MARKS and not self.pre:
            self.out.append(MARKS[tag])
        elif tag in BLOCKS or tag == "blockquote" or re.fullmatch("h[1-6]", tag):
            self.block()

    def handle_data(self, data):
        if self.silent:
            return
        if self.pre:
            self.out.append(data)
            return
        text = re.sub(r"\s+", " ", data)
        last = self.out[-1] if self.out else "\n"
        self.out.append(text.lstrip() if not last or last[-1] in "\n " else text)


def to_markdown(html: str) -> str:
    w = Writer()
    w.feed(html)
    w.close()
    return re.sub(r"(?<! )[ \t]\n", "\n", re.sub(r"\n{3,}", "\n\n", "".join(w.out))).strip()


@F.pandas_udf(T.StringType())
def markdown(html: pd.Series) -> pd.Series:
    return html.map(lambda x: None if x is None else to_markdown(x))


def with_markdown(pages: DataFrame, html: Column, name: str = "markdown") -> DataFrame:
    """pages with the Markdown of html, which workers get in batches of few bytes: pages are long."""
    modest(pages.sparkSession)
    return pages.withColumn(name, markdown(html))
