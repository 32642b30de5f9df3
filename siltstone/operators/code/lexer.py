"""Tokens of curly-brace languages, with brackets paired, and the calls among them."""

from __future__ import annotations

import re
from dataclasses import dataclass

OPEN, CLOSE = "([{", ")]}"
WORD = re.compile(r"[^\W\d][\w$]*|[$#][\w$]*")
NUMBER = re.compile(r"(?:0[xXbBoO][\da-fA-F_]+|\d[\d_]*(?:\.\d[\d_]*)?(?:[eE][+-]?\d+)?|\.\d[\d_]*(?:[eE][+-]?\d+)?)\w*")
OPERATOR = re.compile(r"=>|\?\.(?!\d)|\.\.\.|===|!==|==|!=|<=|>=|&&|\|\||\?\?|\+\+|--|->|::|.", re.S)
QUOTED = {q: re.compile(rf"{q}(?:\\.|[^{q}\\\n])*{q}?", re.S) for q in "\"'"}
REGEX = re.compile(r"/(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\n\[])+/[a-z]*")
#: After these words an expression begins, so a slash begins a pattern and < a tag.
PREFIX_WORDS = {"return", "typeof", "case", "in", "of", "delete", "void", "throw", "new", "else", "do", "await", "yield", "default", "instanceof"}


@dataclass(slots=True)
class Token:
    kind: str  # word, number, text, template, regex, comment, markup, punct
    text: str
    start: int
    end: int
    line_before: bool  # a line ends between this token and the one before
    pair: int = -1  # index of the matching bracket


class Lexer:
    def __init__(self, source: str, script: bool = False, markup: bool = False):
        self.s, self.script, self.markup, self.tokens = source, script, markup, []
        self.at = 0

    def run(self) -> list[Token]:
        self._until(None)
        pair_up(self.tokens)
        return self.tokens

    def _add(self, kind: str, end: int) -> None:
        before = self.tokens[-1].end if self.tokens else 0
        self.tokens.append(Token(kind, self.s[self.at : end], self.at, end, "\n" in self.s[before : self.at]))
        self.at = end

    def _value_before(self) -> bool:
        """Whether what comes before ends a value, so that an operator follows."""
        for t in reversed(self.tokens):
            if t.kind != "comment":
                if t.kind == "word":
                    return t.text not in PREFIX_WORDS
                return t.kind in ("number", "text", "template", "regex", "markup") or t.text in (")", "]", "}")
        return False

    def _until(self, stop: str | None) -> None:
        """Tokens up to an unpaired closing brace (stop) or the end."""
        s, depth = self.s, 0
        while self.at < len(s):
            c = s[self.at]
            if c.isspace() or c == "﻿":
                self.at += 1
            elif s.startswith("//", self.at):
                end = s.find("\n", self.at)
                self._add("comment", len(s) if end < 0 else end)
            elif s.startswith("/*", self.at):
                end = s.find("*/", self.at + 2)
                self._add("comment", len(s) if end < 0 else end + 2)
            elif not self.script and s.startswith('"""', self.at):
                end = s.find('"""', self.at + 3)
                self._add("text", len(s) if end < 0 else end + 3)
            elif c in QUOTED:
                self._add("text", QUOTED[c].match(s, self.at).end())
            elif c == "`" and self.script:
                self._template()
            elif c == "/" and self.script and not self._value_before() and (m := REGEX.match(s, self.at)):
                self._add("regex", m.end())
            elif c == "<" and self.markup and not self._value_before() and re.match(r"<(?:>|[A-Za-z_][\w.\-]*(?:\s[^<>=]*=|\s*/?>|\s+[\w\-]+[\s/>={]|\s*\{))", s[self.at :self.at + 200]):
                self._tag()
            elif m := WORD.match(s, self.at):
                self._add("word", m.end())
            elif m := NUMBER.match(s, self.at):
                self._add("number", m.end())
            else:
                if stop and c == "{":
                    depth += 1
                elif stop and c == "}":
                    if not depth:
                        return
                    depth -= 1
                self._add("punct", OPERATOR.match(s, self.at).end())

    def _hole(self, i: int, holes: list[Token]) -> int:
        """Tokens of a hole whose text begins at i, in braces; where it has ended."""
        inner = Lexer(self.s, self.script, self.markup)
        inner.at = i
        inner._until("}")
        holes += [Token("punct", "{", i, i, False), *inner.tokens, Token("punct", "}", inner.at, inner.at, False)]
        return inner.at + 1

    def _behind(self, holes: list[Token]) -> None:
        """Holes come after the token that they stand in, and end with it."""
        if holes:
            holes[-1].start = holes[-1].end = self.at
        self.tokens += holes

    def _template(self) -> None:
        """A template string; what stands in its holes is tokens of its own after it."""
        s, i, holes = self.s, self.at + 1, []
        while i < len(s) and s[i] != "`":
            if s[i] == "\\":
                i += 2
            elif s.startswith("${", i):
                i = self._hole(i + 2, holes)
            else:
                i += 1
        self._add("template", min(i + 1, len(s)))
        self._behind(holes)

    def _tag(self) -> None:
        """A markup element with all within it; tokens of its braces come after it."""
        s, start, holes, depth = self.s, self.at, [], 0
        i = start
        while i < len(s):
            if s[i] == "{":
                i = self._hole(i + 1, holes)
            elif s[i] == "<":
                closing = s.startswith("</", i)
                i, alone = self._inside(i, holes)
                depth += -1 if closing else 0 if alone else 1
                if depth <= 0:
                    break
            else:
                i += 1
        self._add("markup", i)
        self._behind(holes)

    def _inside(self, i: int, holes: list[Token]) -> tuple[int, bool]:
        """From < of a tag to behind its >; whether it closes itself."""
        s = self.s
        while i < len(s) and s[i] != ">":
            if s[i] == "{":
                i = self._hole(i + 1, holes)
            elif s[i] in QUOTED:
                end = s.find(s[i], i + 1)
                i = len(s) if end < 0 else end + 1
            else:
                i += 1
        return i + 1, s[i - 1 : i] == "/"


def pair_up(tokens: list[Token]) -> None:
    stack: list[int] = []
    for i, t in enumerate(tokens):
        if t.kind != "punct":
            continue
        if t.text in OPEN:
            stack.append(i)
        elif t.text in CLOSE:
            want = OPEN[CLOSE.index(t.text)]
            while stack and tokens[stack[-1]].text != want:
                stack.pop()
            if stack:
                t.pair = stack.pop()
                tokens[t.pair].pair = i


def past(tokens: list[Token], i: int) -> int:
    """The index behind token i, or behind its closing bracket."""
    return (tokens[i].pair if tokens[i].pair > i else i) + 1


def generics_end(tokens: list[Token], i: int, most: int = 80) -> int:
    """Behind the > that closes the < at i, or -1 if this is no list of types."""
    depth, k = 0, i
    while k < min(len(tokens), i + most):
        t = tokens[k]
        if t.text == "<":
            depth += 1
        elif t.text == ">":
            depth -= 1
            if not depth:
                return k + 1
        elif t.kind not in ("word", "text", "number", "comment") and t.text not in ("|", "&", "[", "]", "{", "}", ":", ";", "?", "=>", "(", ")", ".", ",", "@"):
            return -1
        k += 1
    return -1


def chain_start(tokens: list[Token], i: int) -> int:
    """The token at which the expression that ends with the name at i begins: its receivers come first."""
    while i > 0 and tokens[i - 1].text in (".", "?.", "::"):
        k = i - 2
        while k >= 0 and tokens[k].kind == "punct" and tokens[k].text in (")", "]") and tokens[k].pair >= 0:
            k = tokens[k].pair - 1  # before the bracket: a name, another bracket, or nothing of the chain
            if k < 0 or not (tokens[k].kind in ("word", "template") and tokens[k].text not in PREFIX_WORDS or tokens[k].text in (")", "]", ".", "?.")):
                return k + 1
            if tokens[k].text in (".", "?."):
                k -= 1
        if k < 0:
            return i
        i = k
        if i > 0 and tokens[i - 1].text == "new":
            i -= 1
    return i
