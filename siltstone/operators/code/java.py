"""Symbols of Java files: methods and constructors of top-level types, and types without any."""

from __future__ import annotations

import re

from siltstone.operators.code.lexer import Lexer, Token, chain_start, generics_end, past
from siltstone.operators.code.model import SourceFile, Symbol

#: Annotations of classes and methods of the common frameworks.
CLASS_MARKERS = {"RestController": "spring-controller", "Controller": "spring-controller", "Service": "spring-service", "Repository": "spring-repository", "Component": "spring-component", "Entity": "jpa-entity"}
ENDPOINTS = ("GetMapping", "PostMapping", "PutMapping", "DeleteMapping", "PatchMapping", "RequestMapping")
TYPES = ("class", "interface", "enum", "record")
MODIFIERS = ("public", "private", "protected", "static", "final", "abstract", "sealed", "strictfp", "default", "synchronized", "native", "transient", "volatile")
NO_CALLS = {"if", "for", "while", "switch", "catch", "synchronized", "try", "return", "throw", "new", "super", "this", "assert", "else", "do", "case", "yield", "instanceof", "when"}
BEFORE_CALLS = {"return", "throw", "else", "do", "case", "yield", "assert", "instanceof", "in"}


class Scanner:
    def __init__(self, source: str):
        self.source = source
        self.all = Lexer(source).run()
        self.t: list[Token] = [t for t in self.all if t.kind != "comment"]
        where = {id(t): i for i, t in enumerate(self.t)}
        for t in self.t:
            t.pair = where[id(self.all[t.pair])] if t.pair >= 0 and id(self.all[t.pair]) in where else -1
        self.comment_before = {id(b): a for a, b in zip(self.all, self.all[1:], strict=False) if a.kind == "comment"}
        self.out = SourceFile()

    def run(self) -> SourceFile:
        t, i, lines = self.t, 0, []
        while i < len(t):
            if t[i].text in ("package", "import") and t[i].kind == "word":
                end = i
                while end < len(t) and t[end].text != ";":
                    end += 1
                name = "".join(x.text for x in t[i + 1 : end] if x.text != "static" or x.kind != "word")
                if t[i].text == "package":
                    self.out.package = name
                else:
                    lines.append(self.source[t[i].start : t[min(end, len(t) - 1)].end])
                    if not name.endswith("*"):
                        self.out.imports.append(name.rpartition(".")[2])
                i = end + 1
            elif (at := self._declares(i)) is not None:
                i = self._type(i, at)
            else:
                i = past(t, i)
        self.out.header = "\n".join(lines)
        return self.out

    def _head(self, i: int) -> tuple[int, list[str]]:
        """Behind the modifiers and annotations at i, and the annotations' names."""
        t, names = self.t, []
        while i < len(t):
            if t[i].text == "@" and i + 1 < len(t) and t[i + 1].text != "interface":
                k = i + 1
                name = t[k].text
                while k + 2 < len(t) and t[k + 1].text == ".":
                    k += 2
                    name += "." + t[k].text
                names.append(name)
                i = k + 1
                if i < len(t) and t[i].text == "(":
                    i = past(t, i)
            elif t[i].text in MODIFIERS or t[i].text == "non" and i + 2 < len(t) and t[i + 1].text == "-":
                i += 3 if t[i].text == "non" else 1
            else:
                break
        return i, names

    def _declares(self, i: int) -> int | None:
        """The keyword's index if a top-level type begins at i."""
        k, _ = self._head(i)
        if k + 1 < len(self.t) and self.t[k].text in TYPES and self.t[k + 1].kind == "word" and (self.t[k].text != "record" or k + 2 < len(self.t) and self.t[k + 2].text in ("(", "<")):
            return k
        return None

    def _comment(self, i: int) -> str:
        c = self.comment_before.get(id(self.t[i]))
        return c.text if c and c.text.startswith("/*") else ""

    def _private(self, i: int, end: int) -> bool:
        return i < end and bool(re.search(r"\bprivate\b", self.source[self.t[i].start : self.t[end - 1].end]))

    def _type(self, i: int, k: int) -> int:
        t, kind, name = self.t, self.t[k].text, self.t[k + 1].text
        _, annotations = self._head(i)
        body = k + 2
        while body < len(t) and t[body].text != "{":
            body = past(t, body) if t[body].text in "([" else body + 1
        if body >= len(t):
            return len(t)
        end = past(t, body)
        signature = self.source[t[i].start : t[body].start].strip()
        extends, implements = self._heritage(k + 2, body) if kind == "class" else ([], [])
        markers = list(dict.fromkeys(CLASS_MARKERS[a] for a in annotations if a in CLASS_MARKERS))
        members = list(self._members(body + 1, end - 1, name, kind == "enum"))
        for a, b, member in members:
            after, notes = self._head(a)
            ctor = member == name
            endpoint = not ctor and any(x in ENDPOINTS for x in notes)
            self.out.symbols.append(
                Symbol(f"{name}.{member}", "endpoint" if endpoint else "method", t[a].start, t[b - 1].end, self._calls(a, b), not self._private(a, after), markers + ["spring-endpoint"] * endpoint, extends, implements, self._comment(a), signature=signature)
            )
        if not members:
            self.out.symbols.append(Symbol(name, "interface" if kind == "interface" else "class", t[i].start, t[end - 1].end, self._calls(i, end), not self._private(i, k), markers, extends, implements, self._comment(i)))
        return end

    def _heritage(self, i: int, end: int) -> tuple[list[str], list[str]]:
        found: dict[str, list[str]] = {"extends": [], "implements": []}
        into, depth, start = None, 0, None
        for k in range(i, end + 1):
            x = self.t[k]
            if depth == 0 and (x.text in ("extends", "implements", "permits", ",") or k == end):
                if into in found and start is not None:
                    found[into].append(self.source[self.t[start].start : self.t[k - 1].end].split("<")[0].strip())
                into = into if x.text == "," else x.text
                start = k + 1
            depth += (x.text == "<") - (x.text == ">")
        return found["extends"][:1], found["implements"]

    def _members(self, i: int, end: int, owner: str, enum: bool):
        """(first token, behind the last, name) of methods and constructors in a body."""
        t = self.t
        if enum:
            while i < end and t[i].text != ";":
                i = past(t, i)
            i += 1
        while i < end:
            if t[i].text == ";":
                i += 1
                continue
            k, _ = self._head(i)
            name = None
            inner = k < end and (t[k].text in TYPES and k + 1 < end and t[k + 1].kind == "word" and not (t[k].text == "record" and t[k + 2].text not in ("(", "<")) or t[k].text == "@")
            while k < end and t[k].text not in (";", "{", "="):
                if t[k].text == "<" and (g := generics_end(t, k)) > 0:
                    k = g
                elif t[k].text == "(":
                    name = t[k - 1].text if name is None and not inner else name
                    k = past(t, k)
                else:
                    k += 1
            if k < end and t[k].text == "=":  # a field
                while k < end and t[k].text != ";":
                    k = past(t, k)
                i = k + 1
                continue
            if k < end and t[k].text == "{" and name is None and not inner and t[k - 1].text == owner and t[k - 1].kind == "word":
                name = owner
            stop = past(t, k) if k < end else end
            if name is not None:
                yield i, stop, name
            i = stop

    def _calls(self, i: int, end: int) -> list[str]:
        t, found = self.t, []
        for k in range(i, end - 1):
            if t[k].kind != "word" or t[k].text in NO_CALLS or t[k + 1].text != "(" or t[k + 1].pair < 0:
                continue
            before = t[k - 1] if k > 0 else None
            after = t[t[k + 1].pair + 1] if t[k + 1].pair + 1 < len(t) else None
            if before is not None and (before.text == "@" or before.kind == "word" and before.text not in BEFORE_CALLS and k > i):
                continue  # an annotation, a constructor call, or a declaration
            if after is not None and (after.text == "throws" or after.text == "{" and t[k + 1].pair + 1 < end):
                continue
            first = k
            while first > i and t[first - 1].text == "." and t[first - 2].kind == "word":
                first -= 2
            if first > 0 and t[first - 1].text in ("new", "@"):
                continue
            start = chain_start(t, k)
            found.append(((t[start].start, -t[t[k + 1].pair].end), t[k].text))
        return [name for _, name in sorted(found, key=lambda f: f[0])]


def scan(source: str) -> SourceFile:
    return Scanner(source).run()
