"""Symbols of TypeScript and JavaScript files: top-level functions, classes, types and function constants, with routes."""

from __future__ import annotations

import re
from functools import cached_property

from siltstone.operators.code.lexer import Lexer, Token, chain_start, generics_end, past
from siltstone.operators.code.model import SourceFile, Symbol

#: Fixed values.
VERBS = ("get", "post", "put", "delete", "patch", "all")
NO_CALLS = {"if", "for", "while", "switch", "catch", "function", "return", "typeof", "new", "super", "import", "await", "void", "delete", "throw", "case", "in", "of", "do", "else", "yield", "async", "with", "constructor"}
CONTINUES = {".", "?.", ",", "(", "[", "=", "=>", "+", "-", "*", "/", "%", "?", ":", "&&", "||", "??", "&", "|", "^", "<", ">", "<=", ">=", "==", "!=", "===", "!==", "{"}
CONTINUING_WORDS = {"instanceof", "in", "as", "satisfies", "extends", "implements", "of", "from", "is"}
OPENS_MEMBER = {"{", "}", ";", ",", "async", "static", "public", "private", "protected", "get", "set", "readonly", "override", "*"}


def component(name: str) -> bool:
    return re.fullmatch("[A-Z][A-Za-z0-9]*", name) is not None


def hook(name: str) -> bool:
    return re.match("use[A-Z]", name) is not None


def router_like(name: str) -> bool:
    return name.lower() in ("app", "router") or name.endswith(("Router", "App"))


class Scanner:
    def __init__(self, source: str, markup: bool):
        self.source = source
        self.all = Lexer(source, script=True, markup=markup).run()
        self.t: list[Token] = [t for t in self.all if t.kind != "comment"]
        where = {id(t): i for i, t in enumerate(self.t)}
        for t in self.t:
            t.pair = where[id(self.all[t.pair])] if t.pair >= 0 and id(self.all[t.pair]) in where else -1
        self.comment_before = {id(b): a for a, b in zip(self.all, self.all[1:], strict=False) if a.kind == "comment"}
        self.out = SourceFile()

    def text(self, i: int) -> str:
        return self.t[i].text if 0 <= i < len(self.t) else ""

    def run(self) -> SourceFile:
        i, lines, routes = 0, [], []
        while i < len(self.t):
            end = self._statement_end(i)
            if self.text(i) == "import" and self.text(i + 1) not in ("(", "."):
                lines.append(self.source[self.t[i].start : self.t[end - 1].end])
                self._import(i, end)
            elif not self._declaration(i, end):
                routes += self._route(i, end)
            i = end
        self.out.header = "\n".join(lines)
        self._reconcile(routes)
        return self.out

    def _statement_end(self, i: int) -> int:
        """Behind the statement at i: behind its semicolon, its block, or the last token before a line end where it can end."""
        t, k = self.t, i
        while self.text(k) in ("export", "default", "async", "declare", "abstract"):
            k += 1
        while self.text(k) == "@":
            k += 2
            while self.text(k) in (".", "("):
                k = past(t, k) if self.text(k) == "(" else k + 2
        while self.text(k) in ("export", "default", "async", "declare", "abstract"):
            k += 1
        word = self.text(k)
        if word in ("function", "class", "interface", "enum", "namespace", "module") and (t[k].kind == "word") and k + 1 < len(t) and (t[k + 1].kind in ("word", "text") or self.text(k + 1) in ("*", "(", "{")):
            k += 1
            while k < len(t):
                if self.text(k) == "{":
                    if word == "function" and self.text(k - 1) in (":", "|", "&", "=>", "is") or word != "function" and self.text(k - 1) in ("<", ",", "|", "&"):
                        k = past(t, k)  # an object type
                        continue
                    return past(t, k)
                if self.text(k) == ";":
                    return k + 1
                if self.text(k) == "<" and (g := generics_end(t, k)) > 0:
                    k = g
                    continue
                k = past(t, k) if self.text(k) in ("(", "[") else k + 1
            return len(t)
        if word in ("if", "for", "while", "switch", "try", "do", "{"):
            k = self._block_end(k)
            return max(k, i + 1)
        k = i
        while k < len(t):
            if self.text(k) == ";" and t[k].kind == "punct":
                return k + 1
            if k > i and t[k].line_before and not self._continues(k):
                return k
            k = past(t, k)
        return len(t)

    def _block_end(self, k: int) -> int:
        t = self.t
        while k < len(t):
            if self.text(k) == "{":
                k = past(t, k)
                if self.text(k) in ("else", "catch", "finally", "while"):
                    continue
                return k
            if self.text(k) == ";":
                return k + 1
            k = past(t, k)
        return k

    def _continues(self, k: int) -> bool:
        """Whether the token at k, first of its line, goes on with what is before it."""
        before, here = self.t[k - 1], self.t[k]
        if here.kind == "punct" and here.text in CONTINUES or here.kind == "word" and here.text in CONTINUING_WORDS or here.kind == "template":
            return not (here.text == "{" and before.text in (")", "}", "]", ";"))
        if before.kind == "punct":
            return before.text not in (")", "]", "}", ";", "++", "--", ">")
        return before.kind == "word" and before.text in ("return", "typeof", "new", "await", "export", "default", "const", "let", "var", "type", "async", "from", "as", "import", "in", "of", "extends", "implements", "keyof")

    def _import(self, i: int, end: int) -> None:
        words = [x.text for x in self.t[i + 1 : end] if x.kind == "word"]
        if words and words[0] == "type" and len(words) > 1 and words[1] != "from":
            words = words[1:]
        self.out.imports += [w for w in words if w not in ("as", "from", "type", "typeof")]

    def _comment(self, i: int) -> str:
        c = self.comment_before.get(id(self.t[i]))
        return c.text if c else ""

    def _add(self, name: str, kind: str, top: int, i: int, end: int, exported: bool, markers: list[str], **more) -> None:
        self.out.symbols.append(Symbol(name, kind, self.t[i].start, self.t[end - 1].end, self._calls(i, end), exported, markers, comment=self._comment(top), **more))

    def _function_like(self, name: str) -> tuple[str, list[str]]:
        return ("component" if component(name) else "function"), ["react-component"] * component(name) + ["react-hook"] * hook(name)

    def _declaration(self, top: int, end: int) -> bool:
        """Adds the symbols that the statement declares; whether it is a declaration."""
        t, i = self.t, top
        exported = self.text(i) == "export"
        if exported:
            i += 2 if self.text(i + 1) == "default" else 1
        word, k = self.text(i), i
        if word == "async":
            k = i + 1
        if self.text(k) == "function":
            if self.text(k + 1) != "*" and k + 1 < end and t[k + 1].kind == "word":
                kind, markers = self._function_like(t[k + 1].text)
                self._add(t[k + 1].text, kind, top, i, end, exported, markers)
            return True
        if word == "@" and exported:
            return True
        while word == "@":
            k += 2
            while self.text(k) in (".", "("):
                k = past(t, k) if self.text(k) == "(" else k + 2
            word = self.text(k)
        if word == "export":
            return True
        if word in ("class", "interface", "type") and k + 1 < end and t[k + 1].kind == "word" and t[k].kind == "word" and (word != "type" or self.text(k + 2) in ("=", "<")):
            more = dict(zip(("extends", "implements"), self._heritage(k + 2, end), strict=True)) if word == "class" else {}
            if word == "class" and t[k + 1].text in ("extends", "implements"):
                return True
            if word == "interface" and self.text(end - 1) == ";":
                end -= 1
            self._add(t[k + 1].text, word, top, i, end, exported, [], **more)
            return True
        if word in ("const", "let") and t[k].kind == "word":
            for name, value in self._declarators(k + 1, end):
                if self._is_function(value, end):
                    kind, markers = self._function_like(name)
                    self._add(name, kind, top, i, end, exported, markers)
            return True
        return word in ("enum", "abstract", "declare", "namespace", "module", "var") or exported

    def _heritage(self, i: int, end: int) -> tuple[list[str], list[str]]:
        t, found, into, start, depth = self.t, {"extends": [], "implements": []}, None, None, 0

        def close(k: int) -> None:
            if into and start is not None and k > start:
                found[into].append(self.source[t[start].start : t[k - 1].end])

        k = i
        if self.text(k) == "<" and (g := generics_end(t, k)) > 0:
            k = g
        while k < end:
            x = t[k]
            if x.text in ("extends", "implements") and x.kind == "word":
                close(k)
                into, start = x.text, k + 1
            elif x.text == "<" and (g := generics_end(t, k)) > 0:
                close(k)
                start, k = None, g
                continue
            elif x.text == ",":
                close(k)
                start = k + 1
            elif x.text == "{":
                close(k)
                break
            elif x.text == "(":
                k = past(t, k)
                continue
            k += 1
        return found["extends"][:1], found["implements"]

    def _declarators(self, k: int, end: int):
        """(name, first token of the value) of each declared name with a value."""
        t = self.t
        while k < end:
            name = t[k].text if t[k].kind == "word" else None
            while k < end and self.text(k) not in ("=", ",", ";"):
                g = generics_end(t, k) if self.text(k) == "<" else -1
                k = g if g > 0 else past(t, k)
            if self.text(k) == "=" and name:
                yield name, k + 1
            while k < end and self.text(k) != ",":
                g = generics_end(t, k) if self.text(k) == "<" else -1
                k = g if g > 0 else past(t, k)
            k += 1

    def _is_function(self, k: int, end: int) -> bool:
        t = self.t
        if self.text(k) == "async" and not (k + 1 < end and self.text(k + 1) == "=>"):
            k += 1
        if self.text(k) == "function":
            return self.text(k + 1) != "*"
        if self.text(k) == "<" and (g := generics_end(t, k)) > 0:
            k = g
        if k < end and t[k].kind == "word" and self.text(k + 1) == "=>":
            return True
        if self.text(k) != "(" or t[k].pair < 0:
            return False
        k = t[k].pair + 1
        if self.text(k) == ":":  # up to the arrow, a type
            while k < end and self.text(k) not in ("=>", ";", "="):
                k = past(t, k)
        return self.text(k) == "=>"

    @cached_property
    def routers(self) -> set[str]:
        """Names that hold an application or a router, found once a file."""
        names, t = set(), self.t
        for i, x in enumerate(t):
            if x.text not in ("const", "let", "var") or x.kind != "word":
                continue
            for name, k in self._declarators(i + 1, self._value_end(i)):
                last, m = k, k
                while m + 2 < len(t) and t[m].kind == "word" and self.text(m + 1) in (".", "?."):
                    m += 2
                    last = m
                if self.text(last + 1) != "(":
                    continue
                after = self.text(past(t, last + 1))
                if after not in (".", "?.", "(") and (last == k and t[k].text == "express" or last > k and t[last].text == "Router"):
                    names.add(name)
        return names

    def _value_end(self, i: int) -> int:
        k = i + 1
        while k < len(self.t):
            if self.text(k) == ";" or self.t[k].line_before and not self._continues(k) or self.text(k) in (")", "}", "]"):
                return k
            k = past(self.t, k)
        return k

    def _route(self, i: int, end: int) -> list[tuple[int, int, str, str | None]]:
        """(first token, behind the last, label, handler's name) of a statement like app.get("/x", ..., handler)."""
        t = self.t
        last = end - 1 if self.text(end - 1) == ";" else end
        if not (i + 3 < last and t[i].kind == "word" and self.text(i + 1) == "." and t[i + 2].kind == "word" and self.text(i + 3) == "(" and t[i + 3].pair == last - 1):
            return []
        verb, first, then = t[i + 2].text.lower(), t[i + 4], i + 5
        while self.text(then) == "{":  # holes of a template
            then = past(t, then)
        if verb not in VERBS or first.kind not in ("text", "template") or not first.text[1:].startswith("/") or self.text(then) not in (",", ")"):
            return []
        if not router_like(t[i].text) and t[i].text not in self.routers:
            return []
        k, start = i + 4, i + 4
        while k < last - 1:
            if self.text(k) == "," and k + 1 < last - 1:
                start = k + 1
            k = past(t, k)
        stop = last - 2 if self.text(last - 2) == "," else last - 1
        handler = t[start].text if stop - start == 1 and t[start].kind == "word" else None
        return [(i, end, f"{verb.upper()} {first.text[1:-1]}", handler)]

    def _reconcile(self, routes: list[tuple[int, int, str, str | None]]) -> None:
        """A route whose handler is a symbol of the file marks that symbol; another is a symbol itself."""
        for i, end, label, handler in routes:
            known = next((s for s in self.out.symbols if handler and s.name == handler), None)
            if known:
                known.kind, known.route = "endpoint", label
                known.markers = [*known.markers, *(["express-route"] if "express-route" not in known.markers else [])]
            else:
                self._add(label, "endpoint", i, i, end, False, ["express-route"])

    def _calls(self, i: int, end: int) -> list[str]:
        t, found = self.t, []
        for k in range(i, end):
            if t[k].kind != "word" or t[k].text in NO_CALLS and self.text(k - 1) not in (".", "?."):
                continue
            after = k + 1
            if self.text(after) == "?." and self.text(after + 1) == "(":
                after += 1
            elif self.text(after) == "<" and (g := generics_end(t, after)) > 0 and self.text(g) == "(":
                after = g
            tagged = after < len(t) and t[after].kind == "template" and not t[after].line_before
            if not tagged and (self.text(after) != "(" or t[after].pair < 0):
                continue
            before = self.text(k - 1)
            stop = after if tagged else t[after].pair
            then = self.text(stop + 1) if stop + 1 < end else ""
            if before == "function" or before == "*" and self.text(k - 2) == "function":
                continue
            if not tagged and before in OPENS_MEMBER and (then == "{" and not t[stop + 1].line_before or then == ":") and k > i:
                continue  # a method
            start = chain_start(t, k)
            if start > 0 and t[start - 1].text == "new" or t[start].text == "new" and self.text(k - 1) not in (".", "?."):
                continue
            found.append(((t[start].start, -t[stop].end), t[k].text))
        return [name for _, name in sorted(found, key=lambda f: f[0])]


def scan(source: str, markup: bool = True) -> SourceFile:
    return Scanner(source, markup).run()
