"""Symbols of Python files: functions, methods, and classes without methods, with routes of web frameworks."""

from __future__ import annotations

import ast
import io
import keyword
import re
import tokenize
from collections.abc import Iterator
from itertools import accumulate

from siltstone.operators.code.model import SourceFile, Symbol

#: Constructors of applications, verbs, decorators, and base classes of web frameworks.
APPS = {"Flask": "flask", "Blueprint": "flask", "FastAPI": "fastapi", "APIRouter": "fastapi", "Bottle": "bottle"}
VERBS = ("get", "post", "put", "delete", "patch")
DJANGO_DECORATORS = ("api_view", "require_GET", "require_POST", "require_http_methods")
BASE_MARKERS = {"django-model": ("Model",), "django-view": ("View", "ViewSet"), "django-serializer": ("Serializer",)}

Function = ast.FunctionDef | ast.AsyncFunctionDef


class Places:
    """Character offsets of the syntax tree's lines and byte columns."""

    def __init__(self, source: str):
        self.source = source
        self.lines = re.split("(?<=\n)|(?<=\r)(?!\n)", source) if "\r" in source else [f"{x}\n" for x in source.split("\n")]
        self.starts = [0, *accumulate(map(len, self.lines))]

    def at(self, line: int, column: int) -> int:
        text = self.lines[line - 1]
        return self.starts[line - 1] + (column if text.isascii() else len(text.encode()[:column].decode(errors="replace")))

    def start(self, node: ast.AST) -> int:
        return self.at(node.lineno, node.col_offset)

    def end(self, node: ast.AST) -> int:
        return self.at(node.end_lineno, node.end_col_offset)

    def text(self, node: ast.AST) -> str:
        return self.source[self.start(node) : self.end(node)]

    def column(self, offset: int) -> int:
        return offset - (self.source.rfind("\n", 0, offset) + 1)


def last_name(node: ast.AST) -> str | None:
    return node.id if isinstance(node, ast.Name) else node.attr if isinstance(node, ast.Attribute) else None


#: Lines of one indentation that are a call of a plain name without arguments, three at least.
RUN = re.compile(r"^([ \t]+)[A-Za-z_]\w*\(\)\n(?:\1[A-Za-z_]\w*\(\)\n){2,}", re.M | re.A)
KEYWORDS = frozenset(keyword.kwlist)


class Runs:
    """Runs of bare calls in a source, which need no syntax tree: short has the first and the last line of each and blank lines between, so
    it is valid where the source is, and its tree has the same places. Between them there are statements if and only if the last line is one: lines of
    a string or after a backslash are not, and brackets hold no two calls side by side."""

    def __init__(self, source: str):
        self.lines: list[int] = []
        self.names: list[str] = []
        self.last: dict[int, tuple[int, int]] = {}
        parts, at, line = [], 0, 1
        # other line ends than \n would shift the lines of the tree
        for m in () if "\r" in source or "\f" in source else RUN.finditer(source):
            names = [x.strip()[:-2] for x in m[0].split("\n")[:-1]]
            if not KEYWORDS.isdisjoint(names):
                continue
            first = line = line + source.count("\n", at, m.start())
            parts += [source[at : m.start()], m[0][: m[0].index("\n")], "\n" * (len(names) - 1), m[1], names[-1], "()\n"]
            at, line = m.end(), line + len(names)
            self.last[line - 1] = (len(self.lines), len(self.lines) + len(names) - 2)
            self.lines += range(first + 1, line - 1)
            self.names += names[1:-1]
        self.short = "".join([*parts, source[at:]])

    def between(self, statements: set[int]) -> list[tuple[int, str]]:
        """(line, name) of the calls that short leaves out; statements: the lines on which calls stand as statements."""
        out = []
        for line in statements:
            a, b = self.last.get(line, (0, 0))
            out += zip(self.lines[a:b], self.names[a:b], strict=True)
        return out


def children(node: ast.AST) -> list[ast.AST]:
    """The nodes right below node but for those that hold no other, in any order."""
    out = []
    for name in node._fields:
        x = getattr(node, name, None)
        if isinstance(x, list):
            out += [c for c in x if isinstance(c, ast.AST)]
        elif isinstance(x, ast.AST) and x._fields:
            out.append(x)
    return out


def statements(tree: ast.AST) -> Iterator[ast.AST]:
    """All nodes that can hold a statement, and the statements, of tree, in any order."""
    todo = [tree]
    while todo:
        x = todo.pop()
        yield x
        for name in ("body", "orelse", "finalbody", "handlers", "cases"):
            if isinstance(below := getattr(x, name, None), list):
                todo += below


def callees(node: ast.AST, runs: Runs | None = None) -> list[str]:
    """Names that are called within node, outer calls before those in their receivers and arguments; a function's own decorators aside. Those
    that runs left out of the tree are put back."""
    own = set(map(id, getattr(node, "decorator_list", [])))
    found, todo, bare = [], [node], set()
    while todo:
        x = todo.pop()
        kind = type(x)
        if kind is ast.Name or kind is ast.Constant:
            continue
        if kind is ast.Expr and type(x.value) is ast.Call:
            bare.add(x.lineno)
        if kind is ast.Call and (name := last_name(x.func)):
            found.append(((x.lineno, x.col_offset, -x.end_lineno, -x.end_col_offset), name))
        todo += [c for c in children(x) if id(c) not in own] if x is node else children(x)
    if runs:
        found += [((line,), name) for line, name in runs.between(bare)]
    return [name for _, name in sorted(found, key=lambda f: f[0])]


def string(node: ast.AST | None) -> str | None:
    return node.value if isinstance(node, ast.Constant) and isinstance(node.value, str) else None


def strings(node: ast.AST | None) -> list[str]:
    return [s for x in node.elts if (s := string(x)) is not None] if isinstance(node, ast.List) else []


def keyword(call: ast.Call, name: str) -> ast.AST | None:
    return next((k.value for k in call.keywords if k.arg == name), None)


class Scanner:
    def __init__(self, source: str):
        self.runs = Runs(source)
        self.tree, self.places, self.source = ast.parse(self.runs.short), Places(source), source
        self.out, self.bottle, self.apps = SourceFile(), set(), {}

    def run(self) -> SourceFile:
        self._imports()
        for node in sorted((n for n in statements(self.tree) if isinstance(n, ast.Assign | ast.AnnAssign)), key=lambda n: (n.lineno, n.col_offset)):
            target = node.targets[-1] if isinstance(node, ast.Assign) else node.target
            if isinstance(target, ast.Name) and isinstance(node.value, ast.Call) and last_name(node.value.func) in APPS:
                self.apps[target.id] = APPS[last_name(node.value.func)]
        for node in self.tree.body:
            if isinstance(node, Function):
                self._function(node, node.name)
            elif isinstance(node, ast.ClassDef):
                self._class(node)
        return self.out

    def _imports(self) -> None:
        lines = []
        for node in self.tree.body:
            if isinstance(node, ast.Import):
                self.out.imports += [a.asname or a.name.rpartition(".")[2] for a in node.names]
            elif isinstance(node, ast.ImportFrom):
                self.out.imports += [a.asname or a.name for a in node.names if a.name != "*"]
                if node.module == "bottle" and not node.level:
                    self.bottle |= {a.name for a in node.names if not a.asname}
            else:
                continue
            lines.append(self.places.text(node))
        self.out.header = "\n".join(lines)

    def _first(self, node: Function) -> int:
        """Where the definition begins: at the @ of its first decorator."""
        if not node.decorator_list:
            return self.places.start(node)
        return self.source.rindex("@", 0, self.places.start(node.decorator_list[0]))

    def _docstring(self, node: Function) -> str:
        first = node.body[0]
        if not isinstance(first, ast.Expr) or not (isinstance(first.value, ast.JoinedStr) or isinstance(first.value, ast.Constant) and isinstance(first.value.value, str | bytes)):
            return ""
        text = self.places.text(first.value)
        try:
            kinds = [t.type for t in tokenize.generate_tokens(io.StringIO(text).readline)]
        except (tokenize.TokenError, SyntaxError):
            return text
        return "" if kinds.count(tokenize.STRING) > 1 else text

    def _route(self, call: ast.AST) -> tuple[str, str] | None:
        """(marker, label) if a decorator registers a route."""
        if isinstance(call, ast.Name) and call.id in DJANGO_DECORATORS:
            return "django-endpoint", "POST" if call.id == "require_POST" else "GET"
        if not isinstance(call, ast.Call):
            return None
        path = string(call.args[0]) if call.args else None
        label = lambda verbs: "/".join(verbs or ["GET"]) + (f" {path}" if path else "")
        if isinstance(call.func, ast.Name):
            name = call.func.id
            if name in DJANGO_DECORATORS:
                return "django-endpoint", "/".join((strings(call.args[0]) if call.args else []) or ["GET"])
            if name in self.bottle and name in (*VERBS, "route"):
                verb = (string(keyword(call, "method")) or "GET") if name == "route" else name
                return "bottle-endpoint", label([verb.upper()])
        elif isinstance(call.func, ast.Attribute) and isinstance(call.func.value, ast.Name) and call.func.value.id in self.apps:
            kind, verb = self.apps[call.func.value.id], call.func.attr.lower()
            if verb in VERBS:
                return f"{kind}-endpoint", label([verb.upper()])
            if verb == "route":
                return f"{kind}-endpoint", label([v.upper() for v in strings(keyword(call, "methods"))])
        return None

    def _function(self, node: Function, name: str, signature: str = "", markers: tuple[str, ...] = (), bases: tuple[str, ...] = ()) -> None:
        route = next(filter(None, map(self._route, node.decorator_list)), None)
        start = self._first(node)
        self.out.symbols.append(
            Symbol(
                name, "endpoint" if route else "method" if signature else "function", start, self.places.end(node), callees(node, self.runs), not node.name.startswith("_"),
                [*markers, *([route[0]] if route else [])], list(bases), signature=signature, notes=self._docstring(node), route=route[1] if route else "", indent=self.places.column(start),
            )
        )

    def _class(self, node: ast.ClassDef) -> None:
        parts = sorted([*node.bases, *node.keywords], key=lambda n: (n.lineno, n.col_offset))
        bases = tuple(n.attr if isinstance(n, ast.Attribute) else self.places.text(n) for n in parts)
        markers = tuple(m for b in bases for m, ends in BASE_MARKERS.items() if b.endswith(ends))
        markers = tuple(dict.fromkeys(markers))
        first = node.body[0]
        body = self._first(first) if isinstance(first, Function) else self.places.start(first)
        signature = self.source[self.places.start(node) : body].strip()
        methods = [n for n in node.body if isinstance(n, Function)]
        for n in methods:
            self._function(n, f"{node.name}.{n.name}", signature, markers, bases)
        if not methods:
            self.out.symbols.append(Symbol(node.name, "class", self.places.start(node), self.places.end(node), callees(node, self.runs), not node.name.startswith("_"), list(markers), list(bases)))


BLOCK = re.compile(r"^(?:async[ \t]+)?(def|class)[ \t]+(\w+)", re.M)


def roughly(source: str) -> SourceFile:
    """For text that is no valid Python: top-level definitions by their indentation, up to the next line that is not indented."""
    out = SourceFile()
    heads = re.findall(r"^(?:import|from)[ \t].*$", source, re.M)
    out.header = "\n".join(heads)
    for head in heads:
        names = head.split("import", 1)[1] if "import" in head else ""
        out.imports += [x.split(" as ")[-1].strip().rpartition(".")[2] for x in names.strip(" ()\\").split(",") if x.strip() and x.strip() != "*"]
    for m in BLOCK.finditer(source):
        end = re.compile(r"^[^\s#)\]}]", re.M).search(source, m.end())
        text = source[m.start() : end.start() if end else len(source)].rstrip()
        calls = re.findall(r"(\w+)[ \t]*\(", text[m.end() - m.start() :])
        kind = "function" if m[1] == "def" else "class"
        out.symbols.append(Symbol(m[2], kind, m.start(), m.start() + len(text), [c for c in calls if c not in ("if", "while", "for", "return", "and", "or", "not", "in")], not m[2].startswith("_")))
    return out


def scan(source: str) -> SourceFile:
    try:
        return Scanner(source).run()
    except (SyntaxError, ValueError, RecursionError):
        return roughly(source)
