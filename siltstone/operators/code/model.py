"""What a scanner says about a file."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Symbol:
    name: str
    kind: str
    start: int  # character offsets of the body
    end: int
    calls: list[str] = field(default_factory=list)
    exported: bool = False
    markers: list[str] = field(default_factory=list)
    extends: list[str] = field(default_factory=list)
    implements: list[str] = field(default_factory=list)
    comment: str = ""  # shown above the body
    notes: str = ""  # embedded before the body, not shown
    signature: str = ""  # of the class around it
    route: str = ""
    indent: int = 0


@dataclass
class SourceFile:
    imports: list[str] = field(default_factory=list)
    header: str = ""
    package: str = ""
    symbols: list[Symbol] = field(default_factory=list)
