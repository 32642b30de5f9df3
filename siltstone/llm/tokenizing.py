"""Encoding with public tokenizer files: every text is cut at boundaries that the tokenizer itself
never crosses, each distinct piece is encoded once by the library, and pieces are looked up: first
what stands between spaces, then, where that is new, the matches of the pre-tokenizer's pattern.

Why the cuts are safe:

* byte-level files whose pre-tokenizer is the usual contraction/letters/numbers/others/space pattern:
  no alternative of that pattern matches a non-space character followed by white space, so the place
  before a white-space run always begins a new match. White space is what the pattern's own class
  holds: Python's less U+001C to U+001F.
* word files (white space dropped, end-of-word suffix): white space always ends a match; inside, a
  text of plain Latin characters is cut into the pattern's own matches after lower-casing.

Added tokens hold no white space, so no cut falls inside one.
"""

from __future__ import annotations

import json
import re
from array import array

from siltstone.llm.shared import kept

#: Characters beyond these, or what may begin an added token, make a text "odd": it is cut at white space only.
ODD = re.compile("[^\t-\r\x20-\x7e¡-©«¬®-±´¶-¸»¿-ÿ]|<\\|")
#: The pre-tokenizers' patterns over the characters that are left.
BYTE_MATCH = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\\s+(?!\\S)|\\s+")
WORD_MATCH = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
#: White space other than space and line feed.
RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SPACE, SOLID = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
PIECE = re.compile(f"{SPACE}*{SOLID}+|{SPACE}+")
WORD = re.compile(f"{SOLID}+")
#: White space that makes a byte-level text be cut by PIECE rather than at single spaces.
PLAIN = re.compile(f"  | \n|\n | $|{RARE_SPACE.pattern}")
#: Kinds of files.
BYTE, WORDS, WHOLE, SENTENCES = "byte", "word", "whole", "sentencepiece"
#: Entries of each of the two generations of a cache, and the longest key that is kept: so bytes are bounded too.
CACHE_ENTRIES, LONGEST_KEPT = 200_000, 64


def encoder(path: str, entries: int = CACHE_ENTRIES) -> PieceEncoder:
    """One encoder a Python worker; its cache lives until another operator's takes its place."""
    return kept(("pieces", path, entries), lambda: PieceEncoder(path, entries))


def loaded(path: str):
    """The library's model of a file, and the file's kind."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path), SENTENCES
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if any(re.search(r"\s", x["content"]) or not x["content"].startswith("<|") or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens", [])):
        return model, WHOLE
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return model, BYTE
    return model, WORDS if spec["model"].get("end_of_word_suffix") and pre.get("type") == "Sequence" else WHOLE


class Memo(dict):
    """make(key), remembered: at most two generations of `entries` keys of at most LONGEST_KEPT characters; one used again moves to the
    younger. rotate() between batches keeps it so."""

    def __init__(self, make, entries: int):
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value

    def rotate(self) -> None:
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


class PieceEncoder:
    """ids(texts) gives each text's ids as little-endian unsigned 32-bit integers, as the library does
    with add_special_tokens=False, no truncation and no padding."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.model, self.kind = loaded(path)
        if self.kind == SENTENCES:
            return
        self.letters = {i: "".join(byte_letters()[b] for b in chr(i).encode()) for i in range(0x100)}
        bpe = self.model.model
        match = (lambda x: array("I", [t.id for t in bpe.tokenize(x.translate(self.letters))]).tobytes()) if self.kind in ("byte", "word") else self._whole
        self.matches = Memo(match, entries)
        known = self.matches.__getitem__
        find = BYTE_MATCH.findall if self.kind == "byte" else lambda x: WORD_MATCH.findall(x.lower())
        split = lambda x: self._whole(x) if ODD.search(x) else b"".join(map(known, find(x)))
        self.first, self.spaced = Memo(split, entries), Memo(lambda x: split(" " + x), entries)

    def _whole(self, text: str) -> bytes:
        return array("I", self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _one(self, text: str) -> bytes:
        if self.kind == "byte":
            if PLAIN.search(text):
                return b"".join(map(self.first.__getitem__, PIECE.findall(text)))
            parts = text.split(" ")
            parts[0] = self.first[parts[0]]
            parts[1:] = map(self.spaced.__getitem__, parts[1:])
            return b"".join(parts)
        return b"".join(map(self.first.__getitem__, WORD.findall(text) if ODD.search(text) else text.lower().split()))

    def ids(self, texts: list[str]) -> list[bytes]:
        if self.kind == "sentencepiece":
            return [array("I", x).tobytes() for x in self.model.encode(texts, num_threads=1)]
        if self.kind == "whole":
            return list(map(self._whole, texts))
        out = list(map(self._one, texts))
        for memo in (self.matches, self.first, self.spaced):
            memo.rotate()
        return out

    def byte_table(self) -> list[bytes]:
        """For byte-level files, the bytes of each id."""
        letters = byte_letters()
        back = {c: i for i, c in enumerate(letters)}
        out = [b""] * (max(self.model.get_vocab(with_added_tokens=True).values()) + 1)
        for token, i in self.model.get_vocab(with_added_tokens=True).items():
            out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        return out


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable Latin-1,
    else the next character from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]
