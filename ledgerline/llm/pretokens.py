"""Byte-level BPE vocabularies and the pre-tokens their texts fall into.

A text is cut at single spaces first: a space that follows a non-space
character always starts a pre-token, so the piece ``" word"`` has the same
pre-tokens alone as inside its text.  That makes pieces, which repeat a lot,
the unit that a task remembers.  Texts in which a space stands inside a longer
run of white space (``AMBIGUOUS``) are cut by the full pattern instead.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import regex

# Fixed value: the pattern that byte-level BPE vocabularies split texts with.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
AMBIGUOUS = re.compile(r"\s \s|\s \Z")
#: Signs that, at the end of a piece of letters, are one pre-token of their own.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


def load_vocabulary(path: str) -> dict:
    """Merges, byte alphabet and added tokens of a byte-level BPE file.  Files
    whose steps this module does not reproduce are refused."""
    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"]
            or pre["add_prefix_space"] or not pre.get("use_regex", True)
            or model.get("ignore_merges") or model.get("dropout")):
        raise ValueError("not a plain byte-level BPE vocabulary")
    added = spec["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens with stripping rules are not supported")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges,
            "added": {t["content"]: t["id"] for t in added}}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next free character from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def segments(text: str, added) -> list[tuple[str, str | None]]:
    """(plain segment, added token that follows it or None)."""
    if not any(a in text for a in added):
        return [(text, None)]
    out, at = [], 0
    for m in re.finditer("|".join(map(re.escape, sorted(added, key=len, reverse=True))), text):
        out.append((text[at:m.start()], m[0]))
        at = m.end()
    return [*out, (text[at:], None)]


class Remembered:
    """``key -> value`` of the keys used lately.  Two generations of at most
    ``limit`` keys each; when the young one is full it becomes the old one, so
    frequent keys stay and a worker's memory does not grow with the corpus."""

    def __init__(self, make: Callable, limit: int, longest: int = 200):
        self.make, self.limit, self.longest = make, limit, longest
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, key: str):
        """The value of a key that is not in ``young``."""
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self.young) >= self.limit:
                self.old = dict(self.young)
                self.young.clear()
            self.young[key] = value
        return value


class Pieces:
    """Measures texts piece by piece: ``measure(pre_token)`` for a pre-token,
    ``combine(values)`` for a piece of several."""

    def __init__(self, measure: Callable, combine: Callable, limit: int = 300_000):
        self.pattern = regex.compile(PATTERN)
        self.tokens = Remembered(measure, limit)
        self.pieces = Remembered(self._piece, limit)
        self.measure, self.combine = measure, combine

    def _values(self, text: str) -> list:
        known, token = self.tokens.young.get, self.tokens
        return [token(t) if (v := known(t)) is None else v for t in self.pattern.findall(text)]

    def _piece(self, piece: str):
        if piece[0] == " ":
            if piece[1:].isalpha():  # letters only, the usual case
                return self.measure(piece)
            body = piece.rstrip(SIGNS)
            if body[1:].isalpha():
                return self.combine([self.measure(body), self.tokens(piece[len(body):])])
        return self.combine(self._values(piece))

    def plain(self, text: str) -> list:
        """Values whose combination is that of ``text`` without added tokens."""
        if AMBIGUOUS.search(text):
            return self._values(text)
        known, piece = self.pieces.young.get, self.pieces
        first, *rest = text.split(" ")
        out = [piece(first)] if first else []
        out += [piece(p) if (v := known(p)) is None else v for p in map(" ".__add__, rest)]
        return out
