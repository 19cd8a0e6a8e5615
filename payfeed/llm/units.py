"""Whole-text encoding with the ``tokenizers`` library, one library call per distinct unit.

Both public tokenizers cut a text before they merge, and neither ever joins a visible
character with a space that follows it. A text may therefore be encoded in units that
begin at single spaces; a unit's ids are remembered, so the library sees each distinct
unit of a worker once. Texts for which a cut could change the result are handed to the
library whole. The result is always that of encoding the whole text.

Where spaces are kept in front of words, a unit is learned when it is looked up: a line break between
visible characters is a cut as well, and words with marks after them go straight to the library's model.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from payfeed.llm.caches import claim, register

# Units remembered by a worker before it starts anew; about 150 MB.
MAX_UNITS = 1_000_000

_WORD_AND_MARKS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")
# Any ASCII mark but the apostrophe, which may begin a contraction.
_WORD_AND_ANY_MARKS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")
_ENCODERS: dict[str, UnitEncoder] = {}
register("units", _ENCODERS.clear)


class _SpacePair(Exception):
    """A white space character stands before a space: the text can't be cut there."""


class _Units(dict):
    """Ids of units behind ``before`` (a space or nothing), learned as they are looked up; ``bare`` has those behind nothing.

    Holds no reference to itself, so that its memory is free as soon as the encoder goes.
    """

    def __init__(self, library, alphabet: dict[int, str], before: str, bare: _Units | None = None):
        self.library, self.model, self.alphabet, self.before, self.bare = library, library.model, alphabet, before, bare
        self.spelled, self.line_break = before.translate(alphabet), self.whole("\n")

    def __missing__(self, unit: str) -> bytes:
        if not unit or unit[-1].isspace():
            raise _SpacePair
        bare = self if self.bare is None else self.bare
        match = _WORD_AND_ANY_MARKS.fullmatch(unit)
        if match is None and "\n" in unit:
            lines = unit.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                # Not remembered: few such units come again, their parts do.
                return self[lines[0]] + b"".join([self.line_break + bare[x] for x in lines[1:]])
        if len(self) >= MAX_UNITS:
            self.clear()
        if match is None:
            data = self.whole(self.before + unit)
        elif match[2]:
            # Marks after a word are a pre-token of their own.
            data = self[match[1]] + bare[match[2]]
        else:
            # One word of Latin letters is one pre-token.
            form = self.spelled + (unit if unit.isascii() else unit.translate(self.alphabet))
            data = array("I", [t.id for t in self.model.tokenize(form)]).tobytes()
        self[unit] = data
        return data

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()


class UnitEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        # The library finds the strings of these anywhere in a text before it cuts it.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            self.cut = _cut_rule(json.load(file))
        # How byte-level models spell the space and the two bytes of Latin letters.
        spell = lambda c: "".join(p for p, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c))
        self.alphabet = {ord(c): spell(c) for c in [" ", *map(chr, range(0xC0, 0x100))]}
        self.first: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}
        if self.cut == "kept":
            self.first = _Units(self.library, self.alphabet, "")
            self.inner = _Units(self.library, self.alphabet, " ", self.first)

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self._library([text])[0]
        if self.cut == "dropped":
            return self._joined(self.inner, text.replace("\n", " ").split(" "), "")
        if self.cut is None:
            return self._library([text])[0]
        units = text.split(" ")
        last = units.pop()
        try:
            if not units:
                return self._end("", last)
            head = units[0]
            known = self.first[head] if head else b""
            del units[0]
            return known + b"".join(map(self.inner.__getitem__, units)) + self._end(" ", last)
        except _SpacePair:
            return self._library([text])[0]

    def _end(self, before: str, unit: str) -> bytes:
        """The last unit, after which no space comes: it may be empty or end in white space."""
        if not unit or unit[-1].isspace():
            return self._library([before + unit])[0]
        return (self.inner if before else self.first)[unit]

    def _joined(self, known: dict[str, bytes], units: list[str], before: str) -> bytes:
        try:
            return b"".join(map(known.__getitem__, units))
        except KeyError:
            missing = [u for u in set(units) if u not in known]
        if len(known) + len(missing) > MAX_UNITS:
            known.clear()
            missing = list(set(units))
        self._learn(known, missing, before)
        return b"".join(map(known.__getitem__, units))

    def _learn(self, known: dict[str, bytes], missing: list[str], before: str) -> None:
        """Plain words go to the library's model at once, whatever else through its whole chain."""
        rest = []
        for unit in missing:
            match = _WORD_AND_MARKS.fullmatch(unit)
            if match is None:
                rest.append(unit)
                continue
            word, marks = match.groups()
            data = known.get(word)
            if data is None:
                data = known[word] = self._word(word, before)
            if marks:
                known[unit] = data + self._marks(marks)
        known.update(zip(rest, self._library([before + u for u in rest])))

    def _word(self, word: str, before: str) -> bytes:
        """One word of Latin letters: it is one pre-token, and normalization can only lower it."""
        form = before + (word.lower() if self.cut == "dropped" else word)
        return array("I", [t.id for t in self.library.model.tokenize(form.translate(self.alphabet))]).tobytes()

    def _marks(self, marks: str) -> bytes:
        """Marks after a word are a pre-token of their own."""
        if marks not in self.first:
            self.first[marks] = self._library([marks])[0]
        return self.first[marks]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]


def _cut_rule(spec: dict) -> str | None:
    """Whether spaces are ``kept`` in front of words, ``dropped``, or of unknown effect (None)."""
    before, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normalizer:
        return "kept"
    parts = before.get("pretokenizers") or []
    if parts and parts[0].get("type") == "Split" and parts[0].get("invert") and parts[0].get("behavior") == "Removed":
        kinds = {n.get("type") for n in (normalizer or {}).get("normalizers", [])}
        visible_only = r"[^\s\p{L}\p{N}]+" in parts[0]["pattern"].get("Regex", "")
        if kinds <= {"NFC", "Replace", "Lowercase"} and visible_only and all(p.get("type") == "ByteLevel" for p in parts[1:]):
            return "dropped"
    return None


def encoder(path: str) -> UnitEncoder:
    """This worker's encoder for a tokenizer file."""
    claim("units")
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
