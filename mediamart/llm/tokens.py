"""Token ids of whole texts as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array

#: Fixed value: the pattern by which the vocabulary's own file parts lower-case text into units.
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for the characters that PLAIN allows.
_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
_PLAIN = re.compile(r"(?!.*<\|)[!-~À-ÿ]+")


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """A tokenizer file with remembered words.

    Where the file's rules part text at white space and never look across it, a text's ids are its
    words' ids in a row, so each distinct word is encoded once.  Words with characters beyond Latin
    letters and ASCII, and all texts under other rules, go to the tokenizer as they are.  When
    ``most`` words are remembered, only those that come again are kept.
    """

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most = self.tokenizer.model, most
        self.words: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}  # what was remembered before the memory was last full
        self.units: dict[str, bytes] = {}
        self.characters = _byte_characters()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        folds = [s["type"] for s in (rules.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = (
            steps[0].get("pattern") == {"Regex": UNIT_PATTERN}
            and folds == ["NFC", "Replace", "Lowercase"]
            and rules["model"].get("type") == "BPE"
            and rules.get("post_processor") is None
        )

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _unit(self, unit: str) -> bytes:
        spelled = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.characters)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return array("I", ids).tobytes() if LITTLE else self._packed(ids)

    def _learn(self, missing: set[str]) -> None:
        """Add the ids of ``missing`` words; a unit is what the model spells by itself."""
        words, units = self.words, self.units
        if len(units) > self.most:
            units.clear()
        for word in missing:
            low = word.lower()
            if not _PLAIN.fullmatch(word):
                words[word] = self._whole(word)
            elif low.isalpha():  # one unit, remembered as the word it mostly is
                found = words.get(low)
                words[word] = self._unit(low) if found is None else found
            else:
                parts = []
                for unit in _UNITS.findall(low):
                    found = units.get(unit)
                    if found is None:
                        found = words.get(unit)
                        units[unit] = found = self._unit(unit) if found is None else found
                    parts.append(found)
                words[word] = b"".join(parts)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  The distinct words of about a million characters are looked up at a time."""
        if not self.by_word:
            return [self._whole(text) for text in texts]
        out: list[bytes] = []
        start, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= 1 << 20 or k == len(texts) - 1:
                out += self._encoded(texts[start : k + 1])
                start, size = k + 1, 0
        return out

    def _encoded(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        known = self.words
        there = set().union(*split)
        missing = there - known.keys()
        if len(known) + len(missing) > self.most:
            self.before, self.words = known, {"": b""}
            known = self.words
            missing = there - known.keys()
        again = missing & self.before.keys()
        for word in again:
            known[word] = self.before[word]
        missing -= again
        self._learn(missing)
        find = known.__getitem__
        out = [b"".join(map(find, words)) for words in split]
        for word in missing:  # what is long, or more than fits, is not remembered
            if len(word) > 64 or len(known) > self.most:
                del known[word]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
