"""Token ids of whole texts, word by word through a bounded cache.

White space never lies inside a token of a tokenizer that pre-splits on it and
adds no prefix, so a text's ids are the ids of its words in a row.  Words are
encoded once per worker and kept as little-endian bytes; joining those gives a
text's ids without a Python-level step per token.  ``WordEncoder`` checks that
property on the tokenizer's own parts and else encodes whole texts.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

CACHE_BYTES = 64 << 20        # of a cache, about; it may hold twice that (two generations)
_ENTRY_BYTES = 200            # of a dictionary entry with two short byte strings, besides their content
ENCODE_BYTES = 2 << 20        # of text encoded at a time
#: a run of small ASCII letters and of bytes of other characters, and the ASCII punctuation behind it
_STEM_AND_TAIL = re.compile(rb"([a-z\x80-\xff]+)([!-/:-@\[-`{-~]*)")
_SPECIAL = b"<|"                                     # opens the tokenizers' special strings


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """Byte-level form: printable Latin-1 characters stand for their own byte, the others follow from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


_BYTE_LETTER = dict(enumerate(_byte_letters()))


class _Recent(dict):
    """A cache filled by ``make``, of about ``limit`` to twice as many bytes; what was not asked for lately goes.  A
    word beyond a thousandth of the limit is not kept."""

    def __init__(self, limit: int, make):
        super().__init__()
        self.limit, self.make, self.old, self.held = limit, make, {}, 0

    def __missing__(self, key: bytes) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = len(key) + len(value)
        if 1000 * size <= self.limit:
            self[key] = value
            self.held += size + _ENTRY_BYTES
            if self.held > self.limit:
                self.old = dict(self)
                self.clear()
                self.held = 0
        return value


class WordEncoder:
    """Ids of a text as bytes of unsigned 32-bit little-endian integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.by_word, self.letters_apart = _splits_on_space(path)
        self.words = _Recent(CACHE_BYTES, self._word if self.letters_apart else self._one)
        self.stems = _Recent(CACHE_BYTES, self._stem)
        self.tails = _Recent(CACHE_BYTES >> 4, self._one)

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _one(self, text: bytes) -> bytes:
        return self._whole([text])[0]

    def _word(self, word: bytes) -> bytes:
        """Letters and the punctuation behind them are words of their own to the tokenizer, and so are cached apart."""
        m = _STEM_AND_TAIL.fullmatch(word)
        if m:
            stem, tail = m.groups()
            if stem.isascii() or stem.decode("utf-8", "replace").isalpha():
                return self.stems[stem] + self.tails[tail] if tail else self.stems[stem]
        return self._one(word)

    def _stem(self, stem: bytes) -> bytes:
        """A run of letters is one word of the tokenizer.  Small ASCII letters are their own byte-level form; other
        Latin letters are brought to it; both go to the tokenizer's model directly."""
        text = stem.decode()
        if not stem.isascii():
            low = text.lower()
            if max(text) > "\u024f" or not low.isalpha() or not unicodedata.is_normalized("NFC", text):
                return self._one(stem)
            text = low.encode().decode("latin-1").translate(_BYTE_LETTER)
        return array("I", [t.id for t in self.merge(text)]).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return self._whole(texts)
        collects = gc.isenabled()
        gc.disable()            # no cycles arise here, and scans of long lists would cost as much as the work
        try:
            get, out = self.words.__getitem__, []
            for t in texts:
                # the tokenizer ignores case, but for special strings
                out.append(b"".join(map(get, (t.lower() if self.letters_apart and _SPECIAL not in t else t).split())))
            return out
        finally:
            if collects:
                gc.enable()


@lru_cache(maxsize=4)
def _splits_on_space(path: str) -> tuple[bool, bool]:
    """Whether words between spaces are encoded apart, and, in them, runs of letters and of punctuation."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    first = parts[0] if parts else {}
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    pattern = (first.get("pattern") or {}).get("Regex", "")
    plain = all(p.get("type") in ("Split", "ByteLevel") and not p.get("add_prefix_space") for p in parts)
    known = {"NFC", "Lowercase", "Replace", "Sequence"}
    norm = spec.get("normalizer") or {}
    norms = {n.get("type") for n in norm.get("normalizers", [norm]) if n}
    strips = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(c.isspace() for c in t["content"])
                 for t in spec.get("added_tokens", []))
    by_word = bool(drops and plain and norms <= known and not strips and r"[^\s" in pattern)
    letters = any(p.get("type") == "ByteLevel" for p in parts) and r"[\p{L}]+" in pattern and r"[^\s\p{L}\p{N}]+" in pattern and "Lowercase" in norms
    plain_model = spec["model"].get("type") == "BPE" and array("I").itemsize == 4 and sys.byteorder == "little"
    return by_word, by_word and letters and plain_model


def encoder(path: str) -> WordEncoder:
    """An encoder for one task.  Loading takes a fifth of a second and full caches gain nothing over empty ones after
    a few megabytes, while workers outlive their tasks, take turns, and would each keep what they loaded."""
    return WordEncoder(path)
