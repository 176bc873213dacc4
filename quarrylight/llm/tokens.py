"""Token ids of whole texts by a tokenizer whose pieces never span white space, with a bounded cache of words."""

from __future__ import annotations

import os
import unicodedata
from array import array

#: Words that a worker keeps in each of two generations; LONGEST: letters of a word that is kept.
CACHE = 300_000
LONGEST = 64
_LAST = ".,;:!?*$%&#-"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids as the tokenizer file gives them for the whole text without special tokens, from cached words.

    Its pre-tokenizer drops white space and never joins over it, so a text's ids are those of the parts between blanks,
    one after another. A part of letters (all below U+0130, where lower case is one letter for one) is one piece, which
    goes to the BPE model itself; punctuation behind it is a piece of its own; all else goes to the tokenizer.
    """

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        shown = [c for n in range(0x130) for c in chr(n)]
        self.shown = {ord(c): level.pre_tokenize_str(c)[0][0] for c in shown}
        self.cache: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _piece(self, base: str) -> bytes:
        if base.isalpha() and max(base) < "\u0130" and unicodedata.is_normalized("NFC", base):
            return array("I", [t.id for t in self.model.tokenize(base.lower().translate(self.shown))]).tobytes()
        return array("I", self.tokenizer.encode(base, add_special_tokens=False).ids).tobytes()

    def _known(self, w: str) -> bytes | None:
        got = self.cache.get(w)
        if got is None and (got := self.old.get(w)) is not None:
            self.cache[w] = got
        return got

    def _learn(self, w: str) -> bytes:
        if (got := self._known(w)) is not None:
            return got
        base = w.rstrip(_LAST)
        cut = len(base) < len(w) and base[-1:].isalpha()
        base, last = (base, w[len(base) :]) if cut else (w, "")
        got = self._known(base)
        if got is None:
            got = self._piece(base)
            if len(base) <= LONGEST:
                self.cache[base] = got
            return got + self._learn(last) if cut else got
        if cut:
            got += self._learn(last)
            self.cache[w] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        try:
            cache = self.cache
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(self.cache) > CACHE:
                self.old, self.cache = self.cache, {"": b""}
            cache, learn = self.cache, self._learn
            return b"".join([got if (got := cache.get(w)) is not None else learn(w) for w in words])


_MADE: dict[str | None, WordIds] = {}


def shared(path: str | None = None) -> WordIds:
    """One for each Python worker."""
    if path not in _MADE:
        _MADE[path] = WordIds(path)
    return _MADE[path]

