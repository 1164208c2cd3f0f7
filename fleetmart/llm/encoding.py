"""Token ids of texts by a public tokenizer, with a bounded memory of what was encoded before.

The tokenizer drops white space and lets no token cross it, so a text's ids are those of its parts between spaces and
line feeds, one after the other. Parts repeat; each worker keeps the recent ones.
"""

from __future__ import annotations

import json

import numpy as np
import regex

from fleetmart.llm.recent import Recent, kept

WORD_BPE = "word_bpe_49k.json"

# Printable ASCII and Latin-1: here NFC changes nothing and lower case needs no context.
_PLAIN = regex.compile(r"[!-~¡-ÿ]+")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        # The file's own split of lower-case text into words, and its stand-ins for bytes.
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
        self._words = regex.compile(steps[0]["pattern"]["Regex"])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self._stand_in = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self._word = Recent(self._encode_word, 100_000)
        self._part = Recent(self._encode_part)

    def _encode_word(self, word: str) -> bytes:
        # Printable ASCII stands for itself.
        text = word if word.isascii() else "".join([self._stand_in[b] for b in word.encode()])
        return np.array([t.id for t in self._model.tokenize(text)], dtype="<u4").tobytes()

    def _encode_part(self, part: str) -> bytes:
        if _PLAIN.fullmatch(part) and "<|" not in part:
            low = part.lower()
            if low.isalpha():
                return self._encode_word(low)
            return b"".join([self._word[w] for w in self._words.findall(low)])
        return np.array(self._tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers; no ids for a null or empty text."""
        if not text:
            return b""
        if "<|" not in text and len(text.encode("latin-1", "ignore")) == len(text):
            text = text.lower()  # in Latin-1 as good before the split as after it, and then fewer parts differ
        return b"".join(map(self._part.__getitem__, text.replace("\n", " ").split(" ")))


def encoder(path: str) -> Encoder:
    """The worker's encoder; it outlives a task."""
    return kept(("encoder", path), lambda: Encoder(path))


def public(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
