"""Ids of a lower-casing word BPE, by words kept from earlier texts."""

from __future__ import annotations

from itertools import chain

import numpy as np

from finloom.llm.words import kept

#: Entries of the table of known words in one Python worker; it starts anew when full.
CACHE_WORDS = 1_200_000

#: What may follow a word of letters; the tokenizer splits there too.
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class WordTokenizer:
    """Encodes text word by word.

    The tokenizer drops white space and never joins across it, and neither its Unicode
    composition nor its lower-casing looks past it, so a text's ids are those of its words in
    order. Each distinct word is encoded once, many in one call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        """The tokenizer and the words known so far, which the Python worker keeps."""
        return kept((cls, path), lambda: cls(path))

    def encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers; none for a null."""
        split = [t.split() if t else [] for t in texts]
        here: dict[bytes, bytes] = dict.fromkeys(chain.from_iterable(split), b"")  # of these texts only, so looked up fast
        words = list(here)
        found = list(map(self.known.get, words))
        here.update(zip(words, found, strict=True))
        if None in found:
            missing = [w for w, ids in zip(words, found, strict=True) if ids is None]
            if len(self.known) + len(missing) > CACHE_WORDS:
                self.known, self.cores = {}, {}
            learned = self._learn(missing)
            here.update(learned)
            self.known.update(learned)
        return [b"".join(map(here.__getitem__, ws)) for ws in split]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not known. Letters, in lower case, and what follows them are encoded apart and kept."""
        lowered = b" ".join(words).lower().split(b" ")
        letters = [low.rstrip(_PUNCTUATION) for low in lowered]
        tails = [low[len(core) :] for low, core in zip(lowered, letters, strict=True)]
        for k, core in enumerate(letters):
            if not (core.isalpha() or core.decode().isalpha()) or b"<|" in tails[k]:
                letters[k], tails[k] = b"", words[k]
        self._single(set(tails).difference(self.cores))
        self._letters(sorted(set(letters).difference(self.cores, [b""])))
        cores = self.cores
        return {w: cores[core] + cores[tail] if core and tail else cores[core or tail] for w, core, tail in zip(words, letters, tails, strict=True)}

    def _single(self, words: set[bytes]) -> None:
        listed = sorted(words)
        for w, e in zip(listed, self.tokenizer.encode_batch_fast([w.decode() for w in listed], add_special_tokens=False), strict=True):
            self.cores[w] = np.array(e.ids, "<u4").tobytes()

    def _letters(self, words: list[bytes]) -> None:
        """Words of letters only: each is one word of the tokenizer, so many go in one text."""
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            e = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
            ids, owner = np.array(e.ids, "<u4").tobytes(), np.array(e.word_ids)
            if owner.size and owner[-1] + 1 != len(some):  # a letter that the normaliser takes apart
                self._single(set(some))
                continue
            cut = (4 * np.searchsorted(owner, np.arange(len(some) + 1))).tolist()
            self.cores.update(zip(some, map(ids.__getitem__, map(slice, cut, cut[1:])), strict=True))
