"""Token ids of whole texts from a public tokenizer, word by word."""

from __future__ import annotations

import re

import numpy as np

# Words remembered by a Python worker: two generations of so many, at some 150 bytes a word.
MEMO_WORDS = 200_000
# Letters that lower-casing and composition leave one letter, then marks that form one token's word.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PROBE = "Die Straße, où l'on va: 3.5% of ~Ünits?! don't <x> naïve"


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    For tokenizers that drop white space and split there before anything else: a text's ids are
    then those of its words in a row, and a word needs the tokenizer only when it is new. A word of
    plain letters and marks goes to the tokenizer's model as the two pre-tokens it would be split
    into; every other word takes the whole way.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.memo_words = memo_words
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = str.maketrans({c: "".join(x for x, _ in spell(c)) for c in letters})
        whole = np.array(self._encode(_PROBE), "<u4").tobytes()
        if self.of([_PROBE.encode()])[0] != whole:
            raise ValueError(f"{path} does not split texts into words at white space")

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _model(self, token: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(token)]

    def _learnt(self, word: bytes) -> bytes:
        """The ids of a word that is not among the young."""
        ids = self.old.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            plain = _PLAIN.fullmatch(text)
            if plain is None:
                found = self._encode(text)
                ids = np.array(found, "<u4").tobytes()
            else:
                letters, marks = plain.groups()
                low = letters.lower()
                if marks or low != letters:
                    key = low.encode()
                    ids = self.young.get(key) or self._learnt(key)
                    if marks:
                        key = marks.encode()
                        ids += self.young.get(key) or self._learnt(key)
                else:
                    ids = np.array(self._model(low.translate(self.spelling)), "<u4").tobytes()
        self.young[word] = ids
        return ids

    def of(self, texts: list[bytes]) -> list[bytes]:
        if len(self.young) > self.memo_words:
            self.old, self.young = self.young, {}
        out = []
        for text in texts:
            words = text.split()
            get = self.young.get
            ids = list(map(get, words))
            if None in ids:
                ids = [self.young.get(w) or self._learnt(w) if x is None else x for w, x in zip(words, ids)]
            out.append(b"".join(ids))
        return out


_BY_PATH: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process and file, so that later tasks know the words of earlier ones."""
    if path not in _BY_PATH:
        _BY_PATH[path] = WordIds(path)
    return _BY_PATH[path]
