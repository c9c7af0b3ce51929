"""Token ids of whole texts, by a public tokenizer file, with a bounded memo of words.

White space always ends a token of these vocabularies, so a text's ids are the ids of its
blank-separated words one after the other. Invented and common words repeat, so each worker
keeps the ids of recent words; a word of letters with trailing punctuation goes to the
vocabulary's merge model at once, any other word through the whole tokenizer.
"""

from __future__ import annotations

import os
from array import array
from functools import cache

from stintlake.llm.common import on_release

#: Whose memo it is, for :func:`stintlake.llm.common.lean`.
OWNER = "token ids"
#: The id that ends each document.
END_ID = 2
VOCABULARY = "word_bpe_49k.json"

#: Marks that may follow the letters of a plain word and are then a token run of their own.
_MARKS = ".,!?;:#*%$&"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Word to little-endian unsigned 32-bit ids. Holds two generations of ``size`` words."""

    def __init__(self, path: str, size: int):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = size
        self.old: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = {
            c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)
        }

    def _letters(self, letters: str) -> bytes:
        ids = self.stems.get(letters)
        if ids is None:
            mapped = letters if letters.isascii() else letters.translate(self.level)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(self.stems) >= self.size:
                self.stems.clear()
            self.stems[letters] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        letters = word.rstrip(_MARKS)
        if letters.isalpha() and (letters.isascii() or max(letters) < "\u0100"):
            ids = self._letters(letters.lower())
            if len(letters) < len(word):
                ids += self["0" + word[len(letters):]][4:]
            return ids
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def forget(self) -> None:
        self.clear()
        self.old = {}
        self.stems.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


@cache
def words_of(path: str, size: int = 150_000) -> _Words:
    """One memo per worker process and vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    words = _Words(path, size)
    on_release(OWNER, words.forget)
    return words


def encode(words: _Words, text: str | None) -> bytes:
    """The ids of ``text`` (none for NULL) as little-endian unsigned 32-bit integers."""
    if not text:
        return b""
    for blank in "\n\t\r":
        if blank in text:
            text = text.replace(blank, " ")
    return b"".join(map(words.__getitem__, text.split(" ")))
