"""Ids of whole texts by the ``tokenizers`` library, asked once for each word it has not
lately seen.

A text is cut at its blanks, where neither kind of tokenizer ever joins anything, so the
ids of the text are those of its words in turn; a text for which that is not sure, one
with runs of white space, goes to the library whole.

A text that holds an added token of the file, such as a literal ``<|endoftext|>``, goes to the
library whole, which gives the token its special id.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np

from tillwright.llm.byte_bpe import in_chunks

CACHED_WORDS = 800_000
ASK_WHOLE = ""
LAST_LATIN = chr(0xFF)


def _byte_characters() -> dict[int, str]:
    """The printable character that byte-level files write for each byte: itself if it is
    printable in Latin-1 and no blank, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(0x100) if x not in shown]
    return {x: chr(x) for x in shown} | {x: chr(0x100 + i) for i, x in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


class WordIds:
    """``leading_blank`` says that a blank belongs to the word after it (byte-level files);
    otherwise white space has no ids of its own."""

    def __init__(self, path: str, leading_blank: bool, dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Each added token in lower case, after its longest run without letters, which is sought
        # first; files whose normalizer lowers letters take the token in any case.
        added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [(max(re.split("[^\\W\\d_]", token), key=len), token) for token in added]
        self.blank = " " if leading_blank else ""
        self.dtype = np.dtype(dtype)
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.model = self.tokenizer.model
        self.known: dict[str, bytes | str] = {}
        self.tails: dict[str, bytes] = {}

    def _holds_added(self, text: str) -> bool:
        return any(mark in text and token in text.lower() for mark, token in self.added)

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in made]

    def _letters(self, word: str) -> bytes:
        """Ids of a word of Latin letters, which the library never splits before its model."""
        if not self.blank:
            word = word.lower()
        elif word[0] == "\n":
            word = word[1:]
        else:
            word = " " + word
        if word.isascii():
            raw = word.replace(" ", BYTE_CHARACTERS[0x20])
        else:
            raw = word.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        return array(self.code, [token.id for token in self.model.tokenize(raw)]).tobytes()

    def _learn(self, words: set[str]) -> None:
        known, others = self.known, []
        for word in words:
            # A word at the edge of a longer run of white space stands for nothing alone.
            shown = word[1:] if self.blank and word[:1] == "\n" else word
            if self.blank and (not shown or shown[0].isspace() or shown[-1].isspace()):
                known[word] = ASK_WHOLE
                continue
            letters = word.rstrip(".,")
            if not (only := letters[len(word) - len(shown) :]).isalpha() or max(only) > LAST_LATIN:
                others.append(word)
                continue
            ids = known.get(letters)
            if ids is None:
                ids = self._letters(letters)
                if self.blank and word[0] == "\n":
                    ids = self._tail("\n") + ids
                known[letters] = ids
            if len(letters) < len(word):
                known[word] = ids + self._tail(word[len(letters) :])
        whole = [word if word[:1] == "\n" else self.blank + word for word in others]
        known.update(zip(others, self._whole(whole), strict=True))

    def _tail(self, marks: str) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = self.tails[marks] = self._whole([marks])[0]
        return ids

    def _words(self, text: str) -> list[str]:
        if self.blank:
            # The first word has no blank before it and is asked for by itself; a line
            # feed between two words stands for the blank.
            return text.replace("\n", " \n").split(" ")[1:]
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def of(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as bytes of ``dtype``."""
        for part in in_chunks(texts):
            chunk = texts[part]
            words = list(map(self._words, chunk))
            flat = list(chain.from_iterable(words))
            found = list(map(self.known.get, flat))
            unseen = {word for word, ids in zip(flat, found, strict=True) if ids is None}
            if unseen:
                if len(self.known) + len(unseen) > CACHED_WORDS:
                    self.known.clear()
                    unseen = set(flat)
                self._learn(unseen)
                known = self.known
                found = [known[word] if ids is None else ids for word, ids in zip(flat, found, strict=True)]
            heads = [text.partition(" ")[0].partition("\n")[0] for text in chunk] if self.blank else []
            first = self._whole(heads)
            begin = 0
            for i, (text, own) in enumerate(zip(chunk, words, strict=True)):
                ids = found[begin : begin + len(own)]
                begin += len(own)
                if self._holds_added(text):
                    yield self._whole([text])[0]
                elif not self.blank:
                    yield b"".join(ids)
                elif ASK_WHOLE in ids or not heads[i] or heads[i][0].isspace() or heads[i][-1].isspace():
                    yield self._whole([text])[0]
                else:
                    yield first[i] + b"".join(ids)


@cache
def word_ids(path: str, leading_blank: bool, dtype: str) -> WordIds:
    """One cache for each Python worker and tokenizer."""
    return WordIds(path, leading_blank, dtype)
