"""Token ids of whole texts, word by word with a cache.

The tokenizer drops white space and never merges across it, so a text's ids are those of its
white-space-separated words in turn. A word of plain characters is split by the tokenizer's
pattern and given to its merge model directly; any other goes through the whole tokenizer.
"""

from array import array
from operator import attrgetter

import numpy as np
import regex

CACHED = 200_000
# The pattern and the printable bytes of the tokenizer file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))
# From here on characters may combine, fold by context or compose.
PLAIN_END = "̀"
# A mark is a piece of its own after letters.
MARKS = frozenset(".,;:!?)")
ID = attrgetter("id")
SPLITTERS = regex.compile("[\x1c-\x1f]")


def byte_names() -> dict[int, str]:
    """Byte -> the character that stands for it; other bytes are counted up from 256."""
    shown = {b for part in PRINTABLE for b in part}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Recent(dict):
    """Remembers what was used lately: when full, what there is becomes the older half, from
    which entries used again come back."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def turn(self) -> None:
        if len(self) > self.size:
            self.older = dict(self)
            self.clear()


def encoder(path: str, cached: int = CACHED) -> "Encoder":
    """The encoder of this Python process, which a worker keeps from task to task."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_encoders", {})
    if (path, cached) not in kept:
        kept[path, cached] = Encoder(path, cached)
    return kept[path, cached]


def forget() -> None:
    """Drops the encoders of this Python process, whose caches take over 100 MB each: for tasks
    that come after the last text was encoded."""
    import tokenizers

    vars(tokenizers).pop("_encoders", None)


class Encoder:
    def __init__(self, path: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.names, self.pieces = self.tokenizer.model, byte_names(), regex.compile(PIECES)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached, self.of_piece, self.of_word = cached, {}, Recent(cached)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        found = self.of_piece.get(piece)
        if found is None:
            plain = piece.isascii() and piece.isprintable()  # these bytes stand for themselves
            named = piece if plain else piece.encode().decode("latin-1").translate(self.names)
            found = self.of_piece[piece] = array("I", map(ID, self.model.tokenize(named))).tobytes()
        return found

    def word(self, word: str) -> bytes:
        if (word.isascii() or max(word) < PLAIN_END) and not any(s in word for s in self.special):
            return b"".join(map(self.piece, self.pieces.findall(word.lower())))
        return self.whole(word)

    def learn(self, words: list[str]) -> None:
        """Remember the ids of new words. Where all are plain they are lowered together; one of
        letters only is a single piece, and one of letters and a mark is two."""
        together = "\n".join(words)
        if any(s in together for s in self.special) or not (together.isascii() or max(together) < PLAIN_END):
            self.of_word.update((w, self.word(w)) for w in words)
            return
        piece, of_word = self.piece, self.of_word
        for word, lowered in zip(words, together.lower().split("\n")):
            if lowered.isalpha():
                of_word[word] = piece(lowered)
            elif lowered[-1] in MARKS and (head := lowered[:-1]).isalpha():
                of_word[word] = piece(head) + piece(lowered[-1])
            else:
                of_word[word] = b"".join(map(piece, self.pieces.findall(lowered)))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the text, without special tokens added."""
        if not text:
            return np.empty(0, "<u4")
        if SPLITTERS.search(text):  # str.split takes these for white space
            return np.frombuffer(self.whole(text), "<u4")
        if len(self.of_piece) > self.cached:
            self.of_piece.clear()
        self.of_word.turn()
        words = text.split()
        found = list(map(self.of_word.get, words))
        try:
            return np.frombuffer(b"".join(found), "<u4")
        except TypeError:  # some are not known
            missing = [i for i, ids in enumerate(found) if ids is None]
        older, new = self.of_word.older, []
        for word in {words[i] for i in missing}:
            if word in older:
                self.of_word[word] = older[word]
            else:
                new.append(word)
        if new:
            self.learn(new)
        for i in missing:
            found[i] = self.of_word[words[i]]
        return np.frombuffer(b"".join(found), "<u4")
