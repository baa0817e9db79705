"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

The word tokenizer in use lower-cases, drops white space, cuts texts into runs of letters,
single digits and runs of other signs, and codes each of these words for itself, its last
token being one that ends a word. A text's
ids are therefore those of its white-space separated pieces, and of the words in these.
Words recur far more often than texts: pieces and words are kept in caches bounded in entries
and in the length of an entry, and the tokenizer sees each new word once. A full cache makes
room in two steps: what is used again stays. Pieces of any length are coded; long ones are not
kept. A test holds the result against encoding whole texts.
"""

import os
import re

import numpy as np

LONGEST_KEPT = 64  # bytes or letters
_TOKENIZERS: dict[str, "PieceTokenizer"] = {}
# Pieces that may be cut into words here: printable ASCII and the letters of Latin-1.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Signs that are a word of their own behind a letter.
MARKS = {sign.encode(): sign for sign in ",.;:!?"}
# The tokenizer's own word pattern, for lower-cased plain pieces.
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class PieceTokenizer:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, most_pieces: int = 400_000, most_words: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most_pieces, self.most_words = most_pieces, most_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.pieces: dict[bytes, bytes] = {}
        self.older_pieces: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """One byte string per text; NULL and empty texts have no ids."""
        # Special tokens are told apart by case; everything else may be lower-cased at once.
        split = [(text if b"<|" in text else text.lower()).split() if text else [] for text in texts]
        if len(self.pieces) > self.most_pieces:
            self.pieces, self.older_pieces = {}, self.pieces
        if len(self.words) > self.most_words:
            self.words, self.older_words = {}, self.words
        known = self.pieces.get
        found = [list(map(known, pieces)) for pieces in split]
        gaps = [[i for i, ids in enumerate(made) if ids is None] if None in made else () for made in found]
        new = self._learnt({pieces[i] for pieces, places in zip(split, gaps, strict=True) for i in places})
        for pieces, made, places in zip(split, found, gaps, strict=True):
            for i in places:
                made[i] = new[pieces[i]]
        return [b"".join(made) for made in found]

    def _learnt(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces that are not in the cache."""
        learnt, single, marked, cut, whole = {}, {}, {}, {}, []
        older = self.older_pieces.get
        for piece in pieces:
            if ids := older(piece):
                learnt[piece] = ids
            elif piece.isalpha():  # ASCII letters: one word
                single[piece] = piece.lower().decode()
            elif piece[:-1].isalpha() and piece[-1:] in MARKS:
                marked[piece] = piece[:-1].lower().decode()
            else:
                text = piece.decode()
                if PLAIN.fullmatch(text) and "<|" not in text:  # not a special token
                    cut[piece] = WORDS.findall(text.lower())
                else:
                    whole.append(piece)
        words = self._words({*single.values(), *marked.values(), *MARKS.values(), *(word for found in cut.values() for word in found)})
        for piece, word in single.items():
            learnt[piece] = words[word]
        for piece, word in marked.items():
            learnt[piece] = words[word] + words[MARKS[piece[-1:]]]
        for piece, found in cut.items():
            learnt[piece] = b"".join([words[word] for word in found])
        for at in range(0, len(whole), 5_000):
            part = whole[at : at + 5_000]
            made = self.tokenizer.encode_batch_fast([piece.decode() for piece in part], add_special_tokens=False)
            for piece, encoding in zip(part, made, strict=True):
                learnt[piece] = np.array(encoding.ids, "<u4").tobytes()
        self.pieces.update({piece: ids for piece, ids in learnt.items() if len(piece) <= LONGEST_KEPT})
        return learnt

    def _words(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of words."""
        found = {word: ids for word in wanted if (ids := self.words.get(word) or self.older_words.get(word))}
        new = [word for word in wanted if word not in found]
        for at in range(0, len(new), 500):
            part = new[at : at + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            joined, begin = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                found[word] = joined[begin:end]
                begin = end
        self.words.update({word: ids for word, ids in found.items() if len(word) <= LONGEST_KEPT})
        return found


def tokenizer_at(path: str) -> PieceTokenizer:
    """One tokenizer per Python worker, reused by its tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]
