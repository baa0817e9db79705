"""Exact token counts of every prefix of every text, by prefix dynamic programming.

The tokenizer is a byte-pair model of the ``sentencepiece`` library: of all neighbours whose
concatenation is a piece the best scored are joined first, the leftmost at a tie. A sequence
of pieces is the tokenization of its text exactly when each two neighbours are the
tokenization of their own concatenation. So the tokens of a prefix are those of a shorter
prefix and one last piece, and only one last piece fits:

    count[i] = count[i - len(piece)] + 1

for the piece that ends at i and fits behind the last piece of the prefix before it. One pass
gives the count of all prefixes in time linear in the text, where encoding each prefix anew is
quadratic. Which pieces fit behind each other is remembered per worker.

The pieces that end at a place come from an automaton over the vocabulary, the longest first.
Texts are cut before spaces where no piece holds a space behind another sign, as no merge can
cross such a cut; what lies between recurs, and its counts are kept in a cache bounded in
entries and their length. ``steps`` holds, for every code point, by how much it changes the count
(a sign may lower it: it can complete a longer piece). From that table follow

* the count of any prefix (``tokens_before``),
* the longest prefix within a budget (``longest_within``, ``truncated``),

without encoding anything again.

A sign without a piece counts as its UTF-8 bytes (byte fallback). Strings that look like
control pieces are ordinary text. NULL and empty texts have no tokens. Repeated rows, and rows
without a doc_id, are counted each for itself. Extra columns are ignored. One pass over the
documents without an exchange: a lost task is run again.
"""

import re
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.llm.common import id_and_text

COUNTED = "doc_id long, n_bytes long, n_chars long, n_tokens long, steps binary"
SPACE = "▁"  # the model's sign for a space
ROWS_OUT = 512

_COUNTERS: dict[str, "PrefixCounter"] = {}


class PrefixCounter:
    """Token counts of prefixes for one model file."""

    def __init__(self, path: str, most_chunks: int = 400_000, most_pairs: int = 600_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in ids) or not any(model.is_byte(i) for i in range(model.vocab_size())):
            raise ValueError("the model must have byte fallback and no unused pieces")
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        self.most_chunks, self.most_pairs = most_chunks, most_pairs
        self.starts = {piece[:n] for piece in self.scores for n in range(1, len(piece) + 1)}
        # Pieces, signs that only occur inside pieces, and "" for any other sign.
        self.names = [*self.scores, *sorted({sign for piece in self.scores for sign in piece} - self.scores.keys()), ""]
        self.numbers = {name: number for number, name in enumerate(self.names)}
        spaced = not any(f"{sign}{SPACE}" in piece for piece in self.scores for sign in piece if sign != SPACE)
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if spaced else "(?s).+")
        self.prefix = SPACE if model.encode("a", out_type=str)[0][0] == SPACE else ""
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}
        self.edges: dict[str, tuple | None] = {}
        self.forget_states()

    def joined(self, text: str) -> list[tuple]:
        """The pieces of a short text by joining neighbours, as trees (piece, left, right)."""
        parts, scores = [(sign, None, None) for sign in text], self.scores
        while len(parts) > 1:
            best, at = max((scores.get(parts[i][0] + parts[i + 1][0], -np.inf), -i) for i in range(len(parts) - 1))
            if best == -np.inf:
                break
            left, right = parts[-at], parts[1 - at]
            parts[-at : 2 - at] = [(left[0] + right[0], left, right)]
        return parts

    def edges_of(self, piece: str) -> tuple | None:
        """(left, right, ordered): the parts at either edge of a piece while it is joined, each with the
        score it is made with and the one it is used with. ``ordered`` if scores only fall on the way.
        None if joining does not end in the piece."""
        if piece not in self.edges:
            tree, *more = self.joined(piece)
            self.edges[piece] = None
            if not more:
                sides, ordered = [], True
                for side in (1, 2):
                    node, used, found = tree, -np.inf, []
                    while node:
                        made = self.scores[node[0]] if node[1] else np.inf
                        ordered &= made > used
                        found.append((node[0], made, used))
                        node, used = node[side], made
                    sides.append(found)
                self.edges[piece] = (*sides, ordered)
        return self.edges[piece]

    def follows(self, last: str, piece: str) -> bool:
        """Whether ``last`` and ``piece`` are the tokenization of their concatenation ("": the beginning or no piece).

        They are unless two parts at the seam meet and are joined before either is used within its
        own piece. Parts meet when the later of them is made; at equal scores the left goes first.
        """
        if not piece:
            return True
        mine, other = self.edges_of(piece), self.edges_of(last) if last else None
        if mine is None or not last:
            return mine is not None
        if other is None:
            return False
        if not (mine[2] and other[2]):
            return [part[0] for part in self.joined(last + piece)] == [last, piece]
        for left, left_made, left_used in other[1]:
            for right, right_made, right_used in mine[0]:
                score = self.scores.get(left + right)
                if score is not None and min(score, right_made) > left_used and min(score, left_made) >= right_used:
                    return False
        return True

    def forget_states(self) -> None:
        # A state is the longest end of the text that begins a piece, with what follows each sign.
        self.states: dict[str, tuple[str, dict]] = {"": ("", {})}
        self.n_moves = 0

    def move(self, state: tuple[str, dict], sign: str) -> tuple:
        """The state after a sign, and the pieces that end there (number, length, tokens), the longest first."""
        self.n_moves += 1
        text = state[0] + sign
        while text and text not in self.starts:
            text = text[1:]
        ends = [(self.numbers[text[at:]], len(text) - at, 1) for at in range(len(text)) if text[at:] in self.scores]
        if sign not in self.scores:  # as bytes
            ends.append((self.numbers.get(sign, len(self.names) - 1), 1, len(sign.encode())))
        state[1][sign] = made = (self.states.setdefault(text, (text, {})), ends)
        return made

    def steps_of(self, chunk: str) -> bytes:
        """Changes of the count in a chunk, 16 bits each."""
        steps = self.older.get(chunk)
        if steps is None:
            if self.n_moves > self.most_pairs:
                self.forget_states()
            state, fits, names, size = self.states[""], self.fits, self.names, len(self.names)
            last, counts = [size - 1], [0]
            for sign in chunk:
                state, ends = state[1].get(sign) or self.move(state, sign)
                for number, length, tokens in ends:
                    pair = last[-length] * size + number
                    fit = fits.get(pair)
                    if fit is None:
                        if len(fits) > self.most_pairs:
                            fits.clear()
                        fit = fits[pair] = self.follows(names[last[-length]], names[number])
                    if fit:
                        break
                last.append(number)
                counts.append(counts[-length] + tokens)
            steps = array("h", map(sub, counts[1:], counts)).tobytes()
        if len(chunk) <= 64:
            if len(self.known) >= self.most_chunks:
                self.known, self.older = {}, self.known
            self.known[chunk] = steps
        return steps

    def count(self, text: str | None) -> tuple[bytes, int]:
        """Steps of a text, one byte each if they fit and two if not, and its token count."""
        if not text:
            return b"", 0
        steps_of = self.steps_of
        chunks = self.chunks.findall(self.prefix + text.replace(" ", SPACE))
        found = list(map(self.known.get, chunks))
        for at in [i for i, steps in enumerate(found) if steps is None] if None in found else ():
            found[at] = steps_of(chunks[at])
        steps = np.frombuffer(b"".join(found), np.int16)
        if self.prefix:  # an empty text has no tokens: the first sign brings the prefix along
            steps = np.concatenate([steps[:1] + steps[1:2], steps[2:]])
        narrow = steps.astype(np.int8)
        return (narrow if (narrow == steps).all() else steps.astype("<i2")).tobytes(), int(steps.sum(dtype=np.int64))


def counter_at(path: str) -> PrefixCounter:
    """One counter per Python worker, reused by its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(docs: DataFrame, model: str) -> DataFrame:
    """One row per document: its size, its token count and the steps of the count.

    ``model`` is the path of a model file that every executor has.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("steps", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_at(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                texts = part.column(1).to_pylist()
                made = [counter.count(text) for text in texts]
                sizes = [[len(text.encode()) if text else 0 for text in texts], [len(text or "") for text in texts]]
                columns = [part.column(0), *map(pa.array, sizes, [pa.int64()] * 2), pa.array([n for _, n in made], pa.int64()), pa.array([s for s, _ in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return id_and_text(docs).mapInArrow(count, COUNTED)


def changes(steps: bytes, n_chars: int) -> np.ndarray:
    return np.frombuffer(steps, "<i2" if len(steps) > n_chars else np.int8)


def tokens_before(steps: Column, n_chars: Column, chars: Column) -> Column:
    """The token count of the first ``chars`` code points (all, where there are fewer; NULL for NULL)."""

    @F.pandas_udf("long")
    def count(steps: pd.Series, n_chars: pd.Series, chars: pd.Series) -> pd.Series:
        rows = zip(steps, n_chars, chars, strict=True)
        return pd.Series([None if pd.isna(n) else int(changes(s, size)[: max(0, int(n))].sum(dtype=np.int64)) for s, size, n in rows], dtype="Int64")

    return count(steps, n_chars, chars.cast("long"))


def longest_within(steps: Column, n_chars: Column, budget: Column) -> Column:
    """The length in code points of the longest prefix with at most ``budget`` tokens.

    Counts may fall with a further sign, so this looks at all prefixes. A budget below zero
    counts as zero; the empty prefix fits any budget. NULL for NULL.
    """

    @F.pandas_udf("long")
    def longest(steps: pd.Series, n_chars: pd.Series, budget: pd.Series) -> pd.Series:
        found = []
        for s, size, most in zip(steps, n_chars, budget, strict=True):
            if pd.isna(most):
                found.append(None)
                continue
            fit = np.flatnonzero(np.cumsum(changes(s, size), dtype=np.int64) <= int(most))
            found.append(int(fit[-1]) + 1 if len(fit) and most >= 0 else 0)
        return pd.Series(found, dtype="Int64")

    return longest(steps, n_chars, budget.cast("long"))


def truncated(docs: DataFrame, model: str, budget: int) -> DataFrame:
    """(doc_id, n_tokens, kept_chars, kept_tokens): how much of each text fits ``budget`` tokens."""
    kept = prefix_counts(docs, model).withColumn("kept_chars", longest_within(F.col("steps"), F.col("n_chars"), F.lit(budget)))
    tokens = tokens_before(F.col("steps"), F.col("n_chars"), F.col("kept_chars"))
    return kept.select("doc_id", "n_tokens", "kept_chars", tokens.alias("kept_tokens"))


def digests(counted: DataFrame, limit: int) -> DataFrame:
    """Sizes, counts, and whether a text has more than ``limit`` tokens."""
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
