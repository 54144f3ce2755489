"""Token counts of a byte-level BPE vocabulary, by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens; distinct new ones are held as one flat array of symbols with their sequence numbers.
In every round each sequence's pair of lowest rank is merged at all its places at once, in all sequences together,
until no pair has a rank; what survives is counted. Counts of short pre-tokens are remembered within a worker, up to
a bound.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from clinicpulse.llm.frames import bounded_batches

# Fixed value: the pattern that cuts texts before the merges; white space is Unicode's property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_NONE = np.int32(2**31 - 1)
_REMEMBERED = 500_000
_SHORT = 64
_CHUNK = 50_000


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """``keys``: pairs of symbols as left * size + right, sorted, with their ranks and what they merge to."""

    size: int
    first: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    specials: tuple[str, ...]

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if model["type"] != "BPE" or spec["normalizer"] or any(before.get(k) != v for k, v in plain.items()):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        ids, size = model["vocab"], max(model["vocab"].values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.array([ids[sign] for sign in _byte_signs()], dtype=np.int64)
        specials = tuple(t["content"] for t in spec["added_tokens"])
        return Vocabulary(size, first, keys[order], order.astype(np.int32), merged[order], specials)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], _NONE), self.merged[at]

    def count_symbols(self, sequences: list[bytes]) -> np.ndarray:
        """How many symbols each byte sequence is merged into."""
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        counts = lengths.copy()
        symbols = self.first[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
        of = np.repeat(np.arange(len(sequences)), lengths)
        rank, into = self._ranked(symbols, of)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            # Sequences without a pair left are done.
            sizes = np.diff(np.r_[starts, len(symbols)])
            done = lowest == _NONE
            counts[of[starts[done]]] = sizes[done]
            per_symbol = np.repeat(lowest, sizes)
            chosen = (rank == per_symbol) & (rank != _NONE)
            # Of overlapping places of one pair every other one is merged, from the left.
            at = np.flatnonzero(chosen)
            fresh = np.r_[True, at[1:] != at[:-1] + 1] if len(at) else np.empty(0, dtype=bool)
            run_start = at[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(at) else at
            at = at[(at - run_start) % 2 == 0]
            symbols[at] = into[at]
            touched = np.zeros(len(symbols), dtype=bool)
            touched[at] = True
            stay = np.repeat(~done, sizes)
            stay[at + 1] = False
            symbols, of, rank, into, touched = symbols[stay], of[stay], rank[stay], into[stay], touched[stay]
            if not len(symbols):
                break
            redo = np.flatnonzero(touched | np.r_[touched[1:], False])
            right = np.minimum(redo + 1, len(symbols) - 1)
            inside = (right > redo) & (of[right] == of[redo])
            new_rank, new_into = self._look_up(symbols[redo], symbols[right])
            rank[redo], into[redo] = np.where(inside, new_rank, _NONE), new_into
        return counts

    def _ranked(self, symbols: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(symbols), _NONE, dtype=np.int32), np.zeros(len(symbols), dtype=np.int64)
        if len(symbols) > 1:
            found, result = self._look_up(symbols[:-1], symbols[1:])
            rank[:-1], into[:-1] = np.where(of[1:] == of[:-1], found, _NONE), result
        return rank, into


class Counter:
    """Counts the tokens of texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}
        self.words = regex.compile(PATTERN)
        whole = sorted(vocabulary.specials, key=len, reverse=True)
        self.specials = regex.compile("|".join(regex.escape(s) for s in whole)) if whole else None

    def _pretokens(self, text: str):
        if len(text) <= 1 << 20:
            yield self.words.findall(text)
            return
        # The same pre-tokens, but never all at once.
        found = (m.group() for m in self.words.finditer(text))
        while chunk := list(islice(found, _CHUNK)):
            yield chunk

    def _learn(self, words: set[str]) -> dict[str, int]:
        new = [w for w in words if w not in self.known]
        counts = self.vocabulary.count_symbols([w.encode() for w in new]).tolist() if new else []
        if len(self.known) + len(new) > _REMEMBERED:
            self.known.clear()
        long = {}
        for word, n in zip(new, counts, strict=True):
            (self.known if len(word) <= _SHORT else long)[word] = n
        return long

    def count(self, texts: list[str]) -> list[int]:
        """Special strings inside texts count as one token each, as the vocabulary's library has it by default."""
        totals = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            words = set().union(*[w for _, w in held])
            long = self._learn(words)
            # A word may have left the memory while this batch was learnt.
            missing = [w for w in words if w not in self.known and w not in long]
            if missing:
                self._learn(set(missing))
            for at, some in held:
                totals[at] += sum(map(self.known.__getitem__, some)) if not long else sum(
                    long[w] if w in long else self.known[w] for w in some
                )
            held.clear()

        for at, text in enumerate(texts):
            parts = self.specials.split(text) if self.specials else [text]
            totals[at] += len(parts) - 1
            for part in parts:
                for words in self._pretokens(part):
                    held.append((at, words))
                    size += len(words)
                    if size >= _CHUNK:
                        settle()
                        size = 0
        settle()
        return totals


def token_counts(docs: DataFrame, path: str) -> "CountOf":
    """A function from a text column to its token count, for the vocabulary file at ``path``.

    The file is read once, on the driver, and its arrays are broadcast: their size is the vocabulary's. A null text
    counts as empty, which has no tokens.
    """
    bounded_batches(docs.sparkSession)
    return CountOf(docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path)))


class CountOf:
    def __init__(self, vocabulary) -> None:
        self.vocabulary = vocabulary

    @cached_property
    def counter(self) -> Counter:
        return Counter(self.vocabulary.value)

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary}

    def __call__(self, text: Column) -> Column:
        held = self

        @F.arrow_udf("bigint")
        def counted(texts: pa.Array) -> pa.Array:
            return pa.array(held.counter.count([t or "" for t in texts.to_pylist()]), pa.int64())

        return counted(text)
