"""Encoding of the whole corpus with a public tokenizer.

Method: the merges of a byte-level BPE are compiled into a deterministic
automaton by successive merge gadgets. The states are the tokens; an arc from
token u to token v exists if v may follow u in a correct encoding. The gadget of
a merge (a, b) -> c takes away the arcs from every token that ends in a, as it
stands when the merge's turn comes, to every token that begins with b; what
ends or begins with a token at a given turn is read from its right and left
spines of merges. A word is encoded by table-driven steps over its bytes: a
table of moves gives the state of the vocabulary's trie after each byte, and with
it the tokens that end there; of those exactly one continues a correct path from
the token kept where it begins, so each position keeps one. The arc labels along
the path of the last position are the encoding; emitting a label's bytes decodes
it. 50,257² arcs would not fit, so both tables are compiled for what is reached,
and bounded.

A table of words already run through the automaton, bounded in size, sits in
front of it: most words of a corpus repeat.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread

TOKENIZERS = "/opt/tokenizers"

# Fixed value: how byte-level BPE vocabularies of this family cut a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for texts of ASCII alone, for Python's own engine.
ASCII_WORDS = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII).findall

# Bounds of what a worker keeps: arcs and moves in entries, the words already run in bytes, about, and the longest word kept.
ARCS, MOVES, WORD_BYTES, LONGEST_WORD = 300_000, 300_000, 64_000_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a .tiktoken file with their ids, which are the ranks of their merges."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeAutomaton:
    """The automaton of a vocabulary given as ranks: bytes -> id, lower ids merged first.

    Two tables drive it: ``moves``, from a state of the vocabulary's trie and a
    byte to the next state, which knows the tokens that end there, and ``arcs``,
    which tokens may follow which. Both are compiled for what is reached, hold a
    bounded number of entries, and are begun anew when full.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.size = max(ranks.values()) + 1
        self.parts: dict[int, tuple[int, int]] = {}
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self.arcs: dict[int, bool] = {}
        self.moves: dict[int, int] = {}
        self._build_trie()
        # gadgets go in by rank: the parts of a token are the encoding by the merges before it
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = self._run(token, i)
                if len(parts) == 2:
                    self.parts[i] = (parts[0], parts[1])

    def _build_trie(self) -> None:
        """Children by state and byte, the state of the longest proper suffix, and the tokens that end in a state, longest first."""
        self.child: dict[int, int] = {}
        self.suffix = [0]
        self.ends: list[tuple | None] = [None]
        level = [(0, 0, token, i) for token, i in self.ranks.items() if token]
        while level:
            deeper = []
            for state, at, token, i in level:
                key = state << 8 | token[at]
                if key not in self.child:
                    self.child[key] = len(self.suffix)
                    below = self._fallen(self.suffix[state], token[at]) if at else 0
                    self.suffix.append(below)
                    self.ends.append(self.ends[below])
                if at + 1 == len(token):
                    self.ends[self.child[key]] = (i, at + 1, self.ends[self.child[key]])
                else:
                    deeper.append((self.child[key], at + 1, token, i))
            level = deeper

    def _fallen(self, state: int, byte: int) -> int:
        """The state after a byte: a child, or one of the longest suffix that has it."""
        while (found := self.child.get(state << 8 | byte)) is None and state:
            state = self.suffix[state]
        return found or 0

    def _move(self, key: int) -> int:
        if len(self.moves) >= MOVES:
            self.moves.clear()
        state = self.moves[key] = self._fallen(key >> 8, key & 255)
        return state

    def _run(self, word: bytes, below: int | None = None) -> list[int]:
        """The labels of the path of ``word``; with ``below``, in the automaton before the gadget of that rank."""
        n, moves, ends, size = len(word), self.moves, self.ends, self.size
        known = self.arcs if below is None else {}
        label, start, state = [-1] * (n + 1), [0] * (n + 1), 0
        for end, byte in enumerate(word, 1):
            key = state << 8 | byte
            state = moves[key] if key in moves else self._move(key)
            token_here = ends[state]
            while token_here is not None:
                token, length, token_here = token_here
                begin = end - length
                if below is not None and length > 1 and token >= below or begin and label[begin] < 0:
                    continue
                if begin:
                    pair = label[begin] * size + token
                    if not (known[pair] if pair in known else self.arc(label[begin], token, below)):
                        continue
                label[end], start[end] = token, begin
                break
        out, at = [], n
        while at:
            out.append(label[at])
            at = start[at]
        return out[::-1]

    def _spine(self, token: int, right: bool) -> tuple[tuple[int, int], ...]:
        """(token, the rank at which it goes into the next) down a token's right or left edge, the token itself first."""
        kept = self._right if right else self._left
        if token not in kept:
            out, inner = [(token, self.size)], token
            while inner in self.parts:
                until, inner = inner, self.parts[inner][1 if right else 0]
                out.append((inner, until))
            kept[token] = tuple(out)
        return kept[token]

    def _made(self, token: int, turn: int) -> bool:
        """Whether a token stands before the gadget of rank ``turn`` goes in: single bytes always do."""
        return len(self.bytes_of[token]) == 1 or token < turn

    def arc(self, u: int, v: int, below: int | None = None) -> bool:
        """Whether v may follow u: no gadget, or none below a rank, has taken the arc away.

        The merge of an end of u and a beginning of v takes it away if both
        stand at its turn: each has been made and hasn't yet gone into a larger
        token. Of two occurrences of one merge's tokens the left one goes first.
        """
        top = self.size if below is None else below
        # at the turn of the merge that takes a away, the pair across the border comes later in the text than a's own; b's own comes later than the pair
        taken = any(
            (merged := self.ranks.get(self.bytes_of[a] + self.bytes_of[b])) is not None and merged < top and merged < a_until and merged <= b_until
            and self.parts.get(merged, (a, b)) == (a, b) and self._made(a, merged) and self._made(b, merged)
            for a, a_until in self._spine(u, True) for b, b_until in self._spine(v, False)
        )
        if below is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            self.arcs[u * self.size + v] = not taken
        return not taken

    def encode_word(self, word: bytes) -> list[int]:
        return self._run(word)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the arc labels."""
        return b"".join(self.bytes_of[i] for i in ids)


class CorpusEncoder:
    """Texts to ids: cut into words, words looked up or run through the automaton."""

    def __init__(self, path: str):
        import regex

        self.automaton = MergeAutomaton(read_ranks(path))
        self.cut_any = regex.compile(WORDS).findall
        self.table: dict[str, list[int]] = {}
        self.held = 0

    def cut(self, text: str) -> list[str]:
        # of ASCII texts the plain engine finds the same words, faster
        return ASCII_WORDS(text) if text.isascii() else self.cut_any(text)

    def _word(self, word: str) -> list[int]:
        ids = self.automaton.encode_word(word.encode("utf-8", "replace"))
        if len(word) <= LONGEST_WORD:
            if self.held >= WORD_BYTES:
                self.table.clear()
                self.held = 0
            self.table[word] = ids
            self.held += 200 + 4 * len(word) + 40 * len(ids)
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get, slow = self.table.get, self._word
        return list(chain.from_iterable([get(w) or slow(w) for w in self.cut(text)]))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        get, slow = self.table.get, self._word
        return sum([len(get(w) or slow(w)) for w in self.cut(text)])


@lru_cache(maxsize=4)
def encoder(path: str) -> CorpusEncoder:
    """The encoder of a vocabulary file, built once per worker process."""
    return CorpusEncoder(path)


def vocabulary(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return os.path.join(folder or os.environ.get("TALLYSPARK_TOKENIZERS", TOKENIZERS), f"{name}.tiktoken")


def encode_texts(df: DataFrame, id_column: str = "doc_id", text: Column | str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of every text, without special tokens; null and empty texts give an empty list.

    The strings of special tokens are ordinary text. Texts of any length are
    encoded whole; repeated rows each come out. Batches stream through the
    workers without a shuffle, unless the scan is too narrow to keep half the
    cores busy. Other columns are left out, whatever their names.
    """
    file = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file).encode
        for batch in batches:
            lists = [encode(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int64)
            if ends[-1] < 2**31 - 1:
                flat = pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1])), pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
            else:
                ids = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    column = F.col(text) if isinstance(text, str) else text
    texts = df.select(F.col(id_column).cast("long").alias("doc_id"), column.cast("string").alias("text"))
    return spread(texts, "doc_id").mapInArrow(run, "doc_id long, ids array<int>")


def count_tokens(df: DataFrame, id_column: str = "doc_id", text: Column | str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every text; 0 for null and empty ones."""
    file = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(file).count
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([count(t) for t in batch.column(1).to_pylist()], pa.int64())], ["doc_id", "n_tokens"])

    column = F.col(text) if isinstance(text, str) else text
    texts = df.select(F.col(id_column).cast("long").alias("doc_id"), column.cast("string").alias("text"))
    return spread(texts, "doc_id").mapInArrow(run, "doc_id long, n_tokens long")
