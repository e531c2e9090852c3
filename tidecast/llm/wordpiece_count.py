"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie. Each node knows, for the case that no longer match
follows, how many pieces are popped off the front (greedy longest match) and
which node the remaining suffix leads to (its failure link); both are
computed once, breadth first. A word is then read symbol by symbol, adding
popped counts on failures: linear time, and no piece is ever built.
"""

from __future__ import annotations

import json
import threading

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.bpe_automaton import byte_labels
from tidecast.llm.common import map_arrow

#: Word forms a worker keeps before it starts anew.
MAX_WORDS = 300_000
#: Words: letters, digits, other signs.
WORD = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")
_UNMATCHED = -1


class LongestMatch:
    """Counts pieces of words over a set of byte strings; those in ``heads``
    match only at the start of a word, those in ``tails`` only after it."""

    def __init__(self, heads: list[bytes], tails: list[bytes]):
        # Node 0 is the root of heads, node 1 the root of tails.
        self.child: list[dict[int, int]] = [{}, {}]
        ends: set[int] = set()
        order = [0, 1]
        for root, pieces in ((0, heads), (1, tails)):
            for piece in pieces:
                node = root
                for x in piece:
                    if x not in self.child[node]:
                        self.child[node][x] = len(self.child)
                        self.child.append({})
                    node = self.child[node][x]
                if node > 1:
                    ends.add(node)
        n = len(self.child)
        self.fail = [_UNMATCHED] * n
        self.pops = [0] * n
        for node in order:
            for x, nxt in self.child[node].items():
                if nxt in ends:  # the whole prefix is a piece: pop it, go on at the tails
                    self.fail[nxt], self.pops[nxt] = 1, 1
                elif node <= 1:
                    self.fail[nxt] = _UNMATCHED
                else:
                    pops, at = self.pops[node], self.fail[node]
                    while at != _UNMATCHED and x not in self.child[at]:
                        if at <= 1:
                            at = _UNMATCHED
                            break
                        pops, at = pops + self.pops[at], self.fail[at]
                    if at != _UNMATCHED:
                        self.fail[nxt], self.pops[nxt] = self.child[at][x], pops
                order.append(nxt)

    def count(self, word: bytes) -> int:
        """Pieces of the word; 1 (the unknown piece) if it can't be covered."""
        child, fail, pops = self.child, self.fail, self.pops
        node, total = 0, 0
        for x in word:
            nxt = child[node].get(x)
            while nxt is None:
                if node <= 1 or fail[node] == _UNMATCHED:
                    return 1
                total += pops[node]
                node = fail[node]
                nxt = child[node].get(x)
            node = nxt
        while node > 1:
            if fail[node] == _UNMATCHED:
                return 1
            total += pops[node]
            node = fail[node]
        return total


class _Counts(dict):
    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, chunk: str) -> tuple[int, int]:
        words = WORD.findall(chunk)
        out = len(words), sum(self.automaton.count(w.encode("utf-8", "surrogatepass")) for w in words)
        if len(self) >= MAX_WORDS:
            self.clear()
        self[chunk] = out
        return out


def load(path: str, head_mark: str = "Ġ") -> LongestMatch:
    """Automaton of a byte-level vocabulary file: entries that start with
    ``head_mark`` (a space) begin words, entries without it continue them. A
    single byte may begin a word too, so every word can be covered."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in enumerate(byte_labels())}
    heads, tails = [], []
    for token in vocab:
        if token.startswith(head_mark) and len(token) > 1:
            heads.append(bytes(byte[c] for c in token[1:] if c in byte))
        elif all(c in byte for c in token):
            tails.append(bytes(byte[c] for c in token))
    return LongestMatch(heads + [t for t in tails if len(t) == 1], tails)


_loaded: dict[str, _Counts] = {}
_lock = threading.Lock()


def counts(path: str) -> _Counts:
    """The word counts of a file, compiled once in each worker process."""
    with _lock:
        if path not in _loaded:
            _loaded[path] = _Counts(load(path))
        return _loaded[path]


def piece_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_pieces of every row (repeated rows and null ids
    too). Null and empty texts have none. Rows are independent: no shuffle.
    ``path`` must be readable by executors."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = counts(path).__getitem__
        words, pieces = [], []
        for text in batch.column(1).to_pylist():
            found = list(map(of, (text or "").split()))
            words.append(sum(w for w, _ in found))
            pieces.append(sum(p for _, p in found))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(words, pa.int64()), pa.array(pieces, pa.int64())], ["doc_id", "n_words", "n_pieces"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id bigint, n_words bigint, n_pieces bigint")
