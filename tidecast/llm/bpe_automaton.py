"""BPE encoding and decoding by a tokenization automaton.

Construction. The automaton over tokens starts as one state with an arc for
each base symbol and takes one merge gadget for each merge (u, v) -> w, in
order of priority: the state reached by u loses its v arc, every state that
had the path u v gains an arc w, which leads to the state after v as it was
before the loss. What remains after the last gadget accepts exactly the
correct tokenizations. The state after a token is thus the row of the token's
right part at the time of the merge, less the arcs lost since; a new token is
an arc wherever its left part was one at that time. So a gadget is stored as
two links and one lost arc with its time, and the 49k x 49k arc table is
never written out: ``_arc`` looks along the two chains of parts.

Encoding. The token automaton is turned into a table over symbols: a table
state holds the longest vocabulary prefix that ends here (a trie with failure
links) and the last token of each prefix of the text within it; of the tokens
that end here exactly one has an arc from the state before it. Rows of the
table are made when first needed and kept, so a word is one table step for
each byte, then its tokens are read off backwards. Decoding emits the labels
of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import threading
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_arrow

#: Table states and cached words a worker keeps before it starts anew.
MAX_STATES = 400_000
MAX_WORDS = 300_000
_START = -1
_AT = -1
#: Blanks to Python's split() but not to the pattern's \s.
_OTHER_BLANKS = regex.compile("[\x1c-\x1f]")
# Where the tokenizers library's Unicode tables differ from ours.
# Marks that came after Unicode 9 (and U+11930, half of a later composition),
# which its normaliser neither reorders nor composes.
_LATER_MARKS = (
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF "
    "10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 "
    "11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF "
)
# Letters and numbers later than Unicode 16, which its pattern takes for signs.
_LATER_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
# Capitals that it lowers and Unicode 15.1 does not have: first, last, step, distance to the small letter.
_LATER_CAPITALS = ((0x1C89, 0x1C89, 1, 1), (0xA7CB, 0xA7CB, 1, -0xA567), (0xA7CC, 0xA7CE, 2, 1), (0xA7D2, 0xA7D4, 2, 1), (0xA7DA, 0xA7DA, 1, 1),
                   (0xA7DC, 0xA7DC, 1, -0xA641), (0x10D50, 0x10D65, 1, 0x20), (0x16EA0, 0x16EB8, 1, 0x1B))


def _class(ranges: str) -> str:
    """A character class of hexadecimal ranges."""
    ends = [r.split("-") for r in ranges.split()]
    return "[" + "".join(f"{chr(int(e[0], 16))}-{chr(int(e[-1], 16))}" for e in ends) + "]"


_OPAQUE = regex.compile(f"({_class(_LATER_MARKS)})")
_SIGNS = regex.compile(_class(_LATER_LETTERS))
_LOWERED = {c: c + by for first, last, step, by in _LATER_CAPITALS for c in range(first, last + 1, step)}
_CAPITAL = regex.compile("[" + "".join(map(chr, _LOWERED)) + "]")


def normalised(text: str) -> str:
    """NFC and lower case as the library has them."""
    if text.isascii():
        return text.lower()
    if _OPAQUE.search(text):
        text = "".join(p if i % 2 else unicodedata.normalize("NFC", p) for i, p in enumerate(_OPAQUE.split(text)))
    else:
        text = unicodedata.normalize("NFC", text)
    if _CAPITAL.search(text):
        text = text.translate(_LOWERED)
    return text.replace("Σ", "σ").lower()


def byte_labels() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Words(dict):
    """Ids and labels of pieces between blanks met so far. At MAX_WORDS the
    cache becomes the older of two generations; words still met move over."""

    def __init__(self, coder: BpeAutomaton):
        super().__init__()
        self.coder = coder
        self.older: dict[str, tuple[str, str]] = {}
        self.of = self.__getitem__

    def __missing__(self, piece: str) -> tuple[str, str]:
        out = self.older.get(piece)
        if out is None:
            coder = self.coder
            parts = [piece] if piece.isalpha() else coder.split(piece)
            if len(parts) == 1:
                out = coder._emit(coder.tokens(parts[0].encode("utf-8")))
            else:
                ids, labels = zip(*map(self.of, parts))
                out = " ".join(ids), " ".join(labels)
        if len(self) >= MAX_WORDS:
            self.older = dict(self)
            self.clear()
        self[piece] = out
        return out


class BpeAutomaton:
    """Automaton of a byte-level BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.label = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label.update({i: t for t, i in self.special.items()})
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._build(vocab, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.digits = {i: str(i) for i in self.label}
        self._reset()
        self.words = _Words(self)

    # -- construction -----------------------------------------------------

    def _build(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}
        self.spelling: dict[int, tuple[int, ...]] = {}
        for b, c in enumerate(byte_labels()):
            for token, symbol in ((c, b), (c + self.suffix, 256 + b)):
                if token in vocab:
                    self.spelling[vocab[token]] = (symbol,)
                    self.born[vocab[token]] = 0
        for time, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if w in self.born:
                raise ValueError(f"two merges make {a + b!r}")
            if u not in self.born or v not in self.born or not self._arc(u, v):
                continue  # the automaton has no path u v: the gadget changes nothing
            self.lost[u, v] = time
            self.left[w], self.right[w], self.born[w] = u, v, time
            self.spelling[w] = self.spelling[u] + self.spelling[v]
        self.length = {t: len(s) for t, s in self.spelling.items()}
        self._trie()

    def _arc(self, s: int, t: int) -> bool:
        """Whether the state after token s has an arc t."""
        lost, born, parts = self.lost, self.born, []
        end = 1 << 60
        while True:
            parts.append((t, end))
            end = born[t]
            if t not in self.left:
                break
            t = self.left[t]
        end = 1 << 60
        while True:
            for x, until in parts:
                time = lost.get((s, x))
                if time is not None and time < end and time <= until:
                    return False
            end = born[s]
            if s not in self.right:
                return True
            s = self.right[s]

    def _trie(self) -> None:
        self.child: list[dict[int, int]] = [{}]
        self.token = [None]
        self.depth = [0]
        for t, symbols in self.spelling.items():
            node = 0
            for x in symbols:
                if x not in self.child[node]:
                    self.child[node][x] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[node][x]
            self.token[node] = t
        self.fail = [0] * len(self.child)
        self.ends: list[tuple[int, ...]] = [()] * len(self.child)
        queue = [0]
        for node in queue:  # breadth first: shorter nodes are done
            for x, nxt in self.child[node].items():
                self.fail[nxt] = self._step(self.fail[node], x) if node else 0
                own = () if self.token[nxt] is None else (self.token[nxt],)
                self.ends[nxt] = own + self.ends[self.fail[nxt]]
                queue.append(nxt)

    def _step(self, node: int, x: int) -> int:
        while True:
            nxt = self.child[node].get(x)
            if nxt is not None:
                return nxt
            if not node:
                return 0
            node = self.fail[node]

    # -- the table over symbols -------------------------------------------
    # A table row is a dict from symbol to the next row; under _AT it holds
    # its own number. Rows are shared by all words that reach them.

    def _reset(self) -> None:
        self.start: dict = {_AT: 0}
        self.rows = [self.start]
        self.states: list[tuple[int, tuple[int, ...]]] = [(0, (_START,))]
        self.last = [_START]
        self.number = {self.states[0]: 0}
        self.arcs: dict[tuple[int, int], bool] = {}

    def _grow(self, row: dict, x: int) -> dict:
        """Make the table entry of ``row`` and symbol ``x``."""
        node, lasts = self.states[row[_AT]]
        node = self._step(node, x)
        arcs = self.arcs
        for t in self.ends[node]:
            before = lasts[self.length[t] - 1]
            if before == _START:
                break
            ok = arcs.get((before, t))
            if ok is None:
                ok = arcs[before, t] = self._arc(before, t)
            if ok:
                break
        else:
            raise AssertionError("a text has exactly one tokenization")
        key = (node, (t, *lasts[: self.depth[node]]))
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.rows)
            self.rows.append({_AT: at})
            self.states.append(key)
            self.last.append(t)
        out = row[x] = self.rows[at]
        return out

    def tokens(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word."""
        if len(self.rows) > MAX_STATES:
            self._reset()
        row, path = self.start, []
        for x in word[:-1]:
            nxt = row.get(x)
            row = self._grow(row, x) if nxt is None else nxt
            path.append(row)
        x = word[-1] | 256
        nxt = row.get(x)
        path.append(self._grow(row, x) if nxt is None else nxt)
        out, i, last, length = [], len(path), self.last, self.length
        while i > 0:
            t = last[path[i - 1][_AT]]
            out.append(t)
            i -= length[t]
        out.reverse()
        return out

    # -- texts --------------------------------------------------------------

    def _emit(self, ids: list[int]) -> tuple[str, str]:
        return " ".join([self.digits[i] for i in ids]), " ".join([self.label[i] for i in ids])

    def split(self, piece: str) -> list[str]:
        """Parts of a piece between blanks."""
        if not _SIGNS.search(piece):
            return self.pattern.findall(piece)
        shown = _SIGNS.sub("\u2603", piece)  # any sign that is neither letter nor digit
        return [piece[m.start():m.end()] for m in self.pattern.finditer(shown)]

    def _plain(self, text: str) -> list[tuple[str, str]]:
        text = normalised(text)
        pieces = [p for p in regex.split(r"\s+", text) if p] if _OTHER_BLANKS.search(text) else text.split()
        return list(map(self.words.of, pieces))

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, ids joined by a space, labels joined by a space."""
        out: list[tuple[str, str]] = []
        at = 0
        if self.special_pattern is not None:
            for m in self.special_pattern.finditer(text):
                out += self._plain(text[at:m.start()])
                out.append(self._emit([self.special[m.group()]]))
                at = m.end()
        out += self._plain(text[at:] if at else text)
        if not out:
            return 0, "", ""
        ids, labels = zip(*out)
        ids = " ".join(ids)
        return ids.count(" ") + 1, ids, " ".join(labels)

    def decode(self, ids: list[int]) -> str:
        """Arc labels joined by a space (the file names no decoder)."""
        return " ".join(self.label[i] for i in ids if i in self.label)


_loaded: dict[str, BpeAutomaton] = {}
_lock = threading.Lock()


def automaton(path: str) -> BpeAutomaton:
    """The automaton of a file, compiled once in each worker process."""
    with _lock:
        if path not in _loaded:
            _loaded[path] = BpeAutomaton(path)
        return _loaded[path]


def bpe_codes(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              keep_tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (repeated
    rows and null ids too); with ``keep_tokens`` also ids (array) and decoded.
    Null or empty texts have no tokens and the digest of the empty string.
    Rows are independent: no shuffle. ``path`` must be readable by executors.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_tokens:
        schema += ", ids array<int>, decoded string"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = automaton(path)
        coded = [coder.encode(t or "") for t in batch.column(1).to_pylist()]
        digest = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        arrays = [batch.column(0).cast(pa.int64()), pa.array([c[0] for c in coded], pa.int64()),
                  pa.array([digest(c[1]) for c in coded], pa.string()), pa.array([digest(c[2]) for c in coded], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_tokens:
            arrays += [pa.array([list(map(int, c[1].split())) for c in coded], pa.list_(pa.int32())), pa.array([c[2] for c in coded], pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(arrays, names)

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)
