"""BPE encoding and decoding by a deterministic automaton over tokens.

The merges are compiled one after another. The automaton starts as one state with a loop for
every base symbol, so it accepts every symbol string. The gadget of merge (a, b) -> c then
changes it so that it accepts exactly the strings in which that merge has been applied: the
state behind `a` is split, its copy loses the arc `b`, all `a` arcs go to the copy, and every
state with an arc `a` gets an arc `c` to the state behind `b`. All arcs of one label lead to one
state, and a state differs from the one it was split from by one lost arc, so a state is kept as
(parent, lost label, merge index) and a label as its target state: the whole automaton has at
most one state and one label per merge.

In the end exactly one path spells any given word, and so any beginning of it; its arcs are the
word's BPE tokens. Encoding goes over the word once, from left to right, and looks up in the
transition table by which arc each place is reached from a place before; nothing is tried twice.
Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import pick, table

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Words of each kind that one Python worker remembers; beyond that the memory starts anew.
WORDS_REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class MergeAutomaton:
    """The automaton of a merge list: `merges` are (left, right, merged) token ids in order."""

    FOREVER = 1 << 40

    def __init__(self, n_tokens: int, base: list[int], merges: list[tuple[int, int, int]]):
        self.parent, self.lost, self.since = [-1], [-1], [-1]  # by state; 0 is the start
        self.target = [-1] * n_tokens  # by label: the state that all its arcs lead to
        self.spine: list[tuple[tuple[int, int], ...]] = [()] * n_tokens  # left parts, with the merge that used each up
        self._losses: dict[int, dict[int, int]] = {}
        self._next: dict[int, int] = {}  # the transition table, by state << 20 | label
        for t in base:
            self.target[t] = 0
        left: dict[int, tuple[int, int]] = {}
        for at, (a, b, c) in enumerate(merges):
            q = self.target[a]
            if q < 0 or self.target[b] < 0 or not self._has(q, self._left_parts(b, left), self._walk(q)):
                continue  # a is never followed by b here: nothing to merge
            behind = self.target[b]
            self.parent.append(q)
            self.lost.append(b)
            self.since.append(at)
            self.target[a] = len(self.parent) - 1
            self.target[c] = behind
            left[c] = (a, at)
        for t in range(n_tokens):
            if self.target[t] >= 0:
                self.spine[t] = self._left_parts(t, left)

    def _left_parts(self, t: int, left: dict[int, tuple[int, int]]) -> tuple[tuple[int, int], ...]:
        parts, until = [], self.FOREVER
        while True:
            parts.append((t, until))
            if t not in left:
                return tuple(parts)
            t, until = left[t]

    def _walk(self, q: int) -> dict[int, int]:
        """Labels that state q has lost, with the merge that took each."""
        losses: dict[int, int] = {}
        while q > 0:
            losses[self.lost[q]] = self.since[q]  # the earliest is written last
            q = self.parent[q]
        return losses

    @staticmethod
    def _has(q: int, parts: tuple[tuple[int, int], ...], losses: dict[int, int]) -> bool:
        return all(losses.get(u, until + 1) > until for u, until in parts)

    def step(self, q: int, t: int) -> int:
        """The state that the arc t of state q leads to; -1 if there is no such arc. Filled into the
        transition table on first use, since most pairs never come up."""
        key = q << 20 | t
        found = self._next.get(key)
        if found is None:
            if len(self._next) > 2_000_000:
                self._next.clear()
            if (losses := self._losses.get(q)) is None:
                if len(self._losses) > 3_000:
                    self._losses.clear()
                losses = self._losses[q] = self._walk(q)
            found = self._next[key] = self.target[t] if self.target[t] >= 0 and self._has(q, self.spine[t], losses) else -1
        return found

    def path(self, word: str, inner: dict[str, int], final: dict[str, int], reach: dict[str, int]) -> list[int]:
        """Labels of the only path that spells `word`.

        `inner` has the labels that end before the word does, `final` those that end it; `reach` has the
        length of the longest label by its last three symbols, 2 at least.
        """
        if (t := final.get(word)) is not None and self.step(0, t) >= 0:
            return [t]
        n, name, after, longest = len(word), inner.get, self._next.get, reach.get
        states, begins, labels = [0], [0], [0]  # of each place: its state, and where its last arc begins
        for i in range(1, n + 1):
            if i == n:
                name = final.get
            j = i - longest(word[i - 3 : i] if i > 2 else word[:i], 2)
            for j in range(j if j > 0 else 0, i):
                t = name(word[j:i])
                if t is not None and (q := states[j]) >= 0:
                    to = after(q << 20 | t)
                    if to is None:
                        to = self.step(q, t)
                    if to >= 0:
                        break
            else:
                to = j = t = -1
            states.append(to)
            begins.append(j)
            labels.append(t)
        if states[n] < 0:
            raise ValueError(f"no path spells {word!r}")
        out = []
        while n:
            out.append(labels[n])
            n = begins[n]
        return out[::-1]


class WordBpe:
    """A word-level BPE vocabulary file (lower case, end-of-word suffix, no decoder) as an automaton."""

    #: White space as Unicode has it, without the four information separators that Python adds.
    SPACE = "\t-\r \x85\xa0  -     　"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.labels = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for label, i in [*vocab.items(), *self.special.items()]:
            self.labels[i] = label
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = {a + b for a, b in pairs}
        base = [i for t, i in vocab.items() if t not in made and t not in self.special]
        self.automaton = MergeAutomaton(len(self.labels), base, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        ordinary = {t: i for t, i in vocab.items() if t not in self.special}
        n = len(self.suffix)
        self.final = {t[: len(t) - n]: i for t, i in ordinary.items() if t.endswith(self.suffix)}
        self.inner = {t: i for t, i in ordinary.items() if not (n and t.endswith(self.suffix))}
        self.reach: dict[str, int] = {}
        for t in [*self.final, *self.inner]:
            self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 2))
        self.bytes = byte_symbols()
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{self.SPACE}\p{{L}}\p{{N}}]+")
        self.rare = regex.compile("[^\0-\u024f\u2010-\u2027]")
        self._path, self._rules = path, None
        self._known: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}  # of words as text, and as byte symbols

    def rules(self):
        """The library's normalizer and pre-tokenizer for this file; its model isn't used."""
        if self._rules is None:
            from tokenizers import Tokenizer

            self._rules = Tokenizer.from_file(self._path)
        return self._rules

    def word(self, word: str, spelled: bool = False) -> bytes:
        """Ids of a word, given as text or spelled in byte symbols."""
        known = self._known[spelled]
        found = known.get(word)
        if found is None:
            symbols = word if spelled or word.isascii() and word.isprintable() else "".join([self.bytes[b] for b in word.encode()])
            if len(known) >= WORDS_REMEMBERED:
                known.clear()
            found = np.array(self.automaton.path(symbols, self.inner, self.final, self.reach), "<u4").tobytes()
            if len(word) <= 64:
                known[word] = found
        return found

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            if self.rare.search(text):  # where Unicode versions differ, the file's own rules pre-split
                own = self.rules()
                return [self.word(w, True) for w, _ in own.pre_tokenizer.pre_tokenize_str(own.normalizer.normalize_str(text))]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # final sigma isn't told apart
        return [*map(self.word, self.words.findall(text.lower()))]

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids as little-endian unsigned 32-bit integers; none for a null or blank text."""
        out: list[bytes] = []
        at, text = 0, text or ""
        if self.cut is not None and "<" in text:
            for m in self.cut.finditer(text):
                out += self._plain(text[at : m.start()])
                out.append(np.array([self.special[m[0]]], "<u4").tobytes())
                at = m.end()
        out += self._plain(text[at:] if at else text)
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs, one blank between them, since the vocabulary names no decoder."""
        return " ".join(map(self.labels.__getitem__, ids.tolist()))


_loaded: dict[str, WordBpe] = {}


def vocabulary(path: str) -> WordBpe:
    """Compiled once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, ids array<long>): the tokens of every whole text.

    A null or empty text gives an empty array; a null id stays null; repeated rows stay repeated;
    other columns are not read. `vocabulary_path` must exist on every executor.
    """
    path = vocabulary_path or public_path(DEFAULT_VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            ids = [bpe.encode(x.as_py()).astype(np.int64) for x in b.column(1)]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "ids"])

    return _docs(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<long>")


def decode(df: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, decoded) of a table (doc_id, ids); null ids decode to an empty text."""
    path = vocabulary_path or public_path(DEFAULT_VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            texts = [bpe.decode(np.array(x.as_py() or [], np.int64)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, so that
    neither ids nor decoded texts leave the worker.

    A null text counts as empty (no tokens, digests of nothing); a null id stays null; repeated rows stay
    repeated; an empty table gives no rows; other columns are not read."""
    path = vocabulary_path or public_path(DEFAULT_VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for x in b.column(1):
                ids = bpe.encode(x.as_py())
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _docs(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(df, doc_id=id_col, text=text_col).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
