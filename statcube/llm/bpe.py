"""BPE encoding and decoding with a tokenization automaton.

``MergeAutomaton`` compiles a merge list into a deterministic automaton whose arcs are labelled with tokens and which
accepts exactly the correct tokenizations of all words. It starts as one state with a loop for every base symbol. Each merge
(u, v), in order of priority, applies the merge gadget: the arcs labelled u are redirected to a copy of their target
that lacks the arc v, and wherever an arc u could be followed by v, an arc uv leads to the target
of v. All arcs with one label share a target, so a state is kept as "copy of a state, minus one arc" and the table
has one entry per merge: ``_cut[(u, v)]`` is the time at which the copy reached by u lost its arc v; what a state
had lost before it was copied is found along the right parts of its token, and how an arc came to be along the left parts of its label.

A word is encoded by transitions of that automaton: from the state of every position the arcs whose labels spell the next
symbols are followed. As each prefix of a word has one correct tokenization, each position has one
state, and the labels on the path to the last position are the tokens. Decoding emits the arc labels.

Texts are cut into words as the tokenizer file asks for: special tokens first, then NFC, white space, lower case and the word
pattern. Texts of ASCII and Latin letters take a table of this module; any other text is cut by the tokenizers
library's own normalizer and pre-tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, one_thread, table, texts_of, tokenizer_file

TOKENIZER = "word_bpe_49k.json"
#: Words and arcs that a task remembers; beyond that it starts anew, so memory stays bounded.
REMEMBERED_WORDS = 300_000
REMEMBERED_ARCS = 500_000
_NEVER = 1 << 60

# Texts of these characters are cut without the library: no other white space, no composition, no odd case mapping.
_PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-įı-ſ]*")
_PLAIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\\sa-z0-9ß-öø-ſ]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table_ = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in table_)
    table_.update({b: chr(256 + k) for k, b in enumerate(hidden)})
    return [table_[b] for b in range(256)]


class MergeAutomaton:
    """Deterministic tokenization automaton of a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.labels = {i: t for t, i in vocab.items()}
        self._made: dict[int, int] = {}  # time at which a token came to be
        self._parts: dict[int, tuple[int, int]] = {}
        self._cut: dict[int, int] = {}  # (u, v) as one number -> time
        self._spell: dict[int, tuple[str, ...]] = {}
        self._width = max(self.labels) + 2
        self._arcs: dict[int, bool] = {}
        for time, (left, right) in enumerate(merges):
            u, v, made = vocab[left], vocab[right], vocab[left + right]
            # Without the arc the pair never comes up; so of several merges to one token at most one applies.
            if self._has_arc(u, v):
                self._made[made] = time
                self._parts[made] = (u, v)
                self._cut[u * self._width + v] = time
        self._root: dict = {}
        for token, label in vocab.items():
            if label in self._made or self._is_base(token):
                node = self._root
                for symbol in self._symbols(token):
                    node = node.setdefault(symbol, {})
                node[None] = label

    def _is_base(self, token: str) -> bool:
        return len(token.removesuffix(self.suffix) if self.suffix and len(token) > len(self.suffix) else token) == 1

    def _symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def _has_arc(self, reached: int, label: int) -> bool:
        """Whether the state reached by a token has an arc with this label, at the present time."""
        cut, width = self._cut, self._width
        here, bound = reached, _NEVER
        while True:
            # A merge of a token with itself redirects first: the copy gets no arc of the doubled token.
            there, limit = label, _NEVER
            while True:
                time = cut.get(here * width + there)
                if time is not None and time < bound and time <= limit:
                    return False
                parts = self._parts.get(there)
                if parts is None:
                    break
                limit = min(limit, self._made[there])
                there = parts[0]
            parts = self._parts.get(here)
            if parts is None:
                return True
            bound = min(bound, self._made[here])
            # The state of a token made of twice the same part is the part's state before that very merge.
            here = parts[1]

    def encode_word(self, symbols: list[str]) -> list[int]:
        """Tokens of one word, given as base symbols (the last one with the suffix)."""
        size, arcs, width = len(symbols), self._arcs, self._width
        if len(arcs) > REMEMBERED_ARCS:
            arcs.clear()
        reached: list[int] = [-1] * (size + 1)
        origin = [-1] * (size + 1)
        for start in range(size):
            state = reached[start]
            if start and state < 0:
                continue
            node = self._root
            for end in range(start, size):
                node = node.get(symbols[end])
                if node is None:
                    break
                label = node.get(None)
                if label is None:
                    continue
                if start:
                    arc = state * width + label
                    allowed = arcs.get(arc)
                    if allowed is None:
                        allowed = arcs[arc] = self._has_arc(state, label)
                    if not allowed:
                        continue
                reached[end + 1], origin[end + 1] = label, start
        if size and origin[size] < 0:
            raise ValueError(f"No token for a symbol of {''.join(symbols)!r}")
        path = []
        while size:
            path.append(reached[size])
            size = origin[size]
        return path[::-1]

    def emit(self, ids) -> Iterator[str]:
        """Arc labels of token numbers."""
        return map(self.labels.__getitem__, ids)


class WordBpe:
    """Encoder and decoder of a word-BPE tokenizer file (lower case, word ends marked)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        one_thread()
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        if spec["decoder"] is not None or model["unk_token"] is not None or model["ignore_merges"]:
            raise ValueError(f"{path} is not a word-BPE file of the expected kind")
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special tokens with options are not supported")
        self._special_pattern = re.compile("(" + "|".join(map(re.escape, self._special)) + ")") if self._special else None
        self.automaton = MergeAutomaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.automaton.labels.update({i: t for t, i in self._special.items()})
        self.labels = [self.automaton.labels.get(i) for i in range(max(self.automaton.labels) + 1)]
        self._bytes = byte_symbols()
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        self._known: dict[str, bytes] = {}

    def _encode_mapped(self, mapped: str) -> bytes:
        symbols = list(mapped)
        symbols[-1] += self.automaton.suffix
        return array("I", self.automaton.encode_word(symbols)).tobytes()

    def _learn(self, words: list[str], mapped: bool) -> None:
        known = self._known
        for word in set(words):
            if word not in known:
                plain = word[1:] if mapped else "".join(self._bytes[b] for b in word.encode("utf-8"))
                known[word] = self._encode_mapped(plain)

    def words(self, text: str) -> tuple[list[str], bool]:
        """Words of a text without special tokens; True if they are given in byte symbols (after a NUL)."""
        if _PLAIN.fullmatch(text):
            return _PLAIN_WORD.findall(text.lower()), False
        pieces = self._splitter.pre_tokenize_str(self._normalizer.normalize_str(text))
        return ["\0" + p for p, _ in pieces], True

    def _encode_piece(self, text: str) -> bytes:
        words, mapped = self.words(text)
        try:
            return b"".join(map(self._known.__getitem__, words))
        except KeyError:
            if len(self._known) > REMEMBERED_WORDS:
                self._known.clear()
            self._learn(words, mapped)
            return b"".join(map(self._known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Token numbers as little-endian unsigned 32-bit integers."""
        if "<|" not in text or self._special_pattern is None:
            return self._encode_piece(text)
        found = []
        for piece in self._special_pattern.split(text):
            special = self._special.get(piece)
            found.append(self._encode_piece(piece) if special is None else array("I", [special]).tobytes())
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The arc labels, with a blank between tokens, as the file names no decoder."""
        return " ".join(map(self.labels.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The compiled tokenizer, once per Python worker."""
    return WordBpe(path)


def bpe_digests(text: Column, path: str | None = None) -> Column:
    """Struct of ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of a whole text."""

    def run(column: pa.Array) -> pa.Array:
        coder = word_bpe(path or tokenizer_file(TOKENIZER))
        counts, ids_digests, text_digests = [], [], []
        for value in texts_of(column):
            ids = coder.encode(value)
            counts.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            text_digests.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
        arrays = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(run, "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")(text)


def encode_column(text: Column, path: str | None = None) -> Column:
    """Token numbers of a whole text as an array."""

    def run(column: pa.Array) -> pa.Array:
        coder = word_bpe(path or tokenizer_file(TOKENIZER))
        return pa.array([array("I", coder.encode(v)).tolist() for v in texts_of(column)], pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")(text)


def decode_column(ids: Column, path: str | None = None) -> Column:
    """Decoded text of an array of token numbers (a missing array as empty)."""

    def run(column: pa.Array) -> pa.Array:
        coder = word_bpe(path or tokenizer_file(TOKENIZER))
        return pa.array([coder.decode(array("I", v.as_py() or []).tobytes()) for v in column], pa.string())

    return F.arrow_udf(run, "string")(ids)


def bpe_round_trip(docs: DataFrame, identifier: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    A missing or empty text has no tokens and decodes to the empty text. Texts are encoded whole, one at a time;
    repeated rows get equal results, other columns are ignored and an empty table gives an empty result.
    """
    coded = docs.select(F.col(identifier).alias("__id"), bpe_digests(F.col(text), path).alias("__c"))
    return coded.select(F.col("__id").alias(identifier), "__c.n_tokens", "__c.ids_sha256", "__c.decoded_sha256")


def op7(spark, folder):
    return bpe_round_trip(table(spark, folder, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op7_bpe": (op7, None)}
