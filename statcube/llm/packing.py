"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are encoded and cut into pieces of at most ``capacity`` tokens. Every input partition packs its pieces by best fit (longest
first, into the bin with the least room that holds them) and emits the bins that are full or nearly
so. The underfull bins go up a tree as items: ``fan_in`` partitions meet in a node, whose bins are packed by best fit once
more, and so on up to the root, which emits everything. A bin carries its pieces with their places, so what moves up
is a few numbers per piece of an underfull bin and never a text.

A node passes up at most ``carried`` bins, the emptiest ones, and emits the others as they are: whatever the size of
the corpus, a node works on at most ``fan_in * carried`` bins. No piece is ever dropped by this.
"""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statcube.llm.bpe import _PLAIN, _PLAIN_WORD, REMEMBERED_WORDS, TOKENIZER, byte_symbols
from statcube.llm.shared import Query, one_thread, table, texts_of, tokenizer_file
from statcube.sources.scratch import materialize

CAPACITY = 4096
FAN_IN = 8
#: Bins with at most this much room count as full on the way up.
NEARLY_FULL = 8
CARRIED = 20_000
END_OF_DOCUMENT = 1
#: Characters of texts that are cut into words at once; a longer text is taken alone.
CHARACTERS_AT_ONCE = 2_000_000
#: New words that go to the library in one call.
WORDS_PER_CALL = 10_000

# Kinds of the bytes of plain texts in lower case; every byte of a Latin letter beyond ASCII is a letter.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*b"\t\n\x0b\x0c\r "]] = _SPACE
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_KIND[[*b"0123456789"]] = _DIGIT
_CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
#: Byte symbols of the vocabulary, with blanks left between words.
_SYMBOLS = "".join(symbol if byte != 0x20 else " " for byte, symbol in enumerate(byte_symbols()))

_PIECE = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])


def plain_words(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the first bytes of all words, and of all bytes in words, of plain texts in lower case (UTF-8, a blank at the end).

    The same words as those of ``_PLAIN_WORD``: a byte begins a word where the kind of bytes changes, and at every digit; an apostrophe
    that begins a word takes the ending of a contraction with it.
    """
    found = np.frombuffer(lowered, np.uint8)
    kind = _KIND[found]
    inside = kind != _SPACE
    begins = inside.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    marks = np.flatnonzero((found == ord("'")) & begins)
    for ending in _CONTRACTIONS:
        at = marks
        for k, letter in enumerate(ending, 1):
            at = at[found[at + k] == letter]  # what matched so far is no blank, so another byte follows
        begins[at + 1] = False
        after = at + 1 + len(ending)
        begins[after] = inside[after]
    return begins, inside


class LibraryWords:
    """Token numbers by the tokenizers library, which is asked once per distinct word of a task.

    Only texts of ASCII and Latin letters are cut into words here; others, and special tokens, go whole to the library.
    """

    def __init__(self, path: str, specials_as_text: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        one_thread()
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = specials_as_text
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._words = Tokenizer(self._tokenizer.model)  # for words that are normalized, cut and spelled in byte symbols
        self._words.pre_tokenizer = CharDelimiterSplit(" ")
        self._known: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True

    def encode(self, text: str) -> bytes:
        if not self._is_plain(text):
            return self._encode_whole(text)
        words = _PLAIN_WORD.findall(text.lower())
        self._learn(set(words))
        return b"".join(map(self._known.__getitem__, words))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """What ``encode`` gives for every text, in order; many texts are cut and looked up at once, each distinct word of them once."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= CHARACTERS_AT_ONCE:
                yield from self._encode_held(held)
                held, size = [], 0
        yield from self._encode_held(held)

    def _is_plain(self, text: str) -> bool:
        return "<|" not in text and _PLAIN.fullmatch(text) is not None

    def _encode_whole(self, text: str) -> bytes:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_held(self, texts: list[str]) -> Iterator[bytes]:
        plain = list(map(self._is_plain, texts))
        coded = self._encode_plain([text for text, is_plain in zip(texts, plain) if is_plain])
        for text, is_plain in zip(texts, plain):
            yield next(coded) if is_plain else self._encode_whole(text)

    def _encode_plain(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        lowered = [f"{text} ".lower().encode() for text in texts]  # blanks keep the words of two texts apart
        first_bytes = np.cumsum([0, *map(len, lowered)])
        joined = b"".join(lowered)
        del lowered
        begins, inside = plain_words(joined)
        first_words = np.searchsorted(np.flatnonzero(begins), first_bytes)
        # Without blanks a word ends where the next begins, as in an Arrow column.
        data = np.frombuffer(joined, np.uint8)[inside]
        offsets = np.append(np.flatnonzero(begins[inside]), len(data))
        del joined, begins, inside
        words = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = words.indices.to_numpy()
        del data, offsets, words
        self._learn(distinct)
        coded = list(map(self._known.__getitem__, distinct))
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        tokens = np.frombuffer(b"".join(coded), "<u4")
        starts = np.cumsum(lengths) - lengths
        # Tokens of the words one after the other: from where a word's tokens are to where they go.
        counts = lengths[number]
        ends = np.cumsum(counts)
        ids = tokens[np.repeat(starts[number] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        first_tokens = np.concatenate([[0], ends])[first_words].tolist()
        for start, end in zip(first_tokens, first_tokens[1:]):
            yield ids[start:end].tobytes()

    def _learn(self, words: Iterable[str]) -> None:
        """All of these distinct words are known afterwards; new ones go to the library, each ends with the one token that marks a word's end."""
        known = self._known
        new = [word for word in words if word not in known]
        if new and len(known) > REMEMBERED_WORDS:
            known.clear()
            new = list(words)
        for first in range(0, len(new), WORDS_PER_CALL):
            asked = new[first : first + WORDS_PER_CALL]
            symbols = codecs.charmap_decode(" ".join(asked).encode(), "strict", _SYMBOLS)[0]
            ids = np.asarray(self._words.encode_batch_fast([symbols], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) != len(asked):
                raise ValueError("Words and word ends differ")
            start, raw = 0, ids.tobytes()
            for word, end in zip(asked, (4 * ends).tolist()):
                known[word] = raw[start:end]
                start = end


@lru_cache(maxsize=2)
def library_words(path: str, specials_as_text: bool = False) -> LibraryWords:
    """The encoder, once per Python worker."""
    return LibraryWords(path, specials_as_text)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin, by best fit of falling sizes.

    Room is a whole number up to ``capacity``: bins are held by their room, and a bit set tells which rooms exist.
    """
    order = np.argsort(-sizes, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += size
        left = room - size
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins, offsets, np.asarray(fills, np.int64)


def _packed(sizes: np.ndarray, members: pa.ListArray, id_type: pa.DataType, capacity: int, nearly_full: int, carried: int, root: bool, node: int) -> pa.RecordBatch:
    """Bins (node, done, fill, members) of units with lists of member pieces."""
    bins, offsets, fills = best_fit(sizes, capacity)
    order = np.lexsort((offsets, bins))
    taken = members.take(pa.array(order))
    counts = np.asarray(taken.value_lengths().fill_null(0), np.int64)
    flat = taken.flatten()
    shift = np.repeat(offsets[order], counts)
    fields = [flat.field(k) for k in range(flat.type.num_fields)]
    fields[-1] = pa.array(np.asarray(fields[-1], np.int64) + shift)
    flat = pa.StructArray.from_arrays(fields, fields=list(flat.type))
    per_bin = np.bincount(bins[order], weights=counts, minlength=len(fills)).astype(np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32)), flat)
    done = fills >= capacity - nearly_full
    if root:
        done[:] = True
    elif (~done).sum() > carried:
        fullest_first = np.argsort(-np.where(done, -1, fills), kind="stable")
        done[fullest_first[: (~done).sum() - carried]] = True
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(fills), node, np.int64)), pa.array(done), pa.array(fills), lists], ["node", "done", "fill", "members"])


def pack_tokens(
    docs: DataFrame,
    identifier: str,
    text: str,
    encode: Callable[[], Callable],
    capacity: int = CAPACITY,
    end_of_document: int | None = END_OF_DOCUMENT,
    nearly_full: int = NEARLY_FULL,
    fan_in: int = FAN_IN,
    carried: int = CARRIED,
    finish: Callable[[], None] | None = None,
    many: bool = False,
) -> DataFrame:
    """Packed pieces: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``encode`` makes, inside a task, a function from a text to little-endian unsigned 32-bit token numbers; with ``many`` one from
    an iterator of texts to an iterator of their token numbers. A missing text counts as empty. Documents longer than ``capacity`` are cut, others stay whole; a document without any
    token (no end mark asked for) gives no piece. Rows that repeat are packed as often as they occur; other columns are ignored; an
    empty table gives an empty result. A task holds a few numbers per piece of its partition. ``finish`` runs at the end of a task that encodes.
    """
    id_kind = docs.schema[identifier].dataType.simpleString()
    schema = f"node long, done boolean, fill long, members array<struct<id:{id_kind},piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
    mark = b"" if end_of_document is None else int(end_of_document).to_bytes(4, "little")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encode() if many else partial(map, encode())
        ids, rows = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            sources = []
            for k, coded in enumerate(coder(texts_of(batch.column(1)))):
                tokens = coded + mark
                for piece, start in enumerate(range(0, len(tokens) // 4, capacity)):
                    part = tokens[4 * start : 4 * (start + capacity)]
                    rows.append((piece, start, len(part) // 4, zlib.crc32(part)))
                    sources.append(k)
            ids.append(batch.column(0).take(pa.array(sources, pa.int64())))
        if finish is not None:
            finish()
        if not rows:
            return
        columns = np.asarray(rows, np.int64).reshape(-1, 4)
        all_ids = pa.chunked_array(ids).combine_chunks()
        zero = np.zeros(len(rows), np.int64)
        arrays = [all_ids, pa.array(columns[:, 0].astype(np.int32)), *(pa.array(c) for c in (columns[:, 1], columns[:, 2], columns[:, 3], zero))]
        flat = pa.StructArray.from_arrays(arrays, ["id", *(f.name for f in _PIECE)])
        single = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32)), flat)
        yield _packed(columns[:, 2], single, all_ids.type, capacity, nearly_full, carried, False, TaskContext.get().partitionId())

    def merged(root: bool) -> Callable[[pa.Table], pa.Table]:
        def node(rows: pa.Table) -> pa.Table:
            members = rows.column("members").combine_chunks()
            members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
            sizes = np.asarray(rows.column("fill"), np.int64)
            packed = _packed(sizes, members, members.type.value_type.field(0).type, capacity, nearly_full, carried, root, rows.column("node")[0].as_py())
            return pa.Table.from_batches([packed])

        return node

    level = materialize(docs.select(F.col(identifier), F.col(text)).mapInArrow(leaves, schema), "bins")
    finished = level.filter("done")
    nodes = (level.agg(F.max("node")).first()[0] or 0) + 1
    while True:
        root = nodes <= fan_in
        nodes = -(-nodes // fan_in)
        underfull = level.filter("NOT done").withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        level = materialize(underfull.groupBy("node").applyInArrow(merged(root), schema), "bins")
        finished = finished.unionByName(level.filter("done"))
        if root:
            break
    # The number is given before the pieces are taken out, so it counts bins.
    numbered = finished.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    return numbered.select("sequence_id", F.explode("members").alias("m")).select(F.col("m.id").alias(identifier), "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def pack_documents(docs: DataFrame, path: str | None = None, forget: bool = False) -> DataFrame:
    """``pack_tokens`` of ``doc_id`` and ``text`` by the word-BPE tokenizer file.

    With ``forget`` a Python worker drops the words it remembers, and memory that Arrow keeps, at the end of a task, for jobs in which it lives on with other stages.
    """

    def encode() -> Callable[[Iterable[str]], Iterator[bytes]]:
        return library_words(path or tokenizer_file(TOKENIZER)).encode_all

    def forget_words() -> None:
        library_words(path or tokenizer_file(TOKENIZER))._known.clear()
        pa.default_memory_pool().release_unused()

    return pack_tokens(docs, "doc_id", "text", encode, finish=forget_words if forget else None, many=True)


def op2(spark, folder):
    return pack_documents(table(spark, folder, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op2_best_fit_packing": (op2, None)}
