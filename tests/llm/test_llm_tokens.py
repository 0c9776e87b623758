"""BPE automaton, packing, token counts and chat formatting."""

import hashlib
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from statcube.llm import bpe, chat_format, packing, token_counts
from statcube.llm.queries import QUERIES
from statcube.llm.shared import ship_package, table, tokenizer_file

ODD = ["", "aaaaaaa", "hahahaha ha", "<|endoftext|>x<|startoftext|> <|endoftext|", "ΑΣ İstanbul ǅ ﬁ", "n\u0303 ñ", "don't I'LL 'sun", "１２ ½ 漢字 かな", "a\x1cb\x85c d\u200be", "👩‍👩‍👧", "\0x", "ß ẞ ſ K", "العربية हिन्दी"]


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(bpe.TOKENIZER))


def odd_docs(spark):
    rows = [(k, t, 1) for k, t in enumerate(ODD)] + [(0, None, 2), (None, "no id", 3), (2, "hahahaha ha", 4), (50, "word " * 9000, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece int")


def test_automaton_equals_library(library):
    coder, rnd = bpe.word_bpe(tokenizer_file(bpe.TOKENIZER)), random.Random(3)
    texts = list(ODD)
    for alphabet in ("ab", "aeiourstn", "abcdefghijklmnopqrstuvwxyz", "hazé'!? 0"):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 25))) for _ in range(1500)]
    texts += ["".join(chr(rnd.choice([rnd.randint(32, 0x17F), rnd.randint(32, 0x2FFF)])) for _ in range(20)) for _ in range(1500)]
    for text in texts:
        ids = coder.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert array("I", ids).tolist() == want, text
        assert coder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_automaton_of_small_merge_lists():
    """Every word over two letters against merging by rank, for merge lists with doubled tokens."""
    def merged(word, merges):
        parts = list(word)
        for u, v in merges:
            k = 0
            while k < len(parts) - 1:
                if parts[k] == u and parts[k + 1] == v:
                    parts[k : k + 2] = [u + v]
                k += 1
        return parts

    for merges in ([("a", "a"), ("aa", "aa"), ("aa", "a")], [("a", "b"), ("ab", "a"), ("b", "b"), ("bb", "ab")], [("b", "a"), ("a", "ba"), ("ba", "ba")]):
        tokens = ["a", "b", *(u + v for u, v in merges)]
        machine = bpe.MergeAutomaton({t: k for k, t in enumerate(tokens)}, merges)
        for size in range(1, 11):
            for n in range(2**size):
                word = "".join("ab"[(n >> k) & 1] for k in range(size))
                assert [tokens[k] for k in machine.encode_word(list(word))] == merged(word, merges)
    # Of two merges to the same token only one can ever apply.
    twice = bpe.MergeAutomaton({"a": 0, "aa": 1, "aaa": 2}, [("a", "a"), ("a", "aa"), ("aa", "a")])
    assert twice.encode_word(list("aaaaa")) == [1, 2] and twice.encode_word(list("aaaa")) == [1, 1]


def test_bpe_query_and_odd_texts(spark, library):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    for frame, found in ((docs, QUERIES["op7_bpe"](spark, SMALL)), (odd_docs(spark), bpe.bpe_round_trip(odd_docs(spark)))):
        want = []
        for row in frame.collect():
            ids = library.encode(row.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((row.doc_id, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.bpe_round_trip(docs.limit(0)).count() == 0
    back = odd_docs(spark).select("text", bpe.encode_column("text").alias("ids")).select("text", bpe.decode_column("ids").alias("back"))
    for r in back.collect():
        assert r.back == library.decode(library.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False)


def packed_well(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("odd", [False, True])
def test_packing_against_library(spark, library, odd):
    docs = odd_docs(spark) if odd else table(spark, SMALL, "documents")
    rows = (packing.pack_documents(docs.repartition(20)) if odd else QUERIES["op2_best_fit_packing"](spark, SMALL)).collect()
    want = []
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 4096):
            part = ids[start : start + 4096]
            want.append((row.doc_id, start // 4096, start, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    assert len(rows) == len(want)
    least = -(-sum(w[3] for w in want) // 4096)
    assert packed_well(rows, 4096) <= least * 1.02 + 1


def test_texts_are_encoded_many_at_once(library, monkeypatch):
    """Equal to the library for any grouping of texts; a group asks it once for its new words, not once per text."""
    rnd = random.Random(7)
    latin = [chr(c) for c in range(0x180) if bpe._PLAIN.fullmatch(chr(c))]
    texts = [*ODD, "'s's", "''s", "x'll've", "'d9'm'", "'", "'r", "it's 'sun é's'é 12'34's5", "a_b'_s", "'RE'\t\n\x0b\x0c\r'S", "\x1c's"]
    for alphabet in ("'" * 5 + "strevmld0 9é.!\n\tSÀ", latin, [*latin, "漢", "́", "²", "\0", "<|"]):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["it's " * 900, "x" * 3000, ""]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    coder = packing.LibraryWords(tokenizer_file(bpe.TOKENIZER))
    assert [coder.encode(t) for t in texts] == want and list(coder.encode_all([])) == []
    for size in (1, 1000, 1_000_000):
        monkeypatch.setattr(packing, "CHARACTERS_AT_ONCE", size)
        assert list(packing.LibraryWords(tokenizer_file(bpe.TOKENIZER)).encode_all(iter(texts))) == want

    class Counted:
        calls = 0

        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, *args, **options):
            self.calls += 1
            return self.inner.encode_batch_fast(*args, **options)

    coder = packing.LibraryWords(tokenizer_file(bpe.TOKENIZER))
    coder._words = Counted(coder._words)
    group = [f"{a}{b} new" for a in "abcdefghij" for b in "klmnopqrst"]
    assert list(coder.encode_all(group)) == [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(group, add_special_tokens=False)]
    assert coder._words.calls == 1


def test_packing_in_many_partitions_and_small_nodes(spark):
    """Up the tree with tiny carries: nothing is lost, and the packing stays close to the least number."""
    rnd = random.Random(5)
    sizes = [rnd.randint(0, 90) for _ in range(3000)]
    docs = spark.createDataFrame([(k, "x" * n) for k, n in enumerate(sizes)], "doc_id long, text string").repartition(40)
    encode = lambda: lambda text: b"\1\0\0\0" * len(text)
    for carried, slack in ((10_000, 1.06), (5, 1.2)):
        rows = packing.pack_tokens(docs, "doc_id", "text", encode, capacity=100, nearly_full=0, fan_in=3, carried=carried).collect()
        assert sorted(r.doc_id for r in rows) == list(range(3000))
        assert packed_well(rows, 100) <= slack * (sum(sizes) + 3000) / 100 + 1
    assert packing.pack_tokens(docs.limit(0), "doc_id", "text", encode).count() == 0
    assert packing.pack_tokens(docs.filter("text = ''"), "doc_id", "text", encode, end_of_document=None).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.asarray([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and fills.tolist() == [10, 10]


def test_token_counts_against_library(spark, library):
    library.encode_special_tokens = True
    try:
        for frame, found in ((table(spark, SMALL, "documents"), QUERIES["op3_token_counts"](spark, SMALL)), (odd_docs(spark), token_counts.count_tokens(odd_docs(spark)))):
            want = [(r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in frame.collect()]
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    finally:
        library.encode_special_tokens = False
    assert token_counts.count_tokens(odd_docs(spark).limit(0)).count() == 0


def test_separator_scan_over_block_borders(spark):
    rnd = random.Random(2)
    rows, want = [], []
    for file in range(12):
        flat = [rnd.choice([7, 7, 7, 1, 2]) if file % 3 else rnd.choice([1, 2]) for _ in range(rnd.randint(0, 60))]
        for block in range(0, len(flat) + 4, 4):
            rows.append((f"f{file}", block, np.asarray(flat[block : block + 4], "<u2").tobytes() if rnd.random() > 0.1 or flat[block : block + 4] else None))
        documents, current = [], 0
        for token in flat:
            if token == 7:
                documents.append((current, True))
                current = 0
            else:
                current += 1
        if current:
            documents.append((current, False))
        want += [(f"f{file}", k, n, t) for k, (n, t) in enumerate(documents)]
    blocks = spark.createDataFrame(rows, "file string, block long, tokens binary").repartition(5)
    assert sorted(map(tuple, token_counts.scan_separators(blocks, 7).collect())) == sorted(want)
    assert token_counts.scan_separators(blocks.limit(0), 7).count() == 0


def test_raw_token_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.asarray([3, 9, 9, 4, 4, 9, 5], "<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    found = token_counts.scan_separators(token_counts.raw_token_files(spark, str(tmp_path)), 9).collect()
    assert sorted((r.ordinal, r.n_tokens, r.terminated) for r in found) == [(0, 1, True), (1, 0, True), (2, 2, True), (3, 1, False)]


def test_raw_token_files_of_other_stores_are_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "_in_ranges", lambda file: False)
    (tmp_path / "a.bin").write_bytes(np.asarray([3, 9, 9, 4], "<u2").tobytes())
    found = token_counts.raw_token_files(spark, str(tmp_path), block_tokens=2).collect()
    assert [(r.block, len(r.tokens)) for r in found] == [(0, 8)]


def test_raw_token_files_are_read_in_ranges(spark, tmp_path):
    flat = [np.random.default_rng(k).integers(0, 12, size).astype("<u2") for k, size in enumerate((1, 8, 9, 1000))]
    (tmp_path / "of tokens").mkdir()
    for k, tokens in enumerate(flat):
        (tmp_path / "of tokens" / f"f{k}.bin").write_bytes(tokens.tobytes())
    blocks = token_counts.raw_token_files(spark, str(tmp_path / "of tokens"), block_tokens=8)
    assert sorted((r.file[-6:], r.block, len(r.tokens)) for r in blocks.collect()) == [(f"f{k}.bin", b, 2 * len(t[8 * b : 8 * b + 8])) for k, t in enumerate(flat) for b in range(-(-len(t) // 8))]
    want = []
    for k, tokens in enumerate(flat):
        ends = np.flatnonzero(tokens == 9)
        lengths = np.diff(np.concatenate([[-1], ends, [len(tokens)]])) - 1
        want += [(f"f{k}.bin", n, int(size), n < len(ends)) for n, size in enumerate(lengths) if n < len(ends) or size]
    assert sorted((r.file[-6:], r.ordinal, r.n_tokens, r.terminated) for r in token_counts.scan_separators(blocks, 9).collect()) == want


def digests(turns):
    learned = "".join(x for r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_chat_query_reads_back(spark):
    turns = defaultdict(list)
    for r in sorted(table(spark, SMALL, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    found = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op9_chat_format"](spark, SMALL).collect()}
    assert found == {k: digests(v) for k, v in turns.items()}


def test_grammar_round_trip():
    rnd = random.Random(1)
    pieces = ["\\", "[", "<", "]", " ", "\n", "[INST] ", " [/INST]", "</s>", "a", "<<SYS>>\n", "[ROLE=", "[/ROLE]", "[REPLY] ", "\n<</SYS>>\n", "é"]
    for _ in range(5000):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", "", "x] y", "\\"]), "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9)))) for _ in range(3)]
        assert [t[:2] for t in chat_format.parse("".join(chat_format.render_turn(*t) for t in turns))] == turns
    assert chat_format.render_turn("user", "plain [x] text") == "[INST] plain [x] text [/INST]"
    for broken in ("text", "[INST] open", "</s>", "[INST] x\\"):
        with pytest.raises(ValueError):
            chat_format.parse(broken)


def test_chat_parts_and_odd_rows(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"t{k} </s> \\ é") for k in range(300)]
    rows += [(2, None, None, None), (2, 0, "tool", ""), (2, 0, "tool", ""), (None, 1, "user", "x"), (3, 0, "user", "long " * 50_000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    parts = chat_format.format_conversations(frame, part_chars=200)
    assert parts.filter("conv_id = 1").count() > 10
    found = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(parts).collect()}
    want = {
        1: [(r, x) for _, _, r, x in rows[:300]],
        2: [("", ""), ("tool", ""), ("tool", "")],
        None: [("user", "x")],
        3: [("user", "long " * 50_000)],
    }
    assert found == {k: digests(v) for k, v in want.items()}
    assert chat_format.read_back(chat_format.format_conversations(frame.limit(0))).count() == 0
