import random
import struct
import zlib

import numpy as np
import pytest
from helpers import EDGE_ROWS, edge_docs, empty_docs

from ledgerline.llm import bpe, dac
from ledgerline.llm.common import word_bpe
from ledgerline.session import scratch_path

ODD = ["a<|endoftext|>b <|ENDOFTEXT|>  x\x1cy z\tq\r\nË́é ١٢ 日本語   ΑΣ ß İ don't 'S it's'll 's's a😀b ’re", "", " ", "\n\n", "x" * 5000,
       "ab" * 3000 + "1234567890" * 10, "́a <|startoftext|><|endoftext|>", "\U0001f468‍\U0001f469", "가 각", "’", "ªº µ Straße ÀÉ×÷   x"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_bpe())


@pytest.fixture(scope="module")
def spec():
    return open(word_bpe(), encoding="utf-8").read()


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_trie_equals_library_on_odd_texts(library, spec):
    enc = bpe.TextEncoder(bpe.Vocabulary(spec))
    for t in ODD:
        ids = library.encode(t, add_special_tokens=False).ids
        assert enc(t) == packed(ids), t
        assert enc.decode(packed(ids)) == library.decode(ids, skip_special_tokens=False)


def test_trie_equals_library_on_random_words_after_resets(library, spec, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_NODES", 200)
    monkeypatch.setattr(bpe, "MAX_WORDS", 50)
    rnd = random.Random(2)
    enc = bpe.TextEncoder(bpe.Vocabulary(spec))
    for _ in range(30):
        t = " ".join("".join(rnd.choices("etaoinshrdlué.'", k=rnd.randint(1, 12))) for _ in range(60))
        assert enc(t) == packed(library.encode(t, add_special_tokens=False).ids)


def test_shared_prefixes_are_computed_once(spec):
    trie = bpe.TrieEncoder(bpe.Vocabulary(spec))
    trie.encode(["thinking"])
    nodes = len(trie.last)
    trie.encode(["thinkers"])
    assert len(trie.last) == nodes + 3  # "e", "r" and the closing "s" are new; "think" is not


def test_encode_rows(spark, library):
    docs = edge_docs(spark, clash=["ids", "n_tokens", "decoded"])
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode(docs, word_bpe(), decoded=True).collect()), key=str)
    want = []
    for i, t in EDGE_ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), packed(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    assert bpe.encode(empty_docs(spark), word_bpe()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_random_access_and_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = np.concatenate([rnd.integers(0, 1 << bits, n // 4 + 1) for bits in (7, 9, 17, 32)])[:n].astype("<u4")
    rnd.shuffle(ids)
    docs, counts = [3, None, 5], [n // 2, 0, n - n // 2]
    data = dac.pack_segment(1, 2, docs, counts, ids) + b"\n" + dac.pack_segment(1, 3, [], [], ids[:0]) + b"\n"
    a, b = dac.segments(data)
    assert (a.all_tokens() == ids).all() and a.doc_ids == docs and a.counts.tolist() == counts and b.n_tokens == 0
    assert [a.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        a.token(n)
    with pytest.raises(ValueError, match="cut short"):
        dac.Segment(memoryview(data[:60]))


def test_files_hold_documents_in_order(spark, library, monkeypatch):
    path = scratch_path(spark, "tokens-test")
    dac.write_tokens(edge_docs(spark, clash=["id", "shard"]), path, word_bpe(), shards=4)
    docs = dac.read_documents(spark, path)
    got = sorted(((r.start, r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in dac.with_starts(docs, dac.segment_starts(spark, path)).collect()))
    want, start = [], 0
    for i, t in sorted(EDGE_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = packed([*library.encode(t or "", add_special_tokens=False).ids, 2])
        want.append((start, i, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == want


def test_empty_table_gives_no_segments(spark):
    path = scratch_path(spark, "tokens-test")
    dac.write_tokens(empty_docs(spark), path, word_bpe())
    assert dac.read_documents(spark, path).count() == 0 and dac.segment_starts(spark, path).count() == 0


def test_library_encoder_equals_library_and_keeps_words_between_tasks(library, spec, monkeypatch):
    enc = dac.LibraryEncoder(spec, bpe.Vocabulary(spec))
    own = [library.encode(t, add_special_tokens=False).ids for t in ODD]
    texts = [*ODD, None, *ODD[::-1]]
    for _ in range(2):
        ids, n, _ = enc(texts)
        assert n.tolist() == [len(x) for x in [*own, [], *own[::-1]]]
        assert ids.tolist() == [i for x in [*own, [], *own[::-1]] for i in x]
        enc.release()  # as at a task's end; the library is not asked again for words met by the task before
        monkeypatch.setattr(enc, "library", None)


@pytest.mark.parametrize("words, ids", [(30, 1 << 23), (400_000, 40), (1, 1)])
def test_library_encoder_begins_anew_when_full(library, spec, monkeypatch, words, ids):
    monkeypatch.setattr(dac, "WORDS", words)
    monkeypatch.setattr(dac, "WORD_IDS", ids)
    rnd = random.Random(4)
    enc = dac.LibraryEncoder(spec, bpe.Vocabulary(spec))
    for _ in range(20):
        texts = [" ".join("".join(rnd.choices("etaoinshrdlué.'١", k=rnd.randint(1, 9))) for _ in range(rnd.randint(0, 25))) for _ in range(3)]
        got, n, _ = enc([*texts, "a<|endoftext|>b"])
        want = [library.encode(t, add_special_tokens=False).ids for t in [*texts, "a<|endoftext|>b"]]
        assert n.tolist() == list(map(len, want)) and got.tolist() == [i for x in want for i in x]
