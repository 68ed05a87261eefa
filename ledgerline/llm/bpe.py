"""BPE encoding by a prefix-sharing trie, and decoding.

Texts are normalised and cut into words as the vocabulary file asks.  Distinct
words not met before are inserted into a trie in sorted order, that is depth
first.  Each node holds the
last token of the encoding of its prefix: the one token that ends the prefix
and whose pair with the last token of the shorter prefix before it survives
merging.  A word's ids follow from the pointers to those shorter prefixes, so
the encoding of a prefix shared by many words is computed once.

The words' ids and the trie are kept by a task up to fixed numbers of entries,
then dropped and rebuilt; that bounds memory and changes no result.

Defined cases: a null text encodes like an empty one (no ids); null ids of the
id column pass through; repeated rows are encoded one by one; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import col

END = "</w>"
MAX_WORDS = 400_000
MAX_NODES = 600_000
NEVER = 1 << 60  # rank of a merge that does not exist


class Vocabulary:
    """Merges, ids, normaliser and pre-tokeniser of a ``tokenizers`` BPE file."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or model.get("continuing_subword_prefix") \
                or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("the trie encoder needs a plain BPE file with word ends")
        if spec.get("decoder") is not None or spec.get("post_processor") is not None:
            raise ValueError("decoders and post-processors are not supported")
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.longest = max(map(len, self.ids))
        library = Tokenizer.from_str(text)
        self.normalise, self.pre_tokenise = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        added = spec.get("added_tokens") or []
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("only added tokens that match as they stand are supported")
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_at = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.latin = all(spec.get(k) == x for k, x in LATIN_SPEC.items()) and all("<|" in t for t in self.added)
        self.byte_char = {i: c for i, c in enumerate(map(chr, range(256)))}
        shown = [i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or 174 <= i <= 255]
        self.byte_char |= {i: chr(256 + n) for n, i in enumerate(i for i in range(256) if i not in shown)}
        self.token = [""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for t, i in [*self.ids.items(), *self.added.items()]:
            self.token[i] = t

        # Per token id: the two tokens whose merge makes it, and that merge's rank.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.pair_rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            if whole in self.made or any(x in self.made and self.made[x][2] > rank for x in (left, right)):
                raise ValueError("merges must make each token once, after its parts")
            self.made[whole] = (left, right, rank)
            self.pair_rank[left << 32 | right] = rank

    def byte_mapped(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.byte_char)

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts along the left (0) or right (1) edge of a token's merge tree, smallest first, each with
        the rank of the merge that takes it in."""
        parts, rank = [], NEVER
        while True:
            parts.append((token, rank))
            if token not in self.made:
                return parts[::-1]
            rank, token = self.made[token][2], self.made[token][side]

    def apart(self, left: list[tuple[int, int]], right: list[tuple[int, int]]) -> bool:
        """Whether no merge joins the two tokens' inner edges before both are complete.

        ``left`` is the right edge of the left token, ``right`` the left edge
        of the right one.  Merges run by rank, equal ones from the left.
        """
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = left[i], right[j]
            if x_taken == y_taken == NEVER:
                return True
            rank = self.pair_rank.get(x << 32 | y, NEVER)
            if rank < x_taken and rank <= y_taken:
                return False
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1


class TrieEncoder:
    """Encodes words; nodes persist between calls."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.pair_ok: dict[int, bool] = {}
        self.whole_ok: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # by node, word end and symbol
        self.last: list[int] = [-1]    # last token of the prefix's encoding
        self.before: list[int] = [-1]  # node of the prefix without that token
        if len(self.pair_ok) > MAX_NODES:
            self.pair_ok.clear()

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        key = (token, side)
        if key not in self.edges:
            self.edges[key] = self.v.edge(token, side)
        return self.edges[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens gives just the two tokens."""
        key = left << 32 | right
        ok = self.pair_ok.get(key)
        if ok is None:
            ok = self.pair_ok[key] = (key not in self.v.pair_rank and self.whole(right)
                                      and self.v.apart(self.edge(left, 1), self.edge(right, 0)))
        return ok

    def whole(self, token: int) -> bool:
        """Whether merging a token's own symbols gives the token."""
        ok = self.whole_ok.get(token)
        if ok is None:
            made = self.v.made.get(token)
            ok = self.whole_ok[token] = made is None or (
                self.whole(made[0]) and self.whole(made[1])
                and self.v.apart(self.edge(made[0], 1), self.edge(made[1], 0)))
        return ok

    def add(self, path: list[int], word: str, k: int, end: bool) -> int:
        """New node for ``word[:k]`` (closed by the word end if ``end``); ``path`` has the nodes of its prefixes."""
        suffix = END if end else ""
        ids, last = self.v.ids, self.last
        for start in range(max(0, k - self.v.longest), k):
            token = ids.get(word[start:k] + suffix)
            if token is not None and (self.whole(token) if start == 0 else self.fits(last[path[start]], token)):
                self.last.append(token)
                self.before.append(path[start])
                return len(self.last) - 1
        raise ValueError(f"no token ends {word[:k]!r}")

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of byte-mapped words, as little-endian unsigned 32-bit integers; sorted words share most work."""
        out = []
        for word in words:
            if len(self.last) > MAX_NODES:
                self.clear()
            path, node, child, n = [0], 0, self.child, len(word)
            for k, c in enumerate(word, 1):
                key = node << 10 | (k == n) << 9 | ord(c)
                at = child.get(key)
                if at is None:
                    at = child[key] = self.add(path, word, k, k == n)
                node = at
                path.append(node)
            ids = []
            while node:
                ids.append(self.last[node])
                node = self.before[node]
            out.append(array("I", ids[::-1]).tobytes())
        return out


# Latin-1 text of these bytes only is cut by LATIN_CUT as the library cuts it:
# no other letters or digits, nothing that composes or expands.
LATIN_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
LATIN_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
# Fixed value: the normaliser and cut that LATIN_CUT stands for.
LATIN_SPEC = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


# What stands apart from words of letters, which white space is put around to cut as LATIN_CUT does.
LATIN_APART = "(" + LATIN_CUT.pattern.replace("[a-zß-öø-ÿ]+|", "") + ")"


def laid_out(table: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, number of each) from the distinct words' ids (a stretch of ``table`` each), the
    distinct word that each word is, and the number of words of each text."""
    k = size[which]
    total = np.concatenate([[0], np.cumsum(k, dtype=np.int32)]).astype(np.int32)  # of a few MB of text
    at = np.repeat(start[which] - total[:-1], k)
    at += np.arange(total[-1], dtype=np.int32)
    return table[at], np.diff(total[np.concatenate([[0], np.cumsum(n)])]).astype(np.int64)


class BatchEncoder:
    """Ids of many texts at once, through a bounded table of the words met.

    Words of a batch become numbers, and each distinct one is looked up once.
    Texts of LATIN_BYTES are cut together; the others one by one, by the
    library's own normaliser and pre-tokeniser.
    """

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.trie = TrieEncoder(vocab)
        self.words: dict[str, bytes] = {}

    def release(self) -> None:
        """Give back the memory of the words and the trie; what the worker keeps is the vocabulary."""
        self.words = {}
        self.trie.clear()
        self.trie.pair_ok.clear()
        pa.default_memory_pool().release_unused()

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, new ones encoded in byte-mapped order.

        A word that is byte-mapped already has a space after it, which tells it
        from words of Latin texts."""
        known = self.words
        new = [w for w in words if w not in known]
        if len(known) + len(new) > MAX_WORDS:
            known.clear()
            new = words
        if new:
            pairs = sorted((w[:-1] if w[-1] == " " else self.v.byte_mapped(w), w) for w in new)
            known.update(zip([w for _, w in pairs], self.trie.encode([m for m, _ in pairs])))
        return list(map(known.__getitem__, words))

    def latin(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts as a dictionary array, number of each text's) of texts of LATIN_BYTES in lower case."""
        spaced = pc.replace_substring_regex(pa.array(texts, pa.large_string()), LATIN_APART, r" \1 ")
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
        return split.flatten().dictionary_encode(), np.diff(split.offsets.to_numpy())

    def other(self, text: str) -> list[str]:
        """A text's byte-mapped words, each with a space after it, and added tokens, with a line feed."""
        out = []
        for span in (self.v.added_at.split(text) if self.v.added_at else [text]):
            if span in self.v.added:
                out.append(span + "\n")
            elif span:
                out += [w + " " for w, _ in self.v.pre_tokenise(self.v.normalise(span))]
        return out

    def cut(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts as a dictionary array, number of each text's); a null text is an empty one."""
        lower, others = [], {}
        for i, text in enumerate(texts):
            text = text or ""
            try:
                if self.v.latin and "<|" not in text and not text.encode("latin-1").translate(None, LATIN_BYTES):
                    lower.append(text.lower())
                    continue
            except UnicodeEncodeError:
                pass
            lower.append("")
            others[i] = self.other(text)
        words, n = self.latin(lower)
        if others:  # an empty text stands for each of them, as one empty word
            at = np.cumsum(n) - n
            flat, parts, last = words.dictionary_decode(), [], 0
            for i, own in others.items():
                parts += [flat.slice(last, int(at[i]) - last), pa.array(own, pa.large_string())]
                last, n[i] = int(at[i] + n[i]), len(own)
            words = pa.concat_arrays([*parts, flat.slice(last)]).dictionary_encode()
        return words, n

    def __call__(self, texts: list[str | None], decoded: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        """(ids of all texts in a row, number of each, decoded texts if asked); a null text is an empty one."""
        words, n = self.cut(texts)
        known = words.dictionary.to_pylist()
        found = dict.fromkeys(known, b"")
        plain = [w for w in known if w and w[-1] != "\n"]
        found.update(zip(plain, self.ids_of(plain)))
        found.update((w, self.v.added[w[:-1]].to_bytes(4, "little")) for w in known if w and w[-1] == "\n")
        ids = list(found.values())
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        table = np.frombuffer(b"".join(ids), "<u4")
        out, counts = laid_out(table, np.cumsum(size, dtype=np.int32) - size, size, words.indices.to_numpy(), n)
        shown = None
        if decoded:
            each = pa.array([self.decode(x) for x in ids], pa.string()).take(words.indices)
            ends = np.concatenate([[0], np.cumsum(n)])
            shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each), " ")
        return out, counts, shown

    def decode(self, ids: bytes) -> str:
        """Tokens joined by one space, as a file without a decoder decodes."""
        return " ".join(map(self.v.token.__getitem__, memoryview(ids).cast("I").tolist()))


class TextEncoder(BatchEncoder):
    """Ids of one text at a time, as little-endian unsigned 32-bit integers."""

    def __call__(self, text: str | None) -> bytes:
        return super().__call__([text])[0].tobytes()


_ENCODERS: dict[int, BatchEncoder] = {}


def encoder(spec: str) -> BatchEncoder:
    """This worker's encoder of a vocabulary file's text."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = BatchEncoder(Vocabulary(spec))
    return _ENCODERS[key]


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value for each run of ``values`` of the given lengths."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * values.itemsize
    parts = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), parts).cast(pa.binary())


def encode(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and, if asked, ``decoded``.

    The vocabulary file is read once by the driver and sent as a broadcast;
    its size is fixed by the file.  Added tokens in a text count as such, and
    none are added at the ends.
    """
    spark = df.sparkSession
    with open(vocabulary_path, encoding="utf-8") as fh:
        spec = spark.sparkContext.broadcast(fh.read())
    src = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    fields = [T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids", T.BinaryType())]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(spec.value)
        try:
            for batch in batches:
                for at, rows in slices(batch.column(1)):
                    ids, n, shown = enc(rows, decoded)
                    cols = [batch.column(0).slice(at, len(rows)), pa.array(n, pa.int64()), binaries(ids, n)]
                    yield pa.RecordBatch.from_arrays([*cols, shown] if decoded else cols, names)
        finally:
            enc.release()  # idle workers of later stages hold no tables

    return src.mapInArrow(run, T.StructType(fields))


def slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, list]]:
    """Runs of texts or bytes of about ``limit`` length, with the row each starts at."""
    rows, size, at = [], 0, 0
    for value in texts:
        value = value.as_py()
        rows.append(value)
        size += len(value or "")
        if size >= limit:
            yield at, rows
            at, rows, size = at + len(rows), [], 0
    if rows:
        yield at, rows
