"""BPE encoding and decoding (operator 9) by prefix-sharing trie traversal.

A text is split into words as the tokenizer's pre-tokenizer does. The distinct
words of a batch that are not yet known go into a trie, and a depth-first
walk carries the last token of every prefix's encoding: the encoding of a
prefix ends in the one token that is a suffix of it and is compatible with
the last token of what stands before it, so each prefix costs one step, and a
prefix that many words share is encoded once. Two tokens are compatible when
merging would leave them apart if they stood next to each other.

Scale: encoding is a map over documents, without a shuffle. A worker keeps
the encodings of the words it has met up to ``KNOWN_WORDS`` and starts anew
beyond that; long words are walked like the others, the walk needing memory
for one path only.

``encode`` adds the ids as unsigned 32-bit little-endian integers in one binary
value, ``decode`` gives back the text. Defined results: a null text is empty
and has no ids; special tokens inside a text become their ids, as in the
library's default; invalid UTF-8 after decoding becomes U+FFFD.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.llm.runtime import ship, tidy

KNOWN_WORDS = 100_000
KNOWN_PAIRS = 100_000
LONG_WORD = 200         # bytes; beyond, no encoding is kept per prefix

# Fixed value: the byte-level pre-tokenizer's pattern; alternatives that start
# with different characters stand with the most frequent first.
WORDS = r"""(?> ?\p{L}+)|'(?:s|t|re|ve|m|ll|d)|(?> ?\p{N}+)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable
    bytes are themselves, the others follow in order from code point 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Trie:
    """Distinct words as a trie in array form: the words in order, and how many
    bytes of each lie on the path of the one before it. Reading the arrays
    from left to right is the depth-first traversal of the trie: a word first
    goes back up to the shared depth and then down its own bytes."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = sorted(words)
        self.shared = [0] * len(words)
        before = b""
        for i, w in enumerate(self.words):
            n = min(len(before), len(w))
            if before[:n] != w[:n]:
                n = 0
                while before[n] == w[n]:
                    n += 1
            self.shared[i] = n
            before = w


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizers ``.json`` file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.ids = {bytes(letters[c] for c in token): i for token, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) \
            if self.specials else None
        self.words = regex.compile(WORDS)
        # A merge: the rank of each pair, and for each merged token its rank and parts.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = r
            self.made.setdefault(vocab[left + right], (r, a, b))
        self.apart: dict[tuple[int, int], bool] = {}
        self.packed = {i: i.to_bytes(4, "little") for i in [*self.ids.values(), *self.specials.values()]}
        self.known: dict[str | int, bytes] = {}
        self.forget()

    def compatible(self, a: int, b: int) -> bool:
        """Whether neighbours ``a`` and ``b`` stay as they are.

        Their merges are undone from the latest to the earliest; the pair that
        faces each other at the border must never have been merged before the
        merge that is undone next. At equal rank the leftmost merge comes
        first, so the left token's is undone last.
        """
        known = self.apart.get((a, b))
        if known is not None:
            return known
        left, right, before = a, b, float("inf")
        while True:
            r = self.rank.get((left, right))
            if r is not None and r < before:
                ok = False
                break
            lm, rm = self.made.get(left), self.made.get(right)
            if lm is None and rm is None:
                ok = True
                break
            if rm is None or (lm is not None and lm[0] > rm[0]):
                before, left = lm[0], lm[2]
            else:
                before, right = rm[0] + 0.5, rm[1]
        if len(self.apart) > KNOWN_PAIRS:
            self.apart.clear()
        self.apart[a, b] = ok
        return ok

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct words, by a depth-first walk of their trie.

        The walk holds one path: for each depth the last token of that
        prefix's encoding, where it starts, and on words of usual length the
        encoding itself.
        """
        out: dict[bytes, bytes] = {}
        for long, group in ((False, [w for w in words if len(w) <= LONG_WORD]),
                            (True, [w for w in words if len(w) > LONG_WORD])):
            trie = Trie(group)
            ids, apart, packed = self.ids, self.apart, self.packed
            last, begin, path = [-1], [0], [b""]
            for w, depth in zip(trie.words, trie.shared):
                del last[depth + 1:], begin[depth + 1:], path[depth + 1:]
                for end in range(depth + 1, len(w) + 1):
                    start = end - 1
                    while True:
                        token = ids.get(w[start:end])
                        if token is not None:
                            if start == 0:
                                break
                            ok = apart.get((last[start], token))
                            if ok or (ok is None and self.compatible(last[start], token)):
                                break
                        start -= 1
                    last.append(token)
                    begin.append(start)
                    if not long:
                        path.append(path[start] + packed[token])
                if long:
                    tokens, at = [], len(w)
                    while at:
                        tokens.append(packed[last[at]])
                        at = begin[at]
                    out[w] = b"".join(tokens[::-1])
                else:
                    out[w] = path[len(w)]
        return out

    def forget(self) -> None:
        """Start the known words anew; special tokens, by id, are always known."""
        self.known.clear()
        self.known.update((i, self.packed[i]) for i in self.specials.values())

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed unsigned 32-bit little-endian integers."""
        split = [self._split(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        known = self.known
        new = list(set().union(*split).difference(known))
        raws = [w.encode("utf-8", "surrogatepass") for w in new]
        encoded = self.encode_words(raws)
        for w, raw in zip(new, raws):
            known[w] = encoded[raw]
        return [b"".join(map(known.__getitem__, parts)) for parts in split]

    def _split(self, text: str) -> list[str | int]:
        """Words as strings, special tokens as their ids."""
        if not any(s in text for s in self.specials):
            return self.words.findall(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self.words.findall(text[at:m.start()])
            out.append(self.specials[m[0]])
            at = m.end()
        return out + self.words.findall(text[at:])


def token_bytes(spec: dict) -> dict[int, bytes]:
    """The bytes of each id, special tokens as they are written."""
    letters = byte_letters()
    plain = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    return plain | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


def decoder(path: str) -> Callable[[bytes], str]:
    """The function from packed ids to text; it needs the tokens only, not
    the merges."""
    if path not in _TOKENS:
        with open(path, encoding="utf-8") as f:
            _TOKENS[path] = token_bytes(json.load(f))
    of = _TOKENS[path].__getitem__

    def decode_ids(ids: bytes) -> str:
        return b"".join(map(of, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
    return decode_ids


_LOADED: dict[str, Bpe] = {}
_TOKENS: dict[str, dict[int, bytes]] = {}


def load_bpe(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


BATCH_CHARS = 1_000_000


def _groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with the values of a column, of bounded total size."""
    group, total, first = [], 0, 0
    for i, value in enumerate(batch.column(column)):
        group.append(value.as_py())
        total += len(group[-1] or "")
        if total > BATCH_CHARS or i + 1 == batch.num_rows:
            yield batch.slice(first, len(group)), group
            group, total, first = [], 0, i + 1


def _encoder(path: str, column: str, added: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(path)
        for batch in batches:
            for part, texts in _groups(batch, column):
                ids = bpe.encode_batch([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())],
                                                 names=[*part.schema.names, added])
    return run


def _decoder(path: str, column: str, added: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_ids = decoder(path)
        for batch in batches:
            for part, ids in _groups(batch, column):
                texts = [decode_ids(i or b"") for i in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, added])
    return run


def _added(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    df = df.drop(*[c for c in df.columns if c.lower() == name])
    return df, T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the binary column ``ids``."""
    ship(df.sparkSession)
    df, schema = _added(df, ids, T.BinaryType())
    return df.mapInArrow(tidy(_encoder(tokenizer, text, ids)), schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the string column ``decoded``."""
    ship(df.sparkSession)
    df, schema = _added(df, text, T.StringType())
    return df.mapInArrow(tidy(_decoder(tokenizer, ids, text)), schema)


def encoded_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    there = decode(encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), tokenizer)
                   .select("doc_id", "ids"), tokenizer)
    return there.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
