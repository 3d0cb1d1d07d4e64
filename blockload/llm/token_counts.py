"""Token counts through a digest cache (operator 6).

A text's key is the digest of its normalised content and the digest of the
tokenizer's file. Normalising only joins runs of white space and trims, which
the tokenizer undoes to the same effect (``collapses_space`` checks that it
drops white space; otherwise the text itself is digested). Keys are joined to
the cache, a Parquet table; one text of each key that it lacks is encoded, by
the tokenizers library, and the new counts are appended.

Scale: one scan digests the texts and stores (doc_id, size, key), which all else
is joined to. A second scan gives each task's distinct texts, of which those that
the cache lacks are shuffled by key and met once each; without a miss it does not
run. So a hot text travels once a task, and is encoded once however many rows
hold it and whatever their ids. A cache can be shared by runs: it is only
appended to, and doubled keys of concurrent writers are merged on reading.

Where the tokenizer provably works word by word (``word_by_word``), a text's
count is the sum over its words, and the library encodes each distinct word
once per worker, not each text.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows and ties give one result each; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.llm.runtime import pick, ship, staged, tidy
from blockload.session import new_path

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"
PIECE_CHARS = 200_000   # longer texts are encoded in pieces that end at white space
KNOWN_WORDS = 200_000   # words whose counts a worker keeps
KNOWN_CHARS = 100       # longer words are not kept
SEEN_TEXTS = 500_000    # keys of which a task remembers that it gave their text

# Fixed value: a way of splitting that never joins what white space separates.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer's file; the file's content is its version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def collapses_space(path: str) -> bool:
    """Whether a .json tokenizer first turns white space runs into one space
    and then drops it, so that their length and kind cannot matter."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    joined = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " "
                 for s in steps)
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    dropped = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
                  and r"[^\s\p{L}\p{N}]+" in s.get("pattern", {}).get("Regex", "") for s in splits)
    strips = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
    return joined and dropped and not strips


def word_by_word(path: str) -> bool:
    """Whether the parts of a text between white space are encoded each by
    itself: the steps before the model are of the kinds listed, split by the
    known pattern, and no added token has white space in it."""
    if not collapses_space(path):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
    splits = spec["pre_tokenizer"]["pretokenizers"]
    return (set(steps) <= {"NFC", "Replace", "Lowercase"} and steps.count("Replace") == 1
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"] == {"Regex": WORD_SPLIT} and not splits[1]["add_prefix_space"]
            and not splits[1]["use_regex"] and spec["model"]["type"] == "BPE"
            and not any(any(c.isspace() for c in t["content"]) for t in spec["added_tokens"]))


def content_digest(raw: bytes, collapse: bool) -> str:
    """Digest of a text's bytes; ``split`` parts at space and the code points 9 to 13."""
    return hashlib.sha256(b" ".join(raw.split()) if collapse else raw).hexdigest()


def _raw(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _keyed(collapse: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [_raw(t) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([content_digest(r, collapse) for r in raws], pa.string())],
                names=["doc_id", "n_bytes", "content"])
    return run


def _texts(collapse: bool):
    """(content, text), as a rule once for each key of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            keys, rows = [], []
            for i, t in enumerate(batch.column("text")):
                key = content_digest(_raw(t), collapse)
                if key not in seen:
                    if len(seen) >= SEEN_TEXTS:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    rows.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column("text").take(pa.array(rows, pa.int64()))],
                                             names=["content", "text"])
    return run


_LOADED: dict[str, object] = {}


def load_tokenizer(path: str):
    """The library's tokenizer, once per worker: ``.json`` by tokenizers,
    ``.model`` by sentencepiece; returns a function from texts to counts."""
    if path in _LOADED:
        return _LOADED[path]
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def count(texts: list[str]) -> list[int]:
            return [len(ids) for ids in model.encode(texts, num_threads=1)]
    else:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()

        def count(texts: list[str]) -> list[int]:
            return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    _LOADED[path] = count
    return count


def _pieces(text: str, size: int) -> list[str]:
    """``text`` cut before white space, about every ``size`` characters."""
    out, at = [], 0
    while len(text) - at > size:
        cut = next((i for i in range(at + size, len(text)) if text[i] in " \t\n\r"), len(text))
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


_KNOWN: dict[str, dict[bytes, int]] = {}


def count_words(path: str, texts: list[bytes]) -> list[int]:
    """Tokens of each text, by its words; words that the worker does not know
    yet are encoded by the library."""
    count, known = load_tokenizer(path), _KNOWN.setdefault(path, {})
    if len(known) > KNOWN_WORDS:
        known.clear()
    found = [Counter(t.split()) for t in texts]
    new = list(set().union(*found).difference(known))
    if new:
        known.update(zip(new, count([w.decode("utf-8") for w in new])))
    sums = [sum(map(mul, words.values(), map(known.__getitem__, words))) for words in found]
    for w in new:
        if len(w) > KNOWN_CHARS:
            del known[w]
    return sums


def _counter(path: str, collapse: bool, by_word: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_tokenizer(path)
        for batch in batches:
            keys, counts = batch.column("content"), []
            texts = batch.column("text")
            if by_word:
                for start in range(0, batch.num_rows, 64):
                    counts += count_words(path, [_raw(t) for t in texts.slice(start, 64)])
                yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["content", "n_tokens"])
                continue
            for start in range(0, batch.num_rows, 16):  # few texts at a time bound the encodings held
                group, owner = [], []
                for i, text in enumerate(texts.slice(start, 16).to_pylist()):
                    for piece in _pieces(text, PIECE_CHARS) if collapse else [text]:
                        group.append(piece)
                        owner.append(i)
                sums = [0] * min(16, batch.num_rows - start)
                for i, n in zip(owner, count(group)):
                    sums[i] += n
                counts += sums
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["content", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts, one row per key; none before the first append."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache)
            .groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens")))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    ``cache`` is a folder that keeps counts between calls; without one the
    call gets its own under the work folder. Misses are encoded and appended
    before the result is returned.
    """
    spark = docs.sparkSession
    ship(spark)
    cache = cache or new_path(spark, "token-cache")
    version, collapse = tokenizer_digest(tokenizer), collapses_space(tokenizer)
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = staged(rows.mapInArrow(tidy(_keyed(collapse)), "doc_id long, n_bytes long, content string"), "token-keys")

    def stored() -> DataFrame:
        return read_cache(spark, cache).where(F.col("tokenizer") == version).select("content", "n_tokens")

    misses = staged(keyed.select("content").distinct().join(stored(), "content", "left_anti"), "token-misses")
    if not misses.isEmpty():
        texts = rows.select("text").mapInArrow(tidy(_texts(collapse)), "content string, text string")
        chosen = texts.join(misses, "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
        counted = chosen.mapInArrow(tidy(_counter(tokenizer, collapse, word_by_word(tokenizer))),
                                    "content string, n_tokens long")
        counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(stored(), "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
