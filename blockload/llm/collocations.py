"""Phrase collocation mining (operator 12) over depth-truncated suffix trees,
built by vertical partitioning.

The suffixes of a language's words, cut after three words and at the end of
their piece, form one tree, far too large for a task. It is parted by prefixes:

1. Words are counted over all texts. A word is the prefix of as many suffixes
   as it occurs; where that passes ``PREFIX_SUFFIXES``, its two-word prefixes are
   counted in another pass, and those that pass it too are parted by the whole
   suffix.
2. Prefixes are grouped so that a group holds ``GROUP_SUFFIXES`` on average, the
   memory budget of a task: the number of groups follows the words counted, and
   a prefix's group is a digest of its language and words, so no table of
   prefixes has to travel. A prefix takes up an eighth of a group at most.
3. The texts are read again and each suffix is sent to its group, packed and
   already added up within a few megabytes of text. Each group's subtrees are
   built by themselves: sorted suffixes, whose leaf totals add up to the counts of
   the phrases above them.

A phrase is scored by its counts: the first part of a cut is an ancestor in its
own subtree, the rest is looked up with a join. So every step is a shuffle on
(language, prefix), and a frequent word's suffixes never meet in one task. Long
prefixes are bounded by their number: no more than ``MOST_LONG`` words (or pairs)
can pass the limit, which grows with the words where it must.

Defined results: a null text is empty; a null lang is ``und``; repeated rows
count as often as they stand there; an empty table gives an empty result; extra
columns are not read. Counts may reach 10^16.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockload.llm.runtime import partitions_for, ship, staged, tidy

MIN_COUNT = 10
TOP = 2000
COVERED_PERCENT = 50             # a phrase goes if so much of it lies in one longer candidate
SLICE_BYTES = 8 << 20            # of text whose suffixes are added up before they travel
GROUP_SUFFIXES = 1_000_000
PREFIX_SUFFIXES = GROUP_SUFFIXES // 8
MOST_LONG = 4096

WORDS = "lang string, word string, n long"
PAIRS = "lang string, word string, next string, n long"
PACKED = "grp long, lang string, suffixes binary, counts binary"
PHRASES = "lang string, phrase string, words int, a long, l1 long, l2 long, rest1 string, rest2 string"

# A-Z in lower case; what ends a piece becomes a line feed, what
# separates words a space.
_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r",
                           b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_TWO_WORDS = re.compile(rb"(?:[ \t]*[^ \t]+){0,2}")

Slice = dict[str, list[tuple[bytes, bytes]]]


# --- words of a slice of text ------------------------------------------------------

def _parts(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A text in parts that end before a blank, each with the two words after
    it, which its last suffixes reach into."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        end = max(text.rfind(b" ", at + 1, at + SLICE_BYTES), text.rfind(b"\t", at + 1, at + SLICE_BYTES))
        if end < 0:
            ends = [e for e in (text.find(b" ", at + 1), text.find(b"\t", at + 1)) if e > 0]
            if not ends:
                break
            end = min(ends)
        yield text[at:end], _TWO_WORDS.match(text, end).group()
        at = end
    yield text[at:], b""


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    """Texts by language, some megabytes at a time."""
    held: Slice = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            raw = text.as_py()
            if not raw:
                continue
            for part in _parts(raw.encode("utf-8", "surrogatepass")):
                held.setdefault(lang, []).append(part)
                size += len(part[0])
                if size >= SLICE_BYTES:
                    yield held
                    held, size = {}, 0
    if held:
        yield held


class Tokens:
    """The words of some texts: ``ids`` into ``words``, in order; ``counted``
    tells whether a word belongs to its part, ``ends`` whether a piece ends
    after it."""

    def __init__(self, parts: list[tuple[bytes, bytes]]) -> None:
        data = b"\n".join(a + b for a, b in parts).translate(_LETTERS)
        raw = np.frombuffer(data, np.uint8)
        letter = (raw != 32) & (raw != 10)
        edge = np.diff(np.r_[False, letter, False].view(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(start) + 1, np.int32)
        np.cumsum(stop - start, out=offsets[1:])
        text = raw[letter].tobytes()
        made = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        coded = made.dictionary_encode()
        self.words: pa.BinaryArray = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        line = np.cumsum(raw == 10)[start]
        self.ends = np.r_[line[1:] != line[:-1], True][:len(start)]
        sizes = np.array([len(a) + len(b) + 1 for a, b in parts])
        begin = np.cumsum(sizes) - sizes
        last = begin + np.array([len(a) for a, _ in parts])
        self.counted = start < last[np.searchsorted(begin, start, "right") - 1]

    def suffixes(self) -> np.ndarray:
        """The three words from each counted word on, -1 after a piece's end."""
        ids, ends, none = self.ids, self.ends, np.int64(-1)
        second = np.where(ends, none, np.r_[ids[1:], none][:len(ids)])
        third = np.where(second < 0, none, np.r_[second[1:], none][:len(ids)])
        return np.column_stack([ids, second, third])[self.counted]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in slices(batches):
        for lang, parts in held.items():
            t = Tokens(parts)
            n = np.bincount(t.ids[t.counted], minlength=len(t.words))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), t.words.take(pa.array(some)).cast(pa.string()), pa.array(n[some])],
                names=["lang", "word", "n"])


def _among(words: pa.BinaryArray, wanted: set[bytes]) -> np.ndarray:
    return pc.is_in(words, value_set=pa.array(sorted(wanted), pa.binary())).to_numpy(zero_copy_only=False)


def _pair_counts(long_words: dict[str, set[bytes]]):
    """Counts of the two-word prefixes that begin with a long prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in slices(batches):
            for lang in held.keys() & long_words.keys():
                t = Tokens(held[lang])
                s = t.suffixes()[:, :2]
                s = s[_among(t.words, long_words[lang])[s[:, 0]] & (s[:, 1] >= 0)]
                keys, n = np.unique(s[:, 0] * len(t.words) + s[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), t.words.take(pa.array(keys // len(t.words))).cast(pa.string()),
                     t.words.take(pa.array(keys % len(t.words))).cast(pa.string()), pa.array(n)],
                    names=["lang", "word", "next", "n"])
    return run


# --- suffixes to their groups ------------------------------------------------------

def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
    return h ^ (h >> np.uint64(32))


def _distinct(s: np.ndarray, n_words: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of three words, and how often each stands there."""
    if n_words + 1 < 1 << 21:
        key = ((s[:, 0] + 1) * (n_words + 1) + s[:, 1] + 1) * (n_words + 1) + s[:, 2] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    else:
        order = np.lexsort((s[:, 2], s[:, 1], s[:, 0]))
        t = s[order]
        new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]).any(axis=1)])
    n = np.ones(len(s), np.int64) if counts is None else counts[order]
    return s[order[new]], np.add.reduceat(n, new)


def _packed(n_groups: int, long_words: dict[str, set[bytes]], long_pairs: dict[str, set[bytes]]):
    """A row for each group and language that a slice has suffixes for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in slices(batches):
            for lang, parts in held.items():
                t = Tokens(parts)
                s = t.suffixes()
                if not len(s):
                    continue
                s, n = _distinct(s, len(t.words))
                seed = zlib.crc32(lang.encode("utf-8", "surrogatepass"))
                digest = np.fromiter((zlib.crc32(w.as_py(), seed) for w in t.words), np.uint64, len(t.words))
                digest = np.r_[digest, np.uint64(1)]             # the last one for no word
                h = _mixed(digest[s[:, 0]], np.uint64(0))
                if lang in long_words:
                    rows = np.flatnonzero(_among(t.words, long_words[lang])[s[:, 0]])
                    h[rows] = _mixed(h[rows], digest[s[rows, 1]])
                    if lang in long_pairs and len(rows):
                        rows = rows[s[rows, 1] >= 0]
                        two = pc.binary_join_element_wise(t.words.take(pa.array(s[rows, 0])),
                                                          t.words.take(pa.array(s[rows, 1])), b" ")
                        rows = rows[_among(two, long_pairs[lang])]
                        h[rows] = _mixed(h[rows], digest[s[rows, 2]])
                group = (_mixed(h, np.uint64(7)) % np.uint64(n_groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                s, n, group = s[order], n[order], group[order]
                cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
                words = pa.concat_arrays([t.words, pa.array([b""], pa.binary())])
                s[s < 0] = len(t.words)
                texts = pc.binary_join_element_wise(*[words.take(pa.array(s[:, k])) for k in range(3)], b" ")
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[cuts[:-1]]), pa.array([lang] * (len(cuts) - 1)), pc.binary_join(lists, b" "),
                     pa.array([n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    names=["grp", "lang", "suffixes", "counts"])
    return run


# --- subtrees of a group -----------------------------------------------------------

def subtree_phrases(lang: str, packed: list[bytes], counts: list[bytes], least: int,
                    long_words: dict[tuple[str, bytes], int], long_pairs: dict[tuple[str, bytes], int]) -> pa.RecordBatch:
    """The phrases of two and three words in the subtrees of one group. A leaf
    is a distinct suffix; a phrase's count is the total of the leaves below
    it. A long prefix's own count was known before its suffixes were parted."""
    coded = pc.split_pattern(pa.array([b" ".join(packed)], pa.large_binary()), b" ").flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    s = coded.indices.to_numpy().astype(np.int64).reshape(-1, 3)
    none = words.index(b"") if b"" in words else -1
    s[s == none] = -1
    s, leaf = _distinct(s, len(words), np.frombuffer(b"".join(counts), np.int64))
    one = np.r_[True, s[1:, 0] != s[:-1, 0]]
    two = one | np.r_[True, s[1:, 1] != s[:-1, 1]]
    first, second = np.flatnonzero(one), np.flatnonzero(two)
    total1, total2 = np.add.reduceat(leaf, first), np.add.reduceat(leaf, second)
    of1, of2 = np.cumsum(one) - 1, np.cumsum(two) - 1      # each leaf's subtrees

    def above(i: int) -> tuple[int, int, bytes, bool]:
        """Counts of a leaf's first word and first two words, the two words,
        and whether they were parted further."""
        w = words[s[i, 0]]
        pair = w + b" " + words[s[i, 1]]
        known = long_pairs.get((lang, pair))
        return (long_words.get((lang, w), int(total1[of1[i]])), known or int(total2[of2[i]]), pair, known is not None)

    rows: list[tuple] = []
    for k in np.flatnonzero((total2 >= least) & (s[second, 1] >= 0)):
        l1, a, pair, parted = above(second[k])
        if not parted:
            rows.append((pair, 2, a, l1, None, words[s[second[k], 1]], None))
    for i in np.flatnonzero((leaf >= least) & (s[:, 2] >= 0)):
        l1, l2, pair, _ = above(i)
        last = words[s[i, 2]]
        rows.append((pair + b" " + last, 3, int(leaf[i]), l1, l2, words[s[i, 1]] + b" " + last, last))
    cols = list(zip(*rows)) if rows else [()] * 7
    text = lambda c: pa.array(c, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(rows), pa.string()), text(cols[0]), pa.array(cols[1], pa.int32()),
         *[pa.array(c, pa.int64()) for c in cols[2:5]], text(cols[5]), text(cols[6])],
        names=[c.split()[0] for c in PHRASES.split(", ")])


def _subtrees(least: int, long_words: dict[tuple[str, bytes], int], long_pairs: dict[tuple[str, bytes], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, packed, counts = None, [], []
        for batch in batches:
            for grp, lang, suffixes, n in zip(*(batch.column(c).to_pylist() for c in ("grp", "lang", "suffixes", "counts"))):
                if (grp, lang) != key:
                    if key:
                        yield subtree_phrases(key[1], packed, counts, least, long_words, long_pairs)
                    key, packed, counts = (grp, lang), [], []
                packed.append(suffixes)
                counts.append(n)
        if key:
            yield subtree_phrases(key[1], packed, counts, least, long_words, long_pairs)
    return run


# --- the operator ------------------------------------------------------------------

def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), (lang, word, n) of all words, and the phrases of two and
    three words that occur ``least`` times with the counts of their first
    parts; staged tables."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    words = staged(texts.mapInArrow(tidy(_word_counts), WORDS).groupBy("lang", "word").agg(F.sum("n").alias("n")),
                   "phrase-words")
    totals = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    n = totals.agg(F.sum("n")).head()[0] or 0
    limit = max(PREFIX_SUFFIXES, n // MOST_LONG)

    # No more than MOST_LONG words, or pairs, can be over the limit.
    long_words = {(r.lang, r.word.encode()): r.n for r in words.where(F.col("n") > limit).collect()}
    long_pairs: dict[tuple[str, bytes], int] = {}
    by_lang: dict[str, set[bytes]] = {}
    for lang, w in long_words:
        by_lang.setdefault(lang, set()).add(w)
    pairs_by_lang: dict[str, set[bytes]] = {}
    if long_words:
        pairs = texts.mapInArrow(tidy(_pair_counts(by_lang)), PAIRS)
        pairs = pairs.groupBy("lang", "word", "next").agg(F.sum("n").alias("n")).where(F.col("n") > limit)
        long_pairs = {(r.lang, f"{r.word} {r.next}".encode()): r.n for r in pairs.collect()}
        for lang, p in long_pairs:
            pairs_by_lang.setdefault(lang, set()).add(p)

    n_groups = partitions_for(n, GROUP_SUFFIXES)
    packed = texts.mapInArrow(tidy(_packed(n_groups, by_lang, pairs_by_lang)), PACKED)
    grouped = packed.repartition(n_groups, "grp").sortWithinPartitions("grp", "lang")
    phrases = grouped.mapInArrow(tidy(_subtrees(least, long_words, long_pairs)), PHRASES)
    parted = [(lang, p.decode(), 2, a, long_words[lang, p.split(b" ")[0]], None, p.split(b" ")[1].decode(), None)
              for (lang, p), a in long_pairs.items() if a >= least]
    phrases = phrases.unionByName(spark.createDataFrame(parted, PHRASES))
    return totals, words, staged(phrases, "phrases")


def _score(a: str, left: str, right: str) -> Column:
    big = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({big(a)} * {big(a)})) div ({big(left)} * {big(right)})")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best ``top``
    phrases of two and three words."""
    totals, words, phrases = phrase_counts(docs, least)
    pairs = phrases.where("words = 2")
    known = words.where(F.col("n") >= least).select("lang", "word", F.col("n").alias("f")).unionByName(
        pairs.select("lang", F.col("phrase").alias("word"), F.col("a").alias("f")))

    # Phrases that one longer candidate mostly covers go.
    longer = phrases.where("words = 3").select("lang", "a", F.explode(F.array(
        F.substring_index("phrase", " ", 2), F.col("rest1"))).alias("phrase"))
    cover = longer.groupBy("lang", "phrase").agg(F.max("a").alias("__cover"))
    alone = phrases.join(cover, ["lang", "phrase"], "left").where(
        (F.col("words") == 3) | F.col("__cover").isNull() | (100 * F.col("__cover") < COVERED_PERCENT * F.col("a")))

    for k in (1, 2):
        part = known.select(F.col("lang").alias("__lang"), F.col("word").alias("__word"), F.col("f").alias(f"r{k}"))
        alone = alone.join(part, (F.col("lang") == F.col("__lang")) & (F.col(f"rest{k}") == F.col("__word")),
                           "inner" if k == 1 else "left").drop("__lang", "__word")
    cut = lambda k: F.struct(_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"),
                             F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
    best = F.when(F.col("words") == 3, F.least(cut(1), cut(2))).otherwise(cut(1))
    scored = alone.select("lang", "phrase", "a", best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
