"""Suffix-array dedup (operator 1): strings that also start elsewhere, of
``LENGTH`` bytes (``repeated_spans``) or of more than some words
(``repeated_passages``, ``without_repeats`` with ``over_words``).

The construction is column-wise over many strings at once: each round puts one
symbol, a byte or a word, in front of every string's suffix, and updates the
collection's order (its Burrows-Wheeler transform, the symbols read in that
order) and the common prefixes of neighbours. A suffix whose common prefix with a
neighbour reaches the length starts a repeated string.

To need few rounds on long texts, the strings are windows of the texts, aligned
so that equal strings meet in one column. A string is filed under its anchor,
the ``ANCHOR`` bytes (``ANCHOR_WORDS`` words) in it with the least digest: equal
strings have equal anchors at equal places. The symbols around one anchor that
belong to strings filed under it are its window, less than twice the length,
so a collection is finished after that many rounds however long the texts
are. Windows of an anchor that occurs once are never made.

Scale: equal texts are one class from the start (every text of a class with
two members is covered whole), so copies cost a row each, not their text.
Shuffled are anchors (about one per 170 bytes, or per 22 words), the texts once,
by (class, row) so that copies spread, and windows of repeated anchors. A task
holds windows up to ``BATCH_WINDOWS``; it streams them in the order of their
anchors, which takes the place of the external files of the method. Anchors that
hold a noticeable share of all rows are few and meet theirs by a broadcast, so
they stay where they are. An anchor with more than ``HOT_WINDOWS`` windows
(bounded by a task's memory) is not gathered: each of its strings is counted by
digest instead, with partial sums, which gives the same marks.

Defined results: a null text is empty; texts shorter than the length keep all
bytes; strings never cross texts; words are what white space (space, code
points 9 to 13) separates, whatever separates them; repeated rows are copies;
extra columns are kept, except those with the names of the columns that are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockload.llm.runtime import sheltered, ship, staged, tidy

LENGTH = 400
ANCHOR = 64                     # bytes of an anchor, a power of two
ANCHOR_WORDS = 8                # words of an anchor, a power of two
BUFFER = 1 << 20                # bytes that are searched for anchors at a time
BATCH_WINDOWS = 16_384          # windows a task gathers before it works on their groups
BROADCAST_ROWS = 10_000         # an anchor with more rows meets them by a broadcast, if among MOST_BROADCAST
MOST_BROADCAST = 4096
HOT_WINDOWS = 100_000           # a larger group, over 150 MB with its columns, is counted instead
NONE = 0xFF                     # no symbol; a byte that UTF-8 never has, and no number of a word
NULL_ID = -(1 << 63)

ANCHORS = "key long, d1 long, d2 long, shift int, begin int, end int"   # a window, its first symbol before the anchor
WINDOWS = ANCHORS + ", data binary"
SPANS = "d1 long, d2 long, begin int, end int"
STRINGS = "digest binary, d1 long, d2 long, begin int, end int"
_BLANK = re.compile(rb"[ \t-\r]")
_NAMES = [c.split()[0] for c in WINDOWS.split(", ")]

# Any fixed odd numbers and any fixed table serve; the digest only has to be
# the same in all tasks.
_TABLE = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.random.default_rng(2).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(3).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling_digest(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit digests of the ``size`` symbols at every place, by doubling, from
    the symbols' own."""
    step, i = 1, 0
    while step < size:
        h = h[:-step] * _ODD[i] + h[step:]
        step, i = step * 2, i + 1
    h ^= h >> np.uint64(31)
    h *= _ODD[-1]
    h ^= h >> np.uint64(29)
    return h


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (the leftmost of equals) in every window of
    ``width``, by running minima from both ends of blocks."""
    bits = np.uint64(max(1, int(len(values)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = (values & ~low) | np.arange(n, dtype=np.uint64)
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n - width + 1], ahead[width - 1:n]) & low).astype(np.int64)


def find_anchors(h: np.ndarray, owner: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(digest, owner, place, first start, last start) of the anchors among
    symbols with digests ``h``, for strings of ``length`` symbols;
    ``owner[i]`` is the text of symbol i."""
    if len(h) < length:
        return (np.zeros(0, np.int64),) * 5
    digest = rolling_digest(h, anchor)
    best = window_argmin(digest, length - anchor + 1)
    starts = np.flatnonzero(owner[:len(best)] == owner[length - 1:length - 1 + len(best)])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 5
    at, text = best[starts], owner[starts]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(starts)] - 1
    return digest[at[new]].view(np.int64), text[new], at[new], starts[new], starts[last]


class Words:
    """Where the words of some texts in one buffer start and stop, and whose
    they are."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        self.letter = (raw != 32) & ((raw < 9) | (raw > 13))
        self.raw = raw
        edge = np.diff(np.r_[False, self.letter, False].view(np.int8))
        self.start, self.stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.array([len(t) + 1 for t in texts])
        self.begin = np.cumsum(sizes) - sizes
        self.owner = np.searchsorted(self.begin, self.start, "right") - 1

    def __len__(self) -> int:
        return len(self.start)

    def digests(self) -> np.ndarray:
        """64-bit digests of the words, from their bytes and places in them."""
        if not len(self):
            return np.zeros(0, np.uint64)
        size = self.stop - self.start
        edge = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(edge, size)
        h = _TABLE[self.raw[self.letter]] * _PLACES[place % len(_PLACES)]
        h ^= h >> np.uint64(31)
        h = np.add.reduceat(h * _ODD[-2], edge) + size.astype(np.uint64)
        return (h ^ (h >> np.uint64(29))) * _ODD[-1]

    def numbers(self) -> np.ndarray:
        """A number for each word, equal for equal words, from 256 on."""
        offsets = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.stop - self.start, out=offsets[1:])
        data = pa.py_buffer(self.raw[self.letter].tobytes())
        words = pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(offsets), data])
        return words.dictionary_encode().indices.to_numpy().astype(np.int32) + 256


class ByByte:
    """Strings of ``length`` bytes."""

    def __init__(self, length: int) -> None:
        self.length, self.anchor, self.least = length, ANCHOR, length

    def pieces(self, raw: bytes) -> Iterator[tuple[int, bytes]]:
        """A text in pieces that overlap, so that each string is in one."""
        for at in range(0, max(1, len(raw) - self.length + 1), BUFFER):
            yield at, raw[at:at + BUFFER + self.length - 1]

    def anchors(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        """key, piece, shift, begin and end of the anchors' windows."""
        sizes = np.array([len(p) for p in pieces])
        owner = np.repeat(np.arange(len(pieces)), sizes)
        key, own, pos, lo, hi = find_anchors(_TABLE[np.frombuffer(b"".join(pieces), np.uint8)], owner, self.length, ANCHOR)
        base = (np.cumsum(sizes) - sizes)[own]
        return key, own, lo - pos, lo - base, hi + self.length - base

    def symbols(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All symbols of the windows, how many each has, and where each symbol
        starts and stops in its window."""
        n = np.array([len(r[6]) for r in rows])
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.frombuffer(b"".join(r[6] for r in rows), np.uint8), n, at, at + 1


class ByWord:
    """Strings of ``length`` words."""

    def __init__(self, length: int) -> None:
        if length < ANCHOR_WORDS:
            raise ValueError(f"a passage has at least {ANCHOR_WORDS} words here")
        self.length, self.anchor, self.least = length, ANCHOR_WORDS, 2 * length - 1

    def pieces(self, raw: bytes) -> Iterator[tuple[int, bytes]]:
        """A text in pieces of whole words; each begins with as many words of
        the one before as belong to no string there."""
        at = 0
        while True:
            end, words = at, None
            while end < len(raw) and (words is None or len(words) < 2 * self.length):
                blank = _BLANK.search(raw, min(len(raw), end + BUFFER))
                end = blank.start() if blank else len(raw)
                words = Words([raw[at:end]]) if end < len(raw) else None
            yield at, raw[at:end]
            if words is None:
                return
            at += int(words.start[len(words) - self.length + 1])

    def anchors(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        words = Words(pieces)
        key, own, pos, lo, hi = find_anchors(words.digests(), words.owner, self.length, ANCHOR_WORDS)
        if not len(key):
            return (np.zeros(0, np.int64),) * 5
        base = words.begin[own]
        return key, own, lo - pos, words.start[lo] - base, words.stop[hi + self.length - 1] - base

    def symbols(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        words = Words([r[6] for r in rows])
        base = words.begin[words.owner]
        return words.numbers(), np.bincount(words.owner, minlength=len(rows)), words.start - base, words.stop - base


def _anchors(kind: ByByte | ByWord):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = batch.column("d1").to_numpy(), batch.column("d2").to_numpy()
            pieces: list[tuple[int, int, bytes]] = []     # row, place of the piece in the text, bytes
            held = 0

            def out() -> pa.RecordBatch:
                key, own, shift, begin, end = kind.anchors([p for _, _, p in pieces])
                row, base = np.array([r for r, _, _ in pieces])[own], np.array([a for _, a, _ in pieces])[own]
                cols = [key, d1[row], d2[row], *[c.astype(np.int32) for c in (shift, begin + base, end + base)]]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_NAMES[:-1])

            for i, text in enumerate(batch.column("text")):
                for at, piece in kind.pieces(text.as_py().encode("utf-8", "surrogatepass")):
                    if len(piece) >= kind.least:
                        pieces.append((i, at, piece))
                        held += len(piece)
                    if held >= BUFFER:
                        yield out()
                        pieces, held = [], 0
            if pieces:
                yield out()
    return run


def _windows(hot: bool):
    """The windows of a text's anchors, of those that are hot or of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors = [a for a in batch.column("__anchors")[i].as_py() if a["hot"] == hot]
                n = len(anchors)
                if not n:
                    continue
                raw = batch.column("__text")[i].as_py().encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays([
                    pa.array([a["key"] for a in anchors], pa.int64()),
                    pa.array([batch.column("__d1")[i].as_py()] * n, pa.int64()),
                    pa.array([batch.column("__d2")[i].as_py()] * n, pa.int64()),
                    *[pa.array([a[c] for a in anchors], pa.int32()) for c in ("shift", "begin", "end")],
                    pa.array([raw[a["begin"]:a["end"]] for a in anchors], pa.binary())], names=_NAMES)
    return run


def repeated_starts(columns: np.ndarray, group: np.ndarray, length: int,
                    owner: np.ndarray | None = None) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Which suffixes of aligned strings repeat for ``length`` symbols.

    ``columns[c, i]`` is symbol c of string i, ``NONE`` where it has none;
    strings of one ``group`` (ascending) may match. Returns a boolean array of
    the same shape for the columns where a repeated string can start; with
    ``owner`` (of each string) also which of them repeat in a string of another
    owner.

    One round per column, from the last to the first: ``order`` lists the
    strings by group and suffix, ``common[k]`` is the common prefix of the
    suffixes at k - 1 and k. Putting a symbol in front sorts the order stably
    by that symbol; the common prefix of new neighbours with one symbol is one
    more than the least common prefix between their old places.
    """
    n_cols, n = columns.shape
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    hits = np.zeros((max(0, n_cols - length + 1), n), bool)
    across = np.zeros_like(hits)
    group = group.astype(np.int64) * max(256, int(columns.max(initial=0)) + 1)
    for c in range(n_cols - 1, -1, -1):
        symbol = columns[c, order]
        key = group[order] + symbol
        moved = bool((key[1:] < key[:-1]).any())
        place = np.argsort(key, kind="stable") if moved else None
        if moved:
            order, key, symbol = order[place], key[place], symbol[place]
        same = (key[1:] == key[:-1]) & (symbol[1:] != NONE)
        fresh = np.zeros(n + 1, np.int32)
        if moved:
            before, after = place[:-1], place[1:]
            near = same & (after == before + 1)
            fresh[1:n][near] = common[after[near]] + 1
            far = np.flatnonzero(same & ~near)
            if len(far):
                bounds = np.empty(2 * len(far), np.int64)
                bounds[0::2], bounds[1::2] = before[far] + 1, after[far] + 1
                fresh[1 + far] = np.minimum.reduceat(common, bounds)[0::2] + 1
        else:
            fresh[1:n] = np.where(same, common[1:n] + 1, 0)
        common = fresh
        if c < len(hits):
            hits[c, order] = np.maximum(common[:-1], common[1:]) >= length
            if owner is not None and n:
                run = np.flatnonzero(common[:n] < length)     # where other strings begin
                own = owner[order]
                many = np.minimum.reduceat(own, run) != np.maximum.reduceat(own, run)
                across[c, order] = np.repeat(many, np.diff(np.r_[run, n]))
    return hits if owner is None else (hits, across)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of true values in each row."""
    edge = np.zeros((len(marks), 1), bool)
    turns = np.diff(np.hstack([edge, marks, edge]).astype(np.int8), axis=1)
    who, first = np.nonzero(turns == 1)
    return who, first, np.nonzero(turns == -1)[1] - 1


def _group_spans(rows: list[tuple], kind: ByByte | ByWord, across: bool) -> pa.RecordBatch:
    """Spans of the windows (as in ``WINDOWS``), sorted by key."""
    key = np.array([r[0] for r in rows], np.int64)
    d1, d2 = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    left = kind.length - kind.anchor                         # the anchor's column
    symbols, n, start, stop = kind.symbols(rows)
    aligned = np.full((len(rows), left + kind.length), NONE, symbols.dtype)
    first = np.cumsum(n) - n
    offset = np.array([r[3] for r in rows]) + left           # the column of a window's first symbol
    row = np.repeat(np.arange(len(rows)), n)
    aligned[row, np.arange(len(symbols)) - np.repeat(first - offset, n)] = symbols
    columns = np.ascontiguousarray(aligned.T)
    del aligned
    group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    hits = repeated_starts(columns, group, kind.length, d1 if across else None)
    who, a, z = _runs(hits[1].T if across else hits.T)
    begin, at = np.array([r[4] for r in rows])[who], (first - offset)[who]    # at: a column's place among all symbols
    return pa.RecordBatch.from_arrays(
        [pa.array(d1[who]), pa.array(d2[who]), pa.array((begin + start[at + a]).astype(np.int32)),
         pa.array((begin + stop[at + z + kind.length - 1]).astype(np.int32))], names=["d1", "d2", "begin", "end"])


def _matched(kind: ByByte | ByWord, across: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in _NAMES]):
                if len(rows) >= BATCH_WINDOWS and row[0] != rows[-1][0]:
                    yield _group_spans(rows, kind, across)
                    rows = []
                rows.append(row)
        if rows:
            yield _group_spans(rows, kind, across)
    return run


def _strings(kind: ByByte | ByWord):
    """Every string of some windows by a digest of its symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, d1, d2, _, begin, _, data in zip(*[batch.column(c).to_pylist() for c in _NAMES]):
                if isinstance(kind, ByByte):
                    spans = [(i, i + kind.length) for i in range(len(data) - kind.length + 1)]
                    texts = [data[a:z] for a, z in spans]
                else:
                    w = Words([data])
                    spans = list(zip(w.start.tolist(), w.stop[kind.length - 1:].tolist()))
                    texts = [b" ".join(data[a:z].split()) for a, z in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                     pa.array([d1] * len(spans), pa.int64()), pa.array([d2] * len(spans), pa.int64()),
                     pa.array([begin + a for a, _ in spans], pa.int32()),
                     pa.array([begin + z for _, z in spans], pa.int32())],
                    names=["digest", "d1", "d2", "begin", "end"])
    return run


def _hot_spans(windows: DataFrame, kind: ByByte | ByWord, across: bool) -> DataFrame:
    """Spans of the windows of very frequent anchors, by counting each string."""
    strings = windows.mapInArrow(tidy(_strings(kind)), STRINGS)
    place, text = F.struct("d1", "d2", "begin"), F.struct("d1", "d2")
    twice = (strings.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("b"),
                                           (F.min(text) != F.max(text)).alias("across"))
             .where("across" if across else "a <> b").select("digest"))
    return strings.join(twice, "digest", "left_semi").select("d1", "d2", "begin", "end")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


class _Texts:
    """The texts of ``docs`` with their classes of equals. ``rows`` has the
    ``carried`` columns and __row, __text, __none, __d1, __d2."""

    def __init__(self, docs: DataFrame, carried: list[str]) -> None:
        ship(docs.sparkSession)
        text = F.coalesce(F.col("text"), F.lit(""))
        self.rows = docs.select(
            *[F.col(f"`{c}`") for c in carried], F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("__row"),
            text.alias("__text"), F.col("text").isNull().alias("__none"), F.xxhash64(text).alias("__d1"),
            F.xxhash64(F.lit(7), text).alias("__d2"))
        self.ids = staged(self.rows.select(F.col("__d1").alias("d1"), F.col("__d2").alias("d2"),
                                           F.col("__row").alias("row")), "suffix-ids")
        self.classes = self.ids.groupBy("d1", "d2").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))

    def at(self):
        return (F.col("__d1") == F.col("__s1")) & (F.col("__d2") == F.col("__s2")) & (F.col("__row") == F.col("__srow"))

    def spans(self, kind: ByByte | ByWord, across: bool = False) -> DataFrame:
        """(d1, d2, found): the repeated strings of each text, in spans; with
        ``across`` only those that repeat in another text."""
        long = self.rows.where(F.octet_length("__text") >= kind.least).select(
            F.col("__d1").alias("d1"), F.col("__d2").alias("d2"), F.col("__text").alias("text"))
        anchors = staged(long.mapInArrow(tidy(_anchors(kind)), ANCHORS), "suffix-anchors")
        place = F.xxhash64("d1", "d2", "shift", "begin")
        repeated = staged(anchors.groupBy("key").agg(
            F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"))
            .where("a <> b").select("key", "n"), "suffix-repeated")
        few = max(BROADCAST_ROWS, (repeated.agg(F.sum("n")).head()[0] or 0) // MOST_BROADCAST)
        keyed = repeated.select("key", "n", (F.col("n") > HOT_WINDOWS).alias("hot"))
        frequent = F.broadcast(keyed.where(F.col("n") > few).drop("n"))      # no more than MOST_BROADCAST rows
        met = anchors.join(frequent, "key").unionByName(
            anchors.join(frequent.select("key"), "key", "left_anti").join(keyed.where(F.col("n") <= few).drop("n"), "key"))
        wanted = met.groupBy("d1", "d2").agg(
            F.collect_set(F.struct("key", "shift", "begin", "end", "hot")).alias("anchors"))
        source = staged(self.classes.join(wanted, ["d1", "d2"]).select("d1", "d2", "row", "anchors").toDF(
            "__s1", "__s2", "__srow", "__anchors"), "suffix-wanted")
        given = self.rows.join(source, self.at()).mapInArrow(tidy(_windows(False)), WINDOWS)
        very = self.rows.join(source.where(F.exists("__anchors", lambda a: a["hot"])), self.at()).mapInArrow(
            tidy(_windows(True)), WINDOWS)
        spans = given.repartition("key").sortWithinPartitions("key").mapInArrow(
            tidy(_matched(kind, across)), SPANS).unionByName(_hot_spans(very, kind, across))
        return spans.groupBy("d1", "d2").agg(F.collect_set(F.struct("begin", "end")).alias("found"))

    def told(self, **found: DataFrame) -> DataFrame:
        """Every row with the number of its copies and its spans of each kind."""
        each = self.ids.distinct().join(
            self.classes.select("d1", "d2", F.col("copies").alias("__copies")), ["d1", "d2"])
        for name, spans in found.items():
            each = each.join(spans.withColumnRenamed("found", name), ["d1", "d2"], "left")
        each = each.toDF("__s1", "__s2", "__srow", "__copies", *found)
        return self.rows.join(each, self.at(), "left")


def _merged(found: list | None, raw: bytes, copied: bool, length: int, over_words: int) -> list[tuple[int, int]]:
    """The runs to remove. Of a text with copies all strings repeat."""
    if copied and over_words and len(raw.split()) > over_words:
        return [(len(raw) - len(raw.lstrip()), len(raw.rstrip()))]
    if copied and not over_words and len(raw) >= length:
        return [(0, len(raw))]
    return merge_spans([(s["begin"], s["end"]) for s in found or []])


def _cut(names: list[str], length: int, over_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, texts = [], [], []
            for text, none, found, copies in zip(*(batch.column(c) for c in ("__text", "__none", "__found", "__copies"))):
                whole = text.as_py()
                raw, n = whole.encode("utf-8", "surrogatepass"), copies.as_py() or 1
                runs = _merged(found.as_py(), raw, n > 1, length, over_words)
                parts, at = [], 0
                for begin, end in runs:
                    parts.append(raw[at:begin])
                    at = end
                spans.append([{"begin": b, "end": e} for b, e in runs])
                kept.append(b"".join([*parts, raw[at:]]))
                texts.append(None if none.as_py() else whole)
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) if c != "text" else pa.array(texts, pa.string()) for c in names],
                 pa.array(spans, kind), pa.array(kept, pa.binary()),
                 pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())],
                names=[*names, "spans", "kept", "kept_text"])
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, over_words: int = 0) -> DataFrame:
    """``docs`` with ``spans`` (begin, end: the maximal runs of bytes to remove),
    ``kept`` (the remaining bytes) and ``kept_text`` (those of them that are
    whole characters). Needs columns doc_id and text. With ``over_words`` not
    strings of ``length`` bytes repeat but strings of so many words and one."""
    if over_words == 0 and length < ANCHOR:
        raise ValueError(f"length must be at least {ANCHOR}")
    names = [c for c in docs.columns if c.lower() not in ("spans", "kept", "kept_text")]
    texts = _Texts(docs, [c for c in names if c != "text"])
    told = texts.told(__found=texts.spans(ByWord(over_words + 1) if over_words else ByByte(length)))
    schema = T.StructType([*[docs.schema[c] for c in names], *T._parse_datatype_string(
        "spans array<struct<begin:int,end:int>>, kept binary, kept_text string").fields])
    return told.mapInArrow(tidy(_cut(names, length, over_words)), schema)


REPORT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, "
          "passage_bytes long, in_other_documents boolean")


def _reported(length: int, over_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, found, passages, copies in zip(
                    *(batch.column(c) for c in ("doc_id", "__text", "__found", "__passages", "__copies"))):
                raw, n = text.as_py().encode("utf-8", "surrogatepass"), copies.as_py() or 1
                runs = _merged(found.as_py(), raw, n > 1, length, 0)
                shared = _merged(passages.as_py(), raw, n > 1, 0, over_words)
                digest, at = hashlib.sha256(), 0
                for begin, end in [*runs, (len(raw), len(raw))]:
                    digest.update(raw[at:begin])
                    at = end
                rows.append((doc.as_py(), len(raw), sum(e - b for b, e in runs), len(runs), digest.hexdigest(),
                             len(shared), sum(e - b for b, e in shared), bool(shared)))
            fields = [f.split() for f in REPORT.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)],
                                             names=[n for n, _ in fields])
    return run


def span_report(docs: DataFrame, length: int = LENGTH, over_words: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document,
    for strings of ``length`` bytes; and, for passages of more than
    ``over_words`` words that also stand in another document, n_passages
    (maximal runs), passage_bytes and in_other_documents."""
    texts = _Texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    told = texts.told(__found=texts.spans(ByByte(length)), __passages=texts.spans(ByWord(over_words + 1), across=True))
    return told.mapInArrow(tidy(_reported(length, over_words)), REPORT)


def without_repeats(docs: DataFrame, length: int = LENGTH, over_words: int = 0) -> DataFrame:
    """``docs`` with the repeated runs cut out of their texts. A character cut
    in two is left out whole; n_chars, if there, is counted anew; documents of
    which nothing but white space is left are dropped, others are kept."""
    plain, restored = sheltered(docs, "doc_id", "text", "n_chars")
    cut = repeated_spans(plain, length, over_words)
    changed = F.size("spans") > 0
    kept = cut.where(~changed | F.col("kept_text").rlike(r"\S"))
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    if "n_chars" in docs.columns:
        chars = F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("text", text).select(*restored)
