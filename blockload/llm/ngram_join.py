"""N-gram Jaccard join (operator 5): documents whose sets of word n-grams have
Jaccard similarity of at least PERCENT / 100, and their components.

The overlaps of two documents are entries of the product of the document by
n-gram incidence matrix with its transpose. The n-grams, by digest, are cut
into column blocks, and size-derived bounds decide which entries are needed:
sets of sizes a and b that reach the similarity differ in few n-grams, so cut
into one block more than that, they agree in a whole block. Only documents
with an equal, non-empty block are compared; a passage that many documents
share seldom makes them agree in a block, and a second bound drops those
that do not share enough of their n-grams with all other such documents
together. Documents that agree, directly or through others, form a cluster;
a large one is parted by the n-grams that are rarest in it, of which partners
have one in common; in a cluster overlaps are accumulated column by column, and
pairs below the bound are dropped.

Exactness: a level's block count exceeds the possible differences by a margin
for blocks that are empty in both sets; a document with more empty blocks than
the margin also files its empty blocks, so no pair is lost. Sets are of 64-bit
digests of n-grams, as are the classes of equal sets; the classes are checked
for collisions. A pair once proposed is compared by its whole sets.

Scale: equal sets are one class, so exact copies cost a row each. Block digests
go out sorted and packed; equal ones are merged in the task that makes them,
so a hot one is a row per task and a group of copies never meets whole. A
cluster of more than ``CHUNK`` documents is compared in chunks that share some
documents; what then is not in its main component is compared with all of
it, chunk by chunk. Tasks return spanning links, never all pairs.

Defined results: a null text or one without words has no n-grams and links
with nothing; documents with fewer than ``words`` words have their whole
sequence as one; repeated rows are copies; null doc_ids never name a
component unless all ids in it are null; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockload.llm.components import components, forest
from blockload.llm.runtime import partitions_for, pick, release, sheltered, ship, staged, tidy, unstage

WORDS = 4
PERCENT = 85
FLUSH_ROWS = 1 << 19        # block digests a task holds before it sends them
SLICE_ROWS = 1 << 20        # block digests of a slice of their range, on average
MOST_SLICES = 1 << 16
SEVERAL = 0xFFFFFFFF        # in place of a short owner: the n-gram has several
CHUNK = 1024                # documents of a cluster that are compared at once
CHUNK_GRAMS = 2_000_000
SHARED = 32                 # documents of a large cluster that all its chunks hold
NULL_ID = -(1 << 63)

SETS = "doc long, text_digest long, n long, class long, other long"
SLICES = "slice long, digests binary, classes binary, a binary, b binary"
LINKS = "a long, b long"
MEMBERS = "class long, grams binary"

# Any fixed odd numbers serve; they only have to be the same in all tasks.
_RNG = np.random.default_rng(5)
_TABLE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mix(h: np.ndarray, odd: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[odd]
    h = (h ^ (h >> np.uint64(29))) * _ODD[odd + 1]
    return h ^ (h >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_BASE = _ODD[60]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWER = {"up": _powers(1, _BASE), "down": _powers(1, _INVERSE)}


def word_digests(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, digest) of the words of ``data``."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if len(_POWER["up"]) <= n:
        _POWER["up"], _POWER["down"] = _powers(2 * n + 1, _BASE), _powers(2 * n + 1, _INVERSE)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[raw] * _POWER["up"][:n], out=total[1:])
    value = (total[ends] - total[starts]) * _POWER["down"][starts]
    return starts, _mix(value + (ends - starts).astype(np.uint64) * _ODD[58], 0)


def gram_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram digests of each text."""
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    starts, value = word_digests(b" ".join(raws) + b" ")
    edges = np.cumsum([0, *[len(r) + 1 for r in raws]])
    first = np.searchsorted(starts, edges)
    grams = np.zeros(len(value), np.uint64)
    if len(value) >= words:
        last = len(value) - words + 1
        for i in range(words):
            grams[:last] += value[i:i + last] * _ODD[10 + i]
        grams = _mix(grams, 2)
    for a, z in zip(first[:-1], first[1:]):
        if z - a >= words:
            yield np.unique(grams[a:z - words + 1])
        elif z > a:
            weight = _ODD[10:10 + z - a]
            yield _mix((value[a:z] * weight).sum(keepdims=True) + _ODD[30 + z - a], 2)
        else:
            yield grams[:0]


def set_digest(grams: np.ndarray) -> tuple[int, int]:
    """Two independent digests of a set."""
    tail = np.array([len(grams)], np.uint64) * _ODD[40]
    pair = np.concatenate([_mix(grams, 42).sum(keepdims=True) + tail, _mix(grams, 44).sum(keepdims=True) + tail])
    return tuple(int(v) for v in _mix(pair, 46).view(np.int64))


class Levels:
    """Size intervals and their column blocks.

    Interval i holds the sizes ``low[i]`` to ``low[i + 1] - 1``; partners are
    in the same interval or a neighbouring one. Level i serves the pairs whose
    smaller set is in interval i; ``blocks[i]`` exceeds the differences such a
    pair can have by 1 and the margin ``spare[i]`` for empty blocks.
    """

    def __init__(self, percent: int) -> None:
        self.percent, self.low, self.blocks, self.spare = percent, [1], [], []

    def _extend(self) -> None:
        low = self.low[-1]
        high = low * 100 // self.percent            # the largest partner of the smallest set
        self.low.append(high + 1)
        differ = high * (100 - self.percent) // self.percent
        k = differ + 1
        for _ in range(8):
            empty = int(2 * k * np.exp(-low / k)) + 2 if differ else 0
            k = differ + 1 + empty
        self.blocks.append(k)
        self.spare.append(k - differ - 1)

    def of(self, n: int) -> list[int]:
        """Levels that a set of size n takes part in."""
        while len(self.low) < 2 or self.low[-1] <= n:
            self._extend()
        i = int(np.searchsorted(self.low, n, "right")) - 1
        return [i - 1, i] if i else [0]


def block_digests(grams: np.ndarray, levels: Levels) -> np.ndarray:
    """Digests of a set's non-empty column blocks at its levels, and of the
    empty ones where there are more than the margin."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(_mix(grams, 48), out=sums[1:])
    out = []
    for i in levels.of(len(grams)):
        k = levels.blocks[i]
        edge = (np.arange(1, k, dtype=np.float64) * (2.0 ** 64 / k)).astype(np.uint64)
        cut = np.concatenate([[0], np.searchsorted(grams, edge), [len(grams)]])
        digest = sums[cut[1:]] - sums[cut[:-1]]
        place = np.arange(k, dtype=np.uint64) * _ODD[50] + np.full(k, i + 1, np.uint64) * _ODD[51]
        full = cut[1:] > cut[:-1]
        if k - full.sum() <= levels.spare[i]:
            digest, place = digest[full], place[full]
        out.append(_mix(digest + place, 52))
    return np.concatenate(out)


def _texts(batch: pa.RecordBatch, size: int = 1 << 19) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) in runs of about ``size`` characters."""
    run, first, held = [], 0, 0
    for i, text in enumerate(batch.column("text")):
        text = text.as_py()
        run.append(text)
        held += len(text or "")
        if held >= size:
            yield first, run
            run, first, held = [], i + 1, 0
    if run:
        yield first, run


def _digested(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, pairs = [], []
            for _, texts in _texts(batch):
                for grams in gram_sets(texts, words):
                    sizes.append(len(grams))
                    pairs.append(set_digest(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_digest"), pa.array(sizes, pa.int64()),
                 pa.array([p for p, _ in pairs], pa.int64()), pa.array([p for _, p in pairs], pa.int64())],
                names=["doc", "text_digest", "n", "class", "other"])
    return run


def _merged(digest: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests with their least owner, and the links (least owner,
    other owner) of digests with several."""
    order = np.argsort(digest, kind="stable")
    digest, owner = digest[order], owner[order]
    new = np.flatnonzero(np.r_[True, digest[1:] != digest[:-1]]) if len(digest) else np.zeros(0, np.int64)
    if not len(new):
        return digest, owner, owner, owner
    least = np.minimum.reduceat(owner, new)
    head = np.repeat(least, np.diff(np.r_[new, len(digest)]))
    far = head != owner
    return digest[new], least, head[far], owner[far]


def _pack48(digest: np.ndarray) -> bytes:
    """The low 48 bits of digests; their slice tells of the others."""
    return digest.astype(np.uint32).tobytes() + (digest >> np.uint64(32)).astype(np.uint16).tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low, high = np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.uint16, n, 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def _pack32(digest: np.ndarray) -> bytes:
    """The low 32 bits of digests, for counts that may be too high: in a slice
    one in thousands has another's."""
    return digest.astype(np.uint32).tobytes()


def _short(own):
    """32 bits of a class, for counts that may be too high."""
    return np.minimum(own & 0xFFFFFFFF, SEVERAL - 1)


def _by_slice(digest: np.ndarray, owner: np.ndarray, a: np.ndarray, b: np.ndarray, n_slices: int,
              pack=_pack48) -> pa.RecordBatch:
    """Sorted digests with their owners as one row per slice; the pairs (a, b)
    ride along."""
    at = ((digest >> np.uint64(32)) * np.uint64(n_slices)) >> np.uint64(32)
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.r_[cuts[1:], len(at)]
    share = np.linspace(0, len(a), len(cuts) + 1).astype(int)
    cols = [[pack(digest[x:y]) for x, y in zip(cuts, ends)], [owner[x:y].tobytes() for x, y in zip(cuts, ends)],
            [a[x:y].tobytes() for x, y in zip(share[:-1], share[1:])],
            [b[x:y].tobytes() for x, y in zip(share[:-1], share[1:])]]
    return pa.RecordBatch.from_arrays([pa.array(at[cuts].astype(np.int64)), *[pa.array(c, pa.binary()) for c in cols]],
                                      names=["slice", "digests", "classes", "a", "b"])


def _texts_sets(words: int):
    """(set, class) of the texts of a batch."""
    def feed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        for _, texts in _texts(batch):
            for grams in gram_sets(texts, words):
                if len(grams):
                    yield grams, set_digest(grams)[0]
    return feed


def _stored_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
    """(set, class) of a batch of stored sets."""
    for own, grams in zip(batch.column("class").to_pylist(), batch.column("grams")):
        yield np.frombuffer(grams.as_py(), np.uint64), own


def _flushes(feed, digests_of, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Digests and their owners, a bounded number at a time."""
    digests, owners, held = [], [], 0
    for batch in batches:
        for grams, own in feed(batch):
            digest = digests_of(grams)
            digests.append(digest)
            owners.append(np.full(len(digest), own, np.int64))
            held += len(digest)
            if held >= FLUSH_ROWS:
                yield np.concatenate(digests), np.concatenate(owners)
                digests, owners, held = [], [], 0
    if held:
        yield np.concatenate(digests), np.concatenate(owners)


def _sliced(feed, percent: int, n_slices: int):
    """Block digests by slice of their range, with the links that a task sees
    itself; a digest of several owners goes on with the least one only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(percent)
        for digest, owner in _flushes(feed, lambda grams: block_digests(grams, levels), batches):
            digest, least, a, b = _merged(digest, owner)
            a, b = forest(a, b) if len(a) else (a, b)
            yield _by_slice(digest, least, a, b, n_slices)
    return run


def _tally(digest: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests with their owner, ``NULL_ID`` where there are several;
    and how many digests of several each owner has."""
    order = np.argsort(digest, kind="stable")
    digest, owner = digest[order], owner[order]
    new = np.flatnonzero(np.r_[True, digest[1:] != digest[:-1]])
    size = np.diff(np.r_[new, len(digest)])
    many = np.repeat(size > 1, size) & (owner != NULL_ID)
    who, count = np.unique(owner[many], return_counts=True)
    return digest[new], np.where(size > 1, NULL_ID, owner[new]), who, count


def _gram_slices(words: int, n_slices: int):
    """N-grams of the classes asked for by slice, with the shared ones that a
    task sees itself. Eight bytes an n-gram: equal bits of different n-grams or
    classes only add to the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digest, owner in _flushes(_asked_sets(words), lambda grams: grams, batches):
            digest, owner, who, count = _tally(digest, _short(owner))
            owner = np.where(owner == NULL_ID, SEVERAL, owner).astype(np.uint32)
            yield _by_slice(digest, owner, who, count, n_slices, _pack32)
    return run


def _shared_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(short, n): n-grams of a slice that another class has too."""
    now, rows = None, []

    def out() -> pa.RecordBatch:
        parts = [(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for _, _, a, b in rows]
        owner = np.concatenate([np.frombuffer(c, np.uint32) for _, c, _, _ in rows]).astype(np.int64)
        _, _, who, count = _tally(np.concatenate([np.frombuffer(d, np.uint32) for d, _, _, _ in rows]),
                                  np.where(owner == SEVERAL, NULL_ID, owner))
        who, count = np.concatenate([who, *[a for a, _ in parts]]), np.concatenate([count, *[b for _, b in parts]])
        return pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(count, pa.int64())], names=["short", "n"])

    for batch in batches:
        for at, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", "digests", "classes", "a", "b"))):
            if now is not None and at != now:
                yield out()
                rows = []
            now = at
            rows.append(row)
    if now is not None:
        yield out()


def _slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of the documents with an equal block, slice by slice."""
    now, digests, owners, pairs = None, [], [], []

    def out() -> tuple[np.ndarray, np.ndarray]:
        _, _, a, b = _merged(np.concatenate(digests), np.concatenate(owners))
        a, b = np.concatenate([a, *[x for x, _ in pairs]]), np.concatenate([b, *[y for _, y in pairs]])
        return forest(a, b) if len(a) else (a, b)

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("slice", "digests", "classes", "a", "b")]
        for at, digest, owner, a, b in zip(*cols):
            if now is not None and at != now:
                yield out()
                digests, owners, pairs = [], [], []
            now = at
            digests.append(_unpack48(digest))
            owners.append(np.frombuffer(owner, np.int64))
            pairs.append((np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)))
    if now is not None:
        yield out()


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for a, b in _slices_of(batches):
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents that agree with any other, once a slice."""
    for a, b in _slices_of(batches):
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([a, b])), pa.int64())], names=["class"])


def _asked_sets(words: int):
    """(set, class) of the classes asked for, each once a task. A row whose
    text is not the class's own gives none."""
    seen: set[int] = set()

    def feed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        own = batch.column("class").to_pylist()
        for first, texts in _texts(batch):
            for i, grams in enumerate(gram_sets(texts, words), first):
                if own[i] not in seen and set_digest(grams)[0] == own[i]:
                    seen.add(own[i])
                    yield grams, own[i]
    return feed


def _member_sets(words: int):
    """The sets of the classes asked for as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed = _asked_sets(words)
        for batch in batches:
            if rows := [(c, g.tobytes()) for g, c in feed(batch)]:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()),
                                                  pa.array([g for _, g in rows], pa.binary())],
                                                 names=["class", "grams"])
    return run


def _dealt(key: np.ndarray, cols: list[np.ndarray], n_slices: int) -> pa.RecordBatch:
    """Rows of ``SLICES`` with the columns in the key's order, cut by slice of
    the key."""
    order = np.argsort(key, kind="stable")
    at = ((key[order] >> np.uint64(32)) * np.uint64(n_slices)) >> np.uint64(32)
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.r_[cuts[1:], len(at)]
    packed = [[c[x:y].tobytes() for x, y in zip(cuts, ends)] for c in (col[order] for col in cols)]
    packed += [[b""] * len(cuts)] * (4 - len(cols))
    return pa.RecordBatch.from_arrays([pa.array(at[cuts].astype(np.int64)), *[pa.array(c, pa.binary()) for c in packed]],
                                      names=["slice", "digests", "classes", "a", "b"])


def _gathered(batches: Iterator[pa.RecordBatch], *kinds) -> Iterator[list[np.ndarray]]:
    """The columns that ``_dealt`` has cut, slice by slice."""
    now, rows = None, []

    def out() -> list[np.ndarray]:
        return [np.concatenate([np.frombuffer(r[i], kind) for r in rows]) for i, kind in enumerate(kinds)]

    for batch in batches:
        for at, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", "digests", "classes", "a"))):
            if now is not None and at != now:
                yield out()
                rows = []
            now = at
            rows.append(row)
    if now is not None:
        yield out()


def _cluster_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
    """(tokens, class): a set's n-grams as those of its cluster. In a cluster
    different n-grams are different tokens."""
    for own, cluster, grams in zip(batch.column("class").to_pylist(), batch.column("cluster").to_pylist(), batch.column("grams")):
        yield _mix(np.frombuffer(grams.as_py(), np.uint64) ^ _mix(np.array([cluster]).view(np.uint64), 54), 56), own


def _token_slices(n_slices: int):
    """Tokens with their classes, by slice of the tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, own in _flushes(_cluster_sets, lambda tokens: tokens, batches):
            yield _dealt(token, [token, own], n_slices)
    return run


def _frequencies(n_slices: int):
    """Tokens with their classes and in how many sets they are (255 for more),
    by slice of the classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, own in _gathered(batches, np.uint64, np.int64):
            _, at, count = np.unique(token, return_inverse=True, return_counts=True)
            yield _dealt(_mix(own.view(np.uint64), 54), [token, own, np.minimum(count, 255).astype(np.uint8)[at]], n_slices)
    return run


def _rarest(percent: int, n_slices: int):
    """The tokens of a set one of which each partner has among its own such
    tokens: the rarest of a set, one more than the set can have besides those it
    shares. What no other set has is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, own, count in _gathered(batches, np.uint64, np.int64, np.uint8):
            order = np.lexsort((token, count, own))
            token, own, count = token[order], own[order], count[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            n = np.diff(np.r_[first, len(own)])
            place = np.arange(len(own)) - np.repeat(first, n)
            take = (place <= np.repeat(n - -(-n * percent // 100), n)) & (count > 1)
            if take.any():
                digest, least, a, b = _merged(token[take], own[take])
                a, b = forest(a, b) if len(a) else (a, b)
                yield _by_slice(digest, least, a, b, n_slices)
    return run


def product_links(sets: list[np.ndarray], left: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Spanning links (indexes) of the pairs (left row, any row) that reach the
    similarity, by the sparse product of the rows with the incidence matrix."""
    sizes = np.array([len(s) for s in sets])
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    by_column, count = row[order], np.bincount(column, minlength=len(grams))
    end = np.cumsum(count)
    start = end - count
    begin = np.cumsum(sizes) - sizes
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b = [], []
    for i in np.flatnonzero(left):
        own = column[begin[i]:begin[i] + sizes[i]]
        own = own[count[own] > 1]
        if len(own) * 100 < percent * sizes[i]:      # too few n-grams that any other row has
            continue
        total = count[own]
        at = np.repeat(start[own] - (np.cumsum(total) - total), total) + np.arange(total.sum())
        overlap = np.bincount(by_column[at], minlength=len(sets))
        for j in np.flatnonzero(100 * overlap >= percent * (sizes + sizes[i] - overlap)):
            x, y = root(int(i)), root(int(j))
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(int(i))
                b.append(int(j))
    return a, b


def _compared(percent: int):
    """Links inside each (cluster, part), rows sorted by it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out() -> pa.RecordBatch:
            own = np.array([r[0] for r in rows], np.int64)
            _, first = np.unique(own, return_index=True)        # a document shared twice counts once
            left = np.zeros(len(rows), bool)
            for c, flag in ((r[0], r[2]) for r in rows):
                left[first[np.searchsorted(own[first], c)]] |= flag
            own, left = own[first], left[first]
            a, b = product_links([np.frombuffer(rows[i][1], np.uint64) for i in first], left, percent)
            return pa.RecordBatch.from_arrays([pa.array(own[a], pa.int64()), pa.array(own[b], pa.int64())],
                                              names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("cluster", "part", "class", "grams", "left")]
            for cluster, part, own, grams, left in zip(*cols):
                if key is not None and (cluster, part) != key:
                    yield out()
                    rows = []
                key = (cluster, part)
                rows.append((own, grams, left))
        if key is not None:
            yield out()
    return run


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """Links from rows (cluster, part, class, grams, left)."""
    parts = rows.select("cluster", "part", "class", "grams", "left").repartition("cluster", "part")
    return parts.sortWithinPartitions("cluster", "part").mapInArrow(tidy(_compared(percent)), LINKS)


def component_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc, text_digest, n, group, component_id of each row of ``docs``; doc is
    the id with ``NULL_ID`` for null, group is null for rows without n-grams."""
    ship(docs.sparkSession)
    rows = _rows(docs)
    sets = staged(rows.mapInArrow(tidy(_digested(words)), SETS), "grams-sets")
    stats = sets.agg(F.sum("n").alias("grams")).head()
    known = F.when(F.col("doc") != NULL_ID, F.col("doc"))
    classes = staged(sets.where("n > 0").groupBy("class").agg(
        F.min(known).alias("least"), F.max("n").alias("n"), F.min(F.struct("doc", "text_digest")).alias("row"),
        (F.min("other") != F.max("other")).alias("clash")), "grams-classes")
    if classes.where("clash").limit(1).count():
        raise ValueError("two different sets have one digest; change the fixed numbers of this module")

    sets_left = _candidates(rows, classes, words, percent, int(stats.grams or 0))
    agreeing = _agreements(sets_left, _stored_sets, percent, sets_left.agg(
        F.sum(F.octet_length("grams") / 8)).head()[0] or 0).mapInArrow(tidy(_agreeing), LINKS)
    clusters = staged(components(agreeing), "grams-clusters")
    links = _links(sets_left, classes, clusters, percent)

    found = components(links)
    named = found.join(classes.select(F.col("class").alias("node"), "least"), "node")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = found.join(names, "component").select(F.col("node").alias("class"), "component", "component_id")
    every = classes.select("class", "least").join(linked, "class", "left").select(
        "class", F.coalesce("component", "class").alias("group"),
        F.coalesce("component_id", "least").alias("component_id"))
    return sets.join(every, "class", "left").select(
        "doc", "text_digest", "n", "group", F.when(F.col("group").isNull(), known).otherwise(
            F.col("component_id")).alias("component_id"))


def _rows(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), "text",
        F.xxhash64("text").alias("text_digest"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text)."""
    return component_rows(docs, words, percent).select(
        F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def _slices_for(n_digests: float) -> int:
    return min(partitions_for(int(n_digests), SLICE_ROWS), MOST_SLICES)


def _agreements(rows: DataFrame, feed, percent: int, n_grams: float) -> DataFrame:
    """The column blocks of all sets, brought together by slices of their digests."""
    n = _slices_for(n_grams * 0.4)
    slices = rows.mapInArrow(tidy(_sliced(feed, percent, n)), SLICES)
    return slices.repartition(n, "slice").sortWithinPartitions("slice")


def _candidates(rows: DataFrame, classes: DataFrame, words: int, percent: int, n_grams: int) -> DataFrame:
    """The stored sets (class, grams) that may have a partner: they agree in a
    block with another, and enough of their n-grams are in other such sets.
    The second bound leaves out documents that only share a passage, which
    would else tie all others together into one cluster."""
    partnered = _agreements(rows, _texts_sets(words), percent, n_grams).mapInArrow(tidy(_partnered), "class long")
    wanted = partnered.distinct().join(classes, "class").select("row.doc", "row.text_digest", "class", "n")
    wanted = staged(wanted, "grams-wanted")
    release(rows.sparkSession)
    n = _slices_for(wanted.agg(F.sum("n")).head()[0] or 0)
    slices = _texts_of(rows, wanted).mapInArrow(tidy(_gram_slices(words, n)), SLICES)
    shared = (slices.repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(
        tidy(_shared_grams), "short long, n long").groupBy("short").agg(F.sum("n").alias("shared")))
    short = F.least(F.col("class").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(SEVERAL - 1))
    enough = staged(wanted.withColumn("short", short).join(shared, "short").where(
        F.col("shared") * 100 >= F.col("n") * percent).select("doc", "text_digest", "class"), "grams-enough")
    release(rows.sparkSession)
    sets = _texts_of(rows, enough).mapInArrow(tidy(_member_sets(words)), MEMBERS)
    left = staged(sets.dropDuplicates(["class"]), "grams-sets-left")
    release(rows.sparkSession)
    return left


def _texts_of(rows: DataFrame, some: DataFrame) -> DataFrame:
    """The texts of classes, with the class. They are read again rather than
    kept as sets, which would take several times their room."""
    # A shuffle at every size: whether the ids fit a broadcast changes nothing.
    return rows.join(some.select("doc", "text_digest", "class").hint("merge"), ["doc", "text_digest"])


def _sized(members: DataFrame) -> DataFrame:
    """cluster, class, n, m, parts from rows (cluster, class, n)."""
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"))
    parts = F.greatest(F.ceil(F.col("m") / CHUNK), F.ceil(F.col("grams") / CHUNK_GRAMS)).cast("long")
    return members.join(size, "cluster").select("cluster", "class", "n", "m", parts.alias("parts"))


def _parted(sets: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """(cluster, class, n): large clusters as smaller ones that hold all their
    pairs. Blocks that agree by chance tie ever more sets together as there are
    more of them; of two sets that reach the similarity the rarest n-grams,
    counted in the cluster, have one in common as well, which others seldom have."""
    n = _slices_for(large.agg(F.sum("n")).head()[0])
    by_slice = lambda df: df.repartition(n, "slice").sortWithinPartitions("slice")
    tokens = sets.join(large.select("class", "cluster"), "class").mapInArrow(tidy(_token_slices(n)), SLICES)
    counted = by_slice(tokens).mapInArrow(tidy(_frequencies(n)), SLICES)
    rare = by_slice(counted).mapInArrow(tidy(_rarest(percent, n)), SLICES)
    found = components(by_slice(rare).mapInArrow(tidy(_agreeing), LINKS))
    return large.select("class", "n").join(found.withColumnRenamed("node", "class"), "class").select(
        F.col("component").alias("cluster"), "class", "n")


def _links(sets: DataFrame, classes: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Spanning links of all sets that reach the similarity."""
    members = staged(_sized(clusters.select(F.col("node").alias("class"), F.col("component").alias("cluster")).join(
        classes.select("class", "n"), "class")), "grams-members")
    large = members.where("parts > 1")
    if large.limit(1).count():
        members = staged(members.where("parts = 1").unionByName(_sized(_parted(sets, large, percent))), "grams-members")
        release(sets.sparkSession)
    spread = staged(sets.join(members, "class"), "grams-members-sets")
    part = F.pmod(F.xxhash64("class"), F.col("parts"))
    shared = (F.col("parts") > 1) & (F.pmod(F.xxhash64(F.lit(1), "class"), F.col("m")) < SHARED)
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    first = spread.withColumn("part", F.explode(F.when(shared, every).otherwise(F.array(part)))).withColumn(
        "left", F.lit(True))
    links = staged(_compare(first, percent), "grams-links")
    release(sets.sparkSession)

    # Large clusters: what is outside the main component meets all of the cluster.
    large = members.where("parts > 1").select("class", "cluster", "parts")
    if not large.limit(1).count():
        unstage(spread)
        return links
    labelled = large.join(components(links).withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    count = labelled.groupBy("cluster", "component").count()
    main = count.groupBy("cluster").agg(F.max(F.struct("count", "component")).alias("main")).select(
        "cluster", F.col("main.component").alias("main"))
    outside = labelled.join(main, "cluster").where("component <> main")
    groups = outside.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / (CHUNK // 2)).cast("long").alias("groups"))
    outside = staged(outside.select("class"), "grams-outside")
    tiled = spread.where("parts > 1").join(groups, "cluster").join(
        outside.withColumn("out", F.lit(True)), "class", "left")
    all_groups = F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)
    column = tiled.withColumn("g", F.explode(all_groups)).withColumn("left", F.lit(False)).withColumn(
        "part", F.col("g") * F.col("parts") + part)
    row = tiled.where("out").withColumn("p", F.explode(every)).withColumn("left", F.lit(True)).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(2), "class"), F.col("groups")) * F.col("parts") + F.col("p"))
    keep = ["cluster", "part", "class", "grams", "left"]
    more = staged(_compare(column.select(*keep).unionByName(row.select(*keep)), percent), "grams-links")
    unstage(spread)
    release(sets.sparkSession)
    return links.unionByName(more)


def without_near_copies(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` with one document of each component, the one with the least
    id (null ids last); of rows with one id and text one stays. Documents
    without n-grams stay."""
    linked = staged(component_rows(docs, words, percent), "grams-rows")
    first = F.min(F.struct((F.col("doc") == NULL_ID).alias("unknown"), "doc", "text_digest")).alias("row")
    kept = linked.where("group is not null").groupBy("group").agg(first).select("row.doc", "row.text_digest").union(
        linked.where("group is null").select("doc", "text_digest").distinct())
    kept = kept.toDF("__kept", "__kept_text")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    plain, restored = sheltered(docs, "doc_id", "text")
    numbered = plain.withColumn("__own", own).withColumn("__text", F.xxhash64("text"))
    left = numbered.join(kept.hint("merge"), (F.col("__own") == F.col("__kept")) & (F.col("__text") == F.col("__kept_text")),
                         "left_semi")
    if linked.groupBy("doc", "text_digest").count().where("count > 1").limit(1).count():
        left = left.dropDuplicates(["__own", "__text"])
    return left.select(*restored)
