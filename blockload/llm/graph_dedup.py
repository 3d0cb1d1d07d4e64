"""Embedding near-dedup (operator 7) on a robust-pruned flat graph.

Vectors are dealt to clusters, each to its ``OVERLAP`` nearest, so shards
overlap. A shard builds its own graph: every vector's nearest ones, robustly
pruned (a neighbour that is much closer to one already taken is left out), and
the links both ways. The adjacency lists of a vector from all its shards are
united into one flat graph. Every vector is then searched for: in each of its
shards greedily from the medoid, and on, in widening range, from every vector
found near enough, until no such vector is left unvisited. Vectors for which
any is found are then compared with all of their shards, by their cosine in
double precision. Recall is audited on sampled queries against all rows, and
the search is repeated with more effort while it falls short of ``ENOUGH``;
after the last effort, or if too few links are seen to judge, all shards that
the triangle inequality does not rule out are compared.

Scale: the clusters are fitted on a bounded sample (``SAMPLE_ROWS``). Shards are
cut into cells of about ``CELL`` vectors by salting; a query visits all cells
of its shards, so a hot cluster is many tasks and no link is lost. Equal
vectors are one class. A pair counts in the first shard it shares, where it is
always compared; a task returns counts and one link per vector, never pairs.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components link with nothing and are their own component; vectors
of different lengths do not link; null vec_ids never name a component unless
all ids in it are null; repeated rows are copies that link; extra columns are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockload.llm.components import components, forest
from blockload.llm.runtime import partitions_for, pick, ship, staged

THRESHOLD = 0.9
CELL = 1500                 # vectors of a cell, about
SAMPLE_ROWS = 8192          # rows that the clusters are fitted on
MOST_CLUSTERS = 2048
ROUNDS = 8
EFFORTS = ((2, 32), (3, 64), (5, 128))    # (overlap, beam) of each attempt
DEGREE = 16
CANDIDATES = 48
ALPHA = 1.2
SLACK = 0.05                # vectors this little below the threshold are still expanded
AUDIT_QUERIES = 1024        # classes that the audit draws at a time
AUDIT_GROUPS = 50           # groups that its linked queries must make up, each worth one over its group's classes
AUDIT_DRAWS = 65_536        # classes after which it draws no more
ENOUGH = 0.97               # audited recall at which no further attempt is made
AT_ONCE = 256               # queries compared with a cell at a time
HELD = 4096                 # queries a task holds

PLACED = "class long, copies long, unit binary, dim int, shards array<int>"
EDGES = "class long, near array<long>"
FOUND = "class long, peer long"
LINKS = "class long, n long, peer long"
VISITS = "class long, copies long, unit binary, dim int, home int, shards array<int>"


def usable_classes(vectors: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, classes with their vector and number of rows)."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = pick(vectors, "vec_id", column).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    usable = F.coalesce(F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = staged(rows.select("vec_id", F.when(usable, F.col("x")).alias("x"),
                              F.when(usable, F.xxhash64("x")).alias("class")), "vectors")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.min("x").alias("x"),
        F.max("x").alias("other"))
    classes = staged(classes, "vector-classes")
    if classes.where("x <> other").limit(1).count():
        raise ValueError("two different vectors have one digest")
    return rows, classes.drop("other")


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()          # so that no square overflows
    return x / np.sqrt(x @ x)


def fit_clusters(classes: DataFrame, n: int) -> np.ndarray:
    """Centres of the clusters, by rounds of k-means on a bounded sample."""
    sample = [r.x for r in classes.orderBy(F.xxhash64(F.lit(3), "class")).limit(SAMPLE_ROWS).select("x").collect()]
    if not sample:
        return np.zeros((1, 1))
    width = max(map(len, sample))
    points = np.zeros((len(sample), width))
    for i, x in enumerate(sample):
        points[i, :len(x)] = unit(np.array(x))
    k = min(partitions_for(n, CELL), MOST_CLUSTERS, len(points))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        own = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def _placer(centres: np.ndarray, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = min(overlap, len(centres))
        for batch in batches:
            units = [unit(np.array(x.as_py())) for x in batch.column("x")]
            shards = []
            for u in units:
                w = min(len(u), centres.shape[1])
                near = centres[:, :w] @ u[:w]
                shards.append(np.sort(np.argsort(-near, kind="stable")[:t]).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("copies"), pa.array([u.tobytes() for u in units], pa.binary()),
                 pa.array([len(u) for u in units], pa.int32()), pa.array(shards, pa.list_(pa.int32()))],
                names=["class", "copies", "unit", "dim", "shards"])
    return run


def _by_cell(work, names: list[str]):
    """Calls ``work`` with the rows of each (dim, shard, cell); rows come sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["dim"], row["shard"], row["cell"])
                if key is not None and now != key:
                    yield from work(key, rows)
                    rows = []
                key = now
                rows.append(row)
        if key is not None:
            yield from work(key, rows)
    return run


def pruned_graph(points: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each point: its nearest ones, robustly pruned."""
    n = len(points)
    near = points @ points.T
    np.fill_diagonal(near, -2)
    c = min(CANDIDATES, n - 1)
    if c <= 0:
        return [np.zeros(0, np.int64)] * n
    cand = np.argpartition(-near, c - 1, axis=1)[:, :c]
    cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(near, cand, 1), axis=1, kind="stable"), 1)
    away = 1 - np.take_along_axis(near, cand, 1)
    alive = np.ones_like(cand, bool)
    rows = np.arange(n)
    taken = [[] for _ in range(n)]
    for _ in range(DEGREE):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        pick_ = cand[rows, first]
        for i in np.flatnonzero(some):
            taken[i].append(pick_[i])
        alive[rows, first] = False
        between = 1 - near[pick_[:, None], cand]
        alive &= ~(ALPHA * between <= away)
    return [np.array(t, np.int64) for t in taken]


def _build(key: tuple, rows: list[dict]) -> Iterator[pa.RecordBatch]:
    points = np.array([np.frombuffer(r["unit"]) for r in rows])
    own = np.array([r["class"] for r in rows], np.int64)
    near: list[set[int]] = [set(t.tolist()) for t in pruned_graph(points)]
    for i, t in enumerate([list(s) for s in near]):
        for j in t:
            near[j].add(i)
    yield pa.RecordBatch.from_arrays(
        [pa.array(own), pa.array([own[list(s)].tolist() for s in near], pa.list_(pa.int64()))], names=["class", "near"])


def range_search(q: np.ndarray, points: np.ndarray, near: list[np.ndarray], start: int, beam: int,
                 threshold: float) -> np.ndarray:
    """Points with a cosine of at least ``threshold`` that a greedy search
    from ``start`` reaches, going on from every point near enough."""
    seen = np.zeros(len(points), bool)
    seen[start] = True
    score = float(points[start] @ q)
    todo, best = [(-score, start)], [score]           # open points; the beam's scores, least first
    found = [start] if score >= threshold else []
    while todo:
        s, u = heapq.heappop(todo)
        if len(best) >= beam and -s < best[0] and -s < threshold - SLACK:
            break
        new = near[u][~seen[near[u]]]
        if not len(new):
            continue
        seen[new] = True
        scores = points[new] @ q
        for v, s in zip(new.tolist(), scores.tolist()):
            if s >= threshold:
                found.append(v)
            if len(best) < beam:
                heapq.heappush(best, s)
            elif s > best[0]:
                heapq.heapreplace(best, s)
            elif s < threshold - SLACK:
                continue
            heapq.heappush(todo, (-s, v))
    return np.array(found, np.int64)


def _searcher(beam: int, threshold: float):
    def work(key: tuple, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        members = [r for r in rows if r["member"]]
        if not members:
            return
        own = np.array([r["class"] for r in members], np.int64)
        at = {c: i for i, c in enumerate(own.tolist())}
        points = np.array([np.frombuffer(r["unit"]) for r in members])
        near = [np.array([at[c] for c in r["near"] or () if c in at], np.int64) for r in members]
        middle = points.sum(axis=0)
        start = int((points @ middle).argmax())
        found: dict[int, set[int]] = {}
        for r in rows:
            c = r["class"]
            got = found.setdefault(c, set())
            got.update(range_search(np.frombuffer(r["unit"]), points, near, start, beam, threshold).tolist())
            got.discard(at.get(c, -1))
            if c in at:                     # found from one side is found from both
                for j in got:
                    found.setdefault(int(own[j]), set()).add(at[c])
        a = [c for c, got in found.items() for _ in got]
        b = [c for got in found.values() for c in own[list(got)].tolist()]
        if a:
            root, node = forest(np.array(a, np.int64), np.array(b, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["class", "peer"])
    return _by_cell(work, ["class", "peer"])


def shared_before(asked: list[list[int]], members: list[list[int]], shard: int) -> np.ndarray:
    """Which (query, member) pairs also share a shard before ``shard``."""
    before = sorted({s for m in members for s in m if s < shard})
    at = {s: i for i, s in enumerate(before)}

    def marks(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), len(before)), np.float32)
        for i, some in enumerate(lists):
            out[i, [at[s] for s in some if s in at]] = 1
        return out

    return marks(asked) @ marks(members).T > 0


def _compare(shard: int, members: list[dict], asked: list[dict], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the queries with the members of a cell, and their rows in the
    pairs that share no earlier shard."""
    if not members:
        return
    points = np.array([np.frombuffer(r["unit"]) for r in members])
    own = np.array([r["class"] for r in members], np.int64)
    copies = np.array([r["copies"] for r in members], np.int64)
    ids, counts, roots, nodes = [], [], [], []
    for k in range(0, len(asked), AT_ONCE):
        some = asked[k:k + AT_ONCE]
        c = np.array([r["class"] for r in some], np.int64)
        hit = np.array([np.frombuffer(r["unit"]) for r in some]) @ points.T >= threshold
        hit &= c[:, None] != own[None, :]
        linked = np.flatnonzero(hit.any(axis=1))
        if not len(linked):
            continue
        first = hit[linked] & ~shared_before([some[i]["shards"] for i in linked], [r["shards"] for r in members], shard)
        ids.append(c[linked])
        counts.append(first @ copies)
        i, j = np.nonzero(hit)
        root, node = forest(c[i], own[j])
        roots.append(root)
        nodes.append(node)
    if ids:
        linked, n = np.concatenate(ids), np.concatenate(counts)
        root, node = forest(np.concatenate(roots), np.concatenate(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[linked, node]), pa.array(np.r_[n, np.zeros(len(node), np.int64)]),
             pa.array(np.r_[linked, root])], names=["class", "n", "peer"])


def _comparer(threshold: float):
    """Compares the queries of each (dim, shard, cell) with all its members;
    members come first, queries are taken ``HELD`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, asked = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["dim"], row["shard"], row["cell"])
                if now != key:
                    if asked:
                        yield from _compare(key[1], members, asked, threshold)
                    key, members, asked = now, [], []
                if row["member"]:
                    members.append(row)
                elif len(asked) >= HELD:
                    yield from _compare(key[1], members, asked, threshold)
                    asked = []
                if row["asked"]:
                    asked.append(row)
        if asked:
            yield from _compare(key[1], members, asked, threshold)
    return run


def compared(rows: DataFrame, threshold: float) -> DataFrame:
    """(class, n, peer) of the rows asked for against the members of their cells."""
    rows = rows.select("dim", "shard", "cell", "class", "copies", "unit", "shards", "member", "asked")
    rows = rows.repartition("dim", "shard", "cell").sortWithinPartitions("dim", "shard", "cell", F.desc("member"))
    return staged(rows.mapInArrow(_comparer(threshold), LINKS), "vector-links")


def in_cells(placed: DataFrame) -> DataFrame:
    """Rows by each of their ``shards``, with the shard's number of cells."""
    in_shard = placed.withColumn("shard", F.explode("shards"))
    home = in_shard if "home" not in placed.columns else in_shard.where("shard = home")
    cells = home.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("long").alias("cells"))
    return in_shard.join(cells, ["dim", "shard"]).withColumn("cell", F.pmod(F.xxhash64("class"), F.col("cells")))


EVERY_CELL = "explode(sequence(0L, cells - 1))"


def search_links(classes: DataFrame, centres: np.ndarray, overlap: int, beam: int, threshold: float) -> DataFrame:
    """(class, n, peer): linked rows of other classes counted in a cell, and a
    class it is linked with, directly or through others."""
    dealt = in_cells(staged(classes.mapInArrow(_placer(centres, overlap), PLACED), "vector-places"))

    def together(df: DataFrame) -> DataFrame:
        return df.repartition("dim", "shard", "cell").sortWithinPartitions("dim", "shard", "cell", "class")

    built = together(dealt.select("dim", "shard", "cell", "class", "unit")).mapInArrow(_by_cell(_build, []), EDGES)
    graph = built.groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    graph = staged(graph, "vector-graph")
    visits = dealt.withColumn("home", F.col("cell")).withColumn("cell", F.expr(EVERY_CELL)).withColumn(
        "member", F.col("home") == F.col("cell"))
    asked = visits.join(graph, "class", "left").select(
        "dim", "shard", "cell", "class", "unit", "member", F.when(F.col("member"), F.col("near")).alias("near"))
    found = staged(together(asked).mapInArrow(_searcher(beam, threshold), FOUND), "vector-found")
    linked = found.select(F.explode(F.array("class", "peer")).alias("class")).distinct()
    visits = visits.join(linked.withColumn("asked", F.lit(True)), "class", "left")
    return compared(visits.withColumn("asked", F.coalesce("asked", F.lit(False))).where("member or asked"), threshold)


def _visitor(centres: np.ndarray, angles: np.ndarray, threshold: float):
    """The shards that may hold a vector near enough, by the triangle
    inequality; ``angles[s]`` is the largest of a member of s to its centre."""
    reach = angles + np.arccos(np.clip(threshold, -1, 1)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = []
            for raw in batch.column("unit"):
                u = np.frombuffer(raw.as_py())
                w = min(len(u), centres.shape[1])
                away = np.arccos(np.clip(centres[:, :w] @ u[:w], -1, 1))
                shards.append(np.flatnonzero(away <= reach).astype(np.int32).tolist())
            home = batch.column("shards").flatten()
            cols = [batch.column(c) for c in ("class", "copies", "unit", "dim")]
            yield pa.RecordBatch.from_arrays([*cols, home, pa.array(shards, pa.list_(pa.int32()))],
                                             names=["class", "copies", "unit", "dim", "home", "shards"])
    return run


def _leaner(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = batch.column("shards").flatten().to_numpy()
            near = []
            for raw, s in zip(batch.column("unit"), home):
                u = np.frombuffer(raw.as_py())
                w = min(len(u), centres.shape[1])
                near.append(float(centres[s, :w] @ u[:w]))
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(near, pa.float64())], names=["shard", "near"])
    return run


def exact_links(classes: DataFrame, centres: np.ndarray, threshold: float) -> DataFrame:
    """As ``search_links``, without a loss: each vector lies in its nearest
    shard and is compared with all shards that may hold one near enough."""
    placed = staged(classes.mapInArrow(_placer(centres, 1), PLACED), "vector-places")
    least = placed.mapInArrow(_leaner(centres), "shard int, near double").groupBy("shard").agg(F.min("near").alias("near"))
    angles = np.full(len(centres), -np.inf)
    for r in least.collect():
        angles[r.shard] = np.arccos(np.clip(r.near, -1, 1))
    dealt = in_cells(placed.mapInArrow(_visitor(centres, angles, threshold), VISITS))
    visits = dealt.withColumn("own", F.col("cell")).withColumn("cell", F.expr(EVERY_CELL))
    member = (F.col("shard") == F.col("home")) & (F.col("cell") == F.col("own"))
    # A member is in its home only, so that every pair has one shard.
    return compared(visits.withColumn("member", member).withColumn("asked", F.lit(True)).withColumn(
        "shards", F.array("shard")), threshold)


def _scan(queries: list[tuple[int, bytes]], threshold: float):
    ids = np.array([c for c, _ in queries], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim: dict[int, list[int]] = {}
        for i, (_, raw) in enumerate(queries):
            by_dim.setdefault(len(raw) // 8, []).append(i)
        for batch in batches:
            total, others = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            dims = batch.column("dim").to_numpy()
            own, copies = batch.column("class").to_numpy(), batch.column("copies").to_numpy()
            for dim, at in by_dim.items():
                rows = np.flatnonzero(dims == dim)
                if not len(rows):
                    continue
                points = np.array([np.frombuffer(batch.column("unit")[int(r)].as_py()) for r in rows])
                q = np.array([np.frombuffer(queries[i][1]) for i in at])
                hit = (q @ points.T >= threshold) & (ids[at][:, None] != own[rows][None, :])
                total[at] += hit @ copies[rows]
                others[at] += hit.sum(axis=1)
            some = others > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some]), pa.array(others[some])],
                                             names=["class", "n", "others"])
    return run


def linked_sample(classes: DataFrame, threshold: float) -> tuple[list, bool]:
    """(class, true, others) of sampled queries with a true partner, by brute
    force against all rows: linked rows and linked classes. Queries are drawn
    until the linked ones make up ``AUDIT_GROUPS`` groups or none is left;
    False if ``AUDIT_DRAWS`` did not suffice."""
    every = staged(classes.mapInArrow(_placer(np.zeros((1, 1)), 1), PLACED).withColumn(
        "draw", F.xxhash64(F.lit(9), "class")), "vector-audit")
    linked, drawn, rest = [], 0, every
    while sum(1 / (r.others + 1) for r in linked) < AUDIT_GROUPS:
        if drawn >= AUDIT_DRAWS:
            return linked, False
        asked = rest.select("class", "unit", "draw").orderBy("draw").limit(AUDIT_QUERIES).collect()
        if not asked:
            break
        scan = _scan([(r["class"], bytes(r.unit)) for r in asked], threshold)
        linked += every.mapInArrow(scan, "class long, n long, others long").groupBy("class").agg(
            F.sum("n").alias("true"), F.sum("others").alias("others")).collect()
        drawn, rest = drawn + len(asked), every.where(F.col("draw") > asked[-1].draw)
    return linked, True


def recall_of(linked: list, counts: DataFrame) -> float:
    """Recall of the link counts on the sample: the mean over the linked
    queries, or over their groups (so that large ones do not hide small ones),
    whichever is less."""
    if not linked:
        return 1.0
    spark = counts.sparkSession
    asked = spark.createDataFrame([(r["class"], r.true, r.others) for r in linked], "class long, true long, others long")
    got = asked.join(counts, "class", "left").select(
        (F.least("true", F.coalesce("n", F.lit(0))) / F.col("true")).alias("part"), (1 / (F.col("others") + 1)).alias("w"))
    r = got.agg(F.avg("part").alias("each"), (F.sum(F.col("part") * F.col("w")) / F.sum("w")).alias("group")).head()
    return min(r.each, r.group)


def audit(classes: DataFrame, counts: DataFrame, threshold: float = THRESHOLD) -> float:
    """Recall of the link counts on sampled queries against all rows."""
    return recall_of(linked_sample(classes, threshold)[0], counts)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``."""
    ship(vectors.sparkSession)
    rows, classes = usable_classes(vectors, column)
    centres = fit_clusters(classes, classes.count())
    linked, judged = linked_sample(classes, threshold)
    # Last, or if the sample cannot tell, all that may be near enough is compared.
    for overlap, beam in [*(EFFORTS if judged else ()), (None, None)]:
        links = search_links(classes, centres, overlap, beam, threshold) if overlap else exact_links(
            classes, centres, threshold)
        counts = staged(links.groupBy("class").agg(F.sum("n").alias("n")), "vector-counts")
        if overlap is None or recall_of(linked, counts) >= ENOUGH:
            break
    found = components(links.select(F.col("class").alias("a"), F.col("peer").alias("b")))
    named = found.join(classes.select(F.col("class").alias("node"), "least"), "node")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = found.join(names, "component").select(F.col("node").alias("class"), "component_id")
    each = classes.join(counts, "class", "left").join(linked, "class", "left").select(
        "class", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    out = rows.select("vec_id", "class").join(each, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
