"""Top-k, chat, WARC, embedding graph, components and the pipeline on hard
small fixtures."""

import gzip
import hashlib
import io
import json
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blockload.llm import chat, graph_dedup, mixing, ngram_join, queries, suffix_dedup, topk, toxicity, warc
from blockload.llm.components import components
from blockload.llm.queries import tokenizer_path

NAN, INF = float("nan"), float("inf")
CLASH = {"dim": 1, "class": "c", "x": 2, "digest": 3, "n": 4, "record": "r", "turns": "t", "label2": 1, "numbers": 7}


def clashing(df):
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items()})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] * (1 + i % 3) + rng.normal(size=16) * (0.1 if i % 2 else 0.5)).tolist())
            for i in range(400)]
    rows += [(400 + i, base[0].tolist()) for i in range(60)]      # copies
    rows += [(500, None), (520, []), (540, [0.0] * 16), (560, [NAN] * 16), (580, [1.0, None] + [0.5] * 14),
             (600, [INF] * 16), (620, [1.0, 2.0]), (640, [2.0, 4.0]), (660, [-1.0, -2.0]), (680, [1e-30] * 16),
             (700, base[1].tolist()), (None, base[2].tolist()), (None, None)]
    return rows


def frame(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))


def usable(x):
    return bool(x) and all(v is not None and np.isfinite(v) for v in x)


@pytest.mark.parametrize("scale,block", [(1, 4096), (300, 64)])
def test_top_k(spark, vectors, monkeypatch, scale, block):
    """At scale 300 cells are coarse, so bounds rule out less."""
    monkeypatch.setattr(topk, "BLOCK_VECTORS", block)
    rows = [(i, [v * scale if v is not None else None for v in x] if x is not None else None) for i, x in vectors]
    assert rows_of(topk.top_k(frame(spark, rows))) == brute_top_k(rows)


def brute_top_k(rows, step=20, k=20):
    """Over rows: rows of one id and rows that repeat are candidates too."""
    ints = [(i, [math.floor(64 * Fraction(v)) for v in x]) for i, x in rows if usable(x)]
    want = []
    for a, (q, x) in enumerate(ints):
        if q is not None and q % step == 0:
            scores = sorted((-sum(m * n for m, n in zip(x, y)), i is None, i or 0, i)
                            for b, (i, y) in enumerate(ints) if a != b and len(x) == len(y))
            want += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scores[:k])]
    return sorted(want, key=repr)


def test_top_k_of_one_id_and_of_large_numbers(spark, vectors, monkeypatch):
    """Rows of one id with other vectors, repeated queries, and components far
    past 2^24, where cells are coarse and sums pass 53 bits."""
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 64)
    rng = np.random.default_rng(9)
    rows = [(i % 7 * 20, rng.normal(size=16).tolist()) for i in range(60)] + vectors[:100]
    rows += [(i, (rng.normal(size=16) * 2.0 ** 22).tolist()) for i in range(300, 340)]
    rows += [(i, [float(2.0 ** rng.integers(12, 24) * s) for s in rng.choice([-1, 1], 8)]) for i in range(1000, 1060)]
    rows += [(1100, [2.0 ** 23.9] * 64), (1101, [2.0 ** 23.9, -2.0 ** 23.9] * 32), (1120, [1e-300] * 64), (1121, [0.0] * 64)]
    rows += [(1200, [1e100, 0.0, 1.0]), (1201, [0.0, 1e100, 2.0]), (1202, [-1e100, 0.0, 2.0])]
    want = [w for w in brute_top_k(rows) if w[0] != 1200]
    got = rows_of(topk.top_k(frame(spark, [r for r in rows if r[0] != 1202])))
    assert [g for g in got if g[0] != 1200] == want
    assert [g for g in got if g[0] == 1200] == [(1200, 1, 1201, 64 * 128)]
    for more in ([(1202, [-1e100, 0.0, 2.0])], [(1203, [1e300, 0.0, 2.0])]):
        with pytest.raises(Exception, match="OVERFLOW|2\\^490"):
            topk.top_k(frame(spark, [(1200, [1e100, 0.0, 1.0]), *more])).collect()


def test_near_duplicates(spark, vectors):
    rows = [r for r in vectors]
    got = {r.vec_id: r for r in graph_dedup.near_duplicates(frame(spark, rows)).collect() if r.vec_id is not None}
    units = [(i, np.array(x) / np.linalg.norm(x)) for i, x in rows if usable(x) and np.any(np.array(x) != 0)]
    true = found = 0
    edges = []
    for a, (i, u) in enumerate(units):
        near = [j for b, (j, v) in enumerate(units) if b != a and len(u) == len(v) and u @ v >= 0.9]
        edges += [(i, j) for j in near if i is not None and j is not None]
        if i is not None:
            true, found = true + len(near), found + got[i].n_links
            assert got[i].n_links <= len(near)
    assert found / true >= 0.97
    for i in (500, 520, 540, 560, 580, 600):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[640].component_id == 620 and got[660].component_id == 660
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    same = sum(got[i].component_id == root(i) for i in parent)
    assert same >= 0.97 * len(parent)


def test_salted_cells_lose_no_links(spark, vectors, monkeypatch):
    monkeypatch.setattr(graph_dedup, "CELL", 40)
    monkeypatch.setattr(graph_dedup, "MOST_CLUSTERS", 2)
    rows, classes = graph_dedup.usable_classes(frame(spark, vectors), "embedding")
    centres = graph_dedup.fit_clusters(classes, classes.count())
    links = graph_dedup.search_links(classes, centres, 2, 32, 0.9)
    assert graph_dedup.audit(classes, links.groupBy("class").agg(F.sum("n").alias("n"))) >= 0.9


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(300)] + [(7000, 7000)]
    edges += [(3000 + rnd.randrange(80), 3000 + rnd.randrange(80)) for _ in range(60)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}


# --- chat

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "\\", "<", "\n", "</s>\n", "<s>user\n", "é😀", "%0A"]


def test_conversations_come_back(spark):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, "to%ol\n</s>"]),
             None if rnd.random() < 0.1 else "".join(rnd.choice(CONTROL) for _ in range(rnd.randint(0, 12))))
            for c in [*range(40), None] for t in [0, 1, 2, 2, None]]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    made = chat.format_turns(chat.canonical_turns(chat.conversation_records(df)))
    got = made.select("conv_id", "layout", "formatted", chat.read_back(F.col("formatted")).alias("back"),
                      chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked")).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert len(got) == len(want)
    for r in got:
        assert r.layout == "messages" and [tuple(t) for t in r.back] == want[r.conv_id]
        assert r.masked == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        bare = "".join(r.formatted.split("</s>\n"))
        assert bare.count("<s>") == len(want[r.conv_id]) and "[INST]" not in bare and "</s>" not in bare


def test_layouts_are_told_apart_by_their_paths(spark):
    records = {
        '{"messages":[{"role":"user","content":"a"},{"content":"b","role":"assistant"}]}': ("messages", ["user a", "assistant b"]),
        '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}': ("sharegpt", ["user a", "assistant b"]),
        '{"prompt":"a","response":null}': ("prompt", ["user a", "assistant "]),
        '{"instruction":"a","input":"","output":"b"}': ("alpaca", ["user a", "assistant b"]),
        '{"output":"b","input":"c","instruction":"a"}': ("alpaca", ["user a\n\nc", "assistant b"]),
        '{"system":"s","prompt":"a","response":"b"}': ("system_prompt", ["system s", "user a", "assistant b"]),
        '{"question":"a","answer":"b"}': ("question", ["user a", "assistant b"]),
        '{"text":"a"}': ("unknown", None),
        '{"messages":[{"role":"user","content":{"x":1}}]}': ("unknown", None),
        '{"messages":[]}': ("unknown", None),
    }
    df = spark.createDataFrame([(j,) for j in records], "j string").withColumn("record", F.parse_json("j"))
    got = chat.canonical_turns(clashing(df).drop("record").withColumn("record", F.parse_json("j"))).collect()
    for r in got:
        turns = None if r.turns is None else [f"{t.role} {t.text}" for t in r.turns]
        assert (r.layout, turns) == records[r.j]


# --- WARC

@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(6)
    big = ["".join(rnd.choice("<p>abc é\n") for _ in range(2000)) for _ in range(6)]
    rows = [(i, f"http://x/{i}", rnd.choice(big) if i % 2 else f"<p>{i % 9}") for i in range(150)]
    noise = "".join(chr(rnd.randrange(32, 0x2FF)) for _ in range(200_000))
    return rows + [(900, None, None), (901, "a b\n\x7f", ""), (902, "", noise), (902, "", noise), (903, "u", noise),
                   (None, "u", big[0]), (None, None, None), (904, "u", "x" * 999), (905, "u", "x" * 999),
                   (906, "u", "y" * 1000), (907, "u", "y" * 1000)]


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            first[h] = max(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        top = first.get(h) if i is not None else None
        other = top is not None and i < top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response", top if other else None))
    return sorted(out, key=repr)


def test_archives_come_back(spark, pages, tmp_path):
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3))
    files = warc.write_archives(df, str(tmp_path / "out"))
    assert sum(r.records for r in files.collect()) == len(pages)
    for size in (1 << 24, 5000, 777):       # ranges shorter than members too
        back = warc.read_archives(files, range_bytes=size)
        got = rows_of(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
        assert got == brute_pages(pages)
    html = {(r.page_id, bytes(r.payload).decode()) for r in back.where("record_type = 'response'").collect()}
    assert html <= {(i, h or "") for i, _, h in pages}


def test_a_plain_reader_understands_the_archives(spark, pages, tmp_path):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in warc.write_archives(df, str(tmp_path / "out")).collect():
        with open(r.path, "rb") as f:
            data = gzip.decompress(f.read())
        assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC/1.1\r\n") >= r.records
        for line in data.split(b"\r\n"):
            if line.startswith(b"WARC-Target-URI:"):
                assert b" " not in line[17:] and line[17:]


def test_magic_inside_members_is_not_a_record():
    """Members that hold, uncompressed, bytes that look like members."""
    fake = warc.MAGIC + b"\x00" * 20 + warc.MAGIC
    data, starts = b"", []
    for i in range(30):
        starts.append(len(data))
        raw = gzip.compress(b"WARC/1.1\r\nX: 1\r\n\r\n" + fake * i + bytes(range(256)) * 30, compresslevel=0 if i % 2 else 6)
        data += raw

    class Source:
        def read_at(self, n, at):
            return data[at:at + n]

    for step in (1, 100, 5000, len(data)):
        got = [at for b in range(0, len(data), step)
               for at, part, _, _ in warc.members(Source(), b, min(b + step, len(data)), len(data), window=300)
               if part >= 0]
        assert got == starts
        if step == 1:
            continue
    assert not list(warc.members(io.BytesIO(b""), 0, 0, 0))


def record(i, payload):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return (f"WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: {i}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
            + block + b"\r\n\r\n")


@pytest.fixture(scope="module")
def strange_archives(spark, tmp_path_factory):
    """name -> (bytes, page ids that can be read, damages)."""
    body = [record(i, b"text %d " % i * 300) for i in range(6)]
    zipped = [gzip.compress(b) for b in body]
    broken = bytearray(zipped[1])
    broken[-6] ^= 1                                                     # the checksum
    lost = b"\x00\x01" + zipped[1][2:]                                  # no magic
    cases = {
        "many": (gzip.compress(b"".join(body[:3])) + zipped[3] + gzip.compress(b"".join(body[4:])), range(6), 0),
        "plain": (b"".join(body), range(6), 0),
        "plain-cut": (b"".join(body)[:-900], range(5), 1),
        "cut": (b"".join(zipped)[:-20], range(5), 1),
        "cut-early": (b"".join(zipped[:5]) + zipped[5][:6], range(5), 1),
        "broken": (zipped[0] + bytes(broken) + zipped[2], (0, 2), 1),
        "lost": (zipped[0] + lost + zipped[2], (0, 2), 1),
        "padded": (zipped[0] + bytes(700) + zipped[1], (0, 1), 0),
        "length": (zipped[0] + gzip.compress(body[1].replace(b"Length: ", b"Length: x")) + zipped[2], (0, 2), 1),
        "empty": (b"", (), 0),
    }
    folder = tmp_path_factory.mktemp("warc")
    for name, (data, _, _) in cases.items():
        (folder / f"{name}.warc").write_bytes(data)
    return folder, cases


@pytest.mark.parametrize("size", [1 << 24, 100])
def test_strange_archives_lose_nothing_in_silence(spark, strange_archives, size):
    folder, cases = strange_archives
    files = spark.createDataFrame([(n, str(folder / f"{n}.warc"), len(d)) for n, (d, _, _) in cases.items()],
                                  "name string, path string, bytes long")
    got = warc.read_archives(files.select("path", "bytes"), range_bytes=size, damaged="report").collect()
    for name, (_, ids, damages) in cases.items():
        rows = [r for r in got if r.path.endswith(f"/{name}.warc")]
        found = [r for r in rows if r.record_type == "response"]
        assert sorted(r.page_id for r in found) == sorted(ids), name
        assert all(bytes(r.payload) == b"text %d " % r.page_id * 300 for r in found)
        assert len(rows) - len(found) == damages, name
        if damages:
            with pytest.raises(Exception, match=f"{name}.warc at byte"):
                warc.read_archives(files.where(F.col("name") == name).select("path", "bytes"), range_bytes=size).collect()


# --- queries and the pipeline

def test_empty_tables(spark):
    vec = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vec).count() == 0
    assert graph_dedup.near_duplicates(vec).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_records(pages).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(chat.canonical_turns(chat.conversation_records(rows))).count() == 0


def test_contract_columns(spark):
    want = {
        "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "passage_bytes",
                             "in_other_documents"],
        "op4_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        "op6_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        "op8_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op10_mix": ["doc_id", "size", "source_size", "target", "taken"],
    }
    for name, cols in want.items():
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns == cols


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, queries.table(spark, sf, "labels")).where("rejected").collect()}
    one = docs.where(~F.col("doc_id").isin(list(toxic) or [-1]))
    groups = ngram_join.jaccard_components(one, 5, 80).where("doc_id = component_id or n_shingles = 0")
    two = one.join(groups.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    three = suffix_dedup.without_repeats(two, 256, 50)
    four = rows_of(mixing.mixed_documents(three).select("doc_id", "source"))
    out = corpus_pipeline.run(spark, sf)
    assert rows_of(out.select("doc_id", "source")) == four and len(four) > 100
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in three.collect()}
    for r in out.select("doc_id", "n_tokens", "ids").limit(50).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and ids == library.encode(text[r.doc_id], add_special_tokens=False).ids


def test_records_of_json_files(spark, tmp_path):
    lines = [{"prompt": "a", "response": "</s>"}, {"messages": [{"role": "user", "content": "x"}]}]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)))
    records = spark.read.text(str(tmp_path / "r.jsonl")).select(F.parse_json("value").alias("record"))
    made = chat.format_turns(chat.canonical_turns(records)).select("layout", "formatted").collect()
    assert {r.layout for r in made} == {"prompt", "messages"} and all(r.formatted.startswith("<s>user\n") for r in made)


def lone_pairs_beside_a_large_group():
    """A group of 200 near copies, and 150 pairs of vectors that have one partner each."""
    rng = np.random.default_rng(8)
    base, singles = rng.normal(size=32), rng.normal(size=(150, 32))
    rows = [(i, (base + rng.normal(size=32) * 0.05).tolist()) for i in range(200)]
    for k, x in enumerate(singles):
        rows += [(1000 + 2 * k, x.tolist()), (1001 + 2 * k, (x + rng.normal(size=32) * 0.3).tolist())]
    units = np.array([np.array(x) / np.linalg.norm(x) for _, x in rows])
    return rows, dict(zip([i for i, _ in rows], ((units @ units.T >= 0.9).sum(axis=1) - 1).tolist()))


def test_lost_lone_pairs_fail_the_audit(spark):
    rows, true = lone_pairs_beside_a_large_group()
    _, classes = graph_dedup.usable_classes(frame(spark, rows), "embedding")
    kept = spark.createDataFrame([(i, n) for i, n in true.items() if i < 1000], "least long, n long")
    assert graph_dedup.audit(classes, classes.join(kept, "least").select("class", "n")) < 0.9


@pytest.mark.parametrize("draws", [65_536, 0])
def test_links_are_whole_when_no_effort_is_enough(spark, monkeypatch, draws):
    """One shard to a vector and a beam of one lose pairs across 20 clusters;
    without draws the audit cannot tell."""
    rows, true = lone_pairs_beside_a_large_group()
    monkeypatch.setattr(graph_dedup, "EFFORTS", ((1, 1),))
    monkeypatch.setattr(graph_dedup, "CELL", 25)
    monkeypatch.setattr(graph_dedup, "AUDIT_DRAWS", draws, raising=False)
    got = {r.vec_id: r.n_links for r in graph_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == true


def test_a_pair_found_only_in_a_later_shard_counts(spark, monkeypatch):
    """A pair that the search sees in one of its shards only is counted once."""
    rows, true = lone_pairs_beside_a_large_group()
    _, classes = graph_dedup.usable_classes(frame(spark, rows), "embedding")
    monkeypatch.setattr(graph_dedup, "CELL", 200)
    whole = graph_dedup._searcher

    def late(beam, threshold):
        run = whole(beam, threshold)

        def only_last(batches):
            for batch in batches:
                yield from run(iter([batch.filter([s != 0 for s in batch.column("shard").to_pylist()])]))
        return only_last

    monkeypatch.setattr(graph_dedup, "_searcher", late)
    centres = graph_dedup.fit_clusters(classes, 400)
    assert len(centres) == 2
    links = graph_dedup.search_links(classes, centres, 2, 32, 0.9).groupBy("class").agg(F.sum("n").alias("n"))
    got = {r.least: r.n for r in classes.join(links, "class").collect()}
    assert got == {i: n for i, n in true.items() if n}


def test_passages_of_short_words_go(spark):
    """51 words of one to three letters repeat; so do, apart from each other,
    two neighbours of 30 words, which stay."""
    rnd = random.Random(12)

    def words(n, size):
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(*size))) for _ in range(n))

    passage, one, two = words(51, (1, 3)), words(30, (5, 6)), words(30, (5, 6))
    least = " ".join(rnd.choice("abcdefgh") for _ in range(51))
    assert len(passage) < 256 and len(least) == 101
    fills = [words(40, (6, 6)) for _ in range(14)]
    texts = [f"{fills[0]} {passage} {fills[1]}", f"{fills[2]} {passage} {fills[3]}",
             f"{fills[4]} {one} {two} {fills[5]}", f"{fills[6]} {one} {fills[7]}", f"{fills[8]} {two} {fills[9]}",
             f"{fills[10]} {least} {fills[11]}", f"{fills[12]} {least} {fills[13]}"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text.split() for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    want = {i: t.replace(passage, "").replace(least, "").split() for i, t in enumerate(texts)}
    assert got == want
