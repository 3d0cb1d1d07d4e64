"""Operators on documents against brute force, on hard small fixtures:
nulls in any column, empty and very long texts, ties and repeated rows, empty
tables, extra columns with clashing names."""

import hashlib
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blockload.llm import bpe, mixing, ngram_join, runtime, suffix_dedup, token_counts, toxicity
from blockload.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = {"d1": 1, "key": "k", "size": 3, "target": 2.0, "total": 1, "class": 5, "digest": "x", "ids": "y", "rank": 1,
         "n": 1, "spans": "s", "doc": 1, "rejected": "no", "p_toxic": 2, "content": "c", "row": 1, "bucket": 0}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    words = ["é" + "".join(rnd.choice("abcDEfgh") for _ in range(rnd.randint(1, 6))) for _ in range(300)]

    def para(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared = [para(rnd.randint(60, 200)) for _ in range(6)]
    out = []
    for i in range(60):
        text = para(rnd.randint(0, 150))
        for _ in range(rnd.randint(0, 3)):
            b = rnd.choice(shared)
            cut = rnd.randint(0, len(b) // 2)
            text += " " + b[cut:rnd.randint(cut, len(b))] + " " + para(rnd.randint(0, 60))
        out.append((i, text))
    for g in range(20):
        n = rnd.choice([1, 2, 3, 4, 5, 6, 7, 8, 12, 30, 90, 300])
        base = para(n).split(" ")
        for c in range(5):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, n // 25))):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            out.append((100 + 10 * g + c, " ".join(t)))
    out += [(900, None), (901, ""), (902, " \n\t"), (903, "a b c"), (904, "A B\tC"), (905, "ab" * 900),
            (906, "x" * 399), (907, "x" * 400), (908, "x" * 401), (909, "x" * 399), (None, out[7][1]), (None, None),
            (5, out[5][1]), (5, out[5][1]), (6, out[9][1]), (910, para(30_000)), (911, "y" * 150_000),
            (912, "<|endoftext|>a<|endoftext|><|ENDOFTEXT|> b")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if k % 7 == 0 else "en", None if k % 11 == 0 else f"s{k % 3}", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def clashing(df):
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items()})


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def brute_spans(texts, length=400):
    raws = [(d, (t or "").encode()) for d, t in texts]
    count = Counter(r[i:i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone[:-1]].tobytes()
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((d, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_passages(texts, size=51):
    """Runs of words in strings of ``size`` words that stand in two places, and
    in two documents, as byte spans."""
    raws = [(t or "").encode() for _, t in texts]
    words = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raws]
    strings = [[tuple(r[a:b] for a, b in w[i:i + size]) for i in range(len(w) - size + 1)] for r, w in zip(raws, words)]
    places, owners = Counter(x for s in strings for x in s), Counter(x for s in strings for x in set(s))

    def runs(w, marks):
        return suffix_dedup.merge_spans([(w[i][0], w[i + size - 1][1]) for i, m in enumerate(marks) if m])

    return ([runs(w, [places[x] > 1 for x in s]) for w, s in zip(words, strings)],
            [runs(w, [owners[x] > 1 for x in s]) for w, s in zip(words, strings)])


@pytest.mark.parametrize("hot,few", [(100_000, 10_000), (2, 0)])
def test_repeated_spans(docs, texts, hot, few, monkeypatch):
    """Of bytes, and of words in other documents; all anchors hot, or met by a
    broadcast."""
    short = [t for t in texts if len(t[1] or "") < 20_000]
    monkeypatch.setattr(suffix_dedup, "HOT_WINDOWS", hot)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", few)
    some = docs.where("coalesce(length(text), 0) < 20000")
    got = suffix_dedup.span_report(some).cache()
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_spans(short)
    shared = brute_passages(short)[1]
    want = [(i, len(r), sum(e - b for b, e in r), bool(r)) for (i, _), r in zip(short, shared)]
    assert rows_of(got, "doc_id", "n_passages", "passage_bytes", "in_other_documents") == sorted(want, key=repr)
    assert any(len(r) > 1 for r in shared)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_repeated_passages(spark, hot, monkeypatch):
    """Words of one to three letters, other white space between them, runs that
    touch, repeats in one text, copies: cut are the strings of 51 equal words."""
    monkeypatch.setattr(suffix_dedup, "HOT_WINDOWS", hot)
    rnd = random.Random(8)

    def words(n, most=3):
        return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, most))) for _ in range(n)]

    def text(w):
        return "".join(x + rnd.choice([" ", " ", "  ", "\n", "\t"]) for x in w)

    shared = [words(rnd.randint(48, 56)) for _ in range(8)] + [words(300)]
    rows = []
    for i in range(80):
        parts = words(rnd.randint(0, 40), 9)
        for _ in range(rnd.randint(0, 3)):
            parts = parts + rnd.choice(shared) + words(rnd.choice([0, 0, 5]))
        rows.append((i, text(parts)))
    rows += [(100, rows[3][1]), (101, " " + text(shared[-1]) + " "), (101, " " + text(shared[-1])), (102, None),
             (103, ""), (104, "x " * 200), (105, text(words(50))), (106, "y" * 3000 + " " + text(shared[-1]))]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(4)
    got = suffix_dedup.repeated_spans(df, over_words=50)
    found = sorted(((r.doc_id, r.text, tuple((s.begin, s.end) for s in r.spans)) for r in got.collect()), key=repr)
    assert found == sorted(((i, t, tuple(s)) for (i, t), s in zip(rows, brute_passages(rows)[0])), key=repr)


def test_passages_of_a_long_text(monkeypatch):
    """Pieces of any size file the same strings; words larger than a piece too."""
    rnd = random.Random(9)
    raw = " ".join("w" * rnd.choice([1, 2, 3, 900]) + str(rnd.randint(0, 9)) for _ in range(400)).encode()
    kind = suffix_dedup.ByWord(51)

    def strings():
        found = set()
        for at, piece in kind.pieces(raw):
            w = [m.span() for m in re.finditer(rb"\S+", piece)]
            found |= {(at + a, at + b) for (a, _), (_, b) in zip(w, w[50:])}
        return found

    whole = strings()
    monkeypatch.setattr(suffix_dedup, "BUFFER", 700)
    assert len(list(kind.pieces(raw))) > 3 and strings() == whole and len(whole) == 350


def test_repeated_spans_in_a_long_text(spark):
    rnd = random.Random(1)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(500))
    fill = "".join(rnd.choice("ijklmnop") for _ in range(1 << 20))
    rows = [(1, fill + part + fill[::-1] + part, None, None, None)]
    got = suffix_dedup.span_report(spark.createDataFrame(rows, SCHEMA)).head()
    assert (got.n_removed, got.n_spans) == (1000, 2)


def test_only_long_passages_go(spark):
    rnd = random.Random(2)

    def words(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))

    long, short = words(60), words(45)
    rows = [(i, f"{words(40)} {long if i < 2 else short} {words(40)}", None, None, None) for i in range(4)]
    out = {r.doc_id: r.text for r in suffix_dedup.without_repeats(
        spark.createDataFrame(rows, SCHEMA), 256, 50).collect()}
    assert all(long not in out[i] and 78 <= len(WORD.findall(out[i])) <= 82 for i in (0, 1))
    assert out[2] == rows[2][1] and out[3] == rows[3][1]


def test_columns_of_the_collection_match_a_plain_comparison():
    rnd = np.random.default_rng(0)
    columns = rnd.integers(0, 2, (14, 60)).astype(np.int16)
    columns[rnd.random(columns.shape) < 0.02] = -1
    group = np.sort(rnd.integers(0, 5, 60))
    hits = suffix_dedup.repeated_starts(columns, group, 5)
    for c in range(10):
        for i in range(60):
            own = columns[c:c + 5, i]
            want = (own != suffix_dedup.NONE).all() and any(
                j != i and group[j] == group[i] and (columns[c:c + 5, j] == own).all() for j in range(60))
            assert hits[c, i] == want


def test_without_repeats_keeps_schema_and_clean_documents(docs, texts):
    df = clashing(docs)
    out = suffix_dedup.without_repeats(df)
    assert out.schema == df.schema
    kept = {r.doc_id: r.text for r in out.collect()}
    spans = {d: s for d, _, _, s, _ in brute_spans([t for t in texts if len(t[1] or "") < 20_000])}
    by_id = dict(texts)
    for d in (0, 903, 906, 901, 900, 910):
        assert kept[d] == by_id[d] or spans.get(d)
    assert 907 not in kept      # nothing was left


def brute_components(texts, words, percent):
    sets = []
    for _, t in texts:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words
                    else ({tuple(w)} if w else set()))
    inverted = {}
    for i, s in enumerate(sets):
        for g in s:
            inverted.setdefault(g, []).append(i)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, o in Counter(j for g in s for j in inverted[g] if j > i).items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    name = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            name[root(i)] = min(name.get(root(i), d), d)
    return sorted(((d, len(sets[i]), name.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(texts)), key=repr)


@pytest.mark.parametrize("chunk,flush,words,percent", [(1024, 1 << 20, 4, 85), (8, 50, 5, 80), (8, 1 << 20, 4, 85)])
def test_jaccard_components(docs, texts, monkeypatch, chunk, flush, words, percent):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "FLUSH_ROWS", flush)
    monkeypatch.setattr(ngram_join, "SHARED", 2)
    got = rows_of(ngram_join.jaccard_components(clashing(docs), words, percent), "*")
    assert got == brute_components(texts, words, percent)


def test_block_counts_cover_every_possible_difference():
    levels = ngram_join.Levels(85)
    for a in range(1, 3000):
        b = a * 100 // 85                       # the largest possible partner
        least = -(-85 * (a + b) // 185)
        shared = set(levels.of(a)) & set(levels.of(b))
        assert any(levels.blocks[i] - levels.spare[i] > a + b - 2 * min(a, least) for i in shared)


def test_one_document_of_each_group_stays(docs, texts):
    df = clashing(docs)
    out = ngram_join.without_near_copies(df, 5, 80)
    assert out.schema == df.schema
    kept = Counter(r.doc_id for r in out.collect())
    want = brute_components(texts, 5, 80)
    groups = {c for d, n, c in want if n}
    for d, n, c in want:
        if d is not None and n:
            assert (d in kept) == (d == c)
    assert groups - {None} <= set(kept)
    assert kept[5] == 1 and 900 in kept and 901 in kept


def test_mix_meets_its_targets(docs, texts):
    got = [r.asDict() for r in mixing.mix(clashing(docs)).collect()]
    assert len(got) == len(texts)
    total = sum(len(WORD.findall(t or "")) for _, t in texts)
    by_source = {}
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] in (0, r["size"], 2 * r["size"])
        assert r["d1"] == 1 and r["class"] == 5
        s = by_source.setdefault(r["source"], {"target": r["target"], "size": r["source_size"], "taken": 0, "most": 0})
        s["taken"] += r["taken"]
        s["most"] = max(s["most"], r["size"])
    assert abs(sum(s["target"] for s in by_source.values()) - 1.5 * total) < 1e-6
    for s in by_source.values():
        assert s["target"] <= 2 * s["size"] and abs(s["taken"] - s["target"]) <= s["most"]
    again = Counter((r.doc_id, r.text, r.source, r.taken) for r in mixing.mix(docs.repartition(3)).collect())
    assert again == Counter((r["doc_id"], r["text"], r["source"], r["taken"]) for r in got)


def test_mix_tells_rows_of_one_id_apart(spark, monkeypatch):
    """Null ids with texts of their own, and rows that repeat whole, over many
    parts: each has its place, so targets are met to a document."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rows = [(i, f"{i} a a a a", "a") for i in range(300)]
    rows += [(None, f"{i} b" + " b" * (i % 9), "b") for i in range(800)]
    rows += [(7, "the same row again", "c")] * 900 + [(None, "no id", None)] * 500 + [(None, None, "c")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = []
    for parts in (9, 2):
        got = mixing.mix(df.repartition(parts), columns=["doc_id"]).collect()
        assert len(got) == len(rows) and got[0].__fields__[0] == "doc_id"
        by_target = {}
        for r in got:
            t = by_target.setdefault((r.target, r.source_size), [0, 0])
            t[0], t[1] = t[0] + r.taken, max(t[1], r.size)
            assert r.taken in (0, r.size, 2 * r.size)
        assert len(by_target) == 4
        for (target, _), (taken, most) in by_target.items():
            assert abs(taken - target) <= most
        runs.append(Counter((r.doc_id, r.size, r.target, r.taken) for r in got))
    assert runs[0] == runs[1]


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 100}, {"a": 0, "b": 0}, {"x": 7},
                                   {"a": 1, "b": 1, "c": 10_000, "d": 3, "é": 40, "Z": 8}])
def test_source_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mixed_documents_repeat_what_is_taken(docs):
    df = clashing(docs)
    out = mixing.mixed_documents(df)
    assert out.dtypes == df.dtypes
    taken = {(r.doc_id, r.text): r.taken for r in mixing.mix(docs).collect() if r.doc_id not in (5, None)}
    rows = Counter((r.doc_id, r.text) for r in out.collect())
    for (d, t), words in taken.items():
        size = len(WORD.findall(t or ""))
        assert rows[d, t] == (words // size if size else 0)


def test_bpe_matches_the_library(docs, texts):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    out = bpe.decode(bpe.encode(clashing(docs), path), path)
    assert len(out.columns) == len(set(out.columns))
    for r in out.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_on_random_strings():
    path = tokenizer_path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    rnd = random.Random(1)
    bits = ["a", "aa", " ", "the", "ing", "<|endoftext|>", "é", "😀", "1", "23", "!!", "\n", "  ", "　", "x", "-",
            "==", "_", "tion", "'s", "\x85", "\x1c", "²", "ั"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, docs, texts, tmp_path, name):
    path, cache = tokenizer_path(name), str(tmp_path / "cache")
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    want = sorted(((d, len((t or "").encode()), count(t or ""), count(t or "") > 2048) for d, t in texts), key=repr)
    half = token_counts.token_counts(docs.where("doc_id % 2 = 0"), path, cache).count()
    stored = spark.read.parquet(cache).count()
    assert half and stored
    assert rows_of(token_counts.token_counts(clashing(docs), path, cache), "*") == want
    assert spark.read.parquet(cache).count() > stored
    full = spark.read.parquet(cache).count()
    assert rows_of(token_counts.token_counts(docs, path, cache), "*") == want
    assert spark.read.parquet(cache).count() == full      # nothing was encoded anew


def test_distinct_misses_are_encoded_once(spark, tmp_path):
    """50 rows of null id and 10 of one id hold two texts (white space apart):
    two counts are stored, and a second call stores none."""
    path, cache = tokenizer_path("word_bpe_49k.json"), str(tmp_path / "cache")
    rows = [(None, "one text here" + " " * (i % 3)) for i in range(50)] + [(7, "another  one") for _ in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for _ in range(2):
        assert token_counts.token_counts(df, path, cache).count() == 60
        assert spark.read.parquet(cache).count() == 2


def test_words_by_themselves_count_as_in_the_text():
    path = tokenizer_path("word_bpe_49k.json")
    assert token_counts.word_by_word(path)
    assert not any(token_counts.word_by_word(tokenizer_path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    rnd, whole = random.Random(6), token_counts.load_tokenizer(path)
    marks = ["a", "Z", "é", "e\u0301", "\u0301", "Σ", "ς", "İ", "ﬁ", "日", "\u00a0", "\u2003", "\u0085", "\u200b", "'s", "'", "9",
             "<|endoftext|>", "<|start", "oftext|>", "the", "ing", " ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c", ".", "\x00", "🙂", "ก็"]
    texts = ["".join(rnd.choices(marks, k=rnd.randint(0, 40))) for _ in range(3000)]
    for start in range(0, 3000, 500):
        part = texts[start:start + 500]
        assert token_counts.count_words(path, [t.encode() for t in part]) == whole(part)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 10)
    text = "one two  three <|endoftext|> four'll fünf 12 345\n\nsix " * 20
    pieces = token_counts._pieces(text, 10)
    assert "".join(pieces) == text and len(pieces) > 50
    count = token_counts.load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    assert sum(count(pieces)) == count([text])[0]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 4 <> 0")
    held = labels.where("doc_id % 4 = 0")
    scored = toxicity.toxicity(docs, seen).join(held.withColumnRenamed("quality", "q"), "doc_id")
    c = {(r.toxic, r.rejected): r["count"] for r in scored.groupBy("toxic", "rejected").count().collect()}
    assert c[1, True] / (c[1, True] + c.get((1, False), 0)) > 0.9
    assert c.get((0, True), 0) / (c[0, False] + c.get((0, True), 0)) < 0.02


def test_toxicity_against_one_process(spark, monkeypatch):
    """The same rows, models and probabilities as without Spark."""
    monkeypatch.setattr(toxicity, "LEAST_ROWS", 30)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {}
    for r in labels.withColumn("h", F.xxhash64("doc_id")).collect():
        if r.toxic is not None:
            y = known.setdefault(r.doc_id, (r.h, [0.0, 0.0]))[1]
            y[0], y[1] = max(y[0], float(r.quality == 0)), max(y[1], float(r.toxic == 1))
    order = sorted(known, key=lambda d: (known[d][0], d))
    groups = {}
    for d in order:
        groups.setdefault(tuple(known[d][1]), []).append(d)
    first = {d for g in groups.values() for d in g[:30]}
    chosen = sorted(order, key=lambda d: (d not in first, known[d][0], d))[:250]
    assert len(chosen) == 250 < len(known)
    weight = {d: len(g) / sum(x in chosen for x in g) for g in groups.values() for d in g}
    chosen = sorted(d for d in chosen if d in texts)
    made = [toxicity.features(texts[d]) for d in chosen]
    models = toxicity.fit_chain(toxicity.Sample([c for c, _ in made], [v for _, v in made]),
                                np.array([known[d][1] for d in chosen]),
                                np.array([zlib.crc32(str(d).encode()) % toxicity.FOLDS for d in chosen]),
                                np.array([weight[d] for d in chosen]))
    fitted = toxicity.train(docs, labels, [F.coalesce(F.col("quality") == 0, F.lit(False)), F.col("toxic") == 1], 250)
    assert [m.category for m in fitted] == sorted(models) == [0, 1]
    want = {}
    for d, t in texts.items():
        columns, values = toxicity.features(t)
        p = []
        for k in (0, 1) if len(columns) else ():
            b, e, w, _ = models[k]
            p.append(1 / (1 + np.exp(-(values @ w[columns].astype(float) + b + sum(x * q for x, q in zip(e, p))))))
        want[d] = (p or [0.0, 0.0]) + [bool(p) and p[1] >= models[1][3]]
    got = toxicity.score(docs, fitted, ["p_unfit", "p_toxic"]).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.p_unfit, r.p_toxic) == pytest.approx(want[r.doc_id][:2], abs=1e-6) and r.rejected == want[r.doc_id][2]


def test_toxicity_with_labels_in_parts(spark):
    """A category that cannot be learned stops no other; labels of a row that
    is there twice count each by itself; rare labels are in the sample."""
    rnd = random.Random(4)
    bad, good = ["slurb", "vexon", "grawk"], [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choices(good, k=30) + ([rnd.choice(bad)] * 3 if i % 5 == 0 else []))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kind = "doc_id long, quality int, toxic int"
    toxic = {i for i in range(0, 300, 5)}
    cases = {
        "no quality": [(i, None, int(i in toxic)) for i in range(300)],
        "other label first": [(i, 1, 0) for i in range(300)] + [(i, 0 if i % 3 else 1, int(i in toxic)) for i in range(300)],
        "unfit of clean rows": [(i, 0, 0) for i in range(300)] + [(i, 1, 1) for i in toxic],
        "rare": [(i, 1, int(i in toxic)) for i in range(300)] + [(10_000 + i, 1, 0) for i in range(30_000)],
    }
    for name, labels in cases.items():
        out = toxicity.toxicity(docs, spark.createDataFrame(labels, kind)).collect()
        assert {r.doc_id for r in out if r.rejected} == toxic, name


def test_toxicity_without_usable_labels(spark, docs):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = clashing(docs)
    out = toxicity.toxicity(df, none).collect()
    assert len(out) == df.count() and not any(r.rejected or r.p_toxic for r in out)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = tokenizer_path("byte_bpe_50k.json")
    assert suffix_dedup.span_report(docs).count() == 0
    assert suffix_dedup.without_repeats(docs).count() == 0
    assert toxicity.toxicity(docs, labels).count() == 0
    assert ngram_join.jaccard_components(docs).count() == 0
    assert ngram_join.without_near_copies(docs, 5, 80).count() == 0
    assert token_counts.token_counts(docs, path).count() == 0
    assert bpe.encoded_digests(docs, path).count() == 0
    assert mixing.mix(docs).count() == 0
    assert mixing.mixed_documents(docs).count() == 0


def kept_shuffles(spark):
    """Shuffle files on the session's local disk."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(str(d)) for f in names if re.fullmatch(r"shuffle_\d+_\d+_\d+\.data", f)}


def test_release_frees_the_shuffles_of_the_last_query(spark):
    before = kept_shuffles(spark)
    runtime.staged(spark.range(20_000).repartition(5).groupBy((F.col("id") % 1000).alias("k")).count(), "kept")
    own = kept_shuffles(spark) - before
    assert own
    runtime.release(spark)
    until = time.time() + 15
    while own & kept_shuffles(spark) and time.time() < until:
        time.sleep(0.2)
    assert not own & kept_shuffles(spark)


def staged_grams(monkeypatch):
    """Bytes of n-gram sets in each table that the join stages, as it runs."""
    found, plain = {}, ngram_join.staged

    def staged(df, kind):
        out = plain(df, kind)
        if "grams" in out.columns and dict(out.dtypes)["grams"] == "binary":
            found[kind] = found.get(kind, 0) + (out.agg(F.sum(F.octet_length("grams"))).head()[0] or 0)
        return out

    monkeypatch.setattr(ngram_join, "staged", staged)
    return found


def test_sets_that_only_share_passages_are_not_stored(spark, monkeypatch):
    """Documents that agree in blocks with others, but share half of their n-grams."""
    rnd = random.Random(11)
    para = lambda n: [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
    passages = [para(150) for _ in range(10)]
    texts = [(i, " ".join(passages[i % 10] + para(150))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kinds = staged_grams(monkeypatch)
    got = rows_of(ngram_join.jaccard_components(docs, 5, 80), "*")
    assert got == brute_components(texts, 5, 80) and all(r[0] == r[2] for r in got)
    wanted = ngram_join._agreements(ngram_join._rows(docs), ngram_join._texts_sets(5), 80, 12_000)
    assert wanted.mapInArrow(ngram_join._partnered, "class long").distinct().count() > 30   # else nothing is shown
    assert sum(kinds.values()) == 0


def test_a_chain_of_groups_is_not_compared_as_one_cluster(spark, monkeypatch):
    """Pairs of near copies, each tied to the next pair by a passage: what is
    compared grows with the documents, not with their square."""
    rnd = random.Random(12)
    para = lambda n: [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
    passages, texts = [para(70) for _ in range(31)], []
    for i in range(30):
        base = passages[i] + para(60) + passages[i + 1]
        near = list(base)
        near[100] = "other"
        texts += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(near))]
    compared, plain = [], ngram_join._compare

    def compare(rows, percent):
        compared.append(rows.count())
        return plain(rows, percent)

    largest, staged = [], ngram_join.staged

    def watched(df, kind):
        out = staged(df, kind)
        if kind == "grams-clusters":
            largest.append(out.groupBy("component").count().agg(F.max("count")).head()[0])
        return out

    monkeypatch.setattr(ngram_join, "staged", watched)
    monkeypatch.setattr(ngram_join, "_compare", compare)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    monkeypatch.setattr(ngram_join, "SHARED", 2)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows_of(ngram_join.jaccard_components(docs, 5, 80), "*")
    assert got == brute_components(texts, 5, 80) and {r[2] for r in got} == set(range(0, 60, 2))
    assert largest[0] > 8 and sum(compared) <= len(texts) + 20


def test_counts_of_shared_grams_are_never_too_low(monkeypatch):
    """Classes with the same 32 bits only add to each other's counts."""
    monkeypatch.setattr(ngram_join, "_asked_sets", lambda words: ngram_join._stored_sets)
    monkeypatch.setattr(ngram_join, "FLUSH_ROWS", 300)
    rng = np.random.default_rng(13)
    pool = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    classes = [5, 5 + (1 << 32), -1, -2, 1 << 40, ngram_join.SEVERAL, *range(100, 120)]
    sets = {c: np.unique(rng.choice(pool, 60)) for c in classes}
    batches = [pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([sets[c].tobytes()], pa.binary())],
                                          names=["class", "grams"]) for c in classes]
    for n_slices in (1, 7):
        rows = [r for b in ngram_join._gram_slices(5, n_slices)(iter(batches)) for r in b.to_pylist()]
        rows = pa.RecordBatch.from_pylist(sorted(rows, key=lambda r: r["slice"]))
        found = Counter()
        for b in ngram_join._shared_grams(iter([rows])):
            for r in b.to_pylist():
                found[r["short"]] += r["n"]
        uses = Counter(g for s in sets.values() for g in s.tolist())
        for c, s in sets.items():
            assert found[int(ngram_join._short(c))] >= sum(uses[g] > 1 for g in s.tolist())
        assert all(found[c] == sum(uses[g] > 1 for g in sets[c].tolist()) for c in range(100, 120))
