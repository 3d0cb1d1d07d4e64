"""Collocation mining against brute force, parted and not."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockload.llm import collocations


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", lower(text or "")):
            t = re.findall(r"[^ \t]+", piece)
            n[lang] += len(t)
            for m in (1, 2, 3):
                for i in range(len(t) - m + 1):
                    f[lang, tuple(t[i:i + m])] += 1
    wanted = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    covered = {(lang, part) for (lang, p), a in wanted.items() if len(p) == 3
               for part in (p[:2], p[1:]) if 100 * a >= 50 * f[lang, part]}
    best = {}
    for (lang, p), a in wanted.items():
        if (lang, p) in covered:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in best.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    vocabulary = ["the", "The", "of", "a", "zug", "größe", "日本", "x y", "new", "york", "city", "hall", "\x00", "san"]
    rows = []
    for i in range(500):
        words = rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", " ; ", "\n", "\r\n", "!", " ?"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text + rng.choice(["", "New York city hall", "san jose"])))
    rows += [("en", None), ("en", ""), ("en", " . ,\n"), (None, None), ("fr", "un seul mot")]
    rows += [("en", "hot pair " * 400)] * 3 + [("en", "same row twice")] * 12
    return rows


@pytest.mark.parametrize("group,prefix", [(1_000_000, 125_000), (500, 60)])
def test_collocations(spark, texts, monkeypatch, group, prefix):
    """With small groups, frequent words and pairs are parted further."""
    monkeypatch.setattr(collocations, "GROUP_SUFFIXES", group)
    monkeypatch.setattr(collocations, "PREFIX_SUFFIXES", prefix)
    docs = spark.createDataFrame(texts, "lang string, text string").withColumns(
        {"word": F.lit(1), "n": F.lit(2), "phrase": F.lit("p"), "grp": F.lit(0)}).repartition(5)
    got = collocations.collocations(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(texts)
    few = collocations.collocations(docs, least=3, top=7)
    assert sorted(tuple(r) for r in few.collect()) == expected(texts, 3, 7)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    blank = spark.createDataFrame([("en", None), (None, " .\t")], "lang string, text string")
    assert collocations.collocations(blank).collect() == []


@pytest.mark.parametrize("size", [8, 25, 60, 1000])
def test_long_texts_in_parts(monkeypatch, size):
    """Whatever the parts, the suffixes are those of the whole text."""
    rng = random.Random(size)
    text = "".join(rng.choice(["ab", "c", "long-word-without-blanks", "d.", "e,f", "g\n"]) + rng.choice([" ", "\t", "  "])
                   for _ in range(200)).encode()

    def suffixes(parts):
        t = collocations.Tokens(parts)
        words = [w.as_py() for w in t.words] + [b""]
        return Counter(tuple(words[i] for i in row) for row in t.suffixes())

    whole = suffixes([(text, b"")])
    monkeypatch.setattr(collocations, "SLICE_BYTES", size)
    parts = list(collocations._parts(text))
    assert b"".join(a for a, _ in parts) == text and (size > len(text)) == (len(parts) == 1)
    assert suffixes(parts) == whole
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text.decode()])], names=["lang", "text"])
    assert sum((suffixes(s["en"]) for s in collocations.slices(iter([batch]))), Counter()) == whole


def test_exact_scores_past_64_bits(spark):
    a, left, right = 9_999_999_999_999_999, 9_999_999_999_999_999, 10_000_000_000_000_001
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        collocations._score("a", "l", "r").alias("s")).head()
    assert row.s == 1_000_000 * a * a // (left * right)
