"""Counts by word (operator 6), without Spark."""

import public_tokenizers

from blockload.llm import token_counts as tc


def test_words_are_encoded_once_and_long_ones_are_not_kept(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, given = tc.load_tokenizer(path), []
    monkeypatch.setitem(tc._LOADED, path, lambda words: given.extend(words) or plain(words))
    monkeypatch.setattr(tc, "_KNOWN", {})
    long = "x" * (tc.KNOWN_CHARS + 1)
    texts = ["a b a", "", f"b {long} {long} it's", "é日本 a"]
    whole = plain(texts)
    assert tc.count_words(path, [t.encode() for t in texts]) == whole
    assert sorted(given) == sorted(["a", "b", long, "it's", "é日本"])
    assert tc.count_words(path, [t.encode() for t in texts]) == whole and given[5:] == [long]
    assert set(tc._KNOWN[path]) == {w.encode() for w in ("a", "b", "it's", "é日本")}
