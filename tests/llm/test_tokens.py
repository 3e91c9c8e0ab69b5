"""Byte-level BPE and token counts against the libraries they stand for."""

import random

import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Regex, Tokenizer, pre_tokenizers

import samples
from grantchron.llm import byte_bpe, pretokens, token_counts
from grantchron.llm.queries import BPE, MULTI_BPE

ENCODING = tiktoken.Encoding(
    "ranks",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks=byte_bpe.read_ranks(MULTI_BPE),
    special_tokens={},
)
LIBRARY = Tokenizer.from_file(BPE)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aB1²½ \t\n\x1f\x85　'sté_-.日՘\U0001f469"), max_size=30))
def test_pieces_are_matches_of_the_pattern(text):
    whole = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
    assert pretokens.split(text) == [p for p, _ in whole.pre_tokenize_str(text)]


def test_common_characters_split_as_the_pattern_says():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for code in (*range(0x530), *range(0x2010, 0x2060)):
        for text in (f"a{chr(code)}b", f" {chr(code)}1", f"{chr(code)}{chr(code)} .", f"  {chr(code)}"):
            assert pretokens.split(text) == pattern.findall(text), hex(code)


def test_merges_are_those_of_the_ranks():
    tokenizer = byte_bpe.rank_tokenizer(MULTI_BPE)
    raw = tiktoken.Encoding(
        "raw", pat_str=r"(?s).+", mergeable_ranks=byte_bpe.read_ranks(MULTI_BPE), special_tokens={}
    )
    rng = random.Random(2)
    parts = [" ", "-", "=", "a", "ene", "n", "aha", "*", "é", "日", " the", "0", "www", "."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) * rng.choice((1, 1, 2, 3, 5, 9)) for _ in range(rng.randint(1, 7)))
        assert tokenizer.encode(text).ids == raw.encode_ordinary(text)


def test_ids_and_bytes_of_whole_texts(spark):
    found = byte_bpe.round_trip(samples.documents(spark), MULTI_BPE).collect()
    expected = sorted((str(r[0]), tuple(ENCODING.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in samples.rows())
    assert sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in found) == expected


def test_offsets_and_split_characters(spark):
    rows = byte_bpe.encode(samples.documents(spark), MULTI_BPE, offsets=True)
    rows = rows.withColumn("text", byte_bpe.decode_text("ids", MULTI_BPE))
    for r in rows.collect():
        words = byte_bpe._words(MULTI_BPE)
        assert len(r.ids) == len(r.starts) == len(r.ends)
        for i, s, e in zip(r.ids[:500], r.starts, r.ends):
            assert words[i] in r.text[s:e].encode()
        assert "".join(byte_bpe.decode_pieces(list(r.ids[:500]), MULTI_BPE)) == r.text[: len("".join(byte_bpe.decode_pieces(list(r.ids[:500]), MULTI_BPE)))]


def test_decoding_half_a_character_and_null(spark):
    ids = ENCODING.encode_ordinary("👩")
    rows = spark.createDataFrame([(1, ids[:-1]), (2, None), (3, [])], "n int, ids array<int>")
    rows = rows.select("n", byte_bpe.decode("ids", MULTI_BPE).alias("b"), byte_bpe.decode_text("ids", MULTI_BPE).alias("t"))
    first, null, empty = sorted(rows.collect())
    assert "👩".encode().startswith(bytes(first.b)) and "�" in first.t
    assert null.b is None and null.t is None and bytes(empty.b) == b"" and empty.t == ""


def test_counts_of_whole_texts(spark):
    found = token_counts.token_counts(samples.documents(spark), BPE).collect()
    expected = []
    for r in samples.rows():
        text = r[1] or ""
        n = len(LIBRARY.encode(text, add_special_tokens=False).ids)
        expected.append((str(r[0]), len(text.encode()), n, n > 1024))
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(expected)


def test_caches_start_anew_when_full(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_PIECES", 5)
    cache = pretokens.PieceCache(lambda pieces: [len(p) for p in pieces], {"first": 1})
    for i in range(10):
        lookup = cache.take_in([["first", f"a{i}", f"b{i}"]])
        assert lookup("first") == 1 and lookup(f"b{i}") == 2
        assert len(cache.known) <= 9


def test_nothing_gives_nothing(spark):
    none = samples.no_documents(spark)
    assert byte_bpe.round_trip(none, MULTI_BPE).collect() == []
    assert token_counts.token_counts(none, BPE).collect() == []
