"""Byte-level BPE: prefixes, appends, edits and the query against the tokenizer library."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.llm import byte_bpe as B
from aloft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TOK = B.tokenizer()
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=TOK.ranks, special_tokens={})

texts = st.text(max_size=60) | st.text(alphabet="ab'rlvetsd \n\t1.é的🙂", max_size=60)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_encode_and_decode(text):
    ids = TOK.encode(text)
    assert ids == LIB.encode_ordinary(text)
    assert TOK.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=24))
def test_every_prefix_has_its_encoding(piece):
    table = TOK.table(piece)
    for p in range(1, len(piece) + 1):
        whole = TOK.ranks.get(piece[:p])
        plain = [TOK.ranks[x] for x in TOK.merge(piece[:p])]
        assert TOK.follow(piece, table, p) == ([whole] if whole is not None else plain)
        assert table[p] == plain[-1]


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(0, 70), st.integers(0, 70), texts)
def test_edit_equals_a_fresh_encoding(text, i, j, new):
    i, j = min(i, len(text)), min(max(i, j), len(text))
    edited = TOK.edit(TOK.open(text), i, j, new)
    fresh = TOK.open(text[:i] + new + text[j:])
    assert edited == fresh and edited.all_ids() == LIB.encode_ordinary(fresh.text)
    assert TOK.append(TOK.open(text), new) == TOK.open(text + new)


def test_edits_and_appends_are_local():
    text = " ".join(f"word{i} and more" for i in range(5000))
    state = TOK.open(text)
    same, found = TOK.edit_counted(state, 30000, 30004, "xyzzy")
    assert same == TOK.open(text[:30000] + "xyzzy" + text[30004:]) and found < 100
    long = TOK.open("x" * 50000)  # one piece: the table of its prefixes is continued
    more, found = TOK.edit_counted(long, 50000, 50000, "yx" * 10)
    assert more == TOK.open("x" * 50000 + "yx" * 10) and found <= 20


def test_special_strings_are_text():
    text = "<|endoftext|> <s> [CLS]"
    assert TOK.encode(text) == LIB.encode_ordinary(text) and TOK.decode(TOK.encode(text)) == text.encode()


def test_vocabulary_is_checked():
    with pytest.raises(ValueError, match="single bytes"):
        B.PrefixTokenizer({b"a": 0}, ".")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(pairs):
    out = []
    for doc, text in pairs:
        ids = LIB.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op13_byte_bpe"](spark, SF)) == expected([tuple(r) for r in docs])


def test_edges(spark):
    pairs = [("b", None), ("a", ""), (None, "x y"), ("a", "same"), ("a", "same"), ("long", "ab" * 40000 + " z" * 3000),
             ("t", "tab\x00\x1c  \U0001F642 ")]
    frame = spark.createDataFrame(pairs, "doc_id string, text string")
    assert rows(B.report(frame)) == expected(pairs)
    assert B.report(frame.where("false")).collect() == []


def test_columns(spark):
    frame = spark.createDataFrame([(1, "one two", 5, "x")], "doc_id int, text string, IDS int, Decoded string")
    out = B.encode(frame)
    assert out.columns == ["doc_id", "text", "Decoded", "ids"]
    back = B.decode(out)
    assert back.columns == ["doc_id", "text", "ids", "decoded"]
    assert bytes(back.first()["decoded"]) == b"one two"
    with pytest.raises(Exception, match="no token has the id"):
        B.decode(spark.createDataFrame([(1, [5, -1])], "k int, ids array<int>")).collect()
    assert B.decode(spark.createDataFrame([(1, None)], "k int, ids array<int>")).first()["decoded"] is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, len(TOK.token) - 1), min_size=2, max_size=2))
def test_pairs_stay_apart_if_plain_merges_say_so(pair):
    left, right = (TOK.token[t] for t in pair)
    assert TOK.stays_apart(*pair) == (TOK.merge(left + right) == [left, right])
