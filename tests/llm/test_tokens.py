import itertools

import public_tokenizers as P
import pytest

from corpusflow.llm import tokens as T
from tests.llm.data import ODD, corpus, documents

TEXTS = [*corpus(n=30), "<|endoftext|>a <|endoftext|> b", "  \n\t x", "'s'S don't ﬁ ½ x²   ​ 한국어 😀😀﻿", "a" * 3000,
         "a" * 64 + " " + "ab" * 32 + "c", "\r\n\r\n  end   ", "٣٤ Ⅳ ꙮ ʰ ́é", "\x85\x1c\x1d hi\x0b\x0c", "x 　 y　 z 　", "\0 \0",
         *("".join(x) for x in itertools.product(" \na'　", repeat=4))]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda texts: [len(x.ids) for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_against_the_library(spark, library):
    rows = [*enumerate(TEXTS), *ODD]
    got = T.count_tokens(documents(spark, rows), P.path("byte_bpe_50k.json"), P.PATTERN, 100).collect()
    want = sorted((str(d), len((t or "").encode()), n, n > 100) for (d, t), n in zip(rows, library([t for _, t in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_table_query_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r.n_tokens for r in T.op9_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert got == dict(zip([d.doc_id for d in docs], library([d.text for d in docs])))


def test_heap_and_side_by_side_agree():
    ranks, first, _ = T.load_merges(P.path("byte_bpe_50k.json"))
    m = T.Merger(ranks, first)
    pieces = [p.encode() for t in TEXTS for p in t.split(" ")] + [b"", b"a"]
    short = [p for p in pieces if len(p) <= T.SIDE_BY_SIDE]
    assert m._side_by_side(short) == [T.merge_count([first[b] for b in p], ranks) for p in short]


def test_tables_may_start_anew(library, monkeypatch):
    monkeypatch.setattr(T, "WORDS_KEPT", 50)
    ranks, first, _ = T.load_merges(P.path("byte_bpe_50k.json"))
    w = T.Words(ranks, first, P.PATTERN)
    texts = [t for t in TEXTS if "<|" not in t]
    assert [n for t in texts for n in w.count([t])] == library(texts)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        T.load_merges(P.path("word_bpe_49k.json"))


def test_empty_table(spark):
    assert T.count_tokens(documents(spark, []), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
