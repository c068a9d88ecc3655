import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from corpusflow.llm import align as A
from corpusflow.llm.tokens import byte_symbols
from tests.llm.data import ODD, corpus, documents

FILES = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
TEXTS = [*corpus(seed=8, n=40), " ", "  a  b ", " lead", "trail ", "é▁x y", "a\x00b c", "<s> hi <|endoftext|> there </s> <unk>", "ﬁ 　x y", "a\n\nb\t c d",
         "🤷‍♂️ word", "́a b", "x y z", "z ́a", "don't 'tis 12 345 + - x", "한국어 말 하다", "\x1c a \x1d b", "a" * 2000, "\r\n x", "\nfirst line\nsecond line\n\nthird\n fourth\n", "a\nb \nc\n", "x\n▁y", "one\n12\n+\né", "y ▁ z", "ab " * 40]


@pytest.fixture(scope="module")
def brute():
    """The contract's words, byte by byte, from the libraries over whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    byte_of = {c: i for i, c in enumerate(byte_symbols())}

    def tokens(text):
        if not text:
            return None
        x = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        whole = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else None

    def run(texts):
        linked, strings, counts = [], [], Counter()
        for text in texts:
            found = tokens(text)
            if found is None:
                linked.append(None), strings.append(None)
                continue
            spans = []
            for side in found:
                at, out = 0, []
                for i, t in side:
                    out.append((i, at, at + len(t)))
                    at += len(t)
                spans.append(out)
            own = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e] if len(text) < 5000 else None
            cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
            at, parts = 0, []
            for c in cuts:
                parts.append("|".join(",".join(str(i) for i, s, e in side if at < e <= c) for side in spans))
                at = c
            linked.append(own), strings.append((len(spans[0]), len(spans[1]), len(cuts), ";".join(parts)))
            counts.update(own)
        most = {}
        for (_, j), n in counts.items():
            most[j] = max(most.get(j, 0), n)
        return [(0, 0, 0, 0, 0, 0, "") if s is None else
                (*s[:3], len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), hashlib.sha256(s[3].encode()).hexdigest())
                for s, own in zip(strings, linked)]

    return run


def rows_of(found):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.collect())


@pytest.mark.parametrize("kept", [A.PAIRS_KEPT, 10])
def test_against_the_libraries(spark, brute, kept):
    rows = [*enumerate(TEXTS), *(x for x in ODD if len(x[1] or "") < 5000)]
    want = brute([t for _, t in rows])
    got = A.align(documents(spark, rows), *FILES, pairs_kept=kept)
    assert rows_of(got) == sorted((str(d), *w) for (d, _), w in zip(rows, want))
    assert sum(w[0] == 0 for w in want) >= 4


def test_table_query_against_the_libraries(spark, brute):
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in docs if len(r.text) < 1500]
    got = A.align(spark.createDataFrame(short), *FILES)
    assert rows_of(got) == sorted((str(r.doc_id), *w) for r, w in zip(short, brute([r.text for r in short])))
    assert A.op12_token_alignment(spark, "/root/testdata/sf0.001").count() == len(docs)


def test_pointers_against_overlaps():
    """Groups are the connected components of overlaps, for any two tilings."""
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 60)
        ends = [np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n})) for _ in "ab"]
        a, b = A.groups(*ends)
        common = np.intersect1d(*ends)
        assert a.tolist() == np.searchsorted(common, ends[0]).tolist() and b.tolist() == np.searchsorted(common, ends[1]).tolist()
        spans = [list(zip([0, *e[:-1]], e)) for e in ends]
        assert sorted(zip(*(x.tolist() for x in A.links(*ends)[:2]))) == [
            (i, j) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]


def test_small_blocks_and_tables_change_nothing(spark, monkeypatch):
    """Long texts are cut into blocks, and the table of words starts anew, in the process itself."""
    files = tuple(open(p, "rb").read() for p in FILES)
    texts = [" ".join(corpus(seed=1, n=20)), "word " * 3000, "x" * 5000]

    def run():
        words, out = A.Words(*files), []
        for text in texts:
            if words.full():
                words.shrink()
            for _, held in A._by_text(words, [text]):
                ids = np.concatenate(held)
                out.append((words.sizes[ids].sum(axis=0).tolist(), [words.strings[i] for i in ids], sorted(words.pairs[A._ranges(words.ptr, ids)].tolist())))
        return out

    whole = run()
    monkeypatch.setattr(A, "BLOCK", 100)
    monkeypatch.setattr(A, "WORDS_KEPT", 30)
    assert run() == whole and len(whole) == 3


def test_empty_table(spark):
    assert A.align(documents(spark, []), *FILES).count() == 0
    assert rows_of(A.align(documents(spark, [(1, None), (2, ""), (3, "ab cd ▁")]), *FILES)) == [
        (str(i), 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
