"""Small inputs shared by the tests of the llm operators."""

import random

SYLLABLES = "ka lo mi ra te su no vi el or an da pe gi hu".split()

#: columns of results that an input may also have
CLASHING = ("n_shingles long, component_id long, kept boolean, bands string, odd string, rep long, key long, leader long, "
            "hits string, items string, n_words long, n_hit long, spans string, base string, score double, predicted int, stats string, "
            "slot long, block long, position long, mix_n long, mix_key string, chunk int, shard int, n_bytes long, n_tokens long, "
            "lane int, rank int, matches string, payload string, digest string, first long")


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed=5, n=60):
    """Texts with copies, near copies, shared passages and short ones."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 40))
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            text = rng.choice(out)
        elif kind == 2 and out:
            w = rng.choice(out).split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = "".join(words(rng, 1))
            text = " ".join(w)
        elif kind == 3:
            w = words(rng, 50)
            text = " ".join(w[:20]) + " " + passage + " " + " ".join(w[20:])
        elif kind == 4:
            text = " ".join(words(rng, rng.randint(0, 4)))
        else:
            text = " ".join(words(rng, rng.randint(30, 200)))
        out.append(text)
    return out


def documents(spark, rows, clash=True):
    """``rows`` of (doc_id, text[, source]) with extra columns whose names clash."""
    rows = [(*r, None)[:3] for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if clash:
        for c in CLASHING.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
    return df


ODD = [(1000, None), (1001, ""), (1002, " \n\t "), (None, "lost words without an id but with some length to them, more than fifty bytes"),
       (1003, "x"), (1003, "x"), (1004, "long " * 30_000)]
