import hashlib
import random
from collections import Counter

import pytest

from strata.llm import align as A
from strata.llm.tokens import Encoder, PieceEncoder, tokenizer_path

PA, PB = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute(rows):
    """rows: (doc_id, text), with the libraries on whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PA)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PB)
    bytes_a, bytes_b = Encoder(PA, True).entries(), PieceEncoder(PB).entries()
    docs, count = [], Counter()
    for i, t in rows:
        if not t:
            docs.append((i, [], [], [], []))
            continue
        x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        want = (" " + t).encode()
        if b"".join(bytes_a[k] for k in x) != want or b"".join(bytes_b[k] for k in y) != want:
            docs.append((i, [], [], [], []))
            continue
        ends = []
        for ids, table in ((x, bytes_a), (y, bytes_b)):
            at, e = 0, []
            for k in ids:
                at += len(table[k])
                e.append(at)
            ends.append(e)
        links = [(x[m], y[ends[1].index(e)]) for m, e in enumerate(ends[0]) if e in set(ends[1])]
        groups, ga, gb = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            na, nb = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, x[ga:na])) + "|" + ",".join(map(str, y[gb:nb])))
            ga, gb = na, nb
        count.update(links)
        docs.append((i, x, y, groups, links))
    most = {}
    for (_, k), n in count.items():
        most[k] = max(most.get(k, 0), n)
    return sorted(((i, len(x), len(y), len(g), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, x, y, g, ls in docs), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed):
    rng = random.Random(seed)
    odd = ["▁", "▁a", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "\n\n", "\t", "   ", "日本", "é", "ﬁ", "😀",
           "don't", "http://x.y/z?a=1", "...", "é", "naïve", "\xa0", " ", "A1b2", "foo(bar);", "--", "<|endoftext|", "\r\n"]
    words = ["the", "Hello", "world", "unbelievable", "antidisestablishmentarianism", "zzxqj", "ouaiènement"]
    rows = [(k, "".join(rng.choice(words if rng.random() < .6 else odd) + rng.choice(["", " ", " ", "  ", ", ", ".\n"])
                        for _ in range(rng.randrange(12)))) for k in range(150)]
    return rows + [(None, None), (None, ""), (3, rows[5][1]), (500, " "), (501, "  "), (502, "\n"), (503, " x "), (504, "a▁b"),
                   (505, "long " * 20000)]


def test_equals_brute_force(spark, monkeypatch):
    rows = made(1)
    df = spark.createDataFrame([(i, t, 1, "g") for i, t in rows], "doc_id long, text string, row int, links string").repartition(3)
    want = brute(rows)
    assert rows_of(A.digest(df, PA, PB)) == want
    monkeypatch.setattr(A, "BROADCAST_PAIRS", 0)  # counts meet links in a join
    assert rows_of(A.digest(df, PA, PB)) == want


def test_edge_tables(spark, docs, no_docs):
    assert rows_of(A.digest(docs, PA, PB)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert A.digest(no_docs, PA, PB).count() == 0
    groups = A.align(docs.where("doc_id = 6"), PA, PB, keep_groups=True).collect()[0]
    assert hashlib.sha256(groups.groups.encode()).hexdigest() == groups.groups_sha256


@pytest.mark.parametrize("seed", range(3))
def test_pieces_equal_whole_texts(seed):
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=PB)
    one = PieceEncoder(PB, cache_bytes=10_000)  # forgets often
    texts = [t or "" for _, t in made(seed)]
    import numpy as np
    for i in range(0, len(texts), 20):
        got = [np.frombuffer(x, "<u4").tolist() for x in one(texts[i:i + 20])]
        assert got == model.encode(texts[i:i + 20])


def test_pair_bound_holds(spark):
    rows = made(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = Encoder(PA, True).entries(), PieceEncoder(PB).entries()
    pairs = A.pair_counts(A.align(df, PA, PB), len(b), A.code_kind(len(a), len(b))).collect()
    for r in pairs:
        x, y = a[r.code // len(b)], b[r.code % len(b)]
        assert x.endswith(y) or y.endswith(x)
    assert len(pairs) <= A.pair_bound(a, b) < A.BROADCAST_PAIRS
