import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from strata.llm.packing import piece_digest
from strata.llm.tokens import tokenizer_path
from strata.session import scratch_path
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dup import brute as near
from tests.llm.test_tokens import check_pieces, whole

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    """A small corpus with known outcomes: (folder, rows)."""
    rng = random.Random(9)
    item = [f"item{i}" for i in range(30)]
    rows, labels = [], []
    for i in range(700):
        words = [f"word{rng.randrange(400)}" for _ in range(rng.randrange(20, 60))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(3, "blorpy")
        elif i % 10 == 1:
            words[5:5] = item[:15]
        elif i % 10 == 2:
            words.insert(2, 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"')
        elif i % 10 == 3:
            words = rows[rng.randrange(len(rows))][1].split() + ["end"]
        rows.append((i, " ".join(words), "en", f"src{i % 2}", len(" ".join(words))))
        labels.append((i, 1, int(toxic or "blorpy" in words)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "x", 0), (1002, rows[7][1], "en", "x", 1)]
    root = scratch_path(spark, "pipeline-corpus")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(5, " ".join(item))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows


def test_stages_equal_brute_force(spark, corpus):
    root, rows = corpus
    docs, outs = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, step in C.STAGES:
        docs = C.stage(step(spark, docs, root), f"test-{name}")
        outs.append({r.doc_id: r for r in docs.collect()} if name != "packing" else docs)
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {r[0]: r[1] for r in rows if "blorpy" not in (r[1] or "")}
    assert set(outs[0]) == set(clean)
    kept = {d for d, v in near(list(clean.items())).items() if v[2]}
    assert set(outs[1]) == kept and len(kept) < len(clean)
    hit = contaminated([(d, clean[d]) for d in kept], [(5, " ".join(f"item{i}" for i in range(30)))])
    kept = {d for d in kept if not hit[d][4]}
    assert set(outs[2]) == kept
    assert set(outs[3]) == kept and any("<SECRET>" in (r.text or "") for r in outs[3].values())
    for d, r in outs[3].items():
        assert (r.text == clean[d]) == ("token = " not in (clean[d] or ""))
        assert "token = " not in (r.text or "") or r.text.split('token = "')[1].startswith("<SECRET>")
    src = [(d, r.text) for d, r in outs[3].items()]
    ids = {d: i + [0] for (d, _), i in zip(src, whole(tokenizer_path("byte_bpe_50k.json"), [t for _, t in src]), strict=True)}
    check_pieces(piece_digest(outs[4]).collect(), ids, 1024)


def test_run_and_registration(spark, corpus):
    assert C.run(spark, corpus[0]).count() > 0
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert "pipeline" in E.queries() and sum(k.startswith("op") for k in E.queries()) == 13


def test_empty_tables(spark, corpus):
    root = scratch_path(spark, "pipeline-empty")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    assert C.run(spark, root).count() == 0
