import random

import pytest

from strata.llm import secrets_scan as S

HEX = "0123456789abcdef"


def corpus(n, seed):
    """Prose with long words, addresses, checksums and planted secrets."""
    rng = random.Random(seed)
    rows, secrets = [], {}
    for i in range(n):
        words = ["".join(rng.choice(["th", "er", "on", "an", "ing", "the"]) for _ in range(rng.randrange(1, 11)))
                 for _ in range(rng.randrange(5, 40))]
        if i % 5 == 0:
            value = "".join(rng.choice(HEX) for _ in range(40))
            secrets.setdefault(i, []).append(value)
            words.insert(rng.randrange(len(words)), rng.choice(['token = "{}"!!', "api_key={}", "secret: '{}'"]).format(value))
        if i % 7 == 0:
            words.append("sha1: " + "".join(rng.choice(HEX) for _ in range(40)))
        if i % 3 == 0:
            words.append(f"someone.{rng.randrange(10**6)}@mail{i}.example.com http://www.example.org/path/to/{i}/page")
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 0))
    return rows, secrets


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_finds_planted_secrets_and_drops_false_positives(spark):
    rows, secrets = corpus(600, 1)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = S.candidates(docs)
    assert found.count() > 5 * sum(map(len, secrets.values()))
    got = {}
    for r in S.scan(docs).collect():
        got.setdefault(r.doc_id, []).append(r.value)
        assert r.score >= 0.5
    assert got == secrets
    masked = {r.doc_id: r for r in S.redact(docs).collect()}
    for i, text, *_ in rows:
        want = text
        for s in secrets.get(i, ()):
            want = want.replace(s, "<SECRET>")
        assert masked[i].text == want and masked[i].n_chars == (len(want) if i in secrets else 0)
    assert S.redact(docs).columns == docs.columns


def test_given_labels_decide(spark):
    """A forest learned from labelled findings that call checksums secrets."""
    rows, _ = corpus(400, 2)
    docs = spark.createDataFrame(rows, DOCS)
    found = S.features(S.candidates(docs))
    labelled = found.withColumn("label", found["checksum"].cast("double"))
    kept = S.scan(docs, labelled).collect()
    assert kept and all("sha1" in r.before for r in kept)


def test_candidates_and_context(spark):
    docs = spark.createDataFrame([(1, 'x password=abcdefgh12345678ij, y', None, None, None), (2, "é" * 50, "fr", "t", 1),
                                  (3, 'see token = "0123456789abcdef0123"### done', "en", "tests/a", 1)], DOCS)
    rows = {r.doc_id: r for r in S.candidates(docs).collect()}
    assert set(rows) == {1, 3}
    assert rows[1].value == "abcdefgh12345678ij" and rows[1].before.endswith("password=")
    assert rows[3].value == "0123456789abcdef0123" and rows[3].before.rstrip().endswith("token =") and rows[3].path == "tests/a"


def test_edges(spark, docs, no_docs):
    assert S.digest(no_docs).count() == 0
    assert S.digest(docs).count() == 0
    assert sorted(map(str, S.redact(docs).collect())) == sorted(map(str, docs.collect()))
    no_path = docs.drop("source")
    assert S.digest(no_path).count() == 0
    rows, secrets = corpus(100, 3)
    d = spark.createDataFrame(rows, DOCS)
    once, twice = ([r.value for r in S.scan(x).collect()] for x in (d, d.unionByName(d)))
    assert sorted(twice) == sorted(2 * once) and {s for v in secrets.values() for s in v} <= set(once)


def test_every_part_of_a_run_addresses_and_short_passwords(spark):
    rng = random.Random(7)

    def some(chars, n):
        return "".join(rng.choice(chars) for _ in range(n))
    alnum = HEX + "GHJKLMNPQRSTUVWXYZ"
    rows, secrets = corpus(400, 4)
    for i in range(400, 800):
        aws, forty, gh, word = "AKIA" + some("ABCDEFGH2345", 16), some(alnum, 40), "ghp_" + some(alnum, 36), some(alnum, 6) + "7$k"
        text, planted = [(f"token={gh}:x-oauth-basic", [gh]), (f"{aws}:us-east-1", [aws]), (f"use {aws}:{forty} now", [aws]),
                         (f"api_key={forty}=foo", [forty]), (f"see postgres://admin:{forty}@host/db", [forty]),
                         (f"postgres://admin:{word}@db.example.com/x", [word]), (f'password = "{word}"', [word]),
                         (f"password: {word}!, and", [word])][i % 8]
        rows.append((i, f"ther on {text} the er", "en", "x", 0))
        secrets[i] = planted
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    cand = {}
    for r in S.candidates(docs).collect():
        cand.setdefault(r.doc_id, set()).add(r.value)
    masked = {r.doc_id: r.text for r in S.redact(docs).collect()}
    for i in range(400, 800):
        for s in secrets[i]:
            assert any(s in v for v in cand[i]) and s not in masked[i], (rows[i], cand[i], masked[i])
    one = spark.createDataFrame([(1, "ftp admin:zq9f8e7d6c5b4a3f2e1d@host/db", "", "", 0)], DOCS)
    assert "zq9f8e7d6c5b4a3f2e1d" in {r.value for r in S.candidates(one).collect()}
    one = spark.createDataFrame([(1, "key=0123456789abcdef0123=foo", "", "", 0)], DOCS)
    got = {r.value for r in S.candidates(one).collect()}
    assert "0123456789abcdef0123" in got and "key=0123456789abcdef0123=foo" in got


def test_null_and_shared_ids_are_masked(spark):
    rows, secrets = corpus(300, 6)
    plain = [(t, secrets.get(i, [])) for i, t, *_ in rows]
    docs = spark.createDataFrame([(None if i % 2 else 3, t, "en", "s", 0) for i, (t, _) in enumerate(plain)], DOCS).repartition(3)
    want = []
    for text, values in plain:
        for v in values:
            text = text.replace(v, "<SECRET>")
        want.append(text)
    got = S.redact(docs).collect()
    assert sorted(r.text for r in got) == sorted(want) and sum(r.doc_id is None for r in got) == 150


@pytest.mark.parametrize("query", ["op1_secrets"])
def test_no_python_on_the_main_path(spark, small_dir, query):
    from strata.llm.queries import QUERIES
    plan = QUERIES[query](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
