import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from strata.llm import packing, token_files
from strata.llm.tokens import Encoder, tokenizer_path
from strata.session import scratch_path


def whole(path, texts):
    """Ids by the library as it is: special-token strings are their tokens."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXTS = ["", " ", "  a", "a\n\nb", "don't, can't. we're;they'll", "x  \t y", "a b　c", "½, Ⅷ. 12,5", "%%%, ,a",
         "<|endoftext|> <|startoftext|>", "ΑΣ ΑΣ. İI", "é é. é, ñ!", "a\x1cb\x00c", "🙂, 東京. ok"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_whole_texts(name, spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    path = tokenizer_path(name)
    e = Encoder(path, cache_bytes=2000)
    assert [np.frombuffer(x, "<u4").tolist() for x in e(TEXTS + docs)] == whole(path, TEXTS + docs)


def check_pieces(rows, docs, length):
    """rows: piece rows; docs: doc_id -> ids with the end id."""
    assert sum(r.length for r in rows) == sum(map(len, docs.values()))
    by_seq = {}
    for r in rows:
        ids = docs[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start:r.start + r.length])
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s, parts in by_seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == length or s == max(by_seq)
    for d, ids in docs.items():
        at = 0
        for start, n in sorted((r.start, r.length) for r in rows if r.doc_id == d):
            assert start == at
            at += n
        assert at == len(ids)


def test_packing(docs, no_docs):
    path = tokenizer_path("byte_bpe_50k.json")
    src = docs.collect()
    expect = {r.doc_id: i + [0] for r, i in zip(src, whole(path, [r.text for r in src]))}
    packed = packing.sequences(packing.tokenize(docs, path, 0), 64)
    check_pieces(packing.piece_digest(packing.pieces(packed)).collect(), expect, 64)
    assert packing.pieces(packing.sequences(packing.tokenize(no_docs, path, 0), 64)).count() == 0


@pytest.mark.parametrize("length", [1, 7, 64, 1 << 20])
def test_sequences(spark, docs, no_docs, length):
    """Sequences are the stream of all documents, cut; the last one is padded."""
    path = tokenizer_path("byte_bpe_50k.json")
    tokens = packing.tokenize(docs, path, 0)
    packed = packing.sequences(tokens, length, pad_id=9)
    seqs = sorted(packing.id_arrays(packed).collect())
    stream = [int(x) for r in sorted(packing.offsets(tokens).collect(), key=lambda r: r.begin)
              for x in np.frombuffer(r.ids, "<u4")]
    assert [s.sequence_id for s in seqs] == list(range(-(-len(stream) // length)))
    assert [x for s in seqs for x in s.ids[:s.n_tokens]] == stream
    for s in seqs:
        assert len(s.ids) == length or (len(s.ids) == s.n_tokens and len(s.ids) & (len(s.ids) - 1) == 0)
        assert all(x == 9 for x in s.ids[s.n_tokens:]) and (s is seqs[-1] or s.n_tokens == length)
    if length == 64:
        split = packing.sequences(tokens.repartition(5), length, pad_id=9)  # every document is a stretch
        assert sorted(packing.id_arrays(split).collect()) == seqs
    assert packing.sequences(packing.tokenize(no_docs, path, 0), length).count() == 0


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files(spark, docs, no_docs, encoding):
    path = tokenizer_path("word_bpe_49k.json")
    src = sorted(docs.collect(), key=lambda r: r.doc_id)
    at = token_files.write_tokens(docs, scratch_path(spark, "tf"), path, 2, encoding, page_rows=2, partitions=2)
    got = sorted(token_files.token_digest(spark, at).collect())
    start = 0
    for r, s, ids in zip(got, src, whole(path, [r.text for r in src]), strict=True):
        ids.append(2)
        assert tuple(r) == (s.doc_id, start, len(ids), crc(ids))
        start += len(ids)
    one = token_files.read_tokens(spark, at, (6, 6)).collect()
    assert [r.doc_id for r in one] == [6] and one[0].ids[-1] == 2
    plan = token_files.read_tokens(spark, at, (6, 6), ["doc_id", "n_tokens"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,6)" in plan and "ids" not in plan.split("ReadSchema")[-1]
    import pathlib
    file = max(pathlib.Path(at.removeprefix("file:")).glob("*.parquet"), key=lambda f: f.stat().st_size)
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert column.has_offset_index
    assert ("DELTA_BINARY_PACKED" in column.encodings) == (encoding == "delta")
    empty = token_files.write_tokens(no_docs, scratch_path(spark, "tf"), path, 2)
    assert token_files.token_digest(spark, empty).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_between_spaces(name):
    """White space at the ends of units, runs of spaces, and each distinct piece looked up once."""
    from tokenizers import Tokenizer
    e, whole = Encoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a \n\n b", "a\n b", "a \n \n b", "\n", " \n", "a \t", "\xa0 a \xa0b",
             "it's 3.5 (or so)!!  x", "a   b c", "one,\ntwo.\n", "Ġa bĠ", "\x1c a \x1cb"]
    for group in (texts, [t for t in texts if t and not t[0].isspace()], *([t] for t in texts)):
        assert e(group) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in group]
    seen, coded = [], e.coded
    e.coded = lambda flat: seen.extend(flat) or coded(flat)
    e(["first " + "same words, again " * 200] * 5)
    assert len(seen) < 20


def test_packing_holds_little(spark, docs):
    """Places go on over groups and batches, few rows are read at once, ids are
    written without a dictionary, and the session is as before."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(["x" * 200_000] * 60)], names=["doc_id", "text"])
    sizes = []

    def encode(texts):
        sizes.append(sum(map(len, texts)))
        return [np.array([len(t)], "<u4").tobytes() for t in texts]

    out = pa.Table.from_batches(packing._coded([batch, batch], 3, encode, b"\0" * 4))
    assert sum(sizes) == 24_000_000 and max(sizes) <= 8 << 20
    assert out["at"].to_pylist() == list(range(0, 240, 2)) and out["doc_id"].to_pylist() == [*range(60)] * 2
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    before, put = spark.conf.get(key), type(spark.conf).set
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark.conf), "set", lambda self, k, v: (seen.append((k, v)), put(self, k, v))[1])
        tokens = packing.tokenize(docs, tokenizer_path("byte_bpe_50k.json"), 0)
    assert (key, "512") in seen and spark.conf.get(key) == before
    files = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in tokens.inputFiles()]
    columns = [f.row_group(g).column(4) for f in files for g in range(f.num_row_groups)]
    assert columns and all(c.path_in_schema == "ids" and not c.has_dictionary_page for c in columns)
