"""WARC archives with a two-level capture index.

Records are single gzip members, so a byte range holds one record. Captures
are sorted by their reversed-host URL key and cut into compressed blocks, file
by file; each index file has a sparse directory (first and last key, place) of
its blocks. A lookup binary-searches the files' key ranges and a file's
directory, reads the blocks it points to, and then the records by byte range.

Of records with equal payloads of at least ``revisit_bytes``, that with the
largest id is a response and the others revisit it. Payload groups are counted
with partial aggregates, and the join that tells a record its group starts
from a written table, so adaptive execution can split a large group.

Files go to the shared folder through a temporary name and a rename, and rows
are sorted before they are written, so a repeated task writes the same bytes.
Any file system that ``pyarrow.fs`` opens by its URI will do.

Edge cases: a NULL html is an empty payload; a NULL url has an empty key; rows
that share the largest id of their group are all responses; a record without
an id has none when read back; no pages give no archive and an empty index;
further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stage

_CAPTURE = "key string, page_id long, url string, type string, file string, offset long, length long"
_RECORD = ("key string, page_id long, url string, type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")
#: a fixed date, so that archives are the same in every run
DATE = "2024-01-01T00:00:00Z"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" in uri:
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), re.sub("^file:", "", uri)


def _publish(folder: str, name: str, write) -> None:
    """Write a file whole or not at all, also if several attempts run."""
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    held = f"{base}/.{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(held, compression=None) as out:
        write(out)
    if not isinstance(fs, pyarrow.fs.LocalFileSystem) and fs.get_file_info(f"{base}/{name}").type:
        fs.delete_file(f"{base}/{name}")
    fs.move(held, f"{base}/{name}")


def url_key(url: Column) -> Column:
    """Reversed-host key: http://a.b.org:80/x?y#z -> org,b,a)/x?y"""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^#]*)", 1)
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), F.lit(""))


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, payload: bytes,
           digest: str) -> bytes:
    """One WARC record as a gzip member; ``digest`` is hexadecimal."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    body = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    deflate = zlib.compressobj(3, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + deflate.flush()


def parse(member: bytes) -> dict:
    """A record's fields; a response's payload is held against its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")

    def page(name: str) -> int | None:
        found = re.search(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "type": kind,
            "refers_to": page("WARC-Refers-To"), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def _rows(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields],
                                      names=[n for n, _ in fields])


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = 1000, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one archive a task below ``folder``; returns the captures."""
    ship(pages.sparkSession)
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     url_key(F.col(url_col)).alias("key"), body.alias("body"), F.sha1(body).alias("digest"))
    large = p.where(F.octet_length("body") >= revisit_bytes)
    groups = stage(large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where(
        "n > 1 and last is not null").select("digest", "last"), "warc-groups")
    p = p.join(groups, "digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))
    p = p.select("page_id", "url", "key", "body", "digest", refers.alias("refers_to"))
    p = p.sortWithinPartitions("page_id", "url", "digest")

    def run(batches):
        name = f"pages-{TaskContext.get().partitionId():06d}.warc.gz"
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        found: list[dict] = []

        def write(out):
            at, b = 0, first
            while b is not None:
                for r in b.to_pylist():
                    kind = "response" if r["refers_to"] is None else "revisit"
                    raw = record(r["page_id"], r["url"], kind, r["refers_to"], r["body"], r["digest"])
                    out.write(raw)
                    found.append({"key": r["key"], "page_id": r["page_id"], "url": r["url"], "type": kind,
                                  "file": name, "offset": at, "length": len(raw)})
                    at += len(raw)
                b = next(batches, None)
        _publish(folder, name, write)
        for i in range(0, len(found), 10_000):
            yield _rows(_CAPTURE, found[i:i + 10_000])

    return stage(p.mapInArrow(run, _CAPTURE), "warc-captures")


def write_index(captures: DataFrame, folder: str, block_rows: int = 500, files: int | None = None) -> DataFrame:
    """Write the sorted, compressed index below ``folder``; returns its
    directory (file, block, first_key, last_key, offset, length, n)."""
    files = files or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = captures.repartitionByRange(files, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    schema = "file string, block int, first_key string, last_key string, offset long, length long, n int"

    def run(batches):
        name = f"captures-{TaskContext.get().partitionId():06d}"
        directory: list[dict] = []

        def write(out):
            held: list[dict] = []
            at = 0

            def flush(some):
                nonlocal at
                raw = zlib.compress("\n".join(json.dumps(r) for r in some).encode())
                out.write(raw)
                directory.append({"file": name, "block": len(directory), "first_key": some[0]["key"],
                                  "last_key": some[-1]["key"], "offset": at, "length": len(raw), "n": len(some)})
                at += len(raw)
            for b in batches:
                held += b.to_pylist()
                while len(held) >= block_rows:
                    flush(held[:block_rows])
                    held = held[block_rows:]
            if held:
                flush(held)
        _publish(folder, name, write)
        if directory:
            _publish(folder, f"{name}.directory", lambda out: out.write(json.dumps(directory).encode()))
            yield _rows(schema, directory)

    return stage(rows.mapInArrow(run, schema), "warc-directory")


def lookup(urls: DataFrame, directory: DataFrame, archives: str, index: str, url_col: str = "url") -> DataFrame:
    """All records whose URL key equals that of one of ``urls``: (key, page_id,
    url, type, refers_to, payload_bytes, payload_digest, payload)."""
    ship(urls.sparkSession)
    wanted = urls.select(url_key(F.col(url_col)).alias("key")).distinct()
    spans = directory.groupBy("file").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b"))
    spans = sorted((r.a, r.b, r.file) for r in spans.collect())  # a row an index file
    firsts = [s[0] for s in spans]

    def find(batches):
        fs, base = file_system(index)
        held: dict[str, tuple[list, list]] = {}

        def blocks(file):
            if file not in held:
                if len(held) >= 8:
                    held.clear()
                with fs.open_input_file(f"{base}/{file}.directory") as f:
                    d = json.loads(f.read())
                held[file] = ([x["last_key"] for x in d], d)
            return held[file]
        for b in batches:
            out = set()
            for key in b.column(0).to_pylist():
                i = bisect.bisect_right(firsts, key) - 1
                while i >= 0 and spans[i][1] >= key:  # a key may lie in several files
                    ends, d = blocks(spans[i][2])
                    j = bisect.bisect_left(ends, key)
                    while j < len(d) and d[j]["first_key"] <= key:
                        out.add((d[j]["file"], d[j]["offset"], d[j]["length"]))
                        j += 1
                    i -= 1
            if out:
                yield _rows("file string, offset long, length long",
                            [dict(zip(("file", "offset", "length"), x, strict=True)) for x in sorted(out)])

    def read_blocks(batches):
        fs, base = file_system(index)
        for b in batches:
            for r in b.to_pylist():
                with fs.open_input_file(f"{base}/{r['file']}") as f:
                    raw = zlib.decompress(f.read_at(r["length"], r["offset"]))
                yield _rows(_CAPTURE, [json.loads(x) for x in raw.decode().split("\n")])

    def read_records(batches):
        fs, base = file_system(archives)
        name, f = None, None
        for b in batches:
            out, size = [], 0
            for r in b.to_pylist():
                if r["file"] != name:
                    name, f = r["file"], fs.open_input_file(f"{base}/{r['file']}")
                out.append({"key": r["key"], **parse(f.read_at(r["length"], r["offset"]))})
                size += len(out[-1]["payload"] or b"")
                if size > 4 << 20:
                    yield _rows(_RECORD, out)
                    out, size = [], 0
            if out:
                yield _rows(_RECORD, out)

    places = wanted.sort("key").mapInArrow(find, "file string, offset long, length long").distinct()
    captures = stage(places.repartition("file", "offset").mapInArrow(read_blocks, _CAPTURE), "warc-found")
    hits = captures.join(wanted, "key", "left_semi")
    hits = hits.repartition(F.col("file"), F.floor(F.col("offset") / (16 << 20)))
    return hits.sortWithinPartitions("file", "offset").mapInArrow(read_records, _RECORD)


def digest(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read
    back through the index."""
    captures = write_archives(pages, f"{folder}/archives")
    directory = write_index(captures, f"{folder}/index")
    found = lookup(pages.select("url"), directory, f"{folder}/archives", f"{folder}/index")
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
