"""WARC archives with a two-level capture index.

Writing: the payload's digest and size come from JVM functions; per digest a small aggregate names the capture that
is the response, and pages are joined to it by digest, so the html is shuffled once and a digest that a third of the
pages share is split like any skewed join. Each task writes one archive of gzip records (one member a record) under a
name of its own attempt and returns a manifest row per record; the manifest is stored as Parquet, whose committer
accepts one attempt per task, so files of lost or repeated attempts are never referred to.

Index: manifest rows are range-partitioned and sorted by key (reversed host with path, then the capture's number)
and written as shards of zlib-compressed blocks of ``block`` lines. A shard's sparse directory (first key, offset
and length of each block) lies at its end. Only the shards' first keys, one a partition, are sent to tasks.

Lookup: the wanted keys are range-partitioned likewise, a task binary-searches the shards' first keys, then a
shard's directory, and reads and scans only blocks that may hold the key; the records found are sorted by archive
and offset, and read by range.

Defined results: null html is the empty payload, a null url has the key ``-``. Of captures equal in page_id and
payload, the first by url is the response and the others revisit that page_id. Null page_ids sort last. Empty
tables write no archives and return no rows. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.llm.common import stored, work_dir

MANIFEST = "key string, page_id {id}, archive string, offset bigint, length bigint"
_EMPTY_SHA1 = "da39a3ee5e6b4b0d3255bfef95601890afd80709"


def filesystem(uri: str):
    """pyarrow's file system and the path in it for a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def base32(hexed: Column) -> Column:
    """Upper-case base32 of a 40-digit hex string: 20 bits are 5 hex digits and 4 letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(hexed, i + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(bits, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*out)


def surt(url: str | None) -> str:
    """Reversed host, then path and query: http://www.a.org/x?y -> org,a,www)/x?y. '-' for null."""
    if url is None:
        return "-"
    try:
        u = urlsplit(url.strip())
        host, port = u.hostname or "", u.port
    except ValueError:
        return "-" + "".join(url.split())
    tail = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){tail}".replace(" ", "%20").replace("\n", "%0A")


def capture_key(url: str | None, page_id) -> str:
    """Key and capture number; numbers compare as text."""
    number = "~" if page_id is None else f"{page_id + (1 << 63):020d}" if isinstance(page_id, int) else str(page_id)
    return f"{surt(url)} {number}"


def _record(kind: str, url: str, page_id, digest: str, size: int, refers, payload: bytes) -> bytes:
    """A gzip member with a WARC response, or a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = uuid.UUID(hashlib.md5(f"{page_id} {url} {digest}".encode("utf-8", "surrogatepass")).hexdigest())
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    lines += [f"X-Page-ID: {json.dumps(page_id)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {json.dumps(refers)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """Headers and payload of a record; a response's payload is held against its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"type": fields["WARC-Type"], "page_id": json.loads(fields["X-Page-ID"]), "url": fields["WARC-Target-URI"], "digest": digest, "size": size, "refers": json.loads(fields.get("X-Refers-To-Page-ID", "null")), "payload": payload}


def _one_line(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", "%0A")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = 0) -> DataFrame:
    """Archives below folder; returns the stored manifest. Payloads of at least ``min_revisit`` bytes are written once."""
    src = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), F.coalesce(pages[html], F.lit("")).alias("html"))
    id_type = src.schema["page_id"].dataType
    src = src.withColumns({"sha1": F.sha1(F.encode("html", "utf-8")), "size": F.octet_length("html").cast("long")})
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", F.coalesce("url", F.lit("")).alias("u"))
    firsts = src.where(F.col("size") >= min_revisit).groupBy("sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    # exact repeats of the response's row: one of them is it
    firsts = firsts.where("n > 1").select(F.col("sha1").alias("_sha1"), "first")
    both = src.join(firsts.hint("merge"), F.col("sha1") == F.col("_sha1"), "left")
    same = F.col("first.page_id").eqNullSafe(F.col("page_id")) & (F.col("first.u") == F.coalesce("url", F.lit("")))
    both = both.select("page_id", "url", _one_line(F.col("url")).alias("uri"), "html", base32(F.col("sha1")).alias("digest"), "size", F.col("first").isNull().alias("alone"), same.alias("same"), F.col("first.page_id").alias("refers"), F.col("_sha1").alias("of"))
    twice = src.join(firsts.hint("merge"), F.col("sha1") == F.col("_sha1")).where(same).groupBy("sha1").count().where("count > 1").select("sha1")
    twice = {r.sha1 for r in twice.limit(1).collect()}  # usually none: then no row needs a number
    if twice:
        both = both.withColumn("same", F.when(F.col("same"), F.row_number().over(W.partitionBy("of", "same", "page_id").orderBy("url")) == 1).otherwise(F.col("same")))
    names = ["key", "page_id", "archive", "offset", "length"]

    def save(batches):
        from pyspark import TaskContext

        fs, root = filesystem(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        fs.create_dir(root, recursive=True)
        at = 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
            for b in chain([first], batches):
                rows = []
                for lo in range(0, b.num_rows, 256):
                    for r in b.slice(lo, 256).to_pylist():
                        kind = "response" if r["alone"] or r["same"] else "revisit"
                        member = _record(kind, r["uri"], r["page_id"], r["digest"], r["size"], r["refers"], r["html"].encode("utf-8", "surrogatepass"))
                        f.write(member)
                        rows.append((capture_key(r["url"], r["page_id"]), r["page_id"], name, at, len(member)))
                        at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, b.schema.field("page_id").type if n == "page_id" else None) for n, c in zip(names, zip(*rows, strict=True), strict=True)] if rows else [pa.array([], t) for t in (pa.string(), b.schema.field("page_id").type, pa.string(), pa.int64(), pa.int64())], names=names)

    return stored(both.drop("of").mapInArrow(save, MANIFEST.format(id=id_type.simpleString())), "manifest")


def index(manifest: DataFrame, folder: str, block: int = 512) -> DataFrame:
    """Shards of sorted, compressed blocks below folder; returns (first, shard), one row a shard."""
    rows = manifest.select("key", "archive", "offset", "length")
    rows = rows.repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")

    def save(batches):
        from pyspark import TaskContext

        fs, root = filesystem(folder)
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        fs.create_dir(root, recursive=True)
        name = f"shard-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.cdx"
        directory, lines, at = [], [], 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as f:

            def flush() -> int:
                raw = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"))
                directory.append([lines[0].split("\t")[0], at, len(raw)])
                f.write(raw)
                lines.clear()
                return at + len(raw)

            for b in chain([head], batches):
                for r in b.to_pylist():
                    lines.append(f"{r['key']}\t{r['archive']} {r['offset']} {r['length']}")
                    if len(lines) == block:
                        at = flush()
            if lines:
                at = flush()
            tail = zlib.compress(json.dumps(directory).encode())
            f.write(tail + len(tail).to_bytes(8, "little"))
        yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "shard": [name]})

    return stored(rows.mapInArrow(save, "first string, shard string"), "shards")


class Shard:
    """A shard's directory; blocks are read by range when a key may be in them."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.directory = json.loads(zlib.decompress(self.file.read_at(n, size - 8 - n)))
        self.firsts = [d[0] for d in self.directory]
        self.held: tuple[int, list[tuple[str, str]]] = (-1, [])

    def block(self, i: int) -> list[tuple[str, str]]:
        if self.held[0] != i:
            _, at, n = self.directory[i]
            text = zlib.decompress(self.file.read_at(n, at)).decode("utf-8", "surrogatepass")
            self.held = (i, [tuple(x.split("\t")) for x in text.split("\n")])
        return self.held[1]

    def find(self, key: str):
        """Places of all captures with this key: they may start in the block before the first that begins with it."""
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.firsts) and self.firsts[i] <= key:
            rows = self.block(i)
            at = bisect.bisect_left(rows, (key,))
            while at < len(rows) and rows[at][0] == key:
                yield rows[at][1]
                at += 1
            i += 1


def lookup(keys: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """(key, archive, offset, length) of every capture of the distinct keys(key)."""
    tops = sorted((r.first, r.shard) for r in shards.collect())  # one row an index partition
    rows = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")

    def search(batches):
        fs, root = filesystem(folder)
        firsts = [t[0] for t in tops]
        held: dict[int, Shard] = {}
        for b in batches:
            found = []
            for key in b.column(0).to_pylist():
                i = max(0, bisect.bisect_left(firsts, key) - 1)
                while i < len(firsts) and firsts[i] <= key:
                    if i not in held:
                        for k in [k for k in held if k < i - 1]:
                            held.pop(k).file.close()
                        held[i] = Shard(fs, f"{root}/{tops[i][1]}")
                    found += [(key, *place.split(" ")) for place in held[i].find(key)]
                    i += 1
            key, archive, offset, length = zip(*found, strict=True) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(archive, pa.string()), pa.array(map(int, offset), pa.int64()), pa.array(map(int, length), pa.int64())], names=["key", "archive", "offset", "length"])

    return rows.mapInArrow(search, "key string, archive string, offset bigint, length bigint")


def fetch(places: DataFrame, folder: str, id_type: str = "bigint", payload: bool = False, task_bytes: int = 16 << 20) -> DataFrame:
    """Reads the records at (archive, offset, length) by range; the payload's text is returned if asked for.

    Places are small whatever lies at them, so the number of tasks follows from the records' bytes, ``task_bytes`` a task.
    """
    places = stored(places.select("archive", "offset", "length"), "places")
    tasks = max(places.sparkSession.sparkContext.defaultParallelism, -(-(places.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    rows = places.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = f"page_id {id_type}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}" + ", payload string" * payload

    def read(batches):
        fs, root = filesystem(folder)
        name, file = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["archive"] != name:
                    if file:
                        file.close()
                    name, file = r["archive"], fs.open_input_file(f"{root}/{r['archive']}")
                x = parse(file.read_at(r["length"], r["offset"]))
                out.append((x["page_id"], x["url"], x["size"], x["digest"], x["type"], x["refers"], *([x["payload"].decode("utf-8", "surrogatepass")] * payload)))
            cols = list(zip(*out, strict=True)) if out else [()] * (6 + payload)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(places.sparkSession.createDataFrame([], schema).schema)
    types, names = arrow.types, arrow.names
    return rows.mapInArrow(read, schema)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = 0, payload: bool = False) -> DataFrame:
    """Writes pages, indexes the captures, looks every page up and reads its record back."""
    spark: SparkSession = pages.sparkSession
    folder = work_dir(spark, "warc")
    manifest = write(pages, f"{folder}/archive", page_id, url, html, min_revisit)
    shards = index(manifest, f"{folder}/index")
    wanted = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"))
    id_type = wanted.schema["page_id"].dataType.simpleString()

    def keyed(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array([capture_key(u, p) for p, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], pa.string())})

    places = lookup(wanted.mapInArrow(keyed, "key string"), shards, f"{folder}/index")
    return fetch(places, f"{folder}/archive", id_type, payload)
