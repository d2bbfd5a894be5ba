"""Web archives (WARC 1.1): writing with revisits, reading, and assembly of transactions.

Writing: pages of equal payload (SHA-1 and length) keep one copy, in a response record of the smallest page_id; the others are
revisit records that refer to it, with its address and date. Every page also gets a request record and a metadata record (its page_id as a field);
both name the response or revisit by WARC-Concurrent-To. Each record is a gzip member of its own; a file begins with a warcinfo record and closes at about 32 MB of
blocks. Reading streams a file record by record, whatever a file's size, plain or gzip.

Assembly: concurrent-to identifiers link records, whichever side names the other and over however many members; what they link (a connected component) is
a capture, one nested row, if a response, revisit or resource record is among it. The first of these kinds that is there is its hub, of several records the one of smallest id; the others of them are
in ``others``. An identifier that no record has links those that name it all the same. Members without a capture come as rows of their own, with a null hub. A capture's members meet in
one task, as they're one row; nothing else is gathered.

Damaged archives don't end a job: a record has a status. ``truncated``: the file ends before the record does; ``damaged``: no record header, or no length, where one should be (a plain file is
read on from the next header), or a gzip member that can't be unpacked (the rest of that file is given up). Such rows have a null payload and no part in assembly. Records of one id are one node: the links of all of them count, and a hub that is there twice is one capture, the smaller of the two. A record without an id is a row with a null hub; equal ones are one row.

Defined results: null html is an empty payload. Repeated rows (equal page_id and payload) get records of their own with equal
roles. Rows of one page_id with other payloads are other captures of it. A null page_id is written as such; it becomes the response only of a payload that no page with an
id has. An empty table gives no files and no rows. Very long payloads are one record each. Columns other than page_id, url and html are not read, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.components import star_components
from scriptorium.llm.storage import discard, materialize, reading, scratch, tables, task_fs, task_write

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HUBS = ("response", "revisit", "resource")
NAMES = uuid.UUID("5b0e7c1e-55a6-4c0f-9d5b-0a6a3c1c8f10")


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, '/'.join(map(str, parts)))}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, ident: str, block: bytes, **fields) -> bytes:
    """One record as a gzip member."""
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {ident}".encode(), f"WARC-Date: {DATE}".encode()]
    head += [f"{k.replace('_', '-')}: {_line(v)}".encode() for k, v in fields.items() if v is not None]
    head.append(f"Content-Length: {len(block)}".encode())
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(b"\r\n".join(head) + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _line(value) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, sha1 (hex), role, refers_to, refers_url: a row for each page_id and payload, a written table. Payloads under min_bytes are all responses."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    with tables() as keep:
        narrow = keep(pages.select("page_id", "url", F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("bytes")).distinct(), "warc-narrow")
        named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
        first = keep(narrow.groupBy("sha1", "bytes").agg(F.min(named).alias("first")), "warc-first")
        own = narrow.drop("url").distinct().join(first.hint("merge"), ["sha1", "bytes"])
        revisit = ~F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("bytes") >= min_bytes)
        out = own.select("page_id", "sha1", F.when(revisit, "revisit").otherwise("response").alias("role"), F.when(revisit, F.col("first.page_id")).alias("refers_to"), F.when(revisit, F.col("first.url")).alias("refers_url"))
        return materialize(out, "warc-roles")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes page_id, url, html; returns the table of files: path, n_records."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    told = roles(pages, min_bytes)
    known = told.select("page_id", F.col("refers_url").alias("url"), F.lit(None).cast("binary").alias("payload"), "role", "refers_to", F.col("sha1").alias("s"))
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    none = F.lit(None).cast("string").alias("role"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to")
    own = pages.select("page_id", "url", payload.alias("payload"), *none).withColumn("s", F.sha1("payload"))
    # each role before the pages that it's for, in one shuffle; records of one page and payload follow each other, so
    # that repeated rows can be numbered
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = known.unionByName(own).repartition(parts, "page_id", "s").sortWithinPartitions("page_id", "s", F.col("role").isNull(), "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, size, n, again, given, refers_to, refers_url = TaskContext.get().partitionId(), [], 0, 0, 0, "", None, None
        done = lambda: pa.RecordBatch.from_pydict({"path": [task_write(folder, f"{part:06d}", b"".join(out))], "n_records": [n]}, pa.schema([("path", pa.string()), ("n_records", pa.int64())]))
        for batch in batches:
            for k in range(batch.num_rows):
                page, url, payload, role, refers, sha1 = (c[k].as_py() for c in batch.columns)
                if role:
                    given, refers_to, refers_url, again = role, refers, url, -1
                    continue
                again += 1
                if not out:
                    about = b"software: scriptorium\r\nformat: WARC File Format 1.1\r\n"
                    out.append(record("warcinfo", record_id("warcinfo", part, page, sha1, again), about, Content_Type="application/warc-fields"))
                    n += 1
                hub, target = record_id("page", page, sha1, again), url or f"urn:page:{page}"
                digest = "sha1:" + base32_sha1(payload)
                head = HTTP % len(payload)
                if given == "response":
                    out.append(record("response", hub, head + payload, WARC_Target_URI=target, Content_Type="application/http; msgtype=response", WARC_Payload_Digest=digest))
                    size += len(payload)
                else:
                    out.append(record("revisit", hub, head, WARC_Target_URI=target, Content_Type="application/http; msgtype=response", WARC_Payload_Digest=digest, WARC_Profile=PROFILE, WARC_Refers_To=record_id("page", refers_to, sha1, 0), WARC_Refers_To_Target_URI=refers_url or f"urn:page:{refers_to}", WARC_Refers_To_Date=DATE))
                asked = f"GET {_line(target)} HTTP/1.1\r\n\r\n".encode()
                out.append(record("request", record_id("request", page, sha1, again), asked, WARC_Target_URI=target, Content_Type="application/http; msgtype=request", WARC_Concurrent_To=hub))
                fields = f"page-id: {'' if page is None else page}\r\n".encode()
                out.append(record("metadata", record_id("metadata", page, sha1, again), fields, WARC_Target_URI=target, Content_Type="application/warc-fields", WARC_Concurrent_To=hub))
                size, n = size + 1000, n + 3
                if size >= file_bytes:
                    yield done()
                    out, size, n = [], 0, 0
        if out:
            yield done()

    files = materialize(rows.mapInArrow(run, "path string, n_records long"), "warc-files")
    discard(told)
    return files


FIELDS = "record_id string, type string, concurrent_to array<string>, target string, refers_to string, payload_digest string, payload_bytes long, payload_sha1 string, fields map<string,string>, status string"
BROKEN = (EOFError, zlib.error, gzip.BadGzipFile)


def records(stream) -> Iterator[tuple[dict[str, list[str]], bytes, str]]:
    """Header fields (lower-case names), block and status of each record of an open archive, already unpacked."""
    head: dict[str, list[str]] = {}
    lost = False  # between a damaged place and the next header
    try:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                if not lost:
                    yield {}, b"", "damaged"
                lost = True
                continue
            lost, head = False, {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                head.setdefault(name.strip().lower(), []).append(value.strip())
            size = head.get("content-length", [""])[0]
            if not line:
                yield head, b"", "truncated"
            elif not size.isdecimal():
                yield head, b"", "damaged"
                lost = True
            else:
                block = stream.read(int(size))
                yield (head, block, "ok") if len(block) == int(size) else (head, b"", "truncated")
            head = {}
    except BROKEN as e:
        yield head, b"", "truncated" if isinstance(e, EOFError) else "damaged"


def unpacked(raw):
    """An open archive as it's meant to be read: gzip members unpacked, plain ones as they are."""
    start = raw.read(2)
    raw.seek(0)
    return gzip.GzipFile(fileobj=raw) if start == b"\x1f\x8b" else io.BufferedReader(raw)


def payload_of(head: dict[str, list[str]], block: bytes) -> bytes:
    """What follows the HTTP head, or the whole block of other kinds."""
    return block.partition(b"\r\n\r\n")[2] if "application/http" in head.get("content-type", [""])[0] else block


def read_archives(spark: SparkSession, files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row for each record of the files that column path names: FIELDS, and the payload if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("target", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("status", pa.string())]
        schema = pa.schema(kinds + [("payload", pa.binary())] * with_payload)
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = task_fs(path)
                with system.open_input_file(name) as raw, unpacked(raw) as stream:
                    for head, block, status in records(stream):
                        one = lambda k, head=head: head.get(k, [None])[0]
                        payload, kind = payload_of(head, block), one("warc-type")
                        pairs = [x.partition(":")[::2] for x in block.decode("utf-8", "replace").splitlines() if ":" in x] if "warc-fields" in (one("content-type") or "") else []
                        row = {"record_id": one("warc-record-id"), "type": kind, "concurrent_to": head.get("warc-concurrent-to", []), "target": one("warc-target-uri"), "refers_to": one("warc-refers-to"), "payload_digest": one("warc-payload-digest")}
                        row |= {"payload_bytes": len(payload), "payload_sha1": base32_sha1(payload), "fields": list({k.strip(): v.strip() for k, v in pairs}.items()), "status": status}
                        if status != "ok":
                            row |= {"payload_bytes": None, "payload_sha1": None}
                        rows.append(row | {"payload": payload if status == "ok" else None} if with_payload else row)
                        size += len(payload) * with_payload + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(parts, "path").mapInArrow(run, FIELDS + ", payload binary" * with_payload)


def places(found: DataFrame) -> DataFrame:
    """id, hub: every record id, and those that are only named, with the hub of its component (null: none has been found); a written table of ids."""
    named = F.array_except(F.coalesce("concurrent_to", F.array().cast("array<string>")), F.array("record_id"))
    mark = lambda ident, out, told, rank: F.struct(ident.alias("id"), out.cast("string").alias("out"), F.lit(told).alias("told"), rank.cast("int").alias("rank"))
    rank = F.array_position(F.array(*map(F.lit, HUBS)), F.col("type"))
    none = F.lit(None)
    own = F.array(mark(F.col("record_id"), none, False, F.when(rank > 0, rank)))
    links = F.flatten(F.transform(named, lambda o: F.array(mark(F.col("record_id"), o, False, none), mark(o, none, True, none))))
    marks = found.where("record_id is not null").select(F.inline(F.concat(own, links)))
    with tables() as keep:
        # a leaf names one record and is named by none: it belongs wherever that one belongs. Most members are leaves,
        # so only what is left has to go through rounds of components
        leaf = (F.min("out") == F.max("out")) & ~F.bool_or("told")
        ids = keep(marks.groupBy("id").agg(F.when(leaf, F.min("out")).otherwise(F.col("id")).alias("anchor"), F.min("rank").alias("rank"), F.min("out").isNotNull().alias("names")), "warc-ids")
        inner = ids.where("names and anchor = id").select("id")
        links = found.select(F.col("record_id").alias("a"), F.explode(named).alias("b"))
        roots = star_components(links.join(inner, F.col("a") == F.col("id"), "left_semi"))
        placed = ids.join(roots, F.col("anchor") == F.col("node"), "left").select("id", "rank", F.coalesce("root", "anchor").alias("group"))
        heads = placed.where("rank is not null").groupBy("group").agg(F.min(F.struct("rank", "id"))["id"].alias("hub"))
        out = materialize(placed.join(heads.hint("merge"), "group", "left").select("id", "hub"), "warc-places")
        discard(roots)
        return out


def assemble(found: DataFrame) -> DataFrame:
    """A row for each capture: hub (record id), type, target, payload_digest, payload_bytes, payload_sha1, refers_to, and requests, metadata and others, arrays of nested rows by
    record id. A member without a capture is in a row of its own, with a null hub."""
    found = found.where("status = 'ok' and type <> 'warcinfo'")
    where = places(found)
    placed = found.join(where.hint("merge"), found["record_id"] == where["id"], "left")
    # a capture's members meet; what has no capture stays apart, however many records name the same missing one
    alone = F.coalesce("record_id", F.concat(F.lit("no id "), F.sha2(F.to_json(F.struct(*found.columns)), 256)))
    placed = placed.withColumn("group", F.coalesce("hub", alone))
    about = ("type", "target", "payload_digest", "payload_bytes", "payload_sha1", "refers_to")
    nested = F.struct("record_id", "type", "target", "payload_bytes", F.map_entries("fields").alias("fields"))
    ordered = lambda what: F.array_sort(F.collect_list(F.when(what, nested)))
    restored = lambda a: F.transform(a, lambda x: F.struct(x["record_id"].alias("record_id"), x["type"].alias("type"), x["target"].alias("target"), F.map_from_entries(x["fields"]).alias("fields"), x["payload_bytes"].alias("payload_bytes")))
    is_head = F.coalesce(F.col("record_id") == F.col("hub"), F.lit(False))
    kinds = {"requests": F.col("type") == "request", "metadata": F.col("type") == "metadata", "others": ~F.col("type").isin("request", "metadata") & ~is_head}
    head = F.min(F.when(is_head, F.struct(*about))).alias("head")
    rows = placed.groupBy("group").agg(F.max("hub").alias("hub"), head, *[ordered(what).alias(name) for name, what in kinds.items()])
    out = rows.select("hub", *[F.col("head")[name].alias(name) for name in about], *[restored(name).alias(name) for name in kinds])
    return reading(out, where)


def captures(spark: SparkSession, files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each capture, from the archives alone: a revisit's
    payload is that of the response it refers to."""
    with tables() as keep:
        whole = assemble(keep(read_archives(spark, files), "warc-records"))
        page = F.try_element_at(F.get("metadata", F.lit(0))["fields"], F.lit("page-id"))
        rows = whole.where("hub is not null").select("hub", "type", "payload_digest", "payload_bytes", "payload_sha1", F.col("refers_to").alias("ref"), F.when(page != "", page.cast("long")).alias("page_id"))
        try:
            rows = materialize(rows, "warc-captures")
        finally:
            discard(whole)
    kept = rows.where("type = 'response'").select(F.col("hub").alias("r_hub"), F.col("page_id").alias("r_page"), F.col("payload_bytes").alias("r_bytes"), F.col("payload_sha1").alias("r_sha1"))
    out = rows.join(kept.hint("merge"), F.col("ref") == F.col("r_hub"), "left")
    revisit = F.col("type") == "revisit"
    either = lambda a, b: F.when(revisit, F.col(a)).otherwise(F.col(b))
    out = out.select("page_id", either("r_bytes", "payload_bytes").alias("payload_bytes"), either("r_sha1", "payload_sha1").alias("payload_digest"), F.col("type").alias("record_type"), F.when(revisit, F.col("r_page")).alias("refers_to"))
    return reading(out, rows)
