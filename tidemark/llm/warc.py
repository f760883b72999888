"""WARC archives: a deterministic sharded writer and a reader of whole archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import join_counted, small_batches, stored

#: Compressed bytes after which a file is rolled.
ROLL_BYTES = 64 << 20
#: Shards that there should be, and the least and most bytes of one, which go before that number.
SHARDS, LEAST_SHARD, MOST_SHARD = 1024, 8 << 20, 256 << 20
#: Parts by payload that the rows of one id split into, and ids that one task sums up.
PARTS, ROWS_PER_TASK = 1024, 500_000
LEVEL = 3
#: Every record bears this date unless the caller gives another: archives are the same from run to run.
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SOFTWARE = "tidemark"
#: What commits a folder's archives, the names that this writer gives, and the shards whose files one part lists.
MANIFEST, OWN_NAMES, SHARDS_A_PART = "_MANIFEST.json", re.compile(r"part-\d{6}-\d{5}\.warc\.gz$|_MANIFEST[-.].*|_temporary-"), 1024


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(str, parts)))}>"


def record(kind: str, headers: list[tuple[str, str]], body: bytes, content_type: str) -> bytes:
    """One WARC/1.1 record as a gzip member of its own, the same bytes each time."""
    head = [("WARC-Type", kind), *headers, ("Content-Type", content_type), ("Content-Length", str(len(body)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + body + b"\r\n\r\n") + packer.flush()


def page_record(name: tuple, page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: str, refers: int | None, date: datetime) -> bytes:
    """A response record, or without a payload a revisit that names the response with the same one.

    name tells records apart: the id and which of its rows it is.
    """
    when = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length + (payload or b"")
    uri = "".join(c for c in url or "" if c > " ") or f"urn:page:{page_id}"
    headers = [
        ("WARC-Record-ID", record_id("page", *name)),
        ("WARC-Date", when),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest32(body)}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(length)),
    ]
    if payload is None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id("page", refers, 0)), ("X-Refers-To-Page-Id", str(refers))]
    return record("revisit" if payload is None else "response", headers, body, "application/http; msgtype=response")


def info_record(name: str, date: datetime) -> bytes:
    body = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
    return record("warcinfo", [("WARC-Record-ID", record_id("info", name)), ("WARC-Date", date.strftime("%Y-%m-%dT%H:%M:%SZ")), ("WARC-Filename", name)], body, "application/warc-fields")


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that is shared by all (a URI or a plain path)."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def shard_starts(sizes: DataFrame) -> list[tuple]:
    """The first (id, part) of each shard, from rows (id, part, size): equal shares of the bytes before a row.

    Rows are sorted into ranges; bytes before a row are its range's plus those of the ranges before. They depend
    on the rows alone, not on where ranges were cut; the driver holds a number a range and a row a shard.
    """
    order = (F.asc_nulls_first("id"), F.asc("part"))
    ranges = max(1, -(-sizes.count() // ROWS_PER_TASK))
    placed = stored(sizes.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()), "warc-ranges")
    told = sorted((r["range"], r["size"]) for r in placed.groupBy("range").agg(F.sum("size").alias("size")).collect())
    total = sum(size for _, size in told)
    wide = min(max(total // SHARDS, LEAST_SHARD), MOST_SHARD)
    before, at = {}, 0
    for k, size in told:
        before[k], at = at, at + size

    def firsts(batches):
        last, at = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("size").to_numpy()
            at = before[batch.column("range")[0].as_py()] if at is None else at
            ends = at + np.cumsum(size)
            shard = (ends - size) // wide
            new = np.flatnonzero(np.diff(shard, prepend=-1 if last is None else last))
            last, at = shard[-1], int(ends[-1])
            yield pa.RecordBatch.from_arrays([pa.array(shard[new], pa.int64()), batch.column("id").take(pa.array(new)), batch.column("part").take(pa.array(new))], ["shard", "id", "part"])

    low = lambda r: (r["id"] is not None, r["id"] or 0, r["part"])
    starts: dict[int, tuple] = {}
    for r in placed.mapInArrow(firsts, "shard long, id long, part int").collect():
        starts[r["shard"]] = min(starts.get(r["shard"], low(r)), low(r))
    return [starts[k] for k in sorted(starts)]


def own_files(system: fs.FileSystem, root: str) -> list[fs.FileInfo]:
    """What runs of this writer have in a folder: archives, manifests, and temporary folders of runs that died."""
    if system.get_file_info(root).type == fs.FileType.NotFound:
        return []
    return [f for f in system.get_file_info(fs.FileSelector(root)) if OWN_NAMES.match(f.base_name)]


def made_ready(folder: str, replace: bool) -> None:
    """Leaves nothing of other runs in folder: what no manifest commits goes; what one does is an error, or goes too."""
    system, root = opened(folder)
    found = own_files(system, root)
    if any(f.base_name == MANIFEST for f in found) and not replace:
        raise FileExistsError(f"{folder} holds archives that {MANIFEST} commits; replace them, or write elsewhere")
    for f in sorted(found, key=lambda f: f.base_name != MANIFEST):  # the manifest first: what is half gone isn't committed
        (system.delete_dir if f.type == fs.FileType.Directory else system.delete_file)(f.path)


def commit_manifest(files: DataFrame, folder: str) -> None:
    """Writes the manifest of files (file, records, bytes, sha256): parts by ranges of shards, one JSON line a file in the
    order of names, then MANIFEST, which names the parts with their sizes and hashes and commits them all.

    The same files give the same bytes, whoever wrote them when.
    """
    shard = F.regexp_extract("file", r"part-(\d+)-", 1).cast("int")

    def written(table: pa.Table) -> pa.Table:
        system, root = opened(folder)
        rows = sorted(table.select(["file", "records", "bytes", "sha256"]).to_pylist(), key=lambda r: r["file"])
        data = "".join(json.dumps(r) + "\n" for r in rows).encode()
        name, temp = f"_MANIFEST-{table.column('part')[0].as_py():06d}.jsonl", f"_temporary-manifest-{uuid.uuid4().hex}"
        with system.open_output_stream(f"{root}/{temp}") as f:
            f.write(data)
        system.move(f"{root}/{temp}", f"{root}/{name}")  # attempts write the same, so the last one may win
        sums = [len(rows), sum(r["records"] for r in rows), sum(r["bytes"] for r in rows)]
        return pa.table({"part": [name], "files": [sums[0]], "records": [sums[1]], "bytes": [sums[2]], "sha256": [hashlib.sha256(data).hexdigest()]})

    parts = files.withColumn("part", F.floor(shard / SHARDS_A_PART).cast("int")).groupBy("part").applyInArrow(written, "part string, files long, records long, bytes long, sha256 string")
    told = sorted((r.asDict() for r in parts.collect()), key=lambda r: r["part"])  # a row for some thousand files
    totals = {k: sum(r[k] for r in told) for k in ("files", "records", "bytes")}
    system, root = opened(folder)
    temp = f"{root}/_temporary-manifest-{uuid.uuid4().hex}"
    system.create_dir(root, recursive=True)
    with system.open_output_stream(temp) as f:
        f.write(json.dumps({**totals, "parts": told}).encode())
    system.move(temp, f"{root}/{MANIFEST}")


def manifest_files(spark: SparkSession, folder: str) -> DataFrame:
    """file, records, bytes and sha256 of the archives that are committed in folder; none, if no run has ended there.

    A part that isn't what the manifest says fails the job.
    """
    kinds = "file string, records long, bytes long, sha256 string"
    system, root = opened(folder)
    if system.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], kinds)
    with system.open_input_stream(f"{root}/{MANIFEST}") as f:
        parts = json.loads(f.read())["parts"]

    def read(batches):
        system, root = opened(folder)
        for batch in batches:
            for part in batch.to_pylist():
                with system.open_input_stream(f"{root}/{part['part']}") as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != part["sha256"]:
                    raise ValueError(f"{part['part']} isn't the part that {MANIFEST} of {folder} names")
                yield pa.RecordBatch.from_pylist([json.loads(x) for x in data.splitlines()])

    if not parts:
        return spark.createDataFrame([], kinds)
    return spark.createDataFrame([(p["part"], p["sha256"]) for p in parts], "part string, sha256 string").repartition(len(parts)).mapInArrow(read, kinds)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: datetime = DATE, roll_bytes: int = ROLL_BYTES, replace: bool = False, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes a WARC record of each row into folder; returns the manifest: file, records, bytes, sha256.

    Shards are ranges of the id with about equal bytes, an id with very many rows splitting by payload, so they
    depend on the rows alone; a task writes one shard, sorted by id and payload, one gzip member a record, with
    regenerated headers and digests; a file is rolled after roll_bytes compressed bytes. Tasks write under
    temporary names that no other attempt shares; the list of the attempts that count is stored, the files in it
    are renamed, and the manifest that names each file with its records, bytes and hash, written last, commits them
    (commit_manifest, read by manifest_files). What lost attempts left is removed, and so is, before, what a run that
    died left in folder; archives that a manifest commits there are an error unless replace says that they go.

    Of equal payloads (by SHA-256) of least_bytes or more the row with the least id is a response, the others
    revisit it; only lengths and digests of those are shuffled. Null payloads are empty; a null id comes first
    and is always a response; rows with one id and payload follow each other, and if the payload is theirs the
    first is the response. An empty table gives an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    small_batches(spark)
    made_ready(folder, replace)
    body, id_ = F.coalesce(F.col(body_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    own = pages.select(id_.alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    own = own.withColumns({"print": F.unhex(F.sha2("body", 256)), "length": F.octet_length("body").cast("long")})
    own = own.withColumn("part", F.pmod(F.xxhash64("print"), F.lit(PARTS)).cast("int"))
    marks = stored(own.select("id", "print", "part", "length"), "warc-marks")
    twins = marks.where(F.col("length") >= least_bytes).groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("copies")).where("copies > 1")
    twins = stored(twins, "warc-twins")
    revisits = F.coalesce(F.col("id") != F.col("least"), F.lit(False))  # repeated rows of the least id aside
    size = F.when(revisits, 0).otherwise(F.col("length")) + 512
    starts = shard_starts(join_counted(marks, twins, "print", "copies", "left").groupBy("id", "part").agg(F.sum(size).alias("size")))
    shared = spark.sparkContext.broadcast(tuple(np.array(c, np.int64) for c in zip(*starts, strict=True)) if starts else None)

    @F.arrow_udf("int")
    def shard_of(ids: pa.Array, parts: pa.Array) -> pa.Array:
        known, first_id, first_part = shared.value
        some = np.array(ids.is_valid())
        keys = np.rec.fromarrays([some, ids.fill_null(0).to_numpy(), parts.to_numpy().astype(np.int64)])
        table = np.rec.fromarrays([known.astype(bool), first_id, first_part])
        return pa.array(np.searchsorted(table, keys, "right") - 1, pa.int32())

    ready = join_counted(own, twins, "print", "copies", "left")
    ready = ready.select("id", "url", "print", "part", "length", "least", F.sha1("body").alias("digest"), F.when(~revisits, F.col("body")).alias("body"))
    ready = ready.withColumn("shard", shard_of("id", "part"))
    ordered = ready.repartitionById(max(1, len(starts)), "shard").sortWithinPartitions("shard", F.asc_nulls_first("id"), "part", "print", "url")
    names = uuid.uuid4().hex[:12]

    def written(batches):
        system, root = opened(folder)
        out, buffer, count, shard_now, file_no, name = None, 0, 0, None, 0, ""
        sha, temp, done, last, repeat, nulls = None, "", [], None, 0, 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((temp, name, count, buffer, sha.hexdigest()))
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard_now:
                    close()
                    shard_now, file_no, nulls = row["shard"], 0, 0
                elif out is not None and buffer >= roll_bytes:
                    close()
                    file_no += 1
                if out is None:
                    name = f"part-{shard_now:06d}-{file_no:05d}.warc.gz"
                    temp = f"_temporary-{names}/{uuid.uuid4().hex}.warc.gz"
                    system.create_dir(f"{root}/_temporary-{names}", recursive=True)
                    out = system.open_output_stream(f"{root}/{temp}", compression=None)
                    data = info_record(name, date)
                    out.write(data)
                    buffer, count, sha = len(data), 1, hashlib.sha256(data)
                page, least = row["id"], row["least"]
                repeat = repeat + 1 if (page, row["print"]) == last else 0
                last = page, row["print"]
                first = page is None or least is None or (page == least and not repeat)
                payload = row["body"].encode() if first else None
                digest = digest32(payload) if first else base64.b32encode(bytes.fromhex(row["digest"])).decode()
                # the response to a payload that others revisit is (id, 0); other rows are told apart by the payload
                key = (page, 0) if page == least and not repeat else (page, row["print"].hex(), repeat)
                if page is None:
                    key, nulls = (None, shard_now, nulls), nulls + 1
                data = page_record(key, page, row["url"], payload, row["length"], digest, least, date)
                out.write(data)
                sha.update(data)
                buffer, count = buffer + len(data), count + 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["temp", "file", "records", "bytes", "sha256"])

    manifest = stored(ordered.mapInArrow(written, "temp string, file string, records long, bytes long, sha256 string"), "warc-manifest")

    def committed(batches):
        system, root = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if system.get_file_info(f"{root}/{row['temp']}").type != fs.FileType.NotFound:
                    system.move(f"{root}/{row['temp']}", f"{root}/{row['file']}")
            yield batch.select(["file", "records", "bytes", "sha256"])

    files = stored(manifest.mapInArrow(committed, "file string, records long, bytes long, sha256 string"), "warc-files")
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    if system.get_file_info(f"{root}/_temporary-{names}").type != fs.FileType.NotFound:
        system.delete_dir(f"{root}/_temporary-{names}")
    commit_manifest(files, folder)
    return files


def parse_records(stream):
    """(headers, block) of each record of a WARC file, gzip members or plain."""
    data = io.BufferedReader(stream) if not isinstance(stream, io.BufferedReader) else stream
    while True:
        line = data.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {line[:40]!r}")
        headers = {}
        while (line := data.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield headers, data.read(int(headers["content-length"]))


FIELDS = "file string, record_type string, page_id long, uri string, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean"


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """The page records of the files (column file) in folder, one task a file: FIELDS.

    Responses' lengths and digests are taken from the payload read back, revisits' from their headers;
    digest_ok says whether block and payload match the digests of the headers.
    """
    def read(batches):
        system, root = opened(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for headers, block in parse_records(stream):
                        if headers["warc-type"] not in ("response", "revisit"):
                            continue
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        revisit = headers["warc-type"] == "revisit"
                        told = headers["warc-payload-digest"].removeprefix("sha1:")
                        digest = told if revisit else digest32(payload)
                        ok = headers["warc-block-digest"] == f"sha1:{digest32(block)}" and digest == told
                        page, refers = headers.get("x-page-id", ""), headers.get("x-refers-to-page-id", "")
                        rows.append((name, headers["warc-type"], int(page) if page else None, headers["warc-target-uri"], int(headers["x-payload-length"]) if revisit else len(payload), digest, int(refers) if refers else None, ok))
                        if len(rows) == 4096:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    columns = [f.split()[0] for f in FIELDS.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], columns)

    spread = files.select("file").repartitionByRange(max(1, files.count()), "file")
    return spread.mapInArrow(read, FIELDS)
