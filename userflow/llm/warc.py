"""Web archives: writing, reading back, and a globally ordered capture index.

Records are written by the tasks that hold the pages, straight into the shared folder,
one gzip member each. Reading an archive gives its captures as a run sorted by URL key and
time. Runs are dealt out by ranges of the key, and each range is merged from its slices of
the runs with a loser tree: one comparison for each level of the tree and capture.

A task's files count only if the table of files that the tasks return has them, so a
failed or repeated attempt leaves unread files behind and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.llm import bloom
from userflow.llm.tables import stored
from userflow.session import scratch

LEAST_BYTES = 1000  # of a payload that may be replaced by a revisit
FILE_BYTES = 1 << 30  # of an archive before the next one is begun
RANGE_ROWS = 20_000  # captures of one merged range, on average
LEVEL = 5  # of compression
DIGEST_BITS = 1 << 27  # of the filter that finds repeated payloads, at most
_CHUNK = 1 << 20

# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` (page_id, url, captured, html) with digest (SHA-1 of the html, a null one
    as empty) and refers_to: null for a response; of pages with equal payloads of at least
    ``least_bytes``, the one with the largest page_id, for all others. A page without an
    id refers to such a page, too, if there is any."""
    payload = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", "captured", payload.alias("html"), F.sha1(payload).alias("digest"))
    able = marked.where(F.octet_length("html") >= least_bytes)
    repeated = stored(
        able.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated"
    )
    # Only pages that may be repeated are shuffled; the others stay where they are read.
    some = bloom.build(repeated, "digest", bloom.bits_for(repeated.count(), 16, DIGEST_BITS), 2)
    maybe = (F.octet_length("html") >= least_bytes) & some.contains(F.col("digest"))
    other = F.coalesce(F.col("page_id") != F.col("holder"), F.col("holder").isNotNull())
    joined = marked.where(maybe).join(repeated, "digest", "left").select(
        "page_id", "url", "captured", "html", "digest", F.when(other, F.col("holder")).alias("refers_to")
    )
    return joined.union(marked.where(~maybe).withColumn("refers_to", F.lit(None).cast("long")))


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + _END) + packer.flush()


def _target(url: str | None) -> str:
    """The url with what a header line cannot hold as escapes."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda c: f"%{ord(c[0]):02X}" if c[0] != "%" else "%", url or "")


def _capture(page: int | None, url: str | None, captured: datetime | None, html: str, digest: str, refers_to: int | None) -> bytes:
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    when = (captured or datetime(1970, 1, 1)).strftime("%Y-%m-%dT%H:%M:%SZ")
    packed = base64.b32encode(bytes.fromhex(digest)).decode()
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", when),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{packed}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        return _member(fields, http + payload)
    return _member([*fields, ("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)], http)


def _writer(folder: str, file_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        names, sizes = [], []
        out = None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None or sizes[-1] >= file_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    sizes.append(0)
                    out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                record = _capture(*row)
                out.write(record)
                sizes[-1] += len(record)
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, captured, html), in archives below
    ``folder``, a URI all executors reach; returns the written table of files (file,
    bytes). An empty table writes none."""
    columns = ["page_id", "url", "captured", "html", "digest", "refers_to"]
    typed = with_revisits(pages, least_bytes).select(*columns)
    typed = typed.withColumn("captured", F.col("captured").cast("timestamp").cast("timestamp_ntz"))
    return stored(typed.mapInArrow(_writer(folder, file_bytes), "file string, bytes long"), "archives")


def url_key(url: str) -> str:
    """Sort key of a url: host labels from the last to the first, then path and query, so
    that captures of a site, and of a page, stand together."""
    host, slash, rest = url.partition("://")[2].partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + rest.partition("#")[0]


def members(stream: Any) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of a stream, read in chunks."""
    offset, data = 0, stream.read(_CHUNK)
    while data:
        unpacker, parts, used = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not data:
                data = stream.read(_CHUNK)
                if not data:
                    raise ValueError(f"archive ends within the record at {offset}")
            parts.append(unpacker.decompress(data))
            used += len(data) - len(unpacker.unused_data)
            data = unpacker.unused_data
        yield offset, used, b"".join(parts)
        offset += used
        data = data or stream.read(_CHUNK)


def _page(record_id: str | None) -> int | None:
    found = re.search(r":(-?\d+)>$", record_id or "")
    return int(found[1]) if found else None


def parsed(content: bytes) -> dict[str, Any]:
    """A capture record's fields; the payload of a response must have its digest."""
    head, _, block = content.partition(_END)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no archive record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(_END)
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response":
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    else:
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    return {
        "url_key": url_key(fields["WARC-Target-URI"]),
        "captured": datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC),
        "page_id": _page(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To")),
    }


RUN = pa.schema(
    [
        ("url_key", pa.string()), ("captured", pa.timestamp("us", "UTC")), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("file", pa.string()), ("offset", pa.int64()), ("bytes", pa.int64()), ("place", pa.int64()),
    ]
)
SCHEMA = (
    "url_key string, captured timestamp, page_id long, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, file string, offset long, bytes long, place long"
)


def _order(row: dict[str, Any]) -> tuple:
    page = row["page_id"]
    return row["url_key"], row["captured"], page is not None, page or 0, row["file"], row["offset"]


def _reader(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, size, content in members(stream):
                        rows.append({**parsed(content), "file": name, "offset": offset, "bytes": size})
                rows.sort(key=_order)
                for place, row in enumerate(rows):
                    row["place"] = place
                yield pa.RecordBatch.from_pylist(rows, RUN)

    return run


def read_runs(files: DataFrame, folder: str) -> DataFrame:
    """The captures of the archives, each archive's as a run in the order of URL key, time
    and page_id; a task reads a few archives."""
    n = files.count()
    dealt = files.select("file").repartition(max(1, min(n, 10_000)), "file")
    return stored(dealt.mapInArrow(_reader(folder), SCHEMA), "runs")


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """K-way merge of sorted runs with a loser tree. Each inner node keeps the run that
    lost there; the winner's next item replays the path from its leaf to the root."""
    heads = [next(run, None) for run in runs]
    n = len(runs)
    losers = [-1] * n  # -1: nobody came by yet, and wins

    def beats(a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return a < 0
        return heads[b] is None or (heads[a] is not None and heads[a] <= heads[b])

    def replay(run: int) -> None:
        node = (run + n) // 2
        while node:
            if beats(losers[node], run):
                run, losers[node] = losers[node], run
            node //= 2
        losers[0] = run

    for run in reversed(range(n)):
        replay(run)
    while n and heads[losers[0]] is not None:
        winner = losers[0]
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        replay(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, by run and place, into one order."""
    table = pa.Table.from_batches(list(batches), RUN).combine_chunks()
    files, keys = table["file"].to_pylist(), table.select(["url_key", "captured", "page_id", "file", "offset"]).to_pylist()
    cuts = [i for i in range(len(files)) if not i or files[i] != files[i - 1]] + [len(files)]
    runs = [iter([(*_order(keys[i]), i) for i in range(a, b)]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    order = pa.array([item[-1] for item in merged(runs)], pa.int64())
    yield from table.take(order).to_batches()


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in the order of URL key, time and page_id: partition after partition,
    and within each. The ranges are told apart by place in the archives last, so that not
    even equal captures need share a task."""
    n = max(1, -(-runs.count() // range_rows))
    dealt = runs.repartitionByRange(n, "url_key", "captured", "page_id", "file", "offset")
    return dealt.sortWithinPartitions("file", "place").mapInArrow(_merge, SCHEMA).drop("place")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a full URI: Spark takes one without a scheme for its default file
    system, the tasks' own file access would not."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def archived(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, captured, html) as archives, reads them back and
    returns the merged index: url_key, captured, page_id, payload_bytes, payload_digest
    (of the full payload, lower-case hex SHA-1), record_type (response or revisit),
    refers_to, file, offset, bytes.

    A null html is an empty payload, a null url an empty one, a null time 1970. Repeated
    rows are records of their own; those that share the largest page_id of a payload are
    all responses. Other columns are not looked at. An empty table gives an empty index.
    """
    folder = _qualified(pages.sparkSession, folder or scratch(pages.sparkSession, "llm/warc"))
    return merged_index(read_runs(write_archives(pages, folder, least_bytes), folder))
