"""WARC records in ZIP packages: written, and read back by range.

A package is a ZIP file with two members stored as they are: ``archive/data.warc.gz``, a gzip member per record, and
``indexes/index.cdxj``, a line per record with its place in the archive. The reader goes from the end of the file
to the central directory (ZIP64 where its fields overflow), finds the stored members, and reads each record's range
by the index; nothing is extracted. Tasks seek in the store: one reads a package's directory and index, and the records
that the index names are dealt out by stretches of the package, so that a package of any size is read by many.

Spark writes the packages, one in a file, and a lost task is simply run again. A package holds about ``target`` bytes of payload, or one
larger record. In a store that only Spark's readers reach, packages are read as binary files, whole, of 2 GB at the most.
"""

import base64
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstream.llm.common import map_batches, slices
from wardstream.session import materialise

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
RECORDS = (
    "record_id string, record_type string, url string, refers_to_id string, "
    "payload_digest string, payload binary"
)

# ZIP structures; fixed values of the format.
_LOCAL = struct.Struct("<IHHHHHIIIHH")
_CENTRAL = struct.Struct("<IHHHHHHIIIHHHHHII")
_END = struct.Struct("<IHHHHIIH")
_END64 = struct.Struct("<IQHHIIQQQQ")
_LOCATOR64 = struct.Struct("<IIQI")
_MAGIC = {"local": 0x04034B50, "central": 0x02014B50, "end": 0x06054B50, "end64": 0x06064B50, "locator64": 0x07064B50}
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_STORED = 0

ReadAt = Callable[[int, int], bytes]
#: Bytes read at once, of an index or of neighbouring records; bytes between two records that are read with them.
STEP, GAP = 4 << 20, 1 << 12


def package(members: list[tuple[str, bytes]], comment: bytes = b"", zip64: bool = False) -> bytes:
    """A ZIP file of stored members. ``zip64``: put sizes and places in ZIP64 fields, needed or not."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        at, crc, raw = len(out), zlib.crc32(data), name.encode()
        big = zip64 or len(data) >= _FULL32 or at >= _FULL32
        size = _FULL32 if big else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        version = 45 if big else 20
        out += _LOCAL.pack(_MAGIC["local"], version, 0x800, _STORED, 0, 0x21, crc, size, size, len(raw), len(extra))
        out += raw + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if big else b""
        directory += _CENTRAL.pack(
            _MAGIC["central"], version, version, 0x800, _STORED, 0, 0x21, crc, size, size,
            len(raw), len(extra), 0, 0, 0, 0, _FULL32 if big else at,
        )
        directory += raw + extra
    start, n = len(out), len(members)
    out += directory
    if zip64 or start >= _FULL32 or n >= _FULL16:
        end = len(out)
        out += _END64.pack(_MAGIC["end64"], 44, 45, 45, 0, 0, n, n, len(directory), start)
        out += _LOCATOR64.pack(_MAGIC["locator64"], 0, end, 1)
        out += _END.pack(_MAGIC["end"], 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, len(comment))
    else:
        out += _END.pack(_MAGIC["end"], 0, 0, n, n, len(directory), start, len(comment))
    return bytes(out + comment)


def members(read_at: ReadAt, size: int) -> dict[str, tuple[int, int]]:
    """Place and size of the data of each stored member, by name.

    ``read_at(offset, length)`` reads a range. Raises ValueError if this is no ZIP file; members that are compressed
    or encrypted have no range of their own and are left out.
    """
    tail_size = min(size, _END.size + _FULL16)
    tail = read_at(size - tail_size, tail_size)
    at = len(tail)
    while True:
        at = tail.rfind(struct.pack("<I", _MAGIC["end"]), 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + _END.size <= len(tail):
            end = _END.unpack_from(tail, at)
            if at + _END.size + end[7] == len(tail):
                break
    n, length, start = end[4:7]
    if n == _FULL16 or length == _FULL32 or start == _FULL32:
        place = size - tail_size + at - _LOCATOR64.size
        if place >= 0:
            locator = _LOCATOR64.unpack(read_at(place, _LOCATOR64.size))
            if locator[0] == _MAGIC["locator64"]:
                end64 = _END64.unpack(read_at(locator[2], _END64.size))
                if end64[0] != _MAGIC["end64"]:
                    raise ValueError("broken ZIP64 end of central directory")
                n, length, start = end64[7:10]
    directory, found, at = read_at(start, length), {}, 0
    for _ in range(n):
        entry = _CENTRAL.unpack_from(directory, at)
        if entry[0] != _MAGIC["central"]:
            raise ValueError("broken central directory")
        flags, method, packed, plain = entry[3], entry[4], entry[8], entry[9]
        n_name, n_extra, n_comment, place = entry[10], entry[11], entry[12], entry[16]
        at += _CENTRAL.size
        name = directory[at : at + n_name].decode("utf-8", "replace")
        extra = directory[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                plain = next(wide) if plain == _FULL32 else plain
                packed = next(wide) if packed == _FULL32 else packed
                place = next(wide) if place == _FULL32 else place
            extra = extra[4 + width :]
        if method == _STORED and not flags & 1:
            # The local header's own name and extra fields may have other lengths.
            local = _LOCAL.unpack(read_at(place, _LOCAL.size))
            if local[0] != _MAGIC["local"]:
                raise ValueError("broken local header")
            found[name] = (place + _LOCAL.size + local[9] + local[10], packed)
    return found


def places(read_at: ReadAt, size: int) -> Iterator[tuple[int, int]]:
    """Place and size in the package of each record that one of its indexes names. An index is read in steps of STEP."""
    found = members(read_at, size)
    for name, (at, length) in sorted(found.items()):
        if not (name.startswith("indexes/") and name.endswith(".cdxj")):
            continue
        rest = b""
        for done in range(0, length, STEP):
            *lines, rest = (rest + read_at(at + done, min(STEP, length - done))).split(b"\n")
            if done + STEP >= length:
                lines.append(rest)
            for line in filter(None, lines):
                entry = json.loads(line.decode().split(" ", 2)[2])
                base, room = found[f"archive/{entry['filename']}"]
                offset, width = int(entry["offset"]), int(entry["length"])
                if offset + width > room:
                    raise ValueError("the index points outside its archive")
                yield base + offset, width


def record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, block = gzip.decompress(raw).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, block[: int(headers["Content-Length"])]


def records(read_at: ReadAt, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record that an index of the package points to, one range read each."""
    for at, width in places(read_at, size):
        yield record(read_at(at, width))


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    """A header value, percent-coded where it would break its line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def _record(kind: str, record_id: str, url: str | None, refers_to: str | None, payload: bytes, sha: str) -> bytes:
    block = payload if kind == "response" else b""
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_one_line(url)}")
    if kind == "revisit":
        headers.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        headers.append(f"WARC-Refers-To: {refers_to}")
    return gzip.compress("\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def _packages(target: int, zip64: bool):
    """Rows of (kind, record_id, url, refers_to, payload) into rows of one package each."""

    def run(batches):
        archive, index, held = bytearray(), [], 0

        def close():
            files = [(ARCHIVE, bytes(archive)), (INDEX, "".join(index).encode())]
            # The line end that the text writer adds is the package's comment.
            whole = package(files, b"\n", zip64)[:-1]
            archive.clear()
            index.clear()
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["value"])

        for batch in batches:
            for part in slices(batch, "payload"):
                for row in part.to_pylist():
                    payload = row["payload"]
                    sha = digest(payload)
                    one = _record(row["kind"], row["record_id"], row["url"], row["refers_to"], payload, sha)
                    place = {"filename": ARCHIVE.split("/")[1], "offset": str(len(archive)), "length": str(len(one)), "digest": f"sha1:{sha}"}
                    index.append(f"{row['record_id']} {DATE} {json.dumps(place)}\n")
                    archive += one
                    held += len(payload)
                    if held >= target:
                        yield close()
                        held = 0
        if index:
            yield close()

    return run


def write_packages(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    target: int = 8 << 20,
    zip64: bool = True,
) -> None:
    """Write a record per row into packages under ``path``.

    Of rows with equal payloads of ``least`` bytes or more, those with the largest key are responses and the others
    revisits of it; all others are responses. A null payload is empty, a null key is below all others and makes the
    record id of ``null``, and a null url leaves its header out. Rows equal in key and payload are
    alike in kind. An empty table writes no package. Other columns are not read.
    """
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload")
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    # Stored, so that the join deals out both sides itself and can split a payload of many pages.
    last = materialise(rows.groupBy("sha").agg(F.max("key").alias("last")), "payloads")
    seen = F.col("last").isNotNull() & ~F.col("key").eqNullSafe(F.col("last"))
    revisit = seen & (F.length("payload") >= least)

    def record_id(c: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))

    ready = rows.join(last, "sha").select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        record_id("key").alias("record_id"),
        "url",
        F.when(revisit, record_id("last")).alias("refers_to"),
        "payload",
    )
    (
        map_batches(ready, _packages(target, zip64), "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def _open(path: str):
    """A file that can be read by ranges, in a store that Arrow reaches too."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "file://" + path.removeprefix("file:").removeprefix("//")
    store, inner = fs.FileSystem.from_uri(unquote(path))
    return store.open_input_file(inner)


def _reachable(path: str) -> bool:
    try:
        _open(path).close()
    except (OSError, ValueError):  # pa.ArrowInvalid is a ValueError
        return False
    return True


def _table(found: list[tuple[dict[str, str], bytes]]) -> pa.RecordBatch:
    rows = [
        (
            headers["WARC-Record-ID"],
            headers["WARC-Type"],
            headers.get("WARC-Target-URI"),
            headers.get("WARC-Refers-To"),
            headers["WARC-Payload-Digest"].removeprefix("sha1:"),
            block if headers["WARC-Type"] == "response" else None,
        )
        for headers, block in found
    ]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 5 + [pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _places_of(batches):
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
            with _open(path) as file:
                found = places(lambda at, n, f=file: f.read_at(n, at), size)
                while some := list(islice(found, 1 << 16)):
                    columns = [pa.array([path] * len(some)), *(pa.array([x[k] for x in some], pa.int64()) for k in (0, 1))]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "at", "width"])


def _records_at(batches):
    """Rows of (path, at, width), sorted, into records. Neighbouring ranges are read at once, STEP bytes at the most or one record."""
    last, file = None, None
    for batch in batches:
        paths, starts, widths = (batch.column(c).to_pylist() for c in ("path", "at", "width"))
        i = 0
        while i < len(paths):
            if paths[i] != last:
                if file is not None:
                    file.close()
                last, file = paths[i], _open(paths[i])
            j, begin, end = i, starts[i], starts[i]
            while j < len(paths) and paths[j] == last and starts[j] <= end + GAP and (j == i or starts[j] + widths[j] - begin <= STEP):
                end = max(end, starts[j] + widths[j])
                j += 1
            raw = file.read_at(end - begin, begin)
            yield _table([record(raw[at - begin : at - begin + n]) for at, n in zip(starts[i:j], widths[i:j], strict=True)])
            i = j
    if file is not None:
        file.close()


def _whole(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            view = batch.column("content")[i].as_buffer()
            yield _table(list(records(lambda at, n, v=view: v.slice(at, n).to_pybytes(), view.size)))


def read_packages(spark: SparkSession, path: str, stretch: int = 64 << 20) -> DataFrame:
    """The records of all packages under ``path``: RECORDS, a row per record.

    Records of one ``stretch`` of a package are read by one task. Files that are no package are an error. A folder without packages has no
    records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    first = files.select("path").first()
    if first is None or not _reachable(first.path):
        return map_batches(files.select("content"), _whole, RECORDS)
    # Paths and lengths alone: no content is read here.
    named = map_batches(files.select("path", "length"), _places_of, "path string, at bigint, width bigint")
    # The places are few bytes however much they name, so the number of tasks goes by the packages' size, which is told here.
    total = files.agg(F.sum("length")).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // stretch))
    dealt = named.repartition(tasks, "path", F.floor(F.col("at") / stretch)).sortWithinPartitions("path", "at")
    return map_batches(dealt, _records_at, RECORDS)


def resolved(found: DataFrame) -> DataFrame:
    """``found`` (of ``read_packages``) without payloads: ``payload_bytes`` is that of the full payload, which a
    revisit has from the record it refers to (null if that is missing).

    Read back as written: a record id that occurs twice stands for equal payloads.
    """
    rows = found.withColumn("own_bytes", F.length("payload").cast("long")).drop("payload")
    sizes = materialise(
        rows.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("full_id"), F.col("payload_digest").alias("full_digest"))
        .agg(F.max("own_bytes").alias("full_bytes")),
        "payload-sizes",
    )
    same = (F.col("refers_to_id") == F.col("full_id")) & (F.col("payload_digest") == F.col("full_digest"))
    return rows.join(sizes, same, "left").select(
        "record_id",
        "record_type",
        "url",
        "refers_to_id",
        "payload_digest",
        F.coalesce("own_bytes", "full_bytes").alias("payload_bytes"),
    )
