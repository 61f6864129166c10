"""WARC archives of pages, and an index of captures in global order.

Writing: each page becomes one WARC 1.1 record, put together as a string column, and each
record one gzip member, so that any of them can be read by its offset and length. Members
are joined to pieces of about `piece_bytes`, which Spark's text writer puts into
files; what it writes behind each piece is an empty gzip member. Files are cut by the
number of pieces, and a long record counts as several, so an archive has at most
`archive_bytes` and one record. Of pages with an equal payload of `least_revisit` bytes or
more only the one with the smallest page_id holds it, the others are revisit records that
name it.

Index: external merge. Each archive that is read back gives a run of its captures, sorted
by URL key, time and page. Runs are cut at splitters and sent front-coded to key ranges.
Each range merges its runs with a loser tree. Ranges follow each other in order, so the
index is sorted as a whole; a URL with very many captures spreads over ranges by time and
page. The first splitters come from a bounded sample; where the table has more ranges than
these can part evenly, each of their ranges is cut again by splitters of its own sample,
drawn and sorted in tasks, so a range stays of one size however large the table is.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import pick, stored
from jobtide.llm.merge import deal, front_code, front_decode, merge_runs
from jobtide.session import shared_folder

END = "\r\n"
RECORD_END = b"\r\n\r\n"
NOTHING = gzip.compress(b"", mtime=0)  # a gzip member without content
UNZIP_BYTES = 1 << 14
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = re.compile(rb"<urn:page:(-?\d*)>")


@dataclass(frozen=True)
class Settings:
    """Parameters of archives and index."""

    least_revisit: int = 100
    archive_bytes: int = 24 << 20  # bytes of an archive's records before gzip, at most one record more
    piece_bytes: int = 1 << 20  # records that are written as one row
    range_captures: int = 20_000  # captures that one key range merges
    sample: int = 20_000  # pages that the first splitters are drawn from, at most
    drawn: int = 10  # pages of a sample for each splitter


def capture_time(page_id: str = "page_id") -> Column:
    """Time of a capture where the table has none: its page_id in seconds from the start of 2024."""
    seconds = F.lit(1_704_067_200) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1 << 31))
    return F.timestamp_seconds(seconds)


def url_key(url: str) -> bytes:
    """A URL's sort key: host labels from the right, then path and query, in lower case."""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower().encode("utf-8", "surrogatepass")
    labels = host.removeprefix("www.").split(".")[::-1]
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    place = ",".join(labels) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{place}){path}".lower().encode("utf-8", "surrogatepass")


def capture_key(url: str, time: str, page_id: int | None) -> bytes:
    """Sort key of a capture: URL key, time, page; pages without an id come last."""
    page = b"\xff" * 9 if page_id is None else b"\x00" + ((page_id + 2**63) % 2**64).to_bytes(8, "big")
    return url_key(url).replace(b"\0", b"") + b"\0" + time.encode() + page


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, bytes, digest); a null payload is empty."""
    plain = pick(pages, page_id="long", url="string", html="string")
    html = F.coalesce("html", F.lit(""))
    return plain.select(
        "page_id",
        F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.lit("urn:none")).alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha2(html, 256).alias("digest"),
    )


def originals(hashed: DataFrame, settings: Settings) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another one."""
    small = hashed.where(F.col("bytes") >= settings.least_revisit).select("page_id", "digest")
    # A row for each digest and task at most goes through the shuffle; written, so that the
    # join below shuffles both sides and a payload with very many copies can be split.
    first = stored(
        small.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 and refers_to is not null")
        .select("digest", "refers_to"),
        "first-captures",
    )
    return (
        small.join(first, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def record(refers_to: Column, time: Column) -> Column:
    """The text of a page's record without the two line ends behind it."""
    revisit = refers_to.isNotNull()
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("html")))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{END}WARC-Record-ID: <urn:page:"),
        name,
        F.lit(f">{END}WARC-Target-URI: "),
        F.col("url"),
        F.lit(f"{END}WARC-Date: "),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{END}WARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{END}WARC-Profile: {PROFILE}{END}WARC-Refers-To: <urn:page:"),
                refers_to.cast("string"),
                F.lit(">"),
            ),
        ).otherwise(""),
        F.lit(f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END + END),
        block,
    )


def write_archives(pages: DataFrame, folder: str, settings: Settings = Settings()) -> None:
    """Write one record for each row of `pages` (page_id, url, html) to archives in `folder`.

    Null payloads are empty, null URLs `urn:none`. Rows with an equal page_id and payload
    are the same capture and of one type. A page without an id revisits the smallest id
    among its copies, if there is one. An empty table writes no record. Other columns are
    left out.
    """
    hashed = digests(pages)
    revisits = originals(hashed, settings).withColumnsRenamed({"page_id": "p", "digest": "d"})
    joined = hashed.join(
        revisits, hashed["page_id"].eqNullSafe(revisits["p"]) & (hashed["digest"] == revisits["d"]), "left"
    )
    most = max(1, settings.archive_bytes // settings.piece_bytes)
    pieces = joined.select(record(F.col("refers_to"), capture_time()).alias("value")).mapInArrow(
        lambda batches: zipped(batches, settings.piece_bytes, most), "value binary"
    )
    (
        # The bytes stay as they are; the text writer does not look into them.
        pieces.select(F.col("value").cast("string").alias("value"))
        .write.mode("overwrite")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", NOTHING.decode("latin-1"))
        .option("maxRecordsPerFile", most)
        .text(folder)
    )


def zipped(batches: Iterator[pa.RecordBatch], piece_bytes: int, most: int) -> Iterator[pa.RecordBatch]:
    """Records as gzip members, joined to pieces; empty rows behind a piece make up for its length, `most` at most."""

    def rows(members: list[bytes], size: int) -> pa.RecordBatch:
        more = min(most, -(-size // piece_bytes)) - 1
        return pa.RecordBatch.from_arrays([pa.array([b"".join(members), *[b""] * more], pa.binary())], ["value"])

    members, size = [], 0
    for batch in batches:
        for value in batch.column(0):
            raw = value.as_py().encode("utf-8", "surrogatepass") + RECORD_END
            if members and size + len(raw) > piece_bytes:
                yield rows(members, size)
                members, size = [], 0
            members.append(gzip.compress(raw, 6, mtime=0))
            size += len(raw)
    if members:
        yield rows(members, size)


def members(content: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, unzipped bytes) of each gzip member that is not empty."""
    at = 0
    while at < len(content):
        start, unzip, parts = at, zlib.decompressobj(31), []
        while not unzip.eof:
            block = content[at : at + UNZIP_BYTES]
            if not block:
                raise ValueError(f"member at byte {start} is cut off")
            try:
                parts.append(unzip.decompress(block))
            except zlib.error as damage:
                raise ValueError(f"member at byte {start} is damaged") from damage
            at += len(block) - len(unzip.unused_data)
        if any(parts):
            yield start, at - start, b"".join(parts)


def read_records(file: io.BufferedIOBase) -> Iterator[tuple[int, int, dict[bytes, bytes], bytes]]:
    """(offset, length, header, block) of each record of an open archive; header names in lower case."""
    at = 0
    while True:
        line = file.readline()
        if not line:
            return
        if line == b"\r\n":  # between records
            at += 2
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}: {line[:40]!r}")
        size = len(line)
        header: dict[bytes, bytes] = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            size += len(line)
            key, _, value = line.partition(b":")
            header[key.strip().lower()] = value.strip()
        size += len(line)
        length = int(header[b"content-length"])
        block = file.read(length)
        if len(block) < length:
            raise ValueError(f"record at byte {at} is cut off")
        yield at, size + length, header, block
        at += size + length


FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def capture(header: dict[bytes, bytes], block: bytes) -> tuple[bytes, tuple]:
    """Sort key and fields of a record; a response's payload is hashed, not taken at its word."""
    page = PAGE.fullmatch(header[b"warc-record-id"])[1]
    page_id = int(page) if page else None
    kind = header[b"warc-type"].decode()
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = header[b"warc-payload-digest"].decode().removeprefix("sha256:")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    refers = None
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        if found != digest or size != len(payload):
            raise ValueError(f"payload of page {page_id} is damaged")
    else:
        refers = int(PAGE.fullmatch(header[b"warc-refers-to"])[1])
    key = capture_key(
        header[b"warc-target-uri"].decode("utf-8", "surrogateescape"), header[b"warc-date"].decode(), page_id
    )
    return key, (page_id, size, digest, kind, refers)


def sampled_keys(plain: DataFrame, share: float) -> DataFrame:
    """(url, t, page_id) of a share of the pages, chosen by hash."""
    chosen = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(share * (1 << 30))
    return (
        digests(plain.withColumn("html", F.lit(None).cast("string")))
        .where(chosen)
        .select("url", F.date_format(capture_time(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), "page_id")
    )


def even_cuts(keys: list[bytes], parts: int) -> list[bytes]:
    """Keys that part the sorted `keys` into `parts` even ranges; fewer if keys repeat."""
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def splitters(pages: DataFrame, settings: Settings) -> tuple[list[bytes], DataFrame | None, int]:
    """Keys that part the captures into ranges, and what cuts these ranges again.

    The first keys come from at most `sample` pages. If they are too few for ranges of `range_captures`,
    the second result is (part, cuts), with at most one row for each first range, from a sample that
    grows with the table and stays in tasks; the third is the most ranges that a first range is cut into.
    """
    plain = pick(pages, page_id="long", url="string")
    n = plain.count()
    parts = n // settings.range_captures + 1
    if parts == 1:
        return [], None, 1
    share = min(1.0, 1.1 * settings.sample / n)
    keys = sorted(capture_key(*r) for r in sampled_keys(plain, share).limit(settings.sample).collect())
    if parts * settings.drawn <= settings.sample:
        return even_cuts(keys, parts), None, 1
    first = even_cuts(keys, max(2, settings.sample // settings.drawn))
    again = -(-parts // (len(first) + 1))
    if again == 1:
        return first, None, 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [capture_key(*row) for row in zip(*(column.to_pylist() for column in batch.columns))]
            where = [bisect_right(first, key) for key in own]
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(own, pa.binary())], ["part", "key"])

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        own = even_cuts(sorted(map(bytes, frame["key"])), again)
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "cuts": [own]})

    share = min(1.0, settings.drawn / settings.range_captures)
    # About `drawn` keys for each range of `range_captures`.
    keyed = sampled_keys(plain, share).mapInArrow(placed, "part long, key binary")
    return first, keyed.groupBy("part").applyInPandas(cut, "part long, cuts array<binary>"), again


def coded_runs(part_of, keys: list[bytes], columns: list[list], name: str) -> Iterator[pa.RecordBatch]:
    """A sorted run in pieces, one for each range that `part_of` gives its keys, front-coded."""
    where = np.array([part_of(key) for key in keys], np.int64)
    for part in np.unique(where).tolist():
        begin, end = np.searchsorted(where, [part, part + 1]).tolist()
        prefixes, rests = front_code(keys[begin:end])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int64()),
                pa.array([name], pa.string()),
                pa.array([prefixes], pa.list_(pa.int32())),
                pa.array([rests], pa.list_(pa.binary())),
                *[
                    pa.array([column[begin:end]], pa.list_(pa.int64() if kind == "long" else pa.string()))
                    for column, kind in zip(columns, KINDS)
                ],
            ],
            ["part", "run", "prefixes", "rests", *NAMES],
        )


def index_archives(files: DataFrame, cuts: list[bytes], again: DataFrame | None = None, most: int = 1) -> DataFrame:
    """The captures of archives (path, content), merged into global order.

    `cuts` part the captures into ranges; `again` (part, cuts) parts these once more, into at most `most`.
    Columns: part and place, the capture's position; url_key; captured_at; first_of_url,
    whether the capture before has another URL; the fields of the record; archive, and offset
    and length of the record's gzip member in it. No archives give no rows.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name = path.as_py()
                rows = []
                for offset, length, raw in members(memoryview(content.as_buffer())):
                    for _, _, header, block in read_records(io.BytesIO(raw)):
                        key, fields = capture(header, block)
                        rows.append((key, (*fields, name.rsplit("/", 1)[-1], offset, length)))
                rows.sort(key=lambda r: r[0])
                columns = [list(column) for column in zip(*(fields for _, fields in rows))]
                yield from coded_runs(lambda key: bisect_right(cuts, key), [k for k, _ in rows], columns, name)

    def cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = [key for key, _ in front_decode(row["prefixes"], row["rests"])]
                own, first = row["cuts"] or [], row["part"] * most
                part_of = lambda key: first + bisect_right(own, key)  # noqa: B023, E731
                yield from coded_runs(part_of, keys, [row[name] for name in NAMES], row["run"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("run", kind="stable")
        sizes = frame["prefixes"].map(len).to_numpy()
        order, keys, same = [], [], []
        coded = [front_decode(p.tolist(), r) for p, r in zip(frame["prefixes"], frame["rests"])]
        for run, key, shared in merge_runs(coded):
            order.append(run)
            keys.append(key)
            same.append(shared)
        runs_of = np.array(order)
        at = (np.cumsum(sizes) - sizes)[runs_of] + deal(runs_of, len(sizes))
        urls = [k.index(b"\0") for k in keys]
        out = pd.DataFrame(
            {
                "part": frame["part"].iloc[0],
                "place": np.arange(len(keys)),
                "url_key": [k[:n].decode("utf-8", "replace") for k, n in zip(keys, urls)],
                "captured_at": [k[n + 1 : n + 21].decode() for k, n in zip(keys, urls)],
                "first_of_url": [s <= n for s, n in zip(same, urls)],
            }
        )
        for name in NAMES:
            flat = [v for column in frame[name] for v in column]
            out[name] = pd.Series([flat[i] for i in at.tolist()], dtype=object)
        return out

    lists = ", ".join(f"{n} array<{k}>" for n, k in zip(NAMES, KINDS))
    schema = f"part long, run string, prefixes array<int>, rests array<binary>, {lists}"
    coded = files.select("path", "content").mapInArrow(runs, schema)
    if again is not None:
        coded = coded.join(again, "part", "left").mapInArrow(cut_again, schema)
    return coded.groupBy("part").applyInPandas(
        merge,
        f"part long, place long, url_key string, captured_at string, first_of_url boolean, {FIELDS}",
    )


KINDS = [f.split()[1] for f in FIELDS.split(", ")]


def archive_and_index(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write `pages` to archives in the shared folder, read them back, and return their index."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "archives")
    write_archives(pages, folder, settings)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return index_archives(files, *splitters(pages, settings))
