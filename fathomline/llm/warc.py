"""WARC archives of web pages, written and read as streams of chunks.

Between pages and archives stands the chunked record table, record_table(): a payload is a series of rows (record
identifier, chunk number, bytes), cut in the JVM, and never a whole value in Python.  The writer takes these rows in
order, and writer and reader carry the digest on from chunk to chunk, so a record needs the memory of one chunk
however long its payload is.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import bitmap, deleted, id_kind, opened, perhaps, scratch, small_batches, written

CHUNK_BYTES = 1 << 16
#: Equal payloads of fewer bytes than this are all stored.
REVISIT_BYTES = 1000
#: A payload on more than one in so many of the pages that share theirs is joined by broadcast: there are fewer than so many.
HOT_SHARE = 1000
#: Fixed values of the format.
VERSION, DATE = b"WARC/1.1", "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Chunk(NamedTuple):
    """A part of a payload that was read; digest is the SHA-1 of the payload up to and with this chunk."""

    record_id: str
    chunk_no: int
    data: bytes
    digest: str
    last: bool


def chunks(record_id, payload: str, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Encodes and digests a payload slice by slice; an empty one has one empty chunk."""
    running, at, no = hashlib.sha1(), 0, 0
    while True:
        data = payload[at : at + size].encode()
        running.update(data)
        at += size
        last = at >= len(payload)
        yield Chunk(record_id, no, data, running.hexdigest(), last)
        if last:
            return
        no += 1


class _Member:
    """One gzip member of an archive: records can be read alone, as the format wants."""

    def __init__(self, out: BinaryIO):
        self.out, self.packer = out, zlib.compressobj(1, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.out.write(self.packer.compress(data))

    def close(self) -> None:
        self.out.write(self.packer.flush())


class Record:
    """A record that is being written: its header at once, then its payload chunk by chunk.

    size and digest are the full payload's, also of a revisit, whose block is empty.  close() compares them with what
    was written.
    """

    def __init__(self, out: BinaryIO, page_id, url: str | None, refers_to, size: int, digest: str):
        self.size, self.digest, self.done, self.running = size, digest, 0, hashlib.sha1()
        self.revisit = refers_to is not None
        head = {"WARC-Type": "revisit" if self.revisit else "response", "WARC-Record-ID": urn(page_id), "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": size, "Content-Length": 0 if self.revisit else size}
        if url is not None:
            head["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")
        if self.revisit:
            head |= {"WARC-Refers-To": urn(refers_to), "WARC-Profile": PROFILE}
        self.member = _Member(out)
        self.member.write(VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n")

    def write(self, data: bytes) -> None:
        self.running.update(data)
        self.done += len(data)
        self.member.write(data)

    def close(self) -> None:
        if not self.revisit and (self.done, self.running.hexdigest()) != (self.size, self.digest):
            raise ValueError("the chunks of a record aren't its payload")
        self.member.write(b"\r\n\r\n")
        self.member.close()


def write_record(out: BinaryIO, page_id, url: str | None, kind: str, refers_to, size: int, digest: str, data: Iterator[bytes]) -> None:
    """A whole record; kind is response or revisit."""
    record = Record(out, page_id, url, refers_to if kind == "revisit" else None, size, digest)
    for part in data:
        record.write(part)
    record.close()


def read_records(stream: BinaryIO, size: int = CHUNK_BYTES) -> Iterator[tuple[dict[str, str], Iterator[Chunk]]]:
    """Headers of each record and its block as chunks; a block that isn't consumed is skipped."""
    source = io.BufferedReader(gzip.GzipFile(fileobj=stream), size)
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        head: dict[str, str] = {}
        while (line := source.readline()).strip():
            key, _, value = line.decode().partition(":")
            head[key.lower()] = value.strip()
        left = int(head["content-length"])

        def block(left: int = left) -> Iterator[Chunk]:
            running, no, record = hashlib.sha1(), 0, head["warc-record-id"]
            while True:
                data = source.read(min(size, left))
                if left and not data:
                    raise EOFError("the archive ends within a record")
                left -= len(data)
                running.update(data)
                yield Chunk(record, no, data, running.hexdigest(), not left)
                if not left:
                    return
                no += 1

        own = block()
        yield head, own
        for _ in own:
            pass


def urn(page_id) -> str:
    """The record identifier of a page; a page without an id gets a random one."""
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def page_of(record_id: str) -> str | None:
    """The page id in a record identifier, as text."""
    own = record_id.strip("<>")
    return unquote(own.removeprefix("urn:page:")) if own.startswith("urn:page:") else None


def metadata(pages: DataFrame, *, id_col: str, html_col: str) -> DataFrame:
    """(id, digest, size) of each page: the payload stays behind."""
    raw = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast(id_kind(pages, id_col)).alias("id"), F.sha1(raw).alias("digest"), F.length(raw).cast("long").alias("size"))


def responses(pages: DataFrame, *, least: int = REVISIT_BYTES, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(digest, response, n): for each payload of least bytes or more that several pages share, the largest page id.

    Sums by task come first, so one payload on a third of all pages costs a row a task.
    """
    own = metadata(pages, id_col=id_col, html_col=html_col).filter(F.col("size") >= least)
    return own.groupBy("digest").agg(F.max("id").alias("response"), F.count("*").alias("n")).filter("n > 1 and response is not null")


def revisits(pages: DataFrame, shared: DataFrame, *, least: int = REVISIT_BYTES, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, digest, response) of the pages that revisit another one, by joins of metadata alone.

    A payload on more than a thousandth of all its pages' number is one of at most a thousand, so those are broadcast;
    no key of the other join has more rows than that.
    """
    total = shared.agg(F.sum("n")).first()[0] or 0
    own = metadata(pages, id_col=id_col, html_col=html_col).filter(F.col("size") >= least).drop("size")
    many = F.col("n") * HOT_SHARE > total
    hot = F.broadcast(shared.filter(many).select("digest", F.col("response").alias("_hot")))
    met = own.join(hot, "digest", "left")
    found = met.filter("_hot is not null").select("id", "digest", F.col("_hot").alias("response"))
    rest = met.filter("_hot is null").select("id", "digest").join(shared.filter(~many).select("digest", "response"), "digest")
    return found.unionByName(rest).filter(~F.col("id").eqNullSafe(F.col("response"))).distinct()


def record_table(pages: DataFrame, *, least: int = REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table: (record_id, chunk_no, data, last, size, digest, url, refers_to).

    A payload (UTF-8, null: empty) is cut into rows of chunk_bytes bytes as the rows pass; they stay side by side and
    in order, in the task that read the page.  A revisit has one row without data.  Which pages revisit others is found
    on ids and digests; a bitmap of them lets all other pages pass, and another one of the pages that the first lets
    through in vain says for which of the rest the payload has to come along, so payloads are hardly shuffled, and
    never by digest.
    """
    spark, kind = pages.sparkSession, id_kind(pages, id_col)
    shared = written(responses(pages, least=least, id_col=id_col, html_col=html_col), "warc-shared")
    known = written(revisits(pages, shared, least=least, id_col=id_col, html_col=html_col), "warc-revisits")
    raw = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    own = small_batches(pages).select(F.col(id_col).cast(kind).alias("id"), (F.col(url_col) if url_col in pages.columns else F.lit(None)).cast("string").alias("url"), raw.alias("raw"), F.sha1(raw).alias("digest"), F.length(raw).cast("long").alias("size"))
    none = F.lit(None).cast(kind)
    rows = own.withColumn("refers_to", none)
    if known.limit(1).count():
        key, columns = F.xxhash64("id", "digest"), ["id", "url", "raw", "digest", "size"]
        other = known.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "response")
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
        first = written(bitmap(known.select(key.alias("key")), "key"), "bitmap")
        vain = perhaps(own.select("id", "digest", key.alias("key")), "key", first, "perhaps").filter("perhaps").join(other, same, "left_anti")
        second = written(bitmap(vain.select("key").distinct(), "key"), "bitmap")
        marked = perhaps(perhaps(own.withColumn("key", key), "key", first, "perhaps"), "key", second, "needed")
        asked = marked.filter("perhaps").select("id", "url", F.when(F.col("needed"), F.col("raw")).alias("raw"), "digest", "size")
        met = asked.join(other, same, "left").select(*columns, F.col("response").alias("refers_to"))
        rows = marked.filter("not perhaps").select(*columns, none.alias("refers_to")).unionAll(met)
    n = F.when(F.col("refers_to").isNotNull(), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / chunk_bytes))).cast("int")
    cut = rows.select("*", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no"))
    data = F.when(F.col("refers_to").isNull(), F.substring(F.col("raw"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return cut.select(F.col("id").alias("record_id"), "chunk_no", data.alias("data"), (F.col("chunk_no") == F.col("n") - 1).alias("last"), "size", "digest", "url", "refers_to")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of a chunked record table and returns the manifest (archive, n_records) as a table.

    One archive a task, under a name of its own: only what a task that succeeded wrote is in the manifest, so a task
    that is repeated after a loss leaves nothing that is read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = record = None
        name, n = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            for page_id, no, data, last, size, digest, url, to in zip(*batch.columns):
                if out is None:
                    fs, path = opened(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path)
                if no.as_py() == 0:
                    record, n = Record(out, page_id.as_py(), url.as_py(), to.as_py(), size.as_py(), digest.as_py()), n + 1
                if data.is_valid:
                    record.write(data.as_py())
                if last.as_py():
                    record.close()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "n_records"])

    return written(small_batches(records).mapInArrow(write, "archive string, n_records bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, kind: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record of the archives.

    A response's length and digest are those of the payload that was read; they must agree with its headers.  A
    revisit's are its headers', which the writer took from the payload that it leaves out.  kind is the ids' type.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = opened(name)
                rows = []
                with fs.open_input_stream(path) as stream:
                    for head, block in read_records(stream):
                        what, digest, size = head["warc-type"], head["warc-payload-digest"].partition(":")[2], int(head["x-payload-length"])
                        if what == "response":
                            got, end = 0, None
                            for end in block:
                                got += len(end.data)
                            if (got, end.digest) != (size, digest):
                                raise ValueError(f"record {head['warc-record-id']} of {name} is damaged")
                        rows.append((page_of(head["warc-record-id"]), size, digest, what, page_of(head["warc-refers-to"]) if what == "revisit" else None))
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    spark = manifest.sparkSession
    n = max(1, manifest.count())
    found = manifest.select("archive").repartition(min(n, 4 * spark.sparkContext.defaultParallelism if n > 10_000 else n)).mapInArrow(read, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def warc(pages: DataFrame, folder: str | None = None, *, least: int = REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes pages to archives in folder (default: a new one in the shared folder) and reads them back, a row a page.

    A null html is an empty payload, a null url has no target header.  A page without an id has a record under a random
    identifier and a row with a null page_id: a revisit where another page has its payload, else a response.  Repeated
    rows have a record each: of equal payloads, all rows with the largest page_id are responses.  Ids may be whole
    numbers or strings.  An empty table writes no archive and gives an empty result; other columns aren't read.
    Archives in the default folder are deleted once they are read; the result is then a table in the shared folder.
    """
    own = folder or scratch(pages.sparkSession, "warc")
    kind = id_kind(pages, id_col)
    found = read_archives(write_archives(record_table(pages, least=least, id_col=id_col, url_col=url_col, html_col=html_col), own), kind).select(F.col("page_id").cast(pages.schema[id_col].dataType).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(pages.schema[id_col].dataType).alias("refers_to"))
    if folder is None:
        found = written(found, "warc-records")
        deleted(pages.sparkSession, own)
    return found
