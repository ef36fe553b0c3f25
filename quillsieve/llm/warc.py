"""WARC archives: written with an index, read back by coalesced byte ranges of the index."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.common import ArrowBatches, encoded, table
from quillsieve.llm.files import attempt_name, opened
from quillsieve.session import materialise, new_folder

DATE = "1970-01-01T00:00:00Z"
#: Ranges of one file at most this far apart are read at once, up to so many bytes.
GAP_BYTES = 64 * 1024
READ_BYTES = 8 * 1024 * 1024
#: Bytes of an archive that one group of ranges spans at most.
BLOCK_BYTES = 32 * 1024 * 1024
#: Payload bytes handed on at once.
_OUT_BYTES = 16 * 1024 * 1024

# Fixed values of the format.
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(page_id))}>"


def record(page_id: object, url: str | None, payload: bytes, refers_to: object = None, revisit: bool = False, date: str = DATE) -> tuple[bytes, str]:
    """One record as a gzip member of its own, and its payload's digest."""
    digest = base32_sha1(payload)
    block = b"" if revisit else _HTTP % len(payload) + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url and url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("Content-Type", None if revisit else "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(encoded(head) + block + b"\r\n\r\n") + packer.flush(), digest


def parsed(raw: bytes) -> tuple[dict[str, str], bytes | None]:
    """Header fields of a record and its payload, None for a revisit."""
    whole = zlib.decompress(raw, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, None if fields["WARC-Type"] == "revisit" else block.partition(b"\r\n\r\n")[2]


def _index_schema(kind: str) -> str:
    return f"page_id {kind}, url string, file string, offset bigint, length bigint, payload_digest string, record_type string, refers_to {kind}"


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """A record per row in archives below ``folder``; returns their index.

    Of rows with equal payloads of at least ``least_bytes`` the one with the smallest id is a
    response and the others revisit it. Rows that repeat that smallest id are all responses;
    a null id is never the smallest, and rows of a payload that only null ids have are responses.
    A null payload is empty. The index is a table in the shared folder with a row per record;
    an empty table gives an empty one.

    Equal payloads meet by their SHA-256, counted before they are shuffled, and only ids of
    repeated ones are joined back.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("sha", F.sha2("payload", 256))
    repeated = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .select(F.col("sha").alias("same"), "first_id")
    )
    linked = rows.join(materialise(repeated, "repeated"), F.col("sha") == F.col("same"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    linked = linked.select("page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to"))

    def run(batches: ArrowBatches) -> ArrowBatches:
        system, path = opened(folder)
        _, name = attempt_name("pages", ".warc.gz")
        sink, offset = None, 0
        for batch in batches:
            offsets, lengths, digests, kinds = [], [], [], []
            if sink is None and batch.num_rows:
                sink = system.open_output_stream(f"{path}/{name}", compression=None)
            for page_id, url, payload, refers in zip(*(batch.column(i) for i in range(4))):
                refers = refers.as_py()
                raw, digest = record(page_id.as_py(), url.as_py(), payload.as_py(), refers, refers is not None)
                sink.write(raw)
                offsets.append(offset)
                lengths.append(len(raw))
                digests.append(digest)
                kinds.append("response" if refers is None else "revisit")
                offset += len(raw)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([name] * len(kinds), pa.string()),
                    pa.array(offsets, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kinds, pa.string()),
                    batch.column(3),
                ],
                names=["page_id", "url", "file", "offset", "length", "payload_digest", "record_type", "refers_to"],
            )
        if sink is not None:
            sink.close()

    system, path = opened(folder)
    system.create_dir(path)
    return materialise(linked.mapInArrow(run, _index_schema(kind)), "warc-index")


def _ranges(rows: list[dict]) -> list[list[dict]]:
    """Rows in order of file and offset, grouped into reads."""
    reads: list[list[dict]] = []
    for row in rows:
        if reads:
            first, last = reads[-1][0], reads[-1][-1]
            near = row["file"] == last["file"] and row["offset"] - last["offset"] - last["length"] <= GAP_BYTES
            if near and row["offset"] + row["length"] - first["offset"] <= READ_BYTES:
                reads[-1].append(row)
                continue
        reads.append([row])
    return reads


def read_warc(selected: DataFrame, folder: str) -> DataFrame:
    """The records that rows of an index name: page_id, url, record_type, payload, payload_bytes,
    payload_digest, refers_to.

    Payload and payload_bytes are null for revisits. The selection is dealt out by stretches of an
    archive and ordered by offset, and near ranges become one read. A record whose payload or
    header doesn't match the index ends the query.
    """
    kind = selected.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to {kind}"
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]

    def run(batches: ArrowBatches) -> ArrowBatches:
        system, path = opened(folder)
        for batch in batches:
            kinds = [batch.schema.field("page_id").type, pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), batch.schema.field("refers_to").type]
            out, held = [], 0
            for read in _ranges(batch.to_pylist()):
                first, last = read[0], read[-1]
                with system.open_input_file(f"{path}/{first['file']}") as source:
                    raw = source.read_at(last["offset"] + last["length"] - first["offset"], first["offset"])
                for row in read:
                    at = row["offset"] - first["offset"]
                    fields, payload = parsed(raw[at : at + row["length"]])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    wrong = digest != row["payload_digest"] or fields["WARC-Record-ID"] != record_id(row["page_id"])
                    if wrong or payload is not None and base32_sha1(payload) != digest:
                        raise ValueError(f"{row['file']} at {row['offset']} doesn't match its index")
                    size = None if payload is None else len(payload)
                    out.append((row["page_id"], row["url"], fields["WARC-Type"], payload, size, digest, row["refers_to"]))
                    held += size or 0
                    if held > _OUT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    stretch = F.floor(F.col("offset") / BLOCK_BYTES)
    return selected.repartition("file", stretch).sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def payload_figures(records: DataFrame) -> DataFrame:
    """Read records without payloads, revisits with the size of the response they refer to."""
    rows = materialise(records.drop("payload"), "records")
    responses = rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("to"), F.col("payload_digest").alias("same"))
    sizes = responses.agg(F.max("payload_bytes").alias("size"))
    met = rows.join(sizes, (F.col("refers_to") == F.col("to")) & (F.col("payload_digest") == F.col("same")), "left")
    return met.withColumn("payload_bytes", F.coalesce("payload_bytes", "size")).drop("to", "same", "size")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    index = write_warc(table(spark, sf_dir, "pages"), folder)
    found = payload_figures(read_warc(index, folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op10_warc": op10_warc}
ORACLES: dict[str, str] = {}
