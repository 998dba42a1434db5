"""Concatenate-and-cut packing of encoded documents into fixed windows.

Pass 1 encodes every document once and freezes ``(part, local start, ids)``: inside a task the starts are a
running sum.  The totals of the parts (one row per input partition) are prefix-summed into global offsets.
Pass 2 cuts every document at the multiples of the window; no token is shuffled.  Windows that a task sees
whole leave it at once, the others leave as boundary records that are put together by sequence id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import tokens
from .store import freeze, map_batches

WINDOW = 2048
END = 1


def encode_documents(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text",
                     end: int = END) -> DataFrame:
    """Frozen ``(part, doc_id, n, start, ids)`` with ``start`` the tokens before the document in the whole corpus
    and ``ids`` its little-endian uint16 ids, ``end`` appended."""
    path = path or tokens.default_path()
    src = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        enc = tokens.encoder(path)
        for batch in batches:
            texts = batch.column(1)
            for k in range(0, len(texts), 256):
                got = [np.append(x, np.uint16(end)) for x in enc.encode([t or "" for t in texts.slice(k, 256).to_pylist()])]
                n = np.fromiter(map(len, got), np.int64, len(got))
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), batch.column(0).slice(k, 256), pa.array(n), pa.array(start),
                     pa.array([x.astype("<u2").tobytes() for x in got], pa.binary())],
                    names=["part", "doc_id", "n", "local", "ids"])

    local = freeze(map_batches(src, run, f"part int, doc_id {kind}, n bigint, local bigint, ids binary"), "tokens")
    totals = local.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row of 12 bytes per input partition, whatever the partitions hold: always small enough to broadcast.
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return local.join(F.broadcast(base), "part").select("part", "doc_id", "n", (F.col("base") + F.col("local")).alias("start"), "ids")


def pieces(encoded: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut :func:`encode_documents` at multiples of ``window``: one row per piece, ``(doc_id, start, length, doc_tokens,
    sequence_id, offset, ids)`` with ``ids`` as little-endian unsigned 32-bit integers."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                n, at = b.column(1).to_numpy(), b.column(2).to_numpy()
                count = (at + n - 1) // window - at // window + 1
                row = np.repeat(np.arange(len(n)), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                seq = at[row] // window + nth
                low = np.maximum(seq * window, at[row])
                high = np.minimum((seq + 1) * window, at[row] + n[row])
                ids = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in b.column(3).to_pylist()]
                start = low - at[row]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(start), pa.array(high - low), pa.array(n[row]), pa.array(seq), pa.array(low - seq * window),
                     pa.array([ids[r][4 * s:4 * (s + m)] for r, s, m in zip(row, start, high - low)], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return map_batches(encoded.select("doc_id", "n", "start", "ids"), run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def sequences(cut: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """Whole training sequences ``(sequence_id, doc_ids, lengths, ids array<int>)`` from :func:`pieces`.

    A window that one task sees from its first to its last token leaves it directly.  The windows that
    straddle tasks leave as boundary records, at most two a task, which are shuffled and joined by sequence id.
    Only the corpus' last sequence can be short; it is padded with ``pad``.
    """
    kind = cut.schema["doc_id"].dataType.simpleString()
    record = f"sequence_id bigint, offset bigint, doc_ids array<{kind}>, lengths array<bigint>, ids binary"

    def run(batches):
        seq = begin = None
        docs, lens, body, size = [], [], [], 0

        def flush():
            return {"sequence_id": seq, "offset": begin, "doc_ids": docs, "lengths": lens, "ids": b"".join(body)}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if seq != r["sequence_id"] or begin + size != r["offset"]:
                    if seq is not None:
                        out.append(flush())
                    seq, begin, docs, lens, body, size = r["sequence_id"], r["offset"], [], [], [], 0
                docs.append(r["doc_id"])
                lens.append(r["length"])
                body.append(r["ids"])
                size += r["length"]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if seq is not None:
            yield pa.RecordBatch.from_pylist([flush()], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(record))
    parts = freeze(map_batches(cut.select("doc_id", "length", "sequence_id", "offset", "ids"), run, record), "windows")
    whole = F.length("ids") == 4 * window
    joined = (parts.where(~whole).groupBy("sequence_id")
              .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_ids", "lengths", "ids"))).alias("p"))
              .select("sequence_id", F.flatten("p.doc_ids").alias("doc_ids"), F.flatten("p.lengths").alias("lengths"),
                      F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids")))
    every = parts.where(whole).select(*joined.columns).unionByName(joined)

    def unpack(batches):
        for batch in batches:
            flat = [np.frombuffer(x, "<u4").astype(np.int32) for x in batch.column(3).to_pylist()]
            flat = [np.pad(x, (0, window - len(x)), constant_values=pad) for x in flat]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * window, np.concatenate(flat) if flat else np.zeros(0, np.int32))],
                names=["sequence_id", "doc_ids", "lengths", "ids"])

    return map_batches(every, unpack, f"sequence_id bigint, doc_ids array<{kind}>, lengths array<bigint>, ids array<int>")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens; see :func:`pieces`.

    Documents follow one another in the order of the input's partitions.  Null and empty texts hold just the end
    id.  Repeated rows and keys are separate documents, a null key stays null, an empty table gives no piece, and
    columns besides key and text are ignored.  Every sequence but the last is full, so at most ``window - 1`` places of the
    whole corpus are padding.
    """
    return pieces(encode_documents(docs, path, key, text), window)
