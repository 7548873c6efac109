"""Token ids on disk: Arrow files of equal-length sequences with masks, and their index.

``tokens-N.arrow`` has record batches of ``ids`` and ``mask``, both fixed-size lists of
``sequence_length``; a memory-mapped reader reaches sequence ``i`` of a file without copying
(batch ``i // BATCH_ROWS``, row ``i % BATCH_ROWS``). The mask is false on the padding that fills a
file's last sequence. ``index-N.arrow`` has ``doc_id``, ``start`` (ids before it in the file) and
``n_tokens``. Files follow each other in ascending doc_id order.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import documents, scratch
from tillwise.llm.tokens import encoder

SEQUENCE_LENGTH = 2048
#: Sequences in a record batch.
BATCH_ROWS = 64
END_ID = 0


def filesystem(folder: str):
    """The file system of a URI or plain path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


def _writer(folder: str, tokenizer: str, spaced: bool, end_id: int, length: int):
    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = filesystem(folder)
        encode = encoder(tokenizer, spaced)
        kind = pa.from_numpy_dtype(encode.type)
        schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        mine = uuid.uuid4().hex  # a retried task never meets a half-written file
        names = [f"tokens-{part:06d}.arrow", f"index-{part:06d}.arrow"]
        block = BATCH_ROWS * length
        end = np.array([end_id], dtype=encode.type)
        n_docs = n_tokens = 0
        with (
            store.open_output_stream(f"{root}/{mine}-{names[0]}") as tokens_out,
            store.open_output_stream(f"{root}/{mine}-{names[1]}") as index_out,
            pa.ipc.new_file(tokens_out, schema) as tokens_file,
            pa.ipc.new_file(index_out, index_schema) as index_file,
        ):
            waiting, held = [], 0

            def flush(final: bool) -> None:
                nonlocal waiting, held
                ids = np.concatenate(waiting) if waiting else np.empty(0, encode.type)
                cut = len(ids) if final else len(ids) // block * block
                for low in range(0, cut, block):
                    chunk = ids[low : min(low + block, cut)]
                    rows = -(-len(chunk) // length)
                    padded = np.zeros(rows * length, encode.type)
                    padded[: len(chunk)] = chunk
                    columns = (padded, np.arange(rows * length) < len(chunk))
                    tokens_file.write_batch(
                        pa.record_batch(
                            [pa.FixedSizeListArray.from_arrays(pa.array(c), length) for c in columns],
                            schema=schema,
                        )
                    )
                waiting, held = [ids[cut:]], len(ids) - cut

            for batch in batches:
                doc_ids, counts = batch.column("doc_id"), []
                first = n_tokens
                for ids in encode.encode_column(batch.column("text")):
                    waiting += [ids, end]
                    counts.append(len(ids) + 1)
                    held += counts[-1]
                    if held >= block:
                        flush(False)
                starts = first + np.cumsum([0, *counts])
                n_docs, n_tokens = n_docs + len(counts), int(starts[-1])
                index_file.write_batch(
                    pa.record_batch([doc_ids, pa.array(starts[:-1]), pa.array(counts, "int64")], schema=index_schema)
                )
            flush(True)
        for name in names:
            store.move(f"{root}/{mine}-{name}", f"{root}/{name}")
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "n_docs": [n_docs], "n_tokens": [n_tokens], "tokens_file": [names[0]], "index_file": [names[1]]},
            schema=pa.schema(
                [("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("tokens_file", pa.string()), ("index_file", pa.string())]
            ),
        )

    return write


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    spaced: bool = True,
    end_id: int = END_ID,
    sequence_length: int = SEQUENCE_LENGTH,
) -> list[dict]:
    """Write ``docs`` (``doc_id``, ``text``) and return one entry per file, in order.

    Entries name the files and have ``start``: the ids in all files before. Null texts are empty, an
    empty table gives files without documents or none;
    documents without doc_id come first, equal ids are ordered by text. A task holds one record
    batch of sequences and one Arrow batch of texts at a time.
    """
    store, root = filesystem(folder)
    store.create_dir(root)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    files = ordered.mapInArrow(
        _writer(folder, tokenizer, spaced, end_id, sequence_length),
        "part int, n_docs long, n_tokens long, tokens_file string, index_file string",
    ).collect()  # one row per file
    entries, start = [], 0
    for row in sorted(files, key=lambda r: r.part):
        entries.append(row.asDict() | {"start": start})
        start += row.n_tokens
    return entries


def _ids_between(reader, low: int, high: int, kept: dict) -> np.ndarray:
    """Ids ``low`` to ``high`` of a token file; views of its buffers where one batch has them all."""
    length = reader.schema.field("ids").type.list_size
    block, parts = BATCH_ROWS * length, []
    for number in range(low // block, -(-high // block)):
        if number not in kept:
            kept.clear()
            kept[number] = reader.get_batch(number).column("ids").flatten().to_numpy()
        parts.append(kept[number][max(0, low - number * block) : high - number * block])
    return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, "uint16")])


def open_file(store, path: str):
    """Memory-mapped where the file is on a mounted disk."""
    from pyarrow import fs

    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def _reader(folder: str):
    def read(batches):
        store, root = filesystem(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                tokens = pa.ipc.open_file(open_file(store, f"{root}/{entry['tokens_file']}"))
                index = pa.ipc.open_file(open_file(store, f"{root}/{entry['index_file']}"))
                kept: dict = {}
                for number in range(index.num_record_batches):
                    docs = index.get_batch(number)
                    starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    sums = [
                        zlib.crc32(_ids_between(tokens, s, s + n, kept).astype("<u4").tobytes())
                        for s, n in zip(starts.tolist(), counts.tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column("doc_id"), pa.array(starts + entry["start"]), docs.column("n_tokens"), pa.array(sums, "int64")],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_documents(spark, folder: str, entries: list[dict]) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    if not entries:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    listed = spark.createDataFrame(
        [(e["tokens_file"], e["index_file"], e["start"]) for e in entries],
        "tokens_file string, index_file string, start long",
    )
    return listed.repartition(len(entries)).mapInArrow(
        _reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files; a null text has the end id alone."""
    import public_tokenizers

    folder = scratch(spark, "token-files")
    entries = write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, folder, entries)
