"""Substring dedup: words of long passages that an earlier document has as well.

A repeated passage of ``WINDOW`` = 13 words is found by difference-cover anchors. Positions of a
document are taken modulo ``PERIOD`` = 7; the cover {0, 1, 3} has every difference modulo 7, so for
any two occurrences of the same 13 words some offset below 7 puts both on cover positions. Only the
7-word windows that begin there are hashed and matched (3 in 7), and every match of 13 words
contains one such pair. Around the anchors that several documents share, the match is extended:
there, and only there, whole 13-word windows are hashed (128 bits) and matched.

Texts are written once, in chunks, to the shared folder. What is shuffled are hashes with a chunk's
number: within a chunk an anchor or window is one row whatever the number of its copies, with the
smallest and the largest doc_id that have it; so a passage that a third of all documents share
gives one row per chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import documents, scratch, stage, task_count
from tillwise.llm.token_files import filesystem
from tillwise.llm.words import Words

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text in a chunk (one longer document is a chunk of its own).
CHUNK_BYTES = 6 << 20
#: Stands for a missing doc_id: no document is smaller by it.
NO_ID = np.iinfo("int64").max
#: Kinds of rows between the steps.
FOUND, CHUNK, GHOST = 0, 1, 2


def _extremes(keys: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys with the smallest and largest id of each."""
    order = np.lexsort(keys[::-1])
    keys, ids = [k[order] for k in keys], ids[order]
    if not len(ids):
        return keys, ids, ids
    new = np.zeros(len(ids), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def _anchor_rows(folder: str):
    schema = pa.schema(
        [(n, pa.int64()) for n in ("hash", "chunk", "low", "high")] + [("kind", pa.int32())]
    )

    def rows(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        store, root = filesystem(folder)

        def finish(ids, texts):
            chunk = (part << 32) + number
            table = pa.table({"doc_id": pa.array(ids, "int64"), "text": pa.array(texts, pa.large_binary())})
            path = f"{root}/chunk-{chunk}.arrow"
            own = f"{path}.{TaskContext.get().taskAttemptId()}"  # moved when complete
            with store.open_output_stream(own) as out:
                with pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
                    file.write_table(table)
            store.move(own, path)
            words = Words(texts)
            at = np.flatnonzero(np.isin(words.place % PERIOD, COVER) & words.whole(ANCHOR))
            found = words.windows(words.hashes(0), ANCHOR, 0)[at].view("int64") if len(at) else np.empty(0, "int64")
            id_of = np.array([NO_ID if i is None else i for i in ids], dtype="int64")
            (hashes,), low, high = _extremes([found], id_of[words.doc[at]])
            mark = np.array([chunk], "int64")
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[hashes, mark * 0x9E3779B9]),
                    pa.array(np.full(n + 1, chunk)),
                    pa.array(np.r_[low, 0]),
                    pa.array(np.r_[high, 0]),
                    pa.array(np.r_[np.full(n, FOUND), CHUNK].astype("int32")),
                ],
                schema=schema,
            )

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids.append(doc_id.as_py())
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield from finish(ids, texts)
                    ids, texts, size = [], [], 0
                    number += 1
        if ids:
            yield from finish(ids, texts)

    return rows


def _sweep(keys: list[str], emit):
    """Walk rows sorted by ``keys`` and ``low``: ``emit(columns, least, most)`` gets whole batches
    with the smallest low and largest high of each row's group, and says which rows go on.

    A group that goes on in the next batch leaves one ghost row with its extremes, or its rows
    while they are undecided, so a group of any size takes one batch of memory.
    """

    def walk(batches):
        names, rest = None, None
        for batch in batches:
            names = names or batch.schema.names
            new = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            rest = new if rest is None else {n: np.concatenate([rest[n], new[n]]) for n in names}
            if len(rest["low"]):
                rest = yield from step(rest, False)
        if rest is not None and len(rest["low"]):
            yield from step(rest, True)

    def step(rows, final):
        new = np.zeros(len(rows["low"]), dtype=bool)
        new[0] = True
        for k in keys:
            new[1:] |= rows[k][1:] != rows[k][:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        least = np.minimum.reduceat(rows["low"], first)
        most = np.maximum.reduceat(rows["high"], first)
        decided = least < most
        go = decided[group] | (rows["kind"] == CHUNK)
        if final or decided[-1]:
            out = emit(rows, least[group], go & (rows["kind"] != GHOST))
            kept = {n: v[first[-1] : first[-1] + 1].copy() for n, v in rows.items()}
            kept["kind"][:], kept["low"][:], kept["high"][:] = GHOST, least[-1], most[-1]
        else:
            inner = go & (rows["kind"] != GHOST)
            chunk_mark = rows["kind"][first[-1] :] == CHUNK
            inner[first[-1] :] = chunk_mark
            out = emit(rows, least[group], inner)
            kept = {n: v[first[-1] :][~chunk_mark] for n, v in rows.items()}
        if out.num_rows:
            yield out
        return kept

    return walk


def _emit_shared(rows, least, go) -> pa.RecordBatch:
    hashes = pa.array(rows["hash"][go], mask=rows["kind"][go] == CHUNK)
    return pa.RecordBatch.from_arrays([pa.array(rows["chunk"][go]), hashes], ["chunk", "hash"])


def _emit_later(rows, least, go) -> pa.RecordBatch:
    go = go & (rows["high"] > least)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["chunk"][go]), pa.array(rows["w1"][go]), pa.array(rows["w2"][go]), pa.array(least[go])],
        ["chunk", "w1", "w2", "least"],
    )


def _read_chunk(folder: str, chunk: int):
    """doc_ids (missing ones as NO_ID), which are missing, and texts as bytes."""
    store, root = filesystem(folder)
    with store.open_input_file(f"{root}/chunk-{chunk}.arrow") as source:
        table = pa.ipc.open_file(source).read_all()
    ids = table["doc_id"].combine_chunks()
    return ids.fill_null(NO_ID).to_numpy(), ids, table["text"].to_pylist()


def _window_rows(folder: str):
    def rows(shared: pa.Table) -> pa.Table:
        chunk = shared["chunk"][0].as_py()
        hashes = np.sort(shared["hash"].drop_null().to_numpy())
        ids, _, texts = _read_chunk(folder, chunk) if len(hashes) else (np.empty(0, "int64"), None, [])
        words = Words(texts)
        one = words.hashes(0)
        anchors = np.zeros(len(one) + 1, dtype=np.int64)
        if len(one) >= WINDOW:
            at = np.flatnonzero(np.isin(words.place % PERIOD, COVER) & words.whole(ANCHOR))
            found = words.windows(one, ANCHOR, 0)[at].view("int64")
            near = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            anchors[1:][at[hashes[near] == found]] = 1
        through = np.cumsum(anchors)
        # A window begins at most PERIOD - 1 words before an anchor that it contains.
        begin = np.flatnonzero(words.whole(WINDOW))
        begin = begin[through[begin + PERIOD] > through[begin]]
        both = [words.windows(words.hashes(w), WINDOW, w)[begin].view("int64") if len(begin) else np.empty(0, "int64") for w in (0, 1)]
        (w1, w2), low, high = _extremes(both, ids[words.doc[begin]])
        return pa.table(
            {"w1": w1, "w2": w2, "chunk": np.full(len(w1), chunk, "int64"), "low": low, "high": high, "kind": np.zeros(len(w1), "int32")}
        )

    return rows


def _kept_rows(folder: str):
    def rows(later: pa.Table) -> pa.Table:
        ids, id_column, texts = _read_chunk(folder, later["chunk"][0].as_py())
        later = later.drop_null()
        words = Words(texts)
        gone = np.zeros(len(words.first) + 1, dtype=np.int64)
        if later.num_rows:
            order = np.argsort(later["w1"].to_numpy())
            w1, w2, least = (later[n].to_numpy()[order] for n in ("w1", "w2", "least"))
            begin = np.flatnonzero(words.whole(WINDOW))
            own = [words.windows(words.hashes(w), WINDOW, w)[begin].view("int64") for w in (0, 1)]
            at, hit = np.searchsorted(w1, own[0]), np.zeros(len(begin), dtype=bool)
            live = np.arange(len(begin))
            while len(live):  # windows that agree in the first hash stand side by side
                live = live[at[live] < len(w1)]
                live = live[w1[at[live]] == own[0][live]]
                hit[live] |= (w2[at[live]] == own[1][live]) & (least[at[live]] < ids[words.doc[begin[live]]])
                at[live] += 1
            np.add.at(gone, begin[hit], 1)
            np.add.at(gone, begin[hit] + WINDOW, -1)
        removed = np.cumsum(gone[:-1]) > 0
        n_removed = np.bincount(words.doc[removed], minlength=len(texts))
        kept = []
        for i, text in enumerate(texts):
            own_words = text.split()  # bytes split at ASCII white space only
            if n_removed[i]:
                gone_here = removed[words.head[i] : words.head[i] + words.counts[i]]
                own_words = [w for w, r in zip(own_words, gone_here.tolist()) if not r]
            kept.append(b" ".join(own_words).decode())
        return pa.table(
            {"doc_id": id_column, "n_words": words.counts.astype("int64"), "n_removed": n_removed.astype("int64"), "kept_text": pa.array(kept, pa.string())}
        )

    return rows


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` of every row of ``docs``.

    Removed are the words covered by a window whose words also begin in a document of smaller
    doc_id; windows are judged on the input. Null texts have no words. A row without doc_id counts
    as larger than all others and is smaller than none; rows of equal id never remove each other's
    words.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "substring-chunks")
    store, root = filesystem(folder)
    store.create_dir(root)
    # Chunks are many and their work is far larger than their rows: keep tasks many, too.
    tasks = 4 * task_count(spark)

    anchors = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _anchor_rows(folder), "hash long, chunk long, low long, high long, kind int"
    )
    shared = stage(
        anchors.repartition(task_count(spark), "hash")
        .sortWithinPartitions("hash", "low")
        .mapInArrow(_sweep(["hash"], _emit_shared), "chunk long, hash long"),
        "shared-anchors",
    )
    later = (
        shared.repartition(tasks, "chunk")
        .groupBy("chunk")
        .applyInArrow(_window_rows(folder), "w1 long, w2 long, chunk long, low long, high long, kind int")
        .repartition(task_count(spark), "w1", "w2")
        .sortWithinPartitions("w1", "w2", "low")
        .mapInArrow(_sweep(["w1", "w2"], _emit_later), "chunk long, w1 long, w2 long, least long")
    )
    none = F.lit(None).cast("long")
    chunks = shared.where("hash IS NULL").select(
        "chunk", none.alias("w1"), none.alias("w2"), none.alias("least")
    )
    return (
        later.union(chunks)
        .repartition(tasks, "chunk")
        .groupBy("chunk")
        .applyInArrow(_kept_rows(folder), "doc_id long, n_words long, n_removed long, kept_text string")
    )


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document once words of windows met in an earlier one are gone."""
    return dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[]
    ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
begins AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM words),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS run FROM begins),
firsts AS (SELECT run, min(doc_id) AS least FROM windows GROUP BY run),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN firsts USING (run) WHERE least < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1),
    lambda i: NOT list_contains(coalesce(gone, []::BIGINT[]), i)), lambda i: w[i]), ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""
