"""Token-id sequences in training order, as fixed-stride binary shards.

Documents are tokenised and strung together, task by task, into sequences of equal length.
A keyed Feistel permutation with cycle-walking gives each of the ``n`` sequences a slot in
0..n-1 without a sort or a stored permutation; slots are cut into ranges, and each range is
one shard file in which slot ``s`` stands at byte ``(s - first slot) * stride``. A reader
resumes from any slot with one seek; a shard written again by a retried task is the same.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from docnorm.llm.common import table, write_table
from docnorm.llm.tokens import VOCABULARY, encoder
from docnorm.session import table_path

LENGTH, SHARD_SEQUENCES, TASK_SHARDS, ROUNDS = 2048, 1024, 8, 6
SEQUENCES = "part int, nth long, n_tokens int, doc_ids array<long>, ids binary"


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    """Round function: a 64-bit finaliser of half and round key."""
    x = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: str) -> np.ndarray:
    """Slot in 0..n-1 of each index: a bijection fixed by ``key``.

    The Feistel network permutes the next power of four; what falls beyond ``n`` is
    permuted again until it lands inside (fewer than four rounds on average).
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    bits, low = np.uint64(half), np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "big")) for r in range(ROUNDS)]
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> bits, out[walking] & low
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & low)
        out[walking] = left << bits | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def token_sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end_id: int = 0) -> DataFrame:
    """Sequences of ``length`` ids from documents (doc_id, text), strung together per task.

    Every document ends with ``end_id`` (null or empty text: that id alone). The last
    sequence of a task is filled up with it. ``doc_ids`` lists the documents in a sequence
    (null ids stay null); ``ids`` holds the token ids.
    """

    def sequences(batches):
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        ids_of, end = encoder(vocabulary, "H").ids, np.array([end_id], "<u2").tobytes()
        held, ids, step = [], bytearray(), 2 * length

        def rows(last: bool):
            nonlocal nth, held, ids
            out, at = [], 0
            begins = 0
            while len(ids) - at >= step or last and at < len(ids):
                chunk = bytes(ids[at:at + step])
                here = []
                while begins < len(held) and held[begins][1] < at + step:
                    here.append(held[begins][0])
                    begins += 1
                if begins and held[begins - 1][2] > at + step:  # goes on in the next sequence
                    begins -= 1
                filled = chunk + end * ((step - len(chunk)) // 2)
                out.append((part, nth, len(chunk) // 2, here, filled))
                nth, at = nth + 1, at + step
            del ids[:at]
            held = [(d, max(0, a - at), b - at) for d, a, b in held[begins:]]
            return out

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()), strict=True)],
                names=["part", "nth", "n_tokens", "doc_ids", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                for doc_id, own in zip(some.column(0).to_pylist(), map(ids_of, some.column(1).to_pylist()), strict=True):
                    held.append((doc_id, len(ids), len(ids) + len(own) + 2))
                    ids += own + end
                if out := rows(False):
                    yield batch_of(out)
        if out := rows(True):
            yield batch_of(out)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sequences, SEQUENCES)


def in_training_order(sequences: DataFrame, n: int, key: str, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """slot, shard, n_tokens, doc_ids and the compressed ids of a written table of ``n`` sequences."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sequences.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per task
    # written, so that its size is known when the join is planned and the sequences stay put
    offsets = write_table(counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")

    def place(batches):
        press = zstandard.ZstdCompressor(9).compress
        for batch in batches:
            slots = permute(batch.column("index").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(slots // shard_sequences), batch.column("n_tokens"), batch.column("doc_ids"),
                 pa.array([press(ids) for ids in batch.column("ids").to_pylist()], pa.binary())],
                names=["slot", "shard", "n_tokens", "doc_ids", "packed"])

    return (sequences.join(offsets, "part").select((F.col("offset") + F.col("nth")).alias("index"), "n_tokens", "doc_ids", "ids")
            .mapInArrow(place, "slot long, shard long, n_tokens int, doc_ids array<long>, packed binary"))


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, given as a path or an address."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_shards(ordered: DataFrame, n: int, folder: str, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """Write each shard of ``n`` sequences as one file of ``folder`` (any file system pyarrow opens); returns
    slot, shard, byte_offset, n_tokens, doc_ids and crc32 of the record, per sequence.

    A task takes a range of TASK_SHARDS shards, so the number of tasks follows the data. A
    shard is written under a name of the task's own and renamed when whole; where a task that
    was repeated finds its shard, which holds the same bytes, it leaves it.
    """
    stride = 2 * length
    tasks = max(1, -(-n // (shard_sequences * TASK_SHARDS)))

    def write(batches):
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        unpack = zstandard.ZstdDecompressor().decompress
        shard, out, name = None, None, None

        def close():
            if out is not None:
                out.close()
                whole = f"{root}/shard-{shard:08d}.bin"
                if store.get_file_info(whole).type == fs.FileType.NotFound:
                    store.move(name, whole)
                else:
                    store.delete_file(name)

        for batch in batches:
            crcs = []
            for key, packed in zip(batch.column("shard").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if key != shard:
                    close()
                    shard, name = key, f"{root}/.writing-{key:08d}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                record = unpack(packed)
                out.write(record)
                crcs.append(zlib.crc32(record))
            slots = batch.column("slot").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), batch.column("shard"), pa.array(slots % shard_sequences * stride, pa.int64()),
                 batch.column("n_tokens"), batch.column("doc_ids"), pa.array(crcs, pa.int64())],
                names=["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "crc32"])
        close()

    return (ordered.repartitionById(tasks, F.floor(F.col("shard") / TASK_SHARDS).cast("int")).sortWithinPartitions("slot")
            .select("slot", "shard", "n_tokens", "doc_ids", "packed")
            .mapInArrow(write, "slot long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, crc32 long"))


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES):
    """Yield ``count`` sequences from slot ``first`` on: one seek, then sequential reads."""
    store, root = opened(folder)
    slot, stride = first, 2 * length
    while slot < first + count:
        shard, place = divmod(slot, shard_sequences)
        take = min(shard_sequences - place, first + count - slot)
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            file.seek(place * stride)
            for _ in range(take):
                yield np.frombuffer(file.read(stride), "<u2")
        slot += take


def materialise(docs: DataFrame, folder: str, key: str, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES,
                vocabulary: str = VOCABULARY) -> DataFrame:
    """Write documents (doc_id, text) as shards in training order; returns the manifest.

    An empty table writes no shard and returns no row; repeated rows are documents of their
    own; other columns are not read. The vocabulary must have fewer than 65,536 ids. A folder
    that holds shards already is refused.
    """
    store, root = opened(folder)
    if any(f.base_name.startswith("shard-") for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True))):
        raise ValueError(f"{folder} holds shards already")
    sequences = write_table(token_sequences(docs, length, vocabulary), "sequences", level=9)
    n = sequences.count()
    ordered = in_training_order(sequences, n, key, shard_sequences)
    return write_table(write_shards(ordered, n, folder, length, shard_sequences), "manifest")


def op4_training_order(spark, sf_dir: str) -> DataFrame:
    """All documents as shards in the shared folder; the manifest is the result."""
    folder = table_path(spark, "docnorm-llm", f"shards-{uuid.uuid4().hex}")
    return materialise(table(spark, sf_dir, "documents"), folder, "epoch-0")
