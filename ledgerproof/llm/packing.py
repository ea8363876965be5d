"""Best-fit packing of documents into training sequences, by hierarchical residual packing.

A document is its ids and an end id. One longer than a sequence is cut into whole sequences,
the rest as its first piece, so that only that piece has to find a place. Pieces are packed
best-fit in leaves of at most ``LEAF`` pieces, longest first; sequences with at most
``SLACK`` free places are finished there. The underfull ones move on as items of their own,
with the pieces they hold, and are packed best-fit again, ``FAN`` leaves together, and so on
up a tree. A round ends the tree when one node has packed all that is left, or when it has
merged less than one in ``LEAST`` of its items: what is left then fits together no more.

No node holds more than ``LEAF`` items at once: it packs one lot after another. An item's
row carries the leaf sequences in it with their places, so that one join at the end tells
every piece its sequence; pieces in sequences that were finished in their leaf need no join.

Cases: a null or empty text is its end id alone; a very long text is cut; ties of lengths go
by the order of the rows; repeated rows and rows without id are packed each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.bytebpe import ByteEncoder, read_vocabulary
from ledgerproof.llm.common import settle, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
END = 0
LEAF = 32_768
FAN = 8
SLACK = 4
LEAST = 100
SLICE = 1 << 23
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBERS = "array<struct<leaf:long,at:int>>"


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than a sequence."""
    first = n_ids % capacity
    rest = [(start, capacity) for start in range(first, n_ids, capacity)]
    return [(0, first), *rest] if first else rest


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    slice_size = SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(shared.value, plain=False)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for part in slices(sizes, slice_size):
                texts = pc.fill_null(batch.column("text").slice(part.start, part.stop - part.start), "")
                ids, ends = encoder.encode(texts)
                rows: list[tuple[int, int, int, int, int]] = []
                for i in range(len(texts)):
                    data = np.append(ids[ends[i] : ends[i + 1]], END).astype("<u4")
                    for n, (start, length) in enumerate(cut(len(data), capacity)):
                        rows.append((i, n, start, length, zlib.crc32(data[start : start + length])))
                which, number, *others = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                ids_of = batch.column("doc_id").slice(part.start, part.stop - part.start).take(pa.array(which))
                columns = [ids_of, pa.array(number.astype(np.int32)), *map(pa.array, others)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and place of each item, and each sequence's fill; longest items first, each into
    the sequence with the least room that is enough."""
    order = np.argsort(-sizes, kind="stable")
    sequence, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    fills: list[int] = []
    open_ = 0  # bit r: some sequence has r free places
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        enough = open_ >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            s = rooms[room].pop()
            if not rooms[room]:
                open_ ^= 1 << room
        else:
            s, room = len(fills), capacity
            fills.append(0)
        sequence[i], at[i] = s, fills[s]
        fills[s] += size
        left = room - size
        if left:
            rooms[left].append(s)
            open_ |= 1 << left
    return sequence, at, np.array(fills, np.int64)


def _lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task, at most ``most`` at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while sum(b.num_rows for b in held) + batch.num_rows >= most:
            room = most - sum(b.num_rows for b in held)
            yield pa.Table.from_batches([*held, batch.slice(0, room)]).combine_chunks()
            held, batch = [], batch.slice(room)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def pack_leaves(cut_pieces: DataFrame, capacity: int, leaf: int, slack: int) -> DataFrame:
    """Pieces with ``leaf`` (a sequence), their place in it, its fill and whether it is finished."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        for lot in _lots(batches, leaf):
            sequence, at, fills = best_fit(lot.column("length").to_numpy(), capacity)
            added = [sequence + number, at, fills[sequence], (fills >= capacity - slack)[sequence]]
            table = lot
            for name, values in zip(["leaf", "at", "fill", "finished"], added, strict=True):
                table = table.append_column(name, pa.array(values))
            number += len(fills)
            yield from table.to_batches()

    return cut_pieces.mapInArrow(run, f"{PIECES}, leaf long, at long, fill long, finished boolean")


def pack_again(items: DataFrame, capacity: int, leaf: int, slack: int) -> DataFrame:
    """Items (fill, members) packed together: node, fill, members, finished, and of how many items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches, leaf):
            sequence, at, fills = best_fit(lot.column("fill").to_numpy(), capacity)
            members = lot.column("members").combine_chunks()
            ends = members.offsets.to_numpy()
            item = np.repeat(np.arange(len(lot)), np.diff(ends))
            inner = members.flatten()
            order = np.argsort(sequence[item], kind="stable")
            moved = pa.StructArray.from_arrays(
                [
                    inner.field("leaf").take(pa.array(order)),
                    pa.array((inner.field("at").to_numpy() + at[item])[order].astype(np.int32)),
                ],
                ["leaf", "at"],
            )
            cuts = np.concatenate([[0], np.cumsum(np.bincount(sequence[item], minlength=len(fills)))]).astype(np.int32)
            columns = {
                "fill": pa.array(fills),
                "members": pa.ListArray.from_arrays(pa.array(cuts), moved),
                "finished": pa.array(fills >= capacity - slack),
                "items": pa.array(np.bincount(sequence, minlength=len(fills))),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return items.mapInArrow(run, f"fill long, members {MEMBERS}, finished boolean, items long")


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    *,
    capacity: int = CAPACITY,
    leaf: int = LEAF,
    fan: int = FAN,
    slack: int = SLACK,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut_pieces = settle(pieces(docs, vocabulary, capacity), "pieces")
    leaves = max(1, -(-cut_pieces.count() // leaf))
    # A piece is some forty bytes whatever its text; dealt out, leaves are of one size.
    placed = settle(pack_leaves(cut_pieces.repartition(leaves), capacity, leaf, slack), "leaves")
    # A sequence's first piece stands for it.
    items = placed.where("at = 0 AND NOT finished").select(
        "fill", F.array(F.struct("leaf", F.lit(0).alias("at"))).alias("members")
    )
    left, nodes, done = items.count(), leaves, []
    while left:
        nodes = max(1, -(-nodes // fan), -(-left // leaf))
        packed = settle(pack_again(items.repartition(nodes), capacity, leaf, slack), "nodes")
        done.append(packed.where("finished"))
        items = packed.where("NOT finished").select("fill", "members")
        before, left = left, items.count()
        stays = packed.where("NOT finished AND items = 1").count()
        if nodes == 1 or (before - stays) * LEAST < before:
            done.append(packed.where("NOT finished"))
            break
    ready = placed.where("finished").select("*", F.col("leaf").alias("sequence_id"), F.col("at").alias("offset"))
    for packed in done:
        # Sequences have their first leaf sequence's number.
        inside = packed.select(
            F.array_min(F.transform("members", lambda m: m["leaf"])).alias("sequence_id"), F.explode("members").alias("m")
        ).select("sequence_id", F.col("m.leaf").alias("held"), F.col("m.at").alias("before"))
        moved = placed.where("NOT finished").join(inside, F.col("leaf") == F.col("held"))
        ready = ready.unionByName(
            moved.select(*placed.columns, "sequence_id", (F.col("at") + F.col("before")).alias("offset"))
        )
    return ready.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
