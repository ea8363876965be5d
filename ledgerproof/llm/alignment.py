"""Alignment of two tokenizers' tokens over the same text, and how often token pairs meet.

Both sides' tokens tile the bytes of space+text. Per batch ``pandas.merge_asof``, keyed by
document and offset (as one place that runs on over the documents, which both sides tile alike),
finds for each token start the other side's covering token; both directions
together are all pairs of overlapping tokens (a pair whose tokens start together is found
twice and kept once). Offsets at which both sides end cut the tokens into groups.

Texts are cut into chunks across which no token of a side reaches, and a task encodes equal
chunks once. Side A's are those of ``bytebpe.py``; side B's begin at runs of spaces, as no piece
of the model has a mark behind other characters. With a model of another kind whole texts
are encoded.

How often a pair of ids is linked in the whole corpus needs every document first. Texts are
therefore worked on in blocks of about ``BLOCK`` bytes, and one row is written per block: its
documents' figures, the pairs of ids that it holds with their counts, and, compressed, which
pair each link is. Only the pairs are summed over the corpus. Each block then gets the totals
of its own pairs back and sums them up per document. No token is encoded twice, no text is
shuffled, and a pair that occurs everywhere is one row per block.

Cases: null and empty texts, and texts that one side does not spell byte by byte (a literal
mark of the piece model), have no tokens: zeros and an empty ``groups_sha256``. Special
tokens' strings are plain text. A very long text is a block of its own. Repeated rows and
rows with null or equal ids count each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.llm.bytebpe import (
    SPACE,
    ByteEncoder,
    Remembered,
    chunk_starts,
    chunks_at,
    column_bytes,
    read_vocabulary,
)
from ledgerproof.llm.common import settle, slices
from ledgerproof.llm.pieces import MARK, MERGES, MODEL, gather

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
BLOCK = 1 << 23
SLICE = 1 << 20
RUN = 1 << 12
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, links binary, pairs array<long>, counts array<long>"
)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PieceSide:
    """Side B: ids of a piece model and the bytes of its pieces."""

    def __init__(self, model: bytes, separable: bool):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.token_bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            byte = self.library.is_byte(i)
            self.token_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace(MARK, " ").encode())

        self.sizes = np.array([len(b) for b in self.token_bytes], np.int64)
        self.separable = separable

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets."""
        lists = self.library.encode(texts.to_pylist(), num_threads=1) if len(texts) else []
        offsets = np.cumsum([0, *map(len, lists)])
        return np.fromiter((i for ids in lists for i in ids), np.int32, offsets[-1]), offsets

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and the number of each.

        A chunk begins with a space; in runs of about ``RUN`` bytes they are encoded one behind the other.
        """
        data, at = column_bytes(words)
        # Behind a chunk of spaces, or one with a literal mark, the next one would not begin a word.
        last = data[np.maximum(at[1:] - 1, 0)]
        follows = (last != SPACE) & ~pc.match_substring(words, MARK).to_numpy(zero_copy_only=False)
        together, apart = words.filter(pa.array(follows)), words.filter(pa.array(~follows)).to_pylist()
        data, at = column_bytes(together)
        run = at[1:] // RUN
        firsts = np.flatnonzero(np.diff(run, prepend=-1)) if len(run) else np.zeros(0, np.int64)
        edges = [*at[firsts].tolist(), len(data)]
        # The library puts the first space in front.
        texts = [data[lo + 1 : hi].tobytes().decode("utf-8") for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        lists = self.library.encode(texts, num_threads=1) if texts else []
        # A chunk of spaces alone is not encoded by itself: the library gives no ids for an empty text.
        before = len(self.library.encode("a"))
        ids = [np.array(ids, np.int32) for ids in lists]
        alone = [np.array(self.library.encode("a" + w.decode("utf-8"))[before:], np.int32) for w in apart]
        ends = np.searchsorted(np.cumsum(self.sizes[np.concatenate([np.zeros(0, np.int32), *ids])]), at[1:]) + 1
        sizes = np.zeros(len(words), np.int64)
        sizes[follows] = np.diff(ends, prepend=0)
        sizes[~follows] = [len(a) for a in alone]
        flat = np.concatenate([np.zeros(0, np.int32), *ids, *alone])
        order = np.argsort(~follows, kind="stable")
        begins = np.zeros(len(words), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(flat, begins, sizes, np.arange(len(words) + 1))[0], sizes


def separable(model: bytes) -> bool:
    """Whether a model merges pieces, leaves texts as they are and has no piece that reaches into a next word."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    read = proto.ModelProto()
    read.ParseFromString(model)
    rules = read.normalizer_spec
    plain = rules.add_dummy_prefix and not (rules.precompiled_charsmap or rules.remove_extra_whitespaces)
    merging = read.trainer_spec.model_type == MERGES and read.trainer_spec.byte_fallback
    return bool(plain and merging) and not any(MARK in p.piece.lstrip(MARK) for p in read.pieces)


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where texts may be cut for side B: their beginnings, and spaces that follow something else."""
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == SPACE) & (data[:-1] != SPACE)
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


def _joined(memory: Remembered, data: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that are cut at ``starts``, and the texts' offsets."""
    begins, sizes = memory.runs(chunks_at(data, starts))
    return gather(memory.flat, begins, sizes, np.searchsorted(starts, bounds))


class Spelling:
    """Bytes of runs of ids."""

    def __init__(self, token_bytes: Sequence[bytes]):
        self.flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.sizes = np.array([len(b) for b in token_bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def fits(self, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which texts the ids spell byte by byte."""
        spelt, ends = gather(self.flat, self.starts[ids], self.sizes[ids], offsets)
        ours, theirs = memoryview(spelt), memoryview(np.ascontiguousarray(data))
        return np.array(
            [ours[a:b] == theirs[c:d] for a, b, c, d in zip(ends[:-1], ends[1:], bounds[:-1], bounds[1:], strict=True)], bool
        )


def covering(starts: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """For each token start the other side's token that covers it; a document's places are its own."""
    found = pd.merge_asof(starts[["at"]], others[["at", "token"]], on="at", direction="backward")
    return found["token"].to_numpy(np.int64)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all overlapping tokens, by side; ``at`` (ascending), ``doc``, ``token`` of either."""
    of_a = covering(a, b)
    of_b = covering(b, a)
    apart = a["at"].to_numpy()[of_b] != b["at"].to_numpy()
    first = np.concatenate([np.arange(len(a)), of_b[apart]])
    second = np.concatenate([of_a, np.arange(len(b))[apart]])
    # By where a link begins: two ascending runs, which a stable sort merges.
    order = np.argsort(np.concatenate([a["at"].to_numpy(), b["at"].to_numpy()[apart]]), kind="stable")
    return first[order], second[order]


class Names:
    """The written form of groups: ``a1,a2|b1`` with a semicolon between groups."""

    def __init__(self, n_a: int, n_b: int):
        digits = lambda n, sign: np.array([f"{i}{sign}" for i in range(n)], object)
        self.a, self.a_last = digits(n_a, ","), digits(n_a, "|")
        self.b, self.b_last = digits(n_b, ","), digits(n_b, ";")

    def digests(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, docs: int) -> tuple[list[str], np.ndarray]:
        """Per document the digest of its groups and their number."""
        met = np.zeros(max(ends_a[-1:].max(initial=0), ends_b[-1:].max(initial=0)) + 1, np.int8)
        met[ends_a] = 1
        met[ends_b] += 1
        last_a, last_b = met[ends_a] == 2, met[ends_b] == 2
        in_a, in_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        of_a, of_b = np.bincount(in_a), np.bincount(in_b)
        text = np.empty(len(a) + len(b), object)
        # Of a group the tokens of A come first: behind all tokens of earlier groups of B.
        text[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[in_a]] = np.where(last_a, self.a_last[a], self.a[a])
        text[np.arange(len(b)) + np.cumsum(of_a)[in_b]] = np.where(last_b, self.b_last[b], self.b[b])
        cuts = np.cumsum(np.bincount(doc_a, minlength=docs) + np.bincount(doc_b, minlength=docs))
        parts = text.tolist()
        out = []
        for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
            out.append(hashlib.sha256("".join(parts[lo:hi])[:-1].encode()).hexdigest() if hi > lo else "")
        return out, np.bincount(doc_b[last_b], minlength=docs)


class Aligner:
    """What a task needs to align slices of texts."""

    def __init__(self, vocabulary: str, model: bytes, separable: bool):
        self.a, self.b = ByteEncoder(vocabulary, plain=True), PieceSide(model, separable)
        self.memory_a, self.memory_b = Remembered(self.a.distinct), Remembered(self.b.distinct)
        self.spell_a, self.spell_b = Spelling(self.a.token_bytes), Spelling(self.b.token_bytes)
        self.names = Names(len(self.a.token_bytes), len(self.b.token_bytes))

    def tokens(self, ids: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """Places of the tokens of good texts, their ids and ends; places run on over the texts."""
        doc = np.repeat(np.arange(len(good)), np.diff(offsets))
        kept = good[doc]
        ids, doc = ids[kept], doc[kept]
        ends = np.cumsum(sizes[ids])
        frame = pd.DataFrame({"at": ends - sizes[ids], "doc": doc, "token": np.arange(len(ids))})
        return frame, ids, ends

    def align(self, texts: pa.Array) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
        """Figures and digests per text, and the pair of ids of each link, text by text."""
        whole = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise(" ", whole, "")
        data, bounds = column_bytes(spaced)
        ids_a, at_a = _joined(self.memory_a, data, bounds, chunk_starts(data, bounds))
        if self.b.separable:
            ids_b, at_b = _joined(self.memory_b, data, bounds, word_starts(data, bounds))
        else:
            ids_b, at_b = self.b.encode(whole)
        good = np.diff(bounds) > 1
        good &= self.spell_a.fits(ids_a, at_a, data, bounds) & self.spell_b.fits(ids_b, at_b, data, bounds)
        a, ids_a, ends_a = self.tokens(ids_a, at_a, self.spell_a.sizes, good)
        b, ids_b, ends_b = self.tokens(ids_b, at_b, self.spell_b.sizes, good)
        first, second = overlaps(a, b)
        doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
        digests, groups = self.names.digests(ids_a, ids_b, ends_a, ends_b, doc_a, doc_b, len(texts))
        count = lambda docs: np.bincount(docs, minlength=len(texts))
        figures = dict(zip(FIGURES, [count(doc_a), count(doc_b), groups, count(doc_a[first])], strict=True))
        return figures, digests, ids_a[first].astype(np.int64) << 32 | ids_b[second]


def aligned_blocks(docs: DataFrame, vocabulary: str, model: bytes) -> DataFrame:
    """One row per block of documents."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, model, separable(model)))
    block_size, slice_size, names = BLOCK, SLICE, [field.split()[0] for field in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        aligner, pack = Aligner(*shared.value), zstandard.ZstdCompressor(level=3)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for part in slices(sizes, block_size):
                block = batch.slice(part.start, part.stop - part.start)
                figures, digests, pairs = [], [], []
                for inner in slices(sizes[part], slice_size):
                    f, d, p = aligner.align(block.column("text").slice(inner.start, inner.stop - inner.start))
                    figures.append(f)
                    digests += d
                    pairs.append(p)
                links, distinct = pd.factorize(np.concatenate(pairs))
                counts = np.bincount(links, minlength=len(distinct))
                columns = {
                    "doc_ids": block.column("doc_id"),
                    **{n: pa.array(np.concatenate([f[n] for f in figures])) for n in FIGURES},
                    "groups_sha256": pa.array(digests, pa.string()),
                    "pairs": pa.array(distinct, pa.int64()),
                    "counts": pa.array(counts, pa.int64()),
                }
                row = {name: pa.ListArray.from_arrays([0, len(values)], values) for name, values in columns.items()}
                row["block"] = pa.array([number])
                row["links"] = pa.array([pack.compress(links.astype("<u4").tobytes())], pa.binary())
                yield pa.RecordBatch.from_arrays([row[n] for n in names], names)
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, BLOCKS)


def pair_totals(blocks: DataFrame) -> DataFrame:
    """asking (a block), place, n (how many links of the corpus hold the pair), best (none of its B id has more)."""
    held = blocks.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    # A B id has at most as many pairs as side A has ids.
    most = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    totals = totals.select("pair", "n", (F.col("n") == most).alias("best"))
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    return asked.join(totals, "pair").select(F.col("block").alias("asking"), "place", "n", "best")


def _summed(blocks: pa.Table, totals: pa.Table) -> pa.Table:
    """Documents of one block with the sums over their links."""
    import zstandard

    n = np.zeros(len(totals), np.int64)
    best = np.zeros(len(totals), np.int64)
    if len(totals):
        place = totals.column("place").to_numpy()
        n[place] = totals.column("n").to_numpy()
        best[place] = totals.column("best").to_numpy().astype(np.int64)
    row = {name: blocks.column(name).combine_chunks() for name in blocks.column_names}
    links = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["links"][0].as_py()), "<u4")
    figures = {name: row[name].flatten() for name in FIGURES}
    ends = np.cumsum(figures["n_links"].to_numpy())
    # Every link of a document lies between two ends; documents without links have equal ones.
    upto = lambda v: np.concatenate([[0], np.cumsum(v[links])])
    sums = [pa.array(np.diff(upto(v)[np.concatenate([[0], ends])])) for v in (best, n)]
    columns = [row["doc_ids"].flatten(), *figures.values(), *sums, row["groups_sha256"].flatten()]
    return pa.Table.from_arrays(columns, names=["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, vocabulary: str = VOCABULARY, model: str = MODEL) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    with open(model, "rb") as file:
        data = file.read()
    blocks = settle(aligned_blocks(docs, read_vocabulary(vocabulary), data), "token-alignment")
    carried = blocks.select("block", "doc_ids", *FIGURES, "groups_sha256", "links")
    return carried.groupBy("block").cogroup(pair_totals(blocks).groupBy("asking")).applyInArrow(_summed, ALIGNED)
