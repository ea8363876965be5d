"""SentencePiece encoding and decoding over a relational lattice.

Texts are escaped (spaces become the mark, one mark goes in front) and cut into words at
marks and around characters that occur in no longer piece, where no piece can reach across.
The distinct words' lattices are relations: substrings of bounded length are exploded,
joined to the piece table by equality, and grouped by word; a higher-order ``aggregate``
folds the edges of a word into its cuts. Unigram models are folded by Viterbi, position by
position. The model at hand is of the merging kind, for which the best sum of scores is not
the encoding; there the fold takes the best edge of two adjacent parts, step by step.

The table of the ``DICTIONARY`` most frequent words is built so and given to all tasks (its
size is bounded by that number and ``LONGEST``); the words beyond it are folded in the task
that meets them, by the same rule, over the same lattice edges. A join of all words of all
documents to a table of all distinct words would move several times the input.

Decoding joins the pieces' bytes; the first space is dropped and every mark becomes a space.
What no piece covers is spelt in byte pieces, so decoding restores any text, except that a
literal mark comes back as a space: ``round_trip`` is false for such texts alone. Cases: null and empty texts have no pieces and decode to
the empty text; very long words cost ``n log n``; repeated rows are encoded each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm.common import settle, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
DICTIONARY = 65_536
LONGEST = 24
CACHE = 1 << 20
SHORT = 40
SLICE = 1 << 20
MERGES, UNIGRAM = 2, 1
UNKNOWN_PENALTY = 10.0


@dataclass
class Pieces:
    """The piece table: scores and ids by piece, each id's bytes, how words are cut, the kind of model."""

    score: dict[str, float]
    number: dict[str, int]
    data: list[bytes]
    byte_ids: list[int]
    unknown: int
    cut: str
    kind: int

    @property
    def longest(self) -> int:
        return max(map(len, self.score), default=1)


def read_pieces(path: str | None = MODEL, *, serialized: bytes | None = None) -> Pieces:
    """The piece table of a model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    if serialized is None:
        with open(path, "rb") as file:
            serialized = file.read()
    model.ParseFromString(serialized)
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError("only models that leave texts as they are and add a first space are supported")
    kind = proto.ModelProto.SentencePiece
    score, number, data, bytes_ = {}, {}, [], [-1] * 256
    for i, piece in enumerate(model.pieces):
        data.append(piece.piece.replace(MARK, " ").encode())
        if piece.type == kind.BYTE:
            value = int(piece.piece[3:5], 16)
            data[i], bytes_[value] = bytes([value]), i
        elif piece.type == kind.NORMAL:
            score[piece.piece], number[piece.piece] = piece.score, i
        elif piece.type == kind.USER_DEFINED:
            raise ValueError("models with user-defined pieces are not supported")
        else:
            data[i] = b""
    joined = {c for p in score if len(p) > 1 for c in p}
    cut = "".join(c for c in "\t\n\r0123456789" if c not in joined)
    return Pieces(score, number, data, bytes_, model.trainer_spec.unk_id, cut, model.trainer_spec.model_type)


def words_of(text: Column, pieces: Pieces) -> Column:
    """The words of a text; empty for null or empty text."""
    cut = "".join(re.escape(c) for c in pieces.cut)
    pattern = f"{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+" + (f"|[{cut}]" if cut else "")
    marked = F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK)))
    found = F.regexp_extract_all(marked, F.lit(pattern), F.lit(0))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))


# ---- the lattice as relations


def lattice(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """word, edges (start, stop, score) for words of a column ``word``; ``table`` holds piece, score."""
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    room = F.least(F.length("word") - F.col("start"), F.lit(longest))
    spans = starts.withColumn("size", F.explode(F.sequence(F.lit(1), room)))
    spans = spans.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("size")))
    # The vocabulary is a file of fixed size.
    edges = spans.join(F.broadcast(table), "piece")
    edge = F.struct("start", (F.col("start") + F.col("size")).alias("stop"), "score")
    found = edges.groupBy("word").agg(F.collect_list(edge).alias("edges"))
    none = F.array().cast("array<struct<start:int,stop:int,score:double>>")
    return words.join(found, "word", "left").select("word", F.coalesce("edges", none).alias("edges"))


def fold_merges(word: Column, edges: Column) -> Column:
    """Cuts of a word: again and again the best edge that spans two adjacent parts joins them."""

    def step(cuts: Column, _: Column) -> Column:
        def joins(e: Column) -> Column:
            inner = F.filter(cuts, lambda c: (c > e["start"]) & (c < e["stop"]))
            ends = F.array_contains(cuts, e["start"]) & F.array_contains(cuts, e["stop"])
            return ends & (F.size(inner) == 1)

        ranked = F.transform(
            F.filter(edges, joins),
            lambda e: F.struct(e["score"].alias("score"), (-e["start"]).alias("before"), e["stop"].alias("stop")),
        )
        # An array of one best edge lets the filter below refer to it by a variable.
        best = F.array_max(ranked)
        merged = F.transform(
            F.array(best), lambda b: F.filter(cuts, lambda c: (c <= -b["before"]) | (c >= b["stop"]))
        )
        return F.when(F.size(ranked) > 0, F.get(merged, F.lit(0))).otherwise(cuts)

    return F.aggregate(F.sequence(F.lit(1), F.length(word)), F.sequence(F.lit(0), F.length(word)), step)


def fold_viterbi(word: Column, edges: Column, unknown: float) -> Column:
    """Cuts of a word with the best sum of scores; a character without piece scores ``unknown``."""
    nowhere = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"))

    def step(best: Column, stop: Column) -> Column:
        covered = F.exists(edges, lambda e: (e["stop"] == stop) & (e["start"] == stop - 1))
        ways = F.transform(
            F.filter(edges, lambda e: e["stop"] == stop),
            lambda e: F.struct((F.get(best, e["start"])["score"] + e["score"]).alias("score"), e["start"].alias("back")),
        )
        spelt = F.struct((F.get(best, stop - 1)["score"] + unknown).alias("score"), (stop - 1).alias("back"))
        ways = F.when(covered, ways).otherwise(F.concat(ways, F.array(spelt)))
        return F.concat(best, F.array(F.array_max(ways)))

    def trace(best: Column) -> Column:
        def back(cuts: Column, _: Column) -> Column:
            first = F.get(cuts, F.lit(0))
            return F.when(first > 0, F.concat(F.array(F.get(best, first)["back"]), cuts)).otherwise(cuts)

        return F.aggregate(F.sequence(F.lit(1), F.length(word)), F.array(F.length(word)), back)

    return F.aggregate(F.sequence(F.lit(1), F.length(word)), F.array(nowhere), step, trace)


def cut_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word, cuts of distinct words, all in Spark."""
    rows = [(p, float(s)) for p, s in pieces.score.items()]
    table = words.sparkSession.createDataFrame(rows, "piece string, score double")
    edges = lattice(words, table, pieces.longest)
    if pieces.kind == UNIGRAM:
        unknown = min(pieces.score.values(), default=0.0) - UNKNOWN_PENALTY
        return edges.select("word", fold_viterbi(F.col("word"), F.col("edges"), unknown).alias("cuts"))
    return edges.select("word", fold_merges(F.col("word"), F.col("edges")).alias("cuts"))


# ---- the same fold for words that only some task meets


def merge_parts(word: str, score: dict[str, float]) -> list[str]:
    """The parts of a word after all merges, best score first, leftmost first among equals."""
    parts = list(word)
    if len(parts) <= SHORT:
        least = -math.inf
        ranks = [score.get(a + b, least) for a, b in zip(parts, parts[1:])]
        while ranks and (best := max(ranks)) > least:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = score.get(parts[at] + parts[at + 1], least)
            if at:
                ranks[at - 1] = score.get(parts[at - 1] + parts[at], least)
        return parts
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (s := score.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-s, i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if not parts[i] or not parts[j] or after[i] != j or parts[i] + parts[j] != whole:
            continue
        parts[i], parts[j] = whole, ""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [p for p in parts if p]


def best_parts(word: str, score: dict[str, float], longest: int, unknown: float) -> list[str]:
    """The parts of a word with the best sum of scores; ties go to the later start of the last part."""
    best = [(0.0, 0)]
    for stop in range(1, len(word) + 1):
        ways = [
            (best[start][0] + s, start)
            for start in range(max(0, stop - longest), stop)
            if (s := score.get(word[start:stop])) is not None
        ]
        if word[stop - 1 : stop] not in score:
            ways.append((best[stop - 1][0] + unknown, stop - 1))
        best.append(max(ways))
    parts, stop = [], len(word)
    while stop:
        parts.append(word[best[stop][1] : stop])
        stop = best[stop][1]
    return parts[::-1]


class Merges:
    """The same fold for many words of equal length at once: a row a word, a merge a step."""

    NONE = np.iinfo(np.int32).max

    def __init__(self, pieces: Pieces):
        number, self.n = pieces.number, len(pieces.data)
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in number.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        order = np.unique([-s for s in pieces.score.values()], return_inverse=True)[1]  # best score first
        pairs = [
            (number[p[:k]] * self.n + number[p[k:]], rank, number[p])
            for p, rank in zip(pieces.score, order.tolist())
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.pair, self.order, self.whole = pairs[:, 0].copy(), pairs[:, 1].astype(np.int32), pairs[:, 2].astype(np.int32)

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        return at, self.pair[at] == wanted

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair's piece in the order of scores, ``NONE`` without one."""
        at, found = self._found(left, right)
        return np.where(found, self.order[at], self.NONE)

    def fold(self, words: Sequence[str]) -> list[list[int] | None]:
        """Ids of words of at most ``SHORT`` characters that are all pieces; None for others."""
        out: list[list[int] | None] = [None] * len(words)
        if not len(self.pair):
            return out
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first, every = np.cumsum(sizes) - sizes, self.of_char[points]
        for size in np.unique(sizes[(sizes > 0) & (sizes <= SHORT)]).tolist():
            rows = np.flatnonzero(sizes == size)
            parts = every[first[rows][:, None] + np.arange(size)]
            known = (parts >= 0).all(1)
            self._fold(rows[known], parts[known], out)
        return out

    def _fold(self, rows: np.ndarray, parts: np.ndarray, out: list[list[int] | None]) -> None:
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while ranks.shape[1] and len(rows):
            at = ranks.argmin(1)  # leftmost first among equals
            goes_on = ranks[np.arange(len(rows)), at] < self.NONE
            for i, ids in zip(rows[~goes_on].tolist(), parts[~goes_on].tolist(), strict=True):
                out[i] = ids
            rows, parts, ranks, at = rows[goes_on], parts[goes_on], ranks[goes_on], at[goes_on]
            row = np.arange(len(rows))
            stays, same = np.ones(parts.shape, bool), np.ones(ranks.shape, bool)
            stays[row, at + 1] = same[row, at] = False
            parts[row, at] = self.whole[self._found(parts[row, at], parts[row, at + 1])[0]]
            parts = parts[stays].reshape(len(rows), stays.shape[1] - 1)
            ranks = ranks[same].reshape(len(rows), same.shape[1] - 1)
            for left in (at - 1, at):
                inside = (left >= 0) & (left < ranks.shape[1])
                r, k = row[inside], left[inside]
                ranks[r, k] = self.rank(parts[r, k], parts[r, k + 1])
        for i, ids in zip(rows.tolist(), parts.tolist(), strict=True):
            out[i] = ids


class Encoder:
    """Ids of words, from the table where it has them, else folded here."""

    def __init__(self, pieces: Pieces, table: dict[str, list[int]] | None = None):
        self.pieces, self.table, self.cache = pieces, table or {}, {}
        self.longest = pieces.longest
        self.floor = min(pieces.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.merges = Merges(pieces) if pieces.kind == MERGES else None

    def ids(self, parts: Sequence[str]) -> list[int]:
        out: list[int] = []
        for part in parts:
            i = self.pieces.number.get(part)
            if i is not None:
                out.append(i)
            else:
                spelt = [self.pieces.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
                out += spelt if min(spelt) >= 0 else [self.pieces.unknown]
        return out

    def word(self, word: str) -> list[int]:
        found = self.table.get(word) or self.cache.get(word)
        if found is None:
            score = self.pieces.score
            if self.pieces.kind == UNIGRAM:
                found = self.ids(best_parts(word, score, self.longest, self.floor))
            else:
                found = self.ids(merge_parts(word, score))
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def words(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of many distinct words."""
        lists = [self.table.get(w) or self.cache.get(w) for w in words]
        new = [i for i, ids in enumerate(lists) if ids is None]
        folded = self.merges.fold([words[i] for i in new]) if self.merges else [None] * len(new)
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
        for i, ids in zip(new, folded, strict=True):
            lists[i] = self.word(words[i]) if ids is None else ids
            self.cache[words[i]] = lists[i]
        return lists

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets. No text may be null."""
        coded, offsets = cut_texts(texts, self.pieces)
        lists = self.words(coded.dictionary.to_pylist())
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, sizes.sum())
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        return gather(flat, starts[which], sizes[which], offsets)


def cut_texts(texts: pa.Array, pieces: Pieces) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of :func:`words_of` of all texts, and where each text's words begin."""
    marked = pc.binary_join_element_wise(MARK, pc.replace_substring(texts, " ", MARK), "")
    marked = pc.if_else(pc.equal(texts, ""), "", marked)
    at = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset : marked.offset + len(marked) + 1].astype(np.int64)
    data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    first, second, third = MARK.encode()
    mark = np.zeros(len(data) + 3, bool)  # three places in front, so that the one before is three back
    mark[3:-2] = (data[:-2] == first) & (data[1:-1] == second) & (data[2:] == third)
    single = np.zeros(256, bool)
    single[list(pieces.cut.encode())] = True
    alone = single[data]
    begins = mark[3:] & ~mark[:-3] | alone
    begins[1:] |= alone[:-1]
    begins[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(begins)
    cuts = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, cuts, pa.py_buffer(data)])
    return words.dictionary_encode(), np.searchsorted(starts, at)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` one after the other, and the offsets of groups of runs."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    return flat[at], ends[bounds]


class Decoder:
    """Texts of ids."""

    def __init__(self, data: Sequence[bytes]):
        self.flat = np.frombuffer(b"".join(data), np.uint8)
        self.sizes = np.array([len(d) for d in data], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of every text."""
        data, ends = gather(self.flat, self.starts[ids], self.sizes[ids], offsets)
        whole = data.tobytes()
        return [whole[a + 1 : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


# ---- documents


def frequent_words(docs: DataFrame, pieces: Pieces, most: int = DICTIONARY) -> DataFrame:
    """The most frequent distinct words of the texts, ``most`` at most: a cut of equal counts goes as a whole."""
    words = docs.select(F.explode(words_of(F.col("text"), pieces)).alias("word"))
    counts = words.where(F.length("word") <= LONGEST).groupBy("word").count()
    counts = settle(counts.where("count > 1"), "word-counts")
    scale = counts.groupBy(F.floor(F.log2("count") * 8).alias("step")).agg(F.count("*").alias("n"))
    least, total = None, 0
    for row in sorted(scale.collect(), key=lambda r: -r.step):  # a few hundred rows
        total += row.n
        if total > most:
            break
        least = row.step
    if least is None:
        return counts.where("false").select("word")
    return counts.where(F.floor(F.log2("count") * 8) >= least).select("word")


def word_table(docs: DataFrame, pieces: Pieces, most: int = DICTIONARY) -> dict[str, list[int]]:
    """Ids of the most frequent words: at most ``most`` rows come to the driver."""
    encoder = Encoder(pieces)
    cut = cut_words(frequent_words(docs, pieces, most), pieces)
    return {
        r.word: encoder.ids([r.word[a:b] for a, b in zip(r.cuts, r.cuts[1:])]) for r in cut.collect()
    }


def encode(docs: DataFrame, pieces: Pieces, table: dict[str, list[int]] | None = None) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip (decoding gives the text again) of every document."""
    spark: SparkSession = docs.sparkSession
    table = word_table(docs, pieces) if table is None else table
    shared = spark.sparkContext.broadcast((vars(pieces), table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, known = shared.value
        encoder = Encoder(Pieces(**parts), known)
        decoder = Decoder(parts["data"])
        for batch in batches:
            column = pc.fill_null(batch.column("text"), "")
            for part in slices(pc.binary_length(column).to_pylist(), SLICE):
                size = part.stop - part.start
                own = column.slice(part.start, size)
                ids, offsets = encoder.encode(own)
                wanted = own.cast(pa.binary()).to_pylist()
                same = [a == b for a, b in zip(decoder.decode(ids, offsets), wanted, strict=True)]
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids))
                columns = [batch.column("doc_id").slice(part.start, size), pa.array(np.diff(offsets)), lists, pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids", "round_trip"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, text of rows with ids; invalid UTF-8 is replaced, null ids give a null text."""
    data = pieces.data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(data)
        for batch in batches:
            lists = [None if x is None else np.array(x, np.int64) for x in batch.column("ids").to_pylist()]
            texts = [None if x is None else decoder.decode(x, np.array([0, len(x)]))[0].decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
