"""Ids of a byte-level merging vocabulary for whole columns of texts.

The pattern of such vocabularies always starts a new part at a space that a non-blank follows,
and nothing behind it changes the parts before it. Texts are therefore cut in front of these
spaces, and of all equal chunks of a batch only one is encoded, by the tokenizers library. The
chunks go there in runs of about ``RUN`` bytes, one behind the other; the byte lengths of the
ids tell where each chunk ends again. What a task has encoded it may remember for its next batches
(:class:`Remembered`).
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerproof.llm.pieces import gather

RUN = 1 << 20
REMEMBERED = 1 << 22
# Bytes that are blank or may begin a blank; in front of these no text is cut.
BLANK = np.zeros(256, bool)
BLANK[[*range(33), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
SPACE = 32


def read_vocabulary(path: str) -> str:
    """The vocabulary file's content; the driver reads it and tasks get it."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and where each text begins and the last one ends."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where texts may be cut: their beginnings, and spaces that no blank follows."""
    cut = np.zeros(len(data), bool)
    cut[:-1] = (data[:-1] == SPACE) & ~BLANK[data[1:]]
    cut[bounds[1:][np.diff(bounds) > 0] - 1] = False  # a text's last byte has another text's first behind it
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


def chunks_at(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The chunks that begin at ``starts``, as a dictionary of distinct ones and their places in it."""
    cuts = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, cuts, pa.py_buffer(data)]).dictionary_encode()


class Remembered:
    """Ids of chunks, encoded when a task first meets them.

    ``encode`` gives the ids of distinct chunks, one after the other, and the number of each. Beyond
    ``REMEMBERED`` bytes of chunks all are forgotten, so memory is bounded by that and one batch.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.known, self.flat = pa.array([], pa.binary()), np.zeros(0, np.int32)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def runs(self, chunks: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``flat`` the ids of each chunk begin, and how many there are."""
        if self.known.nbytes > REMEMBERED:
            self.forget()
        words, before = chunks.dictionary, len(self.known)
        place = pc.index_in(words, value_set=self.known)
        new = place.is_null()
        place = place.fill_null(0).to_numpy().astype(np.int64)
        fresh = words.filter(new)
        if len(fresh):
            flat, sizes = self.encode(fresh)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])
            self.known = pa.concat_arrays([self.known, fresh])
            place[new.to_numpy(zero_copy_only=False)] = before + np.arange(len(fresh))
        place = place[chunks.indices.to_numpy()]
        return self.starts[place], self.sizes[place]


class ByteEncoder:
    """Encodes texts in a task. With ``plain`` the special tokens' strings are ordinary text."""

    def __init__(self, vocabulary: str, plain: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = plain
        content = json.loads(vocabulary)
        self.token_bytes = token_bytes(content)
        self.sizes = np.array([len(t) for t in self.token_bytes], np.int64)

    def one(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _chunks(self, chunks: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of runs of chunks and the number of ids of each chunk."""
        if not len(chunks):
            return
        data, bounds = column_bytes(chunks)
        run = bounds[1:] // RUN
        firsts = np.flatnonzero(np.diff(run, prepend=-1))
        for lo, hi in zip(firsts, [*firsts[1:], len(run)], strict=True):
            ids = self.one(data[bounds[lo] : bounds[hi]].tobytes().decode("utf-8"))
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), bounds[lo + 1 : hi + 1] - bounds[lo]) + 1
            yield ids, np.diff(ends, prepend=0)

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and the number of each."""
        inside, at = column_bytes(words)
        second = np.minimum(at[:-1] + 1, len(inside) - 1)
        # Only chunks that begin like a cut may follow one another.
        follows = (inside[at[:-1]] == SPACE) & (np.diff(at) > 1) & ~BLANK[inside[second]]
        sizes = np.zeros(len(words), np.int64)
        parts = []
        runs = list(self._chunks(words.filter(pa.array(follows))))
        parts += [ids for ids, _ in runs]
        sizes[follows] = np.concatenate([n for _, n in runs] or [np.zeros(0, np.int64)])
        alone = [self.one(w.decode("utf-8")) for w in words.filter(pa.array(~follows)).to_pylist()]
        sizes[~follows] = [len(ids) for ids in alone]
        flat = np.concatenate([*parts, *alone, np.zeros(0, np.int32)])
        order = np.argsort(~follows, kind="stable")
        begins = np.zeros(len(words), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(flat, begins, sizes, np.arange(len(words) + 1))[0], sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets. No text may be null."""
        data, bounds = column_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        starts = chunk_starts(data, bounds)
        chunks = chunks_at(data, starts)
        flat, sizes = self.distinct(chunks.dictionary)
        begins, which = np.cumsum(sizes) - sizes, chunks.indices.to_numpy()
        return gather(flat, begins[which], sizes[which], np.searchsorted(starts, bounds))


def token_bytes(content: dict) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary file stands for."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    # Printable bytes stand for themselves; the others follow from 256 on, in order.
    byte_of = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = content["model"]["vocab"]
    added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    out = [b""] * (max([*vocabulary.values(), *added.values()], default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token)
    for token, i in added.items():
        out[i] = token.encode("utf-8")
    return out
