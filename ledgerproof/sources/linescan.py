"""What a task does with the lines of its splits: counting quotes and joining lines.

These functions work on Arrow batches, whole columns at a time. Batches arrive in file
order, a split as a whole in one task, and a task may hold several splits one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]

# What is counted of a split.
COUNTED = "file_id split_start first_pos lines quotes evens last_even first_odd last_odd crlf_lines".split()


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The batch cut where the file or the split changes, each piece with its split."""
    starts = batch.column("split_start").to_numpy(zero_copy_only=False)
    files = batch.column("file_id").to_numpy(zero_copy_only=False)
    changed = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
    for lo, hi in zip([0, *changed], [*changed, batch.num_rows]):
        if hi > lo:
            yield (int(files[lo]), int(starts[lo])), batch.slice(lo, hi - lo)


def _parity_before(run: pa.RecordBatch, parity: int) -> tuple[np.ndarray, int]:
    """Quote parity before each line, and after the last one."""
    quotes = run.column("quotes").to_numpy(zero_copy_only=False).astype(np.int64)
    upto = parity + np.cumsum(quotes)
    return (upto - quotes) & 1, int(upto[-1]) & 1


def _in_order(run: pa.RecordBatch, last_pos: int) -> int:
    pos = run.column("pos").to_numpy(zero_copy_only=False)
    if pos[0] <= last_pos or (np.diff(pos) <= 0).any():
        raise ValueError("lines of a split arrived out of order")
    return int(pos[-1])


def count_splits(batches: Batches) -> Iterator[pa.RecordBatch]:
    """One row per split, for a quote state at its start that is not known yet.

    ``first_pos`` and ``lines``; ``quotes``; ``evens``: lines that start a record if none is
    open at the split's start (the others do if one is); ``last_even`` and ``last_odd``: the
    last of either kind; ``first_odd``: the first of the other kind, counted from 0, or the
    number of lines; ``crlf_lines``: lines that end with CR LF.
    """
    names = COUNTED
    split, row, last_pos = None, None, -1

    def done():
        row["first_odd"] = row["lines"] if row["first_odd"] is None else row["first_odd"]
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([(n, pa.int64()) for n in names]))

    for batch in batches:
        for here, run in _runs(batch):
            if here != split:
                if row:
                    yield done()
                split, last_pos = here, -1
                row = dict(zip(names, [*here, run.column("pos")[0].as_py(), 0, 0, 0, -1, None, -1, 0]))
            last_pos = _in_order(run, last_pos)
            before, _ = _parity_before(run, row["quotes"] & 1)
            evens, odds = np.flatnonzero(before == 0), np.flatnonzero(before == 1)
            if len(evens):
                row["last_even"] = row["lines"] + int(evens[-1])
            if len(odds):
                row["last_odd"] = row["lines"] + int(odds[-1])
                if row["first_odd"] is None:
                    row["first_odd"] = row["lines"] + int(odds[0])
            row["evens"] += len(evens)
            row["lines"] += run.num_rows
            row["quotes"] += pc.sum(run.column("quotes")).as_py()
            row["crlf_lines"] += pc.sum(run.column("crlf")).as_py()
    if row:
        yield done()


def number_lines(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Adds to each line its line and record number and whether a record starts with it."""
    split, line, record, parity = None, 0, 0, 0
    for batch in batches:
        for here, run in _runs(batch):
            if here != split:
                split = here
                line, record, parity = (
                    run.column(c)[0].as_py() for c in ("line_offset", "record_offset", "start_parity")
                )
            before, parity = _parity_before(run, parity)
            starts = before == 0
            records = record + np.cumsum(starts)
            added = {
                "line_num": pa.array(line + 1 + np.arange(run.num_rows)),
                "record_num": pa.array(records - 1),
                "starts": pa.array(starts),
            }
            line, record = line + run.num_rows, int(records[-1])
            yield pa.RecordBatch.from_arrays(
                [*run.columns, *added.values()], names=[*run.schema.names, *added]
            )


def join_records(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Joins the lines of the records that begin and end in one split.

    The lines before the split's first record and those of a record that its end cuts off
    have been left out, so a record starts with the first line that arrives.
    """
    names = ["file_id", "record_num", "start_line", "end_line", "raw"]

    def rows(file_id, record_nums, first_lines, last_lines, raw):
        columns = [pa.repeat(pa.scalar(file_id, pa.int64()), len(raw)), pa.array(record_nums, pa.int64())]
        columns += [pa.array(first_lines, pa.int64()), pa.array(last_lines, pa.int64()), raw]
        return pa.RecordBatch.from_arrays(columns, names=names)

    split, line, record, parity, last_pos = None, 0, 0, 0, -1
    pieces, first = [], 0  # the lines so far of a record that a batch's end cut off
    for batch in batches:
        for here, run in _runs(batch):
            if here != split:
                split, parity, last_pos, pieces = here, 0, -1, []
                line = run.column("line_offset")[0].as_py() + run.column("head")[0].as_py()
                record = run.column("record_offset")[0].as_py()
            last_pos = _in_order(run, last_pos)
            values = run.column("value")
            before, after = _parity_before(run, parity)
            starts = np.flatnonzero(before == 0)
            head = int(starts[0]) if len(starts) else run.num_rows
            if head:
                pieces.extend(values.slice(0, head).to_pylist())
                if len(starts) or after == 0:
                    yield rows(here[0], [record], [first], [line + head], pa.array(["\n".join(pieces)]))
                    pieces, record = [], record + 1
            if len(starts):
                ends = np.append(starts[1:], run.num_rows)
                whole = len(starts) if after == 0 else len(starts) - 1
                if whole:
                    cuts = pa.array(np.append(starts[:whole], ends[whole - 1]), pa.int32())
                    raw = pc.binary_join(pa.ListArray.from_arrays(cuts, values), "\n")
                    yield rows(
                        here[0],
                        record + np.arange(whole),
                        line + 1 + starts[:whole],
                        line + ends[:whole],
                        raw,
                    )
                if after == 1:
                    pieces = values.slice(int(starts[-1])).to_pylist()
                    first = line + 1 + int(starts[-1])
                record += whole
            line, parity = line + run.num_rows, after


def split_records(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The records of :func:`join_records`, and the lines of records that straddle a split's end.

    Lines with a ``piece_num`` are passed on one by one, with ``piece`` set, their record's number
    and their line's as start and end.
    """
    pieces: list[pa.RecordBatch] = []

    def inner() -> Batches:
        for batch in batches:
            apart = pc.is_valid(batch.column("piece_num"))
            if pc.any(apart).as_py():
                pieces.append(batch.filter(apart))
                batch = batch.filter(pc.invert(apart))
            if batch.num_rows:
                yield batch

    def flagged(rows: pa.RecordBatch, piece: bool) -> pa.RecordBatch:
        flag = pa.repeat(pa.scalar(piece), rows.num_rows)
        return pa.RecordBatch.from_arrays([*rows.columns, flag], [*rows.schema.names, "piece"])

    def waiting() -> Iterator[pa.RecordBatch]:
        while pieces:
            p = pieces.pop(0)
            line = pc.add(pc.add(p.column("line_offset"), p.column("at")), 1)
            columns = [p.column("file_id"), p.column("piece_num"), line, line, p.column("value")]
            yield flagged(pa.RecordBatch.from_arrays(columns, ["file_id", "record_num", "start_line", "end_line", "raw"]), True)

    for records in join_records(inner()):
        yield flagged(records, False)
        yield from waiting()
    yield from waiting()
