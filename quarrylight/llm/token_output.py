"""Token-id output: best-fit-decreasing packing with a segment tree over capacities, written as id matrices.

Documents longer than a row are split without loss. Pieces, longest first, go to the row with the least free room that
holds them; a segment tree over room sizes finds it in a logarithm of the row length. Each row of the result carries
one row of the id matrix (bytes), the cumulative segment lengths and the places where positions restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .vector_packing import blocks


class RoomTree:
    """Open rows by free room, 0 to size; each inner node knows whether a row lies below it."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = self.leaves + room
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the least room that is no less than needed, the row taken out; None without one."""
        at = self.leaves + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def best_fit(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Rows of (item, start, length): items cut into whole rows and a rest, rests placed best-fit-decreasing."""
    rows: list[list[tuple[int, int, int]]] = []
    rests = []
    for i, n in enumerate(lengths):
        rows += [[(i, s, size)] for s in range(0, n - size + 1, size)]
        if n % size:
            rests.append((n % size, i))
    tree = RoomTree(size)
    for n, i in sorted(rests, key=lambda x: (-x[0], x[1])):
        found = tree.take(n)
        if found is None:
            rows.append([])
            found = size, len(rows) - 1
        room, row = found
        rows[row].append((i, lengths[i] - n, n))
        if room > n:
            tree.add(room - n, row)
    return rows


def write_matrices(df: DataFrame, key: str, text: str, row_tokens: int = 2048, pad: int = 0, end: int | None = 1, tokenizer: str | None = None, positions: bool = False) -> DataFrame:
    """One row for each packed row: sequence_id, n_tokens, keys and starts (of each segment in its document),
    cu_seqlens (from 0 to n_tokens), position_resets (where positions begin at 0 again, the padding's begin included),
    ids (row_tokens little-endian unsigned 16-bit numbers, 32-bit where the vocabulary needs them), and position_ids with positions.

    Null texts count as empty; with end, each document ends with that id, so the empty have one; without, documents of no
    id are in no row. Repeated rows are packed again, very long texts are split, an empty table gives no rows. Packing runs in
    blocks within partitions, so memory is bounded and nothing is shuffled. Write the result to store it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for keys, ids, _ in blocks(batches, tokenizer, end):
            rows = best_fit([len(x) // 4 for x in ids], row_tokens)
            out: list[list] = [[] for _ in range(8)]
            for k, row in enumerate(rows):
                parts = [ids[i][4 * s : 4 * (s + n)] for i, s, n in row]
                line = np.full(row_tokens, pad, "<u4")
                got = np.frombuffer(b"".join(parts), "<u4")
                line[: len(got)] = got
                cu = np.concatenate([[0], np.cumsum([n for _, _, n in row])]).astype(np.int32)
                resets = cu if cu[-1] < row_tokens else cu[:-1]
                values = [sequence + k, len(got), [keys[i] for i, _, _ in row], [s for _, s, _ in row], cu, resets, line.astype("<u2").tobytes() if narrow else line.tobytes()]
                if positions:
                    spans = np.diff(np.append(resets, row_tokens))
                    values.append((np.arange(row_tokens) - np.repeat(resets, spans)).astype("<u4").tobytes())
                for col, v in zip(out, values):
                    col.append(v)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=names)
            sequence += len(rows)

    from pyspark.sql.pandas.types import to_arrow_type

    from .tokens import shared

    narrow = max(shared(tokenizer).tokenizer.get_vocab_size(), pad + 1, (end or 0) + 1) <= 1 << 16
    kind = df.schema[key].dataType
    names = ["sequence_id", "n_tokens", "keys", "starts", "cu_seqlens", "position_resets", "ids"] + ["position_ids"] * positions
    ints = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.int64(), pa.list_(to_arrow_type(kind)), pa.list_(pa.int64()), ints, ints, pa.binary()] + [pa.binary()] * positions
    schema = f"sequence_id long, n_tokens long, keys array<{kind.simpleString()}>, starts array<long>, cu_seqlens array<int>, position_resets array<int>, ids binary" + ", position_ids binary" * positions
    return df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, schema)
