"""Vector bin packing of documents into sequences under simultaneous limits on tokens, segments and loss-bearing tokens.

Dot-product heuristic: the open sequence takes, of the pieces that fit whole, the one whose demand has the largest dot
product with what is left in every dimension (each relative to its limit). Where none fits, the piece of the largest
product is cut to what fits and its rest goes back. Packing runs in blocks of consecutive documents within a
partition: no shuffle, memory bounded by a block, and at most one sequence of each block isn't full for want of tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import tokens

#: Ids of a block, about 16 MB.
BLOCK = 1 << 22
END = 1


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("each limit must be positive")


@dataclass
class Piece:
    item: int
    start: int
    length: int
    sequence: int
    offset: int


def pack(lengths: np.ndarray, prompts: np.ndarray, limits: Limits) -> list[Piece]:
    """Pieces of items of these lengths; the first prompts[i] ids of item i bear no loss, the others do.

    Every id lies in exactly one piece, sequences are gapless from offset 0, no limit is exceeded. Items of length 0
    have no piece. Ties go to the smaller item.
    """
    out: list[Piece] = []
    todo: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (tokens, loss) -> stack of (item, start)
    sequence, T, S, L = 0, limits.tokens, limits.segments, limits.loss

    def loss(i: int, start: int, length: int) -> int:
        return max(0, start + length - max(start, int(prompts[i])))

    def put(i: int, start: int) -> None:
        n = int(lengths[i]) - start
        if n > 0:
            todo.setdefault((n, loss(i, start, n)), []).append((i, start))

    for i in range(len(lengths) - 1, -1, -1):  # stacks give the smaller item first
        start, n = 0, int(lengths[i])
        while n - start >= T and loss(i, start, T) <= L:  # a full sequence by itself
            out.append(Piece(i, start, T, sequence, 0))
            sequence, start = sequence + 1, start + T
        put(i, start)

    kinds = np.array(sorted(todo, key=lambda k: (-k[0], -k[1])), np.int64).reshape(-1, 2)
    while len(kinds):
        t, s, l = T, S, L
        while s and t and len(kinds):
            score = kinds[:, 0] * (t / T**2) + kinds[:, 1] * (l / L**2)  # the segment's share is the same for each
            fits = (kinds[:, 0] <= t) & (kinds[:, 1] <= l)
            whole = bool(fits.any())
            k = int(np.argmax(np.where(fits, score, -1.0) if whole else score))
            kind = (int(kinds[k, 0]), int(kinds[k, 1]))
            item, start = todo[kind][-1]
            take = kind[0]
            if not whole:
                free = max(0, int(prompts[item]) - start)  # ids without loss at the front
                take = min(take, t, free + l)
                if take <= 0:
                    break
            todo[kind].pop()
            if not todo[kind]:
                del todo[kind]
                kinds = np.delete(kinds, k, 0)
            out.append(Piece(item, start, take, sequence, T - t))
            t, s, l = t - take, s - 1, l - loss(item, start, take)
            if take < kind[0]:
                rest = (int(lengths[item]) - start - take, loss(item, start + take, kind[0] - take))
                if rest not in todo:
                    at = int(np.searchsorted(-kinds[:, 0], -rest[0]))
                    kinds = np.insert(kinds, at, rest, 0)
                todo.setdefault(rest, []).append((item, start + take))
        sequence += 1
    return out


def blocks(batches: Iterator[pa.RecordBatch], path: str | None, end: int | None = END, size: int = BLOCK) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """(keys, ids of each, how many of these are of the prompt) of consecutive rows (key, text, perhaps prompt); nulls count as empty."""
    enc = tokens.shared(path)
    tail = b"" if end is None else np.array([end], "<u4").tobytes()
    keys, ids, prompts, n = [], [], [], 0
    for b in batches:
        said = b.column(2).to_pylist() if b.num_columns > 2 else [None] * b.num_rows
        for key, text, prompt in zip(b.column(0).to_pylist(), b.column(1), said):
            head = enc.encode(prompt) if prompt else b""
            x = head + enc.encode(text.as_py() or "") + tail
            keys.append(key)
            ids.append(x)
            prompts.append(len(head) // 4)
            n += len(x) // 4
            if n >= size:
                yield keys, ids, prompts
                keys, ids, prompts, n = [], [], [], 0
    if keys:
        yield keys, ids, prompts


def exchanges(turns: DataFrame, conversation: str, turn: str, role: str, text: str, answers: str = "assistant") -> DataFrame:
    """Instruction data for pack_documents: key ("conversation:turn"), prompt, text of each turn whose role is `answers`. The prompt is the
    text of the turn before (the least of several, null where there is none or it is an answer itself); answers with a null conversation or
    turn have no prompt. One join on (conversation, turn): no conversation is gathered."""
    own = turns.filter(F.col(role) == answers).select(F.col(conversation).alias("c"), (F.col(turn) - 1).alias("t"), F.concat_ws(":", F.col(conversation).cast("string"), F.col(turn).cast("string")).alias("key"), F.col(text).alias("text"))
    before = turns.filter(F.coalesce(F.col(role) != answers, F.lit(True))).groupBy(F.col(conversation).alias("c"), F.col(turn).alias("t")).agg(F.min(text).alias("prompt"))
    return own.join(before, ["c", "t"], "left").select("key", "prompt", "text")


def pack_documents(df: DataFrame, key: str, text: str, limits: Limits = Limits(), tokenizer: str | None = None, prompt: str | None = None) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset.

    A document's ids end with id 1, so null and empty texts have one. prompt names a column of texts that stand before the others and bear
    no loss (null: none); their ids come first. Repeated rows are packed again; an empty table gives no rows; further columns take no
    part. sequence_id is unique: partition, then number within it; within a sequence offsets are gapless from 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for keys, ids, prompts in blocks(batches, tokenizer):
            lengths, own = np.array([len(x) // 4 for x in ids], np.int64), np.array(prompts, np.int64)
            placed = pack(lengths, own, limits)
            crc = [zlib.crc32(ids[p.item][4 * p.start : 4 * (p.start + p.length)]) for p in placed]
            yield pa.record_batch(
                [
                    pa.array([keys[p.item] for p in placed], b_kind),
                    pa.array([p.start for p in placed], pa.int64()),
                    pa.array([p.length for p in placed], pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([int(lengths[p.item]) for p in placed], pa.int64()),
                    pa.array([max(0, p.start + p.length - max(p.start, int(own[p.item]))) for p in placed], pa.int64()),
                    pa.array([sequence + p.sequence for p in placed], pa.int64()),
                    pa.array([p.offset for p in placed], pa.int64()),
                ],
                names=["key", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"],
            )
            sequence += 1 + max((p.sequence for p in placed), default=0)

    b_kind = to_arrow_type(df.schema[key].dataType)
    kind = df.schema[key].dataType.simpleString()
    said = [df[prompt].alias("prompt")] if prompt else []
    out = df.select(df[key].alias("key"), df[text].alias("text"), *said).mapInArrow(
        run, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long"
    )
    return out.withColumnRenamed("key", key)
