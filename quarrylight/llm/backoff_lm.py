"""Language-model scores from a weighted backoff automaton learned on the whole training part of a corpus.

The model is an n-gram model of any order with Dirichlet smoothing,

    P(w | h) = (c(h w) + mu P(w | h without its first word)) / (c(h) + mu),

down to smoothed word counts, written as an automaton: a state for each seen history of 1 to order - 1 words (the start of a text is a
word), and a root. A seen n-gram is an arc of its history's state with its log-probability, which leads to the state of the longest
history it ends in; from every state a failure arc with the backoff weight mu / (c(h) + mu) leads to the state of the history
without its first word, at last to the root, which has an arc for every token, the unknown one included. A text is scored in one traversal
from left to right that carries the state, takes failure arcs until there is an arc for the token, and adds up weights. For each state
the probabilities of all V known tokens and of one unknown token sum to 1.

No task or broadcast ever holds the model. Documents form blocks; each block asks for the counts of its own distinct n-grams
(pre-aggregated, dealt out by a hash of the n-gram, so that no history gathers its followers in one place), gets them in the order
asked, builds the part of the automaton that its texts can reach, and traverses it. Blocks times buckets rows are sent, each
with the n-grams of one block in one bucket.
"""

from __future__ import annotations

import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, cut, join_blobs, mix64, pack, pack_sorted, settled, split_blobs, total_bytes, unpack, unpack_sorted

#: UTF-8 bytes of a block, words of the longest n-grams, pseudo-count of the shorter history, tokens that a text is traversed by at once.
BLOCK, ORDER, MU, STRETCH = 12 << 20, 3, 100.0, 256
END, START = 0, 1
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: object) -> bool:
    """The part that the model doesn't learn from. A null key counts as an empty text."""
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


@dataclass
class Grams:
    """The distinct n-grams of one length: hashes (ascending), of each a place where it ends, and of each place its number (-1: none)."""

    hashes: np.ndarray
    last: np.ndarray
    number: np.ndarray


@dataclass
class Block:
    keys: list
    held: np.ndarray  # by document
    sizes: np.ndarray  # tokens by document, the end included
    tokens: np.ndarray  # local numbers of all tokens
    words: np.ndarray  # hash of each local number; END and START first

    @property
    def name(self) -> int:
        """From the content, so that two passes over the same rows agree."""
        x = xxhash.xxh3_64()
        for part in (pickle.dumps(self.keys, 4), self.sizes.tobytes(), self.tokens.tobytes(), self.words.tobytes()):
            x.update(part)
        return x.intdigest() - (1 << 63)

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def train(self) -> np.ndarray:
        """Whether each token is learned from."""
        return np.repeat(~self.held, self.sizes)

    def grams(self, order: int) -> list[Grams]:
        """N-grams of 1 to order words that end at a token; those of one word are all local numbers, START among them."""
        one = mix64(self.words)
        rank = np.argsort(one).astype(np.int32)  # places are below 2^31: a block is little more than one text
        number = np.empty(len(one), np.int32)
        number[rank] = np.arange(len(one), dtype=np.int32)
        out = [Grams(one[rank], rank, number[self.tokens])]
        at, within = one[self.tokens], np.arange(len(self.tokens), dtype=np.int32) - np.repeat(self.first.astype(np.int32), self.sizes)
        for n in range(2, order + 1):
            history = np.empty_like(at)
            history[1:] = at[:-1]
            if n == 2:
                history[self.first] = one[START]
            history *= _PAIR
            history += self.words[self.tokens]
            at = mix64(history)
            del history
            ends = np.flatnonzero(within >= n - 2).astype(np.int32)
            h = at[ends]
            rank = np.argsort(h).astype(np.int32)
            h, ends = h[rank], ends[rank]
            new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
            number = np.full(len(self.tokens), -1, np.int32)
            number[ends] = np.cumsum(new, dtype=np.int32) - 1
            out.append(Grams(h[new], ends[new], number))
        return out


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[Block]:
    """Blocks of consecutive rows (key, text); null texts count as empty."""
    keys, sizes, parts, n = [], [], [], 0

    def fresh() -> defaultdict:
        d: defaultdict = defaultdict()
        d.default_factory = d.__len__
        d[b""], d[b" "]  # END and START: no words
        return d

    def done() -> Block:
        words = np.array([xxhash.xxh3_64_intdigest(w) for w in ids], np.uint64)
        return Block(keys, np.array([held_out(k) for k in keys], bool), np.array(sizes, np.int64), np.concatenate(parts), words)

    ids = fresh()
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            got = [ids[w] for w in raw.split()]
            got.append(END)
            keys.append(key)
            sizes.append(len(got))
            parts.append(np.array(got, np.int32))
            n += len(raw) + 1
            if n >= size:
                block = done()
                keys, sizes, parts, n, ids, raw, got = [], [], [], 0, fresh(), b"", []  # not kept while the block is in use
                yield block
                del block
    if keys:
        block = done()
        parts, ids = [], {}
        yield block


def _edges(n_buckets: int) -> np.ndarray:
    """The least hash of each bucket: buckets are ranges of hashes, so that ascending hashes are in the order of buckets."""
    return np.array([-(-(b << 32) // n_buckets) << 32 for b in range(n_buckets)], np.uint64)


def _parts(grams: list[Grams], n_buckets: int) -> Iterator[tuple[int, np.uint64, list[slice]]]:
    """Bucket, its least hash, and where its n-grams stand."""
    edges = _edges(n_buckets)
    cuts = [np.append(np.searchsorted(g.hashes, edges), len(g.hashes)) for g in grams]
    for k in range(n_buckets):
        part = [slice(int(c[k]), int(c[k + 1])) for c in cuts]
        if any(p.start < p.stop for p in part):
            yield k, edges[k], part


def _counts(b: Block, grams: list[Grams]) -> list[np.ndarray]:
    """How often each n-gram is learned from in this block; START as often as there are texts."""
    train = b.train
    out = [np.bincount(g.number[at := g.number >= 0], weights=train[at], minlength=len(g.hashes)).astype(np.uint32) for g in grams]
    out[0][np.flatnonzero(grams[0].last == START)] = (~b.held).sum()
    return out


def _ask(b: Block, n_buckets: int, order: int) -> Iterator[tuple[int, bytes]]:
    """For each bucket, the block's n-grams in ascending order with their counts in its training part."""
    grams = b.grams(order)
    counts = _counts(b, grams)
    for k, edge, part in _parts(grams, n_buckets):
        yield k, join_blobs([x for g, c, p in zip(grams, counts, part) for x in (pack_sorted(g.hashes[p] - edge), pack(c[p]))])


_ROW = "name long, bucket int, blob binary"
START_GRAM = mix64(np.array([xxhash.xxh3_64_intdigest(b" ")], np.uint64))[0]


def _answer(frame: pd.DataFrame, n_buckets: int) -> pd.DataFrame:
    """Counts over all blocks, sent back to each block in the order it asked; a row without a blob with the number of known tokens."""
    bucket = int(frame["bucket"].iloc[0])
    edge = _edges(n_buckets)[bucket]
    asked = [split_blobs(b) for b in frame["blob"]]
    replies: list[list[bytes]] = [[] for _ in asked]
    known = 0
    for i in range(0, len(asked[0]), 2):
        each = [unpack_sorted(a[i]) for a in asked]
        keys, counts = np.concatenate(each), np.concatenate([unpack(a[i + 1]) for a in asked]).astype(np.uint64)
        rank = np.argsort(keys, kind="stable")
        s = keys[rank]
        new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.empty(0, bool)
        total = np.add.reduceat(counts[rank], np.flatnonzero(new)) if len(s) else counts
        if i == 0 and len(s):
            known = int(((total > 0) & (s[new] + edge != START_GRAM)).sum())
        full = np.empty(len(keys), np.uint64)
        full[rank] = total[np.cumsum(new) - 1] if len(s) else total
        full = full.astype(np.uint32) if not len(full) or full.max() < 1 << 32 else full
        at = 0
        for r, a in zip(replies, each):
            r.append(pack(full[at : at + len(a)]))
            at += len(a)
    return pd.DataFrame({"name": [*frame["name"], 0], "bucket": [bucket] * (len(replies) + 1), "blob": [*map(join_blobs, replies), None], "known": [0] * len(replies) + [known]})


class Automaton:
    """The states and arcs that the texts of a block can reach. A state of level n is a seen history of n words, known by the number of
    that n-gram; its arc for a token is known by the number of the n-gram of both."""

    def __init__(self, b: Block, grams: list[Grams], counts: list[np.ndarray], n_train: int, n_known: int, mu: float):
        self.grams, self.first = grams, b.first
        one = (counts[0] + 0.5) / (n_train + 0.5 * (n_known + 1))
        self.start = int(np.flatnonzero(grams[0].last == START)[0])
        self.seen = [c > 0 for c in counts]
        self.arcs, self.failure = [np.log10(one)], [np.log10(mu / (c + mu)) for c in counts[:-1]]
        opens = np.zeros(len(b.tokens), bool)
        opens[self.first] = True
        for n, (g, c) in enumerate(zip(grams[1:], counts[1:]), 2):
            shorter, ends = grams[n - 2].number, g.last  # (n - 1)-grams: the history ends one token before, the suffix here
            history = shorter[ends - 1]
            if n == 2:
                history = np.where(opens[ends], self.start, history)
            p = (c + mu * one[shorter[ends]]) / (counts[n - 2][history] + mu)
            self.arcs.append(np.log10(p))  # of use where the n-gram is seen
            one = p

    def traverse(self, sizes: np.ndarray) -> np.ndarray:
        """Log10 probability of each text. All texts advance by one token at a time, each from the state it is in; a long text is
        traversed in stretches at once, as the state before a stretch is the one that the order - 1 tokens before it lead to."""
        levels = len(self.grams) - 1
        many = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), many)
        part = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        begin = part * STRETCH
        warm = np.minimum(begin, levels)  # tokens that only lead to the state
        steps = np.minimum(sizes[text] - begin, STRETCH) + warm
        rank = np.argsort(-steps, kind="stable")
        text, begin, warm, steps = text[rank], begin[rank], warm[rank], steps[rank]
        place = self.first[text] + begin - warm
        # the state: its level and the number of its history
        level = np.where((begin == warm) & (levels > 0), 1, 0)
        state = np.full(len(text), self.start)
        score, n = np.zeros(len(text)), len(text)
        for t in range(int(steps[0]) if len(steps) else 0):
            n = int(np.searchsorted(-steps, -t, "left"))  # those that have a token left
            at, counts, lev, st = place[:n] + t, warm[:n] <= t, level[:n], state[:n]
            for down in range(levels, 0, -1):  # failure arcs, from the longest histories on
                here = np.flatnonzero(lev == down)
                arc = self.grams[down].number[at[here]]
                here = here[~self.seen[down][arc] | (arc < 0)]
                score[here] += np.where(counts[here], self.failure[down - 1][st[here]], 0.0)
                lev[here] = down - 1
                if down > 1:
                    st[here] = self.grams[down - 2].number[at[here] - 1]
            for down in range(levels + 1):  # the arcs that are there, and where they lead
                here = np.flatnonzero(lev == down)
                arc = self.grams[down].number[at[here]]
                score[here] += np.where(counts[here], self.arcs[down][arc], 0.0)
                known = self.seen[down][arc]
                to = min(down + 1, levels)
                lev[here] = np.where(known, -1 - to, -1)
                st[here] = self.grams[to - 1].number[at[here]] if to else st[here]
            level[:n] = -1 - lev
        return np.bincount(text, weights=score, minlength=len(sizes))


def _score(b: Block, replies: dict[int, bytes], n_buckets: int, n_train: int, n_known: int, order: int, mu: float) -> tuple[np.ndarray, ...]:
    grams = b.grams(order)
    counts = [np.zeros(len(g.hashes)) for g in grams]
    for k, _, part in _parts(grams, n_buckets):
        for c, p, reply in zip(counts, part, split_blobs(replies[k])):
            c[p] = unpack(reply)
    auto = Automaton(b, grams, counts, n_train, n_known, mu)
    del counts
    one = grams[0].number
    known = np.add.reduceat(auto.seen[0][one].astype(np.int64), b.first)
    return known, np.add.reduceat(auto.arcs[0][one], b.first), auto.traverse(b.sizes)


def score_documents(df: DataFrame, key: str, text: str, order: int = ORDER, mu: float = MU) -> DataFrame:
    """For each row: key, held_out, n_tokens, n_known, train_tokens, base_score (unigrams), score (the automaton's).

    The model learns from all rows that held_out() leaves; A-Z are lower-cased, tokens are the words between ASCII white space and one
    end. Null and empty texts are that end alone. Repeated rows count and are scored each time; an empty table gives no rows; without
    training rows every token is unknown. N-grams of up to `order` words are told apart by 64-bit hashes of their whole text. Further
    columns take no part. The rows are read twice: where their order might change between, they are written down first.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    kind = df.schema[key].dataType.simpleString()
    docs = settled(df.select(df[key].alias("key"), df[text].alias("text")), "scored")
    n_buckets = buckets_for(total_bytes(docs), BLOCK)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            rows = list(_ask(b, n_buckets, order))
            train = int(b.sizes[~b.held].sum())
            yield pa.record_batch([pa.array([b.name] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([train, *[0] * (len(rows) - 1)])], names=["name", "bucket", "blob", "train"])

    asked = docs.mapInArrow(ask, _ROW + ", train long")

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        out = _answer(frame, n_buckets)
        out["train"] = [0] * (len(out) - 1) + [int(frame["train"].sum())]
        return out

    answers = cut(asked.groupBy("bucket").applyInPandas(answer, _ROW + ", known long, train long"), "counts")
    n_train, n_known = (int(x or 0) for x in answers.filter("blob IS NULL").agg(F.sum("train"), F.sum("known")).first())

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            blob = join_blobs([pickle.dumps(b.keys, 4), *(pack(x) for x in (b.held.astype(np.uint8), b.sizes, b.tokens, b.words))])
            yield pa.record_batch([pa.array([b.name]), pa.array([-1], pa.int32()), pa.array([blob], pa.binary())], names=["name", "bucket", "blob"])

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        held = frame["bucket"] == -1
        replies = dict(zip(frame["bucket"][~held].tolist(), frame["blob"][~held]))
        out = []
        for blob in frame["blob"][held]:  # blocks of the same rows have the same name
            parts = split_blobs(blob)
            b = Block(pickle.loads(parts[0]), *(unpack(p) for p in parts[1:]))
            b.held = b.held.astype(bool)
            known, base, score = _score(b, replies, n_buckets, n_train, n_known, order, mu)
            out.append(pd.DataFrame({"key": pd.Series(b.keys, dtype=object), "held_out": b.held, "n_tokens": b.sizes, "n_known": known, "train_tokens": n_train, "base_score": base, "score": score}))
        return pd.concat(out) if out else pd.DataFrame(columns=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    both = docs.mapInArrow(hold, _ROW).unionByName(answers.filter("blob IS NOT NULL").select("name", "bucket", "blob"))
    out = both.groupBy("name").applyInPandas(finish, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key)
