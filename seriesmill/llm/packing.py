"""Lexical retrieval packing: windows of 2048 token ids, filled with similar documents.

A document's ids, with the end id, are cut into full windows and a rest that is shorter. A full window is
a sequence of its own. The rests are dealt to shards of some two thousand by content: each is linked to
the most similar one that minhashes of its terms, weighted by rareness, find in the whole table, and rests
that links connect go to one shard, as far as it holds them. In a shard, a BM25 inverted
index over the rests' token ids, with document counts and mean length of the whole table, returns for
each seed (the longest unused rest) the unused neighbours by descending score; those that fit are placed,
then the best that doesn't fit is cut, and what is left of it stays unused. Where retrieval has no
neighbour left, the longest unused rest fills up. So every sequence is full but a shard's last one, which
is cut into sequences whose lengths are powers of two and which need no padding either.

Defined cases: a null or empty text is the end id alone. Rows are packed one by one, so that repeated rows
or ids and null ids need nothing special; equal scores go by place in the shard, which is
dealt by content and row. Other columns are not read, and an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import arrow_batches, arrow_rows, documents_only, small, stored
from seriesmill.llm.components import roots
from seriesmill.llm.tokens import encoder, grouped

WINDOW = 2048
END = 1
#: Rests of a shard, on average.
SHARD = 2000
#: Parts of the table that shards are cut from, at most.
MOST_PARTS = 500
#: A term that a rest in so many of the shard holds has its weights in a matrix, not in a list of rests.
COMMON_ONE_IN = 10
K1, B = 1.2, 0.75
#: Minhashes of a rest; so many sorted orders, each by its own share of them; rests compared with those that
#: follow so closely in an order.
HASHES, ORDERS, FOLLOWING = 32, 8, 8
#: A term that no other rest has gives no minhash.
NOWHERE = np.int32(2**31 - 1)

#: Bits of a row's number in a link, below the minhashes that agree: rows come from fewer than 16 million tasks.
ROW_BITS = 57

#: Bits of a sequence's number within its shard: no shard has more sequences than twice its rests and a few.
SHARD_BITS = 16

PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where all ids fit, else four, with the width in front."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"\2" + ids.astype("<u2").tobytes()) if small else (b"\4" + ids.astype("<u4").tobytes())


def _wide(stored_ids: bytes) -> np.ndarray:
    return np.frombuffer(stored_ids, "<u2" if stored_ids[0] == 2 else "<u4", offset=1).astype("<u4")


def tokenized(docs: DataFrame, tokenizer: str, id_column: str, text: str) -> DataFrame:
    """(id, n, blocks, rest, row) of every document, the end id included, stored.

    ``blocks`` are the ids of its full windows, ``rest`` those after them.
    """

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, at = encoder(tokenizer).encode_batch(batch.column(1))
        ids = [np.append(flat[low:high], np.uint32(END)) for low, high in zip(at[:-1], at[1:], strict=True)]
        cut = [len(i) - len(i) % WINDOW for i in ids]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(map(len, ids), pa.int64()),
                pa.array([_narrow(i[:c]) if c else None for i, c in zip(ids, cut, strict=True)], pa.binary()),
                pa.array([_narrow(i[c:]) if c < len(i) else None for i, c in zip(ids, cut, strict=True)], pa.binary()),
            ],
            names=["id", "n", "blocks", "rest"],
        )

    rows = documents_only(docs, id_column, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    made = arrow_batches(rows).mapInArrow(
        lambda batches: map(encode, grouped(batches)), f"id {kind}, n long, blocks binary, rest binary"
    )
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "tokens")


def document_counts(tokens: DataFrame) -> np.ndarray:
    """Of how many rests each token id is part. One row for each id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                part = _wide(value)
                greatest = int(part.max(initial=0))
                if greatest >= len(total):
                    total = np.concatenate([total, np.zeros(greatest + 1 - len(total), np.int64)])
                total[part] += 1  # once for an id, however often the rest has it
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    rows = tokens.where("rest IS NOT NULL").select("rest").mapInArrow(count, "token long, n long")
    counts = rows.groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    made = np.zeros(max(counts.column("token").to_pylist(), default=-1) + 1, np.int64)
    made[counts.column("token").to_numpy()] = counts.column("n").to_numpy()
    return made


def term_ranks(counts: np.ndarray, total: int) -> np.ndarray:
    """Each term's rank for each minhash; the least rank of a rest is its minhash.

    A term is chosen in proportion to its idf, so that two rests agree on a minhash with the probability of their
    weighted Jaccard similarity.
    """
    idf = np.log1p((total - counts + 0.5) / (counts + 0.5))
    shared = counts > 1
    ranks = np.full((HASHES, len(counts)), NOWHERE, np.int32)
    for row, draw in zip(ranks, np.random.default_rng(1).exponential(size=(HASHES, len(counts))), strict=True):
        order = np.argsort(draw / idf)
        row[order] = np.arange(len(counts), dtype=np.int32)
        row[~shared] = NOWHERE
    return np.ascontiguousarray(ranks.T)


def signatures(rests: list[np.ndarray], ranks: np.ndarray) -> np.ndarray:
    """The minhashes of each rest; none of them is empty."""
    return np.array([ranks.take(rest, axis=0).min(axis=0) for rest in rests])


def links(rows: np.ndarray, signs: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, most similar row, minhashes that agree) of those that stand close in an order.

    Of equally similar rows the one with the greatest number is taken: so no links form a ring of three or more.
    """
    best, other = np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
    for lag in range(1, min(FOLLOWING, len(rows) - 1) + 1):
        one, two = signs[:-lag], signs[lag:]
        same = ((one == two) & (one != NOWHERE)).sum(axis=1) * (orders[:-lag] == orders[lag:])
        for this, that in ((slice(None, -lag), slice(lag, None)), (slice(lag, None), slice(None, -lag))):
            better = (same > best[this]) | ((same == best[this]) & (rows[that] > other[this]))
            other[this] = np.where(better, rows[that], other[this])
            best[this] = np.maximum(best[this], same)
    found = best > 0
    return rows[found], other[found], best[found]


def shards_by_content(rests: DataFrame, counts: np.ndarray, total: int) -> DataFrame:
    """(row, shard) of the rests, stored. A shard has SHARD rests at most.

    Each of several orders of the whole table sorts the rests by some of their minhashes, and a rest is compared
    with those next to it, so that a group of any size costs in proportion to it.
    """
    spark = rests.sparkSession
    shared = spark.sparkContext.broadcast(term_ranks(counts, total))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [_wide(v) for v in batch.column(1).to_pylist()]
        made = signatures(values, shared.value).astype(">i4") if values else ()
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([m.tobytes() for m in made], pa.binary())], names=["row", "sign"]
        )

    signed = stored(arrow_rows(rests.select("row", "rest"), sign, "row long, sign binary"), "signatures")
    width = 4 * HASHES // ORDERS
    keyed = signed.withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))).withColumn(
        "key", F.expr(f"substring(sign, {width} * order + 1, {width})")
    )
    place = ["order", "key", "sign", "row"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, signs, orders = np.empty(0, np.int64), np.empty((0, HASHES), ">i4"), np.empty(0, np.int32)
        for batch in batches:
            new = np.frombuffer(b"".join(batch.column("sign").to_pylist()), ">i4").reshape(-1, HASHES)
            rows = np.concatenate([rows, batch.column("row").to_numpy()])
            signs = np.concatenate([signs, new])
            orders = np.concatenate([orders, batch.column("order").to_numpy()])
            one, two, same = links(rows, signs, orders)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array((same << ROW_BITS) | two)], names=["a", "link"])
            rows, signs, orders = rows[-FOLLOWING:], signs[-FOLLOWING:], orders[-FOLLOWING:]

    sorted_rows = keyed.repartitionByRange(*place).sortWithinPartitions(*place).select("row", "sign", "order")
    found = arrow_batches(sorted_rows).mapInArrow(compare, "a long, link long")
    nearest = found.groupBy("a").agg(F.max("link").bitwiseAND((1 << ROW_BITS) - 1).alias("b"))
    groups = roots(stored(nearest, "nearest"))
    labelled = signed.join(groups, signed["row"] == groups["node"], "left").select(
        "row", F.coalesce("label", "row").alias("label"), "sign"
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            shard = (part << 24) + (at + np.arange(batch.num_rows)) // SHARD
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(shard, pa.int64())], names=["row", "shard"])

    # parts of several shards each, as the last shard of a part is not full
    parts = min(max(1, total // (8 * SHARD)), MOST_PARTS)
    place = ["label", "sign", "row"]
    dealt = stored(labelled, "labels").repartitionByRange(parts, *place).sortWithinPartitions(*place).select("row")
    return stored(arrow_batches(dealt).mapInArrow(deal, "row long, shard long"), "shards")


class Index:
    """BM25 inverted index of a shard: for each token id the rests that hold it, with their weights."""

    def __init__(self, rests: list[np.ndarray], counts: np.ndarray, total: int, mean: float):
        number = np.repeat(np.arange(len(rests)), [len(r) for r in rests])
        pairs, times = np.unique(
            np.concatenate([*rests, np.empty(0, "<u4")]).astype(np.int64) * len(rests) + number, return_counts=True
        )
        token, self.rest = np.divmod(pairs, max(1, len(rests)))
        length = np.array([len(r) for r in rests], float)
        idf = np.log1p((total - counts[token] + 0.5) / (counts[token] + 0.5))
        norm = K1 * (1 - B + B * length[self.rest] / mean) if len(pairs) else np.empty(0)
        self.weight = idf * times * (K1 + 1) / (times + norm)
        self.size = len(rests)
        self.first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.empty(0, np.int64)
        self.end = np.r_[self.first[1:], len(token)]
        place = np.cumsum(np.r_[True, token[1:] != token[:-1]]) - 1 if len(token) else token
        common = (self.end - self.first) * COMMON_ONE_IN >= max(1, len(rests))
        # scores by the common terms of a seed, of all rests at once
        often = np.flatnonzero(common[place])
        matrix = np.zeros((int(common.sum()), len(rests)))
        matrix[(np.cumsum(common) - 1)[place[often]], self.rest[often]] = self.weight[often]
        self.score = (matrix > 0).T.astype(float) @ matrix
        # each rest's other terms; rests of a shard have small numbers, which numpy sorts in one pass
        other = np.flatnonzero(~common[place])
        holders = self.rest[other]
        order = np.argsort(holders.astype(np.uint16) if len(rests) <= 1 << 16 else holders, kind="stable")
        starts = np.searchsorted(holders[order], np.arange(len(rests) + 1))
        self.terms = [place[other[order[s:e]]] for s, e in zip(starts[:-1], starts[1:], strict=True)]

    def scores(self, seed: int) -> np.ndarray:
        """The score of each rest over all terms of the seed."""
        terms = self.terms[seed]
        if not len(terms):
            return self.score[seed]
        sizes = self.end[terms] - self.first[terms]
        ends = np.cumsum(sizes)
        at = np.repeat(self.first[terms] - ends + sizes, sizes) + np.arange(ends[-1])
        return self.score[seed] + np.bincount(self.rest[at], self.weight[at], minlength=self.size)

    def neighbours(self, seed: int, unused: np.ndarray | bool = True) -> np.ndarray:
        """Unused rests that share a term with the seed, by descending score over all its terms, then by place."""
        score = self.scores(seed)
        found = np.flatnonzero((score > 0) & unused)
        return found[np.argsort(-score[found], kind="stable")]


def fill(lengths: np.ndarray, scores: Callable[[int], np.ndarray]) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (rest, from, length). All are full but the last one, if need be.

    The best neighbour that fits is looked up for each place, which costs less than to sort all neighbours of a seed.
    """
    left, done = lengths.astype(np.int64).copy(), np.zeros(len(lengths), np.int64)
    order = np.argsort(-left, kind="stable")
    for seed in order:
        if not left[seed]:
            continue
        window: list[tuple[int, int, int]] = []
        room = WINDOW

        def place(rest: int) -> None:
            nonlocal room
            take = min(int(left[rest]), room)
            window.append((int(rest), int(done[rest]), take))
            done[rest] += take
            left[rest] -= take
            room -= take

        place(seed)
        if room:
            score = np.where(left > 0, scores(int(seed)), 0)
        while room:
            fits = np.where(left <= room, score, 0)
            best = int(fits.argmax())
            if not fits[best] > 0:
                best = int(score.argmax())
            if not score[best] > 0:
                break
            place(best)
            score[best] = 0
        candidates = order
        while room and len(candidates):
            candidates = candidates[left[candidates] > 0]
            fits = candidates[left[candidates] <= room]
            if len(fits):
                place(fits[0])
            elif len(candidates):
                place(candidates[0])
        yield window


def _powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A window cut into such whose lengths are powers of two."""
    total = sum(length for _, _, length in window)
    pieces = list(window)
    for bit in reversed(range(total.bit_length())):
        room, made = total & (1 << bit), []
        while room:
            rest, start, length = pieces.pop(0)
            take = min(length, room)
            made.append((rest, start, take))
            room -= take
            if take < length:
                pieces.insert(0, (rest, start + take, length - take))
        if made:
            yield made


def pack(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of the packed sequences.

    ``ids`` are little-endian unsigned 32-bit integers. Only rests are shuffled, and their minhashes; a shard
    has two thousand of them at most, each shorter than a window, whatever the documents are like.
    """
    tokens = tokenized(docs, tokenizer, id_column, text)
    kind = tokens.schema["id"].dataType.simpleString()
    counts = document_counts(tokens)
    rests = tokens.where("rest IS NOT NULL").select("row", "id", "n", "rest")
    total, mean = rests.agg(F.count(F.lit(1)), F.avg(F.col("n") % WINDOW)).first()
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, n, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = _wide(value)
            for start in range(0, len(ids), WINDOW):
                rows.append((i, start, WINDOW, ids[start : start + WINDOW].tobytes(), n, 0, 0))
        return pa.RecordBatch.from_arrays(_columns(rows, batch.schema.field(0).type), names=_NAMES)

    def shard(key: tuple, group: pa.Table) -> pa.Table:
        all_ids = [_wide(v) for v in group.column("rest").to_pylist()]
        names, whole = group.column("id").to_pylist(), group.column("n").to_pylist()
        index = Index(all_ids, shared.value, total, mean)
        windows = list(fill(np.array([len(r) for r in all_ids]), index.scores))
        if windows and sum(p[2] for p in windows[-1]) < WINDOW:
            windows += _powers(windows.pop())
        rows = []
        for number, window in enumerate(windows):
            offset = 0
            for rest, start, length in window:
                base = whole[rest] - len(all_ids[rest])
                ids = all_ids[rest][start : start + length]
                sequence = (1 << 62) + (key[0].as_py() << SHARD_BITS) + number
                rows.append((names[rest], base + start, length, ids.tobytes(), whole[rest], sequence, offset))
                offset += length
        return pa.Table.from_arrays(_columns(rows, group.schema.field("id").type), names=_NAMES)

    schema = f"id {kind}, {PIECES}"
    full = arrow_rows(tokens.where("blocks IS NOT NULL").select("id", "n", "blocks"), blocks, schema).withColumn(
        "sequence_id", F.monotonically_increasing_id()
    )

    if total > SHARD:
        dealt = rests.join(small(shards_by_content(rests, counts, total)), "row").drop("row")
    else:
        dealt = rests.drop("row").withColumn("shard", F.lit(0).cast("long"))
    packed = dealt.groupBy("shard").applyInArrow(shard, schema)
    return full.unionByName(packed).withColumnRenamed("id", id_column)


_NAMES = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _columns(rows: list[tuple], kind: pa.DataType) -> list[pa.Array]:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    kinds = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
