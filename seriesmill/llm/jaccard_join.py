"""Join of near-duplicate texts: Jaccard similarity of word shingles of 0.75 or more.

Shingles are hashed into groups, and the counts of a text's shingles in the groups are a point. The
overlap of two sets is at most the sum, over the groups, of the lesser count; the greatest counts below
two tree nodes bound every pair below them in the same way. An R-tree over the points so discards pairs
of subtrees, and what survives is verified on the whole sets.

Points alone don't separate texts of a corpus from each other (two unrelated texts of some hundred
shingles have similar counts), so the tree is not built over all texts at once, but over cells: texts
that share one of their first n - ceil(0.75 n) + 1 shingles in one order of all shingles. Two texts of
sufficient similarity share such a cell for certain, whatever the order. Shingles of rare words come first
in it, as those of common words are shared by chance, and frequent shingles come last, so that a passage
that many texts hold makes no cell for most of them.

Within a cell, texts are first compared with one pivot; only pairs that these links don't already connect
go to the tree. So a group of copies costs links in proportion to its size, not to its square, and
no link between two components is lost. Texts with equal sets are one representative throughout.

What the tree lets pass meets a second bound on points of two groups a shingle or more, of which only the parity
of each count is kept: sets differ by at least as many shingles as there are groups of different parity.
It rules out most pairs of texts that hold the same passage, or are remote copies of one text.

Defined cases: a null or empty text, or one without words, has no shingles and is linked with nothing; so
is a row with a null doc_id, whose component is null. Fewer than five words are one shingle, the whole
sequence. Rows that share a doc_id share its component. The doc_id is of a whole-number type; another one is
refused. Other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seriesmill.llm.common import arrow_batches, arrow_rows, documents_only, free_name, small, stored
from seriesmill.llm.components import components
from seriesmill.llm.hashing import MIX, Text

SHINGLE = 5
GROUPS = 256
#: Shingles that come last in the order: so many at most, and each this often. Any list gives the same
#: links; a better one gives smaller cells.
FREQUENT, OFTEN = 500_000, 24
#: Shingles of different texts that a task counts together; those it sees three times are reported.
COUNTED = 4_000_000
#: Words that count as common: so many at most, and each this often in a task's count.
COMMON, COMMON_OFTEN = 4096, 200
#: Entries of a cell bucket, on average.
BUCKET = 250_000
#: Parts into which the cells of frequent shingles are dealt before their members are compared.
SALTS = 16
#: Star rounds before the tree, and texts of a block of a cell that the tree takes at once.
STARS, BLOCK = 2, 2000
#: Ids that are broadcast to pick the texts to verify; with more, documents are joined.
BROADCAST_IDS = 1_000_000
#: Bits of the tables that tell common words and frequent shingles.
TABLE_BITS = 23

_ENTRY = np.dtype([("key", "<i8"), ("twin", "<i8")])
#: The greatest count that a point holds, four bits each; it stands for any number from there.
_MOST = 15


def _hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text's words, and of its shingles in their order."""
    words = Text((text or "").encode("utf-8", "surrogatepass").lower()).word_hashes()
    if not len(words):
        return words, words
    size = min(SHINGLE, len(words))
    end = len(words) - size + 1
    made = words[:end] + np.uint64(size)
    for i in range(1, size):
        made *= MIX
        made ^= made >> np.uint64(29)
        made += words[i : end + i]
    made *= MIX
    made ^= made >> np.uint64(32)
    return words, made


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashed shingles of a text in ascending order."""
    return np.unique(_hashed(text)[1])


def table_of(values: np.ndarray) -> np.ndarray:
    """Marks, a bit each, for the lower bits of some hashes. Others with the same bits are taken for them."""
    marks = np.zeros(1 << TABLE_BITS, bool)
    marks[(values & np.uint64(len(marks) - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little")


def _marked(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    low = (values & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
    return (table[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


def ranked(text: str | None, common: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles in ascending order, and the first of them in the order for cells.

    ``common`` words and ``frequent`` shingles are tables of marks.
    """
    words, made = _hashed(text)
    values, first = np.unique(made, return_index=True)
    n = len(values)
    rank = np.zeros(n, np.int8)
    if len(words) >= SHINGLE:
        often = np.concatenate([[0], np.cumsum(_marked(words, common))])
        rank += (often[first + SHINGLE] - often[first]).astype(np.int8)
    rank[_marked(values, frequent)] += SHINGLE + 1
    length = n - (3 * n + 3) // 4 + 1
    return values, values[np.argsort(rank, kind="stable")[:length]]


def digest(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def point(values: np.ndarray) -> np.ndarray:
    """Number of shingles in each group, two groups to a byte.

    Long texts have more groups, so that these hold four shingles on average. Groups are ranges of the
    hash, so that neighbouring ones add up to those of a shorter text.
    """
    bits = max(GROUPS, len(values) // 4).bit_length() - 1
    counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    held = np.minimum(counts, _MOST).astype(np.uint8)
    return held[::2] | (held[1::2] << 4)


def _folded(packed: bytes) -> np.ndarray:
    both = np.frombuffer(packed, np.uint8)
    made = np.stack([both & _MOST, both >> 4], axis=1).astype(np.int32)
    made[made == _MOST] = 1 << 22
    return made.reshape(GROUPS, -1).sum(axis=1)


def _points(packed: list[bytes]) -> np.ndarray:
    return np.stack([_folded(p) for p in packed]) if packed else np.empty((0, GROUPS), np.int32)


def parities(values: np.ndarray) -> np.ndarray:
    """A bit for each of two groups a shingle or more: whether their shingles are odd in number."""
    groups = 1 << max(8, (2 * len(values) - 1).bit_length())
    counts = np.bincount((values & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.packbits(counts & 1, bitorder="little")


def _halved(bits: np.ndarray, size: int) -> np.ndarray:
    """Parities of the fewer groups that have ``size`` bytes; groups are lower bits of the hash."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0) if len(bits) > size else bits


def parity_allows(a: list[bytes], b: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Whether each pair of texts may differ by as few shingles as is needed; ``sizes`` are of both sets together."""
    least = np.minimum(np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b)))
    allowed = np.zeros(len(a), bool)
    for size in np.unique(least).tolist():
        at = np.flatnonzero(least == size)
        for part in np.array_split(at, -(-len(at) * size // (1 << 24)) or 1):
            x, y = (
                np.stack([_halved(np.frombuffer(side[i], np.uint8), size) for i in part.tolist()]) for side in (a, b)
            )
            different = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            allowed[part] = 7 * different <= sizes[part]
    return allowed


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


# --- R-tree -------------------------------------------------------------------

_LEAF, _FAN = 16, 8
#: Pairs up to which all are bounded without a tree.
_DIRECT = 4096


def _ordered(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions, so that neighbours are alike: halved again and again along the widest coordinate."""
    features = np.column_stack([sizes, points])
    made: list[np.ndarray] = []
    todo = [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= _LEAF:
            made.append(part)
            continue
        spread = np.ptp(features[part], axis=0)
        part = part[np.argsort(features[part, int(spread.argmax())], kind="stable")]
        half = -(-len(part) // (2 * _LEAF)) * _LEAF
        todo += [part[half:], part[:half]]
    return np.concatenate(made) if made else np.empty(0, np.int64)


def _levels(points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(greatest counts, least and greatest size) per node, from the points up to one node."""
    levels = [(points, sizes, sizes)]
    while len(levels[-1][1]) > 1:
        top, low, high = levels[-1]
        starts = np.arange(0, len(low), _LEAF if len(levels) == 1 else _FAN)
        levels.append(
            (np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts))
        )
    return levels


def _possible(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a pair below nodes i and j can have the similarity."""
    keep = (4 * a[2][i] >= 3 * b[1][j]) & (4 * b[2][j] >= 3 * a[1][i])
    at = np.flatnonzero(keep)
    for part in np.array_split(at, max(1, len(at) // 8_000)):
        most = np.minimum(a[0][i[part]], b[0][j[part]]).sum(axis=1, dtype=np.int64)
        keep[part] = 7 * most >= 3 * (a[1][i[part]].astype(np.int64) + b[1][j[part]])
    return keep


def _children(level: int, nodes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Child positions of each node, and for each child the place of its node in ``nodes``."""
    fan = _LEAF if level == 1 else _FAN
    first = nodes * fan
    number = np.minimum(first + fan, count) - first
    place = np.repeat(np.arange(len(nodes)), number)
    offset = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return first[place] + offset, place


def tree_pairs(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in the tables a and b of (points, sizes) that the bound lets pass, in batches."""
    if len(a[1]) * len(b[1]) <= _DIRECT:  # a single node on either side
        i, j = np.divmod(np.arange(len(a[1]) * len(b[1])), max(1, len(b[1])))
        keep = _possible((a[0], a[1], a[1]), (b[0], b[1], b[1]), i, j)
        yield i[keep], j[keep]
        return
    orders = [_ordered(*side) for side in (a, b)]
    trees = [_levels(side[0][o], side[1][o]) for side, o in zip((a, b), orders, strict=True)]
    tops = [len(t) - 1 for t in trees]
    todo = [(tops[0], tops[1], np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        la, lb, i, j = todo.pop()
        keep = _possible(trees[0][la], trees[1][lb], i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == lb == 0:
            yield orders[0][i], orders[1][j]
            continue
        for part in np.array_split(np.arange(len(i)), max(1, len(i) // 4096)):
            if la >= lb:
                down, place = _children(la, i[part], len(trees[0][la - 1][1]))
                todo.append((la - 1, lb, down, j[part][place]))
            else:
                down, place = _children(lb, j[part], len(trees[1][lb - 1][1]))
                todo.append((la, lb - 1, i[part][place], down))


# --- on Spark -----------------------------------------------------------------

_SCANNED = "id long, n int, twin long, digest binary, point binary, parity binary, shingle long, word long, times long"
_SCANNED_NAMES = ["id", "n", "twin", "digest", "point", "parity", "shingle", "word", "times"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and one for each shingle or word that is frequent within the task."""
    held, words, seen, size = [], [], set(), 0
    for batch in batches:
        hashed = [_hashed(t) for t in batch.column(1).to_pylist()]
        sets = [np.unique(made) for _, made in hashed]
        digests = [digest(s) if len(s) else None for s in sets]
        blank = [None] * len(sets)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column(0).to_pylist(), pa.int64()),
                pa.array(map(len, sets), pa.int32()),
                pa.array([_twin(d) if d else None for d in digests], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([point(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([parities(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                *(pa.array(blank, pa.int64()) for _ in range(3)),
            ],
            names=_SCANNED_NAMES,
        )
        for d, values, (own, _) in zip(digests, sets, hashed, strict=True):
            if d and d not in seen:
                seen.add(d)
                held.append(values)
                words.append(own)
                size += len(values)
            if size >= COUNTED:
                yield _frequent(held, 3, "shingle")
                yield _frequent(words, COMMON_OFTEN, "word")
                held, words, seen, size = [], [], set(), 0
    yield _frequent(held, 3, "shingle")
    yield _frequent(words, min(COMMON_OFTEN, 3 + size // 10_000), "word")


def _frequent(sets: list[np.ndarray], least: int, column: str) -> pa.RecordBatch:
    values, times = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
    often = times >= least
    n = int(often.sum())
    kinds = (pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3, *[pa.int64()] * 3)
    made = dict(zip(_SCANNED_NAMES, (pa.nulls(n, kind) for kind in kinds), strict=True))
    made |= {column: pa.array(values[often].view(np.int64)), "times": pa.array(times[often].astype(np.int64))}
    return pa.RecordBatch.from_arrays(list(made.values()), names=_SCANNED_NAMES)


def _twin(value: bytes) -> int:
    return int.from_bytes(value[:8], "little", signed=True)


def _cells(docs: DataFrame, common: np.ndarray, frequent: np.ndarray, buckets: int) -> DataFrame:
    """(key, twin): the members of cells with two members or more.

    ``twin`` is the head of a text's digest; should two sets share one, both are looked at. Members meet
    as packed entries in hash buckets. Cells of frequent shingles are dealt to SALTS parts each.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table_of(common), table_of(frequent)))

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        usual, late = shared.value
        entries = []
        for text in batch.column(0).to_pylist():
            values, keys = ranked(text, usual, late)
            if len(values):
                made = np.empty(len(keys), _ENTRY)
                made["key"], made["twin"] = keys.view(np.int64), _twin(digest(values))
                entries.append(made)
        if not entries:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], ["bucket", "entries"])
        rows = np.unique(np.concatenate(entries))
        spread = (rows["key"].view(np.uint64) * MIX) >> np.uint64(20)
        bucket = (spread % np.uint64(buckets)).astype(np.int64)
        hot = _marked(rows["key"].view(np.uint64), late)
        bucket[hot] += buckets * (1 + (rows["twin"][hot] & (SALTS - 1)))
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        parts = np.split(rows, starts[1:])
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts]), pa.array([p.tobytes() for p in parts], pa.binary())], names=["bucket", "entries"]
        )

    def members(key: tuple, dealt: pa.Table) -> pa.Table:
        rows = np.unique(np.frombuffer(b"".join(dealt.column("entries").to_pylist()), _ENTRY))
        # parts of a dealt cell may have a single member here, and others elsewhere
        if len(rows) and key[0].as_py() < buckets:
            cell = np.cumsum(np.r_[True, rows["key"][1:] != rows["key"][:-1]]) - 1
            rows = rows[np.bincount(cell)[cell] > 1]
        return pa.table({"key": rows["key"].copy(), "twin": rows["twin"].copy()})

    dealt = arrow_rows(documents_only(docs, "text"), deal, "bucket long, entries binary")
    return dealt.groupBy("bucket").applyInArrow(members, "key long, twin long")


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, shingles) of the wanted (id, digest) texts."""
    ids = wanted.select("id").distinct()
    some = ids.limit(BROADCAST_IDS + 1).count()
    picked = docs.join(F.broadcast(ids) if some <= BROADCAST_IDS else ids, "id", "left_semi")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shingles(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([digest(s) for s in made], pa.binary()), pa.array([s.tobytes() for s in made], pa.binary())],
            names=["digest", "shingles"],
        )

    found = arrow_rows(picked.select("id", "text"), sets, "digest binary, shingles binary")
    return found.join(wanted.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, da, db) whose sets are similar, as (a, b)."""

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (batch.column(c).to_pylist() for c in ("sa", "sb"))
        good = [
            linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right, strict=True)
        ]
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = (
        pairs.join(sets.select(F.col("digest").alias("da"), F.col("shingles").alias("sa")), "da")
        .join(sets.select(F.col("digest").alias("db"), F.col("shingles").alias("sb")), "db")
        .select("a", "b", "sa", "sb")
    )
    return arrow_rows(both, test, "a long, b long")


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, na, da, b, nb, db) that the parities of their counts let pass."""

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
        keep = parity_allows(*(batch.column(c).to_pylist() for c in ("pa", "pb")), sizes)
        return batch.select(["a", "da", "b", "db"]).filter(pa.array(keep))

    both = (
        pairs.join(points.select(F.col("digest").alias("da"), F.col("parity").alias("pa")), "da")
        .join(points.select(F.col("digest").alias("db"), F.col("parity").alias("pb")), "db")
        .select("a", "da", "na", "b", "db", "nb", "pa", "pb")
    )
    return arrow_rows(both, test, "a long, da binary, b long, db binary")


def _new_sets(docs: DataFrame, pairs: DataFrame, before: DataFrame | None) -> DataFrame:
    """The sets that the pairs need; those of ``before`` are not made again."""
    need = pairs.select(F.col("a").alias("id"), F.col("da").alias("digest")).union(pairs.select("b", "db")).distinct()
    if before is None:
        return stored(_sets_of(docs, need), "sets")
    more = stored(need.join(before.select("digest"), "digest", "left_anti"), "wanted")
    if more.isEmpty():
        return before
    return before.union(stored(_sets_of(docs, more), "sets"))


def _labelled(cells: DataFrame, heads: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members (key, id, digest, n, weight, label) of the cells (key, twin) that still have two components.

    Of cells with the same members one is kept: a passage makes a cell of each of its shingles.
    """
    labels = heads.withColumn("label", F.col("id"))
    if found is not None:
        labels = heads.join(found, heads["id"] == found["node"], "left").select(
            *heads.columns, F.coalesce("label", "id").alias("label")
        )
    split = (
        cells.join(labels.select("twin", "label"), "twin")
        .groupBy("key")
        .agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("twin")).alias("one"), F.bit_xor(F.xxhash64("twin", F.lit(1))).alias("other"),
        )
        .where("lo != hi").groupBy("members", "one", "other").agg(F.min("key").alias("key"))
    )
    return cells.join(split.select("key"), "key", "left_semi").join(labels, "twin")


def _pair(rows: DataFrame) -> DataFrame:
    """Distinct pairs of (a, da, na) with (b, db, nb) whose sizes allow the similarity, lesser id first."""
    rows = rows.where("a != b AND 4 * na >= 3 * nb AND 4 * nb >= 3 * na")
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x)
    names = ("a", "da", "na", "b", "db", "nb")
    return rows.select(*(pick(x, y) for x, y in zip(names, names[3:] + names[:3], strict=True))).distinct()


def _star(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of each cell's pivot with the members that have other labels.

    The pivot is the member with the greatest weight. Then the cells without their pivots, all of whose
    pairs are decided.
    """
    pivot = F.max(F.struct("weight", "digest", "id", "n", "label")).alias("p")
    rows = cells.join(cells.groupBy("key").agg(pivot), "key").where("digest != p.digest")
    pairs = rows.where("label != p.label").select(
        F.col("id").alias("a"), F.col("digest").alias("da"), F.col("n").alias("na"),
        F.col("p.id").alias("b"), F.col("p.digest").alias("db"), F.col("p.n").alias("nb"),
    )
    return _pair(pairs), rows.select("key", "twin")


def _tree_join(cells: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs with different labels within the cells that the R-tree can't rule out.

    A cell of more than BLOCK members is cut into blocks, and each pair of blocks is a group of its own.
    Groups meet in buckets, as most are small.
    """
    sized = cells.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK)
    buckets = max(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells.count() // BLOCK)
    rows = (
        cells.join(sized, "key")
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"),
            "id", "digest", "n", "label",
        )
        .withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets)))
        .join(points, "digest")
    )

    def pairs(_: tuple, dealt: pa.Table) -> pa.Table:
        at = {c: dealt.column(c).to_numpy() for c in ("key", "i", "j", "id", "n", "label", "left", "right")}
        digests = dealt.column("digest").to_pylist()
        packed, parity = (dealt.column(c).to_pylist() for c in ("point", "parity"))
        order = np.lexsort((at["j"], at["i"], at["key"]))
        new = np.zeros(len(order), bool)
        for c in ("key", "i", "j"):
            new[1:] |= at[c][order][1:] != at[c][order][:-1]
        sides_of: list[tuple[np.ndarray, np.ndarray]] = []
        for group in np.split(order, np.flatnonzero(new)):
            vectors = _points([packed[g] for g in group])
            sides = [np.flatnonzero(at[c][group]) for c in ("left", "right")]
            same = at["i"][group[0]] == at["j"][group[0]]
            for x, y in tree_pairs(*((vectors[s], at["n"][group[s]]) for s in sides)):
                x, y = group[sides[0][x]], group[sides[1][y]]
                keep = at["label"][x] != at["label"][y]
                if same:
                    keep &= x < y
                x, y = x[keep], y[keep]
                sizes = at["n"][x].astype(np.int64) + at["n"][y]
                keep = parity_allows([parity[i] for i in x.tolist()], [parity[i] for i in y.tolist()], sizes)
                sides_of.append((x[keep], y[keep]))
        # once, however many cells of the bucket a pair shares
        codes: dict[bytes, int] = {}
        text_of = np.array([codes.setdefault(d, len(codes)) for d in digests], np.int64)
        found = np.concatenate([np.stack(p, axis=1) for p in sides_of] or [np.empty((0, 2), np.int64)])
        _, first = np.unique(np.sort(text_of[found], axis=1), axis=0, return_index=True)
        columns = []
        for place in found[first].T:
            columns += [at["id"][place], [digests[i] for i in place.tolist()], at["n"][place]]
        kinds = (pa.int64(), pa.binary(), pa.int32()) * 2
        names = ("a", "da", "na", "b", "db", "nb")
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    schema = "a long, da binary, na int, b long, db binary, nb int"
    return _pair(rows.groupBy("bucket").applyInArrow(pairs, schema))


def _most(scanned: DataFrame, column: str, least: int, most: int) -> np.ndarray:
    """The values seen most often, at most ``most`` of them, sorted."""
    counts = scanned.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("times").alias("times"))
    rows = counts.where(F.col("times") >= least).orderBy(F.desc("times"), column).limit(most).select(column)
    return np.sort(rows.toArrow().column(column).to_numpy().view(np.uint64))


def similar_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, representative): one row for each row of ``docs``.

    ``representative`` is the least doc_id with an equal set; ``component_id`` the least that links reach.
    """
    spark: SparkSession = docs.sparkSession
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        raise ValueError(f"{id_column} is no whole number")
    rows = documents_only(docs, id_column, text).toDF("id", "text").withColumn("id", F.col("id").cast("long"))
    scanned = stored(arrow_batches(rows).mapInArrow(_scan, _SCANNED), "shingles")
    texts = scanned.where("n IS NOT NULL").select("id", "n", "twin", "digest", "point", "parity")
    late = _most(scanned, "shingle", OFTEN, FREQUENT)
    usual = _most(scanned, "word", COMMON_OFTEN, COMMON)
    total = texts.agg(F.sum("n")).first()[0] or 0
    known = rows.where("id IS NOT NULL AND text IS NOT NULL")
    heads = stored(
        texts.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("twin", "n", "point", "parity"))),
        "heads",
    )
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * BUCKET)))
    cells = stored(_cells(known, usual, late, buckets), "cells")
    # A text that shares most of its cells is most likely the one that others were copied from.
    shares = cells.groupBy("twin").agg(F.count(F.lit(1)).alias("cells"))
    members = heads.join(shares, "twin").withColumn("weight", F.col("cells") / F.col("n"))
    members = stored(members.select("twin", "id", "digest", "n", "weight"), "members")
    points = heads.select("digest", "point", "parity")
    open_cells, sets, edges = cells, None, None
    for turn in range(STARS + 1):
        labels = None if edges is None else components(edges)
        if labels is not None:  # what they say stands for the links so far
            edges = labels.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        labelled = stored(_labelled(open_cells, members, labels), "open")
        if labelled.isEmpty():
            break
        if turn < STARS:
            found, open_cells = _star(labelled)
            found = _bounded(found, points)
        else:
            found = _tree_join(labelled, points)
        pairs = stored(found, "pairs")
        if not pairs.isEmpty():
            sets = _new_sets(known, pairs, sets)
            links = stored(_verified(pairs, sets), "links")
            edges = links if edges is None else edges.union(links)
    # rows with one doc_id and several texts tie the heads of these together
    headed = texts.where("id IS NOT NULL").join(heads.select("digest", F.col("id").alias("a")), "digest").select("id", "a")
    least = headed.groupBy("id").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b != most")
    ties = headed.join(least, "id").select("a", "b")
    labels = components(ties if edges is None else edges.union(ties))
    named = heads.join(labels, heads["id"] == labels["node"], "left").select(
        "digest", F.col("id").alias("head"), F.coalesce("label", "id").alias("label")
    )
    full = texts.join(named, "digest", "left")
    return full.select(
        F.col("id").alias(id_column),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("head", "id")).alias("representative"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the least doc_id of their components, in the columns they have.

    Of rows that repeat this doc_id one stays, too. Rows that are linked with nothing stay.
    """
    found = similar_texts(docs, id_column, text)
    gone = stored(
        found.where(F.col("component_id") != F.col(id_column)).select(F.col(id_column).alias("gone")).distinct(), "gone"
    )
    rows = docs.join(small(gone), docs[id_column] == gone["gone"], "left_anti")
    repeated = stored(rows.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("i")).count().where("count > 1"), "repeated")
    if repeated.isEmpty():
        return rows
    number, own = free_name(docs, "number"), Window.partitionBy(id_column).orderBy(F.xxhash64(F.col(f"`{text}`")))
    alone = rows.join(repeated, rows[id_column] == repeated["i"], "left_anti")
    first = rows.join(repeated.select("i"), rows[id_column] == repeated["i"], "left_semi")
    return alone.union(first.withColumn(number, F.row_number().over(own)).where(F.col(number) == 1).drop(number))
