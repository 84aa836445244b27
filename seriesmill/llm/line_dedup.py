"""Removal of repeated line chunks with content-defined boundaries, and of long repeated passages.

A text is split at "\\n". A rolling hash over the hashes of the last two lines chooses where a chunk
ends, so that an inserted line moves the boundaries near it only. Lines of 50 words or more are chunks
of their own. A chunk counts if it has two lines or more, or 50 words. Beside the chunks, every run of
consecutive lines counts that reaches 50 words and has no line to spare at its end, or none at its start:
whatever passage of 50 words or more occurs again, such runs cover all its lines, whatever stands around it.
Of the chunks and runs with the same bytes in the whole table the first by (doc_id, hash of the text,
place) stays; the lines of the others are removed with their line breaks, after a comparison of bytes with
the first. A line that goes so has an equal one at an earlier place, and the earliest of these stays.

Defined cases: null and empty texts stay as they are, and so does a row with a null doc_id but for its
repeated chunks. Rows that repeat both doc_id and text count as one document and keep the same lines.
A document whose chunks all go stays with an empty text. Other columns are passed through.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.llm.common import arrow_rows, documents_only, free_name, stored

WINDOW = 2
#: One boundary in so many lines, beyond the least length of a chunk.
DIVISOR = 2
LEAST_LINES = 2
LONG_WORDS = 50
_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def bounds(lines: list[bytes]) -> list[tuple[int, int]]:
    """First line and end of each chunk."""
    found, start = [], 0
    recent: list[int] = []
    for i, line in enumerate(lines):
        if len(line) > 2 * LONG_WORDS - 2 and len(line.split()) >= LONG_WORDS:
            if i > start:
                found.append((start, i))
            found.append((i, i + 1))
            start, recent = i + 1, []
            continue
        recent = [*recent[-WINDOW + 1 :], xxhash.xxh3_64_intdigest(line)]
        rolling = 0
        for value in recent:
            rolling = (rolling * _FACTOR + value) & _MASK
        if i + 1 - start >= LEAST_LINES and ((rolling * _FACTOR) & _MASK) >> 40 & 0xFFFF < 0x10000 // DIVISOR:
            found.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        found.append((start, len(lines)))
    return found


def _lines(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split(b"\n")


def runs(words: list[int]) -> set[tuple[int, int]]:
    """The shortest run of LONG_WORDS words or more from each line on, and up to each line.

    ``words`` are the numbers of words of the lines.
    """
    before = [0, *accumulate(words)]
    made, start = set(), 0
    for end in range(1, len(before)):
        # the runs from these lines on need the line before ``end``
        while before[end] - before[start] >= LONG_WORDS:
            made.add((start, end))
            start += 1
        if start and before[end] - before[start - 1] >= LONG_WORDS:
            made.add((start - 1, end))
    return made


def spans(lines: list[bytes]) -> list[tuple[int, int]]:
    """First line and end of each chunk that counts and of each run, by place."""
    words = [len(line.split()) for line in lines]
    before = [0, *accumulate(words)]
    made = runs(words)
    for start, end in bounds(lines):
        n = before[end] - before[start]
        if n and (end - start >= LEAST_LINES or n >= LONG_WORDS):
            made.add((start, end))
    return sorted(made)


def chunks(text: str | None) -> list[tuple[int, bytes]]:
    """Number and bytes of each chunk that counts and of each run. The number holds first line and end."""
    if not text:
        return []
    lines = _lines(text)
    return [(start << 32 | end, b"\n".join(lines[start:end])) for start, end in spans(lines)]


_PRIME = (1 << 127) - 1
_BASE = 0x9E3779B97F4A7C15F39CC0605CEDC835 % _PRIME
_powers = [1]


def digests(text: str | None) -> list[tuple[int, bytes]]:
    """Number and digest of each chunk that counts and of each run.

    The digest is a rolling hash over the hashes of the lines, so that its cost is that of the lines, however
    many of them a run needs to reach its words.
    """
    if not text:
        return []
    lines = _lines(text)
    found = spans(lines)
    if not found:
        return []
    while len(_powers) <= len(lines):
        _powers.append(_powers[-1] * _BASE % _PRIME)
    sums = [0]
    for line in lines:
        sums.append((sums[-1] * _BASE + xxhash.xxh3_128_intdigest(line) + 1) % _PRIME)
    return [
        (start << 32 | end, ((sums[end] - sums[start] * _powers[end - start]) % _PRIME).to_bytes(16, "little"))
        for start, end in found
    ]


def without(text: str, numbers: set[int]) -> tuple[str, int, int]:
    """The text without the lines of these numbers, how many lines went, and from how many chunks."""
    lines = _lines(text)
    gone, at = bytearray(len(lines)), 0
    for number in sorted(numbers):
        start, end = max(number >> 32, at), number & 0xFFFFFFFF
        if end > start:
            gone[start:end] = b"\1" * (end - start)
            at = end
    left = [line for line, g in zip(lines, gone, strict=True) if not g]
    cut = sum(gone.find(1, start, end) >= 0 for start, end in bounds(lines))
    return b"\n".join(left).decode("utf-8", "surrogatepass"), sum(gone), cut


def cover(places: list[dict]) -> list[dict]:
    """Few of these places that have the lines of all of them; a line is part of two at most."""
    made: list[dict] = []
    best, reach = None, 0
    for place in sorted(places, key=lambda p: p["number"]):
        start, end = place["number"] >> 32, place["number"] & 0xFFFFFFFF
        if best is not None and start > reach:
            made.append(best)
            best, reach = None, best["number"] & 0xFFFFFFFF
        if best is None:
            reach = max(reach, start)
        if end > reach and (best is None or end > best["number"] & 0xFFFFFFFF):
            best = place
    return made if best is None else [*made, best]


_PLACE = "number long, digest binary"
_OCCURRENCE = "id string, hash long, number long, digest binary, first boolean, part binary"


def _chunk_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, hashes, texts = (c.to_pylist() for c in batch.columns)
    rows = [
        (i, h, number, digest)
        for i, h, text in zip(ids, hashes, texts, strict=True)
        for number, digest in digests(text)
    ]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "hash", "number", "digest"])


def _cover_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    places = pa.array([cover(p) for p in batch.column("places").to_pylist()], batch.schema.field("places").type)
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), places], names=["id", "hash", "places"])


def _parts(text: str, places: list[dict]) -> list[tuple[int, bytes, bool, bytes]]:
    lines = _lines(text)
    return [
        (p["number"], p["digest"], p["first"], b"\n".join(lines[p["number"] >> 32 : p["number"] & 0xFFFFFFFF]))
        for p in places
    ]


_MARKED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("lines", T.LongType()), T.StructField("chunks", T.LongType())]
)


def remove_repeated_chunks(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", counts: tuple[str, str] | None = None
) -> DataFrame:
    """The documents with repeated chunks and passages removed, in the columns they have.

    ``counts`` names two more columns for the numbers of chunks that lost lines and of lines removed.

    What is shuffled: a digest for each chunk and run, the text of each document once, and the text of as many
    repeated ones as cover the lines that go, with that of their firsts. A chunk that a third of all documents share is one row of the
    pre-aggregated digests; the join that looks its occurrences up can be split by adaptive execution.
    """
    key = F.col(f"`{id_column}`")
    keyed = documents_only(docs, id_column, text).select(
        key.alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("hash"), F.col(f"`{text}`").alias("text")
    )
    kind = docs.schema[id_column].dataType.simpleString()
    found = stored(arrow_rows(keyed, _chunk_rows, f"id {kind}, hash long, {_PLACE}"), "chunks")
    place = F.struct("id", "hash", "number")
    repeated = (
        found.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
        .where("n > 1")
        .select("digest", "at")
    )
    again = (
        found.join(repeated, "digest")
        .where(~place.eqNullSafe(F.col("at")))
        .groupBy("id", "hash")
        .agg(F.collect_set(F.struct("number", "digest", "at")).alias("places"))
    )
    again = stored(arrow_rows(again, _cover_rows, again.schema), "repeated").select("id", "hash", F.inline("places"))
    needed = again.groupBy("digest").agg(F.min("at").alias("at")).select("at.*", "digest", F.lit(True).alias("first"))
    occurrences = (
        again.select(*needed.columns[:4], F.lit(False).alias("first"))
        .unionByName(needed)
        .groupBy("id", "hash")
        .agg(F.collect_set(F.struct("number", "digest", "first")).alias("places"))
    )
    names = {n: free_name(docs, n) for n in ("text_hash", "removed", "cut")}
    hashed = docs.withColumn(names["text_hash"], F.xxhash64(F.col(f"`{text}`")))

    def beside(rows: DataFrame, how: str) -> DataFrame:
        on = hashed[names["text_hash"]].eqNullSafe(rows["hash"]) & hashed[id_column].eqNullSafe(rows["id"])
        return hashed.join(rows, on, how)

    def texts_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("id", "hash", "text", "places")]
        rows = [
            (i, h, *part) for i, h, t, places in zip(*columns, strict=True) for part in _parts(t, places)
        ]
        made = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (batch.column("id").type, pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.binary())
        arrays = [pa.array(list(c), k) for c, k in zip(made, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "hash", "number", "digest", "first", "part"])

    # All columns go along, so that both joins read one and the same shuffle of the documents.
    parts = arrow_rows(
        _unclashed(beside(occurrences, "inner"), docs, occurrences, text),
        texts_of,
        _OCCURRENCE.replace("id string", f"id {kind}"),
    )
    firsts = parts.where("first").groupBy("digest").agg(F.max("part").alias("kept_part"))
    removed = (
        parts.where(~F.col("first"))
        .join(firsts, "digest")
        .where(F.col("part") == F.col("kept_part"))
        .groupBy("id", "hash")
        .agg(F.collect_set("number").alias("numbers"))
    )
    joined = beside(removed, "left").select(
        *(docs[f"`{c}`"] for c in docs.columns), removed["numbers"].alias(names["removed"])
    )

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, numbers = batch.column(text).to_pylist(), batch.column(names["removed"]).to_pylist()
        made = [(t, 0, 0) if not n else without(t, set(n)) for t, n in zip(texts, numbers, strict=True)]
        struct = pa.StructArray.from_arrays(
            [pa.array([m[i] for m in made], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["text", "lines", "chunks"],
        )
        return pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, names["cut"]])

    schema = T.StructType([*joined.schema.fields, T.StructField(names["cut"], _MARKED)])
    rows = arrow_rows(joined, cut, schema)
    columns = [
        F.col(f"`{names['cut']}`.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
    ]
    if counts:
        columns += [
            F.col(f"`{names['cut']}`.chunks").alias(counts[0]),
            F.col(f"`{names['cut']}`.lines").alias(counts[1]),
        ]
    return rows.select(*columns)


def _unclashed(joined: DataFrame, docs: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """Places and text; the documents' other columns in one struct, so that names can't clash."""
    others = [docs[f"`{c}`"] for c in docs.columns if c != text]
    return joined.select(
        *(rows[c] for c in ("id", "hash", "places")), docs[f"`{text}`"].alias("text"), F.struct(*others).alias("other")
    )
