"""Groups of spelling variants among the words of a corpus, by pivotal grams.

A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, only A-Z in lower case. In one of ``SLIPS`` documents, by
the crc32 of ``<doc_id>:<run>``, a letter of the run is left out. Results of at least ``LEAST_LETTERS`` letters
and ``LEAST_TIMES`` occurrences are the words to compare; two are near if one inserted, deleted or replaced
letter tells them apart. The form of a word is its near word with the most occurrences (then the least), if
these are ``RATIO`` times its own at least; following forms to the last one gives its root.

Bigrams are ordered by their frequency among the words, rare ones first. The first three of a word and those
as frequent as the third are its prefix; they hold two that don't overlap, and dynamic programming picks
the pair with the least sum of frequencies as pivots. One edit leaves a pivot whole. If the prefix of word
r ends no later in the order than that of s, this pivot is in the prefix of s, at the same place or, where
the lengths differ and the edit is before it, one further. The edit lies on one side of the pivot, and there
in the nearer or the further half of the letters. So the index has, for each bigram of a prefix, its place
counted from the unchanged end of the word, the length, and the letters that stay the same in each of these
cases, which are at least half of the word; pivots are looked up for the three possible lengths, and what is
found is verified by the edit distance.

The index has a fixed number of rows for each word, and a word has at most as many links as there are words
one edit away, so no group grows with the table; a cell that many words share is split by adaptive execution.

Defined cases: null texts have no words; a null doc_id is the empty string in the crc32; repeated rows
count each; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import arrow_batches, arrow_rows, documents_only, stored

SLIPS, LEAST_LETTERS, LEAST_TIMES, RATIO = 31, 7, 2, 10
#: Bigrams of a prefix, but for equally frequent ones: two for the edit it bears and one more.
PREFIX = 3
#: Words that a task counts before it hands them on.
COUNTED = 400_000
#: A root is found after so many doublings: each form has RATIO times the occurrences of the one before.
DOUBLINGS = 6

#: Latin-1: words keep their letters, A-Z in lower case; all else is white space.
_LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def observed(doc_id: str, run: bytes) -> bytes:
    """The run (Latin-1, lower case) as it counts in a document: perhaps with a letter left out."""
    text = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(text, zlib.crc32(f"{doc_id}:".encode()))
    if h % SLIPS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            runs = Counter((text or "").encode("latin-1", "replace").translate(_LETTER).split())
            own = "" if doc_id is None else doc_id
            for run, times in runs.items():
                if len(run) >= LEAST_LETTERS:
                    word = observed(own, run)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += times
            if len(held) >= COUNTED:
                yield _words(held)
                held = Counter()
    yield _words(held)


def _words(held: Counter) -> pa.RecordBatch:
    names = [w.decode("latin-1") for w in held]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
    )


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words to compare."""
    rows = documents_only(docs, id_column, text).toDF("id", "text").select(F.col("id").cast("string"), "text")
    counted = arrow_batches(rows).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


def gram_times(words: DataFrame) -> np.ndarray:
    """How often each bigram, as two Latin-1 bytes, occurs in the words.

    There are 90 letters, so 8100 bigrams at most, whatever the number of words.
    """
    grams = words.selectExpr("explode(transform(sequence(1, length(word) - 1), i -> substr(word, i, 2))) AS gram")
    rows = grams.groupBy("gram").count().collect()
    times = np.zeros(1 << 16, np.int64)
    for gram, n in rows:
        times[int.from_bytes(gram.encode("latin-1"), "big")] = n
    return times


def prefix(grams: list[int], times: list[int]) -> tuple[list[int], tuple[int, int]]:
    """The places of a word's prefix in ascending order, and the order's key of its last bigram."""
    order = sorted((times[g], g) for g in grams)
    last = order[min(PREFIX, len(order)) - 1]
    return [i for i, g in enumerate(grams) if (times[g], g) <= last], last


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """The two places at least two apart with the least sum of weights.

    ``best`` is the lightest place among those that end before the current one starts.
    """
    made, least, best, free = (-1, -1), None, None, 0
    for i, place in enumerate(places):
        while free < i and places[free] <= place - 2:
            if best is None or weights[free] < weights[best]:
                best = free
            free += 1
        if best is not None and (least is None or weights[best] + weights[i] < least):
            least, made = weights[best] + weights[i], (places[best], place)
    return made


def _keys(word: bytes, place: int, length: int) -> list[int]:
    """Cells of a bigram of a word that has, or is compared with words that have, this length.

    The first half of them hold the letters that stay if the edit is after the bigram, the others those if it
    is before.
    """
    size, made = len(word), []
    for side, same in ((0, place + 2), (1, size - place)):
        # the letters on the other side of the bigram, in the word of that length
        free = length - same
        if free < 0:
            continue
        near = free // 2
        seed = ((length << 32) | same) << 2 | side << 1
        whole = word[: same + near] if side == 0 else word[size - same - near :]
        made.append(xxhash.xxh3_64_intdigest(whole, seed) - (1 << 63))
        if near:
            far = free - near
            parts = word[:same] + word[size - far :] if side == 0 else word[size - same :] + word[:far]
            made.append(xxhash.xxh3_64_intdigest(parts, seed | 1) - (1 << 63))
    return made


def _entries(times: np.ndarray):
    """Rows (key, probe, word, last) of a batch of words: the prefix as index, the pivots as look-ups."""
    weights = times.tolist()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, probes, words, lasts = [], [], [], []
        for number, word in enumerate(batch.column(0).to_pylist()):
            raw = word.encode("latin-1")
            n = len(raw)
            grams = [(raw[i] << 8) | raw[i + 1] for i in range(n - 1)]
            places, (often, gram) = prefix(grams, weights)
            index = [k for p in places for k in _keys(raw, p, n)]
            chosen = pivots(places, [weights[grams[p]] for p in places])
            looked = {k for p in chosen for length in (n - 1, n, n + 1) for k in _keys(raw, p, length)}
            keys += index
            keys += looked
            probes += [False] * len(index) + [True] * len(looked)
            words += [number] * (len(index) + len(looked))
            lasts += [(often << 16) | gram] * (len(index) + len(looked))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()), pa.array(probes, pa.bool_()),
                batch.column(0).take(pa.array(words, pa.int32())), pa.array(lasts, pa.int64()),
            ],
            names=["key", "probe", "word", "last"],
        )

    return each


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): the pairs of words one edit apart, each once, a before b."""
    times = words.sparkSession.sparkContext.broadcast(gram_times(words))

    def entries(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _entries(times.value)(batch)

    # a few files hold all words, and each word makes some forty rows
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = words.select("word").repartition(parts, "word")
    rows = stored(arrow_rows(spread, entries, "key long, probe boolean, word string, last long"), "grams")
    index = rows.where("NOT probe").select("key", F.col("word").alias("s"), F.col("last").alias("s_last"))
    probes = rows.where("probe").select("key", F.col("word").alias("r"), F.col("last").alias("r_last"))
    found = probes.join(index, "key").where("r_last <= s_last AND r != s AND levenshtein(r, s, 1) = 1")
    return found.select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b")).distinct()


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words to compare."""
    words = stored(vocabulary(docs, id_column, text), "words")
    pairs = stored(near_words(words), "near")
    both = pairs.selectExpr("inline(array(struct(a as word, b as other), struct(b as word, a as other)))")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (
        both.join(others, "other").groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
        .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.col1")).alias("other_n"))
    )
    forms = F.col("other_n") >= RATIO * F.col("n")
    named = stored(
        words.join(best, "word", "left").select(
            "word", F.when(forms, F.col("other")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(forms, F.col("other_n")).alias("form_n"),
        ),
        "forms",
    )
    # each round follows twice as many forms as the one before
    ways = named.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stored(
            ways.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if ways.where("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return named.join(ways.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
