"""Near-equal records by a multi-index Hamming join.

A record's word set is sketched in bits: every word flips one.  Two sets that
differ in ``d`` words have sketches that differ in at most ``d`` bits, so a
Jaccard similarity of ``threshold`` bounds the distance of the sketches and no
pair is lost.  The words, and with them the bits, are split into ``m`` chunks
with ``d <= 2m - 3``: by the pigeonhole principle at least two chunks of a pair
differ in one bit at most.  Of two chunks that differ in one bit, one has it
set; clearing each set bit in turn thus enumerates all allowed errors, and an
equi-join of the cleared with the plain chunks meets every pair.

A chunk of common words may be shared by ever more records as the table grows.
The records on a key of more than ``HOT`` index rows are not compared with each
other: each is indexed again by that key together with its later chunks.  Of
the two chunks that a pair shares, the earlier one's key is either not crowded,
or leads to the later one.  So no comparison is lost, and a record is compared
with at most ``HOT`` others for each of its keys.

Exact copies (equal word sets) are one record until the end.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import cut_lineage, spread

THRESHOLD = 0.8
#: Beyond this many index rows it is cheaper to index the records of a key again than to compare them.
HOT = 1_000
#: Crowded keys are sent to all tasks up to this number (4 MB), and joined by a shuffle beyond it.
MOST_BROADCAST = 500_000

_GOLDEN = 0x9E3779B97F4A7C15


def chunk_classes(largest: int = 1 << 20) -> list[int]:
    """Numbers of chunks in steps of a fifth, so that a record belongs to two classes at most."""
    out = [1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, out[-1] * 6 // 5))
    return out


_CLASSES = chunk_classes()


def most_differing(words: int, threshold: float) -> int:
    """How many words a set of ``words`` and one at least as large can differ in at the threshold."""
    return int(words * (1 - threshold) / threshold + 1e-9)


def chunks_of(words: int, threshold: float) -> int:
    """The number of chunks of a pair whose smaller set has ``words``."""
    needed = most_differing(words, threshold) // 2 + 2
    return _CLASSES[bisect_left(_CLASSES, needed)]


def word_set(*texts: Column) -> Column:
    """The sorted distinct words of several texts; nulls are empty."""
    joined = F.concat_ws(" ", *texts)
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(joined), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))


_CLASS_SIZES = np.array(_CLASSES, dtype=np.int64)


def _class_numbers(words: np.ndarray, threshold: float) -> np.ndarray:
    """As ``chunks_of`` for many sizes, as positions in the list of classes."""
    needed = (words * (1 - threshold) / threshold + 1e-9).astype(np.int64) // 2 + 2
    return np.searchsorted(_CLASS_SIZES, needed)


def _mix(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(_GOLDEN)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class _Words(dict):
    """Memo of words' 64-bit hashes."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _flat(lists: list[list[str]], memo: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' hashes behind one another, whose they are, and how many each record has."""
    n = np.array([len(x) for x in lists], dtype=np.int64)
    hashes = np.fromiter((memo[w] for words in lists for w in words), dtype=np.uint64, count=int(n.sum()))
    return hashes, np.repeat(np.arange(len(lists)), n), n


def _chunk_keys(hashes: np.ndarray, owner: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(record, chunk, key, cleared)`` of all chunks of records cut into ``m`` chunks each, plain and with each set bit cleared."""
    bit = np.uint64(1) << (hashes & np.uint64(63))
    begins = np.concatenate([[0], np.cumsum(m)])
    chunk = ((hashes >> np.uint64(20)) % m[owner].astype(np.uint64)).astype(np.int64)
    at = begins[owner] + chunk
    sketch = np.zeros(begins[-1], dtype=np.uint64)
    np.bitwise_xor.at(sketch, at, bit)
    record = np.repeat(np.arange(len(m)), m)
    number = np.arange(begins[-1]) - begins[record]
    set_ = np.flatnonzero(sketch[at] & bit)  # two words of one bit have none
    record, number = np.concatenate([record, owner[set_]]), np.concatenate([number, chunk[set_]])
    values = np.concatenate([sketch, sketch[at[set_]] ^ bit[set_]])
    salt = _mix(m[record].astype(np.uint64) * np.uint64(1 << 21) + number.astype(np.uint64) + np.uint64(1))
    return record, number, _mix(values ^ salt), np.arange(len(values)) >= begins[-1]


_INDEX = "key bigint, cleared boolean, rep bigint, n int, low bigint, high bigint, chunks int, chunk int"


def _keys(threshold: float):
    """The index rows of records ``(rep, words)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                reps = part.column(0).to_numpy()
                hashes, owner, n = _flat(part.column(1).to_pylist(), memo)
                bit, side = np.uint64(1) << (hashes & np.uint64(63)), ((hashes >> np.uint64(6)) & np.uint64(1)).astype(bool)
                low, high = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
                np.bitwise_xor.at(low, owner[side], bit[side])
                np.bitwise_xor.at(high, owner[~side], bit[~side])
                # Every class that the smaller set of a pair with this record may be of.
                least, most = _class_numbers(np.ceil(n * threshold - 1e-9), threshold), _class_numbers(n, threshold)
                for step in range(int((most - least).max()) + 1 if len(n) else 0):
                    some = np.flatnonzero(least + step <= most)
                    place = np.full(len(n), -1)
                    place[some] = np.arange(len(some))
                    mine = place[owner] >= 0
                    m = _CLASS_SIZES[least[some] + step]
                    record, chunk, key, cleared = _chunk_keys(hashes[mine], place[owner[mine]], m)
                    of = some[record]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)), pa.array(cleared), pa.array(reps[of]), pa.array(n[of].astype(np.int32)),
                            pa.array(low[of].view(np.int64)), pa.array(high[of].view(np.int64)), pa.array(m[record].astype(np.int32)), pa.array(chunk.astype(np.int32)),
                        ],
                        names=["key", "cleared", "rep", "n", "low", "high", "chunks", "chunk"],
                    )

    return run


def _second_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of a crowded key ``(.., words)``, each with the keys of the record's later chunks."""
    memo = _Words()
    names = ["key", "cleared", "rep", "n", "low", "high", "chunks", "chunk"]
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            hashes, owner, _ = _flat(part.column(8).to_pylist(), memo)
            m = part.column(6).to_numpy().astype(np.int64)
            record, chunk, key, cleared = _chunk_keys(hashes, owner, m)
            keep = chunk > part.column(7).to_numpy()[record]
            record, key, cleared = record[keep], key[keep], cleared[keep]
            both = _mix(key ^ _mix(part.column(0).to_numpy().view(np.uint64)[record]))
            taken = part.take(pa.array(record))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both.view(np.int64)), *(taken.column(i) for i in range(1, 6)), pa.array(cleared)], names=[*names[:6], "again"]
            )


def near_sets(sets: DataFrame, threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """``(rep_a, rep_b, similarity)`` of unique records ``(rep bigint, words array<string>)`` that reach the threshold."""
    sets = sets.filter(F.size("words") > 0).select("rep", "words")
    index = cut_lineage(spread(sets, "rep").mapInArrow(_keys(threshold), _INDEX))
    crowds = cut_lineage(index.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > hot).select("key"))
    # The bounds of the two sizes, and of the distance that they and the threshold allow.
    bound = F.floor((F.col("a.n") + F.col("b.n")) * (1 - threshold) / (1 + threshold) + F.lit(1e-9))
    distance = F.bit_count(F.col("a.low").bitwiseXOR(F.col("b.low"))) + F.bit_count(F.col("a.high").bitwiseXOR(F.col("b.high")))
    close = (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - 1e-9) & (distance <= bound) & (F.col("a.rep") != F.col("b.rep"))
    meets = (F.col("a.key") == F.col("b.key")) & close
    ids = [F.least("a.rep", "b.rep").alias("rep_a"), F.greatest("a.rep", "b.rep").alias("rep_b")]
    crowded = crowds.count()
    if 0 < crowded <= MOST_BROADCAST:
        crowds = F.broadcast(crowds)
    rows = index.select("key", "cleared", "rep", "n", "low", "high")
    if crowded:
        rows = rows.join(crowds, "key", "left_anti")
    # Only one side may be cleared.  An index row is wider than its source tells the planner: the join is one of sorted partitions.
    a, b = rows.alias("a"), rows.filter(~F.col("cleared")).alias("b")
    candidates = a.hint("merge").join(b, meets & (F.col("a.cleared") | (F.col("a.rep") < F.col("b.rep")))).select(*ids)
    if crowded:
        shared = index.join(crowds, "key", "left_semi").join(sets, "rep").select("key", "cleared", "rep", "n", "low", "high", "chunks", "chunk", "words")
        again = shared.mapInArrow(_second_keys, "key bigint, cleared boolean, rep bigint, n int, low bigint, high bigint, again boolean")
        again = cut_lineage(again)
        one = (F.col("a.cleared").cast("int") + F.col("b.cleared").cast("int") <= 1) & (F.col("a.again") | (F.col("a.rep") < F.col("b.rep")))
        second = again.alias("a").hint("merge").join(again.filter(~F.col("again")).alias("b"), meets & one).select(*ids)
        candidates = candidates.unionByName(second)
    candidates = candidates.distinct()
    left = sets.select(F.col("rep").alias("rep_a"), F.col("words").alias("words_a"))
    right = sets.select(F.col("rep").alias("rep_b"), F.col("words").alias("words_b"))
    both = F.size(F.array_intersect("words_a", "words_b"))
    return (
        candidates.join(left, "rep_a")
        .join(right, "rep_b")
        .select("rep_a", "rep_b", (both / (F.size("words_a") + F.size("words_b") - both)).alias("similarity"))
        .filter(F.col("similarity") >= threshold - 1e-12)
    )


def copy_classes(records: DataFrame, key: str, texts: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Records of equal word sets as one: ``(rep, words)``, and the membership ``(rep, key)``."""
    rows = records.select(F.col(key).cast("bigint").alias("__key"), word_set(*texts).alias("words"))
    rows = cut_lineage(rows.withColumn("mark", F.sha2(F.concat_ws(" ", "words"), 256)))
    # Only the mark is grouped, with partial aggregation: a class of a third of the rows is one row of each task.
    reps = rows.groupBy("mark").agg(F.min("__key").alias("rep"), F.min("words").alias("words"))
    reps = cut_lineage(reps)
    members = rows.select("mark", "__key").join(reps.select("mark", "rep"), "mark").select("rep", F.col("__key").alias(key)).distinct()
    return reps.select("rep", "words"), members


def near_pairs(records: DataFrame, key: str, texts: list[Column], threshold: float = THRESHOLD) -> DataFrame:
    """``(key_a, key_b)``: all pairs of records, copies included, of a word-set similarity of at least the threshold.

    The smaller key comes first.  Null texts are empty; a record without any
    word is similar to none.  Repeated rows of one key count once.  Other
    columns are dropped.  An empty table gives an empty result.
    """
    sets, members = copy_classes(records, key, texts)
    sets = sets.filter(F.size("words") > 0)
    links = near_sets(sets, threshold).select("rep_a", "rep_b")
    own = sets.select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b"))
    a = members.select(F.col("rep").alias("rep_a"), F.col(key).alias("x"))
    b = members.select(F.col("rep").alias("rep_b"), F.col(key).alias("y"))
    across = links.join(a, "rep_a").join(b, "rep_b")
    within = own.join(a, "rep_a").join(b, "rep_b").filter(F.col("x") < F.col("y"))
    return across.unionByName(within).select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def near_groups(
    records: DataFrame, key: str, texts: list[Column], threshold: float = THRESHOLD
) -> DataFrame:
    """``(key, group_id, links)``: every record with its group (the smallest key it is linked to over others) and its number of links between classes.

    Groups are connected components of class representatives, found by rounds
    of passing on the smallest label and following labels of labels; a record
    without partner is its own group.
    """
    sets, members = copy_classes(records, key, texts)
    links = near_sets(sets, threshold).select("rep_a", "rep_b")
    links = cut_lineage(links.union(links.select("rep_b", "rep_a")).toDF("u", "v"))
    labels = cut_lineage(sets.select(F.col("rep").alias("u"), F.col("rep").alias("label")))
    while True:
        offered = links.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("offer"))
        nearer = labels.join(offered, "u", "left").select("u", "label", F.least("label", F.coalesce("offer", "label")).alias("new"))
        onward = nearer.join(labels.select(F.col("u").alias("new"), F.col("label").alias("further")), "new", "left")
        after = cut_lineage(onward.select("u", "label", F.least("new", F.coalesce("further", "new")).alias("new")))
        labels = after.select("u", F.col("new").alias("label"))
        if after.filter(F.col("new") < F.col("label")).isEmpty():
            break
    counts = links.groupBy("u").agg(F.count("*").alias("links"))
    return (
        members.join(labels.toDF("rep", "group_id"), "rep")
        .join(counts.withColumnRenamed("u", "rep"), "rep", "left")
        .select(key, "group_id", F.coalesce("links", F.lit(0)).alias("links"))
    )
