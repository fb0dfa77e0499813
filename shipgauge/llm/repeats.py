"""Repeated word passages by prefix-partitioned suffix trees.

A passage is a window of ``WINDOW`` words. Suffixes of documents' word
sequences are split into groups by a prefix of variable length: the prefix ends
with the window's anchor, the run of ``ANCHOR`` words with the smallest hash in
the window. Equal windows have equal prefixes, so they meet in one group, and
the suffixes that share an anchor travel as one row of overlapping words.

1. Anchors of all documents are counted, aggregated before the shuffle. Only
   anchors of two documents or more can belong to a repeat.
2. Documents learn which of their anchors are shared, and send the words around
   those, one row an anchor.
3. A task sorts its groups and builds the suffix trees of as many whole groups as
   fit ``BLOCK`` rows, by doubling: the nodes at depth 1, 2, 4, 8 and so on up to
   the window. An internal node that deep is a repeat; its least document keeps
   it, the other leaves are marked.
4. Groups of more than ``GROUP`` rows take the whole window as prefix: the tree
   below is a single node, whose least document is an aggregate that Spark
   combines before the shuffle and joins back in salted pieces.
5. Marks return to their documents; text is shuffled once for steps 2 and 5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import unused, written

WINDOW = 13
ANCHOR = 5
GROUP = 20_000   # rows of one anchor that a suffix tree takes
BLOCK = 20_000   # rows whose suffix trees one step builds, besides a group
SALTS = 32       # pieces of a window's rows in a large group
SLICE = 1 << 20  # bytes of text whose words one step holds as numbers, besides a text
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # any odd 64-bit number
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)       # another one
NO_KEY = (1 << 63) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word, the words that the numbers mean, words in each text) of the texts one after the other."""
    lists = pc.ascii_split_whitespace(texts)
    found = lists.flatten().dictionary_encode()
    number, kinds = found.indices.to_numpy(), found.dictionary
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    real = number != pc.index(kinds, "").as_py()  # blanks at the ends of a text make empty words
    return number[real], kinds, np.bincount(doc[real], minlength=len(texts))


def word_hashes(words: pa.Array, base: np.uint64 = MULTIPLIER) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in ``base``, odd, mixed with the length."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    if not len(words):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, base, np.uint64))
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(starts, lengths)]
    sums = np.where(lengths > 0, np.add.reduceat(np.append(terms, np.uint64(0)), starts), np.uint64(0))
    return mixed(sums + lengths.astype(np.uint64) * OTHER)


def run_hashes(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``length`` consecutive hashes."""
    out = np.full(max(len(hashes) - length + 1, 0), seed, np.uint64)
    for i in range(length):
        out = mixed(out * MULTIPLIER + hashes[i:len(out) + i])
    return out


def anchors(hashes: np.ndarray, counts: np.ndarray, window: int, anchor: int):
    """(document, first word, anchor's hash) of every window of every document, and which windows begin a run.

    ``counts`` are the documents' numbers of words. The anchor is the run of
    words with the smallest high half of its hash, the leftmost such one.
    Consecutive windows with their anchor at one place are a run.
    """
    starts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    runs = run_hashes(hashes, anchor)
    if len(hashes) < window:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none.astype(bool)
    least = (runs & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(runs), dtype=np.uint64)
    covered, span = 1, window - anchor + 1
    while covered < span:
        step = min(covered, span - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    doc = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    at = np.arange(len(least)) - starts[doc]
    inside = at + window <= counts[doc]  # a window within one document
    doc, at, spot = doc[inside], at[inside], (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = spot[1:] != spot[:-1]
    return doc, at, runs[spot], new


def joined(number: np.ndarray, kinds: pa.Array, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Words ``starts[i]`` and on, ``sizes[i]`` of them, joined by one blank."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    spots = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    words = kinds.take(pa.array(number[spots]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), " ")


def _read(docs: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """``keep``, and under unused names: the key (null: the largest), the text (null: empty) and a number for the row."""
    names = {n: unused(f"_{n}", docs) for n in ("key", "text", "row")}
    body = F.coalesce(F.col(text), F.lit(""))
    ident = F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY))
    return docs.select(*keep, ident.alias(names["key"]), body.alias(names["text"]),
                       F.xxhash64(ident, body).alias(names["row"]))


def _each_slice(batches, key: str, text: str, row: str):
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(), dtype=np.int64)
        cuts = np.unique(np.concatenate(([0], np.searchsorted(ends, np.arange(SLICE, ends[-1], SLICE), side="right"), [len(ends)]))) \
            if len(ends) else []
        for at, end in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(at, end - at)
            number, kinds, counts = words_of(part.column(text))
            yield part, part.column(key).to_numpy(), part.column(row).to_numpy(), number, kinds, counts


def shared_anchors(rows: DataFrame, names: tuple[str, str, str], window: int, anchor: int) -> DataFrame:
    """(anchor, n): the anchors that documents of two keys or more have, with their number of runs of windows."""
    fields = [T.StructField(c, T.LongType()) for c in ("anchor", "low", "high", "n")]
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches):
        for _, keys, _, number, kinds, counts in _each_slice(batches, *names):
            doc, _, found, first = anchors(word_hashes(kinds)[number], counts, window, anchor)
            found, own = found[first], keys[doc[first]]
            order = np.lexsort((own, found))
            found, own = found[order], own[order]
            edges = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.zeros(0, np.int64)
            ends = np.append(edges[1:], len(found))
            yield pa.RecordBatch.from_arrays([pa.array(found[edges].view(np.int64)), pa.array(own[edges]),
                                              pa.array(own[ends - 1] if len(edges) else own), pa.array(ends - edges)], schema=arrow)

    seen = rows.select(*names).mapInArrow(run, T.StructType(fields))
    return (seen.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
            .filter("low < high").select("anchor", "n"))


def own_anchors(rows: DataFrame, names: tuple[str, str, str], window: int, anchor: int) -> DataFrame:
    """(anchor, row): the distinct anchors of each row."""
    fields = [T.StructField("anchor", T.LongType()), T.StructField("row", T.LongType())]
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches):
        for _, _, ids, number, kinds, counts in _each_slice(batches, *names):
            doc, _, found, new = anchors(word_hashes(kinds)[number], counts, window, anchor)
            doc, found = doc[new], found[new]
            order = np.lexsort((doc, found))
            doc, found = doc[order], found[order]
            first = np.ones(len(found), bool)
            first[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(found[first].view(np.int64)), pa.array(ids[doc[first]])], schema=arrow)

    return rows.select(*names).mapInArrow(run, T.StructType(fields))


# one anchor's windows in one row: those from word ``start`` on, as many as ``words`` has beyond a window less one
LEAVES = [T.StructField("anchor", T.LongType()), T.StructField("key", T.LongType()), T.StructField("row", T.LongType()),
          T.StructField("start", T.LongType()), T.StructField("words", T.StringType())]
# a window of a large group: its 128-bit hash in place of its words
NODES = [T.StructField(c, T.LongType()) for c in ("high", "low", "key", "row", "start")]
MARKS = [T.StructField("key", T.LongType()), T.StructField("row", T.LongType()), T.StructField("start", T.LongType()),
         T.StructField("bits", T.LongType())]


def _shared_windows(listed: DataFrame, names: tuple[str, str, str, str], window: int, anchor: int, large: bool) -> DataFrame:
    """The windows whose anchor is in the row's list (the last of ``names``), as ``LEAVES`` or, for large groups, ``NODES``."""
    fields = NODES if large else LEAVES
    arrow = to_arrow_schema(T.StructType(fields))
    def run(batches):
        for part, keys, ids, number, kinds, counts in _each_slice(batches, *names[:3]):
            doc, at, found, new = anchors(word_hashes(kinds)[number], counts, window, anchor)
            lists = part.column(names[3])
            wanted = lists.flatten().to_numpy()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            # (document, anchor) pairs of windows that are among those of the lists
            pairs = np.stack([doc, found.view(np.int64)], axis=1)
            asked = np.stack([np.repeat(np.arange(len(sizes)), sizes), wanted], axis=1)
            mine = _members(pairs, asked)
            doc, at, found, new = doc[mine], at[mine], found[mine], new[mine]  # a run is listed as a whole or not
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[doc] + at
            if large:
                halves = [run_hashes(word_hashes(kinds, base)[number], window, 1)[starts].view(np.int64) for base in (MULTIPLIER, OTHER)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*halves, keys[doc], ids[doc], at)], schema=arrow)
                continue
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, len(doc))) + window - 1
            words = joined(number, kinds, starts[first], sizes)
            yield pa.RecordBatch.from_arrays([pa.array(found[first].view(np.int64)), pa.array(keys[doc[first]]), pa.array(ids[doc[first]]),
                                              pa.array(at[first]), words], schema=arrow)

    return listed.mapInArrow(run, T.StructType(fields))


def _members(pairs: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which rows of ``pairs`` are among those of ``asked``."""
    kinds = np.unique(asked[:, 1])
    if not len(kinds):
        return np.zeros(len(pairs), bool)
    place = np.minimum(np.searchsorted(kinds, pairs[:, 1]), len(kinds) - 1)
    known = kinds[place] == pairs[:, 1]
    width = len(kinds)
    return known & np.isin(pairs[:, 0] * width + place, asked[:, 0] * width + np.searchsorted(kinds, asked[:, 1]))


def tree_nodes(words: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix trees' nodes at depth ``window``: (row, offset, node) of every window of the rows' words.

    Nodes are numbered by pairs of nodes of half the depth, from the words on,
    so equal numbers mean equal words, not equal hashes.
    """
    split = pc.split_pattern(words, " ")
    counts = pc.list_value_length(split).to_numpy().astype(np.int64)
    node = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    depth = 1
    while depth < window:
        step = min(depth, window - depth)  # the second half may overlap the first
        pair = node[:-step] * (int(node.max(initial=0)) + 1) + node[step:]
        node = np.unique(pair, return_inverse=True)[1]
        depth += step
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    row = np.repeat(np.arange(len(counts)), counts)[:len(node)]
    offset = np.arange(len(node)) - starts[row]
    inside = offset + window <= counts[row]
    return row[inside], offset[inside], node[inside]


def _marked(words: pa.Array, keys: np.ndarray, window: int) -> np.ndarray:
    """Bits of each row's windows that also are in a document of a smaller key."""
    row, offset, node = tree_nodes(words, window)
    least = np.full(int(node.max(initial=0)) + 1, NO_KEY)
    np.minimum.at(least, node, keys[row])
    later = least[node] < keys[row]
    bits = np.zeros(len(words), np.int64)
    np.bitwise_or.at(bits, row[later], np.int64(1) << offset[later])
    return bits


def marks_of_trees(leaves: DataFrame, window: int, block: int) -> DataFrame:
    """Marks from the suffix trees of all groups: bit i of ``bits`` for the window at ``start`` + i."""
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrow = to_arrow_schema(T.StructType(MARKS))

    def build(table: pa.Table):
        keys = table.column("key").to_numpy()
        bits = _marked(table.column("words").combine_chunks(), keys, window)
        some = np.flatnonzero(bits)
        return pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(table.column("row").to_numpy()[some]),
                                           pa.array(table.column("start").to_numpy()[some]), pa.array(bits[some])], schema=arrow)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < block:
                continue
            table = pa.Table.from_batches(held)
            group = table.column("anchor").to_numpy()
            end = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if end:
                yield build(table.slice(0, end))
            held, n = table.slice(end).combine_chunks().to_batches(), table.num_rows - end
        if n:
            yield build(pa.Table.from_batches(held))

    return leaves.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(run, T.StructType(MARKS))


def marks_of_nodes(nodes: DataFrame) -> DataFrame:
    """Marks of large groups, whose windows are nodes of their own: an aggregate, joined back by window and salt."""
    least = nodes.groupBy("high", "low").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    spread = least.select("high", "low", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int"))
    found = salted.join(spread.hint("shuffle_hash"), ["high", "low", "salt"])
    return found.filter("key > least").select("key", "row", "start", F.lit(1).cast("long").alias("bits"))


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                 window: int = WINDOW, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """Append ``kept`` (the words that stay, joined by one blank), ``n_words`` and ``n_removed``.

    A word goes if a window of ``window`` words covers it whose words also start
    in a document with a smaller key; windows are judged on the input. Words are
    runs of anything but ASCII blanks. A null text has no words, a text with
    fewer words than a window loses none; a null key counts as the largest long;
    rows of one key never remove each other's words; repeated rows have equal
    results. Output columns replace input columns of those names.
    """
    anchor = min(ANCHOR, window)
    made = [T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("kept", "n_words", "n_removed")]
    rows = _read(docs, key, text, keep)
    names = tuple(rows.columns[len(keep):])
    # tables of their own, so that both sides of the joins below are plain exchanges, which adaptive execution can split
    shared = written(shared_anchors(rows, names, window, anchor), "anchors")
    own = own_anchors(rows, names, window, anchor).join(shared.hint("shuffle_hash"), "anchor")
    few, many, marked = (unused(f"_{n}", docs) for n in ("few", "many", "marks"))
    lists = written(own.groupBy(F.col("row").alias(names[2])).agg(
        F.collect_set(F.when(F.col("n") <= group, F.col("anchor"))).alias(few),
        F.collect_set(F.when(F.col("n") > group, F.col("anchor"))).alias(many)), "shared-anchors")
    # all columns go into the tasks, so that the rows' exchange is the last join's, too
    listed = rows.join(lists.select(names[2], few), names[2])
    marks = marks_of_trees(_shared_windows(listed, (*names, few), window, anchor, False), window, block)
    large = lists.filter(F.size(many) > 0).select(names[2], many)
    if not large.isEmpty():
        marks = marks.unionByName(marks_of_nodes(_shared_windows(rows.join(large, names[2]), (*names, many), window, anchor, True)))
    marks = marks.groupBy(F.col("row").alias(names[2])).agg(F.collect_set(F.struct("key", "start", "bits")).alias(marked))
    schema = T.StructType([docs.schema[c] for c in keep] + made)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for part, keys, _, number, kinds, counts in _each_slice(batches, *names):
            starts = np.concatenate(([0], np.cumsum(counts)))
            lists = part.column(marked)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            doc, (own, at, bits) = np.repeat(np.arange(len(sizes)), sizes), (x.to_numpy() for x in lists.flatten().flatten())
            mine = own == keys[doc]
            first, bits = (starts[doc] + at)[mine], bits[mine]
            gone = np.zeros(len(number) + 1, np.int64)
            for bit in range(int(bits.max(initial=0)).bit_length()):
                here = first[(bits >> bit & 1) == 1] + bit
                np.add.at(gone, here, 1)
                np.add.at(gone, here + window, -1)
            stay = np.cumsum(gone[:-1]) == 0
            left = np.diff(np.concatenate(([0], np.cumsum(stay)))[starts])
            kept = joined(number[stay], kinds, np.concatenate(([0], np.cumsum(left)[:-1])), left)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), kept, pa.array(counts, pa.int64()),
                                              pa.array(counts - left, pa.int64())], schema=arrow)

    return rows.join(marks, names[2], "left").select(*keep, *names, marked).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """``kept`` as its SHA-256 in lower-case hex digits (``kept_sha256``)."""
    return docs.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
