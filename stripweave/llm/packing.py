"""Packing: best-fit decreasing over token counts, exact at any number of documents.

The classic algorithm handles pieces one by one, longest first, and puts each into the
open window with the least capacity that still holds it. Pieces of one length are
interchangeable, and so are windows with one remaining capacity; so the whole run is
decided by how many pieces have each length. That histogram has at most ``window``
entries whatever the size of the corpus, and the driver plans on it with a segment tree
indexed by remaining capacity. The plan says, for a range of pieces of one length, which
range of windows they go to; the executors number their pieces and look them up.

Where the order of the rows counts, the same plan is made for each group of consecutive
documents by itself, on the executors, and the windows are numbered in that order.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import holds, slices, task, written

#: Words that a worker remembers the ids of; further words are encoded each time.
WORD_CACHE = 250_000
END_ID = 1
WINDOW = 2048
#: Consecutive documents that are packed together where the order counts.
GROUP = 2048


class WordEncoder(dict):
    """Ids of whole texts, as little-endian 32-bit words, by a byte-level BPE file.

    A space that stands before a character other than white space begins a new
    pre-token, so a text is the concatenation of its space-separated words, and each
    word's ids are remembered. Texts with other runs of white space, or that spell a
    special token, go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [x["content"] for x in spec.get("added_tokens", ())]
        # Other ways of cutting a text into words, or of changing it before, are the tokenizer's own business.
        cutter = spec.get("pre_tokenizer") or {}
        usual = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
        self.usual = bool(usual and not spec.get("normalizer") and spec["model"].get("type") == "BPE" and not spec["model"].get("ignore_merges"))
        # The printable stand-ins that byte-level vocabularies use for bytes.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand_in = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(map(stand_in.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.points = {p: self.ids(p) for p in ",.;:!?"}

    def ids(self, text: str) -> bytes:
        return array("I", self.fast.encode_ordinary(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise UnevenSpace
        if word[-1] in self.points and word[:-1].isalpha():
            return self[word[:-1]] + self.points[word[-1]]
        found = self.ids(" " + word)
        if len(self) < WORD_CACHE:
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.usual or any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        try:
            return self.ids(first) + b"".join(map(self.__getitem__, rest))
        except UnevenSpace:
            return self.ids(text)


class UnevenSpace(Exception):
    """A space is followed by white space or by the text's end."""


_ENCODERS: dict[str, WordEncoder] = {}
holds("packing", _ENCODERS.clear)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, carried: tuple[str, ...] = ()) -> DataFrame:
    """Cut each document's ids, and the end id, into full windows and a rest.

    Rows ``(doc_id, start, length, ids_crc32, doc_tokens, part, nth)``: ``nth`` counts the
    pieces of one length within the task ``part`` that read them. The ``carried`` columns,
    which are long, follow.
    """

    def cut(state: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, seen, part = encoder(tokenizer), state["seen"], TaskContext.get().partitionId()
        rows: list[tuple] = []
        at: list[int] = []
        for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            ids = words.encode(text or "") + b"\x01\0\0\0"
            total = len(ids) // 4
            for start in range(0, total, window):
                some = ids[4 * start : 4 * (start + window)]
                length = len(some) // 4
                nth = seen.get(length, 0)
                seen[length] = nth + 1
                rows.append((doc_id, start, length, zlib.crc32(some), total, part, nth))
                at.append(i)
        columns = list(zip(*rows)) or [()] * 7
        more = [batch.column(c).take(pa.array(at, pa.int64())) for c in carried]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns), *more], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", *carried]
        )

    def run(batches):
        state: dict = {"seen": {}}
        with task("packing"):
            for batch in batches:
                for piece in slices(batch, 1):
                    yield cut(state, piece)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long" + "".join(f", {c} long" for c in carried)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried).mapInArrow(run, schema)


class OpenWindows:
    """Segment tree over remaining capacities: which is the least one, at least n, with an open window."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.some = [False] * (2 * self.size)

    def set(self, capacity: int, some: bool) -> None:
        at = self.size + capacity
        self.some[at] = some
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = self.size + least
        if self.some[at]:
            return least
        while at > 1:
            if not at & 1 and self.some[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length.

    Rows ``(length, first, last, window_id, n, offset)``: pieces ``first..last`` of that length,
    numbered from 0, go round the ``n`` windows from ``window_id`` on, first at ``offset`` and
    ``length`` further in each round. A window that took a piece and still holds another of its
    length is then the tightest one, so each takes as many of them as fit before the next does.
    """
    tree, opened, out, made = OpenWindows(window), {}, [], 0
    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            capacity, held = tree.tightest(length), left
            if capacity is None:
                capacity, begin = window, made
            else:
                begin, held = opened[capacity].popleft()
            n, each = min(held, left // (capacity // length)), capacity // length
            if not n:
                n, each = 1, left
            if capacity == window:
                made += n
            elif n < held:
                opened[capacity].appendleft((begin + n, held - n))
            elif not opened[capacity]:
                tree.set(capacity, False)
            out.append((length, first, first + n * each - 1, begin, n, window - capacity))
            first, left = first + n * each, left - n * each
            if rest := capacity - each * length:
                opened.setdefault(rest, deque()).append((begin, n))
                tree.set(rest, True)
    return out


def pack(docs: DataFrame, tokenizer: str, *, window: int = WINDOW) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens by best-fit decreasing.

    Null text is empty and so a piece with the end id alone; a null or repeated ``doc_id`` is
    kept as it is, each row packed by itself; columns other than ``doc_id`` and ``text`` are
    ignored; an empty table gives no rows.
    """
    cut = written(pieces(docs, tokenizer, window=window), name="pieces")
    by_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    by_part = written(by_part, name="lengths")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    runs = plan(counts, window)
    order = "partition by length order by part rows between unbounded preceding and 1 preceding"
    shifted = by_part.selectExpr("length", "part", f"coalesce(sum(n) over ({order}), 0) as before")
    numbered = cut.join(shifted.hint("merge"), ["length", "part"]).withColumn("number", F.col("nth") + F.col("before"))
    # Each piece finds its run among those of its length. The table depends on `window` alone, not on
    # the corpus: at most one run for each pair of a length and a capacity, in practice some thousands.
    by_length: dict[int, list[list[int]]] = {}
    for length, *rest in runs:
        by_length.setdefault(length, []).append(rest)
    table = docs.sparkSession.createDataFrame(list(by_length.items()), "length long, runs array<array<long>>")
    run = F.element_at(F.filter("runs", lambda r: (r[0] <= F.col("number")) & (F.col("number") <= r[1])), 1)
    found = numbered.join(F.broadcast(table), "length").withColumn("run", run).withColumn("k", F.col("number") - F.col("run")[0])
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("run")[2] + F.col("k") % F.col("run")[3]).alias("sequence_id"),
        (F.col("run")[4] + F.floor(F.col("k") / F.col("run")[3]) * F.col("length")).cast("long").alias("offset"),
    )


def placed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, file, row)``: a row's place is its file's number in the folder and its place in the file.

    A table that isn't read from files is written first; its files follow its partitions.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs.select("doc_id", "text"), name="ordered")
    # Spark names files part-00012-...-c000: the task, and the file within the task.
    number = lambda pattern: F.regexp_extract("_metadata.file_name", pattern, 1).cast("long")
    file = number(r"^part-(\d+)-") * 100_000 + number(r"-c(\d+)\.")
    return docs.select("doc_id", "text", file.alias("file"), F.col("_metadata.row_index").alias("row"))


def pack_in_order(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``pack``, with sequences that follow the order of the rows.

    Best-fit decreasing runs within each ``group`` of consecutive documents; the group's sequences
    are numbered by the first document in each, and come after those of all groups before. So
    what holds of the documents' order at a group's end holds of the sequences there.
    """
    cut = written(pieces(placed(docs), tokenizer, window=window, carried=("file", "row")).drop("part", "nth"), name="pieces")
    earlier = lambda column, by: F.coalesce(F.sum(column).over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = cut.groupBy("file").agg((F.max("row") + 1).alias("n")).select("file", earlier("n", "file").alias("before"))
    ordered = cut.join(files.hint("merge"), "file").withColumn("place", F.col("before") + F.col("row"))
    ordered = ordered.withColumn("group", F.floor(F.col("place") / group)).drop("file", "row", "before")

    def fill(table: pa.Table) -> pa.Table:
        length, place, start = (table.column(c).to_numpy() for c in ("length", "place", "start"))
        order = np.lexsort((start, place, -length))
        sequence, offset, at = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64), 0
        # The plan's runs take the pieces in this order, one run after the other.
        for n_tokens, first, last, begin, n, begins in plan(dict(zip(*(x.tolist() for x in np.unique(length, return_counts=True)))), window):
            k = np.arange(last - first + 1)
            some = order[at : at + len(k)]
            sequence[some], offset[some] = begin + k % n, begins + k // n * n_tokens
            at += len(k)
        earliest = np.full(sequence.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(earliest, sequence, place)
        number = np.empty(len(earliest), np.int64)
        number[np.argsort(earliest, kind="stable")] = np.arange(len(earliest))
        return table.drop_columns(["place"]).append_column("sequence", pa.array(number[sequence])).append_column("offset", pa.array(offset))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group long, sequence long, offset long"
    filled = written(ordered.groupBy("group").applyInArrow(fill, schema), name="filled")
    groups = filled.groupBy("group").agg((F.max("sequence") + 1).alias("n")).select("group", earlier("n", "group").alias("before"))
    numbered = filled.join(groups.hint("merge"), "group")
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("sequence")).alias("sequence_id"), "offset")
