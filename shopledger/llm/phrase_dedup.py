"""Removal of passages that recur anywhere in the corpus, located by Aho-Corasick automata.

A window is ``window`` consecutive words. A window that starts at two places or more, in one document
or in several, recurs, and its words are removed wherever it stands.

1. Documents are packed into blocks of bounded size, written once. Of every window the smallest hash
   of its ``anchor``-word runs is chosen; equal windows choose equal anchors, so a window can recur
   only if its anchor stands at two places. Only anchors are shuffled here, about one in twelve words.
2. Windows whose anchor recurs are counted by their own hash, once per block with their number there.
   What stands at two places or more is confirmed, and each block is told which of its windows are.
3. A block's maximal runs of confirmed windows are its recurring passages. They are compiled into
   the block's automaton over word numbers, and the block's documents stream through it: every
   occurrence of a passage is located and its words leave. A document without a confirmed window
   can hold no passage and stays as it is. Automata are sharded along the documents, so a document
   passes one automaton, and each is bounded by its block.

A window or an anchor has one row per block that holds it, however often it stands there, so a very
common passage makes at most as many rows as there are blocks. Windows are told apart by 64-bit hashes.

Defined cases: NULL, empty and wordless texts have no words and no windows, their kept text is empty;
texts below one window lose nothing; repeated rows are places of their own, so copies of a text of
a window or more lose all their words; rows without doc_id count like others; an empty table gives no
rows. Only doc_id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle
from shopledger.llm.near_dedup import WordHashes, mixed

WINDOW = 35
ANCHOR = 12
PACK_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_PACKED = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


def words_of(text: bytes) -> list[bytes]:
    """Words as they stand; bytes split on exactly 0x20 and 0x09-0x0D."""
    return text.split()


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` words from every place on, built from halves."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    out, done, part, size = None, 0, h, 1
    while True:
        if k & size:
            out, done = (part, size) if out is None else (_glued(part, out, size, done), done + size)
        size *= 2
        if size > k:
            return mixed(out[: len(h) - k + 1])
        part = _glued(part, part, size // 2, size // 2)


def _glued(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> np.ndarray:
    """Unmixed hashes of a left run followed by a right run."""
    n = min(len(left), len(right) - n_left)
    return left[:n] * np.uint64(pow(_BASE, n_right, 2**64)) + right[n_left : n_left + n]


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest value of every stretch of ``width`` places."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = pick(out[:-size], out[size:]), 2 * size
    rest = width - size
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def chosen(h: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest anchor of every window, and all places' anchors that some window chose."""
    values = grams(h, anchor)
    width = window - anchor + 1
    least = sliding(values, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    reach = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return least, values[values == reach]


def _hashed(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def _counted(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values as signed numbers, and whether each stands once (1) or more often (2)."""
    if not values:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    found, times = np.unique(np.concatenate(values), return_counts=True)
    return found.view(np.int64), np.minimum(times, 2).astype(np.int32)


def packed(documents: DataFrame, window: int, anchor: int, pack_bytes: int) -> DataFrame:
    """block, docs (compressed), anchors, times: one row per block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = WordHashes(), TaskContext.get().partitionId() << 32
        ids, texts, anchors, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            option = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, _PACKED, options=option) as stream:
                stream.write_batch(
                    pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], schema=_PACKED
                    )
                )
            found, times = _counted(anchors)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    pa.array([found], pa.list_(pa.int64())),
                    pa.array([times], pa.list_(pa.int32())),
                ],
                names=["block", "docs", "anchors", "times"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = text.as_buffer().to_pybytes()
                if ids and size + len(raw) > pack_bytes:
                    yield block()
                    ids, texts, anchors, size, number = [], [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
                words = words_of(raw)
                if len(words) >= window:
                    anchors.append(chosen(_hashed(words, hashes), window, anchor)[1])
        if ids:
            yield block()

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    schema = "block long, docs binary, anchors array<long>, times array<int>"
    return settle(read.mapInArrow(run, schema), "phrase-blocks")


def recurring(rows: DataFrame) -> DataFrame:
    """block, found: per block the values (block, value, times) that stand at two places or more."""
    everywhere = F.sum("times").over(Window.partitionBy("value"))
    twice = rows.withColumn("places", everywhere).filter("places > 1")
    return twice.groupBy("block").agg(F.collect_list("value").alias("found"))


def _unpacked(blocks: pa.Table) -> Iterator[tuple[int | None, bytes]]:
    for docs in blocks.column("docs"):
        for row in pa.ipc.open_stream(docs.as_buffer()).read_all().to_pylist():
            yield row["doc_id"], row["text"]


def _found(lists: pa.Table) -> np.ndarray:
    """The block's sorted recurring values; none where no list reached it."""
    flat = lists.column("found").combine_chunks().flatten()
    return np.sort(np.asarray(flat).astype(np.int64).view(np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def windows(blocks: DataFrame, anchors: DataFrame, window: int, anchor: int) -> DataFrame:
    """block, value, times: the windows whose anchor recurs, once per block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, hashes, found = _found(right), WordHashes(), []
        number = None
        if left.num_rows and len(known):
            number = left.column("block")[0].as_py()
            for _, text in _unpacked(left):
                words = words_of(text)
                if len(words) >= window:
                    h = _hashed(words, hashes)
                    open_ = _among(chosen(h, window, anchor)[0], known)
                    if open_.any():
                        found.append(grams(h, window)[open_])
        values, times = _counted(found)
        block = pa.array(np.full(len(values), number or 0, np.int64))
        return pa.table([block, pa.array(values), pa.array(times)], names=["block", "value", "times"])

    sides = blocks.select("block", "docs").groupBy("block").cogroup(anchors.groupBy("block"))
    return sides.applyInArrow(run, "block long, value long, times int")


def _runs(marks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end (exclusive) of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def passages(texts: list[list[int]], marks: list[np.ndarray], window: int) -> set[tuple[int, ...]]:
    """The distinct word sequences covered by maximal runs of confirmed windows."""
    return {
        tuple(text[begin : end + window - 1])
        for text, confirmed in zip(texts, marks)
        for begin, end in _runs(confirmed)
    }


def automaton(phrases: set[tuple[int, ...]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for phrase in phrases:
        machine.add_word(phrase)
    machine.make_automaton()
    return machine


def covered(text: list[int], machine: ahocorasick.Automaton) -> np.ndarray:
    """Whether each word lies in an occurrence of a passage."""
    steps = np.zeros(len(text) + 1, np.int64)
    for last, length in machine.iter(tuple(text)):
        steps[last + 1 - length] += 1
        steps[last + 1] -= 1
    return np.cumsum(steps[:-1]) > 0


def located(blocks: DataFrame, confirmed: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed, text: every document without its recurring passages."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, hashes = _found(right), WordHashes()
        rows: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "text": []}
        numbers: dict[bytes, int] = {}
        docs, texts, marks = [], {}, []
        for at, (doc_id, text) in enumerate(_unpacked(left)):
            words = words_of(text)
            docs.append((doc_id, words))
            if len(known) and len(words) >= window:
                confirmed_here = _among(grams(_hashed(words, hashes), window), known)
                if confirmed_here.any():
                    texts[at] = [numbers.setdefault(w, len(numbers)) for w in words]
                    marks.append(confirmed_here)
        machine = automaton(passages(list(texts.values()), marks, window)) if texts else None
        for at, (doc_id, words) in enumerate(docs):
            kept = words
            if at in texts:
                gone = covered(texts[at], machine)
                kept = [w for w, lost in zip(words, gone.tolist()) if not lost]
            rows["doc_id"].append(doc_id)
            rows["n_words"].append(len(words))
            rows["n_removed"].append(len(words) - len(kept))
            rows["text"].append(b" ".join(kept).decode("utf-8", "replace"))
        schema = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
        return pa.table(rows, schema=pa.schema([*schema, ("text", pa.string())]))

    sides = blocks.select("block", "docs").groupBy("block").cogroup(confirmed.groupBy("block"))
    return sides.applyInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def without_repeats(
    documents: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    pack_bytes: int = PACK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space) of every document."""
    blocks = packed(documents, window, anchor, pack_bytes)
    zipped = F.explode(F.arrays_zip("anchors", "times")).alias("a")
    places = blocks.select("block", zipped).select("block", F.col("a.anchors").alias("value"), "a.times")
    anchors = recurring(places)
    confirmed = settle(recurring(windows(blocks, anchors, window, anchor)), "phrase-confirmed")
    return located(blocks, confirmed, window)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
h AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
m AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM h WHERE h IN (SELECT h FROM m)),
x AS (SELECT r, list(i) AS gone FROM c GROUP BY r),
k AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
             list_filter(w, lambda word, pos: gone IS NULL OR NOT list_contains(gone, pos)) AS kept
      FROM d LEFT JOIN x ON d.r = x.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
