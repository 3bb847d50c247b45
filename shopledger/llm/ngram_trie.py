"""Language model scores from Elias-Fano tries over all word pairs of the corpus.

The model is a Bayesian mixture of orders: p(w) = (c(w) + 1) / (N + V + 1), and after a word v
p(w | v) = (c(v w) + S p(w)) / (c(v) + S). A trie stores, under each last word, the words seen
before it with the quantised smoothed weight c(v w) + S p(w); the divisor belongs to the word before
and comes with that word's count. A pair the trie does not hold falls back to S p(w).

Texts are encoded once, in batches, to batch-local word numbers. Every batch asks for its distinct
pairs, each pair's trie shard counts the training part of all requests, builds its trie in a
memory-mapped file and answers with one byte per pair. So the corpus is shuffled as distinct pairs
per batch, shards hold a bounded number of pairs, and no table of words or pairs passes the driver.
Frequent last words are dealt over several shards by the word before; they are known from the word
counts, and at most eight per shard can be frequent.

Defined cases: NULL and empty texts are the end token alone; NULL ids are trained on; repeated rows
are counted and scored as often as they stand; an empty table gives no rows; without training texts
every score is the base score of unseen words. Only doc_id and text are read, so further columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log10

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle, token_list
from shopledger.llm.elias_fano import Trie, mapped

BATCH_CHARS = 6_000_000
SHARD_PAIRS = 2_000_000
STRENGTH = 64.0
WORD_BITS, BEFORE_BITS = 56, 40
LEVELS = 255
# The end token's hash; words' hashes are set to differ from it.
END = 1

ENCODED = (
    "batch long, doc_ids array<long>, held array<boolean>, sizes array<int>, ids binary,"
    " words binary, counts binary, n_train long, n_pairs long"
)
REQUESTS = "shard int, batch long, words binary, counts binary, fan binary, before binary, pair_counts binary"
REPLIES = "batch long, shard int, counts binary, codes binary"


def trained(doc_id: Column) -> Column:
    """Rows the model learns from: crc32 of the id modulo 7 is not 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) != 2, F.lit(True))


def shut(values: np.ndarray) -> bytes:
    """An array compressed by byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def opened(raw: bytes, kind: type, n: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def narrow(hashes: np.ndarray) -> np.ndarray:
    """Five bytes of each 40-bit number."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def widened(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(5, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :5] = planes.T
    return wide.view("<u8").ravel()


def shut_narrow(hashes: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(narrow(hashes).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


# ---- encoding ---------------------------------------------------------------------------------


class Batch:
    """Texts under way to one encoded row."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.doc_ids, self.held, self.tokens = [], [], []
        self.chars = 0

    def add(self, doc_id: int | None, held: bool, text: str) -> None:
        number = self.numbers
        found = token_list(text)
        ids = [number.setdefault(w, len(number) + 1) for w in found]
        ids.append(0)
        self.tokens.append(np.array(ids, np.int32))
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.chars += len(text)

    def row(self, name: int) -> dict:
        ids = np.concatenate(self.tokens)
        sizes = np.array([len(t) for t in self.tokens], np.int32)
        words = [END, *map(word_hash, self.numbers)]
        # Frequent words get small numbers, which compress well.
        order = np.argsort(-np.bincount(ids, minlength=len(words)), kind="stable")
        renamed = np.empty(len(words), np.int32)
        renamed[order] = np.arange(len(words))
        ids = renamed[ids]
        hashes = np.array(words, np.uint64)[order]
        learn = np.repeat(~np.array(self.held), sizes)
        counts = np.bincount(ids[learn], minlength=len(words)).astype(np.int64)
        pairs = np.unique(previous(ids, sizes, renamed[0]) * len(words) + ids)
        return {
            "batch": name,
            "doc_ids": self.doc_ids,
            "held": self.held,
            "sizes": sizes,
            "ids": shut(ids),
            "words": shut(hashes),
            "counts": shut(counts),
            "n_train": int(learn.sum()),
            "n_pairs": len(pairs),
        }


def word_hash(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word) >> (64 - WORD_BITS)
    return value if value != END else END + 1


def previous(ids: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; a text starts after an end."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[:1] = end
    return before


def encode(documents: DataFrame) -> DataFrame:
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (~trained(F.col("doc_id"))).alias("held"),
        body().alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [
                ("batch", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())),
                ("held", pa.list_(pa.bool_())),
                ("sizes", pa.list_(pa.int32())),
                *[(n, pa.binary()) for n in ("ids", "words", "counts")],
                ("n_train", pa.int64()),
                ("n_pairs", pa.int64()),
            ]
        )
        now = Batch()
        for batch in batches:
            for doc_id, held, text in zip(*batch.columns):
                now.add(doc_id.as_py(), held.as_py(), text.as_py())
                if now.chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist([now.row(name)], schema)
                    name, now = name + 1, Batch()
        if now.tokens:
            yield pa.RecordBatch.from_pylist([now.row(name)], schema)

    return rows.mapInArrow(run, ENCODED)


# ---- word counts ------------------------------------------------------------------------------


def vocabulary(encoded: DataFrame, shards: int, frequent: int) -> tuple[int, dict[int, int]]:
    """Number of distinct training words, and the words above ``frequent`` with their counts.

    The words above ``frequent`` are at most all training tokens divided by it.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column("words"), batch.column("counts")):
                hashes = opened(words.as_py(), np.uint64)
                seen = opened(counts.as_py(), np.int64)
                hashes, seen = hashes[seen > 0], seen[seen > 0]
                order = np.argsort(hashes)
                hashes, seen = hashes[order], seen[order]
                home = hashes % np.uint64(shards)
                out = {"shard": [], "words": [], "counts": []}
                for s in np.unique(home):
                    mine = home == s
                    out["shard"].append(int(s))
                    out["words"].append(shut(np.diff(hashes[mine], prepend=np.uint64(0))))
                    out["counts"].append(shut(seen[mine]))
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema(
                        [("shard", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())]
                    ),
                )

    def count(rows: pa.Table) -> pa.Table:
        hashes = [np.cumsum(opened(w.as_py(), np.uint64)) for w in rows["words"]]
        seen = [opened(c.as_py(), np.int64) for c in rows["counts"]]
        known, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, at, np.concatenate(seen))
        top = total > frequent
        return pa.table(
            {
                "n_words": [len(known)],
                "words": [known[top].astype(np.int64)],
                "totals": [total[top]],
            },
            schema=pa.schema(
                [
                    ("n_words", pa.int64()),
                    ("words", pa.list_(pa.int64())),
                    ("totals", pa.list_(pa.int64())),
                ]
            ),
        )

    dealt = encoded.select("words", "counts").mapInArrow(
        deal, "shard int, words binary, counts binary"
    )
    counted = dealt.groupBy("shard").applyInArrow(
        count, "n_words long, words array<long>, totals array<long>"
    )
    size, top = 0, {}
    for row in counted.collect():
        size += row["n_words"]
        top.update(zip(row["words"], row["totals"]))
    return size, top


# ---- requests, tries, replies -----------------------------------------------------------------


class Requests:
    """The distinct pairs of one batch, shard by shard, always in the same order."""

    def __init__(self, row: dict, shards: int, splits: dict[int, int]) -> None:
        self.ids = opened(row["ids"], np.int32).astype(np.int64)
        self.words = opened(row["words"], np.uint64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        n = len(self.words)
        end = int(np.flatnonzero(self.words == END)[0])
        self.before = previous(self.ids, self.sizes, end)
        # By hash of the last word, then of the word before.
        rank = np.argsort(np.argsort(self.words))
        self.by_rank = np.argsort(self.words)
        key = rank[self.ids] * n + rank[self.before]
        self.pairs, self.pair_of = np.unique(key, return_inverse=True)
        self.last = self.by_rank[self.pairs // n]
        self.pre = self.by_rank[self.pairs % n]
        self.pre_hash = self.words[self.pre] & np.uint64((1 << BEFORE_BITS) - 1)
        parts = np.ones(n, np.int64)
        if splits:
            hot = np.isin(self.words, np.fromiter(splits, np.uint64, len(splits)))
            parts[hot] = [splits[int(w)] for w in self.words[hot]]
        self.parts = parts
        base = (self.words % np.uint64(shards)).astype(np.int64)
        self.base, self.shards = base, shards
        shift = (self.pre_hash.astype(np.int64) >> 7) % parts[self.last]
        self.home = (base[self.last] + shift) % shards

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and pairs of a shard; a split word stands in each of its shards."""
        pairs = np.flatnonzero(self.home == shard)
        mine = (shard - self.base) % self.shards < self.parts
        words = self.by_rank[mine[self.by_rank]]
        return words, pairs

    def learned(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of words and of pairs."""
        learn = np.repeat(~self.held, self.sizes)
        return counts, np.bincount(self.pair_of[learn], minlength=len(self.pairs))


def ask(encoded: DataFrame, shards: int, splits: dict[int, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r = Requests(row, shards, splits)
                counts, pair_counts = r.learned(opened(row["counts"], np.int64))
                out = {k: [] for k in ("shard", "batch", "words", "counts", "fan", "before", "pair_counts")}
                for shard in range(shards):
                    words, pairs = r.of(shard)
                    if not len(words):
                        continue
                    hashes = r.words[words]
                    place = np.searchsorted(hashes, r.words[r.last[pairs]])
                    fan = np.bincount(place, minlength=len(words))
                    out["shard"].append(shard)
                    out["batch"].append(row["batch"])
                    out["words"].append(shut(np.diff(hashes, prepend=np.uint64(0))))
                    out["counts"].append(shut(counts[words]))
                    out["fan"].append(shut(fan.astype(np.int32)))
                    out["before"].append(shut_narrow(r.pre_hash[pairs]))
                    out["pair_counts"].append(shut(pair_counts[pairs].astype(np.int32)))
                schema = pa.schema(
                    [("shard", pa.int32()), ("batch", pa.int64())]
                    + [(n, pa.binary()) for n in ("words", "counts", "fan", "before", "pair_counts")]
                )
                yield pa.RecordBatch.from_pydict(out, schema)

    return encoded.drop("doc_ids", "n_train", "n_pairs").mapInArrow(run, REQUESTS)


def base_probability(counts: np.ndarray, tokens: int, words: int) -> np.ndarray:
    return (counts + 1.0) / (tokens + words + 1.0)


class Asked:
    """All requests to one shard: distinct words and pairs, and where each request finds its own."""

    def __init__(self, rows: list[dict]) -> None:
        self.batches = [row["batch"] for row in rows]
        words = [np.cumsum(opened(row["words"], np.uint64)) for row in rows]
        self.word_ends = np.cumsum([len(w) for w in words])
        fans = [opened(row["fan"], np.int32) for row in rows]
        self.pair_ends = np.cumsum([int(f.sum()) for f in fans])
        self.words, self.word_at = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.concatenate([opened(row["counts"], np.int64) for row in rows])
        self.counts = np.zeros(len(self.words), np.int64)
        np.add.at(self.counts, self.word_at, counts)
        owner = np.repeat(self.word_at, np.concatenate(fans)).astype(np.uint64)
        before = np.concatenate([widened(row["before"]) for row in rows])
        key = (owner << np.uint64(BEFORE_BITS)) | before
        self.pairs, self.pair_at = np.unique(key, return_inverse=True)
        seen = np.concatenate([opened(row["pair_counts"], np.int32) for row in rows])
        self.seen = np.bincount(self.pair_at, seen, len(self.pairs)).astype(np.int64)
        self.owner = (self.pairs >> np.uint64(BEFORE_BITS)).astype(np.int64)
        self.before = self.pairs & np.uint64((1 << BEFORE_BITS) - 1)


def build_trie(asked: Asked, tokens: int, words: int, strength: float) -> bytes:
    """The packed trie of one shard from all requests' training counts."""
    learned = asked.counts > 0
    last, totals = asked.words[learned], asked.counts[learned]
    place = np.cumsum(learned) - 1
    known = asked.seen > 0
    parent, before, seen = place[asked.owner[known]], asked.before[known], asked.seen[known]
    weight = seen + strength * base_probability(totals[parent], tokens, words)
    codes = quantised(np.log10(weight), tokens)
    return Trie.pack(last, totals, parent, before, codes, (WORD_BITS, BEFORE_BITS))


def step(tokens: int) -> float:
    """Distance of two levels: they span the logarithms from one pair to all tokens."""
    return max(1.0, log10(tokens + 10.0)) / (LEVELS - 1)


def quantised(logs: np.ndarray, tokens: int) -> np.ndarray:
    """1 to LEVELS; 0 means no pair."""
    return (np.clip(np.rint(logs / step(tokens)), 0, LEVELS - 1) + 1).astype(np.uint8)


def answer(requests: DataFrame, tokens: int, words: int, strength: float) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        asked = Asked(rows.to_pylist())
        with mapped(build_trie(asked, tokens, words, strength)) as trie:
            at = trie.find_last(asked.words)
            counts = np.zeros(len(at), np.int64)
            counts[at >= 0] = trie.counts[at[at >= 0]]
            codes = trie.find_pairs(at[asked.owner], asked.before)
        shard = rows["shard"][0].as_py()
        compress = zstandard.ZstdCompressor(level=1).compress
        out = {"batch": asked.batches, "shard": [shard] * len(asked.batches)}
        out["counts"] = [
            shut(part) for part in np.split(counts[asked.word_at], asked.word_ends[:-1])
        ]
        out["codes"] = [
            compress(part.tobytes()) for part in np.split(codes[asked.pair_at], asked.pair_ends[:-1])
        ]
        schema = [("batch", pa.int64()), ("shard", pa.int32())]
        schema += [("counts", pa.binary()), ("codes", pa.binary())]
        return pa.table(out, schema=pa.schema(schema))

    return requests.groupBy("shard").applyInArrow(run, REPLIES)


def _scores(
    row: dict, replies: list[dict], shards: int, splits: dict, tokens: int, words: int, strength: float
) -> dict:
    r = Requests(row, shards, splits)
    counts = np.zeros(len(r.words), np.int64)
    codes = np.zeros(len(r.pairs), np.uint8)
    for reply in replies:
        mine, pairs = r.of(reply["shard"])
        counts[mine] = opened(reply["counts"], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(reply["codes"])
        codes[pairs] = np.frombuffer(raw, np.uint8)
    base = np.log10(base_probability(counts, tokens, words))
    weight = np.where(
        codes > 0, (codes.astype(np.float64) - 1) * step(tokens), log10(strength) + base[r.last]
    )
    pair_logs = weight - np.log10(counts[r.pre] + strength)
    starts = np.cumsum(r.sizes) - r.sizes
    return {
        "doc_id": row["doc_ids"],
        "held_out": row["held"],
        "n_tokens": r.sizes,
        "n_known": np.add.reduceat((counts > 0)[r.ids].astype(np.int64), starts),
        "train_tokens": np.full(len(starts), tokens),
        "base_score": np.add.reduceat(base[r.ids], starts),
        "score": np.add.reduceat(pair_logs[r.pair_of], starts),
    }


def score(
    documents: DataFrame, strength: float = STRENGTH, shard_pairs: int = SHARD_PAIRS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    encoded = settle(encode(documents), "lm-encoded")
    sums = encoded.agg(F.sum("n_train").alias("tokens"), F.sum("n_pairs").alias("pairs")).first()
    tokens, pairs = sums["tokens"] or 0, sums["pairs"] or 0
    shards = max(1, ceil(pairs / shard_pairs))
    # Words with more than an eighth of a shard's tokens are dealt; at most eight per shard.
    frequent = max(1, tokens // (8 * shards))
    words, top = vocabulary(encoded, shards, frequent)
    splits = {w: min(shards, ceil(c / frequent)) for w, c in top.items()}
    replies = answer(ask(encoded, shards, splits), tokens, words, strength)
    replies = settle(replies, "lm-replies")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("train_tokens", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [
            pa.table(_scores(row, right.to_pylist(), shards, splits, tokens, words, strength), schema)
            for row in left.to_pylist()
        ]
        return pa.concat_tables(parts) if parts else schema.empty_table()

    kept = encoded.select("batch", "doc_ids", "held", "sizes", "ids", "words")
    both = kept.groupBy("batch").cogroup(replies.groupBy("batch"))
    return both.applyInArrow(
        finish,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
