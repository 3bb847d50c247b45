"""Near duplicates by fast similarity sketching, banding and exact verification.

Sketch: in round i every shingle throws one value into one of ``coordinates`` bins, and a bin keeps
its first round's smallest; rounds go on until every bin is filled, and the later rounds throw at
one fixed bin each, so that all bins fill after twice as many rounds at the latest. Long texts are
done after a round or two. Bins agree with the texts' similarity as probability, with the
concentration of independent minima, so groups of bins make bands.

Texts of equal words are one class, represented by the smallest id. Representatives that share a
band are candidates, but their pairs are not listed: each round, every bucket that still holds
unconnected members compares them to one hub, which then leaves. A few rounds join large groups of
copies into one component; what remains unconnected in a bucket is compared in blocks with all its
other members, so that no linked pair of a bucket is missed. Links are confirmed on full sets.

Defined cases: NULL, empty and wordless texts have no shingles and link to nothing; fewer words than
a shingle make one shingle of all; rows of one id are one node; rows without id stay single and are
kept; repeated rows all get a row; an empty table gives none. Only doc_id and text are read, so
further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle, token_list

SIMILAR = 80
BANDS = 32
ROWS = 5
HUB_ROUNDS = 4
CHUNK_ROWS = 256
CHUNK_SHINGLES = 300_000

_EMPTY = np.uint64(2**64 - 1)
_ROUND_BITS = np.uint64(54)
_LOW = np.uint64(2**54 - 1)


class WordHashes(dict):
    """64-bit hashes of words, computed once per word and task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - k + 1
    total = h[:n].copy()
    for i in range(1, k):
        total = mixed(total) + h[i : n + i]
    return np.unique(mixed(total))


def sketch(elements: np.ndarray, coordinates: int) -> np.ndarray:
    """The filled bins of a non-empty set: (round, value) packed into 64 bits."""
    bins = np.full(coordinates, _EMPTY)
    for i in range(2 * coordinates):
        h = mixed(elements + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(i) << _ROUND_BITS) | (h & _LOW)
        if i < coordinates:
            at = ((h >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
            np.minimum.at(bins, at.astype(np.intp), value)
        else:
            bins[i - coordinates] = min(bins[i - coordinates], value.min())
        if not (bins == _EMPTY).any():
            break
    return bins


def band_keys(bins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for column in bins.reshape(bands, rows).T:
        total = mixed(total) + column
    return mixed(total).view(np.int64)


def sketched(documents: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, class_key (NULL without words), keys; one pass over the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, classes, keys = [], [], []
            for value in batch.column("text"):
                tokens = token_list(value.as_py())
                found = shingles(tokens, words, hashes)
                sizes.append(len(found))
                classes.append(xxhash.xxh3_128_hexdigest(b" ".join(tokens)) if tokens else None)
                bins = sketch(found, bands * rows) if tokens else None
                keys.append(None if bins is None else band_keys(bins, bands, rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.string()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class_key", "keys"],
            )

    rows_in = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    schema = "doc_id long, n_shingles long, class_key string, keys array<long>"
    return rows_in.mapInArrow(run, schema)


def similar_sizes(a: Column, b: Column, similar: int = SIMILAR) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    return 100 * F.least(a, b) >= similar * F.greatest(a, b)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left with every right set of one block."""
    l_all, r_all = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(np.unique(l_all), np.unique(r_all))
    out = np.zeros((len(left), len(right)), np.float32)

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, flat)
        hit = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == flat)
        return owner[hit], at[hit]

    if not len(shared):
        return out
    (lo, la), (ro, ra) = places(left, l_all), places(right, r_all)
    step = 4096
    for begin in range(0, len(shared), step):
        li, ri = (la >= begin) & (la < begin + step), (ra >= begin) & (ra < begin + step)
        a = np.zeros((len(left), step), np.float32)
        b = np.zeros((len(right), step), np.float32)
        a[lo[li], la[li] - begin] = 1
        b[ro[ri], ra[ri] - begin] = 1
        out += a @ b.T
    return out


def confirmed(blocks: DataFrame, texts: DataFrame, words: int, similar: int) -> DataFrame:
    """a, b: the linked pairs of differing components between the two sides of each block.

    ``blocks``: block, side (0 or 1), id, comp. Blocks are bounded in rows and shingles.
    """

    def compare(table: pa.Table) -> pa.Table:
        hashes = WordHashes()
        sides: tuple[list, list] = ([], [])
        for row in table.to_pylist():
            found = shingles(token_list(row["text"]), words, hashes)
            sides[row["side"]].append((row["id"], row["comp"], found))
        pairs = {"a": [], "b": []}
        if sides[0] and sides[1]:
            same = overlaps([s for *_, s in sides[0]], [s for *_, s in sides[1]])
            sizes = [np.array([len(s) for *_, s in side]) for side in sides]
            union = sizes[0][:, None] + sizes[1][None, :] - same
            comps = [np.array([c for _, c, _ in side]) for side in sides]
            linked = (100 * same >= similar * union) & (comps[0][:, None] != comps[1][None, :])
            for i, j in zip(*np.nonzero(linked)):
                a, b = sorted((sides[0][i][0], sides[1][j][0]))
                pairs["a"].append(a)
                pairs["b"].append(b)
        return pa.table(pairs, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    with_text = blocks.hint("merge").join(texts, "id").select("block", "side", "id", "comp", "text")
    return with_text.groupBy("block").applyInArrow(compare, "a long, b long").distinct()


def chunks(rows: Column, shingle_count: Column) -> Column:
    by_rows, by_size = F.ceil(rows / CHUNK_ROWS), F.ceil(shingle_count / CHUNK_SHINGLES)
    return F.greatest(by_rows, by_size, F.lit(1)).cast("long")


def _chunk(count: Column | str) -> Column:
    count = F.col(count) if isinstance(count, str) else count
    return F.pmod(F.xxhash64("id", F.lit(7)), count)


def hub_blocks(pairs: DataFrame) -> DataFrame:
    """Blocks of one hub and a share of the members to compare with it."""
    sizes = pairs.groupBy("hub").agg(
        chunks(F.count(F.lit(1)), F.sum("n")).alias("n_chunks"), F.first("hub_comp").alias("hub_comp")
    )
    members = pairs.join(sizes.select("hub", "n_chunks"), "hub")
    members = members.select(
        F.concat_ws("-", "hub", _chunk("n_chunks")).alias("block"),
        F.lit(1).alias("side"),
        "id",
        "comp",
    )
    hubs = sizes.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)))
    hubs = hubs.select(
        F.concat_ws("-", "hub", "c").alias("block"),
        F.lit(0).alias("side"),
        F.col("hub").alias("id"),
        F.col("hub_comp").alias("comp"),
    )
    return members.unionByName(hubs)


def rest_blocks(members: DataFrame) -> DataFrame:
    """Blocks that compare, per bucket, members outside its largest component with all members."""
    parts = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    buckets = parts.groupBy("key").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"),
        F.count(F.lit(1)).alias("n_comps"),
        F.sum("c").alias("c"),
        F.sum("s").alias("s"),
        F.max(F.struct("c", "comp", "s")).alias("top"),
    )
    buckets = buckets.filter("n_comps > 1").select(
        "key",
        "main",
        chunks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("n_few"),
        chunks(F.col("c"), F.col("s")).alias("n_all"),
    )
    rows = members.join(buckets, "key")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    few = rows.filter("comp != main").withColumn("i", _chunk("n_few")).withColumn("j", up_to("n_all"))
    all_ = rows.withColumn("j", _chunk("n_all")).withColumn("i", up_to("n_few"))
    name = F.concat_ws("-", "key", "i", "j").alias("block")
    few = few.select(name, F.lit(0).alias("side"), "id", "comp")
    return few.unionByName(all_.select(name, F.lit(1).alias("side"), "id", "comp"))


def spread(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the links' smaller ends told the larger ones, and once more through labels."""
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("to"))
    )
    told = ends.join(labels.withColumnsRenamed({"id": "to", "comp": "near"}), "to")
    told = told.groupBy("id").agg(F.min("near").alias("near"))
    lower = labels.join(told, "id", "left").select("id", F.least("comp", "near").alias("comp"))
    lower = settle(lower, "dup-labels")
    jump = lower.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    jumped = lower.join(jump, "comp", "left")
    return settle(jumped.select("id", F.least("comp", "top").alias("comp")), "dup-labels")


def components(links: DataFrame) -> DataFrame:
    """id, comp: the smallest id of each node's component, for nodes with links.

    Every pass points each node at its smallest neighbour, follows the pointers to their ends by
    doubling, and contracts; the passes grow with the logarithm of the component, not its length.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        point = both.groupBy("u").agg(F.min("v").alias("v"))
        point = settle(point.select("u", F.least("u", "v").alias("top")), "dup-point")
        while True:
            ahead = point.select(F.col("u").alias("top"), F.col("top").alias("next"))
            moved = settle(
                point.join(ahead, "top").select("u", F.col("next").alias("top"), "top").toDF(
                    "u", "top", "old"
                ),
                "dup-point",
            )
            point = moved.select("u", "top")
            if moved.filter("top != old").isEmpty():
                break
        if labels is None:
            labels = point.toDF("id", "comp")
        else:
            up = point.toDF("comp", "top")
            raised = labels.join(up, "comp", "left")
            labels = settle(
                raised.select("id", F.coalesce("top", "comp").alias("comp")), "dup-labels"
            )
        edges = edges.join(point.toDF("u", "pu"), "u").join(point.toDF("v", "pv"), "v")
        edges = edges.filter("pu != pv").select(
            F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")
        )
        edges = settle(edges.distinct(), "dup-edges")
        if edges.isEmpty():
            return labels


def links_of(
    classes: DataFrame, texts: DataFrame, words: int, similar: int, rounds: int
) -> DataFrame:
    """a, b: confirmed links that connect every linked pair of representatives sharing a bucket.

    ``classes``: id, n, keys of the representatives; ``texts``: id, text of them.
    """
    keyed = classes.select("id", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    shared = shared.filter("lo < hi").select("key")
    members = settle(keyed.join(shared, "key"), "dup-members")
    active = settle(members.select("id").distinct(), "dup-active")
    # Merge joins at every size: ids grow with the documents and are no side to broadcast.
    texts = settle(texts.join(active.hint("merge"), "id"), "dup-texts")
    labels = active.select("id", F.col("id").alias("comp"))
    links = None
    for i in range(rounds):
        now = members.select("key", "id", "n").join(labels, "id")
        hub = F.min_by(F.struct("id", "n", "comp"), F.xxhash64("id", F.lit(i)))
        hubs = now.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub.alias("h")
        )
        hubs = hubs.filter("lo != hi").select("key", "h")
        members = settle(now.join(hubs, "key").filter("id != h.id"), "dup-members")
        pairs = members.filter(
            (F.col("comp") != F.col("h.comp")) & similar_sizes(F.col("n"), F.col("h.n"), similar)
        )
        pairs = pairs.select(
            F.col("h.id").alias("hub"), F.col("h.comp").alias("hub_comp"), "id", "n", "comp"
        ).distinct()
        pairs = settle(pairs, "dup-pairs")
        if pairs.isEmpty():
            break
        found = settle(confirmed(hub_blocks(pairs), texts, words, similar), "dup-links")
        links = found if links is None else links.unionByName(found)
        labels = spread(labels, found)
    left = members.select("key", "id", "n").join(labels, "id")
    rest = settle(confirmed(rest_blocks(left), texts, words, similar), "dup-links")
    return rest if links is None else links.unionByName(rest)


def near_duplicates(
    documents: DataFrame,
    words: int = 5,
    similar: int = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
    rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document."""
    sketches = settle(sketched(documents, words, bands, rows), "dup-sketch")
    classes = sketches.filter(F.col("class_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = classes.groupBy("class_key").agg(
        F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("n_shingles").alias("n")
    )
    classes = settle(classes, "dup-classes")
    # A representative's text, found by its id; rows of one id and class hold the same words.
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), body().alias("text"))
    links = links_of(classes.select("id", "n", "keys"), texts, words, similar, rounds)
    comps = components(links)
    of_class = classes.select("class_key", "id").join(comps, "id", "left")
    of_class = of_class.select("class_key", F.coalesce("comp", "id").alias("component_id"))
    # One row per class, so a hot class makes no more rows than it has documents.
    rows_out = sketches.select("doc_id", "n_shingles", "class_key")
    rows_out = rows_out.join(of_class, "class_key", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), "doc_id")
    return rows_out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(documents: DataFrame, **options: int) -> DataFrame:
    """The documents kept: of each group the one with the smallest id, in their own columns.

    Where ids repeat, one row of the id stays.
    """
    found = settle(near_duplicates(documents, **options), "dup-result")
    ids = found.filter("kept").groupBy(F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    ids = settle(ids, "dup-kept")
    # The documents' columns wait in a struct, so that none can clash.
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("of"))
    kept = rows.join(ids.hint("merge"), F.col("of").eqNullSafe(F.col("id")))
    if not ids.filter("n > 1 AND id IS NOT NULL").isEmpty():
        single = kept.filter("n = 1 OR of IS NULL")
        kept = single.unionByName(kept.filter("n > 1 AND of IS NOT NULL").dropDuplicates(["of"]))
    return kept.select("row.*")
