"""Personal data: fixed patterns, and more found by bootstrapping from them.

One pass over the whole texts finds e-mail addresses, IP addresses, card and phone numbers. They are
the seeds. The pass also notes every other token that looks like an identifier, each with its
patterns: the word before it or after it together with the token's shape, contexts that leave the
shape out, and the form, which is the shape alone. Matches that fail their kind's check, such as a
card number's checksum, are known not to be one. Spark then scores the graph of patterns and
identifiers for a few rounds: a pattern is as trustworthy as the identifiers it occurs with, an
identifier as its best patterns. A context vouches for an identifier only as far as the other
identifiers of its form occur in trusted contexts too, so a form no seed has is learned from several
identifiers, never from one. Tokens are added as ``ctx_<kind>`` spans where a pattern of word and
shape, the form among the seeds, or context and form together reach ``least_confidence``; seeds stay
what they are.

Candidates are tokens of any length, runs of adjacent tokens with digits, and parts of base matches
that have too few or too many digits. Of a run or such a match all stretches are taken that have no
more digits than the longest base kind, besides the whole; stretches of more digits than that which
are not the whole are left out, so that a table of numbers costs linear work.

Defined cases: NULL text is empty and has no spans; repeated rows get the same spans, and copies of
a text count once in the graph; spans never overlap a span of a seed nor
each other, the leftmost and then the longest stays; ties between kinds go to the
first in the order email, ip, card, phone; an empty table gives no rows. Only doc_id and text are
read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import body, settle

KINDS = ("email", "ip", "card", "phone")
FAILED = "none"
# The base patterns. A match can only start where a run of its first characters
# starts, which the forms below say outright, so that long runs cost linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOCAL_CHARACTERS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = ".,;:!?()[]{}<>\"'"
BREAKS = ".,;:!?[]{}<>\"'"
PIECE = re.compile(r"[^\x20-]+")
# Longer values and forms are known by their digest, longer neighbours by their beginning.
LONGEST_KEY = 64
MOST_DIGITS = 19

ROUNDS = 4
LEAST_CONFIDENCE = 0.8
LEAST_SUPPORT = 5
# Marks of patterns; words and shapes hold no tab.
FORM = "form\t"
CONTEXT = "context\t"
# Unknown identifiers a pattern is assumed to have met before any of its own.
DOUBT = 1.0

SPAN = "struct<kind:string,start:int,end:int>"
FOUND = "array<struct<kind:string,start:int,end:int,value:string,patterns:array<string>>>"
SCHEMA = f"doc_id long, spans array<{SPAN}>, tokens {FOUND}, base_sha256 string"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(
    text: str,
) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(kind, start, end) by start, then kind; leftmost, non-overlapping per kind.

    And the look-alikes: addresses and card-length numbers that fail their check. And the spans of
    numbers dropped for their count of digits.
    """
    found, failed, dropped = [], [], []
    if "@" in text:
        floor = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > floor and text[start - 1] in LOCAL_CHARACTERS:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                floor = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
        else:
            failed.append((FAILED, *m.span()))
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 14 <= len(digits) <= 19:
            if luhn(digits):
                found.append((m.start(), 2, m.end()))
            else:
                failed.append((FAILED, *m.span()))
        else:
            dropped.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
            else:
                dropped.append(m.span())
    return [(KINDS[k], start, end) for start, k, end in sorted(found)], failed, dropped


def shape(token: str) -> str:
    """Digits as 0, letters as a, other characters as they are; runs of letters once."""
    digits = re.sub(r"[0-9]", "0", token)
    return re.sub(r"[^\W\d_]+", "a", digits)


def looks_like_identifier(token: str) -> bool:
    if len(token) < 5:
        return False
    return "@" in token[1:-1] or len(only_digits(token)) >= 4


def key(value: str) -> str:
    if len(value) <= LONGEST_KEY:
        return value
    return hashlib.sha256(value.encode("utf-8", "replace")).hexdigest()


def form_of(value: str) -> str:
    """The shape, and whether a number of a card's length passes the checksum."""
    digits = only_digits(value)
    return shape(value) + "!" * (14 <= len(digits) <= 19 and luhn(digits))


def patterns_of(value: str, before: str, after: str) -> list[str]:
    """Words with the shape, the form alone, and contexts with no more than a coarse class."""
    own = key(shape(value))
    coarse = "@" if "@" in value else "0"
    out = [FORM + key(form_of(value))]
    if before:
        out += [f"{before} {own}", f"{CONTEXT}{before} {coarse} "]
    if after:
        out += [f"{own} {after}", f"{CONTEXT} {coarse} {after}"]
    if before and after:
        out.append(f"{CONTEXT}{before} {after}")
    return out


def neighbour(word: str) -> str:
    return key(re.sub(r"[0-9]", "0", word.strip(MARKS).lower()))


def stretches(text: str, pieces: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The pieces, what adjacent ones make with at most MOST_DIGITS digits, and the whole."""
    digits = [len(only_digits(text[slice(*p)])) for p in pieces]
    for i, (start, _) in enumerate(pieces):
        total = 0
        for j in range(i, len(pieces)):
            total += digits[j]
            if j > i and total > MOST_DIGITS:
                break
            yield start, pieces[j][1]
    if len(pieces) > 1:
        yield pieces[0][0], pieces[-1][1]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without marks around it, but with the other bracket of one within several words."""
    inner = text[start:end].strip(MARKS)
    first = start + text[start:end].index(inner)
    last = first + len(inner)
    if " " in inner or "\t" in inner:
        opened, closed = inner.count("("), inner.count(")")
        if closed > opened and first > start and text[first - 1] == "(":
            first -= 1
        if opened > closed and last < end and text[last] == ")":
            last += 1
    return first, last


def occurrences(
    text: str,
    spans: list[tuple[str, int, int]],
    failed: list[tuple[str, int, int]],
    dropped: list[tuple[int, int]] = (),
) -> list[dict]:
    """Seeds, failed look-alikes and other candidates with their patterns, by start."""
    if not (spans or re.search(r"@|[0-9](?:[^0-9]*[0-9]){3}", text)):
        return []
    places: list[tuple[int, int, str | None]] = []
    words: list[tuple[int, int]] = []
    seeds = [(start, end, kind) for kind, start, end in spans]
    apart = lambda s, e: all(e <= a or s >= b for a, b, _ in seeds)
    seeds = sorted(seeds + [(s, e, kind) for kind, s, e in failed if apart(s, e)])
    runs: list[list[tuple[int, int]]] = []
    at, reach = 0, -1
    for m in TOKEN.finditer(text):
        start, end = m.span()
        words.append((start, end))
        while at < len(seeds) and seeds[at][1] <= start:
            at += 1
        covered = start < reach
        for s, e, kind in seeds[at:]:
            if s >= end:
                break
            covered = covered or e > start
            if start <= s < end:
                places.append((s, e, kind))
                reach = max(reach, e)
        if not covered:
            if only_digits(m.group()):
                # A run goes on over blanks on a line, up to a mark.
                follows = (
                    runs
                    and len(words) > 1
                    and runs[-1][-1] == words[-2]
                    and not text[words[-2][1] : start].strip(" \t")
                    and text[words[-2][1] - 1] not in BREAKS
                    and text[start] not in BREAKS
                )
                if follows:
                    runs[-1].append((start, end))
                else:
                    runs.append([(start, end)])
            elif "@" in m.group():
                runs.append([(start, end)])
    # What the seeds cover, without overlaps, to look up by bisection.
    covers: list[tuple[int, int]] = []
    for start, end, _ in seeds:
        if covers and start < covers[-1][1]:
            covers[-1] = (covers[-1][0], max(end, covers[-1][1]))
        else:
            covers.append((start, end))
    lefts = [start for start, _ in covers]
    for start, end in dropped:
        runs.append([(start + m.start(), start + m.end()) for m in PIECE.finditer(text[start:end])])
        runs.append([(start, end)])
    taken = set()
    for run in runs:
        single = set(run)
        for stretch in stretches(text, run):
            start, end = trimmed(text, *stretch)
            i = _index(lefts, end - 1)
            if (start, end) in taken or (i >= 0 and covers[i][1] > start):
                continue
            value = text[start:end]
            if not looks_like_identifier(value):
                continue
            kind = None
            if CARD.fullmatch(value) and 14 <= len(only_digits(value)) <= MOST_DIGITS:
                if not luhn(only_digits(value)):
                    # A number of its own is known not to be a card; several say nothing.
                    if stretch not in single:
                        continue
                    kind = FAILED
            taken.add((start, end))
            places.append((start, end, kind))
    starts = [s for s, _ in words]
    out = []
    for start, end, kind in sorted(places, key=lambda p: p[:2]):
        value = text[start:end]
        i = _index(starts, start)
        before = neighbour(text[slice(*words[i - 1])]) if i else ""
        j = _index(starts, end - 1) + 1
        after = neighbour(text[slice(*words[j])]) if j < len(words) else ""
        patterns = patterns_of(value, before, after)
        out.append(
            {"kind": kind, "start": start, "end": end, "value": key(value), "patterns": patterns}
        )
    return out


def _index(starts: list[int], at: int) -> int:
    return bisect_right(starts, at) - 1


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    found = pa.struct(
        [*kinds, pa.field("value", pa.string()), pa.field("patterns", pa.list_(pa.string()))]
    )
    for batch in batches:
        spans, tokens, digests = [], [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            base, failed, dropped = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            tokens.append(occurrences(text, base, failed, dropped))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(spans, pa.list_(kinds)),
                pa.array(tokens, pa.list_(found)),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "spans", "tokens", "base_sha256"],
        )


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, spans, tokens, base_sha256 per text; settled, as the graph and the result need it."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    found = rows.mapInArrow(_scan, SCHEMA)
    return settle(found.withColumn("_row", F.monotonically_increasing_id()), "pii-scan")


def _disjoint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of overlapping spans the leftmost and then the longest."""
    for batch in batches:
        kept = []
        for spans in batch.column("added").to_pylist():
            kept.append([])
            for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                if not kept[-1] or span["start"] >= kept[-1][-1]["end"]:
                    kept[-1].append(span)
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        columns = [batch.column("_row"), pa.array(kept, pa.list_(kinds))]
        yield pa.RecordBatch.from_arrays(columns, names=["_row", "added"])


def edges(scanned: DataFrame) -> DataFrame:
    """pattern, value, seed: distinct edges; seed is the kind, "none" for look-alikes, or NULL."""
    flat = scanned.select(F.explode("tokens").alias("t"))
    flat = flat.select("t.value", F.col("t.kind").alias("seed"), F.explode("t.patterns").alias("pattern"))
    return flat.groupBy("pattern", "value").agg(F.min("seed").alias("seed"))


def score_patterns(
    graph: DataFrame, rounds: int = ROUNDS, least_support: int = LEAST_SUPPORT
) -> DataFrame:
    """pattern, kind, confidence, support, seeded after some rounds over the graph.

    ``seeded`` is a form's confidence by the seeds alone, NULL for other patterns. Patterns of one
    identifier only say nothing about others and are left out from the start; each round's scores
    are written, so that a lost executor repeats one round.
    """
    sizes = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("support"))
    sizes = sizes.filter(F.col("support") >= least_support)
    graph = settle(graph.join(sizes, "pattern"), "pii-graph")
    is_form, is_context = F.col("pattern").startswith(FORM), F.col("pattern").startswith(CONTEXT)
    of_value = graph.filter(is_form).select("value", F.col("pattern").alias("_form"), "support")
    doubted = F.sum("score") / (F.first("support") + F.lit(DOUBT))
    seeds = graph.filter(F.col("seed") != FAILED)
    belief = seeds.select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scored = forms = seeded = None
    for _ in range(rounds):
        told = graph.select("pattern", "value", "support").join(belief, "value")
        scored = told.groupBy("pattern", "kind").agg(
            doubted.alias("confidence"), F.first("support").alias("support")
        )
        scored = settle(scored, "pii-patterns")
        if seeded is None:
            seeded = scored.filter(is_form).select(
                "pattern", "kind", F.col("confidence").alias("seeded")
            )
        voiced = graph.join(scored.drop("support"), "pattern").groupBy("value", "kind")
        voiced = voiced.agg(
            F.max(F.when(F.col("seed") == F.col("kind"), 1.0).otherwise(0.0)).alias("_seed"),
            F.max(F.when(~is_form & ~is_context, F.col("confidence"))).alias("_own"),
            F.max(F.when(is_context, F.col("confidence"))).alias("_context"),
            F.max(F.col("seed").isNotNull()).alias("_known"),
        )
        own = F.coalesce("_own", F.lit(0.0))
        known = F.when(F.col("_seed") == 1.0, 1.0).when(F.col("_known"), 0.0)
        first = known.otherwise(F.greatest(own, F.coalesce("_context", F.lit(0.0))))
        voiced = settle(voiced.withColumn("score", first), "pii-voiced")
        # A form's confidence counts all identifiers of the form, those without a context too.
        forms = of_value.join(voiced.select("value", "kind", "score"), "value")
        forms = forms.groupBy("_form", "kind").agg(
            doubted.alias("_by_form"), F.first("support").alias("support")
        )
        forms = settle(forms, "pii-forms")
        told = voiced.join(of_value.drop("support"), "value", "left")
        told = told.join(forms.drop("support"), ["_form", "kind"], "left")
        both = F.least(F.coalesce("_context", F.lit(0.0)), F.coalesce("_by_form", F.lit(0.0)))
        mark = known.otherwise(F.greatest(own, both))
        belief = settle(told.select("value", "kind", mark.alias("score")), "pii-belief")
    forms = forms.select(
        F.col("_form").alias("pattern"), "kind", F.col("_by_form").alias("confidence"), "support"
    )
    every = scored.filter(~is_form).unionByName(forms)
    return every.join(seeded, ["pattern", "kind"], "left")


def find(
    documents: DataFrame,
    rounds: int = ROUNDS,
    least_confidence: float = LEAST_CONFIDENCE,
    least_support: int = LEAST_SUPPORT,
) -> DataFrame:
    """doc_id, spans (base), added (struct of kind, start, end), base_sha256 per text."""
    scanned = scan(documents)
    patterns = score_patterns(edges(scanned), rounds, least_support)
    trusted = patterns.filter(F.greatest("confidence", "seeded") >= least_confidence)
    trusted = trusted.select("pattern", F.col("kind").alias("found"), "confidence", "seeded")
    open_tokens = scanned.select("_row", F.explode("tokens").alias("t"))
    open_tokens = open_tokens.filter(F.col("t.kind").isNull())
    open_tokens = open_tokens.select(
        "_row", "t.start", "t.end", F.explode("t.patterns").alias("pattern")
    )
    is_form, is_context = F.col("pattern").startswith(FORM), F.col("pattern").startswith(CONTEXT)
    best = lambda when: F.coalesce(F.max(F.when(when, F.col("confidence"))), F.lit(0.0))
    hits = open_tokens.join(trusted, "pattern").groupBy("_row", "start", "end", "found").agg(
        F.greatest(
            best(~is_form & ~is_context),
            F.coalesce(F.max("seeded"), F.lit(0.0)),
            F.least(best(is_form), best(is_context)),
        ).alias("_score")
    )
    order = F.when(F.lit(False), 0)
    for i, kind in enumerate(KINDS):
        order = order.when(F.col("found") == kind, -i)
    hits = hits.filter(F.col("_score") >= least_confidence).groupBy("_row", "start", "end")
    hits = hits.agg(F.max_by("found", F.struct("_score", order)).alias("found"))
    span = F.struct(F.concat(F.lit("ctx_"), "found").alias("kind"), "start", "end")
    added = hits.groupBy("_row").agg(F.collect_list(span).alias("added"))
    added = added.mapInArrow(_disjoint, f"_row long, added array<{SPAN}>")
    rows = scanned.drop("tokens").join(added, "_row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    return rows.select(
        "doc_id", "spans", F.coalesce("added", none).alias("added"), "base_sha256"
    )


def report(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    every = F.transform(
        F.concat("spans", "added"),
        lambda s: F.struct(
            s["start"], F.coalesce(rank[s["kind"]], F.lit(len(KINDS))), s["end"], s["kind"]
        ),
    )
    text = F.transform(
        F.sort_array(every),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
