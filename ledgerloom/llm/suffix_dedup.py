"""Suffix-array removal of repeated byte strings, exact.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
is removed; strings are judged on the input.

1. Texts are collapsed by their SHA-256. A class of two or more copies is
   repeated whole; one copy of it still serves the others as a partner.
2. A window of LENGTH bytes is assigned to its smallest ``SEED``-byte hash
   (leftmost of equals), so equal windows have the same seed at the same place.
   Windows whose seed occurs once in the corpus can't repeat.
3. A run of windows with one seed is a segment. Equal segments are collapsed
   with their number. Segments of a seed meet in one task, aligned at the seed.
   Per row, columns that no other row shares are cut away; neighbouring columns
   that split the rows alike become one symbol, which loses nothing, because
   rows that agree on one such column agree on all of them.
4. The suffix array of all rows' symbols (``suffix_array``: linear grouping by
   Lyndon prefixes) gives each place's longest match anywhere else, and with it
   the windows that repeat.
5. A seed with more than ``HOT`` occurrences isn't brought together: its distinct
   segments' windows are counted by a 128-bit hash in partial aggregates.

Cases: null text is empty; texts shorter than LENGTH lose nothing; rows that
repeat (also with one doc_id) are occurrences of their own; texts of any length
are read whole; an empty table gives no rows; other columns may be carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE_INVERSE, filter_bit, hash_filter, in_filter, mix64, powers, prefix_hash, small_batches, stored, text_or_empty, texts_of, with_fields
from .suffix_array import longest_matches, suffix_array

LENGTH, SEED, HOT = 200, 50, 20_000
#: Windows of one text handled at once; places within such a piece take the low 20 bits of a key.
PIECE = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
#: Segments whose bytes a task remembers to have given.
SEEN = 100_000
#: Symbols given to one suffix array.
SYMBOLS = 1 << 15


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    pad = np.concatenate([x, np.full((-len(x)) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    head = np.minimum.accumulate(pad, axis=1).ravel()
    tail = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def seeds(data: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Runs of windows with one seed: first window, last window, seed's place, seed's hash."""
    windows = len(data) - length + 1
    out = []
    for lo in range(0, max(windows, 0), PIECE):
        part = data[lo : min(lo + PIECE, windows) + length - 1]
        run = prefix_hash(part)
        hashes = mix64((run[seed:] - run[:-seed]) * powers(BASE_INVERSE, len(part) - seed + 1))
        keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_min(keys, length - seed + 1)
        place = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        out.append((first + lo, last + lo, place[first] + lo, hashes[place[first]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def _seed_rows(length: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch)
            found = [seeds(data[a:z], length, seed) for a, z in zip(offsets[:-1], offsets[1:])]
            ints = [pa.array([f[k].astype(np.int32) for f in found], pa.list_(pa.int32())) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *ints, pa.array([f[3].view(np.int64) for f in found], pa.list_(pa.int64()))],
                ["key", "doc_id", "lo", "hi", "at", "fp"],
            )

    return rows


def _segments(length: int):
    """Segments of a text's repeated seeds: id (two longs), window numbers and the bytes, which a task
    gives again only after ``SEEN`` other segments."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offsets = texts_of(batch)
            cid = batch.column(1).to_numpy(zero_copy_only=False)
            hits = batch.column(2)
            bound = hits.offsets.to_numpy()
            lo, hi, at, fp, hot = (hits.values.field(k).to_numpy(zero_copy_only=False) for k in range(5))
            s1, s2, segs, owner, pick = [], [], [], [], []
            for k in range(len(cid)):
                text = data[offsets[k] : offsets[k + 1]].tobytes()
                for j in range(bound[k], bound[k + 1]):
                    seg = text[lo[j] : hi[j] + length]
                    d = hashlib.blake2b(seg, digest_size=16, salt=int(at[j] - lo[j]).to_bytes(8, "little")).digest()
                    s1.append(int.from_bytes(d[:8], "little", signed=True))
                    s2.append(int.from_bytes(d[8:], "little", signed=True))
                    segs.append(None if d in seen else seg)
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(d)
                    owner.append(cid[k])
                    pick.append(j)
                if len(pick) > 20_000:
                    yield _segment_batch(owner, pick, lo, hi, at, fp, hot, s1, s2, segs)
                    s1, s2, segs, owner, pick = [], [], [], [], []
            if pick:
                yield _segment_batch(owner, pick, lo, hi, at, fp, hot, s1, s2, segs)

    return rows


def _segment_batch(owner, pick, lo, hi, at, fp, hot, s1, s2, segs) -> pa.RecordBatch:
    pick = np.array(pick, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(owner, pa.int64()), pa.array(lo[pick], pa.int32()), pa.array(hi[pick] - lo[pick], pa.int32()), pa.array(at[pick] - lo[pick], pa.int32()),
            pa.array(fp[pick], pa.int64()), pa.array(hot[pick]), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(segs, pa.binary()),
        ],
        ["cid", "lo", "more", "off", "fp", "hot", "s1", "s2", "seg"],
    )


class _Symbols:
    """Rows of symbols waiting for one suffix array."""

    def __init__(self, length: int):
        self.length = length
        self.text: list[int] = []
        self.rows: list[tuple] = []  # (row id, first place, columns where blocks start and end, first and last window column)
        self.next = 0

    def add_group(self, ids: list[int], segs: list[bytes], off: np.ndarray, more: np.ndarray) -> None:
        """One seed's distinct segments."""
        n, length = len(segs), self.length
        sizes = np.array([len(s) for s in segs])
        centre = int(off.max())
        wide = centre + int((sizes - off).max())
        x = np.full((n, wide), -1, np.int16)
        for r, s in enumerate(segs):
            x[r, centre - off[r] : centre - off[r] + sizes[r]] = np.frombuffer(s, np.uint8)
        left = _shared_extent(x[:, :centre][:, ::-1], [s[:o][::-1] for s, o in zip(segs, off)])
        right = _shared_extent(x[:, centre:], [s[o:] for s, o in zip(segs, off)])
        cols = np.arange(wide)
        valid = (cols >= (centre - left)[:, None]) & (cols < (centre + right)[:, None]) & ((left + right) >= length)[:, None]
        if not valid.any():
            return
        label = _labels(x, valid)
        cuts = np.concatenate([[0], np.flatnonzero((label[:, 1:] != label[:, :-1]).any(0)) + 1, [wide]])
        for r in range(n):
            blocks = np.flatnonzero(valid[r, cuts[:-1]])
            if len(blocks):
                symbols = self.next + 1 + blocks * n + label[r, cuts[blocks]]
                first = centre - int(off[r])
                self.rows.append((ids[r], len(self.text), cuts[blocks], cuts[blocks + 1], first, first + int(more[r])))
                self.text += symbols.tolist()
                self.text.append(-len(self.rows))  # an end of its own
        self.next += len(cuts) * n + 1

    def solve(self) -> list[tuple[int, list[tuple[int, int]]]]:
        """(row id, its repeated windows as ranges of window numbers, both ends included)."""
        best = longest_matches(self.text, suffix_array(self.text)) if self.text else []
        out = []
        for row, place, start, end, first, last in self.rows:
            m = np.array(best[place : place + len(start)])
            some = np.flatnonzero(m)
            reach = end[some + m[some] - 1] - self.length  # last window column that the match holds
            a = np.maximum(start[some], first)
            z = np.minimum(np.minimum(end[some] - 1, reach), last)
            found = [(int(p - first), int(q - first)) for p, q in zip(a, z) if p <= q]
            if found:
                out.append((row, found))
        self.text, self.rows, self.next = [], [], 0
        return out


def _shared_extent(x: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """Per row, the longest common prefix with any other row (missing cells are -1)."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    y = x[order]
    same = (y[1:] == y[:-1]) & (y[1:] >= 0)
    near = np.where(same.all(1), x.shape[1], np.argmin(same, axis=1)) if x.shape[1] else np.zeros(len(order) - 1, int)
    out = np.zeros(len(order), np.int64)
    out[order[1:]] = near
    out[order[:-1]] = np.maximum(out[order[:-1]], near)
    return out


def _labels(x: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Per column, the first row with the same byte; cells outside a row's extent name the row itself."""
    n, wide = x.shape
    own = np.arange(n)[:, None]
    if n <= 12:
        label = np.broadcast_to(own, x.shape).copy()
        for r in range(n - 1, -1, -1):
            label[(x == x[r]) & valid & valid[r]] = r
    else:
        first = np.full((257, wide), n, np.int64)
        at = np.where(valid, x, 256)
        cols = np.broadcast_to(np.arange(wide), x.shape)
        first[at[::-1].ravel(), cols[::-1].ravel()] = np.repeat(np.arange(n - 1, -1, -1), wide)
        label = first[at, cols]
    # outside its extent a row is apart from all others, also from itself inside
    return np.where(valid, label, own + n)


def _by_suffix_array(length: int):
    """Repeated windows of distinct segments that come ordered by seed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = _Symbols(length)
        ids: list[tuple[int, int]] = []
        group: list[tuple] = []
        now = None

        def close() -> None:
            if len(group) > 1:
                base = len(ids)
                ids.extend((g[0], g[1]) for g in group)
                waiting.add_group(list(range(base, base + len(group))), [g[2] for g in group], np.array([g[3] for g in group]), np.array([g[4] for g in group]))
            group.clear()

        def found() -> pa.RecordBatch:
            got = waiting.solve()
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[r][0] for r, _ in got], pa.int64()), pa.array([ids[r][1] for r, _ in got], pa.int64()),
                    pa.array([[{"a": a, "z": z} for a, z in f] for _, f in got], pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))),
                ],
                ["s1", "s2", "windows"],
            )
            ids.clear()
            return out

        for batch in batches:
            for fp, s1, s2, seg, off, more in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if fp != now:
                    close()
                    now = fp
                    if len(waiting.text) >= SYMBOLS:
                        yield found()
                group.append((s1, s2, seg, off, more))
        close()
        yield found()

    return rows


def _window_hashes(length: int):
    """128-bit hashes of all windows of segments of hot seeds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s1, s2, seg, more, many in zip(*(batch.column(k).to_pylist() for k in range(5))):
                digests = [hashlib.blake2b(seg[w : w + length], digest_size=16).digest() for w in range(more + 1)]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s1] * n, pa.int64()), pa.array([s2] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([many] * n, pa.int64()), pa.array(digests, pa.binary())],
                    ["s1", "s2", "w", "many", "digest"],
                )

    return rows


def may_match(rows: DataFrame, sent: Broadcast) -> DataFrame:
    """Rows whose key may be among those of a sent filter, which has a fixed size."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _filtered(batch, sent.value, True)

    return rows.withColumn("bit", filter_bit(F.col("key"))).mapInArrow(some, rows.schema)


def _filtered(batch: pa.RecordBatch, bits: np.ndarray, wanted: bool) -> pa.RecordBatch:
    """The rows whose ``bit``, the last column, is set (or isn't), without it."""
    hit = in_filter(bits, batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False))
    return batch.filter(pa.array(hit == wanted)).drop_columns(["bit"])


def repeated_windows(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(key, copies) of all texts, and (key, ranges of repeated window starts) of those that have any."""
    keyed = docs.select(F.unhex(F.sha2(text_or_empty(F.col("text")), 256)).alias("key"), "doc_id", "text")
    schema = with_fields(keyed.select("key", "doc_id"), "lo array<int>, hi array<int>, at array<int>, fp array<long>")
    found = keyed.mapInArrow(_seed_rows(length, seed), schema)
    classes = found.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.first(F.struct("lo", "hi", "at", "fp")).alias("s"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("cid"), "key", "copies", "rep", "s.*"), "classes")

    # seeds that occur again
    runs = classes.select("cid", F.explode(F.arrays_zip("lo", "hi", "at", "fp")).alias("r")).select("cid", "r.*")
    # written before the join, and its rows after it: a hot seed's rows can be split between plain exchanges
    again = stored(runs.groupBy("fp").count().where("count > 1").select("fp", (F.col("count") > hot).alias("hot")), "again")
    met = stored(runs.join(again, "fp").select("cid", F.struct("lo", "hi", "at", "fp", "hot").alias("hit")), "met")
    hits = met.groupBy("cid").agg(F.collect_list("hit").alias("hits"))
    hits = hits.join(classes.select("cid", "key", "rep"), "cid")

    # their segments, from one text of each class
    hits = stored(hits, "hits")
    given = may_match(keyed, docs.sparkSession.sparkContext.broadcast(hash_filter(hits, "key"))).withColumnRenamed("key", "k").withColumnRenamed("doc_id", "d")
    texts = given.join(hits, (F.col("k") == F.col("key")) & F.col("d").eqNullSafe(F.col("rep"))).select("text", "cid", "hits")
    segments = stored(
        texts.mapInArrow(_segments(length), "cid long, lo int, more int, off int, fp long, hot boolean, s1 long, s2 long, seg binary"), "segments"
    )
    distinct = segments.groupBy("s1", "s2").agg(
        F.count("*").alias("many"), *[F.first(x).alias(x) for x in ("fp", "off", "more", "hot")], F.first("seg", ignorenulls=True).alias("seg")
    )
    distinct = stored(distinct, "distinct")

    windows = "s1 long, s2 long, windows array<struct<a:int,z:int>>"
    cold = distinct.where("not hot").select("fp", "s1", "s2", "seg", "off", "more")
    by_array = cold.repartition("fp").sortWithinPartitions("fp").mapInArrow(_by_suffix_array(length), windows)
    warm = distinct.where("hot").select("s1", "s2", "seg", "more", "many").mapInArrow(
        _window_hashes(length), "s1 long, s2 long, w int, many long, digest binary"
    )
    counted = warm.groupBy("digest").agg(F.sum("many").alias("times")).where("times > 1")
    by_count = warm.join(counted, "digest", "left_semi").groupBy("s1", "s2").agg(F.collect_list(F.struct(F.col("w").alias("a"), F.col("w").alias("z"))).alias("windows"))
    whole = distinct.where("many > 1").select("s1", "s2", F.array(F.struct(F.lit(0).alias("a"), F.col("more").alias("z"))).alias("windows"))
    results = by_array.union(by_count).union(whole)
    ranges = (
        segments.select("cid", "lo", "s1", "s2").join(results, ["s1", "s2"])
        .select("cid", F.explode(F.transform("windows", lambda w: F.struct((F.col("lo") + w["a"]).alias("a"), (F.col("lo") + w["z"]).alias("z")))).alias("r"))
        .groupBy("cid").agg(F.collect_list("r").alias("ranges"))
    )
    ranges = classes.select("cid", "key").join(ranges, "cid").select("key", "ranges")
    return classes.select("key", "copies"), ranges


def _cover(n: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [start, end)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], np.append(ends[:-1][new[1:]], ends[-1:])


def _cut(length: int, keep: bool, known: Broadcast | None = None):
    """With ``known``, a sent filter: only of rows that surely aren't in it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if known is not None:
                batch = _filtered(batch, known.value, False)
            data, offsets = texts_of(batch)
            copies = batch.column(2).to_numpy(zero_copy_only=False)
            ranges = batch.column(3)
            bound = ranges.offsets.to_numpy()
            first, last = (ranges.values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            out = []
            for k in range(batch.num_rows):
                text = data[offsets[k] : offsets[k + 1]]
                n = len(text)
                if copies[k] > 1 and n >= length:
                    spans = (np.array([0]), np.array([n]))
                elif bound[k] < bound[k + 1]:
                    own = slice(bound[k], bound[k + 1])
                    spans = _cover(n, first[own], last[own] + length)
                else:
                    spans = (np.zeros(0, int), np.zeros(0, int))
                raw, at, parts = text.tobytes(), 0, []
                for a, z in zip(*spans):
                    parts.append(raw[at:a])
                    at = int(z)
                parts.append(raw[at:])
                left = b"".join(parts)
                text = left.decode("utf-8", "ignore") if keep else None
                out.append((n, n - len(left), len(spans[0]), hashlib.sha256(left).hexdigest(), text))
            n, removed, spans, sha, left = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(left, pa.string())],
                ["carried", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return rows


def dedupe(docs: DataFrame, carry: list[str], keep: bool = True, length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """Columns ``carry``, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``keep``, the remaining text (null otherwise), a row for each row. A cut
    inside a code point drops the point's rest from the text; the SHA-256 is
    that of the remaining bytes."""
    spark = docs.sparkSession
    with small_batches(spark):
        classes, ranges = repeated_windows(docs, length, seed, hot)
        known = classes.join(ranges, "key", "left").where("copies > 1 or ranges is not null")
        known = stored(known, "known")
        sent = spark.sparkContext.broadcast(hash_filter(known, "key"))
        given = docs.select(F.unhex(F.sha2(text_or_empty(F.col("text")), 256)).alias("key"), F.struct(*carry).alias("carried"), "text")
        theirs = may_match(given, sent).join(known, "key", "left").select("carried", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "ranges")
        # filtered where they are cut: a worker fewer for each task, and the texts cross once
        none = F.lit(None).cast(known.schema["ranges"].dataType).alias("ranges")
        others = given.select("carried", "text", F.lit(1).cast("long").alias("copies"), none, filter_bit(F.col("key")).alias("bit"))
        schema = with_fields(given.select("carried"), "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
        cut = theirs.mapInArrow(_cut(length, keep), schema).union(others.mapInArrow(_cut(length, keep, sent), schema))
        if not keep:  # without texts it is small, and written here its batches are small too
            cut = stored(cut, "cut")
    return cut.select("carried.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
