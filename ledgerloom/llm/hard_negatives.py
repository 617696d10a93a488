"""Hard-negative mining by coordinate pruning over length buckets (LEMP).

A row's score is its integer inner product with the anchor. An anchor's
positives are its best rows of the same label; for each positive, its negatives
are the best rows of other labels whose score lies within a band below the
positive's score. Both are one search: the best ``k`` rows of a wanted label
side with a score in [lo, hi].

Rows are ranked by length over sorted ranges and cut into tiles of ``TILE``
rows, each stored as one row of flat arrays. Within a tile, buckets of
``BUCKET`` rows of similar length hold their coordinates as sorted lists, with
each row's place in every list. A search takes a tile's buckets longest first:

* a bucket whose longest row can't reach ``lo`` is skipped;
* the score's band, divided by the lengths, bounds the angle to the anchor.
  For the anchor's ``FOCUS`` largest coordinates that angle leaves a range of
  feasible values; binary search in the bucket's sorted list turns it into
  places, and the rows within the places of all focus coordinates are the
  candidates;
* candidates are scored exactly in integers, and ``lo`` rises to the k-th best.

The first tile, which has the longest rows, is searched alone first, so that all
tiles start from a raised ``lo``. Anchors are dealt in blocks to every tile, and
the best of a search over all tiles are its result: nothing is capped.

Cases: rows with a null id, label or vector or a null or non-finite component
take no part; rows that share an id are one row, the smallest (label, vector);
vectors meet only those of the same dimension, and empty ones score 0 with each
other; zero vectors score 0; ties go to smaller ids; anchors without positives,
and positives without negatives, have no rows; an empty table gives none.
Components beyond 2^28 in size may leave 64-bit scores. Other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import number_rows

from .common import shared_dir, stored, track

#: Rows of a tile and of a bucket; searches of a block, and at once.
TILE, BUCKET, SEARCH_BLOCK, BATCH = 2048, 512, 4096, 1024
#: Coordinates of the anchor, largest first, that bound the candidates.
FOCUS = 4
#: Wider than any score.
NO_BOUND = 1 << 62
#: Of the larger bounds that rounding may cost.
SLACK = 1e-6
#: Scores below this are exact in double precision.
EXACT = float(1 << 53)

TILES = "dim int, tile long, n int, ids binary, labels binary, ints binary, places binary, sorted binary"
FOUND = "anchor_id long, positive_id long, vec_id long, score long"


def usable(vectors: DataFrame, scale: int, relabel: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """vec_id, label and v (whole numbers: floor of ``scale`` times each component) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    label = F.col("label").cast("long")
    label = relabel(F.col("vec_id"), label) if relabel else label
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    one = rows.select("vec_id", F.struct(label.alias("label"), v.alias("v")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r"))
    return one.select("vec_id", "r.label", "r.v")


# --- tiles --------------------------------------------------------------------

def _units(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 (zero rows stay zero) and their lengths."""
    x = ints.astype(np.float64)
    lengths = np.sqrt((x * x).sum(axis=1))
    return x / np.where(lengths > 0, lengths, 1)[:, None], lengths


def _tiled(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One tile as a row; per bucket and coordinate, the sorted values and each row's place among them."""
    rows, dim = rows.sort_values("place"), int(key[0])
    ints = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), dim)
    units, _ = _units(ints)
    places, values = np.empty((dim, len(rows)), np.int16), np.empty((dim, len(rows)), np.float32)
    for lo in range(0, len(rows), BUCKET):
        own = units[lo : lo + BUCKET].T.astype(np.float32)
        order = np.argsort(own, axis=1, kind="stable")
        np.put_along_axis(places[:, lo : lo + BUCKET], order, np.arange(own.shape[1], dtype=np.int16)[None, :], 1)
        values[:, lo : lo + BUCKET] = np.take_along_axis(own, order, 1)
    return pd.DataFrame([{
        "dim": dim, "tile": key[1], "n": len(rows), "ids": rows["vec_id"].to_numpy(np.int64).tobytes(),
        "labels": rows["label"].to_numpy(np.int64).tobytes(), "ints": ints.tobytes(), "places": places.tobytes(), "sorted": values.tobytes()}])


def tiles(rows: DataFrame) -> DataFrame:
    """The stored tiles of ``rows`` (as of :func:`usable`), the longest rows in tile 0 of their dimension."""
    length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    sized = rows.select("vec_id", "label", "v", F.size("v").alias("dim"), length.alias("length"))
    folder = track(f"{shared_dir(rows.sparkSession)}/llm-{uuid.uuid4().hex}", "numbered")
    placed = number_rows(sized, ["dim"], ["length desc", "vec_id"], "place", folder)
    dealt = placed.select("vec_id", "label", "v", "place", "dim", F.expr(f"(place - 1) div {TILE}").alias("tile"))
    return stored(dealt.groupBy("dim", "tile").applyInPandas(_tiled, TILES), "tiles")


# --- searches -----------------------------------------------------------------

def feasible(focus: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that a unit vector's coordinate can have when its cosine with
    the anchor lies in [least, most] and the anchor's own coordinate is ``focus``.

    The vector stands at an angle between arccos(most) and arccos(least) from
    the anchor, and the anchor at the angle arccos(focus) from the axis.
    """
    axis, near, far = np.arccos(np.clip(focus, -1, 1)), np.arccos(np.clip(most, -1, 1)), np.arccos(np.clip(least, -1, 1))
    near, far = near[:, None], far[:, None]
    high = np.where((near <= axis) & (axis <= far), 1.0, np.maximum(np.cos(near - axis), np.cos(far - axis)))
    low = np.where((near <= np.pi - axis) & (np.pi - axis <= far), -1.0, np.minimum(np.cos(near + axis), np.cos(far + axis)))
    return low - SLACK, high + SLACK


def candidates(units: np.ndarray, lengths: np.ndarray, lo: np.ndarray, hi: np.ndarray, row_lengths: np.ndarray,
               places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which rows of a bucket can score within [lo, hi] with each anchor (anchors x rows)."""
    longest, shortest, n = row_lengths.max(), row_lengths.min(), len(row_lengths)
    with np.errstate(divide="ignore", invalid="ignore"):
        least = lo / (lengths * np.where(lo > 0, longest, shortest))
        most = hi / (lengths * np.where(hi > 0, shortest, longest))
    # nothing is known of the angle to or from a zero vector: its score is 0
    zero = (lengths == 0) | (shortest == 0)
    can_be_zero = zero & (lo <= 0) & (hi >= 0)
    least, most = np.where(can_be_zero | ~np.isfinite(least), -1.0, least) - SLACK, np.where(can_be_zero | ~np.isfinite(most), 1.0, most) + SLACK
    reach = (least <= 1) & (most >= -1) & (lo <= hi) & ~((lengths * longest == 0) & ~can_be_zero)
    mask = np.repeat(reach[:, None], n, axis=1)
    at = np.flatnonzero(reach & ((least > -1) | (most < 1)))
    if len(at) and units.shape[1]:
        own = units[at]
        focus = np.argsort(-np.abs(own), axis=1, kind="stable")[:, :FOCUS]
        low, high = feasible(np.take_along_axis(own, focus, 1), least[at], most[at])
        for f in range(focus.shape[1]):
            first, end = np.empty(len(at), np.int16), np.empty(len(at), np.int16)
            for c in np.unique(focus[:, f]):  # one sorted list serves all anchors that focus on it
                some = focus[:, f] == c
                first[some] = np.searchsorted(values[c], low[some, f].astype(np.float32), "left")
                end[some] = np.searchsorted(values[c], high[some, f].astype(np.float32), "right")
            cut = (first > 0) | (end < n)
            if cut.any():
                place = places[focus[cut, f]]
                mask[at[cut]] &= (place >= first[cut][:, None]) & (place < end[cut][:, None])
    return mask


def _scores(anchors: np.ndarray, rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Exact inner products of anchors and rows, at least where ``mask`` is set."""
    bound = float(anchors.shape[1] or 1) * float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0))
    kind = np.float64 if bound < EXACT else np.int64
    if mask.mean() < 0.02:
        out = np.zeros(mask.shape, np.int64)
        a, r = np.nonzero(mask)
        out[a, r] = np.einsum("kd,kd->k", anchors[a].astype(kind), rows[r].astype(kind)).astype(np.int64)
        return out
    return (anchors.astype(kind) @ rows.astype(kind).T).astype(np.int64)


def _searched(k: int, same: bool):
    """The best ``k`` rows of a tile for each search of a block."""

    def run(key: tuple, tile_rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.empty(0, np.int64) for c in ("anchor_id", "positive_id", "vec_id", "score")})]
        if tile_rows.empty or wanted.empty:
            return out[0]
        tile, dim = tile_rows.iloc[0], int(key[0])
        n = int(tile["n"])
        ids, labels = np.frombuffer(tile["ids"], np.int64), np.frombuffer(tile["labels"], np.int64)
        ints = np.frombuffer(tile["ints"], np.int64).reshape(n, dim)
        places, values = np.frombuffer(tile["places"], np.int16).reshape(dim, n), np.frombuffer(tile["sorted"], np.float32).reshape(dim, n)
        _, row_lengths = _units(ints)
        for start in range(0, len(wanted), BATCH):
            part = wanted.iloc[start : start + BATCH]
            anchors = np.array(part["v"].tolist(), np.int64).reshape(len(part), dim)
            units, lengths = _units(anchors)
            anchor_ids, anchor_labels = part["anchor_id"].to_numpy(np.int64), part["label"].to_numpy(np.int64)
            lo, hi = part["lo"].to_numpy(np.int64).copy(), part["hi"].to_numpy(np.int64)
            # the best so far: search, score, row
            who, score, row = (np.empty(0, np.int64) for _ in range(3))
            for b in range(0, n, BUCKET):
                e = min(n, b + BUCKET)
                mask = candidates(units, lengths, lo.astype(np.float64), hi.astype(np.float64), row_lengths[b:e], places[:, b:e], values[:, b:e])
                mask &= (labels[b:e] == anchor_labels[:, None]) if same else (labels[b:e] != anchor_labels[:, None])
                mask &= ids[b:e] != anchor_ids[:, None]
                some = np.flatnonzero(mask.any(axis=1))
                if not len(some):
                    continue
                got = _scores(anchors[some], ints[b:e], mask[some])
                a, r = np.nonzero(mask[some] & (got >= lo[some][:, None]) & (got <= hi[some][:, None]))
                who, score, row = np.concatenate([who, some[a]]), np.concatenate([score, got[a, r]]), np.concatenate([row, r + b])
                order = np.lexsort((ids[row], -score, who))
                who, score, row = who[order], score[order], row[order]
                rank = np.arange(len(who)) - np.searchsorted(who, who)
                last = rank == k - 1
                lo[who[last]] = np.maximum(lo[who[last]], score[last])
                who, score, row = who[rank < k], score[rank < k], row[rank < k]
            out.append(pd.DataFrame({"anchor_id": anchor_ids[who], "positive_id": part["positive_id"].to_numpy(np.int64)[who],
                                     "vec_id": ids[row], "score": score}))
        return pd.concat(out)

    return run


def _search(index: DataFrame, wanted: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` of every tile for each search in ``wanted``: the stated searches against all rows, in blocks."""
    places = index.select("dim", F.expr("tile + 0").alias("tile"))  # a column of its own beside the index's
    keys = ["dim", "tile", "block"]
    served = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = wanted.join(places, "dim")
    return served.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_searched(k, same), FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def best_rows(index: DataFrame, wanted: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor_id, positive_id, vec_id, score and rank: the ``k`` best rows of the
    anchor's label (``same``) or of other labels with a score within [lo, hi].

    ``wanted`` is a stored table of anchor_id, positive_id, label, v, lo and hi.
    """
    blocks = max(1, -(-wanted.count() // SEARCH_BLOCK))
    block = F.pmod(F.xxhash64("anchor_id", "positive_id"), F.lit(blocks)).cast("int")
    wanted = wanted.select("*", F.size("v").alias("dim"), block.alias("block"))
    keys = ["anchor_id", "positive_id"]
    first = _ranked(_search(index.where(F.col("tile") == 0), wanted, blocks, k, same), k)
    raised = first.where(F.col("rank") == k).select(*keys, F.col("score").alias("reached"))
    wanted = wanted.join(raised, keys, "left").withColumn("lo", F.greatest("lo", F.coalesce("reached", "lo"))).drop("reached")
    return _ranked(_search(index, wanted, blocks, k, same), k)


def mine(vectors: DataFrame, anchor_ids: Callable[[Column], Column], positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95),
         scale: int = 256, relabel: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id satisfies ``anchor_ids``; a negative's score is
    between ``band[0]`` and ``band[1]`` percent of the positive's; ``relabel``
    maps (id, label) to the label that counts.
    """
    rows = stored(usable(vectors, scale, relabel), "rows")
    index = tiles(rows)
    anchors = rows.where(anchor_ids(F.col("vec_id"))).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    no_bound = F.lit(NO_BOUND).cast("long")
    wanted = stored(anchors.withColumn("positive_id", F.col("anchor_id")).withColumn("lo", -no_bound).withColumn("hi", no_bound), "anchors")
    found = best_rows(index, wanted, positives, same=True).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    least, most = band
    # whole scores s with least * p <= 100 * s <= most * p, without leaving whole numbers
    lo, hi = F.expr(f"-((-positive_score * {least} - pmod(-positive_score * {least}, 100)) div 100)"), F.expr(
        f"(positive_score * {most} - pmod(positive_score * {most}, 100)) div 100")
    pairs = found.select("anchor_id", "positive_id", "positive_score", lo.alias("lo"), hi.alias("hi")).where(F.col("lo") <= F.col("hi"))
    pairs = stored(pairs.join(anchors, "anchor_id"), "pairs")
    chosen = best_rows(index, pairs.drop("positive_score"), negatives, same=False)
    scores = pairs.select("anchor_id", "positive_id", "positive_score")
    return chosen.join(scores, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
