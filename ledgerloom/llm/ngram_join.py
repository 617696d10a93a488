"""N-gram Jaccard join with component ids.

A document's set holds the 64-bit hashes of its distinct word n-grams. Two
sets link when 100 * |A & B| >= PERCENT * |A | B|.

1. Equal sets are one class, so exact copies are met once.
2. Two linked sets share an n-gram among their first n - ceil(t * n) + 1 under
   any common order (prefix filter). The order puts n-grams of crowded counter
   cells last (``CELLS`` counters over all documents), so very common n-grams
   are rarely looked at. The order only steers the work, not the result.
3. Classes that share a prefix n-gram meet in tiles of at most ``TILE`` rows
   ordered by size; a row is held only against rows of its size band (up to
   n / t). Two rows meet at their first common n-gram, too, where no more can be
   shared than follows it in both; rows that this leaves without a partner go
   before bitmaps are sent. Hashed bitmaps bound the overlap from above: |A & B| <=
   |A| minus the bits of A that B lacks. They have a bit an n-gram or more: with
   fewer, rows with little in common pass, and tentative groups grow into one.
   What passes joins tentative groups.
4. Inside each tentative group bitmaps of 4 bits an n-gram and more, sent once
   for each class, leave fewer and smaller groups.
5. In these the sorted arrays are intersected exactly, except between rows that
   are already connected. The result are the components; pairs within them are
   not listed.

A group beyond one tile is cut into tiles by hash, in two ways; rows that this
leaves outside the group's main component then meet every other row of
the group, so no link is lost and no group is gathered in one task.

Cases: with fewer than ``n`` words the whole sequence is one n-gram; null,
empty or blank texts have n_shingles 0 and are their own component, linked
with nothing; repeated rows each keep their row; rows with a null doc_id take
part and name no component (the id is the smallest doc_id that is not null);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, chunks, filled, filter_bit, hash_filter, in_filter, mix64, recorded, release, sequence_hash, small_batches, span_hashes, stored, texts_of, windows_of, with_fields, word_spans
from .graph import components

CELLS, TILE = 1 << 17, 2048
#: Bits of the filter of shared n-grams at most: 8 MiB.
MOST_BITS = 1 << 26
#: Pairs held against each other at once.
BLOCK = 1 << 15
#: Bytes of rows after which whole tiles are handed on.
HELD_BYTES = 1 << 24
#: Bytes of bitmaps compared at once.
PAIR_BYTES = 1 << 21


def text_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its sorted distinct n-gram hashes)."""
    for lo, hi, part, off in chunks(data, offsets):
        part = FOLD[part]
        starts, ends, first = word_spans(part, off)
        words = span_hashes(part, starts, ends)
        grams = windows_of(words, n)
        for k in range(hi - lo):
            a, z = first[k], first[k + 1]
            if z - a >= n:
                yield lo + k, np.unique(grams[a : z - n + 1])
            else:
                yield lo + k, np.array([sequence_hash(words[a:z])], np.uint64) if z > a else np.zeros(0, np.uint64)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 17)).astype(np.int64)


def _crowds(n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, own in text_sets(*texts_of(batch), n):
                sums += np.bincount(_cell(own), minlength=CELLS) if len(own) > 4096 else 0
                if len(own) <= 4096:
                    np.add.at(sums, _cell(own), 1)
        step = 4096
        for at in range(0, CELLS, step):
            if sums[at : at + step].any():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + step, dtype=np.int32)), pa.array(sums[at : at + step])], ["cell", "n"])

    return count


def crowd_ranks(docs: DataFrame, n: int) -> np.ndarray:
    """Rank of each counter cell: 0 for ordinary ones, more for crowded ones. CELLS numbers."""
    found = docs.select("text").mapInArrow(_crowds(n), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(CELLS)
    sums[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return np.maximum(0, np.ceil(np.log2(np.maximum(sums, 1) / max(sums.mean(), 1) / 1.3))).astype(np.int8)


def bitmap(hashes: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def width_of(n: int) -> int:
    """Bits of the tentative bitmap: a power of two from 2 * n on, from n on for large sets, whose bounds vary less."""
    return max(64, 1 << int((n if n > 1024 else 2 * n) - 1).bit_length())


def wide_of(n: int) -> int:
    """Bits of the wide bitmap: a power of two from 4 * n on."""
    return max(64, 1 << int(4 * n - 1).bit_length())


def _sum(hashes: np.ndarray) -> int:
    return int(hashes.sum(dtype=np.uint64).view(np.int64))


def _mixed_sum(hashes: np.ndarray) -> int:
    return _sum(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))


def _signatures(n: int, percent: int, ranks: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, k1, k2, prefix, bits = [], [], [], [], []
            for _, own in text_sets(*texts_of(batch), n):
                m = len(own)
                size.append(m)
                k1.append(_sum(own))
                k2.append(_mixed_sum(own))
                first = m - -(-percent * m // 100) + 1 if m else 0
                prefix.append(own[np.argsort(ranks[_cell(own)], kind="stable")[:first]].view(np.int64))
                bits.append(bitmap(own, width_of(m)).tobytes() if m else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["doc_id", "text_hash", "n", "k1", "k2", "prefix", "bits"],
            )

    return rows


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Each row's smallest connected row, after the pairs (a, b) are added to ``root``."""
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _band_pairs(size: np.ndarray, ends: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of rows in one tile whose sizes are within the band, in
    blocks. Rows are ordered by (tile, size); ``ends`` is each row's tile end."""
    # the last row with size <= own * 100 / percent, by a key that rises over tiles and sizes
    key = ends.astype(np.float64) * (int(size.max(initial=0)) + 2) + size
    most = ends.astype(np.float64) * (int(size.max(initial=0)) + 2) + np.minimum(size * 100 // percent, size.max(initial=0))
    last = np.searchsorted(key, most, "right")
    count = np.maximum(last - np.arange(len(size)) - 1, 0)
    upto = np.cumsum(count)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + BLOCK, "right")))
        own = count[lo:hi]
        a = np.repeat(np.arange(lo, hi), own)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own)
        if len(a):
            yield a, b
        lo = hi


def _places_allow(size: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that can link if nothing before the n-gram at ``place`` is shared; each linked pair
    passes at its first common n-gram."""
    na, nb = size[a].astype(np.int64), size[b].astype(np.int64)
    most = np.minimum(na - place[a], nb - place[b])
    return 100 * most >= percent * (na + nb - most)


def _may_link(bits: list[bytes], size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose bitmaps allow the overlap; a is not larger than b."""
    keep = np.zeros(len(a), bool)
    widths = np.array([len(x) for x in bits])
    for w in np.unique(widths[a]):
        mine = np.flatnonzero(widths[a] == w)
        rows = np.unique(np.concatenate([a[mine], b[mine]]))
        flat = np.zeros((len(rows), w), np.uint8)
        for k, r in enumerate(rows):  # a wider bitmap folds onto the narrower by or
            own = np.frombuffer(bits[r], np.uint8)
            flat[k] = own if len(own) == w else np.bitwise_or.reduce(own.reshape(-1, w), axis=0)
        words = flat.view(np.uint64) if w % 8 == 0 else flat
        step = max(1, min(8192, PAIR_BYTES // int(w)))  # bounded bytes, however wide the bitmaps
        for s in range(0, len(mine), step):
            part = mine[s : s + step]
            x, y = words[np.searchsorted(rows, a[part])], words[np.searchsorted(rows, b[part])]
            lost_a = np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
            lost_b = np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            na, nb = size[a[part]].astype(np.int64), size[b[part]].astype(np.int64)
            most = np.minimum(na - lost_a, nb - lost_b)
            keep[part] = 100 * most >= percent * (na + nb - most)
    return keep


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole tiles, some together, of rows that come ordered by tile (column t1, t2)."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < 4 * TILE and sum(b.nbytes for b in held) < HELD_BYTES:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        t1, t2 = (rows.column(x).to_numpy() for x in ("t1", "t2"))
        cut = int(np.flatnonzero((t1 != t1[-1]) | (t2 != t2[-1])).max(initial=-1)) + 1
        if cut:
            yield rows.slice(0, cut)
            held, count = rows.slice(cut).to_batches(), rows.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _tile_ends(t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    starts = np.flatnonzero(np.concatenate([[True], (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])]))
    ends = np.append(starts[1:], len(t1))
    return np.repeat(ends, ends - starts)


def _partnered(percent: int, tile: int):
    """Rows that may link with another row of their group by sizes and places, and all rows of groups beyond one tile."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _tiles(batches):
            t1, t2, size, place = (groups.column(x).to_numpy() for x in ("t1", "t2", "n", "place"))
            order = np.lexsort((size, t2, t1))
            size, place = size[order], place[order]
            some = groups.column("size_of_group").to_numpy()[order] > tile
            ends = np.where(some, np.arange(1, len(some) + 1), _tile_ends(t1[order], t2[order]))  # nothing is held against them here
            for a, b in _band_pairs(size, ends, percent):
                may = _places_allow(size, place, a, b, percent)
                some[a[may]] = True
                some[b[may]] = True
            left = groups.take(pa.array(order[some])).select(["t1", "size_of_group", "cid", "n", "place"])
            yield from left.rename_columns(["grp", "size_of_group", "cid", "n", "place"]).combine_chunks().to_batches()

    return rows


def _with_partners(met: DataFrame, percent: int, tile: int) -> DataFrame:
    """grp, size_of_group, cid, n, place of the rows that :func:`_partnered` leaves."""
    part = F.when(F.col("size_of_group") > tile, F.pmod(F.xxhash64("cid"), F.ceil(F.col("size_of_group") / tile))).otherwise(F.lit(0)).cast("long")
    dealt = met.select(F.col("grp").alias("t1"), part.alias("t2"), "size_of_group", "cid", "n", "place").repartition("t1", "t2").sortWithinPartitions("t1", "t2")
    return dealt.mapInArrow(_partnered(percent, tile), "grp long, size_of_group long, cid long, n int, place int")


def _link_tiles(percent: int, exact: bool):
    """Star edges (a, b) of the rows that connect within each tile; by bitmaps
    alone, or by sorted arrays. Rows with different ``side`` only meet each
    other unless side is 0; rows with equal ``label`` are connected already."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tiles in _tiles(batches):
            t1, t2, cid, size, place, side, label = (tiles.column(x).to_numpy() for x in ("t1", "t2", "cid", "n", "place", "side", "label"))
            order = np.lexsort((cid, size, t2, t1))
            t1, t2, cid, size, place, side, label = (x[order] for x in (t1, t2, cid, size, place, side, label))
            ends = _tile_ends(t1, t2)
            if exact:
                flat = tiles.column("hashes").combine_chunks()
                off = flat.offsets.to_numpy()
                values = flat.values.to_numpy().view(np.uint64)
                sets = [values[off[k] : off[k + 1]] for k in order]
                bits = [bitmap(s, wide_of(len(s))).tobytes() for s in sets]
            else:
                own = tiles.column("bits").to_pylist()
                bits = [own[k] for k in order]
            root = np.arange(len(cid))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = int(root[x])
                return x

            for a, b in _band_pairs(size, ends, percent):
                new = (root[a] != root[b]) & (cid[a] != cid[b]) & ((side[a] == 0) | (side[a] != side[b])) & ((label[a] < 0) | (label[a] != label[b]))
                new &= _places_allow(size, place, a, b, percent)
                a, b = a[new], b[new]
                may = _may_link(bits, size, a, b, percent)
                a, b = a[may], b[may]
                if not exact:
                    root = _merge(root, a, b)
                    continue
                for i, j in zip(a.tolist(), b.tolist()):
                    x, y = find(i), find(j)
                    if x != y:
                        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                            root[max(x, y)] = min(x, y)
            top = np.array([find(x) for x in range(len(cid))], np.int64) if exact else root
            # smallest cid of each local component
            least = np.full(len(cid), np.iinfo(np.int64).max)
            if len(cid):
                np.minimum.at(least, top, cid)
            found = cid != least[top]
            yield pa.RecordBatch.from_arrays([pa.array(cid[found]), pa.array(least[top][found])], ["a", "b"])

    return rows


def _run_tiles(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """rows: t1, t2 (the tile), cid, n, place, side, label and bits or hashes."""
    carried = ["t1", "t2", "cid", "n", "place", "side", "label", "hashes" if exact else "bits"]
    dealt = rows.select(*carried).repartition("t1", "t2").sortWithinPartitions("t1", "t2")
    return dealt.mapInArrow(_link_tiles(percent, exact), "a long, b long").distinct()


def link_groups(rows: DataFrame, percent: int, exact: bool, tile: int, any_large: bool) -> DataFrame:
    """(node, root) of the components that links within groups make.

    rows: grp, size_of_group, cid, n, place (of the n-gram that a group stands
    for, else 0), and bits or hashes. A group up to ``tile``
    rows is one tile. A larger one is cut by hash, twice and differently, so
    that the second cut joins what the first one kept apart; afterwards the rows
    outside its main component meet all of its rows, tile against tile. Which
    rows meet again is settled without their bits or hashes, which are fetched
    for the groups that need it.
    """
    payload = "hashes" if exact else "bits"
    none = F.lit(-1).cast("long")
    parts = F.ceil(F.col("size_of_group") / tile).cast("int")
    key = lambda i, j: i.cast("long") * F.lit(1 << 31) + j
    cuts = F.explode(F.sequence(F.lit(0), F.when(parts > 1, F.lit(1)).otherwise(F.lit(0)))).alias("cut")
    first = rows.select("grp", "size_of_group", "cid", "n", "place", payload, cuts)
    first = first.select(
        F.col("grp").alias("t1"), key(F.col("cut"), F.pmod(F.xxhash64("cid", "grp", "cut"), parts).cast("long")).alias("t2"),
        "cid", "n", "place", F.lit(0).alias("side"), none.alias("label"), payload)
    edges = stored(_run_tiles(first, percent, exact), "links")
    found = components(edges)
    if not any_large:  # known from the groups' sizes, without another pass over the rows
        return found
    found = stored(found, "components")
    large = rows.where(F.col("size_of_group") > tile).select("grp", "size_of_group", "cid")
    named = stored(large.join(found, F.col("cid") == F.col("node"), "left").select("grp", "size_of_group", "cid", F.coalesce("root", "cid").alias("label")), "named")
    counts = named.groupBy("grp", "label").count()
    main = counts.groupBy("grp").agg(F.max_by("label", F.struct("count", "label")).alias("main"), (F.count("*") - 1).alias("others"))
    strays = counts.join(main, "grp").where("label <> main").groupBy("grp").agg(F.sum("count").alias("strays"))
    named = named.join(main.where("others > 0").join(strays, "grp"), "grp")
    rows_of = F.ceil(F.col("strays") / tile).cast("int")
    here = F.pmod(F.xxhash64("cid", "grp"), rows_of).cast("long")
    there = F.pmod(F.xxhash64("cid", "grp"), parts).cast("long")
    wide = named.withColumn("i", F.explode(F.sequence(F.lit(0), rows_of - 1))).withColumn("t2", key(F.col("i"), there))
    tall = named.where("label <> main").withColumn("j", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("t2", key(here, F.col("j").cast("long")))
    # strays also stand in ``wide``, so they meet one another there
    places = wide.select("grp", "cid", "t2", F.lit(2).alias("side"), "label").union(tall.select("grp", "cid", "t2", F.lit(1).alias("side"), "label"))
    places = stored(places.toDF("t1", "at", "t2", "side", "label"), "places")
    again = rows.where(F.col("size_of_group") > tile).join(places, (F.col("grp") == F.col("t1")) & (F.col("cid") == F.col("at")))
    more = _run_tiles(again, percent, exact)
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _grouped(found: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes in groups of several, with what their texts are known by."""
    members = found.union(found.select("root", "root").distinct()).toDF("cid", "grp")
    sizes = members.groupBy("grp").agg(F.count("*").alias("size_of_group"))
    return stored(members.join(sizes, "grp").join(classes.select("cid", "rep", "k1", "k2", "n"), "cid"), "members")


def _of_texts(docs: DataFrame, members: DataFrame, n: int, exact: bool) -> DataFrame:
    """``members`` with the wide bitmap or the sorted array of their texts, read again and written once."""
    wanted = docs.sparkSession.sparkContext.broadcast(hash_filter(members, "rep"))
    theirs = docs.select("text", "doc_id", filter_bit(F.col("doc_id")).alias("bit"))
    kind = "hashes array<long>" if exact else "bits binary"
    theirs = theirs.mapInArrow(_payloads(n, wanted, exact), with_fields(docs.select("doc_id"), f"m int, a long, b long, {kind}"))
    same = theirs["doc_id"].eqNullSafe(members["rep"]) & (theirs["a"] == members["k1"]) & (theirs["b"] == members["k2"]) & (theirs["m"] == members["n"])
    return stored(theirs.join(members, same).select("cid", "n", F.lit(0).alias("place"), "hashes" if exact else "bits", "grp", "size_of_group"), "texts")


def _gram_filter(shared: DataFrame) -> np.ndarray:
    """A bitmap of the shared n-grams' low bits: eight bits an n-gram, MOST_BITS at
    most. Beyond that it lets more through, which only costs a shuffle."""
    bits = min(MOST_BITS, max(1 << 12, 1 << int(8 * shared.count()).bit_length()))
    words = shared.select(F.expr(f"grp & {bits - 1}L").alias("bit")).groupBy(F.expr("shiftright(bit, 5)").cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 31 AS INT)))").alias("v"))
    return filled(words, bits // 32)


def _entries_in(sent):
    """(cid, n, n-gram, its place) of the prefix n-grams that the bitmap holds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = 32 * len(sent.value) - 1
        for batch in batches:
            prefix = batch.column(2)
            grams = prefix.flatten().to_numpy(zero_copy_only=False)
            many = np.diff(prefix.offsets.to_numpy())
            cid, n = (np.repeat(batch.column(k).to_numpy(), many) for k in (0, 1))
            place = (np.arange(len(grams)) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32)
            some = in_filter(sent.value, grams & mask)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (cid, n, grams, place)], ["cid", "n", "grp", "place"])

    return rows


def join(docs: DataFrame, n: int = 3, percent: int = 90, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, and xxhash64 of the text and the component's own number (null for empty sets)."""
    with small_batches(docs.sparkSession):
        return _join(docs, n, percent, tile)


def _join(docs: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(crowd_ranks(docs, n))
    given = docs.select("doc_id", "text")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    schema = with_fields(hashed.select("doc_id", "text_hash"), "n int, k1 long, k2 long, prefix array<long>, bits binary")
    with recorded() as whole:
        signed = stored(hashed.mapInArrow(_with_ranks(n, percent, ranks), schema), "signed")
    sets = stored(signed.select("doc_id", "text_hash", "n", "k1", "k2"), "sets")
    classes = signed.where("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    release(docs.sparkSession, whole)  # prefixes and bitmaps are kept by class

    # classes that share a prefix n-gram
    entries = classes.select("cid", "n", F.explode("prefix").alias("grp"))
    shared = entries.groupBy("grp").agg(F.count("*").alias("size_of_group"), F.min("n").alias("least"), F.max("n").alias("most"))
    # two rows whose sizes are too far apart can't link
    shared = shared.where((F.col("size_of_group") > 2) | (F.col("size_of_group") > 1) & (100 * F.col("least") >= percent * F.col("most")))
    # written, so that the join's two sides come from plain exchanges and a hot n-gram's rows can be split
    shared = stored(shared.select("grp", "size_of_group"), "shared")
    # prefixes are looked up in a bitmap of the shared n-grams, so that few others are shuffled again
    sent = docs.sparkSession.sparkContext.broadcast(_gram_filter(shared))
    entries = classes.select("cid", "n", "prefix").mapInArrow(_entries_in(sent), "cid long, n int, grp long, place int")
    # bitmaps are sent with the rows that sizes and places leave a partner, not with every shared n-gram
    met = stored(_with_partners(entries.join(shared, "grp"), percent, tile), "met").join(classes.select("cid", "bits"), "cid")
    large = lambda sizes: not sizes.where(F.col("size_of_group") > tile).isEmpty()
    tentative = stored(link_groups(met, percent, False, tile, large(shared)), "tentative")

    # inside the tentative groups wide bitmaps, once for each class, and exact intersection for what they leave
    members = _grouped(tentative, classes)
    tentative = stored(link_groups(_of_texts(given, members, n, False), percent, False, tile, large(members)), "tentative")
    members = _grouped(tentative, classes)
    found = stored(link_groups(_of_texts(given, members, n, True), percent, True, tile, large(members)), "found")

    # the smallest doc_id of each component
    named = classes.join(found, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "cid"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.select("k1", "k2", F.col("n").alias("m"), "comp").join(least, "comp")
    hit = (sets["k1"] == named["k1"]) & (sets["k2"] == named["k2"]) & (sets["n"] == named["m"])
    return sets.join(named, hit, "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_hash", F.col("comp").alias("component"),
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with
    the smallest doc_id stays; rows without words all stay."""
    found = stored(join(docs, n, percent, tile).select("doc_id", "text_hash", "component"), "components_of_rows")
    first = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("s"), F.count("*").alias("rows")
    )
    # only rows of components of several rows are looked up; all others stay as they are
    first = stored(first.where("rows > 1").select("component", F.col("s.doc_id").alias("kept_id"), F.col("s.text_hash").alias("kept_hash")), "first")
    touched = found.join(first.select("component"), "component", "left_semi").select("doc_id", "text_hash")
    touched = stored(touched.distinct(), "touched")
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(touched, "text_hash"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), filter_bit(F.xxhash64("text")).alias("bit"))
    kind = rows.select("row").schema
    maybe = rows.mapInArrow(_where_bit(sent, True), kind).withColumn("doc_id", F.col("row.doc_id")).withColumn("text_hash", F.xxhash64("row.text"))
    others = rows.mapInArrow(_where_bit(sent, False), kind).select("row.*")
    hit = lambda t, a, b: F.col("doc_id").eqNullSafe(t[a]) & (F.col("text_hash") == t[b])
    t, k = touched.toDF("touched_id", "touched_hash"), first.drop("component").distinct()
    apart = maybe.join(t, hit(t, "touched_id", "touched_hash"), "left_anti").select("row.*")
    # rows that repeat whole are kept once
    kept = maybe.join(k, hit(k, "kept_id", "kept_hash")).groupBy("doc_id", "text_hash").agg(F.first("row").alias("row")).select("row.*")
    return others.union(apart).union(kept)


def _where_bit(bitmap, wanted: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_filter(bitmap.value, batch.column(1).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(hit == wanted)).select([0])

    return rows


def _with_ranks(n: int, percent: int, ranks):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signatures(n, percent, ranks.value)(batches)

    return rows


def _payloads(n: int, wanted, exact: bool):
    """The sorted arrays, or their wide bitmaps, of the texts whose doc_id may be
    wanted; rows that repeat an id and a set are left out within a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(wanted.value, batch.column(2).to_numpy(zero_copy_only=False))))
            ids, at, size, sums, mixed, own = batch.column(1).to_pylist(), [], [], [], [], []
            for row, hashes in text_sets(*texts_of(batch), n):
                known = (ids[row], len(hashes), _sum(hashes), _mixed_sum(hashes))
                if len(hashes) and known not in seen:
                    seen.add(known)
                    at.append(row)
                    size.append(known[1])
                    sums.append(known[2])
                    mixed.append(known[3])
                    own.append(hashes.view(np.int64) if exact else bitmap(hashes, wide_of(len(hashes))).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(at, pa.int64())), pa.array(size, pa.int32()), pa.array(sums, pa.int64()), pa.array(mixed, pa.int64()),
                 pa.array(own, pa.list_(pa.int64()) if exact else pa.binary())],
                ["doc_id", "m", "a", "b", "hashes" if exact else "bits"])

    return rows
