"""Problem 1: what changed between consecutive full snapshots, by subtracting invertible Bloom lookup tables.

Each archive is sketched once, where its rows are read: its records, as pairs of key hash and value hash, fall into
hash buckets, and each bucket is a table of ``cells`` cells in four parts, every pair being added to one cell of each
part. So only sketches move, one row per bucket and map task, never the records. The tables of two consecutive archives
are subtracted cell by cell, and peeling what is left gives the pairs in which the two differ. Buckets with more
differences than their table holds are sketched again, larger. The keys found are looked up in the two archives, which
classifies them exactly; that filter is pushed down to the scan, so values are only read for what differs.

Cells hold sums modulo 2**64, not exclusive ors: a record that two map tasks both hold counts twice and cannot vanish.
Hashes have HASH_BITS bits, so a pair that is left several times can still be read from its multiple.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import xxhash64_longs
from tidemark.session import cut, small

HASHES, ROWS_PER_BUCKET, FIRST_CELLS, GROWTH, ROUNDS = 4, 2048, 432, 4, 4
CHECK_SEED, DIGEST_SEED, HASH_BITS = 101, 202, 60
#: Rows a map task gathers before it sketches them, and cells that are peeled at once.
CHUNK_ROWS, CHUNK_CELLS = 262_144, 4_000_000
SKETCH = "archive long, bucket long, cell array<int>, n array<long>, k array<long>, v array<long>, c array<long>"
PEELED = "release long, bucket long, failed boolean, kh long"
ARCHIVES_BROADCAST, TOUCHED_BROADCAST = 400_000, 400_000


def release_pairs(releases: DataFrame) -> DataFrame:
    """Per feed the releases in order, one per timestamp, each beside the archive of the one before.

    Expects feed, release (timestamp), label, archive, landed. Of several archives at one timestamp the one landed
    last counts; rows without feed, release or archive are no releases.
    """
    one = (
        releases.dropna(subset=["feed", "release", "archive"])
        .groupBy("feed", "release")
        .agg(F.max(F.struct("landed", "archive", "label")).alias("r"))
        .select("feed", "release", "r.archive", "r.label")
    )
    before = Window.partitionBy("feed").orderBy("release")
    return one.withColumn("before", F.lag("archive").over(before)).filter("before is not null and before != archive")


def _hash(*columns: Column | str) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << HASH_BITS) - 1).cast("bigint"))


def _places(k: np.ndarray, v: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """The cells (from 1, for 0 holds the digest) of each pair, one in each part of the table."""
    part = max(1, cells // HASHES)
    return np.stack([np.mod(xxhash64_longs(k, v, seed + i), part) + i * part + 1 for i in range(HASHES)])


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def _sketcher(cells: int, seed: int):
    """Arrow batches of (archive, bucket, kh, vh) to one sparse table per archive and bucket of a chunk."""
    width = max(cells, HASHES) + 1

    def sketch(table: pa.Table) -> pa.RecordBatch:
        rows = [table.column(i).to_numpy() for i in range(4)]
        order = np.lexsort(rows[::-1])
        rows = [x[order] for x in rows]
        # Repeats of a record within the chunk count once.
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in rows])
        archive, bucket, kh, vh = (x[new] for x in rows)
        head = np.ones(len(kh), bool)
        head[1:] = (archive[1:] != archive[:-1]) | (bucket[1:] != bucket[:-1])
        group = np.cumsum(head) - 1
        spot = np.concatenate([np.zeros((1, len(kh)), np.int64), _places(kh, vh, cells, seed)]) + group * width
        flat, at = np.unique(spot.ravel(), return_inverse=True)
        digest, check = xxhash64_longs(kh, vh, DIGEST_SEED), xxhash64_longs(kh, vh, CHECK_SEED)
        zero = np.zeros(len(kh), np.int64)
        n = np.bincount(at, minlength=len(flat)).astype(np.int64)
        sums = []
        for top, rest in ((digest, kh), (zero, vh), (zero, check)):
            s = np.zeros(len(flat), np.int64)
            np.add.at(s, at, np.concatenate([top, *[rest] * HASHES]))
            sums.append(s)
        bounds = np.searchsorted(flat, np.arange(group[-1] + 2) * width)
        return pa.RecordBatch.from_arrays(
            [pa.array(archive[head]), pa.array(bucket[head]), _lists(bounds, (flat % width).astype(np.int32), pa.int32()), *(_lists(bounds, x, pa.int64()) for x in (n, *sums))],
            names=["archive", "bucket", "cell", "n", "k", "v", "c"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                yield sketch(pa.Table.from_batches(held))
                held = []
        if sum(b.num_rows for b in held):
            yield sketch(pa.Table.from_batches(held))

    return run


def _divided(total: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The hash of which ``total`` is ``times`` the multiple modulo 2**64; nonsense if there is none.

    The odd part of ``times`` has an inverse, and a power of two up to the bits that a hash leaves free is a shift.
    """
    even = times & -times
    odd = times // even
    x = odd.copy()
    for _ in range(5):
        x = x * (2 - odd * x)
    return ((total * x).view(np.uint64) // even.view(np.uint64)).view(np.int64)


def _peeler(cells: int, seed: int):
    """Sketches sorted by (release, bucket), each with its side, to the key hashes in which the sides differ."""
    width = max(cells, HASHES) + 1

    def peel(table: pa.Table) -> pa.RecordBatch:
        release, bucket, side = (table.column(c).to_numpy() for c in ("release", "bucket", "side"))
        head = np.ones(len(release), bool)
        head[1:] = (release[1:] != release[:-1]) | (bucket[1:] != bucket[:-1])
        group, groups = np.cumsum(head) - 1, int(head.sum())
        release, bucket = release[head], bucket[head]
        lists = [table.column(c).combine_chunks() for c in ("cell", "n", "k", "v", "c")]
        size = np.diff(lists[0].offsets.to_numpy())
        cell, n, k, v, c = (x.flatten().to_numpy() for x in lists)
        at, sign = np.repeat(group, size) * width + cell, np.repeat(side.astype(np.int64), size)
        full = [np.zeros(groups * width, np.int64) for _ in range(4)]
        for t, x in zip(full, (n, k, v, c), strict=True):
            np.add.at(t, at, x * sign)
        N, K, V, C = full
        total, digest = N[::width].copy(), K[::width].copy()
        for t in full:
            t[::width] = 0
        found: list[tuple[np.ndarray, ...]] = []
        look = np.unique(at)
        while len(look):
            look = look[N[look] != 0]
            times = N[look]
            key, value = _divided(K[look], times), _divided(V[look], times)
            sound = xxhash64_longs(key, value, CHECK_SEED) * times == C[look]
            sound[sound] &= (_places(key[sound], value[sound], cells, seed) == look[sound] % width).any(axis=0)
            look, key, value, times = look[sound], key[sound], value[sound], times[sound]
            if not len(look):
                break
            owner = look // width
            # A pair alone in several of its cells is taken once.
            _, first = np.unique(np.stack([owner, key, value], axis=1), axis=0, return_index=True)
            owner, key, value, times = owner[first], key[first], value[first], times[first]
            found.append((owner, key, value, times))
            touched = (owner * width + _places(key, value, cells, seed)).ravel()
            for t, x in ((N, times), (K, key * times), (V, value * times), (C, xxhash64_longs(key, value, CHECK_SEED) * times)):
                np.subtract.at(t, touched, np.tile(x, HASHES))
            look = np.unique(touched)
        owner, key, value, times = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
        failed = np.logical_or.reduce([t != 0 for t in full]).reshape(groups, width).any(axis=1)
        net, seen = np.zeros(groups, np.int64), np.zeros(groups, np.int64)
        np.add.at(net, owner, times)
        np.add.at(seen, owner, xxhash64_longs(key, value, DIGEST_SEED) * times)
        failed |= (net != total) | (seen != digest)
        keep, lost = ~failed[owner], np.flatnonzero(failed)
        rows = np.concatenate([owner[keep], lost])
        return pa.RecordBatch.from_arrays(
            [pa.array(release[rows]), pa.array(bucket[rows]), pa.array(np.arange(len(rows)) >= keep.sum()), pa.array(np.concatenate([key[keep], np.zeros(len(lost), np.int64)]))], names=["release", "bucket", "failed", "kh"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CHUNK_CELLS // cells)
        held: pa.Table | None = None

        def peeled(table: pa.Table, heads: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(heads), step):
                stop = heads[i + step] if i + step < len(heads) else table.num_rows
                yield peel(table.slice(heads[i], stop - heads[i]).combine_chunks())

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            heads = _heads(held)
            if len(heads) > 1:  # the last bucket may go on in the next batch
                yield from peeled(held.slice(0, heads[-1]), heads[:-1])
                held = held.slice(heads[-1])
        if held is not None and held.num_rows:
            yield from peeled(held, _heads(held))

    return run


def _heads(table: pa.Table) -> np.ndarray:
    """Where another release or bucket begins."""
    release, bucket = table.column("release").to_numpy(), table.column("bucket").to_numpy()
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(release)), bool), (release[1:] != release[:-1]) | (bucket[1:] != bucket[:-1])]))


def differing_keys(records: DataFrame, roles: DataFrame, valued: Callable[[DataFrame], DataFrame], first_cells: int = FIRST_CELLS, rounds: int = ROUNDS) -> DataFrame:
    """(release, kh) in which a release may differ from the one before; every key that does is there, some once for each side.

    records: archive, bucket, kh of every row, to which ``valued`` adds vh, if need be of few rows only. roles: archive, feed, release, side (1 the release's own archive, -1
    the one before). A bucket that does not peel clean or whose digest disagrees is sketched again with four times the
    cells and new hashes; buckets that resist every round (only possible by a coincidence of hashes, for the last
    table outgrows a bucket) are compared pair by pair.
    """
    done: list[DataFrame] = []
    failed: DataFrame | None = None
    cells = first_cells
    parts = small(roles.groupBy("archive").agg(F.first("feed").alias("feed"), F.collect_list(F.struct("release", "side")).alias("parts")), ARCHIVES_BROADCAST)

    def pairs() -> DataFrame:
        """All pairs, or those of the buckets that failed."""
        here = records
        if failed is not None:
            here = here.join(small(failed.join(roles, "release").select("archive", "bucket").distinct()), ["archive", "bucket"], "left_semi")
        return valued(here).select("archive", "bucket", "kh", "vh")

    for turn in range(rounds):
        seed = 1000 * (turn + 1)
        sketches = pairs().mapInArrow(_sketcher(cells, seed), SKETCH)
        # All archives of a feed meet bucket by bucket, so a sketch moves once, though it takes part in two releases.
        met = sketches.join(parts, "archive").repartition("feed", "bucket")
        sides = met.select(F.explode("parts").alias("p"), *sketches.columns).select("p.release", "p.side", *sketches.columns)
        if failed is not None:
            sides = sides.join(small(failed), ["release", "bucket"], "left_semi")
        peeled = cut(sides.sortWithinPartitions("release", "bucket").mapInArrow(_peeler(cells, seed), PEELED))
        done.append(peeled.filter("not failed").select("release", "kh"))
        failed = peeled.filter("failed").select("release", "bucket")
        if failed.isEmpty():
            failed = None
            break
        cells *= GROWTH
    if failed is not None:
        rest = pairs().distinct().join(roles, "archive").join(failed, ["release", "bucket"], "left_semi")
        done.append(rest.groupBy("release", "kh", "vh").agg(F.sum("side").alias("side")).filter("side != 0").select("release", "kh"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def snapshot_changes(
    rows: DataFrame, releases: DataFrame, key: Sequence[str], value: str = "quantity", measure: Callable[[DataFrame], DataFrame] | None = None,
    sizes: DataFrame | None = None, first_cells: int = FIRST_CELLS, rounds: int = ROUNDS
) -> DataFrame:
    """feed, release, label, the key columns, change_kind, old_value, new_value of each record that changed.

    rows: ``archive``, the key columns and ``value`` (null where a record has none), other columns ignored; repeated
    rows of a record count once (the greatest value). measure adds ``value`` where it has to be worked out, and is then
    spared for rows that don't matter; it must keep rows and columns as they are. releases: see release_pairs. sizes: (archive, rows) where that
    is known or cheaper to count than over ``rows``; it only sets the number of buckets. Rows with a null in the key are
    no records; archives that no release names have no effect; an archive registered again for a later release equals
    its own earlier one. A feed's first release has no changes; an empty table gives no rows.
    """
    sizes = rows.groupBy("archive").agg(F.count("*").alias("rows")) if sizes is None else sizes
    archives = releases.dropna(subset=["feed", "archive"]).select("feed", "archive").distinct()
    buckets = archives.join(sizes, "archive", "left").groupBy("feed").agg(F.greatest(F.lit(1), F.coalesce(F.ceil(F.max("rows") / ROWS_PER_BUCKET), F.lit(1))).alias("buckets"))
    # Archives and releases get short numbers, kept by the checkpoints.
    known = small(cut(archives.join(buckets, "feed").withColumn("no", F.monotonically_increasing_id())), ARCHIVES_BROADCAST)

    def no_of(df: DataFrame, column: str) -> DataFrame:
        return df.join(known.select("feed", F.col("archive").alias(column), F.col("no").alias(f"{column}_no")), ["feed", column])

    pairs = cut(no_of(no_of(release_pairs(releases), "archive"), "before").withColumn("release_no", F.monotonically_increasing_id()))
    one = [pairs.select(F.col(f"{a}_no").alias("archive"), F.xxhash64("feed").alias("feed"), F.col("release_no").alias("release"), F.lit(s).alias("side"), F.col(a).alias("name")) for a, s in (("archive", 1), ("before", -1))]
    roles = one[0].unionByName(one[1])

    add = measure or (lambda df: df)
    keyed = rows.dropna(subset=list(key)).withColumn("kh", _hash(*key))
    records = keyed.join(known.select("archive", "no", "buckets"), "archive").withColumn("bucket", F.pmod("kh", "buckets")).drop("archive", "buckets").withColumnRenamed("no", "archive")

    def valued(df: DataFrame) -> DataFrame:
        return add(df).withColumn("vh", _hash("kh", F.col(value).isNull(), value))

    differing = differing_keys(records, roles.drop("name"), valued, first_cells, rounds).distinct()
    wanted = cut(differing.join(roles.drop("feed").withColumnRenamed("archive", "no"), "release").withColumn("look", F.xxhash64("name", "kh")))
    # One number tells archive and key, so rows are dropped before values are worked out.
    found = keyed.withColumn("look", F.xxhash64("archive", "kh")).join(small(wanted.select("look").distinct(), TOUCHED_BROADCAST), "look", "left_semi")
    held = add(found).select(F.col("archive").alias("name"), "kh", *key, F.col(value).alias("_value"))
    full = held.join(small(wanted.select("name", "kh", "release", "side"), TOUCHED_BROADCAST), ["name", "kh"])
    out = full.groupBy("release", *key).agg(
        F.bool_or(F.col("side") == 1).alias("in_new"), F.bool_or(F.col("side") == -1).alias("in_old"),
        F.max(F.when(F.col("side") == 1, F.col("_value"))).alias("new_value"), F.max(F.when(F.col("side") == -1, F.col("_value"))).alias("old_value"),
    )
    kind = F.when(~F.col("in_old"), "added").when(~F.col("in_new"), "removed").when(~F.col("new_value").eqNullSafe(F.col("old_value")), "changed")
    named = small(pairs.select("feed", F.col("release").alias("at"), "label", F.col("release_no").alias("release")), ARCHIVES_BROADCAST)
    changed = out.withColumn("change_kind", kind).filter("change_kind is not null").join(named, "release")
    return changed.select("feed", F.col("at").alias("release"), "label", *key, "change_kind", "old_value", "new_value")
