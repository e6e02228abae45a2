"""Near duplicates by a chosen-path Jaccard join on word n-grams.

A document is the set of its hashed five-word shingles (lower-case words
between white space; a text of fewer words is one shingle).  Texts with the same
set are one class from the start and take part as one set.

Chosen path: every set walks a random tree whose branches are shared tokens.
At a node it follows each of its tokens whose hash (of node and token) is below
``BRANCHING / (similarity * set size)``, so two sets above the threshold follow
at least ``BRANCHING`` common branches on average and meet in a leaf with a
probability that the depth fixes; the walk is repeated in as many independent
runs as the target recall needs.  Sets in a leaf are a bucket.

A bucket never emits its pairs.  Every bucket has a few leaders, and each set is
first paired with the one of all its leaders that its sketch is closest to, then
with those of the next few that are in other components; verified links join sets into
components.  Then only members outside their leader's component are compared
with all members of the bucket, in tiles of bounded size and by the smallest
hashes of their sets, which decide exactly for sets of at most ``LOWEST``
shingles; only pairs from different components are verified.  So no link
between components is lost.
Candidates are sifted by size and by a 128-bit sketch; every link is verified on
the full sets.  Components grow by label propagation over tables in the shared
folder; links never reach the driver.

Links are counted last: all sets of a component meet once each, in tiles of two
bounded blocks, by their full sets.  A tile emits one count for each set and no
pairs, so rows grow with the blocks of a component and only the products inside
a tile with the square of its sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import held_by, joined, mix64, slices, stored, text_chunks, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.995
DEPTH = 3
BRANCHING = 1.25
#: Leaders of a bucket.
LEADERS = 3
#: Leaders that a set is paired with after the closest one, where they are in
#: other components by then.
NEXT = 3
#: Members of a block that is compared with a bucket.
BLOCK = 512
#: Shingles of a block whose sets are compared in full, on average.
BLOCK_SHINGLES = 1 << 19
#: Sketch bits of 128 that may differ.  Sets at the threshold differ in 12.8 on
#: average, with a standard deviation that falls from 7.5 at 32 shingles, as
#: small sets fill few bins, to 3.4; others differ in 64.  Small sets are not
#: sifted at all.
SKETCH_BITS, SKETCH_BITS_SMALL = 28, 36
SKETCH_SMALL, SKETCH_NONE = 160, 64
#: Smallest hashes of a set that compare it with others of its bucket: a set of
#: at most so many is compared exactly, a larger one within SURE standard errors.
LOWEST = 256
SURE = 3.5
#: Ids of texts to verify that are broadcast (16 bytes each) at most; beyond
#: that the join shuffles.
BROADCAST_IDS = 2_000_000
#: Stands for a null id inside the operator.
_NO_ID = -(1 << 63)

_SPACES = np.ones(256, bool)
_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float = RECALL, branching: float = BRANCHING, depth: int = DEPTH) -> int:
    """Independent runs after which a pair at the threshold has met in a leaf
    with probability ``recall``: a branching process with that mean survives a
    run to the given depth with probability q."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-branching * q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each (lower-case) text."""
    data, starts = joined(texts)
    h, first, _ = word_hashes(data, _SPACES[data], starts)
    doc = np.searchsorted(starts, first, side="right") - 1
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    with np.errstate(over="ignore"):
        full = np.zeros(max(len(h) - SHINGLE + 1, 0), np.uint64)
        for j in range(SHINGLE):
            full = full * _STEP + h[j:j + len(full)]
        full = mix64(full)
        for d in range(len(texts)):
            lo, hi = int(at[d]), int(at[d + 1])
            if hi - lo >= SHINGLE:
                out.append(np.unique(full[lo:hi - SHINGLE + 1]))
            elif hi > lo:
                one = np.zeros(1, np.uint64)
                for j in range(lo, hi):
                    one = one * _STEP + h[j]
                out.append(mix64(one + np.uint64(hi - lo)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        a = mix64(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
        b = mix64(tokens ^ _STEP).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketch(tokens: np.ndarray) -> tuple[int, int]:
    """One bit from the smallest hash of each of 128 bins; an empty bin takes
    that of the next one that isn't."""
    h = np.sort(mix64(tokens * _STEP))
    bins = np.searchsorted(h, np.arange(128, dtype=np.uint64) << np.uint64(57))
    bins[bins == len(h)] = 0
    bits = (h[bins] >> np.uint64(7)) & np.uint64(1)
    words = (bits.reshape(2, 64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return tuple(words.astype(np.int64).tolist())


def lowest(tokens: np.ndarray) -> bytes:
    """The ``LOWEST`` smallest 32-bit hashes of a set, ascending."""
    h = np.unique((mix64(tokens * _STEP) >> np.uint64(32)).astype(np.uint32))
    return h[:LOWEST].astype("<u4").tobytes()


def leaves(tokens: np.ndarray, runs: int, similarity: float, depth: int = DEPTH, branching: float = BRANCHING) -> np.ndarray:
    """Distinct leaves (64-bit path hashes) that a set reaches in all runs."""
    limit = min(1.0, branching / (similarity * len(tokens)))
    bound = np.uint64(min(int(limit * 2.0 ** 64), (1 << 64) - 1))
    nodes = mix64(np.arange(1, runs + 1, dtype=np.uint64) * _STEP)
    with np.errstate(over="ignore"):
        for _ in range(depth):
            kept = []
            # Few nodes at a time, so that memory stays bounded for very long texts.
            width = max(1, (1 << 18) // len(tokens))
            for lo in range(0, len(nodes), width):
                mixed = mix64(nodes[lo:lo + width, None] + tokens[None, :])
                kept.append(mixed[mixed <= bound])
            nodes = np.unique(mix64(np.concatenate(kept) + _STEP)) if kept else nodes[:0]
    return nodes


# ------------------------------------------------------------------ sets


def _with_rid(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("rid"), "text")


def _signatures(rows: DataFrame, similarity: float, runs: int) -> DataFrame:
    """rid and, of its set: fingerprint, size, sketch and leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by("jaccard_join")
        for batch in slices(batches):
            prints, sketches, size, low, paths = [], [], [], [], []
            texts = [t.lower() if t else t for t in batch.column("text").to_pylist()]
            for _, chunk in text_chunks(texts):
                for tokens in shingle_sets(chunk):
                    prints.append(fingerprint(tokens))
                    size.append(len(tokens))
                    sketches.append(sketch(tokens) if len(tokens) else (0, 0))
                    low.append(lowest(tokens))
                    paths.append(leaves(tokens, runs, similarity).astype(np.int64) if len(tokens) else np.zeros(0, np.int64))
            halves = [pa.array([x[i] for x in of], pa.int64()) for of in (prints, sketches) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), *halves[:2], pa.array(size, pa.int32()), *halves[2:], pa.array(low, pa.binary()),
                 pa.array(paths, pa.list_(pa.int64()))], ["rid", "fa", "fb", "size", "s1", "s2", "low", "paths"])

    return rows.mapInArrow(run, "rid long, fa long, fb long, size int, s1 long, s2 long, low binary, paths array<long>")


def _near_leaders(similarity: float) -> Column:
    """(differ, other) of those leaders of a bucket's row whose size and sketch
    may be similar to the row's."""
    found = []
    for i in range(LEADERS):
        of = F.col(f"lead{i}")
        small, large = F.least("size", of["size"]), F.greatest("size", of["size"])
        differ = F.bit_count(F.col("s1").bitwiseXOR(of["s1"])) + F.bit_count(F.col("s2").bitwiseXOR(of["s2"]))
        most = F.when(small < SKETCH_NONE, 128).when(small < SKETCH_SMALL, SKETCH_BITS_SMALL).otherwise(SKETCH_BITS)
        fits = (of["key"] != F.col("key")) & (small >= F.ceil(large * F.lit(similarity)).cast("int")) & (differ <= most)
        found.append(F.when(fits, F.struct(differ.alias("differ"), of["key"].alias("other"))))
    return F.array_compact(F.array(*found))


def _texts_of(keys: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """key and one text of each of the sets."""
    spark = rows.sparkSession
    wanted = stored(spark, sets.join(keys, "key", "left_semi").select("key", "rid"), "join-keys")
    ids = wanted.select("rid").distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by("jaccard_join")
        for batch in slices(batches):
            texts = [t.lower() if t else t for t in batch.column("text").to_pylist()]
            prints = [fingerprint(tokens) for _, chunk in text_chunks(texts) for tokens in shingle_sets(chunk)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in prints], pa.int64()), pa.array([x for _, x in prints], pa.int64()), pa.array(texts, pa.string())],
                ["fa", "fb", "text"])

    # An id may come with several texts: the set's own is told by its fingerprint.
    own = rows.join(ids, "rid", "left_semi").mapInArrow(run, "fa long, fb long, text string")
    own = own.select(F.xxhash64("fa", "fb").alias("key"), "text").join(wanted.select("key"), "key", "left_semi")
    return stored(spark, own.groupBy("key").agg(F.first("text").alias("text")), "join-texts")


def _verify(pairs: DataFrame, rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of keys whose sets have at least that similarity."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    texts = _texts_of(keys, rows, sets)
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by("jaccard_join")
        for batch in slices(batches):
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                sides = [part.column(c).to_pylist() for c in ("ta", "tb")]
                x, y = ([s for _, chunk in text_chunks(side) for s in shingle_sets(chunk)] for side in sides)
                keep = []
                for u, v in zip(x, y, strict=True):
                    shared = len(u) + len(v) - len(np.union1d(u, v))
                    keep.append(shared >= similarity * (len(u) + len(v) - shared))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(rows.sparkSession, both.mapInArrow(run, "a long, b long"), "links")


# ------------------------------------------------------------------ components


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """key, comp (the smallest key of its component) for all keys of the links.

    Labels pass along links and then from label to label until none changes;
    each round is written to the shared folder.  ``known``: components that
    other links made before; then only their labels take part, and keys take
    the label of their label.
    """
    spark = links.sparkSession
    if known is not None:
        between = _labelled(_labelled(links.select("a", "b"), known, "a", "ca"), known, "b", "cb")
        between = stored(spark, between.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")), "links-between")
        if between.isEmpty():
            return known
        upper = components(between)
        lifted = _labelled(known.select("key", F.col("comp").alias("low")), upper, "low", "comp").select("key", "comp")
        # Keys that had no link before are labels of their own.
        return stored(spark, lifted.union(upper.join(known, "key", "left_anti").select("key", "comp")), "labels")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(spark, both.distinct(), "links-both")
    near = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("near"))
    label = stored(spark, near.select("key", F.least("key", "near").alias("comp")), "labels")
    while True:
        offered = both.join(label.select(F.col("key").alias("b"), F.col("comp").alias("near")), "b")
        offered = offered.select(F.col("a").alias("key"), "near", F.lit(None).cast("long").alias("old"))
        own = label.select("key", F.col("comp").alias("near"), F.col("comp").alias("old"))
        step = offered.union(own).groupBy("key").agg(F.min("near").alias("comp"), F.max("old").alias("old"))
        step = stored(spark, step, "labels-step")
        if step.where("comp <> old").isEmpty():
            return step.select("key", "comp")
        # The label's own label: long chains shorten by half in each round.
        new = step.select("key", "comp").join(step.select(F.col("key").alias("comp"), F.col("comp").alias("root")), "comp", "left")
        label = stored(spark, new.select("key", F.least("comp", F.coalesce("root", "comp")).alias("comp")), "labels")


def _labelled(df: DataFrame, comps: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the component of a key column (the key itself if it has no link)."""
    of = comps.select(F.col("key").alias(key), F.col("comp").alias(name))
    return df.join(of, key, "left").withColumn(name, F.coalesce(name, key))


# ------------------------------------------------------------------ the join


def _shared(m: list[np.ndarray], r: list[np.ndarray]) -> np.ndarray:
    """How many tokens each of the sets ``m`` shares with each of ``r``."""
    tokens, place = np.unique(np.concatenate(m + r), return_inverse=True)
    owner = np.repeat(np.arange(len(m) + len(r)), [len(x) for x in m + r])
    in_m = np.zeros(len(tokens), bool)
    in_m[place[owner < len(m)]] = True
    in_r = np.zeros(len(tokens), bool)
    in_r[place[owner >= len(m)]] = True
    column = np.cumsum(in_m & in_r) - 1
    use = (in_m & in_r)[place]
    owner, column = owner[use], column[place[use]]
    shared = np.zeros((len(m), len(r)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):  # bounded memory
        a, b = np.searchsorted(column, [lo, lo + 4096])
        hold = np.zeros((len(m) + len(r), 4096), np.float32)
        hold[owner[a:b], column[a:b] - lo] = 1
        shared += hold[:len(m)] @ hold[len(m):].T
    return shared


def _similar(low_m: list[np.ndarray], low_r: list[np.ndarray], size_m: np.ndarray, size_r: np.ndarray, ok: np.ndarray,
             similarity: float) -> np.ndarray:
    """Which of the pairs in ``ok`` may be similar by their smallest hashes.

    Up to the smaller of both largest hashes, both samples are whole; they are
    compared there, exactly if both sets are whole.
    """
    out = np.zeros_like(ok)
    rows, cols = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
    if not len(rows):
        return out
    m, r = [low_m[i] for i in rows], [low_r[j] for j in cols]
    shared = _shared(m, r)
    whole_m, whole_r = size_m[rows] <= LOWEST, size_r[cols] <= LOWEST
    last = np.uint32(0xFFFFFFFF)
    end_m = np.where(whole_m, last, [x[-1] for x in m]).astype(np.uint32)
    end_r = np.where(whole_r, last, [x[-1] for x in r]).astype(np.uint32)
    n_m = np.array([np.searchsorted(x, np.minimum(end_r, e), "right") for x, e in zip(m, end_m, strict=True)])
    n_r = np.array([np.searchsorted(x, np.minimum(end_m, e), "right") for x, e in zip(r, end_r, strict=True)]).T
    union = np.maximum(n_m + n_r - shared, 1)
    exact = whole_m[:, None] & whole_r[None, :]
    least = similarity - np.where(exact, 1e-6, SURE * np.sqrt(similarity * (1 - similarity) / union))
    out[np.ix_(rows, cols)] = (shared >= least * union) & ok[np.ix_(rows, cols)]
    return out


def _tile_links(t: dict[str, np.ndarray], low: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of a tile: members against outside members."""
    m, r = np.flatnonzero(t["as_m"]), np.flatnonzero(t["as_r"])
    size_m, size_r = t["size"][m], t["size"][r]
    small = np.minimum(size_m[:, None], size_r[None, :])
    ok = (t["comp"][m][:, None] != t["comp"][r][None, :]) & (small >= np.ceil(np.maximum(size_m[:, None], size_r[None, :]) * similarity))
    differ = np.bitwise_count(t["s1"][m][:, None] ^ t["s1"][r][None, :]).astype(np.int16)
    differ += np.bitwise_count(t["s2"][m][:, None] ^ t["s2"][r][None, :])
    ok &= differ <= np.where(small < SKETCH_NONE, 128, np.where(small < SKETCH_SMALL, SKETCH_BITS_SMALL, SKETCH_BITS))
    if not ok.any():
        return m[:0], m[:0]
    a, b = np.nonzero(_similar([low[i] for i in m], [low[j] for j in r], size_m, size_r, ok, similarity))
    # Pairs that are exactly known to be linked make one component: further ones add nothing.
    a, b = m[a], r[b]
    sure = (t["size"][a] <= LOWEST) & (t["size"][b] <= LOWEST)
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while c in root:
            c = root[c]
        return c

    keep = np.ones(len(a), bool)
    for k in np.flatnonzero(sure).tolist():
        x, y = find(int(t["comp"][a[k]])), find(int(t["comp"][b[k]]))
        keep[k] = x != y
        if x != y:
            root[x] = y
    for k in np.flatnonzero(~sure).tolist():
        keep[k] = find(int(t["comp"][a[k]])) != find(int(t["comp"][b[k]]))
    return a[keep], b[keep]


_TILE = ("path", "mb", "rb")


def _cuts(c: dict[str, np.ndarray]) -> np.ndarray:
    """Where the tiles of sorted rows begin, and the end."""
    new = np.ones(len(c[_TILE[0]]) + 1, bool)
    new[1:-1] = False
    for n in _TILE:
        new[1:-1] |= c[n][1:] != c[n][:-1]
    return np.flatnonzero(new)


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by tile, in tables that hold whole tiles."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # The last tile of a batch may go on in the next one.
        last = [batch.column(n)[batch.num_rows - 1].as_py() for n in _TILE]
        same = np.ones(batch.num_rows, bool)
        for n, v in zip(_TILE, last, strict=True):
            same &= batch.column(n).to_numpy() == v
        start = int(np.flatnonzero(same)[0])
        if start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        elif held and [held[-1].column(n)[0].as_py() for n in _TILE] != last:
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _outside_against_members(buckets: DataFrame, sets: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b) from different components of a bucket.

    ``buckets``: path, key, comp, lead_comp.  A bucket's members and those of
    them outside the leader's component are cut into blocks of about ``BLOCK``;
    each tile of one block of either is compared in one place, so no task holds
    more than two blocks at once.
    """
    spark = sets.sparkSession
    counts = buckets.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("comp") != F.col("lead_comp"), 1)).alias("n_out"))
    counts = stored(spark, counts.where("n_out > 0"), "outside-count")
    rows = stored(spark, buckets.join(counts, "path"), "outside")
    keys = rows.select("key").distinct()
    lows = signed.where("size > 0").select("key", "low")
    lows = lows.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, "key", "left_semi")
    lows = lows.groupBy("key").agg(F.first("low").alias("low"))
    lows = stored(spark, lows.join(sets.select("key", "size", "s1", "s2"), "key"), "lowest")
    own = F.xxhash64("key")
    rows = rows.withColumns({
        "nm": F.ceil(F.col("n") / BLOCK), "nr": F.ceil(F.col("n_out") / BLOCK), "out": F.col("comp") != F.col("lead_comp")})
    rows = rows.withColumns({"own_m": F.pmod(own, F.col("nm")), "own_r": F.pmod(F.shiftright(own, 20), F.col("nr"))})
    # Each row gets its set before it is copied to the tiles, so the join's rows
    # grow with the buckets and not with their blocks.
    rows = rows.join(lows, "key")
    base = ["path", "key", "comp", "size", "s1", "s2", "low"]
    as_member = rows.select(*base, F.col("own_m").alias("mb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("nr") - 1)).alias("rb"),
                            "out", "own_r").select(*base, "mb", "rb", F.lit(True).alias("as_m"), (F.col("out") & (F.col("rb") == F.col("own_r"))).alias("as_r"))
    # An outside member stands in its own tile already.
    as_outside = rows.where("out and nm > 1").select(
        *base, F.explode(F.sequence(F.lit(0).cast("long"), F.col("nm") - 1)).alias("mb"), F.col("own_r").alias("rb"), "own_m").where(
        "mb <> own_m").select(*base, "mb", "rb", F.lit(False).alias("as_m"), F.lit(True).alias("as_r"))
    tiles = as_member.unionByName(as_outside).select(*_TILE, "key", "comp", "size", "s1", "s2", "low", "as_m", "as_r")
    tiles = tiles.repartition(*_TILE).sortWithinPartitions(*_TILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table) -> pa.RecordBatch:
            c = {n: table.column(n).to_numpy() for n in (*_TILE, "key", "comp", "size", "s1", "s2", "as_m", "as_r")}
            low = [np.frombuffer(x, "<u4") for x in table.column("low").to_pylist()]
            cuts = _cuts(c)
            found = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                t = {n: v[lo:hi] for n, v in c.items()}
                if hi - lo > 1 and t["as_r"].any():
                    a, b = _tile_links(t, low[lo:hi], similarity)
                    if len(a):
                        x, y = t["key"][a], t["key"][b]
                        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], ["a", "b"])

        held_by("jaccard_join")
        for table in _whole_tiles(batches):
            yield links(table)

    return tiles.mapInArrow(run, "a long, b long").distinct()


def _tile_degrees(m: list[np.ndarray], r: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set of ``m`` with the sets of ``r``, and of each of ``r``
    with those of ``m``; without ``r``, of ``m`` among themselves."""
    other = m if r is None else r
    size_m, size_r = np.array([len(x) for x in m]), np.array([len(x) for x in other])
    shared = np.zeros((len(m), len(other)))
    # Only sets of sizes that may be similar meet: in steps of size, those of two adjacent ones.
    step_m, step_r = (np.floor(np.log(x) / -np.log(similarity) + 1e-9).astype(int) if similarity < 1 else x for x in (size_m, size_r))
    for k in np.unique(step_m):
        i, j = np.flatnonzero(step_m == k), np.flatnonzero(abs(step_r - k) <= 1)
        if len(j):
            shared[np.ix_(i, j)] = _shared([m[x] for x in i], [other[x] for x in j])
    linked = shared >= similarity * (size_m[:, None] + size_r[None, :] - shared)
    if r is None:
        np.fill_diagonal(linked, False)
        return linked.sum(axis=1), np.zeros(0, np.int64)
    return linked.sum(axis=1), linked.sum(axis=0)


def _degrees(sets: DataFrame, comps: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """key and n_links, the sets of its component that have at least that
    similarity, of all sets that share their component."""
    spark = sets.sparkSession
    members = sets.select("key", "size").join(comps, "key")
    blocks = members.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("nb"))
    placed = members.join(blocks, "comp").select("key", "comp", "nb", F.pmod(F.xxhash64("key"), F.col("nb")).alias("own"))
    placed = stored(spark, placed, "placed")
    texts = _texts_of(placed.select("key"), rows, sets).join(placed, "key").select("key", "comp", "nb", "own", "text")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            full = [t.tobytes() for _, chunk in text_chunks(batch.column("text").to_pylist()) for t in shingle_sets(chunk)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "comp", "nb", "own")), pa.array(full, pa.binary())], ["key", "comp", "nb", "own", "tokens"])

    full = texts.mapInArrow(tokens, "key long, comp long, nb long, own long, tokens binary")
    tiles = full.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    tiles = tiles.select(F.col("comp").alias("path"), F.least("own", "with").alias("mb"), F.greatest("own", "with").alias("rb"), "key", "own", "tokens")
    tiles = tiles.repartition(*_TILE).sortWithinPartitions(*_TILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            c = {n: table.column(n).to_numpy() for n in (*_TILE, "key", "own")}
            cuts, held = _cuts(c), table.column("tokens")
            keys, links = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                own = [np.frombuffer(x, np.uint64) for x in held.slice(lo, hi - lo).to_pylist()]
                as_m = c["own"][lo:hi] == c["mb"][lo]
                m, r = np.flatnonzero(as_m), np.flatnonzero(~as_m)
                same = c["mb"][lo] == c["rb"][lo]
                if not same and not (len(m) and len(r)):
                    continue
                of_m, of_r = _tile_degrees([own[i] for i in m], None if same else [own[i] for i in r], similarity)
                keys.append(c["key"][lo:hi][np.concatenate([m, r])])
                links.append(np.concatenate([of_m, of_r]))
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or none), pa.int64()) for x in (keys, links)], ["key", "links"])

    return stored(spark, tiles.mapInArrow(run, "key long, links long").groupBy("key").agg(F.sum("links").alias("n_links")), "degrees")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, counted: bool = True) -> DataFrame:
    """One row per document: doc_id, class_id, rep_id, n_links, class_size, n_shingles.

    ``class_id`` is the smallest doc_id of the class, ``rep_id`` that of the
    documents with the same shingle set.  ``n_links`` counts all links of the
    document's set: the other sets of its class that have at least the
    similarity (null unless ``counted``).  Null texts and texts without a word are in no
    class but their own.  Repeated rows count each; an id with different texts
    has a row for each; a class or set whose smallest id is null has a null id.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = _with_rid(docs)
    signed = stored(spark, _signatures(rows, similarity, runs_for(recall)).withColumn("key", F.xxhash64("fa", "fb")), "signatures")
    some = signed.where("size > 0")
    sets = some.groupBy("key").agg(F.min(F.struct("rid", "size", "s1", "s2")).alias("one"), F.count(F.lit(1)).alias("n")).select("key", "one.*", "n")
    sets = stored(spark, sets, "sets")
    # Rows of the same set have the same leaves.
    own = ["size", "s1", "s2"]
    walks = some.groupBy("key").agg(*[F.first(c).alias(c) for c in ("paths", *own)]).select("key", *own, F.explode("paths").alias("path"))
    walks = stored(spark, walks, "walks")
    # Leaders go into their bucket's rows with all that is compared.
    lead = [F.min(F.struct(F.xxhash64("key", "path", F.lit(i)).alias("h"), "key", *own)).dropFields("h").alias(f"lead{i}") for i in range(LEADERS)]
    led = walks.groupBy("path").agg(F.min("key").alias("low"), F.max("key").alias("high"), *lead)
    led = stored(spark, led.where("low < high").drop("low", "high"), "leaders")
    buckets = stored(spark, walks.join(led, "path"), "buckets")

    # The closest leaders of each set, of at most LEADERS * leaves.
    tries = buckets.select("key", _near_leaders(similarity).alias("near")).where(F.size("near") > 0)
    near = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    tries = stored(spark, tries.groupBy("key").agg(F.slice(near, 1, 1 + NEXT).alias("near")), "tries")
    tested = stored(spark, _ordered(tries.select("key", F.col("near")[0]["other"].alias("other"))), "tested")
    links = _verify(tested, rows, sets, similarity)
    comps = components(links)
    # The next closest, where they are in other components still.
    apart = tries.select("key", F.explode(F.slice("near", 2, NEXT)).alias("next")).select("key", "next.other")
    second = _labelled(_labelled(apart, comps, "key", "comp"), comps, "other", "comp_b").where("comp <> comp_b")
    second = stored(spark, _ordered(second).join(tested, ["a", "b"], "left_anti"), "tested")
    more = _verify(second, rows, sets, similarity)
    comps = components(more, comps)
    # All that is left between components.
    marked = _labelled(_labelled(buckets.select("path", "key", F.col("lead0.key").alias("lead0")), comps, "key", "comp"), comps, "lead0", "lead_comp")
    marked = stored(spark, marked.select("path", "key", "comp", "lead_comp"), "buckets-marked")
    third = _outside_against_members(marked, sets, signed, similarity)
    third = stored(spark, third.join(tested.union(second), ["a", "b"], "left_anti"), "tested")
    more = _verify(third, rows, sets, similarity)
    comps = components(more, comps)

    degree = _degrees(sets, comps, rows, similarity) if counted else sets.select("key", F.lit(None).cast("long").alias("n_links"))
    none = F.lit(0 if counted else None).cast("long")
    classed = _labelled(sets.select("key", "rid", "n"), comps, "key", "comp")
    whole = classed.groupBy("comp").agg(F.min("rid").alias("class_rid"), F.sum("n").alias("class_size"))
    of_set = classed.join(whole, "comp").join(degree, "key", "left").select(
        "key", F.col("rid").alias("rep_rid"), "class_rid", "class_size", F.coalesce("n_links", none).alias("n_links"))
    of_set = stored(spark, of_set, "classes")
    out = signed.select("rid", "size", "key").join(of_set, (signed["key"] == of_set["key"]) & (signed["size"] > 0), "left")

    def known(c: str):
        return F.when(F.col(c) != _NO_ID, F.col(c))

    return out.select(
        known("rid").alias("doc_id"), F.when(F.col("class_rid").isNull(), known("rid")).otherwise(known("class_rid")).alias("class_id"),
        F.when(F.col("rep_rid").isNull(), known("rid")).otherwise(known("rep_rid")).alias("rep_id"),
        F.coalesce("n_links", none).alias("n_links"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.col("size").cast("long").alias("n_shingles"))


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The document with the smallest id of each class, with all its columns.

    Of repeated rows with that id and text, one stays.  Rows with a null id
    stay, and stand for their class.
    """
    spark = docs.sparkSession
    classes = near_duplicates(docs, similarity, recall, counted=False).where("class_size > 1 and doc_id is not null")
    classes = stored(spark, classes.select("doc_id", "class_id"), "duplicates")

    def small(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    goes = classes.where("not (doc_id <=> class_id)").distinct().select("doc_id")
    kept = docs.join(small(goes), "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
    again = classes.where("doc_id <=> class_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    again = small(again)
    once = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))
