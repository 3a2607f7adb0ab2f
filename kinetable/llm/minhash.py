"""Near-duplicates by a signature-coordinate inverted join and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import components, ship_by_value, sized_broadcast

ship_by_value(__name__)

COORDS = 64  # posted coordinates
BLOCK, BLOCK_SHINGLES = 2_048, 2_000_000  # sets of a block and shingles in them, on average at most
TASK_ROWS = 2_048  # rows of block pairs that are handed to Python at once
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``width``-word shingles, A-Z lower-cased, words between
    ASCII white space. A shorter text is one shingle of all its words; none for null or no word.
    """
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    found = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        found = _mix(found * _M1 + each[i : len(each) - span + 1 + i])
    return np.unique(found)


def _permutations(coords: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, coords + 1, dtype=np.uint64)
    return _mix(i * _M1) | np.uint64(1), _mix(i * _M2 + _M3)


def signature(own: np.ndarray, coords: int) -> np.ndarray:
    """The smallest 32-bit value of the set under each of ``coords`` hash functions."""
    a, b = _permutations(coords)
    least = np.full(coords, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 4096):
        part = own[i : i + 4096]
        least = np.minimum(least, (a[:, None] * part[None, :] + b[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _identity(own: np.ndarray) -> int:
    """64 bits of the whole set."""
    both = np.array([len(own), (own * _M1).sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(own))], np.uint64)
    return int(np.uint64(xxhash.xxh3_64_intdigest(both.tobytes())).view(np.int64))


def sketches(docs: DataFrame, key: str, text: str, width: int, coords: int) -> DataFrame:
    """``(id, hash, n, sid, sig)``: a hash of the text, size and identity of its shingle set, its signature; no row is lost."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sid, sig = [], [], []
            for t in batch.column(2):
                own = shingles(t.as_py(), width)
                n.append(len(own))
                sid.append(_identity(own) if len(own) else None)
                sig.append(signature(own, coords) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(sig, pa.list_(pa.int32()))],
                ["id", "hash", "n", "sid", "sig"],
            )

    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("t"))
    return rows.mapInArrow(work, f"id {kind}, hash long, n long, sid long, sig array<int>")


def sets(docs: DataFrame, text: str, width: int, coords: int) -> DataFrame:
    """``(sid, own, sig)``: the full shingle set of each document and its signature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for t in batch.column(0) if len(x := shingles(t.as_py(), width))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_identity(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                    pa.array([signature(x, coords) for x in found], pa.list_(pa.int32())),
                ],
                ["sid", "own", "sig"],
            )

    return docs.select(text).mapInArrow(work, "sid long, own array<long>, sig array<int>")


def match_threshold(percent: int, coords: int) -> int:
    """Coordinates that a pair at the similarity agrees in, less 4.3 standard deviations: about 1 in 100,000 has fewer."""
    p = percent / 100
    return max(1, floor(coords * p - 4.3 * sqrt(coords * p * (1 - p))))


def prefixes(reps: DataFrame, least: int) -> DataFrame:
    """``(sid, n, keys, prefix, weight)``: coordinate-value pairs that some other set shares, rarest first; the first
    of them, one of which any partner with ``least`` matches must share; and how often all of them are shared.
    """
    value = F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    posted = reps.select("sid", F.posexplode("sig").alias("coord", "value"))
    posted = posted.select("sid", F.shiftleft(F.col("coord").cast("long"), 32).bitwiseOR(value).alias("k"))
    shared = posted.groupBy("k").agg(F.count("*").alias("df")).where("df > 1")
    listed = posted.join(shared, "k").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("df", "k"))).alias("l"))
    listed = listed.where(F.size("l") >= least)
    weight = F.aggregate("l", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    listed = listed.select("sid", F.col("l.k").alias("keys"), F.slice("l.k", 1, F.size("l") - least + 1).alias("prefix"), weight.alias("weight"))
    return listed.join(reps.select("sid", "n"), "sid")


def _lists(rows: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and where each row's begin."""
    held = rows.column(name).combine_chunks()
    held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
    return held.values.to_numpy(), held.offsets.to_numpy()


def _block_pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the first and of the second block of each pair of blocks."""
    hub, block, i, j = (rows.column(x).to_numpy() for x in ("hub", "block", "i", "j"))
    order = np.lexsort((j, i, hub))
    new = [(x[order][1:] != x[order][:-1]) for x in (hub, i, j)]
    for part in np.split(order, np.flatnonzero(new[0] | new[1] | new[2]) + 1):
        yield part[block[part] == i[part]], part[block[part] == j[part]]


def _alike(rows: pa.Table, least: int, percent: int):
    """By row: which of some others agree in ``least`` coordinates and are not too different in size."""
    sig = _lists(rows, "sig")[0].reshape(rows.num_rows, -1)
    n = rows.column("n").to_numpy()

    def near(x: int, others: np.ndarray) -> np.ndarray:
        some = others[(others != x) & (100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x]))]
        return some[(sig[some] == sig[x]).sum(axis=1) >= least]

    return near


def _partnered(rows: pa.Table, least: int, percent: int) -> pa.Table:
    """``(hub, sid)`` of the sets in block pairs whose signature agrees with that of any other set there."""
    near, found = _alike(rows, least, percent), np.zeros(rows.num_rows, bool)
    for left, right in _block_pairs(rows):
        for those, others in ((left, right), (right, left)):
            for x in those:
                if not found[x]:
                    some = near(x, others)
                    found[some] = True
                    found[x] = len(some) > 0
    return rows.select(["hub", "sid"]).filter(pa.array(found))


def _compare(rows: pa.Table, least: int, percent: int) -> pa.Table:
    """Links of block pairs, across components only: signatures agree in ``least`` coordinates and the full sets are
    similar enough. A set leaves with one link to each other component; further ones join nothing more.
    """
    values, edges = _lists(rows, "own")
    values, near = values.view(np.uint64), _alike(rows, least, percent)
    sid, n, c = (rows.column(x).to_numpy() for x in ("sid", "n", "c"))
    a, b = [], []
    for left, right in _block_pairs(rows):
        for x in left:
            some = near(x, right[c[right] != c[x]])
            if not len(some):
                continue
            mine = values[edges[x] : edges[x + 1]]  # sorted and distinct
            sizes = edges[some + 1] - edges[some]
            theirs = np.concatenate([values[edges[y] : edges[y + 1]] for y in some])
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            same = np.add.reduceat(mine[at] == theirs, np.cumsum(sizes) - sizes, dtype=np.int64)
            some = some[100 * same >= percent * (n[x] + sizes - same)]
            some = some[np.unique(c[some], return_index=True)[1]]
            a.extend(np.minimum(sid[some], sid[x]).tolist())
            b.extend(np.maximum(sid[some], sid[x]).tolist())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _in_blocks(members: DataFrame, work, least: int, percent: int, schema: str, extra: DataFrame) -> DataFrame:
    """``work`` on every pair of blocks of each ``hub``'s ``members(hub, sid, n, ...)``, joined with ``extra`` by sid.

    Every block meets every block: rows of block x go to the pairs (min(x, y), max(x, y)). A block holds ``BLOCK`` sets or
    ``BLOCK_SHINGLES`` shingles on average, whichever is less, however large the group is.
    """
    sizes = members.groupBy("hub").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sized = cut_lineage(members.join(sizes.select("hub", blocks.alias("blocks")), "hub"))
    n_rows = sized.agg(F.sum("blocks")).first()[0] or 0
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).join(extra, "sid")
    dealt = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "y"), "j": F.greatest("block", "y")}).drop("blocks", "y")
    bucket = F.pmod(F.xxhash64("hub", "i", "j"), F.lit(n_rows // TASK_ROWS + 1)).alias("bucket")
    return dealt.groupBy(bucket).applyInArrow(lambda rows: work(rows, least, percent), schema).distinct()


def links(docs: DataFrame, reps: DataFrame, key: str, text: str, width: int, percent: int, coords: int) -> DataFrame:
    """``(id, component)`` of every set that has a candidate; links are confirmed on full sets.

    Connectivity needs no more than a spanning set of links. The members of a posting list are first compared
    with the list's hub, the set whose values are shared most, so the origin of many near copies. Lists with
    one hub then form a group. Its members first meet by their signatures, block by block inside tasks: who agrees
    with nobody in enough coordinates leaves, and most who share a value by chance do. The others are compared by their full sets
    as far as they are still in different components; only links leave a task. Every pair that shares a posted value is in a
    group, and no list or group is cut. Blocks are of a bounded size, however large the group.
    """
    least = match_threshold(percent, coords)
    listed = cut_lineage(prefixes(reps, least))
    posts = listed.select("sid", "n", "weight", F.explode("prefix").alias("k"))
    drawn = F.struct("weight", "sid", "n")
    hubs = posts.groupBy("k").agg(F.count("*").alias("m"), F.max(drawn).alias("hub")).where("m > 1")
    hubs = cut_lineage(hubs)  # read from files, joins can split a value or hub that many sets share
    members = posts.join(hubs, "k").select(F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n"), "sid", "n").distinct()
    members = cut_lineage(members)
    close = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    pairs = members.where((F.col("sid") != F.col("hub")) & close).select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()
    at = lambda s, x: s.select(F.col("sid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in s.columns if c != "sid"))
    keys = listed.select("sid", "keys")
    matched = pairs.join(at(keys, "a"), "a").join(at(keys, "b"), "b").where(F.size(F.array_intersect("keys_a", "keys_b")) >= least)
    matched = cut_lineage(matched.select("a", "b"))
    # what may still have a partner: members of a group with more than its hub and one other
    sizes = members.groupBy("hub").agg(F.count("*").alias("size")).where("size > 2").select("hub")
    met = cut_lineage(members.join(sizes, "hub").select("hub", "sid", "n"))
    crowded = cut_lineage(_in_blocks(met, _partnered, least, percent, "hub long, sid long", reps.select("sid", "sig")))
    wanted = matched.select(F.col("a").alias("sid")).union(matched.select("b")).union(crowded.select("sid")).distinct()
    wanted = cut_lineage(reps.join(wanted, "sid", "left_semi").select("rep").distinct())
    found = docs.join(sized_broadcast(wanted), F.col(key).eqNullSafe(F.col("rep")), "left_semi")
    full = cut_lineage(sets(found, text, width, coords).groupBy("sid").agg(F.first("own").alias("own"), F.first("sig").alias("sig")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        own = full.select("sid", "own")
        both = pairs.join(at(own, "a"), "a").join(at(own, "b"), "b").withColumn("same", F.size(F.array_intersect("own_a", "own_b")))
        union = F.size("own_a") + F.size("own_b") - F.col("same")
        return cut_lineage(both.where(100 * F.col("same") >= percent * union).select("a", "b"))

    ids = members.select(F.col("sid").alias("id")).distinct()
    first = components(confirmed(matched))
    labels = cut_lineage(ids.join(first, "id", "left").select("id", F.coalesce("component", "id").alias("c")))
    named = crowded.join(labels, crowded["sid"] == labels["id"]).select("hub", "sid", "c")
    apart = named.groupBy("hub").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("hub")
    left = cut_lineage(named.join(apart, "hub").join(reps.select("sid", "n"), "sid"))
    more = cut_lineage(_in_blocks(left, _compare, least, percent, "a long, b long", full))
    of = lambda c, t: labels.select(F.col("id").alias(c), F.col("c").alias(t))
    ends = more.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    whole = components(ends).select(F.col("id").alias("c"), F.col("component").alias("whole"))
    return labels.join(whole, "c", "left").select("id", F.coalesce("whole", "c").alias("component"))


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """``(id, hash, n_shingles, component_id, kept)``, one row per row of ``docs``; ``hash`` is the text's.

    Documents whose shingle sets have a Jaccard similarity of at least ``percent`` hundredths are linked;
    ``component_id`` is the smallest key reachable. Equal sets are one vertex, so copies form no pairs.
    Signatures of ``coords`` coordinates are posted under each (coordinate, value); rare values come
    first, and only pairs with enough collisions are confirmed on the full sets (64-bit hashes of
    shingles). Null and wordless texts have an empty set and are linked with nothing. Rows with a null key take the
    smallest key of their component, null if there is none; such a row is kept if its component has no other key.
    """
    return _grouped(docs, key, text, width, percent, coords).drop("c")


def _grouped(docs: DataFrame, key: str, text: str, width: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """What ``group`` returns and ``c``, a name of the group; null where a set is alone."""
    seen = cut_lineage(sketches(docs, key, text, width, coords))
    reps = seen.where("n > 0").groupBy("sid").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count("*").alias("copies")
    )
    reps = cut_lineage(reps)
    found = links(docs, reps, key, text, width, percent, coords)
    named = reps.select("sid", "rep", "copies").join(found, F.col("sid") == F.col("id"), "left").withColumn("c", F.coalesce("component", "sid"))
    named = named.where("component is not null or copies > 1").select("sid", "rep", "c")
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "c").select("sid", "component_id", "c")
    out = seen.select("id", "hash", "n", "sid").join(named, "sid", "left")
    return out.select(
        "id", "hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"), "c",
    )


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest key and, among texts with this key, the
    smallest hash; rows that repeat a key and a text stay once.

    What leaves is listed by key and hash of the text; the list is broadcast if it is small, else texts are shuffled.
    Documents without words are linked with nothing and stay.
    """
    found = cut_lineage(_grouped(docs, key, text, **options))
    # a group's smallest key, or no key at all, may stand on several texts
    one = found.where(F.col("kept") & F.col("c").isNotNull()).groupBy("c").agg(F.min("hash").alias("_one"))
    found = found.join(one, "c", "left").withColumn("kept", F.col("kept") & F.coalesce(F.col("hash") == F.col("_one"), F.lit(True)))
    gone = cut_lineage(found.where(~F.col("kept")).select(F.col("id").alias("_id"), F.col("hash").alias("_hash")).distinct())
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash"))
    kept = docs.join(sized_broadcast(gone), same, "left_anti")
    twice = docs.groupBy(F.col(key).alias("_id"), F.xxhash64(text).alias("_hash")).agg(F.count("*").alias("m")).where("m > 1")
    twice = cut_lineage(twice.select("_id", "_hash"))
    if twice.isEmpty():
        return kept
    twice = sized_broadcast(twice)
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates([key, text]))
