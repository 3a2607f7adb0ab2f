"""Repeated byte strings by suffix arrays of shards, built by induced sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import ship_by_value

ship_by_value(__name__)

GRAM = 32  # bytes whose smallest hash within a string names the shard that the string is sorted in
RUN = 1_024  # starts of one segment at most
PIECE = 1 << 20  # starts of a text handled at once
SHARD_BYTES = 1_500_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def segments(raw: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor, start, n, grams)``: runs of starts whose ``length``-byte strings have the same smallest gram hash,
    and how often that gram stands in the run.

    Equal strings have equal anchors wherever they stand, so strings are only compared within an anchor;
    equal strings of one run hold its gram at different places.
    """
    gram = min(GRAM, length)
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, len(raw) - length + 1, PIECE):
        part = data[at : at + PIECE + length - 1].astype(np.uint64)
        found, done, power = part, 1, int(_M1)
        whole = None  # hash of the grams, composed from hashes of doubling lengths
        taken, left = 0, gram
        while left:
            if left & 1:
                if whole is None:
                    whole, taken = found, done
                else:
                    n = len(part) - taken - done + 1
                    whole, taken = whole[:n] * np.uint64(power) + found[taken : taken + n], taken + done
            left >>= 1
            if left:
                n = len(found) - done
                found, done, power = found[:n] * np.uint64(power) + found[done:], done * 2, power * power % (1 << 64)
        whole = whole[: len(part) - gram + 1]
        whole = (whole ^ (whole >> np.uint64(29))) * _M2
        whole ^= whole >> np.uint64(32)
        grams, width, span = whole, length - gram + 1, 1
        while span * 2 <= width:
            whole, span = np.minimum(whole[:-span], whole[span:]), span * 2
        if span < width:
            whole = np.minimum(whole[: len(whole) - (width - span)], whole[width - span :])
        starts = np.flatnonzero(np.concatenate(([True], whole[1:] != whole[:-1])))
        ends = np.append(starts[1:], len(whole))
        anchors = whole[starts].view(np.int64)
        for anchor, value, a, b in zip(anchors.tolist(), whole[starts], starts.tolist(), ends.tolist(), strict=True):
            held = int(np.count_nonzero(grams[a : b + width - 1] == value))
            for x in range(a, b, RUN):
                yield anchor, at + x, min(RUN, b - x), held


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the single smallest one."""
    change = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(change, len(text) - 1)
    smaller = np.append(text[change] < text[change + 1], True)
    return np.repeat(smaller, np.diff(ends, prepend=-1))


def _deal(at: np.ndarray, keys: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Appends positions to the buckets of their symbols in the order given."""
    if len(at):
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for part, key in zip(np.split(at, cut), keys[np.concatenate(([0], cut))].tolist(), strict=True):
            buckets[key].append(part)


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """From leftmost-smaller positions in order, all larger-type suffixes upward and all smaller-type ones downward.

    A bucket is scanned in batches: what a batch induces into its own bucket is the next batch, everything
    else belongs to buckets not yet scanned. Every position is handled once in either direction.
    """
    none = np.empty(0, np.int32)
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    first: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(seeds, text[seeds], first)

    def spread(batch: np.ndarray, into: list[list[np.ndarray]], kind: bool, c: int) -> np.ndarray:
        before = batch[batch > 0] - 1
        before = before[small[before] == kind]
        keys = text[before]
        own = keys == c
        _deal(before[~own], keys[~own], into)
        return before[own]

    up: list[np.ndarray] = []
    for c in range(symbols):
        batch, kept = np.concatenate(larger[c] or [none]), []
        while len(batch):
            kept.append(batch)
            batch = spread(batch, larger, False, c)
        up.append(np.concatenate(kept or [none]))
        for part in first[c]:
            spread(part, larger, False, c)
    down: list[np.ndarray] = [none] * symbols
    smaller[0].append(np.array([len(text) - 1], np.int32))
    for c in range(symbols - 1, -1, -1):
        batch, kept = np.concatenate(smaller[c] or [none]), []
        while len(batch):
            kept.append(batch)
            batch = spread(batch, smaller, True, c)
        down[c] = np.concatenate(kept or [none])
        spread(up[c][::-1], smaller, True, c)
    return up, down


def _names(text: np.ndarray, order: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Ranks of leftmost-smaller substrings in text order, equal for equal substrings; ``order`` has them sorted."""
    place = np.empty(len(text), np.int32)
    place[marks] = np.arange(len(marks))
    size = np.diff(np.append(marks, len(text) - 1)) + 1  # up to and with the next mark
    size = size[place[order]]
    same = np.zeros(len(order), bool)
    alive = np.flatnonzero(size[1:] == size[:-1]) + 1
    step = 0
    while len(alive):
        end = size[alive] <= step
        same[alive[end]] = True
        alive = alive[~end]
        alive = alive[text[order[alive] + step] == text[order[alive - 1] + step]]
        step += 1
    names = np.empty(len(marks), np.int64)
    names[place[order]] = np.cumsum(~same) - 1
    return names


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Positions of the reduced string in suffix order: names that still tie are renamed, again and again, by
    themselves and the name as far on as is compared already. A rank is the place of its first holder, so only ties are sorted.
    """
    n = len(names)
    rank = np.concatenate(([0], np.cumsum(np.bincount(names))))[names]
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    step = 1
    while len(tied):
        ahead = np.zeros(len(tied), np.int64)
        inside = tied + step < n
        ahead[inside] = rank[tied[inside] + step] + 1
        pair = rank[tied] * (n + 1) + ahead
        order = np.argsort(pair)
        tied, pair, old = tied[order], pair[order], rank[tied[order]]
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        place, first = np.arange(len(tied)), np.concatenate(([True], old[1:] != old[:-1]))
        rank[tied] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
        alone = new & np.concatenate((new[1:], [True]))
        tied = tied[~alone]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (small numbers, the last a single 0): substrings between leftmost-smaller positions
    are sorted by induction, named, the names' string is sorted, and its order induces the whole array.
    """
    symbols = int(text.max()) + 1
    small = _types(text)
    marks = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if not len(marks):
        return np.arange(len(text) - 1, -1, -1, dtype=np.int32)
    _, down = _induce(text, small, marks, symbols)
    is_mark = np.zeros(len(text), bool)
    is_mark[marks] = True
    ranked = np.concatenate([d[::-1] for d in down])
    ranked = ranked[is_mark[ranked]]
    seeds = marks[_sort_names(_names(text, ranked, marks))]
    up, down = _induce(text, small, seeds, symbols)
    return np.concatenate([x for u, d in zip(up, down, strict=True) for x in (u, d[::-1])])


def common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: by text position, the symbols shared with the suffix before it in the array.

    Only positions that differ from their neighbour one symbol to the left are compared, four 16-bit symbols at a time; each
    further position has one symbol less than the one before it.
    """
    before = np.full(len(text), -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.arange(len(text))
    fresh = (before <= 0) | (at == 0) | (text[at - 1] != text[before - 1])
    heads = np.flatnonzero(fresh)
    value = np.zeros(len(heads), np.int64)
    padded = np.concatenate((text.astype("<u2"), np.zeros(4, "<u2")))
    words = np.ndarray(len(text), "<u8", padded, 0, (2,))  # the symbols from each position on; no two suffixes agree beyond the last
    alive = np.flatnonzero(before[heads] >= 0)
    a, b = heads[alive], before[heads[alive]]
    while len(alive):
        differ = words[a] ^ words[b]
        equal = differ == 0
        value[alive] += np.where(equal, 4, sum((differ & np.uint64((1 << 16 * i) - 1)) == 0 for i in (1, 2, 3)))
        alive, a, b = alive[equal], a[equal] + 4, b[equal] + 4
    run = np.cumsum(fresh) - 1
    return np.maximum(value[run] - (at - heads[run]), 0)


def repeated_starts(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For each content, the starts whose ``length`` bytes also begin elsewhere in the contents."""
    sizes = np.array([len(c) + 1 for c in contents])
    text = np.empty(sizes.sum() + 1, np.int16)
    joined = np.frombuffer(b"\0".join(contents) + b"\0\0", np.uint8)
    text[:] = joined
    text += 2
    edges = np.cumsum(sizes) - 1
    text[edges] = 1
    text[-1] = 0
    array = suffix_array(text)
    shared = common_prefixes(text, array)
    after = np.zeros(len(text), np.int64)  # shared with the following suffix
    after[array[:-1]] = shared[array[1:]]
    twice = np.maximum(shared, after) >= length
    return [np.flatnonzero(twice[e - n + 1 : max(e - length, e - n) + 1]) for e, n in zip(edges.tolist(), sizes.tolist(), strict=True)]


def _located(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tid, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = value.as_py() or b""
            rows = [(a, xxhash.xxh3_64_intdigest(raw[s : s + n + length - 1]), s, n, g) for a, s, n, g in segments(raw, length)]
            if rows:
                anchor, content, start, n, grams = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), tid)), pa.array(anchor, pa.int64()),
                        pa.array(np.array(content, np.uint64).view(np.int64)), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
                        pa.array(np.array(grams) > 1),
                    ],
                    ["tid", "anchor", "content", "start", "n", "again"],
                )


def _batched(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Small batches put together; a batch of a single text would cost more to send than to make."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _runs(starts: np.ndarray) -> list[dict]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return [{"first": int(x[0]), "end": int(x[-1]) + 1} for x in np.split(starts, cut)]


_RUNS = "array<struct<first:int,end:int>>"


def _sorted_shards(cut: DataFrame, length: int) -> DataFrame:
    """``(anchor, content, runs)``: repeated starts of each distinct segment, by one suffix array per shard."""

    def work(rows: pa.Table) -> pa.Table:
        raw = rows.column("raw").to_pylist()
        found = repeated_starts(raw, length)
        runs = [
            [{"first": 0, "end": len(r) - length + 1}] if c > 1 else _runs(f)
            for r, f, c in zip(raw, found, rows.column("copies").to_pylist(), strict=True)
        ]
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return pa.table([rows.column("anchor"), rows.column("content"), pa.array(runs, kind)], ["anchor", "content", "runs"])

    return cut.groupBy("shard").applyInArrow(work, f"anchor long, content long, runs {_RUNS}")


def _counted_strings(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors whose segments don't fit a shard: their strings are counted by 128-bit hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, copies, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "copies", "raw")), strict=True):
                each = [xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(len(raw) - length + 1)]
                n = len(each)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n, pa.int64()), pa.array([content] * n, pa.int64()), pa.array([copies] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(each, pa.binary())],
                    ["anchor", "content", "copies", "at", "string"],
                )

    strings = cut_lineage(cut.mapInArrow(lambda b: _batched(work(b)), "anchor long, content long, copies long, at int, string binary"))
    often = strings.groupBy("string").agg(F.sum("copies").alias("m")).where("m > 1").select("string")
    hits = strings.join(often, "string", "left_semi")
    run = F.array(F.struct(F.col("at").alias("first"), (F.col("at") + 1).alias("end")))
    return hits.select("anchor", "content", run.alias("runs"))


def _merge(spans: list) -> list[dict]:
    done: list[dict] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans):
        if done and first <= done[-1]["end"]:
            done[-1]["end"] = max(done[-1]["end"], end)
        else:
            done.append({"first": first, "end": end})
    return done


def repeats(docs: DataFrame, text: str = "text", length: int = 200, broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with ``spans``: maximal byte ranges (end exclusive) of the UTF-8 text covered by strings of
    ``length`` bytes that also start anywhere else, in the same text or another; null if there are none.

    Every string has an anchor, the smallest hash among its ``GRAM``-byte substrings, so equal strings share it;
    stretches of starts with one anchor are segments. Segments whose anchor occurs once in all are done. Equal segments
    become one with a count, and the others of an anchor meet in one shard, whose suffix array
    tells by common prefixes which starts repeat. An anchor with more distinct bytes than a shard holds is
    decided by counting its strings. Texts are told apart by 64-bit hash, segments by 128 bits. Null
    texts are empty; a column ``spans`` is replaced.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    seen = docs.drop("spans", "_tid").withColumn("_tid", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    plain = docs.select(F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid"), raw.alias("raw"))
    located = plain.mapInArrow(lambda b: _batched(_located(b, length)), "tid long, anchor long, content long, start int, n int, again boolean")
    located = cut_lineage(located)
    often = located.groupBy("anchor").agg(F.count("*").alias("m"), F.max("again").alias("again")).where("m > 1 or again").select("anchor")
    often = cut_lineage(often)  # read from files on both sides, a join can split an anchor that many rows share
    shared = cut_lineage(located.drop("again").join(often, "anchor", "left_semi"))
    unique = cut_lineage(shared.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(F.struct("tid", "start", "n")).alias("at")))
    sizes = cut_lineage(unique.groupBy("anchor").agg(F.sum(F.col("at.n") + length - 1).alias("bytes")))
    total = sizes.where(F.col("bytes") <= SHARD_BYTES).agg(F.sum("bytes")).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    wanted = unique.select("at.tid", F.struct("at.start", "at.n", "anchor", "content", "copies").alias("s"))
    wanted = wanted.groupBy("tid").agg(F.collect_list("s").alias("list"))  # no more than a text has segments
    some = unique.select("at.tid").distinct()
    few = some.limit(broadcast_rows + 1).count() <= broadcast_rows
    holders = plain.join(F.broadcast(some) if few else some, "tid", "left_semi").groupBy("tid").agg(F.first("raw").alias("raw"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, parts in zip(batch.column("raw"), batch.column("list"), strict=True):
                whole, parts = whole.as_py(), parts.as_py()
                own = [whole[p["start"] : p["start"] + p["n"] + length - 1] for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[c] for p in parts], pa.int64()) for c in ("anchor", "content", "copies")] + [pa.array(own, pa.binary())],
                    ["anchor", "content", "copies", "raw"],
                )

    cut = holders.join(wanted, "tid").select("raw", "list")
    cut = cut.mapInArrow(lambda b: _batched(cut_out(b), 5_000), "anchor long, content long, copies long, raw binary")
    large = sizes.where(F.col("bytes") > SHARD_BYTES).select("anchor")
    hot = not large.isEmpty()
    usual = cut
    if hot:
        cut = cut_lineage(cut)
        large = F.broadcast(large)  # at most one in SHARD_BYTES of all bytes
        usual = cut.join(large, "anchor", "left_anti")
    found = _sorted_shards(usual.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))), length)
    if hot:
        found = found.unionByName(_counted_strings(cut.join(large, "anchor", "left_semi"), length))
    found = cut_lineage(found.where(F.size("runs") > 0).select("anchor", "content", F.explode("runs").alias("run")))
    places = shared.groupBy("tid", "start").agg(F.first("anchor").alias("anchor"), F.first("content").alias("content"))
    hits = places.join(found, ["anchor", "content"]).select(
        F.col("tid").alias("_tid"), F.struct((F.col("start") + F.col("run.first")).alias("first"), (F.col("start") + F.col("run.end") + length - 1).alias("end")).alias("span")
    )

    @F.pandas_udf(_RUNS)
    def merged(lists: pd.Series) -> pd.Series:
        return lists.map(_merge)

    spans = cut_lineage(hits.groupBy("_tid").agg(F.collect_list("span").alias("spans")).withColumn("spans", merged("spans")))
    few = spans.limit(broadcast_rows + 1).count() <= broadcast_rows and (spans.agg(F.sum(F.size("spans"))).first()[0] or 0) <= 5 * broadcast_rows
    return seen.join(F.broadcast(spans) if few else spans, "_tid", "left").drop("_tid")


def digest(text: str = "text", spans: str = "spans"):
    """``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of a text without its spans."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def made(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            rows = []
            for t, own in zip(texts, lists, strict=True):
                raw = t.encode() if t else b""
                own = [] if own is None else [(s["first"], s["end"]) for s in own]
                kept, at = hashlib.sha256(), 0
                for a, b in own:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                rows.append((len(raw), sum(b - a for a, b in own), len(own), kept.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return made(F.col(text), F.col(spans))
