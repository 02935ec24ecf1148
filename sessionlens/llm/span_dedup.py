"""Operator 3, suffix-array dedup: removes every byte covered by a span of SPAN bytes that also starts anywhere else.

A suffix array over each set of places that may share a span finds the equal spans: those of the same first SPAN bytes are
neighbours in it. suffix_array.py sorts by linear grouping, of phrases rather than bytes. What makes this a Spark job is how the places meet:

1. Equal texts are one text with a number of copies. Each window of SPAN bytes chooses, of the hashes of the KEY-byte strings
   in it, the smallest (of equal ones the last). Equal windows choose alike, so they meet under the same key. Consecutive
   windows with one choice are a place: about one every 85 bytes, a text of up to 2 * SPAN bytes, known by 128 bits of hash.
2. A count by key leaves the keys with more than one place. A place that stands in several spots gives two of them as
   witnesses. Places that follow each other in both spots are one segment; both sides of a segment are cut from the texts,
   and a suffix array over them marks the windows that repeat. All spots of the place get its marks.
3. Different places under one key are cut from the texts. Equal windows have equal cores: by where the key string lies in the
   window (to a CORES-th of the rest), the bytes around it that all such windows hold. Places that share no core with another
   place are done; the others are dealt out by key, and suffix arrays over whole keys' places mark their windows.
4. A key with more than CROWD different places (a passage that very many texts share, with other text around it) doesn't go
   to one task: the windows of its places meet by 128 bits of hash, spread over all tasks, and two witnesses of each are
   joined to segments and go through suffix arrays as in 2.
5. Each text gets its runs of marked windows, and the bytes they cover are removed at once.

So every mark comes from a suffix array, but for copies of whole texts.

Matches never cross texts; spans are judged on the input. Whole texts are read; no window is left out.

Nulls: a null text is empty; a null doc_id is carried along. Repeated rows are copies of one text: if it has SPAN bytes or
more, nothing of it is kept. Texts shorter than SPAN keep everything. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import disposable, hash128, own_columns, partitions, written
from sessionlens.llm.suffix_array import byte_suffix_array

SPAN = 200
#: Bytes of a key string: a power of two, at most SPAN / 2.
KEY = 32
CORES = 6
#: Bytes of texts that are scanned for places at a time.
SCAN = 1 << 20
#: Cuts that leave a task at a time.
CUTS = 1 << 14
#: Most different places of a key that one suffix array takes.
CROWD = 1024
#: Places are sorted in suffix arrays of about this many bytes, whole keys each; small arrays stay in the cache.
ARRAY_BYTES = 1 << 14
#: A segment starts anew where its first side passes a multiple of 2 to this.
SEGMENT_BITS = 12

#: DuckDB SQL for the digest with spans of 200 bytes, over the texts' bytes in hexadecimal, 256 windows of a text at a time.
SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT rid, o, substr(h, 2 * o + 1, 910) AS h FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 199, 256)) AS o FROM d)),
w AS (SELECT rid, o + q AS p, md5_number(substr(h, 2 * q + 1, 400)) AS g FROM (SELECT rid, o, h, unnest(range(0, len(h) // 2 - 199)) AS q FROM part)),
again AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
hit AS (SELECT rid, p, p > coalesce(lag(p) OVER (PARTITION BY rid ORDER BY p) + 200, -1) AS opens FROM w WHERE g IN (SELECT g FROM again)),
run AS (SELECT rid, min(p) AS lo, max(p) + 200 AS hi FROM (SELECT rid, p, sum(CAST(opens AS INT)) OVER (PARTITION BY rid ORDER BY p) AS k FROM hit) GROUP BY rid, k),
gap AS (SELECT rid, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS since FROM run),
cut AS (SELECT gap.rid, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS upto, string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept FROM gap JOIN d ON d.rid = gap.rid GROUP BY gap.rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON d.rid = cut.rid
"""

U = np.uint64
_POSITION_BITS = 28
_rng = np.random.default_rng(20240131)
_BYTE = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1) for _ in range(3)]
_BASE = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F]
_INVERSE = [pow(b, -1, 1 << 64) for b in _BASE]


class Powers:
    """Powers of the two place-hash bases and their inverses, as far as a slice needs."""

    def __init__(self) -> None:
        self.size = 0

    def upto(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 1 << 21)
            self.up = [tv._powers(self.size, b) for b in _BASE[1:]]
            self.down = [tv._powers(self.size, b) for b in _INVERSE[1:]]


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive bytes; size is a power of two."""
    h, have = _BYTE[0][data], 1
    while have < size:
        h = h[:-have] * U(pow(_BASE[0], have, 1 << 64)) + h[have:]
        have *= 2
    return tv.mix(h)


def places(data: np.ndarray, offsets: np.ndarray, span: int, key: int, powers: Powers) -> dict[str, np.ndarray]:
    """Places of one slice of texts: doc, key, c1, c2 (hash of the place), first (window in its text), windows and at (of the key string)."""
    none = {"doc": np.zeros(0, np.int64), "key": np.zeros(0, U), "c1": np.zeros(0, U), "c2": np.zeros(0, U), "first": np.zeros(0, np.int64), "windows": np.zeros(0, np.int64), "at": np.zeros(0, np.int64)}
    n = len(data)
    if n < span:
        return none
    h = string_hashes(data, key)
    size = np.diff(offsets)
    inside = np.arange(n) - np.repeat(offsets[:-1], size)
    mask = U((1 << _POSITION_BITS) - 1)
    ranked = (h & ~mask) | (mask - (inside[: len(h)].astype(U) & mask))
    low = tv.sliding_min(ranked, span - key + 1)
    left = np.repeat(offsets[1:], size)[: len(low)] - np.arange(len(low))
    valid = left >= span
    change = np.ones(len(low), bool)
    change[1:] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1]) | (inside[1 : len(low)] == 0)
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(low))
    ok = valid[start]
    start, end = start[ok], end[ok]
    if not len(start):
        return none
    doc = np.searchsorted(offsets, start, "right") - 1
    at = offsets[doc] + _position(low[start], mask, inside[start])
    powers.upto(n)
    upto = end - 1 + span
    hashes = []
    for j in (1, 2):
        total = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[j][data] * powers.up[j - 1][:n])])
        hashes.append(tv.mix((total[upto] - total[start]) * powers.down[j - 1][start] + (end - start).astype(U)))
    return {"doc": doc, "key": h[at], "c1": hashes[0], "c2": hashes[1], "first": start - offsets[doc], "windows": end - start, "at": at - start}


def pieces(column: pa.Array, span: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Slices of rows, as first row, row after the last, first byte, bytes, offsets; a long row comes in pieces of SCAN windows.

    Pieces end places early, which changes nothing: every window is in one place, and places of one key meet anyway.
    """
    for lo, hi, data, offsets in tv.slices(column, SCAN):
        if hi - lo > 1 or len(data) < SCAN + span:
            yield lo, hi, 0, data, offsets
            continue
        for at in range(0, len(data) - span + 1, SCAN):
            part = data[at : at + SCAN + span - 1]
            yield lo, hi, at, part, np.array([0, len(part)])


def _position(low: np.ndarray, mask: np.uint64, first: np.ndarray) -> np.ndarray:
    """Where in its text the chosen string starts: at or after the window's first byte."""
    at = (mask - (low & mask)).astype(np.int64)
    turn = 1 << _POSITION_BITS
    return at + ((first - at + turn - 1) // turn) * turn


def repeated_windows(cut: list[bytes], windows: list[int], span: int) -> list[np.ndarray]:
    """For each place, which of its windows (of span bytes) also start elsewhere in these places."""
    sizes = np.array([len(c) + 1 for c in cut])
    offsets = np.cumsum(sizes) - sizes
    joined = b"\x00".join(cut) + b"\x00"  # a separator below the bytes, which go up by one
    symbols = np.frombuffer(joined, np.uint8).astype(np.int64) + 1
    symbols[offsets + sizes - 1] = 0
    counts = np.array(windows)
    is_window = np.zeros(len(symbols), bool)
    is_window[np.repeat(offsets, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    order = byte_suffix_array(symbols)
    order = order[is_window[order]]
    # Suffixes that share their first span bytes are neighbours.
    view = np.ndarray((len(joined) - span + 1,), f"V{span}", joined, strides=(1,))
    word = next(w for w in (8, 4, 2, 1) if span % w == 0)
    marked = np.zeros(len(symbols), bool)
    for lo in range(0, len(order) - 1, 1 << 14):
        a, b = order[lo : lo + (1 << 14)][: len(order) - 1 - lo], order[lo + 1 : lo + 1 + (1 << 14)]
        same = (view[a].view(f"u{word}") == view[b].view(f"u{word}")).reshape(len(a), -1).all(1)
        marked[a[same]] = True
        marked[b[same]] = True
    return [marked[o : o + w] for o, w in zip(offsets.tolist(), windows, strict=True)]


def _runs(marks: np.ndarray) -> list[int]:
    """first, last, first, last, ... of the runs of marked windows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    edge[1::2] -= 1
    return edge.tolist()


def _find_places(span: int, key: int) -> Callable:
    """tid, copies, text -> tid, copies, key, c1, c2, first, shape (windows, and where the key string is: 16 bits each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for lo, hi, first, data, offsets in pieces(batch.column("text"), span):
                p = places(data, offsets, span, key, powers)
                p["first"] += first
                rows = pa.array(p["doc"])
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [own.column("tid").take(rows), own.column("copies").take(rows), *(pa.array(tv.signed(p[c])) for c in ("key", "c1", "c2")), pa.array(p["first"].astype(np.int32)), pa.array((p["windows"] << 16 | p["at"]).astype(np.int32))],
                    ["tid", "copies", "key", "c1", "c2", "first", "shape"],
                )

    return run


#: What a cut is for: a segment (sid, members on its first side) or a place under a key.
_FOR = "sid long, key long, c1 long, c2 long, shape int, total long, members array<struct<at: int, key: long, c1: long, c2: long, windows: int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, cuts (structs of first, bytes and what they are for) -> what they are for, cut (bytes)."""
    names = ["sid", "key", "c1", "c2", "shape", "total", "members"]
    for batch in batches:
        for text, cuts in zip(batch.column("text"), batch.column("cuts"), strict=True):
            data, rows = text.as_buffer().to_pybytes(), cuts.values
            for lo in range(0, len(rows), CUTS):
                part = rows.slice(lo, CUTS)
                own = dict(zip((f.name for f in part.type), part.flatten(), strict=True))
                cut = [data[first : first + size] for first, size in zip(own["first"].to_pylist(), own["bytes"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(own[c] for c in names), pa.array(cut, pa.binary())], [*names, "cut"])


def _in_arrays(name: str, array_bytes: int, marked: Callable[[list[dict]], list[tuple]]) -> Callable:
    """Rows sorted by the column `name` -> key, c1, c2, runs (of marked windows): arrays of whole values of it, about array_bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row[name] != last and size >= array_bytes:
                    yield _marked(marked(held))
                    held, size = [], 0
                last = row[name]
                held.append(row)
                size += len(row["cut"])
        if held:
            yield _marked(marked(held))

    return run


def _sort_places(span: int, array_bytes: int) -> Callable:
    """Places by key -> key, c1, c2, runs: only of places that stand once, and only those with marks."""

    def marked(held: list[dict]) -> list[tuple]:
        # Where every place of a key stands more than once, nothing is left to find.
        open_keys = {r["key"] for r in held if r["total"] == 1}
        left = [r for r in held if r["key"] in open_keys]
        marks = repeated_windows([r["cut"] for r in left], [r["windows"] for r in left], span) if left else []
        return [(r["key"], r["c1"], r["c2"], _runs(m)) for r, m in zip(left, marks, strict=True) if r["total"] == 1 and m.any()]

    return _in_arrays("key", array_bytes, marked)


def _sort_segments(span: int, array_bytes: int) -> Callable:
    """Sides of segments by sid -> key, c1, c2, runs of their members, where they have marks."""

    def marked(held: list[dict]) -> list[tuple]:
        marks = repeated_windows([r["cut"] for r in held], [len(r["cut"]) - span + 1 for r in held], span)
        out = []
        for r, m in zip(held, marks, strict=True):
            at = 0
            for x in r["members"] or ():
                own = m[at : at + x["windows"]]
                at += x["windows"]
                if own.any():
                    out.append((x["key"], x["c1"], x["c2"], _runs(own)))
        return out

    return _in_arrays("sid", array_bytes, marked)


def _marked(rows: list[tuple]) -> pa.RecordBatch:
    key, c1, c2, runs = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(runs, pa.list_(pa.int32()))], ["key", "c1", "c2", "runs"])


def _segments(pairs: DataFrame, span: int) -> DataFrame:
    """src, cut (a request for _cut): both sides of each segment, from pairs of key, c1, c2, windows, a, b (structs of src, at).

    Pairs of two sources at one distance whose windows follow each other are a segment.
    """
    line = ["a_src", "b_src", "off", "block"]
    own = pairs.select("key", "c1", "c2", "windows", F.col("a.src").alias("a_src"), F.col("a.at").alias("at"), F.col("b.src").alias("b_src"), (F.col("b.at") - F.col("a.at")).alias("off"))
    own = own.withColumn("block", F.shiftright("at", SEGMENT_BITS))
    before = F.coalesce(F.sum("windows").over(Window.partitionBy(*line).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    members = F.array_sort(F.collect_list(F.struct("at", "key", "c1", "c2", "windows")))
    found = own.withColumn("gap", F.col("at") - before).groupBy(*line, "gap").agg(F.min("at").alias("first"), F.sum("windows").alias("n"), members.alias("members"))
    sid, none = F.xxhash64(*line, "gap"), F.lit(None)
    side = lambda src, first, own: F.struct(F.col(src).alias("src"), _request(first, F.col("n") - 1 + span, sid, *[none] * 5, own).alias("cut"))
    sides = F.array(side("a_src", F.col("first"), F.col("members")), side("b_src", F.col("first") + F.col("off"), none))
    return found.select(F.explode(sides).alias("side")).select("side.src", "side.cut")


def _request(first: Column, size: Column, *what: Column) -> Column:
    named = zip(what, StructType.fromDDL(_FOR), strict=True)
    return F.struct(first.cast("int").alias("first"), size.cast("int").alias("bytes"), *[c.cast(f.dataType).alias(f.name) for c, f in named])


def _cuts(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """What the requests (src, cut) are for, and the bytes, from texts (src, text); each text is read once."""
    asked = requests.groupBy("src").agg(F.collect_list("cut").alias("cuts"))
    return texts.join(asked, "src").select("text", "cuts").mapInArrow(_cut, f"{_FOR}, cut binary")


def _explode_windows(span: int) -> Callable:
    """Places -> key, c1, c2, src, w (window), h1, h2 (its hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        powers.upto(4 * span)
        for batch in batches:
            sizes = np.array(batch.column("windows").to_pylist(), np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            hashes: list[list[np.ndarray]] = [[np.zeros(0, U)], [np.zeros(0, U)]]
            for cut, w in zip(batch.column("cut").to_pylist(), sizes.tolist(), strict=True):
                data = np.frombuffer(cut, np.uint8)
                for j in (1, 2):
                    total = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[j][data] * powers.up[j - 1][: len(data)])])
                    hashes[j - 1].append(tv.mix((total[span : span + w] - total[:w]) * powers.down[j - 1][:w]))
            at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("key", "c1", "c2", "src")), pa.array(at.astype(np.int32)), *(pa.array(tv.signed(np.concatenate(h))) for h in hashes)], ["key", "c1", "c2", "src", "w", "h1", "h2"]
            )

    return run


def _windows_to_runs(windows: DataFrame) -> DataFrame:
    """key, c1, c2, w -> key, c1, c2, runs; a place has at most SPAN windows."""
    w = F.sort_array(F.collect_set("w"))
    # A run starts at each window whose predecessor is missing and ends at each whose successor is.
    starts = F.filter("ws", lambda x: ~F.array_contains("ws", x - 1))
    ends = F.filter("ws", lambda x: ~F.array_contains("ws", x + 1))
    pairs = F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b)))
    return windows.groupBy("key", "c1", "c2").agg(w.alias("ws")).select("key", "c1", "c2", pairs.alias("runs"))


def _remove(span: int) -> Callable:
    """t, copies, text, spans (structs of lo, hi) -> t, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, copies, text, spans in zip(batch.column("t").to_pylist(), batch.column("copies").to_pylist(), batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                if copies > 1 and len(data) >= span:
                    gone = [(0, len(data))]
                else:
                    gone = merged((s["lo"], s["hi"]) for s in spans or ())
                kept, at = sha256(), 0
                for lo, hi in gone:
                    kept.update(data[at:lo])
                    at = hi
                kept.update(data[at:])
                out.append((t, len(data), sum(hi - lo for lo, hi in gone), len(gone), kept.hexdigest()))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            cols = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["t", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def merged(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs of bytes that half-open spans cover."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def repeated_spans(texts: DataFrame, span: int = SPAN, key: int = KEY, crowd: int = CROWD) -> DataFrame:
    """tid, spans (structs of lo, hi: bytes covered by repeated windows), from tid (unique), copies and text."""
    spark = texts.sparkSession
    n = partitions(spark)
    place = ["key", "c1", "c2"]
    found = "tid long, copies long, key long, c1 long, c2 long, first int, shape int"
    windows = F.shiftright("shape", 16)
    everywhere = written(texts.where(F.octet_length("text") >= span).select("tid", "copies", "text").mapInArrow(_find_places(span, key), found), "places")
    keys = written(everywhere.groupBy("key").agg(F.sum("copies").alias("n"), F.min("c1").alias("low"), F.max("c1").alias("high")).where("n > 1").select("key", (F.col("low") != F.col("high")).alias("mixed")), "keys")
    met = written(everywhere.join(keys, "key"), "met")

    spot = F.struct(F.col("tid").alias("src"), F.col("first").alias("at"))
    different = met.groupBy(*place, "mixed", "shape").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("spots"), F.min(spot).alias("a"), F.max(spot).alias("b"))
    different = written(different.withColumn("windows", windows), "different")
    none = F.lit(None)
    single = different.where("mixed").select(F.col("a.src").alias("src"), _request(F.col("a.at"), F.col("windows") - 1 + span, none, *[F.col(c) for c in (*place, "shape", "total")], none).alias("cut"))
    cut = written(_cuts(texts.select(F.col("tid").alias("src"), "text"), single.unionByName(_segments(different.where("spots > 1"), span))), "cut")
    marked = "key long, c1 long, c2 long, runs array<int>"

    def witnessed(sides: DataFrame) -> DataFrame:
        return sides.select("sid", "members", "cut").repartition(n, "sid").sortWithinPartitions("sid").mapInArrow(_sort_segments(span, ARRAY_BYTES), marked)

    under_keys = cut.where("sid IS NULL").withColumn("windows", windows)
    sharing = written(under_keys.join(_sharing(under_keys, span, key), place, "left_semi").select(*place, "total", "windows", "cut"), "sharing")
    crowded = written(sharing.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("key"), "crowded")
    sorted_places = sharing.join(crowded, "key", "left_anti").repartition(n, "key").sortWithinPartitions("key").mapInArrow(_sort_places(span, ARRAY_BYTES), marked)

    crowds = written(sharing.join(crowded, "key", "left_semi").withColumn("src", F.monotonically_increasing_id()), "crowds")
    many = written(crowds.mapInArrow(_explode_windows(span), "key long, c1 long, c2 long, src long, w int, h1 long, h2 long"), "windows")
    spot = F.struct("src", F.col("w").alias("at"))
    again = many.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("a"), F.max(spot).alias("b")).where("n > 1")
    again = again.select(F.col("h1").alias("key"), F.col("h2").alias("c1"), F.lit(0).cast("long").alias("c2"), F.lit(1).alias("windows"), "a", "b")
    again = written(witnessed(_cuts(crowds.select("src", F.col("cut").alias("text")), _segments(again, span))), "again")
    of_crowds = _windows_to_runs(many.join(again.select(F.col("key").alias("h1"), F.col("c1").alias("h2")), ["h1", "h2"]).select(*place, "w"))

    runs = written(witnessed(cut.where("sid IS NOT NULL")).unionByName(sorted_places).unionByName(of_crowds), "runs")
    pair = F.explode(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)))
    hits = met.select("tid", "first", *place).join(runs, place).select("tid", "first", "runs", pair.alias("k"))
    cover = F.struct((F.col("first") + F.get("runs", F.col("k"))).alias("lo"), (F.col("first") + F.get("runs", F.col("k") + 1) + span).alias("hi"))
    return written(hits.groupBy("tid").agg(F.collect_list(cover).alias("spans")), "spans")


def _sharing(cut: DataFrame, span: int, key: int) -> DataFrame:
    """key, c1, c2 of the places that share a core of their windows with another place."""
    place, at, last = ["key", "c1", "c2"], F.col("shape").bitwiseAND(0xFFFF), F.col("windows") - 1
    rest = span - key
    step, cores = rest // CORES, []
    for g in range(CORES):
        # The key string lies from `low` to `high` bytes into these windows.
        low, high = g * step, rest if g == CORES - 1 else (g + 1) * step
        some = (at >= low) & (at - last <= high)
        cores.append(F.when(some, F.xxhash64(F.lit(g), F.col("cut").substr(at - low + 1, F.lit(low + key + rest - high)))))
    sides = written(cut.select(*place, F.explode(F.array(*cores)).alias("side")).where("side IS NOT NULL"), "sides")
    again = written(sides.groupBy("key", "side").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "side"), "sides-again")
    return written(sides.join(again, ["key", "side"], "left_semi").select(*place).distinct(), "sharing-places")


def dedup_spans(documents: DataFrame, span: int = SPAN, key: int = KEY, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    with disposable(documents.sparkSession) as keep:
        docs, found = _judged_texts(documents, span, key, crowd)
        keep(found)
    return docs.select("doc_id", "t").join(found, "t").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _judged_texts(documents: DataFrame, span: int, key: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t, text of every document; the result by t, written)."""
    docs = own_columns(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("t", hash128(F.col("text")))
    texts = docs.groupBy("t").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    texts = written(texts.withColumn("tid", F.monotonically_increasing_id()), "texts")
    spans = repeated_spans(texts, span, key, crowd)
    found = texts.join(spans, "tid", "left").select("t", "copies", "text", "spans")
    return docs, written(found.mapInArrow(_remove(span), "t binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "removed")
