"""Operator 8, line dedup: which lines repeat across documents, as compressed keep bitmaps; DataFrame functions only.

A line's key is the line without ASCII white space at both ends, A-Z in lower case; keys are compared by 128 bits of
hash. Rows of (key hash, text hash, position) are range-partitioned by key hash and sorted by text and position within;
windows over that order stream each key's first occurrence in every text. Hashes are even, so the ranges are equal parts
of their values and no sample has to be taken first. A text's own hash moves its keys on by as many ranges as there are, so
a line that a third of all documents share spreads over all of them; what they found is added up a key afterwards.
Two rules use it:

* `drop`: keys found in at least min_docs documents lose all their lines in every document;
* `first`: only a key's first occurrence stays (equal texts count as one document here).

The result is, per document, its runs of kept lines: a run-length-coded bitmap of (first line from 0, lines). No text
moves to find it; texts meet their bitmaps in one join on the text's hash. Keys of no code points are never dropped.

Nulls: a null text counts as empty, one empty line; a null doc_id is carried along. Repeated rows are documents of their
own: they count for min_docs. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import ascii_lower, disposable, own_columns, partitions, written

BLANK = " \t\n\x0b\f\r"
#: DuckDB SQL for the `drop` rule with min_docs 10.
SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT rid, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.rid, k.pos, k.line, f.key IS NOT NULL AS dropped FROM k LEFT JOIN f ON k.key = f.key),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS kept FROM m GROUP BY rid)
SELECT d.doc_id, g.n_lines, g.n_dropped, sha256(g.kept) AS kept_sha256 FROM d JOIN g ON d.rid = g.rid
"""


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)))


def _text_hash(text: Column) -> tuple[Column, Column]:
    data = F.coalesce(text, F.lit(""))
    return F.xxhash64(data).alias("t1"), F.xxhash64(F.lit(1), data).alias("t2")


def key_occurrences(documents: DataFrame, min_chars: int = 1) -> DataFrame:
    """h1, h2 (key), t1, t2 (text), pos, starts: a row for each line with a key; starts: the key's first line in its document.

    Written range-partitioned by key and sorted by text and position within a key.
    """
    docs = documents.select(*_text_hash(F.col("text")), line_keys(F.col("text")).alias("keys"))
    # A text always has a line. The outer form keeps Catalyst from splitting every text a second time to filter on that.
    rows = docs.select("t1", "t2", F.posexplode_outer("keys").alias("pos", "key")).where(F.length("key") >= min_chars)
    rows = rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "t1", "t2", "pos")
    n = partitions(documents.sparkSession)
    part = lambda h: F.shiftright(F.shiftrightunsigned(h, 33) * n, 31)  # noqa: E731  0 to n - 1 by the hash's top bits
    ranged = rows.withColumn("range", ((part("h1") + part("t1")) % n).cast("int")).repartitionById(n, "range")
    # The partitioning serves this window as it is. Copies of a text tie, so each counts once for its key.
    order = Window.partitionBy("range", "h1", "h2", "t1", "t2").orderBy("pos")
    return written(ranged.select("h1", "h2", "t1", "t2", "pos", (F.rank().over(order) == 1).alias("starts")), "lines")


def dropped_lines(occurrences: DataFrame, min_docs: int = 10, rule: str = "drop") -> DataFrame:
    """t1, t2, dropped: for each text that loses lines, their sorted positions."""
    place = F.struct("t1", "t2", "pos")
    stats = occurrences.groupBy("h1", "h2").agg(F.sum(F.col("starts").cast("long")).alias("docs"), F.min(place).alias("first"))
    if rule == "drop":
        stats = written(stats.where(F.col("docs") >= min_docs).select("h1", "h2"), "frequent")
        gone = occurrences.join(stats, ["h1", "h2"])
    elif rule == "first":
        # A key that stands in one place only has nothing to lose; copies of that place stand in it too.
        more = occurrences.groupBy("h1", "h2").agg(F.max(place).alias("last"), F.min(place).alias("first"))
        stats = written(more.where(F.col("first") != F.col("last")).select("h1", "h2", "first"), "repeated")
        gone = occurrences.join(stats, ["h1", "h2"]).where(place != F.col("first"))
    else:
        raise ValueError(f"no such rule: {rule}")
    return written(gone.groupBy("t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "dropped")


def keep_runs(n_lines: Column, dropped: Column) -> Column:
    """The runs of kept lines as (first line from 0, lines), given the sorted positions that go."""
    after = lambda i: F.coalesce(F.get(dropped, i), n_lines)
    before = lambda i: F.coalesce(F.get(dropped, i - 1), F.lit(-1))
    runs = F.transform(F.sequence(F.lit(0), F.size(dropped)), lambda i: F.struct((before(i) + 1).alias("first"), (after(i) - before(i) - 1).alias("lines")))
    return F.filter(runs, lambda r: r["lines"] > 0)


def line_bitmaps(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, rule: str = "drop") -> DataFrame:
    """doc_id, text, n_lines, n_dropped and keep (runs of kept lines) of every document."""
    docs = own_columns(documents, "doc_id", "text")
    with disposable(documents.sparkSession) as keep:
        dropped = dropped_lines(key_occurrences(docs, min_chars), min_docs, rule)
        keep(dropped)
    text = docs.select("*", *_text_hash(F.col("text")))
    met = text.join(dropped, ["t1", "t2"], "left")
    none = F.array().cast("array<int>")
    met = met.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))).withColumn("dropped", F.coalesce("dropped", none))
    return met.select("doc_id", "text", F.col("n_lines").cast("long"), F.size("dropped").cast("long").alias("n_dropped"), keep_runs(F.col("n_lines"), F.col("dropped")).alias("keep"))


def apply_bitmap(text: Column, keep: Column) -> Column:
    """The kept lines of a text, joined by line feeds."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["first"] + 1, r["lines"]))), "\n")


def dedup_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document under the `drop` rule."""
    marked = line_bitmaps(documents, min_docs, min_chars)
    kept = apply_bitmap(F.col("text"), F.col("keep"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))
