"""Line dedup: maximal repeated runs of lines, found by a suffix array over line ids; later copies are deleted.

Every text is a sequence of lines.  A run of consecutive lines is repeated if the same lines stand, in a row, at an
earlier place; places are ordered by doc_id, then line.  A maximal repeated run of at least ``MIN_CHARS`` characters
is deleted, so a line goes if and only if it lies in such a run; short lines go with the run around them only.

1. Lines are hashed to 128 bits and counted; only lines that occur twice can lie in a repeated run.  Consecutive ones
   in a document form a segment, and equal segments are collapsed to their first place, copies of any number included.
2. The suffixes of the distinct segments are ordered by distributed prefix doubling: a suffix's label at depth 2d is
   the place of its pair (label at depth d, label d lines further) in the sorted distinct pairs.  Labels keep the
   order of the suffixes; suffixes with one label form a longest-common-prefix interval of at least that depth.
3. A line of a repeated run of enough characters lies in the shortest long-enough window that begins or that ends at
   some line of the run.  Each such window is named by the interval labels of its first and its last 2^j lines; the
   first place of each name stays, all others are deleted.  Doubling stops at the depth of the longest such window,
   because deeper intervals delete nothing more.

DataFrame functions only.  Shuffles carry hashes, never texts, but for the last join, which brings each document the
places that it loses.  A hot line, segment or pair is counted by partial aggregation, and the counts are written before
they are joined, so that Spark can split the join's partitions.

Defined results: a null text stays null and an empty one empty; rows with one doc_id and one text are one document,
repeated, and get one result; rows with one doc_id and different texts come in the order of a hash of the text; a null
doc_id comes first; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.session import Scratch

MIN_CHARS = 20


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line: its place (doc, text hash ``t``, line ``n``), its identity (``a``, ``b``) and its length."""
    line = F.col("line")
    body = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).where(
        "text is not null")
    return body.select("doc", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("n", "line")) \
        .select("doc", "t", "n", F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
                F.length(line).alias("chars"))


def _segments(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Maximal rows of consecutive repeated lines of a document: place, first line ``n0``, ``body``, ``total`` length."""
    # a written table is joined by an exchange of the join's own, whose large partitions Spark splits
    repeated = scratch.keep(lines.groupBy("a", "b").agg(F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    inside = lines.join(repeated, ["a", "b"])
    by_doc = Window.partitionBy("doc", "t").orderBy("n")
    # a document that is repeated as a row has every line more than once
    placed = inside.withColumn("back", F.lag("n").over(by_doc)).where("back is null or back < n")
    island = placed.withColumn("n0", F.col("n") - F.row_number().over(by_doc))
    parts = island.groupBy("doc", "t", "n0").agg(F.sort_array(F.collect_list(F.struct("n", "a", "b", "chars"))).alias("body"))
    return parts.select("doc", "t", F.col("body")[0]["n"].alias("n0"), F.transform(
        "body", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["chars"].alias("chars"))).alias("body"),
        F.aggregate("body", F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("total"),
        F.xxhash64("body.a").alias("s1"), F.xxhash64("body.b", F.lit(1)).alias("s2"))


def _labels(rows: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``label``: numbers in the order of the distinct keys, made by a distributed sort."""
    order = scratch.keep(rows.select(*keys).distinct().orderBy(*keys).withColumn(
        "label", F.monotonically_increasing_id()))
    return rows.join(order, keys)


def removed_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 scratch: Scratch | None = None) -> DataFrame:
    """``doc, t, runs``: for each document that loses lines the runs (first line, end) in order, not overlapping."""
    scratch = scratch or Scratch(docs.sparkSession)
    place = ["doc", "t", "n0"]
    segments = scratch.keep(_segments(_lines(docs, key, text), scratch).where(F.col("total") >= min_chars))
    first = scratch.keep(segments.groupBy("s1", "s2").agg(F.min(F.struct(*place, "body", "total")).alias("f"))
                         .select("s1", "s2", "f.*"))
    whole = segments.join(first.select("s1", "s2", *[F.col(c).alias(f"f_{c}") for c in place]), ["s1", "s2"]).where(
        ~(F.col("doc").eqNullSafe(F.col("f_doc")) & (F.col("t") == F.col("f_t")) & (F.col("n0") == F.col("f_n0")))
    ).select("doc", "t", F.col("n0").alias("start"), (F.col("n0") + F.size("body")).alias("end"))

    # lines of the distinct segments, and a row behind the last; c: characters before the line
    rows = first.select("s1", "s2", *place, F.size("body").alias("m"), "total", F.posexplode(
        F.concat("body", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                                          F.lit(0).alias("chars"))))).alias("i", "x")).select(
        "s1", "s2", *place, "m", "total", "i", "x.*")
    in_segment = Window.partitionBy("s1", "s2").orderBy("i")
    by_chars = Window.partitionBy("s1", "s2").orderBy("c")
    rows = rows.withColumn("c", F.sum(F.col("chars").cast("long")).over(in_segment) - F.col("chars"))
    rows = rows.withColumns({
        "e": F.count("*").over(by_chars.rangeBetween(Window.unboundedPreceding, min_chars - 1)).cast("int"),
        "s": F.count("*").over(by_chars.rangeBetween(Window.unboundedPreceding, -min_chars)).cast("int") - 1})
    rows = scratch.keep(rows)
    ends = F.col("total") >= F.col("c") + min_chars  # else no window that begins here is long enough
    windows = scratch.keep(rows.where((F.col("i") < F.col("m")) & ends).select(
        "s1", "s2", *place, F.col("i").alias("start"), F.least("e", "m").alias("end")).unionByName(
        rows.where("s >= 0").select("s1", "s2", *place, F.col("s").alias("start"), F.col("i").alias("end"))).distinct()
        .withColumn("level", F.floor(F.log2(F.col("end") - F.col("start"))).cast("int")))
    deepest = windows.agg(F.max("level")).first()[0]

    found = whole
    labels = _labels(rows.where(F.col("i") < F.col("m")).select("s1", "s2", "i", "a", "b"), ["a", "b"], scratch) \
        .select("s1", "s2", "i", "label")
    for level in range(0 if deepest is None else deepest + 1):
        depth = 1 << level
        if level:
            ahead = F.coalesce(F.lead("label", depth // 2).over(in_segment), F.lit(-1))
            labels = _labels(labels.select("s1", "s2", "i", F.col("label").alias("p"), ahead.alias("q")), ["p", "q"],
                             scratch).select("s1", "s2", "i", "label")
        labels = scratch.keep(labels)
        here = windows.where(F.col("level") == level).join(
            labels.select("s1", "s2", F.col("i").alias("start"), F.col("label").alias("head")), ["s1", "s2", "start"]
        ).withColumn("rest", F.col("end") - depth).join(
            labels.select("s1", "s2", F.col("i").alias("rest"), F.col("label").alias("tail")), ["s1", "s2", "rest"])
        named = here.select(*place, "start", "end", "head", "tail", (F.col("end") - F.col("start")).alias("len"),
                            F.struct("doc", "t", (F.col("n0") + F.col("start")).alias("n")).alias("at"))
        name = ["head", "tail", "len"]
        earliest = scratch.keep(named.groupBy(*name).agg(
            F.min("at").alias("kept"), F.count("*").alias("copies")).where("copies > 1"))
        later = named.join(earliest, name).where(~F.col("at").eqNullSafe(F.col("kept")))
        found = found.unionByName(later.select("doc", "t", (F.col("n0") + F.col("start")).alias("start"),
                                               (F.col("n0") + F.col("end")).alias("end")))

    # union of the windows of a document
    by_start = Window.partitionBy("doc", "t").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    runs = marked.withColumn("run", F.sum("new").over(by_start)).groupBy("doc", "t", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("doc", "t").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows of ``docs`` with the text freed of later copies, then ``n_lines``, ``n_removed`` and ``runs``.

    The columns of ``docs`` come first, in their order, and the three results behind them.
    """
    scratch = Scratch(docs.sparkSession)
    runs = scratch.keep(removed_runs(docs, key, text, min_chars, scratch))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    k, x = names[docs.columns.index(key)], names[docs.columns.index(text)]
    both = rows.withColumn("_t", F.xxhash64(F.col(x).cast("string"))).join(
        runs, F.col(k).eqNullSafe(F.col("doc")) & (F.col("_t") == F.col("t")), "left")
    lines = F.split(F.col(x).cast("string"), "\n")
    kept = F.filter(lines, lambda line, i: ~F.exists("runs", lambda r: (r["start"] <= i) & (i < r["end"])))
    text_now = F.when(F.col("runs").isNull(), F.col(x)).otherwise(F.array_join(kept, "\n"))
    lost = F.aggregate("runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])
    none = F.array().cast("array<struct<start: int, end: int>>")
    return both.select(*[text_now if c == x else F.col(c) for c in names],
                       F.when(F.col(x).isNull(), 0).otherwise(F.size(lines)).cast("long"),
                       F.coalesce(lost, F.lit(0)).cast("long"), F.coalesce("runs", none)).toDF(
        *docs.columns, "n_lines", "n_removed", "runs")
