"""Line dedup by winnowing over line hashes, with DataFrame functions only.

Method: a text's lines are hashed, and every ``gram`` lines in a row have one hash. Of every ``window``
consecutive gram hashes the least (the last of equal ones) is selected as a fingerprint, so two texts
that share ``gram + window - 1`` lines in a row select the same fingerprint there. A fingerprint is joined with the
first place in the order (document id, row, line) of itself and of each longer piece around it: with 1 to ``window - 1`` lines
before it, or behind it. So a match is extended both ways at the best earlier place, whichever document holds it, and
beyond the next fingerprint carries on. The lines of every run found at an earlier place are deleted from the later one:
with ``window <= gram`` a line of a repeated run of ``gram + window - 1`` lines always goes. A window of one, the
default, selects every gram: then exactly the repeated runs of ``gram`` lines or more go.

The first place of a run in the order is never deleted: a line goes only where equal lines stand earlier.

Scale: a fingerprint and its extensions are rows of two hashes and a place. First places are minima, combined before
the shuffle: a run that a third of all documents hold is one row per task there, and joins back by a plain equi-join whose hot
keys AQE splits. Pairs of documents are never formed. Texts are written once with a row number and meet the
numbers of their deleted lines in one join.

Edge cases: a null text stays null; an empty text has one line; texts of fewer than ``gram`` lines are left
alone; lines without a word character match only inside a run; equal lines are compared without outer
spaces; of repeated rows the first read stays; a null id comes before all others; an empty table gives an
empty result; other columns pass through unless named like the results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm.storage import written


def hashed_lines(text: Column) -> Column:
    """(hash, wordy) of every line; wordy lines have a word character."""
    return F.transform(F.split(text, "\n"), lambda line: F.struct(
        F.xxhash64(F.trim(line)).alias("hash"), line.rlike(r"\w").alias("wordy")))


def gram_hashes(lines: Column, gram: int) -> Column:
    """The hash of every ``gram`` lines in a row; null where none of the lines has a word character."""
    count = F.size(lines) - gram + 1

    def one(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(gram)]
        return F.when(reduce(Column.__or__, [p["wordy"] for p in part]), F.xxhash64(*[p["hash"] for p in part]))

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast("array<bigint>"))


def selected(grams: Column, window: int) -> Column:
    """Positions of the minima of all windows, each once; fewer grams than a window are one window."""
    def least(start: Column) -> Column:
        low = F.array_min(F.slice(grams, start + 1, window))
        return F.array_max(F.transform(F.slice(grams, start + 1, window), lambda g, i: F.when(g == low, start + i)))

    starts = F.sequence(F.lit(0), F.greatest(F.size(grams) - window, F.lit(0)))
    if window == 1:
        return F.filter(starts, lambda p: F.get(grams, p).isNotNull())
    return F.filter(F.array_distinct(F.transform(starts, least)), lambda p: p.isNotNull())


def pieces(gram: int, window: int) -> Column:
    """The fingerprint at ``pos`` and its extensions inside the text: (a, b: hashes of the lines; start, end)."""
    def piece(before: int, behind: int) -> Column:
        hashes = [F.get("lines", F.col("pos") + k)["hash"] for k in range(-before, gram + behind)]
        inside = (F.col("pos") >= before) & (F.col("pos") + (gram + behind) <= F.size("lines"))
        return F.when(inside, F.struct(
            (hashes[0] if len(hashes) == 2 else F.xxhash64(F.lit(before), *hashes)).alias("a"),
            (hashes[1] if len(hashes) == 2 else F.xxhash64(F.lit(-1 - before), *hashes)).alias("b"),
            (F.col("pos") - before).alias("start"), (F.col("pos") + (gram - 1 + behind)).alias("end")))

    around = [piece(0, 0)] + [piece(*p) for k in range(1, window) for p in ((k, 0), (0, k))]
    return F.filter(F.array(*around), lambda p: p.isNotNull())


def deletions(rows: DataFrame, gram: int, window: int) -> DataFrame:
    """(row, lines): the numbers of the lines to delete, of the rows (row, doc_id, text) that have any."""
    lines = rows.filter("text IS NOT NULL").select("row", "doc_id", hashed_lines(F.col("text")).alias("lines"))
    prints = lines.select("row", "doc_id", "lines", F.explode(selected(gram_hashes(F.col("lines"), gram), window)).alias("pos"))
    prints = written(prints.select("row", "doc_id", F.inline(pieces(gram, window))), "line-prints")
    first = (prints.groupBy("a", "b").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.count(F.lit(1)).alias("places"))
             .filter("places > 1").select("a", "b", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")))
    met = prints.join(first, ["a", "b"]).filter((F.col("row") != F.col("first_row")) | (F.col("start") != F.col("first_start")))
    runs = met.select("row", F.explode(F.sequence("start", "end")).alias("line"))
    return runs.groupBy("row").agg(F.collect_set("line").alias("lines"))


def without_repeated_lines(docs: DataFrame, gram: int = 2, window: int = 1, doc_id: str = "doc_id",
                           text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated runs of lines, and n_lines and n_deleted."""
    if window > gram:
        raise ValueError("a window longer than a gram would leave lines of a run between fingerprints")
    results = ("n_lines", "n_deleted")
    keep = [c for c in docs.columns if c not in results]
    names = {c: f"c{i}" for i, c in enumerate(keep)}
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"),
                               *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), "texts")
    cut = deletions(rows.select("row", F.col(names[doc_id]).alias("doc_id"), F.col(names[text]).alias("text")), gram, window)
    body = F.col(names[text])
    joined = rows.join(cut, "row", "left").withColumn("all_lines", F.split(body, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), "lines")
    cleaned = F.when(F.col("lines").isNull(), body).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("all_lines", i)), "\n"))
    return joined.select(
        *[(cleaned if c == text else F.col(n)).alias(c) for c, n in names.items()],
        F.when(body.isNull(), 0).otherwise(F.size("all_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_deleted"))
