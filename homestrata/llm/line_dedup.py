"""Line dedup by overlapping windows of consecutive lines.

Every run of three consecutive lines is hashed (128 bits). A window whose hash occurs
again later, in order of (id, text, line), marks that later occurrence; the marked
windows of one text are merged into covered stretches of lines and those go.

Shuffles: window hashes once to count them and once to find the later ones, never the
windows' text; whole texts move once, to meet their own covered stretches. A window in a
third of all texts is combined before the exchange when counted, and meets its single
first place in a join that can be split.

Defined cases: a null text stays null with no lines; an empty text is one empty line;
texts of fewer than ``window`` lines and windows of blank lines only mark nothing; rows
with a null id are returned as they are and mark nothing; rows repeated with id and
text count as one text, so a repeated row loses no more than the first; an empty table
gives an empty result. Other columns are not read by ``line_dedup`` and are all kept by
``drop_repeated_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestrata.sources.staging import stage

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(h1, h2, id, th, pos): the hash and place of every window of lines."""
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), _lines(F.col(text_col)).alias("l")
    )
    count = F.greatest(F.size("l") - F.lit(window - 1), F.lit(0))
    parts = [F.slice("l", F.lit(k + 1), count).alias(f"l{k}") for k in range(window)]
    rows = lines.select("id", "th", F.posexplode(F.arrays_zip(*parts)).alias("pos", "w"))
    row = [F.col("w")[f"l{k}"] for k in range(window)]
    blank = F.lit(True)
    for line in row:
        blank = blank & (F.trim(line) == "")
    return rows.where(~blank).select(
        F.xxhash64(*row).alias("h1"), F.xxhash64(F.lit(1), *row).alias("h2"), "id", "th", "pos"
    )


def repeated_stretches(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(id, th, start, end): merged line stretches, end exclusive, of later occurrences."""
    windows = line_windows(docs, id_col, text_col, window)
    place = F.struct("id", "th", "pos")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .select("h1", "h2", "first")
    )
    # read back from files, its size is known and it has an exchange of its own to split
    firsts = stage(firsts, "line-windows")
    later = windows.join(firsts, ["h1", "h2"]).where(place != F.col("first")).select("id", "th", "pos").distinct()
    order = Window.partitionBy("id", "th").orderBy("pos")
    gap = F.col("pos") - F.lag("pos").over(order) > window
    island = F.sum(F.coalesce(gap, F.lit(True)).cast("int")).over(order)
    return (
        later.select("id", "th", "pos", island.alias("island"))
        .groupBy("id", "th", "island")
        .agg(F.min("pos").alias("start"), (F.max("pos") + window).alias("end"))
        .select("id", "th", "start", "end")
    )


def _kept(lines: Column, stretches: Column) -> Column:
    """The lines outside ordered, disjoint stretches, as slices between them."""
    count = F.size(stretches)

    def between(i: Column) -> Column:
        start = F.when(i > 0, F.element_at(stretches, F.greatest(i, F.lit(1)))["end"]).otherwise(0)
        end = F.when(i < count, F.element_at(stretches, F.least(i + 1, count))["start"]).otherwise(F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), count), between))


def drop_repeated_lines(
    docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, report: str | None = None
) -> DataFrame:
    """``docs`` with all its columns, ``text_col`` without later occurrences; ``report`` names a
    further struct column (n_lines, n_removed)."""
    own = "_cover"  # names of its own beside whatever columns there are
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    covered = (
        repeated_stretches(docs, id_col, text_col, window)
        .groupBy("id", "th")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(f"{own}_lines"))
        .withColumnsRenamed({"id": f"{own}_id", "th": f"{own}_th"})
    )
    text, stretches = F.col(f"`{text_col}`"), F.col(f"{own}_lines")
    joined = docs.join(
        covered,
        (F.col(f"`{id_col}`") == F.col(f"{own}_id")) & (F.xxhash64(text) == F.col(f"{own}_th")),
        "left",
    )
    lines = _lines(text)
    kept = F.when(stretches.isNull(), text).otherwise(F.array_join(_kept(lines, stretches), "\n"))
    columns = [kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if report:
        removed = F.aggregate(stretches, F.lit(0), lambda n, s: n + s["end"] - s["start"])
        columns.append(
            F.struct(
                F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("bigint").alias("n_lines"),
                F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
            ).alias(report)
        )
    return joined.select(*columns)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: id, n_lines, n_removed and the text that is left."""
    out = drop_repeated_lines(docs.select(id_col, text_col), id_col, text_col, window, report="report")
    return out.select(id_col, "report.n_lines", "report.n_removed", text_col)
