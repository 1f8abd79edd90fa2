"""Line dedup by site-relative frequency.

Pages are grouped by host. For every line, the pages of its host that contain
it are divided by all pages of the host; a line above the boilerplate ratio is
dropped from all pages of that host. Lines are compared without surrounding
spaces; empty lines are never boilerplate and always stay.

With ``low``, a line above that smaller ratio goes too, but only from pages that
keep at least half of their text. A page that is mostly repeated lines is a copy
of another page: near-dedup keeps one of it, here all of them would be emptied.

A host has at most (its mean distinct lines a page / ratio) such lines, so the
list that is joined to its pages is bounded. Counting is one aggregation with a
partial step in each task; a hot host spreads over its lines.

Null texts stay null, empty ones empty; a null host is a host of its own.
Repeated rows are pages of their own. A host of fewer than ``min_pages`` pages
with a line keeps it. A page that loses all lines keeps an empty text. Other
columns, of any name, stay as they are; with ``counts``, ones named n_lines or
n_dropped are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.staging import fresh_name, staged

RATIO, MIN_PAGES = 0.1, 3
#: ``low`` for whole corpora, from the line frequencies given in the README.
LOW_RATIO = 0.005


def _key(line):
    return F.unhex(F.md5(F.trim(line)))


def boilerplate_lines(pages: DataFrame, host: str, text: str, ratio: float, min_pages: int, low: float | None = None) -> DataFrame:
    """``host`` and ``drops``: the keys of the lines that exceed the ratio on that host; ``more``: with those that exceed ``low``."""
    low = ratio if low is None else min(low, ratio)
    lines = F.array_distinct(F.transform(F.filter(F.split(F.col(text), "\n", -1), lambda x: F.trim(x) != ""), _key))
    per_line = pages.select(F.col(host).alias("host"), F.explode(lines).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    common = per_line.where(F.col("n") >= min_pages)
    totals = pages.groupBy(F.col(host).alias("of")).agg(F.count("*").alias("total"))
    over = common.join(totals, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > F.col("total") * low)
    firm = F.when(F.col("n") > F.col("total") * ratio, F.col("line"))
    return over.groupBy("host").agg(F.sort_array(F.collect_list(firm)).alias("drops"), F.sort_array(F.collect_list("line")).alias("more"))


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False, low: float | None = None
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``; ``counts`` adds n_lines and n_dropped."""
    of, drops, more = (fresh_name(pages, f"boilerplate_{name}") for name in ("host", "drops", "more"))
    bad = boilerplate_lines(pages, host, text, ratio, min_pages, low).select(F.col("host").alias(of), F.col("drops").alias(drops), F.col("more").alias(more))
    joined = pages.join(staged(bad, "boilerplate"), F.col(host).eqNullSafe(F.col(of)), "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(drops), _key(x)))
    if low is not None:
        fewer = F.filter(lines, lambda x: ~F.array_contains(F.col(more), _key(x)))
        kept = F.when(F.char_length(F.array_join(fewer, "")) * 2 >= F.char_length(F.array_join(kept, "")), fewer).otherwise(kept)
    clean = F.when(F.col(drops).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    out = [F.when(F.col(text).isNull(), F.lit(None)).otherwise(clean).alias(text) if c == text else F.col(c) for c in pages.columns]
    if counts:
        out = [c for c, name in zip(out, pages.columns) if name.lower() not in ("n_lines", "n_dropped")]
        n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
        left = F.when(F.col(drops).isNull(), n).otherwise(F.size(kept)).cast("long")
        out += [F.when(F.col(text).isNull(), 0).otherwise(n).cast("long").alias("n_lines"), F.when(F.col(text).isNull(), 0).otherwise(n - left).cast("long").alias("n_dropped")]
    return joined.select(*out)
