"""Page texts to chunks: recursive separator splitting, and fixed windows in pure SQL."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import constants as C
from lectern.functions.text import is_blank
from lectern.operators.ordered import running_totals
from lectern.session import cut_lineage


def _pieces(text: str, lo: int, hi: int, separators: Sequence[str]) -> tuple[list[tuple[int, int]] | None, Sequence[str]]:
    """Spans between the first separator found in text[lo:hi], each starting with it; separators left.

    No spans (None) stand for single characters, the pieces of the empty separator.
    """
    for level, sep in enumerate(separators):
        if sep == "":
            return None, separators[level + 1 :]
        at = text.find(sep, lo, hi)
        if at < 0:
            continue
        cuts = [lo]
        while at >= 0:
            if at > lo:
                cuts.append(at)
            at = text.find(sep, at + len(sep), hi)
        cuts.append(hi)
        return list(zip(cuts, cuts[1:])), separators[level + 1 :]
    return [(lo, hi)], ()


def _character_windows(lo: int, hi: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """What merging single characters comes to: full windows that start with the end of the last one."""
    step = max(1, size - overlap)
    while hi - lo > size:
        yield lo, lo + size
        lo += step
    if lo < hi:
        yield lo, hi


def _merge(spans: list[tuple[int, int]], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Adjacent spans joined up to `size`; the next window starts with at most `overlap` characters."""
    first = 0
    for i, (lo, hi) in enumerate(spans):
        start = spans[first][0]
        if hi - start > size and i > first:
            yield start, lo
            while first < i and (lo - spans[first][0] > overlap or hi - spans[first][0] > size):
                first += 1
    if first < len(spans):
        yield spans[first][0], spans[-1][1]


def chunk_spans(
    text: str, lo: int, hi: int, size: int, overlap: int, separators: Sequence[str]
) -> Iterator[tuple[int, int]]:
    spans, rest = _pieces(text, lo, hi, separators)
    if spans is None:
        yield from _character_windows(lo, hi, size, overlap)
        return
    short: list[tuple[int, int]] = []
    for span in spans:
        if span[1] - span[0] < size:
            short.append(span)
            continue
        if short:
            yield from _merge(short, size, overlap)
            short = []
        if rest:
            yield from chunk_spans(text, *span, size, overlap, rest)
        else:
            yield span
    if short:
        yield from _merge(short, size, overlap)


def recursive_chunks(
    text: Column | str,
    size: int = C.CHUNK_CHARS,
    overlap: int = C.CHUNK_OVERLAP,
    separators: Sequence[str] = C.SEPARATORS,
) -> Column:
    """ARRAY<STRING> of stripped, non-empty chunks of one page."""

    def split_page(page: str | None) -> list[str]:
        page = page or ""
        parts = (page[a:b].strip() for a, b in chunk_spans(page, 0, len(page), size, overlap, separators))
        return [p for p in parts if p]

    @F.pandas_udf("array<string>")
    def split(pages: pd.Series) -> pd.Series:
        return pages.map(split_page)

    return split(F.col(text) if isinstance(text, str) else text)


def window_chunks(text: Column | str, size: int = C.CHUNK_CHARS, overlap: int = C.CHUNK_OVERLAP) -> Column:
    """ARRAY<STRING> of fixed windows, each starting `size - overlap` after the last."""
    text = F.col(text) if isinstance(text, str) else text
    last = F.greatest(F.lit(1), F.length(text) - overlap)
    starts = F.sequence(F.lit(1), last, F.lit(size - overlap))
    return F.when(text != "", F.transform(starts, lambda s: F.substring(text, s, size))).otherwise(
        F.array().cast("array<string>")
    )


def explode_pages(pages: DataFrame, chunks: Column, doc: str = "doc_id", page: str = "page_num") -> DataFrame:
    """One row per chunk with `chunk_index`, 0-based over the whole document.

    A page's first index is the running number of chunks on the pages before it, taken
    over (doc, page, count) rows only; texts are not part of that shuffle. The chunks of a
    page, and all that leads to them, are computed once and kept while they are numbered.
    """
    keep = [c for c in pages.columns if c != "text"]
    split = pages.where(~is_blank("text")).withColumn("__chunks", F.filter(chunks, lambda x: ~is_blank(x)))
    split = cut_lineage(split.drop("text"))
    counts = split.select(doc, page, F.size("__chunks").alias("__size"))
    offsets = running_totals(counts, page, {"__first": F.col("__size")}, group=[doc], inclusive=False)
    rows = split.join(offsets.select(doc, page, "__first"), [doc, page])
    return rows.select(
        *keep, "__first", F.posexplode("__chunks").alias("__pos", "text")
    ).select(*keep, (F.col("__first") + F.col("__pos")).cast("int").alias("chunk_index"), "text")


def explode_single_pages(docs: DataFrame, chunks: Column) -> DataFrame:
    """The same for documents known to be one page each: no shuffle at all."""
    keep = [c for c in docs.columns if c != "text"]
    return docs.where(~is_blank("text")).select(
        *keep, F.posexplode(F.filter(chunks, lambda x: ~is_blank(x))).alias("chunk_index", "text")
    )
