"""Benchmark decontamination: prefix-filtered join of item windows with documents.

Every run of 13 words of a benchmark item is a window (an item with fewer words is one window).
A window occurs in a document only if all its shingles do, so one shingle is enough to find it:
the prefix of a window, with its shingles put in order of rarity over the whole corpus, is its
rarest shingle. The steps:

1. count over all documents how often each benchmark shingle occurs (rarity);
2. keep the rarest shingle of each window, with its place in the window, as the window's token;
3. scan the documents for these tokens; a hit carries the words around it;
4. join hits and windows on the token, keep those whose window would lie within the document
   (length and positional bounds: the token's place fixes where the window begins and ends);
5. compare the window's words with the document's, word for word.

What goes to every executor is a filter of fixed size, whatever the benchmark holds; hits and
windows meet in an ordinary join.

Defined results: a null or empty text, or one without words, has no words, no hits and is not
contaminated. An item without words has no window. Equal items all count. Repeated documents each
get a row of their own. An empty benchmark leaves every document clean; an empty document table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.tables import ship_package, stored, text_rows, without_rows
from tickloom.llm.words import LETTERS, chunks, split_words

WINDOW_WORDS = 13
SHINGLE_WORDS = 4
SHARE = 20  # contaminated if SHARE * hit words >= words
EXACT_TOKENS = 1_000_000  # 8 MB
TABLE_BITS = 28  # 32 MB


def _shingles(words, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, positions, hashes) of the runs of words that lie in one text."""
    for size in sizes:
        hashes, inside = words.shingles(size)
        at = np.flatnonzero(inside)
        yield size, at, hashes[at] + np.uint64(size)


def _item_windows(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch, size=1 << 16)):
            words = split_words(part.column("text"), LETTERS)
            rows, texts, tokens, places, sizes, lengths = [], [], [], [], [], []
            for i, (first, last) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                count = int(last - first)
                if not count:
                    continue
                size, length = min(shingle, count), min(window, count)
                hashes = words.shingles(size)[0] + np.uint64(size)
                for begin in range(first, last - length + 1):
                    end = begin + length
                    spelled = b" ".join(words.data[words.starts[w] : words.ends[w]].tobytes() for w in range(begin, end))
                    rows.append(i)
                    texts.append(spelled)
                    tokens.append(hashes[begin : end - size + 1].view(np.int64).tolist())
                    places.append(list(range(length - size + 1)))
                    sizes.append(size)
                    lengths.append(length)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("item_id").take(pa.array(rows, pa.int64())),
                    pa.array(texts, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(sizes, pa.int32()),
                    pa.array(lengths, pa.int32()),
                ],
                names=["item_id", "window", "tokens", "places", "size", "length"],
            )

    return run


class TokenFilter:
    """Tells hashes that may be tokens from those that are none: exactly where there are at most
    ``EXACT_TOKENS`` of them, else by a table of ``TABLE_BITS`` bits. Both sizes are fixed, so
    the filter may go to every executor; tokens let through by mistake find no partner later."""

    def __init__(self, tokens: DataFrame):
        tokens = tokens.select(F.col(tokens.columns[0]).alias("token")).distinct()
        self.table = None
        if tokens.count() <= EXACT_TOKENS:
            self.known = np.sort(_numbers(tokens, "token").view(np.uint64))
        else:
            top = F.shiftrightunsigned("token", 64 - TABLE_BITS)
            bit = F.expr("shiftleft(1L, cast(top & 63 as int))")
            words = tokens.select(top.alias("top")).select(F.shiftrightunsigned("top", 6).alias("word"), bit.alias("bit"))
            words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
            rows = words.toArrow()
            self.table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
            self.table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
        self.flags = None

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be tokens."""
        if self.table is not None:
            top = hashes >> np.uint64(64 - TABLE_BITS)
            return np.flatnonzero((self.table[top >> np.uint64(6)] >> (top & np.uint64(63))) & np.uint64(1))
        if not len(self.known):
            return np.zeros(0, np.int64)
        if self.flags is None:  # a table over the top bits answers for nearly all that are absent
            self.flags = np.zeros(1 << 22, bool)
            self.flags[self.known >> np.uint64(42)] = True
        maybe = np.flatnonzero(self.flags[hashes >> np.uint64(42)])
        at = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == hashes[maybe]]


def _numbers(frame: DataFrame, column: str) -> np.ndarray:
    rows = frame.select(column).toArrow()
    return rows.column(column).to_numpy() if rows.num_rows else np.zeros(0, np.int64)


def _count_occurrences(tokens: TokenFilter, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch)):
            words = split_words(part.column("text"), LETTERS)
            found = [hashes[tokens(hashes)] for _, _, hashes in _shingles(words, sizes)]
            if found:
                token, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])

    return run


def _find_tokens(tokens: TokenFilter, sizes: list[int], reach: int):
    """Per document its number of words and the hits: (token, place, first word of the
    surroundings, the words around it)."""
    hit = pa.struct([("token", pa.int64()), ("place", pa.int32()), ("begin", pa.int32()), ("around", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch)):
            words = split_words(part.column("text"), LETTERS)
            found = [[] for _ in range(part.num_rows)]
            for size, at, hashes in _shingles(words, sizes):
                for h in tokens(hashes):
                    place = int(at[h])
                    doc = int(np.searchsorted(words.bounds, place, "right")) - 1
                    first = max(int(words.bounds[doc]), place - reach)
                    last = min(int(words.bounds[doc + 1]), place + size + reach)
                    around = b" ".join(words.data[words.starts[w] : words.ends[w]].tobytes() for w in range(first, last))
                    begin = int(words.bounds[doc])
                    found[doc].append((int(hashes[h].view(np.int64)), place - begin, first - begin, around))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(words.bounds)), pa.array(found, pa.list_(hit))],
                names=["doc_id", "text_hash", "n_words", "hits"],
            )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    share: int = SHARE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit (words inside an occurrence
    of a window), items (sorted ids, as strings, of items with occurring windows), contaminated."""
    spark = docs.sparkSession
    ship_package(spark)
    source = text_rows(docs, key, text)
    items = benchmark.select(benchmark[item].alias("item_id"), F.coalesce(benchmark[text].cast("string"), F.lit("")).alias("text"))
    item_type = items.schema["item_id"].dataType.simpleString()
    id_type = source.schema["doc_id"].dataType.simpleString()
    windows = items.mapInArrow(
        _item_windows(window, shingle),
        f"item_id {item_type}, window binary, tokens array<bigint>, places array<int>, size int, length int",
    )
    windows = stored(windows, "item_windows")
    # Equal windows are looked for once.
    distinct = windows.groupBy("window").agg(F.first(F.struct("tokens", "places", "length")).alias("w")).select("window", "w.*")
    distinct = stored(distinct.withColumn("window_id", F.monotonically_increasing_id()), "windows")
    sizes = sorted(row["size"] for row in windows.select("size").distinct().collect())  # at most ``shingle`` values
    parts = distinct.select("window_id", F.explode(F.arrays_zip("tokens", "places")).alias("part"))
    parts = parts.select("window_id", F.col("part.tokens").alias("token"), F.col("part.places").alias("offset"))

    counted = source.select("text").mapInArrow(_count_occurrences(TokenFilter(parts.select("token")), sizes), "token bigint, n bigint")
    rarity = stored(counted.groupBy("token").agg(F.sum("n").alias("n")), "rarity")
    # A window with a shingle that no document has cannot occur: it needs no prefix.
    order = Window.partitionBy("window_id").orderBy("n", "token", "offset")
    prefix = parts.join(rarity, "token", "left").fillna({"n": 0}).withColumn("at", F.row_number().over(order))
    prefix = prefix.where("at = 1 and n > 0").select("window_id", "token", "offset")
    prefix = stored(prefix.join(distinct.select("window_id", "window", "length"), "window_id"), "prefixes")

    scanned = source.mapInArrow(
        _find_tokens(TokenFilter(prefix.select("token")), sizes, window),
        f"doc_id {id_type}, text_hash bigint, n_words bigint, hits array<struct<token:bigint,place:int,begin:int,around:binary>>",
    )
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")

    hits = scanned.where("size(hits) > 0").select("row", "doc_id", "text_hash", "n_words", F.explode("hits").alias("hit"))
    hits = hits.select("row", "doc_id", "text_hash", "n_words", "hit.*").join(prefix, "token")
    hits = hits.withColumn("start", F.col("place") - F.col("offset")).withColumn("end", F.col("start") + F.col("length"))
    hits = hits.where("start >= 0 and end <= n_words")
    around = F.slice(F.split(F.col("around").cast("string"), " "), F.col("start") - F.col("begin") + 1, F.col("length"))
    hits = hits.where(F.array_join(around, " ") == F.col("window").cast("string"))
    hits = stored(hits.select("row", "window", "start", "end"), "hits")
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
    spans = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "covered"))).alias("n_hit"))
    named = windows.select("window", F.col("item_id").cast("string").alias("item")).distinct()
    names = hits.select("row", "window").distinct().join(named, "window").select("row", "item").distinct()
    names = names.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = spans.join(names, "row", "left")

    out = scanned.select("row", "doc_id", "text_hash", "n_words").join(found, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they were."""
    found = contamination(docs, benchmark, key, text, **options).where("contaminated")
    return without_rows(docs, stored(found.select("doc_id", "text_hash"), "contaminated"), key, text)
