"""Phrases of two to four words that occur together more often than their parts would.

Texts are lower-cased (A-Z), cut at sentence signs and line ends into pieces and these at blanks into
words. Counting sorts suffix pointers: every word begins a suffix of at most four words of its piece.
Suffixes that cannot hold a frequent phrase are abandoned early: words are counted first, then pairs of
frequent words, and only a suffix that begins with a frequent pair is kept, up to its first pair that is
not frequent. These go to tasks by their two leading words, and each task sorts them by a multikey
three-way quicksort over the words at depth 1, 2, 3 and 4: rows equal to the pivot word are one
partition, whose size is the count of the phrase, and go on at the next depth; partitions smaller than
the least count are left alone. A pair with very many suffixes is routed by all its words instead, and
its partial sizes are added up.

Equal words, pairs and suffixes are summed in each task before they are shuffled, so a phrase held by a
third of all texts is one row per task by then. Which words and pairs are frequent is told to the tasks
by bit tables of bounded size, where a false hit only costs time. All counts are exact.

Scores: cutting a phrase of count a after its first k words gives parts of counts l and r and the score
floor(2,000,000 a / (l + r)); the lowest of its cuts counts, ties to the smallest k. A phrase inside a
longer one of at least 80 per cent of its count is dropped.

Defined results: a null text is empty, a null language ``und``. Repeated rows count as often as they
occur. Ties of score and count go by the bytes of the phrase. An empty table, or one without frequent
phrases, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.tables import ship_package, stored
from tickloom.llm.words import chunks, mix, split_words

LONGEST = 4
LEAST = 30
TOP = 2000
TASK_BYTES = 1 << 20  # of text taken at once
HELD_ROWS = 400_000  # rows summed up in a task before they are passed on
SORTED_ROWS = 250_000  # suffixes a task should sort
HOT = 200_000  # suffixes of a pair that is routed by all its words
MOST_HOT = 1 << 16  # such pairs, which are broadcast
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

# Words are runs of other characters than blank, tab, line ends and sentence signs.
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_WORD = ~_ENDS
_WORD[[9, 32]] = False


class _Tokens:
    """Words of some texts of one language: ``names`` (each once), their hashes, the words in order
    as indices of names, and whether the next word is in the same piece."""

    def __init__(self, lang: str, texts: pa.Array):
        words = split_words(texts, _WORD)
        sizes = words.ends - words.starts
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        letters = words.data[_WORD[words.data]]
        strings = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(at), pa.py_buffer(letters))
        coded = strings.dictionary_encode()
        self.names = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(len(self.names), np.int64)
        first[self.codes[::-1]] = np.arange(len(self.codes))[::-1]
        self.salt = np.uint64(zlib.crc32(lang.encode()))
        self.hashes = words.hashes[first]
        cuts = np.concatenate([[0], np.cumsum(_ENDS[words.data], dtype=np.int64)])
        piece = cuts[words.starts] if len(sizes) else np.zeros(0, np.int64)
        self.joined = np.zeros(len(sizes), bool)
        if len(sizes):
            self.joined[:-1] = piece[1:] == piece[:-1]
            last = words.bounds[1:] - 1
            self.joined[last[last >= 0]] = False

    def word_keys(self) -> np.ndarray:
        return mix(self.hashes + self.salt)

    def pair_keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return _pair_keys(self.hashes[first], self.hashes[second], self.salt)


def _pair_keys(first: np.ndarray, second: np.ndarray, salt) -> np.ndarray:
    return mix(mix(first + salt) + second)


class _Bits:
    """A set of 64-bit keys as a table of bits; it never misses a key it was given."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys & np.uint64(64 * len(self.table) - 1)
        return (self.table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Tokens]]:
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            some = batch.filter(pc.equal(batch.column("lang"), lang))
            for part in chunks(some, size=TASK_BYTES):
                yield lang, _Tokens(lang, part.column("text"))


_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _summed(parts: Iterator[tuple[str, pa.Array, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) rows with equal ones added up, as far as a task can hold them."""

    def total(tables):
        table = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        return table.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).cast(_COUNTS)

    held, rows = [], 0
    for lang, phrases, n in parts:
        langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))
        held.append(pa.table([langs, phrases.cast(pa.string()), pa.array(n, pa.int64())], schema=_COUNTS))
        rows += len(n)
        if rows > HELD_ROWS:
            held = [total(held)]
            rows = held[0].num_rows
            if rows > HELD_ROWS // 2:
                yield from held[0].to_batches(max_chunksize=50_000)
                held, rows = [], 0
    if held:
        yield from total(held).to_batches(max_chunksize=50_000)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts():
        for lang, tokens in _by_language(batches):
            if len(tokens.codes):
                yield lang, tokens.names, np.bincount(tokens.codes)
                yield lang, pa.array([None], pa.string()), np.array([len(tokens.codes)])  # all words

    return _summed(parts())


def _frequent_pairs(tokens: _Tokens, words: _Bits) -> tuple[np.ndarray, np.ndarray]:
    """Places whose word and next word, in one piece, may be frequent, and the pairs' codes there."""
    good = words.has(tokens.word_keys())[tokens.codes] if len(tokens.codes) else np.zeros(0, bool)
    at = np.flatnonzero(tokens.joined[:-1] & good[:-1] & good[1:]) if len(good) else np.zeros(0, np.int64)
    return at, tokens.codes[at] * len(tokens.names) + tokens.codes[at + 1] if len(at) else at


def _joined(columns: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*columns, pa.scalar(" ", columns[0].type)) if len(columns) > 1 else columns[0]


def _pairs(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Bits(frequent.value)

        def parts():
            for lang, tokens in _by_language(batches):
                _, codes = _frequent_pairs(tokens, words)
                found, n = np.unique(codes, return_counts=True)
                if len(found):
                    first, second = np.divmod(found, len(tokens.names))
                    yield lang, _joined([tokens.names.take(pa.array(c)) for c in (first, second)]), n

        yield from _summed(parts())

    return run


def _suffixes(frequent_words, frequent_pairs):
    """Suffixes of two to four words that begin with a frequent pair and go on as long as each next
    pair is frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = _Bits(frequent_words.value), _Bits(frequent_pairs.value)

        def parts():
            for lang, tokens in _by_language(batches):
                at, codes = _frequent_pairs(tokens, words)
                if not len(at):
                    continue
                found, which = np.unique(codes, return_inverse=True)
                first, second = np.divmod(found, len(tokens.names))
                starts = np.zeros(len(tokens.codes) + LONGEST, bool)
                starts[at] = pairs.has(tokens.pair_keys(first, second))[which]
                at = np.flatnonzero(starts)
                sizes = np.full(len(at), 2)
                for more in range(1, LONGEST - 1):
                    sizes += (sizes == more + 1) & starts[at + more]
                for size in range(2, LONGEST + 1):
                    some = at[sizes == size]
                    if not len(some):
                        continue
                    # One number for each different suffix, word by word.
                    code = tokens.codes[some]
                    for i in range(1, size):
                        _, code = np.unique(code * len(tokens.names) + tokens.codes[some + i], return_inverse=True)
                    _, place, n = np.unique(code, return_index=True, return_counts=True)
                    columns = [tokens.names.take(pa.array(tokens.codes[some[place] + i])) for i in range(size)]
                    yield lang, _joined(columns), n

        yield from _summed(parts())

    return run


def three_way_quicksort(rows: np.ndarray, weights: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, depth, weight) of each prefix of the integer ``rows`` (-1 where a row has ended) that
    weighs at least ``least[depth]``: a row that begins with it, and the weight of all that do.

    Sorts row numbers by the value at one depth into less than, equal to and greater than a pivot; the
    equal ones have one more value in common and go on at the next depth. Partitions that weigh too
    little are left unsorted."""
    depths = rows.shape[1]
    stack = [(np.arange(len(rows)), 0)]
    while stack:
        order, depth = stack.pop()
        values = rows[order, depth]
        if len(order) > 2:
            pivot = sorted((values[0], values[len(values) // 2], values[-1]))[1]
        else:
            pivot = values[0]
        equal = values == pivot
        same = order if equal.all() else order[equal]
        if len(same) < len(order):
            for part in (order[values < pivot], order[values > pivot]):
                if len(part) and weights[part].sum() >= least[depth]:
                    stack.append((part, depth))
        if pivot < 0:
            continue
        weight = int(weights[same].sum())
        if weight >= least[depth]:
            yield int(same[0]), depth, weight
            if depth + 1 < depths:
                stack.append((same, depth + 1))


def _sorted_counts(least: int):
    def counts(table: pa.Table, bounds: list[int]) -> pa.RecordBatch:
        langs = table.column("lang").combine_chunks().dictionary_encode()
        split = pc.split_pattern(table.column("phrase").combine_chunks(), " ")
        offsets = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        rows = np.full((len(sizes), 1 + LONGEST), -1, np.int32)
        rows[:, 0] = langs.indices.to_numpy(zero_copy_only=False)
        for i in range(LONGEST):
            longer = sizes > i
            rows[longer, 1 + i] = codes[offsets[:-1][longer] - offsets[0] + i]
        found = [x for x in three_way_quicksort(rows, table.column("n").to_numpy(), np.array(bounds)) if x[1] >= 2]
        at, depth, n = np.array(found, np.int64).reshape(-1, 3).T
        phrases = []
        for size in range(2, LONGEST + 1):
            some = np.flatnonzero(depth == size)
            columns = [words.dictionary.take(pa.array(rows[at[some], 1 + i])) for i in range(size)]
            phrases.append((some, _joined(columns)))
        order = np.argsort(np.concatenate([some for some, _ in phrases]), kind="stable")
        phrase = pa.concat_arrays([p for _, p in phrases]).take(pa.array(order))
        lang = langs.dictionary.take(pa.array(rows[at, 0]))
        return pa.record_batch([lang, phrase, pa.array(n, pa.int64())], schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        batches.clear()
        hot = table.column("hot")
        # Of a pair routed by all words only what has all four is whole in one task.
        for part, bounds in ((table.filter(pc.invert(hot)), [least] * (1 + LONGEST)), (table.filter(hot), [1] * LONGEST + [least])):
            if part.num_rows:
                yield counts(part, bounds)

    return run


def _marks(size: int, salted: int):
    """Places in a table of ``size`` bits for phrases of one or two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts = np.array([zlib.crc32(x.encode()) for x in batch.column("lang").to_pylist()], np.uint64)
            words = split_words(batch.column("phrase"), _WORD)
            first = words.hashes[words.bounds[:-1]]
            keys = mix(first + salts) if salted == 1 else _pair_keys(first, words.hashes[words.bounds[:-1] + 1], salts)
            place = keys & np.uint64(size - 1)
            bits = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.record_batch([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bits)], names=["word", "bits"])

    return run


def _bit_table(phrases: DataFrame, words: int) -> np.ndarray:
    """Bits for all ``phrases`` of that many words: sixteen for each, up to ``MOST_BITS``."""
    size = min(max(LEAST_BITS, 1 << (16 * phrases.count()).bit_length()), MOST_BITS)
    marked = phrases.select("lang", "phrase").mapInArrow(_marks(size, words), "word bigint, bits bigint")
    found = marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(size // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of one to four words that occur at least ``least`` times,
    and (lang, n) of all words."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    schema = "lang string, phrase string, n bigint"

    def counted(made: DataFrame, name: str) -> DataFrame:
        total = made.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return stored(total.where((F.col("n") >= least) | F.col("phrase").isNull()), name)

    words = counted(rows.mapInArrow(_words, schema), "words")
    totals = words.where("phrase is null").select("lang", "n")
    words = words.where("phrase is not null")
    word_bits = spark.sparkContext.broadcast(_bit_table(words, 1))
    pairs = counted(rows.mapInArrow(_pairs(word_bits), schema), "pairs")
    pair_bits = spark.sparkContext.broadcast(_bit_table(pairs, 2))

    total = pairs.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(total / SORTED_ROWS))
    # At most MOST_HOT pairs, as all of them together have ``total`` suffixes.
    hot = pairs.where(F.col("n") > max(HOT, total // MOST_HOT)).select("lang", F.col("phrase").alias("pair"), F.lit(True).alias("hot"))
    suffixes = rows.mapInArrow(_suffixes(word_bits, pair_bits), schema).withColumn("pair", F.substring_index("phrase", " ", 2))
    suffixes = suffixes.join(F.broadcast(hot), ["lang", "pair"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    route = F.when(F.col("hot"), F.col("phrase")).otherwise(F.col("pair"))
    routed = suffixes.repartition(parts, "lang", route).select("lang", "phrase", "n", "hot")
    longer = counted(routed.mapInArrow(_sorted_counts(least), schema), "phrases")
    return words.unionByName(longer), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, text, lang, least)
    words = F.split("phrase", " ", -1)
    found = counts.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))
    size = F.size("w")
    part = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")),
        )
    )
    within = found.where(size > 2).select("lang", F.explode(inside).alias("phrase"), "a")
    within = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(within, ["lang", "phrase"], "left").where(F.expr("longer is null or 100 * cast(longer as decimal(20,0)) < 80 * cast(a as decimal(20,0))"))

    # The best of each of 64 shares of a language first, so that no task ranks all of its phrases.
    order = [F.desc("cut.score"), F.desc("a"), "phrase"]
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
