"""Fuzzy line dedup: one line of each component of alike lines stays.

A line's shingles are the strings of ``SHINGLE`` characters that begin at its words (lower-cased,
trimmed) and, in longer words, at every further character up to the last ``SHINGLE`` of the word, so that
each character is in a shingle and text without blanks has them all. A line with fewer than ``RUN``
of these has those of all its places; with fewer than ``RUN`` even then (under a dozen characters, or hardly
any that differ) it is alike only to an equal one. Lines are alike from a Jaccard similarity of
``SIMILARITY`` on.

1. Every line gets two hashes of its text and a signature: its shingle hashes in ascending
   order form a ring; each of ``BANDS`` fixed points of the ring gives a band, the next ``RUN`` hashes from
   there on. Each band is a min-wise sample of the set of its own, so two lines of similarity s share
   one with probability s^RUN, and all miss with (1 - s^RUN)^BANDS: under half a per cent at 0.8.
2. Equal lines are grouped before they are shuffled; one of each goes on.
3. Lines with a common band form a bucket. Those of a small bucket are all compared; in a large
   one all are compared with its first line, and those not confirmed form a bucket again, for ``ROUNDS``
   rounds. The lines of every large bucket that is not one component by then are compared by an exact
   prefix join: of two sets of that similarity the rarest fifth and one more of the shingles of each
   have one in common. Lines of one list of such a shingle are compared with the first of them, then
   all pairs of different components are, in blocks.
4. Candidates are confirmed by the exact Jaccard similarity of their shingles.
5. Components of confirmed links come from a distributed union-find; of each component the line of
   the least document id stays, in it the one that comes first.

All steps are SQL functions and joins.

Defined results: blank lines are left alone. A null text is left as it is. A document that had lines with
text and lost them all is dropped by ``drop_repeated_lines``; line breaks of the lines that stay are kept.
Repeated rows (same id and text) count as one document. Documents must have ids; those without
keep all their lines. An empty table gives an empty result. Other columns are kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.components import connected_components
from tickloom.llm.prefilter import bit_table, marked
from tickloom.llm.tables import discard, stored, stored_alone

SHINGLE = 10
SIMILARITY = 0.8
RUN = 3
BANDS = 8
SMALL = 12  # lines of a bucket that are all compared with each other
ROUNDS = 4  # of comparing with a first line only, before the rest is compared in full
BLOCK = 1000  # lines of a list that one task compares with the others
FEW = 1000  # links that are not worth new labels: at most so many lines are compared with a list once more
BLANKS = " \t\r"

# A word, seen with the characters that follow its beginning; a longer word than a shingle goes on with each
# of its characters until the shingle ends where the word does. Most words are settled by the first of three ways.
_AT_WORDS = rf"(?s)(?=(.{{1,{SHINGLE}}}))\S(?:\S{{0,{SHINGLE - 1}}}+\s+|(?=\S{{{SHINGLE}}})|\S*\s*)"
_EVERYWHERE = rf"(?s)(?=(.{{{SHINGLE}}}))."


def _trimmed(line: Column, plain: Column) -> Column:
    """``line`` without blanks at its ends; ``plain`` tells how it begins and ends. Trimming looks at every character,
    so it is left out where there is nothing to trim."""
    ends = [at(blank) for blank in BLANKS for at in (plain.startswith, plain.endswith)]
    return F.when(reduce(Column.__or__, ends), F.trim(line, F.lit(BLANKS))).otherwise(line)


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, line_no, line) of all lines with text, lower-cased and trimmed."""
    rows = docs.where(docs[key].isNotNull() & docs[text].isNotNull())
    rows = rows.select(docs[key].alias("doc_id"), F.posexplode(F.split(docs[text], "\n")).alias("line_no", "line"))
    # The filter looks at the line as it is, so that it is lower-cased only once.
    line = F.col("line")
    return rows.where(_trimmed(line, line) != "").withColumn("line", _trimmed(F.lower(line), line))


def _hashed(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("line"), "line")})


def _with_shingles(rows: DataFrame, line: str, name: str) -> DataFrame:
    """``rows`` with the sorted hashes of the line's shingles."""

    def at(places: str):
        found = F.regexp_extract_all(line, F.lit(places), F.lit(1))
        return F.sort_array(F.array_distinct(F.transform(found, lambda s: F.xxhash64(s))))

    rows = rows.withColumn(name, at(_AT_WORDS))
    return rows.withColumn(name, F.when(F.size(name) < RUN, at(_EVERYWHERE)).otherwise(F.col(name)))


def _with_bands(lines: DataFrame) -> DataFrame:
    """``size`` and the hashes ``b0``... of the bands, null for lines without bands."""
    shift = 64 - (BANDS.bit_length() - 1)
    # Signed order: the ring begins at the least number.
    points = [F.lit(-(2**63) + number * 2**shift) for number in range(BANDS)]
    rows = _with_shingles(lines, "line", "ring").drop("line").withColumn("size", F.size("ring"))
    # Sorted among the hashes, a point has those before its own in front of it and the earlier points.
    rows = rows.withColumn("places", F.sort_array(F.concat("ring", F.array(*points))))
    rows = rows.withColumn("ring", F.concat("ring", F.slice("ring", 1, RUN)))

    def band(number: int):
        before = (F.array_position("places", points[number]) - 1 - number).cast("int")
        return F.when(F.col("size") >= RUN, F.xxhash64(F.lit(number), F.slice("ring", before + 1, RUN)))

    return rows.withColumns({f"b{i}": band(i) for i in range(BANDS)}).drop("ring", "places")


def _candidates(buckets: DataFrame, sparse: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs of small buckets, and of large ones with their first line, lines of large ones). Where buckets are ``sparse``
    most hold one line and are sorted out by a filter of fixed size before the rest is joined."""
    passing = []
    if sparse:
        shared = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
        buckets = stored(marked(buckets, "bucket", bit_table(shared, "bucket")).where("maybe").select("bucket", "h1"), "some")
        passing = [shared, buckets]
    hubs = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("hub")).where("n > 1")
    members = stored(buckets.join(hubs, "bucket"), "buckets")
    for table in passing:
        discard(table)
    small = members.where(F.col("n") <= SMALL).select("bucket", "h1")
    other = small.select("bucket", F.col("h1").alias("other"))
    pairs = small.join(other, "bucket").where("h1 < other").select(F.col("h1").alias("a"), F.col("other").alias("b"))
    stars = members.where((F.col("n") > SMALL) & (F.col("h1") != F.col("hub"))).select("bucket", F.col("hub").alias("a"), F.col("h1").alias("b"))
    return pairs, stars, members.where(F.col("n") > SMALL).select("bucket", "h1")


def _labelled(near: DataFrame, links: DataFrame) -> DataFrame:
    """(h1, h2, id, label): the component of each line so far."""
    found = connected_components(links.select("u", "v")).withColumnRenamed("node", "id")
    rows = near.select("h1", "h2", "id").join(found, "id", "left")
    return rows.select("h1", "h2", "id", F.coalesce("component", "id").alias("label"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` where the components that ``links`` join are one."""
    ends = [labels.select(F.col("id").alias(c), F.col("label").alias(f"{c}_label")) for c in ("u", "v")]
    joined = links.select("u", "v").join(ends[0], "u").join(ends[1], "v").select(F.col("u_label").alias("u"), F.col("v_label").alias("v"))
    found = connected_components(joined.where("u <> v")).withColumnRenamed("node", "label")
    return labels.join(found, "label", "left").select("h1", "h2", "id", F.coalesce("component", "label").alias("label"))


def _prefixes(lines: DataFrame, near: DataFrame) -> DataFrame:
    """(token, h1, size, at): the rarest shingles of each line, as many as two alike lines must have one
    of in common; ``at`` is the place in this order, from 0. Some lines besides ``lines`` do no harm, so a filter of
    fixed size picks them."""
    sets = marked(near.select("h1", "id", "shingles"), "h1", bit_table(lines, "h1")).where("maybe")
    tokens = sets.select("h1", "id", F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
    # Shingles of one line only come first in the order and need no list.
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ordered = tokens.join(counts, "token").groupBy("h1", "id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    length = (F.col("size") - F.ceil(SIMILARITY * F.col("size") - 1e-9) + 1).cast("int")
    ordered = ordered.withColumn("single", F.col("size") - F.size("tokens"))
    listed = F.slice("tokens", F.lit(1), F.greatest(length - F.col("single"), F.lit(0)))
    found = ordered.select("h1", "size", "single", F.posexplode(listed).alias("at", "t"))
    return found.select(F.col("t.token").alias("token"), "h1", "size", (F.col("single") + F.col("at")).alias("at"))


def _lists(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the tokens that lines of different components have, with their ``label``, the ``n`` lines of the
    token, the first of these (``hub``, ``hub_label``) and the most ``common`` label."""
    rows = prefixes.join(labels.select("h1", "label"), "h1")
    counts = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("first"))
    lists = counts.groupBy("token").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"), F.min(F.struct("first", "label")).alias("hub"), F.max(F.struct("n", "label"))["label"].alias("common")
    )
    lists = lists.where("labels > 1").select("token", "n", F.col("hub.first").alias("hub"), F.col("hub.label").alias("hub_label"), "common")
    return stored(rows.join(lists, "token"), "lists")


def _possible(left_size: str, left_at: str, right_size: str, right_at: str):
    """Whether two lines can be alike whose first common token stands at these places."""
    rest = F.least(F.col(left_size) - F.col(left_at), F.col(right_size) - F.col(right_at))
    return (1 + SIMILARITY) * rest >= SIMILARITY * (F.col(left_size) + F.col(right_size)) - 1e-6


def _different(lists: DataFrame) -> DataFrame:
    """(a, b): pairs of lines of different components that have a token in common and may be alike. Those of
    the most common label need no turn of their own; the others are dealt into blocks."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = lists.withColumn("blocks", blocks)
    block = F.pmod(F.xxhash64("token", "h1"), F.col("blocks")).cast("int")
    turns = rows.where("label <> common").select("token", block.alias("block"), "h1", "label", "size", "at")
    others = rows.select(
        "token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("h1").alias("h"), F.col("label").alias("l"), F.col("size").alias("s"), F.col("at").alias("p"), "common"
    )
    both = turns.join(others, ["token", "block"]).where("label <> l and (l = common or h1 < h)").where(_possible("size", "at", "s", "p"))
    return both.select(F.least("h1", "h").alias("a"), F.greatest("h1", "h").alias("b")).distinct()


def _alike(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(places, components): all places (doc_id, line_no, h1, h2) of lines that occur more than once
    or may be alike to another, and some more; and (h1, h2, component) of those that are alike."""
    lines = _hashed(_lines(docs, key, text))
    banded = _with_bands(lines)
    # The copies of a line agree in their bands.
    bands = [F.min(f"b{i}").alias(f"b{i}") for i in range(BANDS)]
    distinct = stored(banded.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), *bands), "lines")
    buckets = distinct.select("h1", F.explode(F.array(*[f"b{i}" for i in range(BANDS)])).alias("bucket")).where("bucket is not null")

    pairs, stars, large = _candidates(buckets, sparse=True)
    pairs = stored(pairs.unionByName(stars.select("a", "b")).distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct()
    firsts = stored(distinct.join(ends, "h1", "left_semi").select("h1", "h2", F.col("first_doc").alias("doc_id")), "firsts")

    # One scan gives both the places that may matter and the texts of the candidates, each from its first document.
    wanted = distinct.where("n > 1").select("h1").unionByName(firsts.select("h1"))
    places = marked(lines, "h1", bit_table(wanted, "h1")).where("maybe")
    place = F.xxhash64("h1", "h2", "doc_id")
    places = marked(places.withColumn("place", place), "place", bit_table(firsts.select(place.alias("place")), "place"), "end")
    places = places.select("doc_id", "line_no", "h1", "h2", F.when(F.col("end"), F.col("line")).alias("line"))
    places = stored(places, "places")
    discard(distinct)

    # A line may come more than once in its first document. It is grouped by the keys of the join, which need no
    # other shuffle of the texts.
    near = places.where("line is not null").join(firsts, ["h1", "h2", "doc_id"])
    near = near.groupBy("h1", "h2", "doc_id").agg(F.min("line").alias("line"))
    near = _with_shingles(near.select("h1", "h2", "line"), "line", "shingles").drop("line")
    near = stored(near.withColumn("id", F.monotonically_increasing_id()), "shingles")

    def confirmed(candidates: DataFrame, few: bool = True) -> DataFrame:
        """The candidates that are alike; where they are ``few``, other lines are sorted out before the join."""
        rows = near
        if few:
            rows = marked(near, "h1", bit_table(candidates.select(F.explode(F.array("a", "b")).alias("h1")), "h1")).where("maybe")
        left = rows.select(F.col("h1").alias("a"), F.col("id").alias("u"), F.col("shingles").alias("left"))
        right = rows.select(F.col("h1").alias("b"), F.col("id").alias("v"), F.col("shingles").alias("right"))
        sizes = F.size("left"), F.size("right")
        # Most candidates have too different numbers of shingles. The intersection stands there once, as a
        # condition of a join computes it anew each time.
        possible = F.least(*sizes) >= SIMILARITY * F.greatest(*sizes) - 1e-9
        enough = (1 + SIMILARITY) * F.size(F.array_intersect("left", "right")) >= SIMILARITY * (sizes[0] + sizes[1]) - 1e-9
        return candidates.join(left, "a").join(right, "b").where(possible & enough).select("a", "b", "u", "v")

    links = found = stored(confirmed(pairs, few=False), "links")
    for _ in range(ROUNDS):
        # Lines of large buckets that their first line did not confirm form buckets again.
        if stars.isEmpty():
            break
        rest = stars.join(found.select("a", "b"), ["a", "b"], "left_anti").select("bucket", F.col("b").alias("h1"))
        more, stars, _ = _candidates(stored(rest, "rest"), sparse=False)
        candidates = stored(more.unionByName(stars.select("a", "b")).distinct(), "pairs")
        found = stored(confirmed(candidates), "links")
        links = links.unionByName(found)

    labels = _labelled(near, links)
    if not large.isEmpty():
        # Large buckets whose lines are still in different components are compared in full.
        labels = stored(labels, "labels")
        mixed = large.join(labels.select("h1", "label"), "h1").groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        prefixes = stored(_prefixes(large.join(mixed, "bucket", "left_semi").select("h1"), near), "prefixes")
        lists = _lists(prefixes, labels)
        hubs = lists.where((F.col("n") > SMALL) & (F.col("label") != F.col("hub_label")))
        more = stored(confirmed(hubs.select(F.least("h1", "hub").alias("a"), F.greatest("h1", "hub").alias("b")).distinct()), "links")
        if more.count() > FEW:
            labels = stored(_merged(labels, more), "labels")
            lists = _lists(prefixes, labels)
        last = stored(confirmed(stored(_different(lists), "pairs")), "links")
        labels = _merged(labels, more.unionByName(last))
    return places, labels.select("h1", "h2", F.col("label").alias("component"))


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lines): numbers of the lines to drop from each document, counted from 0."""
    places, components = _alike(docs, key, text)
    rows = places.select("doc_id", "line_no", "h1", "h2").join(components, ["h1", "h2"], "left")
    # A line in no component is one of its own, named by its two hashes.
    own = F.col("component").isNull()
    rows = rows.select("doc_id", "line_no", F.when(own, F.col("h1")).otherwise(F.col("component")).alias("c1"), F.when(own, F.col("h2")).alias("c2"))
    rows = stored(rows.fillna({"c2": 0}), "rows")
    first = F.min(F.struct("doc_id", "line_no")).alias("first")
    kept = rows.groupBy("c1", "c2").agg(first, F.count("*").alias("n")).where("n > 1")
    dropped = rows.join(kept, ["c1", "c2"]).where("doc_id <> first.doc_id or line_no <> first.line_no")
    return dropped.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("lines"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars", drop_empty: bool = True) -> DataFrame:
    """``docs`` without the repeated lines, and, unless ``drop_empty`` is False, without the documents
    that have no text left; ``chars`` (if there is such a column) is brought up to date."""
    dropped = stored_alone(lambda: repeated_lines(docs, key, text), "dropped")
    table = bit_table(dropped, "doc_id")
    rows = marked(docs.withColumn("__key", docs[key]), "__key", table, "__maybe")
    same = rows.where(~F.col("__maybe")).select(*docs.columns)
    changed = rows.where("__maybe").join(dropped.select(F.col("doc_id").alias("__key"), F.col("lines").alias("__lines")), "__key", "left")
    # Line breaks belong to the line before them, so that what stays is joined as it was.
    split = F.split(changed[text], "\n", -1)
    kept = F.filter(split, lambda line, i: ~F.array_contains("__lines", i))
    changed = changed.withColumn("__kept", F.when(F.col("__lines").isNotNull(), F.array_join(kept, "\n")))
    if drop_empty:
        # The search ends at the first character that is not blank.
        changed = changed.where(F.col("__kept").isNull() | F.col("__kept").rlike(r"[^ \n\r\t]"))
    changes = {text: F.coalesce("__kept", text)}
    if chars in docs.columns:
        kind = docs.schema[chars].dataType
        changes[chars] = F.when(F.col("__kept").isNotNull(), F.char_length("__kept").cast(kind)).otherwise(F.col(chars))
    return same.unionByName(changed.withColumns(changes).select(*docs.columns))
