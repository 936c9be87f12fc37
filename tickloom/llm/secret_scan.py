"""Secrets in texts: patterns, and sliding-window entropy over candidate strings.

Patterns give the base spans: assignments to secret-sounding names, access keys and long runs of
lower-case hexadecimal digits. The entropy scan adds spans. Its candidates are long runs of
one character class; a window slides over a candidate, and the counts of the characters in the
window and with them its Shannon entropy are updated for the character that enters and the
one that leaves. The part of a candidate covered by windows above the class's limit becomes a
span, unless the candidate is on the allow list or meets a base span.

All is done with SQL functions inside a row; no text leaves its row, so nothing is shuffled. The
places of a pattern's matches follow from the lengths of the matches and of the pieces between.

Defined results: a null or empty text has no spans. Very long texts and candidates take time in
proportion to their length. Repeated rows each get their spans. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.tables import text_rows

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is too short ends where no longer one could begin, so the length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGNED_LENGTH = 6
PART = 128  # values of a part of a running total
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_text"]  # the order of spans that begin together


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of a class and what a window over them must have."""

    kind: str
    alphabet: str
    candidate: str
    window: int
    limit: float  # bits per character
    needs: tuple[str, ...] = ()  # patterns of which a candidate must hold at least two


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("entropy_hex", "0123456789abcdefABCDEF", r"(?<![0-9A-Za-z])[0-9a-fA-F]{24,}(?![0-9A-Za-z])", 24, 3.0, ("[0-9]", "[a-fA-F]")),
    CharacterClass("entropy_text", _LETTERS + "0123456789+/_=-", r"[A-Za-z0-9+/_=-]{24,}", 24, 3.8, ("[0-9]", "[a-z]", "[A-Z]")),
)

# Candidates of public or made-up values.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"(?i)0123456789|1234567890|abcdefghij|(.)\1{7}",
    r"(?i)^(sha1|sha256|sha384|sha512|md5)[-_=]",
)


def _named(value: Column, use) -> Column:
    """``use`` of a value that is made once within an expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, start: Column, merge) -> Column:
    """Array of the running totals of an array under an associative ``merge``, each with the value of
    its own place. A fold that appends copies its list at every step, so the array is cut into parts of
    ``PART`` values: the totals inside a part, and those of the parts before it, come from short lists."""

    def fold(part: Column) -> Column:
        total = lambda state, x: merge(state["last"], x)
        step = lambda state, x: F.struct(total(state, x).alias("last"), F.array_append(state["all"], total(state, x)).alias("all"))
        return F.aggregate(part, F.struct(start.alias("last"), F.slice(F.array(start), 1, 0).alias("all")), step, lambda state: state["all"])

    def joined(parts: Column) -> Column:
        totals = fold(F.transform(parts, lambda part: F.element_at(part, -1)))
        moved = lambda part, before: F.transform(part, lambda x: merge(before, x))
        return _named(totals, lambda t: F.flatten(F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(moved(part, F.get(t, i - 1))))))

    places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / PART).cast("int"))
    parts = F.transform(places, lambda i: fold(F.slice(values, i * PART + 1, PART)))
    return F.when(F.size(values) <= PART, fold(values)).otherwise(_named(parts, joined))


def _with_spans(rows: DataFrame, name: str, pattern: str, kind: str) -> DataFrame:
    """``rows`` with the places of all matches of a pattern in ``text``, array of (start, kind, end, match). The end of a match is the running total of the lengths of the matches and of
    the pieces before them."""
    rows = rows.withColumn("__found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    pieces = F.when(F.size("__found") > 0, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>"))
    lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size("__found")), "__found", lambda piece, match: F.char_length(piece) + F.char_length(match))
    rows = rows.withColumn("__lengths", lengths)
    rows = rows.withColumn("__ends", running(F.col("__lengths"), F.lit(0), lambda a, b: a + b))

    def span(match, end):
        return F.struct((end - F.char_length(match)).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), match.alias("match"))

    return rows.withColumn(name, F.zip_with("__found", "__ends", span)).drop("__found", "__lengths", "__ends")


def _with_apart(rows: DataFrame, name: str, spans: str, others: str) -> DataFrame:
    """``rows`` with those of ``spans`` that meet none of ``others``. Both are put in order; a span is met by one
    that began before if the furthest end so far lies behind its start, and by a later one if that
    begins before its end."""
    own = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(True).alias("own"), s["end"].alias("end"), s.alias("span")))
    other = F.transform(others, lambda s: F.struct(s["start"].alias("start"), F.lit(False).alias("own"), s["end"].alias("end"), F.lit(None).alias("span")))
    rows = rows.withColumn("__both", F.when((F.size(spans) > 0) & (F.size(others) > 0), F.array_sort(F.concat(own, other))))
    last = F.lit(2**31 - 1)
    rows = rows.withColumns(
        {
            "__ends": F.transform("__both", lambda r: F.when(r["own"], F.lit(-1)).otherwise(r["end"])),
            "__starts": F.transform(F.reverse("__both"), lambda r: F.when(r["own"], last).otherwise(r["start"])),
        }
    )
    rows = rows.withColumns({"__ends": running(F.col("__ends"), F.lit(-1), F.greatest), "__starts": F.reverse(running(F.col("__starts"), last, F.least))})
    # Walked side by side: a column read by place within a lambda may be made anew for each place.
    met = F.zip_with("__ends", "__starts", lambda end, start: F.struct(end.alias("end"), start.alias("start")))
    free = F.zip_with("__both", met, lambda r, m: F.when(r["own"] & (m["end"] <= r["start"]) & (m["start"] >= r["end"]), r["span"]))
    chosen = F.filter(free, lambda span: span.isNotNull())
    return rows.withColumn(name, F.when(F.col("__both").isNull(), F.col(spans)).otherwise(chosen)).drop("__both", "__ends", "__starts")


def _log_sum(count: Column) -> Column:
    """count * log2(count), the term of a character in a window's entropy."""
    return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))


def high_entropy_part(match: Column, kind: CharacterClass) -> Column:
    """(first, last) characters of a string covered by windows above the limit, end exclusive;
    last is 0 where there is none. The state of the scan is the count of each character in
    the window and the sum of their terms."""
    size, window = len(kind.alphabet), kind.window
    state = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("terms"), F.lit(-1).alias("first"), F.lit(0).alias("last")
    )

    def scan(places: Column) -> Column:
        def step(state, i):
            enters, leaves = F.get(places, i), F.when(i >= window, F.get(places, i - window)).otherwise(F.lit(-1))
            more, less = F.get(state["counts"], enters), F.get(state["counts"], leaves)
            change = _log_sum(more + 1) - _log_sum(more) + F.when(leaves >= 0, _log_sum(less - 1) - _log_sum(less)).otherwise(F.lit(0.0))
            terms = state["terms"] + F.when(enters == leaves, F.lit(0.0)).otherwise(change)
            counts = F.transform(
                state["counts"],
                lambda c, at: c + F.when(at == enters, F.lit(1)).otherwise(F.lit(0)) - F.when(at == leaves, F.lit(1)).otherwise(F.lit(0)),
            )
            # entropy = log2(window) - terms / window
            high = (i >= window - 1) & (F.log2(F.lit(float(window))) - terms / window >= kind.limit)
            return F.struct(
                counts.alias("counts"),
                terms.alias("terms"),
                F.when(high & (state["first"] < 0), i - (window - 1)).otherwise(state["first"]).alias("first"),
                F.when(high, i + 1).otherwise(state["last"]).alias("last"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), state, step, lambda s: F.struct(s["first"], s["last"]))

    letters = F.filter(F.split(match, ""), lambda c: c != "")
    places = F.transform(letters, lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    # One-element arrays name a value within an expression, so that it is made once.
    return F.transform(F.array(places), scan)[0]


def _with_entropy_spans(rows: DataFrame, name: str, kind: CharacterClass, allowed: tuple[str, ...]) -> DataFrame:
    """``rows`` with the spans of a class that meet no base span."""

    def wanted(span):
        held = sum((F.when(span["match"].rlike(p), 1).otherwise(0) for p in kind.needs), F.lit(0))
        fine = held >= min(2, len(kind.needs))
        for pattern in allowed:
            fine &= ~span["match"].rlike(pattern)
        return fine

    def part(span):
        return F.transform(
            F.array(high_entropy_part(span["match"], kind)),
            lambda high: F.struct(
                (span["start"] + high["first"]).alias("start"), span["kind"].alias("kind"), (span["start"] + high["last"]).alias("end"), high["last"].alias("last")
            ),
        )[0]

    rows = _with_spans(rows, "__candidates", kind.candidate, kind.kind)
    rows = rows.withColumn("__candidates", F.filter("__candidates", wanted))
    rows = _with_apart(rows, "__candidates", "__candidates", "base")
    high = F.filter(F.transform("__candidates", part), lambda s: s["last"] > 0)
    return rows.withColumn(name, F.transform(high, _plain)).drop("__candidates")


def _plain(span):
    return F.struct(span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``spans``, arrays of (start, kind, end) in
    code points, end exclusive, in order; kind is a place in ``KINDS``. ``spans`` holds the base
    spans too."""
    rows = text_rows(docs, key, text)
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    for kind, pattern in patterns.items():
        rows = _with_spans(rows, f"__{kind}", pattern, kind)
    long_enough = lambda s: F.char_length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGNED_LENGTH
    rows = rows.withColumn("__assign", F.filter("__assign", long_enough))
    base = F.concat(*[F.transform(f"__{kind}", _plain) for kind in patterns])
    rows = rows.withColumn("base", F.array_sort(base)).drop(*[f"__{kind}" for kind in patterns])
    # A string may be a candidate of both classes; the first class keeps it.
    first, second = CLASSES
    rows = _with_entropy_spans(rows, "hex_added", first, allowed)
    rows = _with_entropy_spans(rows, "text_added", second, allowed)
    rows = _with_apart(rows, "text_added", "text_added", "hex_added")
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", "hex_added", "text_added")))
    # Rows pass through a generator, behind which filters on the spans are not written into all that makes them.
    return rows.select("doc_id", F.inline(F.array(F.struct("base", "spans"))))


def span_text(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def span_count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
