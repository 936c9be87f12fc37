"""Chat records of many layouts as one template.

A record is JSON. The fingerprint of its layout is a hash of its nested field paths (names and
nesting, in sorted order, without types and values); it selects one of the declared layouts, which
say where turns, roles and texts stand. What comes out are canonical turns (role, text).

The template writes a turn as ``<|turn|>role<|text|>text<|end|>`` and a line end. In roles and texts a
backslash, ``<`` and ``[`` are written as two characters each, so that no control string, of
this template or of others in use (``</s>``, ``[INST]``), can occur in a text, and every text can be
read back. The loss mask marks the texts of the trained roles, one span for each turn.

Everything is SQL functions inside a row.

Defined results: a record that is null, not JSON or of no declared layout has null turns and a null
output; its fingerprint is reported where it has one. A null or missing role or text counts as
empty. A record without turns gives the empty output. Repeated records each give an output. An empty
table gives an empty result. Other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
TURNS_TYPE = "array<struct<role:string,text:string>>"
TRAINED = ("assistant",)

# Role names that mean the same.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Either a list of turns at ``turns`` with its role and text fields, or single fields, each of
    which is a turn of the role given; several fields of one role in a row are one turn."""

    name: str
    fields: dict | None = None  # of single-field layouts: field -> role, in order of the turns
    turns: str = ""
    role: str = ""
    text: str = ""
    more: tuple[str, ...] = field(default=())  # further top-level fields, not used

    def paths(self, empty: bool = False) -> str:
        """Field paths as ``schema_of_variant`` writes them, without types."""
        if self.fields is not None:
            tops = {name: "" for name in self.fields}
        else:
            tops = {self.turns: ": ARRAY<>" if empty else f": ARRAY<OBJECT<{', '.join(sorted([self.role, self.text]))}>>"}
        tops |= {name: "" for name in self.more}
        return f"OBJECT<{', '.join(name + tops[name] for name in sorted(tops))}>"


LAYOUTS = (
    Layout("messages", turns="messages", role="role", text="content"),
    Layout("message texts", turns="messages", role="role", text="text"),
    Layout("shared conversations", turns="conversations", role="from", text="value"),
    Layout("dialogue turns", turns="dialogue", role="speaker", text="text"),
    Layout("prompt and response", {"prompt": "user", "response": "assistant"}),
    Layout("prompt and completion", {"prompt": "user", "completion": "assistant"}),
    Layout("question and answer", {"question": "user", "answer": "assistant"}),
    Layout("instruction", {"instruction": "user", "output": "assistant"}),
    Layout("instruction with input", {"instruction": "user", "input": "user", "output": "assistant"}),
    Layout("instruction with system", {"system": "system", "instruction": "user", "output": "assistant"}),
    Layout("system, prompt and response", {"system": "system", "prompt": "user", "response": "assistant"}),
)

_SCALARS = r"STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DATE|BINARY|UUID|TIMESTAMP_NTZ|TIMESTAMP|DECIMAL\([0-9]+,[0-9]+\)"


def field_paths(record: Column) -> Column:
    """Nested field names of a variant, sorted, without types."""
    paths = F.regexp_replace(F.schema_of_variant(record), f": (?:{_SCALARS})(?=[,>])", "")
    return F.regexp_replace(paths, f"<(?:{_SCALARS})>", "<>")


def layout_fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _turns(record: Column, layout: Layout, names: dict[str, str]) -> Column:
    if layout.fields is None:
        kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
        turns = F.try_variant_get(record, f"$.{layout.turns}", kind)
        role, text = (lambda t: F.coalesce(t[layout.role], F.lit(""))), (lambda t: F.coalesce(t[layout.text], F.lit("")))
        known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else None
        canonical = (lambda t: F.coalesce(F.try_element_at(known, role(t)), role(t))) if names else role
        return F.transform(turns, lambda t: F.struct(canonical(t).alias("role"), text(t).alias("text")))
    grouped: list[tuple[str, list[str]]] = []
    for name, role in layout.fields.items():
        if grouped and grouped[-1][0] == role:
            grouped[-1][1].append(name)
        else:
            grouped.append((role, [name]))
    value = lambda name: F.coalesce(F.try_variant_get(record, f"$.{name}", "string"), F.lit(""))
    texts = [value(names_[0]) if len(names_) == 1 else F.array_join(F.filter(F.array(*[value(n) for n in names_]), lambda x: x != ""), "\n\n") for _, names_ in grouped]
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("text")) for (role, _), text in zip(grouped, texts)])


def canonical_turns(records: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS, names: dict[str, str] = ROLE_NAMES) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` (its name) and ``turns`` from the JSON ``column``."""
    record = F.try_parse_json(column)
    rows = records.withColumn("__record", record)
    rows = rows.withColumn("fingerprint", F.when(F.col("__record").isNotNull(), layout_fingerprint(field_paths(F.col("__record")))))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS_TYPE)
    for layout in layouts:
        hashes = {layout.paths(), layout.paths(empty=True)}
        chosen = F.col("fingerprint").isin(*[layout_fingerprint(F.lit(p)) for p in sorted(hashes)])
        name = F.when(chosen, F.lit(layout.name)).otherwise(name)
        turns = F.when(chosen, _turns(F.col("__record"), layout, names).cast(TURNS_TYPE)).otherwise(turns)
    return rows.withColumns({"layout": name, "turns": turns}).drop("__record")


def escape(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    # Backslashes come in pairs from the left; between these pairs one stands before a letter.
    between = lambda part: F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), between), "\\")


def render(rows: DataFrame, turns: str = "turns", trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """``rows`` with ``formatted`` and ``loss``, the spans (start, end) in code points of the texts of
    the trained roles."""
    written = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("text"), t["role"].isin(*trained).alias("trained")
        ),
    )
    rows = rows.withColumn("__written", written)

    def step(state, turn):
        begin = state["at"] + F.char_length(turn["head"])
        end = begin + F.char_length(turn["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(turn["trained"], F.concat(state["loss"], span)).otherwise(state["loss"]).alias("loss"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    rows = rows.withColumns(
        {
            "formatted": F.when(F.col(turns).isNotNull(), F.array_join(F.transform("__written", lambda w: F.concat(w["head"], w["text"], F.lit(END))), "")),
            "loss": F.aggregate("__written", start, step, lambda s: s["loss"]),
        }
    )
    return rows.drop("__written")


def read_turns(formatted: str) -> Column:
    """Turns read back from the output."""
    parts = F.split(formatted, r"<\|end\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part):
        at = F.instr(part, F.lit(TEXT))
        role = F.substring(part, F.lit(len(TURN) + 1), at - (len(TURN) + 1))
        text = F.substring(part, at + len(TEXT), F.char_length(part))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: str, loss: str) -> Column:
    """Texts under the loss mask, read back from the output."""
    return F.transform(loss, lambda s: unescape(F.substring(F.col(formatted), s["start"] + 1, s["end"] - s["start"])))


def conversation_records(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Conversations given as one row per turn, as one JSON record each: (key, record). As in published
    sets, a plain question and answer has a layout of its own, with and without a system text;
    all others are lists of messages. Rows of equal turn are ordered by role, then text; a null
    key is a conversation too. A conversation is one output and so one row."""
    rows = rows.select(
        rows[key].alias("__key"),
        F.struct(rows[turn].alias("turn"), F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"), F.coalesce(rows[text].cast("string"), F.lit("")).alias("content")).alias("__turn"),
    )
    grouped = rows.groupBy("__key").agg(F.array_sort(F.collect_list("__turn")).alias("turns"))
    roles = F.array_join(F.transform("turns", lambda t: F.replace(t["role"], F.lit(","), F.lit(",,"))), ",")
    content = lambda i: F.get("turns", F.lit(i))["content"]
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    record = (
        F.when(roles == "user,assistant", F.to_json(F.struct(content(0).alias("prompt"), content(1).alias("response"))))
        .when(
            roles == "system,user,assistant",
            F.to_json(F.struct(content(0).alias("system"), content(1).alias("prompt"), content(2).alias("response"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select(F.col("__key").alias(key), record.alias("record"))
