"""Chat formatting by schema fingerprints, in DataFrame functions only.

Training chats come as rows of turns, as message lists, as prompt and response or as instruction, input and output. The nested field paths
of a record, written as one shape string, are hashed; the hash selects a declarative mapping to canonical turns (role, text).
A frame's shape comes from its schema, a JSON record's from its values along the mapping's own paths, so layouts can mix within a table. Before it's compared with a mapping, a shape is
narrowed to the fields that the mapping knows, level by level, so extra fields do no harm, wherever they are, whatever they're called and however deep they go; of mappings that fit, the one of most fields is taken.
Records whose shape no mapping has are returned with status ``unmapped``, not dropped; so are those in which a list or an object stands where a text belongs, in a message or as input or system text. A null system text is no turn.

Template: ``<turn ROLE>``, newline, text, newline, ``</turn>``, newline. In a text, a backslash goes before every backslash and before
a ``<`` that begins ``<turn`` or ``</turn``, so the end mark between newlines never occurs within a text; roles are percent-encoded
where they hold ``%``, ``>`` or a newline. Both are undone exactly. The loss mask lists the spans of assistant texts.

Defined results: null texts and roles count as empty; turns are ordered by turn, equal ones by role and text, a null turn first; repeated rows are turns of their own.
Rows with a null conv_id are one conversation. Very long texts are formatted whole. An empty table gives no rows. A conversation is one
string, so its turns meet in one task; that is the result's own shape.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "conv_id"
ASSISTANT = "assistant"
OPEN, BODY, CLOSE = "<turn ", ">\n", "\n</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


def shape(kind: T.DataType) -> str:
    """Field names in order, nesting, and _ for every plain value: what is hashed."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f"{f.name}: {shape(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{shape(kind.elementType)}>"
    return "_"


def narrowed(kind: T.DataType, like: T.DataType) -> T.DataType:
    """A type without the fields that like doesn't have, at any depth."""
    if isinstance(kind, T.StructType) and isinstance(like, T.StructType):
        known = {f.name: f.dataType for f in like.fields}
        return T.StructType([T.StructField(f.name, narrowed(f.dataType, known[f.name])) for f in kind.fields if f.name in known])
    if isinstance(kind, T.ArrayType) and isinstance(like, T.ArrayType):
        return T.ArrayType(narrowed(kind.elementType, like.elementType))
    return kind


def fingerprint(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"))


def _nonblank(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


# The roles that other layouts use for ours.
ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


def _role(role: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), role), role)


def kind_of(spec) -> T.DataType:
    """A type from a sample: a dict of fields, a list of one element, or anything for a string."""
    if isinstance(spec, dict):
        return T.StructType([T.StructField(k, kind_of(v)) for k, v in spec.items()])
    return T.ArrayType(kind_of(spec[0])) if isinstance(spec, list) else T.StringType()


@dataclass(frozen=True)
class Layout:
    """A mapping: a sample of the fields, and how a record (a function from a field to its column) becomes an array of turns."""

    name: str
    fields: dict
    turns: Callable[[Callable[[str], Column]], Column]

    @property
    def schema(self) -> T.StructType:
        return kind_of(self.fields)

    @property
    def fingerprint(self) -> str:
        return fingerprint(shape(self.schema))


def _messages(list_field: str, role: str, text: str):
    return lambda f: F.transform(f(list_field), lambda m: F.struct(_role(m[role]).alias("role"), m[text].alias("text")))


def _asked(f: Callable[[str], Column]) -> Column:
    """An instruction with its input, where there is one."""
    both = F.concat(F.coalesce(f("instruction"), F.lit("")), F.lit("\n\n"), f("input"))
    return _turn("user", F.when(_nonblank(f("input")), both).otherwise(f("instruction")))


def _told(name: str, user: str, answer: str) -> list[Layout]:
    """A question and its answer, with and without a system text."""
    plain = lambda f: F.array(_turn("user", f(user)), _turn(ASSISTANT, f(answer)))
    with_system = lambda f: F.concat(_SYSTEM(f), plain(f))
    return [Layout(f"{name}_system", {user: "", answer: "", "system": ""}, with_system), Layout(name, {user: "", answer: ""}, plain)]


_MESSAGES, _FROM = _messages("messages", "role", "content"), _messages("conversations", "from", "value")
#: A system text is a turn; null is none.
_SYSTEM = lambda f: F.when(f("system").isNotNull(), F.array(_turn("system", f("system")))).otherwise(F.array().cast(TURNS))
#: Mappings; of those that fit a record, the first with the most fields counts.
LAYOUTS = tuple(sorted((
    Layout("messages_system", {"messages": [{"role": "", "content": ""}], "system": ""}, lambda f: F.concat(_SYSTEM(f), _MESSAGES(f))),
    Layout("messages", {"messages": [{"role": "", "content": ""}]}, _MESSAGES),
    Layout("from_value_system", {"conversations": [{"from": "", "value": ""}], "system": ""}, lambda f: F.concat(_SYSTEM(f), _FROM(f))),
    Layout("from_value", {"conversations": [{"from": "", "value": ""}]}, _FROM),
    Layout("instruction_input_system", {"instruction": "", "input": "", "output": "", "system": ""}, lambda f: F.concat(_SYSTEM(f), F.array(_asked(f), _turn(ASSISTANT, f("output"))))),
    Layout("instruction_input", {"instruction": "", "input": "", "output": ""}, lambda f: F.array(_asked(f), _turn(ASSISTANT, f("output")))),
    *_told("instruction", "instruction", "output"),
    *_told("prompt_response", "prompt", "response"),
    *_told("prompt_completion", "prompt", "completion"),
    *_told("question_answer", "question", "answer"),
), key=lambda x: -len(x.fields)))
#: Rows of turns are a layout over several records.
ROWS = kind_of({"turn": "", "role": "", "text": ""})


def from_frame(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of a frame whose schema has a known shape, beside conv_id and any other columns."""
    own = T.StructType([f for f in df.schema if f.name != ID])
    if shape(narrowed(own, ROWS)) == shape(ROWS):
        return df.select(ID, F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    for x in LAYOUTS:
        if fingerprint(shape(narrowed(own, x.schema))) == x.fingerprint:
            return df.select(ID, F.posexplode(x.turns(F.col)).alias("__k", "__t")).select(ID, F.col("__k").cast("long").alias("turn"), F.col("__t.role").alias("role"), F.col("__t.text").alias("text"))
    raise ValueError(f"no mapping for the shape {shape(own)}")


def shape_by_paths(values: Column, like: T.DataType) -> Column:
    """The shape string of JSON values (array<variant>) as far as a type's own paths go: every other field may be anything. A field is there where any of the values has it. Something nested where a plain value belongs, or the
    other way round, is X, which no type has."""
    kind = lambda v: F.substring(F.schema_of_variant(v), 1, 5)
    none = F.array().cast("array<variant>")
    if isinstance(like, T.StructType):

        def field(f: T.StructField) -> Column:
            own = F.filter(F.transform(values, lambda v: F.try_variant_get(v, f"$.{f.name}", "variant")), lambda v: v.isNotNull())
            return F.when(F.size(own) > 0, F.concat(F.lit(f"{f.name}: "), shape_by_paths(own, f.dataType)))

        inner = F.array_join(F.array(*[field(f) for f in sorted(like.fields, key=lambda f: f.name)]), ", ")
        return F.when(F.forall(values, lambda v: kind(v) == "OBJEC"), F.concat(F.lit("OBJECT<"), inner, F.lit(">"))).otherwise("X")
    if isinstance(like, T.ArrayType):
        items = F.flatten(F.transform(values, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), none)))
        inside = F.when(F.size(items) > 0, shape_by_paths(items, like.elementType)).otherwise("_")
        return F.when(F.forall(values, lambda v: kind(v) == "ARRAY"), F.concat(F.lit("ARRAY<"), inside, F.lit(">"))).otherwise("X")
    return F.when(F.exists(values, lambda v: kind(v).isin("OBJEC", "ARRAY")), "X").otherwise("_")


#: Fields that several layouts have and others lack: a record in which one is nested has no mapping, as another layout would lose what it says.
OPTIONAL = kind_of({"input": "", "system": ""})


def from_json(df: DataFrame, record: str = "record") -> DataFrame:
    """conv_id, layout (null: unmapped), status, turns of each JSON record; the layout is chosen row by row."""
    parsed = df.select(ID, F.try_parse_json(record).alias("v")).withColumn("vs", F.array("v"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    lost = shape_by_paths(F.col("vs"), OPTIONAL).contains("X")
    for x in reversed(LAYOUTS):
        kinds = {f.name: f.dataType.simpleString() for f in x.schema}
        mapped = x.turns(lambda name, kinds=kinds: F.try_variant_get(F.col("v"), f"$.{name}", kinds[name])).cast(TURNS)
        hit = F.col("v").isNotNull() & ~lost & (F.substring(F.sha2(shape_by_paths(F.col("vs"), x.schema), 256), 1, 16) == x.fingerprint)
        layout, turns = F.when(hit, F.lit(x.name)).otherwise(layout), F.when(hit, mapped).otherwise(turns)
    return parsed.select(ID, layout.alias("layout"), F.when(layout.isNull(), "unmapped").otherwise("mapped").alias("status"), turns.alias("turns"))


def explode_turns(mapped: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the mapped records."""
    return mapped.where("status = 'mapped'").select(ID, F.posexplode("turns").alias("turn", "t")).select(ID, F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|<(?=/?turn))", r"\\$1")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\|<)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit(">"), F.lit("%3E")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%3E"), F.lit(">")), F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: array of (turn from 0, at: first code point in formatted, skip: the same within the turn, n: code points)."""
    plain = turns.select(ID, "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    parts = plain.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(BODY))).withColumn("body", escape_text(F.col("text")))
    order = Window.partitionBy(ID).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    size = F.char_length("head") + F.char_length("body") + len(CLOSE)
    # in order of the window; the number makes the order explicit for the group
    placed = parts.withColumn("k", F.row_number().over(order) - 1).withColumn("at", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size)
    piece = F.struct("k", "role", "at", F.char_length("head").alias("skip"), F.char_length("body").alias("n"), F.concat("head", "body", F.lit(CLOSE)).alias("s"))
    whole = placed.groupBy(ID).agg(F.array_sort(F.collect_list(piece)).alias("p"))
    loss = F.transform(F.filter("p", lambda x: x["role"] == ASSISTANT), lambda x: F.struct(x["k"].alias("turn"), (x["at"] + x["skip"]).alias("at"), x["skip"].alias("skip"), x["n"].alias("n")))
    return whole.select(ID, F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"), loss.alias("loss"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, parsed back from formatted and its loss mask."""
    pieces = F.split("formatted", CLOSE, -1)
    cut = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))
    head = lambda s: F.substring_index(s, BODY, 1)
    turn = lambda s: F.struct(unescape_role(head(s).substr(F.lit(len(OPEN) + 1), F.char_length(s))).alias("role"), unescape_text(s.substr(F.char_length(head(s)) + len(BODY) + 1, F.char_length(s))).alias("text"))
    masked = F.transform("loss", lambda m: unescape_text(F.get("pieces", m["turn"]).substr(m["skip"] + 1, m["n"])))
    return cut.select(ID, F.transform("pieces", turn).alias("turns"), F.array_join(masked, "").alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
