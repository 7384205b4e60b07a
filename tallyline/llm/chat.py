"""Chat formatting: records of many layouts become canonical turns, marked text with a loss mask. DataFrame functions only.

A record is JSON. The paths of its fields, without the types of their values, make a fingerprint that selects the
layout's mapping; fields that a layout does not name are left out where the whole fingerprint is unknown. A turn is written as <s>[INST]role[/INST]text</s>. In role and text every <, [ and backslash is
followed by a backslash, so no control string can appear there, and taking that backslash away gives the text back.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, HEAD, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LEARNED = "assistant"
TYPES = r"\b(STRING|VOID|BOOLEAN|TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\s*\d+\)|VARIANT)(?=[,>]|$)"
#: How deep fields of no layout may be nested, lists and objects counted.
DEPTH = 4


@dataclass(frozen=True)
class Layout:
    """One shape of record. Either `turns`: (role, field) in order, or a list at `each` of objects with role and text."""

    name: str
    example: str
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", '{"messages":[{"role":"","content":""}]}', each="$.messages"),
    Layout("conversations", '{"conversations":[{"from":"","value":""}]}', each="$.conversations", role="from",
           text="value", roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", '{"prompt":"","response":""}', turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("completion", '{"prompt":"","completion":""}', turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", '{"instruction":"","input":"","output":""}',
           turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("task", '{"instruction":"","output":""}', turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("turn", '{"role":"","text":""}', each="$", text="text"),
)


def field_paths(record: Column) -> Column:
    """The nested field paths of a JSON text, every plain value as _; null where it is no JSON."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), TYPES, "_")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON text; null where it is no JSON."""
    return F.xxhash64(field_paths(record))


def _without_others(paths: Column, layout: Layout) -> Column:
    """The paths without the fields that `layout` does not name."""
    names = {layout.role, layout.text, layout.each.removeprefix("$.")} if layout.each else {f for _, f in layout.turns}
    own = "|".join(sorted(names - {"$"}))
    other = rf"(?<=[< ])(?!(?:{own}): )(?:`[^`]*`|[^<>,:` ]+): (?:_|OBJECT<>)(?:, |(?=>))"
    for _ in range(DEPTH):
        paths = F.regexp_replace(paths, r"(?<=: )ARRAY<(?:_|OBJECT<>|ARRAY<_>)>", "_")
        paths = F.regexp_replace(F.regexp_replace(paths, other, ""), ", >", ">")
    return paths


def _turns(layout: Layout, record: Column) -> Column:
    value = F.try_parse_json(record)
    if layout.turns:
        return F.array(*[F.struct(F.lit(role).alias("role"), F.try_variant_get(value, f"$.{field}", "string").alias("text"))
                         for role, field in layout.turns])
    if layout.each == "$":
        items = F.array(F.struct(F.try_variant_get(value, f"$.{layout.role}", "string").alias("role"),
                                 F.try_variant_get(value, f"$.{layout.text}", "string").alias("text")))
    else:
        kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
        items = F.transform(F.try_variant_get(value, layout.each, kind),
                            lambda t: F.struct(t[layout.role].alias("role"), t[layout.text].alias("text")))
    if not layout.roles:
        return items
    names = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair])
    return F.transform(items, lambda t: F.struct(F.coalesce(names[t["role"]], t["role"]).alias("role"), t["text"]))


def canonical_turns(records: DataFrame, key: str, order: str, record: str,
                    layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(`key`, `order`, place, layout, role, text): a row for every turn of every record, by the layout's mapping.

    The layout is the one of the record's fingerprint; else the first of `layouts` whose fingerprint the record has without the
    fields that the layout does not name, so the layouts with more fields come first. Null roles and texts are empty. A
    record without turns, of unknown layout or without JSON gives one row with a null place, role and text, so that nothing
    is lost unseen; its layout is null unless it is known.
    """
    base = records.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(record).alias("record"),
                          field_paths(F.col(record)).alias("paths"))
    named = F.lit(None).cast("string")
    for whole in (False, True):
        for layout in reversed(layouts):
            paths = F.col("paths") if whole else _without_others(F.col("paths"), layout)
            named = F.when(F.xxhash64(paths) == fingerprint(F.lit(layout.example)), layout.name).otherwise(named)
    known = base.select("key", "order", "record", named.alias("layout"))
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, _turns(layout, F.col("record"))).otherwise(turns)
    each = known.select("key", "order", "layout", F.posexplode_outer(turns).alias("place", "turn"))
    filled = [F.when(F.col("place").isNotNull(), F.coalesce(F.col(f"turn.{c}"), F.lit(""))).alias(c) for c in ("role", "text")]
    return each.select(F.col("key").alias(key), F.col("order").alias(order), "place", "layout", *filled)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_turns(turns: DataFrame, key: str, order: str, place: str = "place") -> DataFrame:
    """(`key`, formatted, loss): a conversation as one text, and the code-point spans that count for the loss.

    Turns go by (`order`, `place`, role, text), nulls first; equal rows are turns of their own. Rows with a null role and
    text make no turn; a conversation of such rows only has an empty text. loss: array of (start, stop, turn, at), stop exclusive,
    one per assistant turn: the span starts `at` code points into the turn of that number (from 0). Offsets come from a
    running sum over rows, so only the result itself is put into one row.
    """
    real = F.col("role").isNotNull()
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD))
    rows = turns.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(place).alias("place"), "role", "text",
                        real.cast("int").alias("real"), F.when(real, head).otherwise("").alias("head"),
                        F.when(real, F.concat(escape(F.col("text")), F.lit(CLOSE))).otherwise("").alias("body"))
    by = Window.partitionBy("key").orderBy("order", "place", "role", "text")
    size = F.char_length("head") + F.char_length("body")
    placed = (rows.withColumn("n", F.row_number().over(by))
              .withColumn("stop", F.sum(size.cast("long")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("turn", F.sum("real").over(by.rowsBetween(Window.unboundedPreceding, 0)) - 1)
              .select("key", "n", F.concat("head", "body").alias("piece"),
                      F.when(F.col("role") == LEARNED, F.struct(
                          (F.col("stop") - F.char_length("body")).alias("start"),
                          (F.col("stop") - len(CLOSE)).alias("stop"), F.col("turn").cast("int").alias("turn"),
                          F.char_length("head").alias("at"))).alias("span")))
    whole = placed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "piece", "span"))).alias("parts"))
    return whole.select(F.col("key").alias(key), F.array_join("parts.piece", "").alias("formatted"),
                        F.filter("parts.span", lambda s: s.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    pieces = F.split(formatted, CLOSE, -1)

    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(OPEN) + 1))
        cut = F.instr(inner, HEAD)
        return F.struct(unescape(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(inner, cut + len(HEAD))).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, in order, unescaped. The text is cut into its turns once, so that a span is looked up in
    its own turn and not from the start of a long conversation."""
    once = F.array(F.struct(F.split(formatted, CLOSE, -1).alias("turns"), loss.alias("loss")))

    def spans(c: Column) -> Column:
        return F.transform(c["loss"], lambda s: F.substring(c["turns"][s["turn"]], s["at"] + 1, (s["stop"] - s["start"]).cast("int")))

    return unescape(F.array_join(F.transform(once, spans)[0], ""))
