"""JSON values of unknown shape: typed looks at VARIANT columns, text of message contents (all JVM-side).

A key may hold a string in one row and a list of blocks in the next, so nothing is inferred: each look asks for one type
and is null for the others.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space when texts are stripped.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"

# Keys of a tool's input that its summary shows, in this order; longest value and longest summary.
TOOL_KEYS = ("command", "description", "path", "pattern", "query", "url", "glob_pattern", "target_directory", "working_directory")
TOOL_VALUE, TOOL_SUMMARY = 120, 480
USER_QUERY = r"(?s)<user_query>\s*(.*?)\s*</user_query>"


def row() -> Column:
    """The column that holds a row's JSON value."""
    return F.col("v")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def any_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text_at(v: Column, path: str) -> Column:
    """The value if it is a string."""
    x = any_at(v, path)
    return F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(v, path, "string"))


def scalar_at(v: Column, path: str) -> Column:
    """The value as text, whatever it is; null if missing or null."""
    return F.try_variant_get(v, path, "string")


def list_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def dict_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "map<string,variant>")


def is_dict(v: Column) -> Column:
    return dict_at(v, "$").isNotNull()


def truthy(v: Column, path: str) -> Column:
    """Present and neither null, false, zero, nor an empty string or list."""
    return F.coalesce(~scalar_at(v, path).isin("", "false", "0", "0.0", "[]", "{}"), F.lit(False))


def first_of(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def unwrap_query(text: Column) -> Column:
    """The first tagged user query, if there is one."""
    return F.when(text.rlike(USER_QUERY), strip(F.regexp_extract(text, USER_QUERY, 1))).otherwise(text)


def cut(text: Column, most: int) -> Column:
    """At most `most` characters, the last of them an ellipsis where something was cut."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 1)), F.lit("…"))).otherwise(text)


def tool_summary(inp: Column) -> Column:
    """Known keys as key=value, else the compact JSON."""
    def shown(key: str) -> Column:
        value = strip(scalar_at(inp, f"$.{key}"))
        short = F.when(F.length(value) > TOOL_VALUE, F.concat(F.left(value, F.lit(TOOL_VALUE - 3)), F.lit("…"))).otherwise(value)
        return F.when(scalar_at(inp, f"$.{key}") != "", F.concat(F.lit(f"{key}="), short))

    known = F.concat_ws(" ", *[shown(k) for k in TOOL_KEYS])
    plain = F.when(is_dict(inp), F.when(known != "", known).otherwise(F.to_json(inp))).otherwise(strip(scalar_at(inp, "$")))
    return F.coalesce(cut(plain, TOOL_SUMMARY), F.lit("None"))


def joined(blocks: Column, of) -> Column:
    """Non-empty texts of a list's elements, a line each; empty for null."""
    return F.coalesce(strip(F.array_join(F.filter(F.transform(blocks, lambda b: of(b)), lambda x: x != ""), "\n")), F.lit(""))


def block_text(block: Column, kinds: tuple[str, ...] = ("text",)) -> Column:
    """The text of a block of one of these types."""
    return F.when(text_at(block, "$.type").isin(*kinds), scalar_at(block, "$.text"))


def loose_text(block: Column) -> Column:
    """The text of any block that has one."""
    return scalar_at(block, "$.text")


def text_or_content(block: Column) -> Column:
    return first_of(scalar_at(block, "$.text"), scalar_at(block, "$.content"))


def any_string(x: Column) -> Column:
    """A list's element written out, whatever it is."""
    return scalar_at(x, "$")


def content_text(v: Column, path: str, of=block_text) -> Column:
    """A message's content: a string, or a list of blocks; empty for others."""
    return F.when(text_at(v, path).isNotNull(), strip(text_at(v, path))).otherwise(joined(list_at(v, path), of))


def blocks_with_tools(blocks: Column, include: bool = True) -> Column:
    """Text blocks with unwrapped queries and, if asked for, tool calls summarised."""
    def of(b: Column) -> Column:
        tool = F.concat(F.lit("[tool "), first_of(scalar_at(b, "$.name"), F.lit("tool")), F.lit("] "), tool_summary(any_at(b, "$.input")))
        text = F.when(text_at(b, "$.type") == "text", unwrap_query(F.coalesce(scalar_at(b, "$.text"), F.lit(""))))
        return text.when(text_at(b, "$.type") == "tool_use", tool) if include else text

    return joined(blocks, of)


def has_tool(blocks: Column) -> Column:
    return F.coalesce(F.exists(blocks, lambda b: text_at(b, "$.type") == "tool_use"), F.lit(False))


def spoken_content(v: Column, path: str) -> Column:
    """A string with its query unwrapped, or blocks with tools."""
    text = text_at(v, path)
    return F.when(text.isNotNull(), unwrap_query(strip(text))).otherwise(blocks_with_tools(list_at(v, path)))


def speaker(v: Column) -> Column:
    """User or assistant from role, type or message.role; human counts as user."""
    def known(c: Column) -> Column:
        low = F.lower(c)
        return F.when(low.isin("user", "human"), "user").when(low == "assistant", "assistant")

    return F.coalesce(*[known(text_at(v, p)) for p in ("$.role", "$.type", "$.message.role")])


def parts_text(v: Column, parts: Column) -> Column:
    """Text parts one after the other, else the record's own text."""
    each = F.transform(F.filter(parts, lambda p: text_at(p, "$.type") == "text"), lambda p: F.coalesce(scalar_at(p, "$.text"), F.lit("")))
    return F.when(parts.isNotNull(), strip(F.array_join(each, "\n"))).otherwise(F.coalesce(strip(text_at(v, "$.text")), F.lit("")))


def dataset_text(v: Column, path: str = "$") -> Column:
    """A message content of a public dataset: a string; a list of strings and blocks; a block; others as they are written."""
    def part(x: Column) -> Column:
        own = first_of(text_at(x, "$.text"), text_at(x, "$.content"), text_at(x, "$.value"))
        return F.coalesce(strip(F.coalesce(text_at(x, "$"), own)), F.lit(""))

    nested = first_of(text_at(v, f"{path}.text"), text_at(v, f"{path}.content"))
    out = F.when(text_at(v, path).isNotNull(), strip(text_at(v, path))).when(list_at(v, path).isNotNull(), joined(list_at(v, path), part))
    return F.coalesce(out.when(nested.isNotNull(), strip(nested)).otherwise(strip(scalar_at(v, path))), F.lit(""))


def first_text(v: Column, *keys: str) -> Column:
    """The first key that holds a non-blank string, or a block with one; empty if none does."""
    def of(x: Column) -> Column:
        return strip(F.coalesce(text_at(x, "$"), first_of(text_at(x, "$.text"), text_at(x, "$.content"))))

    texts = F.transform(F.array(*[any_at(v, f"$.{k}") for k in keys]), of)
    return F.coalesce(F.get(F.filter(texts, lambda t: t != ""), F.lit(0)), F.lit(""))


def messages_at(v: Column, *keys: str) -> Column:
    """A list of messages, also where it is written as a JSON string; null if it is neither."""
    looks = []
    for k in keys:
        looks += [list_at(v, f"$.{k}"), F.try_variant_get(F.try_parse_json(text_at(v, f"$.{k}")), "$", "array<variant>")]
    return F.coalesce(*looks)
