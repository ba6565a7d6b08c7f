"""Column helpers for term records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..schemas import DISCARD, ERROR

_STRIP = r"(?U)^\s+|\s+$"


def ustrip(c: Column) -> Column:
    """Without white space at either end, Unicode's included."""
    return F.regexp_replace(c, _STRIP, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def ensure_prefix(c: Column, prefix: str) -> Column:
    """With the prefix, once; null stays null."""
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def unescape_breaks(c: Column) -> Column:
    r"""Literal ``\n`` and ``\r`` become line breaks."""
    return F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))


def as_list(c: Column) -> Column:
    """A scalar as a list of one; null and blank as the empty list."""
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.array(c))


def scalar_or_list(raw: Column, path: str) -> Column:
    """The value at a JSON path as a list, whether it is written as a scalar or as a list; blank members go."""
    v = F.get_json_object(raw, path)
    listed = F.when(F.ltrim(v).startswith("["), F.from_json(v, "array<string>")).otherwise(as_list(v))
    return F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def key_or_default(raw: Column, key: str, default: str = ERROR) -> Column:
    """A JSON object's value, or the default where the key is absent; a null value stays null."""
    return F.when(F.array_contains(F.json_object_keys(raw), key), F.get_json_object(raw, f"$.{key}")).otherwise(F.lit(default))


def is_kept(term: Column) -> Column:
    """Not marked as discarded."""
    return F.coalesce(term != DISCARD, F.lit(True))


def missing_keys(raw: Column, keys: Sequence[str]) -> Column:
    """Mandatory keys that a JSON object lacks; null where the text is no object."""
    return F.array_except(F.array(*map(F.lit, keys)), F.json_object_keys(raw))


_STRING = r'"(?:[^"\\]|\\.)*"'
_DECIMAL = r"(-?[0-9]+(?:\.[0-9]+(?:[eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+))"


def flatten_json_list(c: Column) -> Column:
    """The members of nested JSON lists, in order and at any depth, as strings; a scalar alone is a list of one.

    Lists are opened level by level as VARIANT values, as many times as the brackets go
    deep, so a string that looks like a list stays a string.  Decimal numbers are kept as they
    are written: they pass as marked strings.  What begins like a list and is no JSON is one member.
    """
    text = c.cast("string")
    pieces = F.regexp_extract_all(text, F.lit(_STRING + r'|[^"]+'), F.lit(0))
    marked = F.array_join(F.transform(pieces, lambda p: F.when(p.startswith('"'), p).otherwise(F.regexp_replace(p, _DECIMAL, r'"\\u0001$1"'))), "")
    ready = F.when(text.rlike(r"[0-9][.eE]"), marked).otherwise(text)
    step = F.transform(F.split(F.regexp_replace(F.regexp_replace(text, _STRING, ""), r"[^\[\]]", ""), ""), lambda b: F.when(b == "[", 1).when(b == "]", -1).otherwise(0))
    reached = F.aggregate(step, F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), lambda a, b: F.struct((a["at"] + b).alias("at"), F.greatest(a["most"], a["at"] + b).alias("most")))
    is_list = lambda x: F.schema_of_variant(x).startswith("ARRAY")
    opened = F.aggregate(
        F.sequence(F.lit(1), F.greatest(reached["most"], F.lit(1))), F.array(F.try_parse_json(ready)),
        lambda found, _: F.flatten(F.transform(found, lambda x: F.when(is_list(x), x.cast("array<variant>")).otherwise(F.array(x)))),
    )
    plain = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.regexp_replace(x.cast("string"), "^\u0001", "")).otherwise(F.regexp_replace(F.to_json(x), r'"\\u0001([^"]*)"', "$1"))
    members = F.transform(F.filter(opened, lambda x: ~F.is_variant_null(x)), plain)
    return F.when(text.isNull(), F.lit(None)).when(~F.ltrim(text).startswith("["), F.array(text)).when(F.try_parse_json(text).isNull(), F.array(text)).otherwise(members)


def content_list(c: Column) -> Column:
    """A JSON list of ``{src, content}`` objects or bare values as ``array<struct<src, content>>``; null if it is no list."""
    items = F.from_json(F.when(F.ltrim(c).startswith("["), c), "array<string>")

    def entry(x: Column) -> Column:
        made = F.from_json(x, "struct<src:string,content:string>")
        return F.when(F.ltrim(x).startswith("{"), F.struct(F.coalesce(made["src"], F.lit("")).alias("src"), F.coalesce(made["content"], F.lit("")).alias("content"))).otherwise(
            F.struct(F.lit("").alias("src"), F.coalesce(x, F.lit("")).alias("content"))
        )

    return F.transform(items, entry)


def distinct_members(lists: Column) -> Column:
    """The members of lists within a list, each once, where it came first."""
    return F.array_distinct(F.flatten(lists))


def document_text(term: Column, synonyms: Column, description: Column, uuid: Column) -> Column:
    """The text that a concept is indexed under."""
    return F.concat_ws(
        "\n", F.concat(F.lit("Term: "), F.coalesce(term, F.lit(""))), F.concat(F.lit("Exact Synonyms: "), F.to_json(F.coalesce(synonyms, F.array().cast("array<string>")))),
        F.concat(F.lit("Description: "), F.coalesce(description, F.lit(""))), F.concat(F.lit("Term UUID: "), F.coalesce(uuid, F.lit(""))),
    )


def parsed_document(text: Column) -> Column:
    """``struct<term, synonyms, description, uuid>`` out of ``document_text``."""
    field = lambda name: F.regexp_extract(text, rf"(?m)^{name}: (.*)$", 1)
    return F.struct(
        field("Term").alias("term"), F.from_json(field("Exact Synonyms"), "array<string>").alias("synonyms"), field("Description").alias("description"), field("Term UUID").alias("uuid")
    )


def with_synonym(synonyms: Column, term: Column) -> Column:
    """The list with one more term, unless it holds it."""
    old = F.coalesce(synonyms, F.array().cast("array<string>"))
    return F.when(term.isNull() | F.array_contains(old, term), old).otherwise(F.array_append(old, term))


def synonym_hint(synonyms: Column) -> Column:
    """`` (also known as: a, b)``, or nothing without synonyms."""
    return F.when(F.coalesce(F.size(synonyms), F.lit(0)) <= 0, F.lit("")).otherwise(F.concat(F.lit(" (also known as: "), F.array_join(synonyms, ", "), F.lit(")")))


def percent_encoded(c: Column, keep_slash: bool = True) -> Column:
    """Percent encoding as in URLs; Spark's own form encoding differs in four characters."""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), *((("%2F", "/"),) if keep_slash else ())):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def deep_link(base: Column, chapter: Column, text: Column, head: int = 35, tail: int = 36) -> Column:
    """A link to a passage: its first and last words as a text fragment.

    The head is cut back to the last space in it, the tail forward to the first; without a
    space, or in a short text, the whole stands.  One final full stop is dropped.
    """
    first = F.substring(text, 1, head)
    n = F.length(first) - F.instr(F.reverse(first), " ")
    first = F.when(F.instr(first, " ") > 0, F.substring(first, F.lit(1), n)).otherwise(first)
    last = F.when(F.length(text) > tail, F.substring(text, F.length(text) - tail + 1, F.lit(tail))).otherwise(text)
    last = F.when(F.instr(last, " ") > 0, F.substring(last, F.instr(last, " ") + 1, F.length(last))).otherwise(last)
    last = F.when(last.endswith("."), F.substring(last, F.lit(1), F.length(last) - 1)).otherwise(last)
    return F.concat(base, chapter, F.lit("/#:~:text="), percent_encoded(first), F.lit(","), percent_encoded(last))


def first_word(c: Column) -> Column:
    return F.get(F.split(ustrip(c), r"\s+"), 0)


def same_prefix(a: Column, b: Column, n: int = 4) -> Column:
    """Equal, or alike in their first lower-cased characters."""
    return (a == b) | (F.substring(F.lower(a), 1, n) == F.substring(F.lower(b), 1, n))


def stable_id(*parts: Column, prefix: str = "") -> Column:
    """An id that follows from its parts; unlike a random one it survives recomputation."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\u0001", *parts), 256), 1, 32))


def random_id() -> Column:
    return F.uuid()


def unfenced(text: Column) -> Column:
    """Model output without a code fence around it."""
    inner = F.regexp_extract(text, r"(?s)```[a-zA-Z]*\s*(.*?)\s*```", 1)
    return F.when(F.length(inner) > 0, inner).otherwise(F.trim(text))


def parsed_or(text: Column, schema: str, fallback: Column) -> Column:
    """Model output as a record, or the fallback where it is none."""
    body = unfenced(text)
    return F.when(F.json_object_keys(body).isNotNull(), F.from_json(body, schema)).otherwise(fallback)
