"""JSON held in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.bind import let

_JSON_PIECE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[,:]|[^",:]+'


def is_json(text: Column) -> Column:
    """True when the whole text is one JSON value.

    Spark's parsers stop after the first value; wrapping the text makes trailing characters an
    error. Text that closes one kind of wrapper early cannot close the other as well. Null
    text gives false.
    """
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,string>", strict)
    return F.coalesce((F.size(listed) == 1) & (F.size(member) == 1), F.lit(False))


def is_json_object(text: Column) -> Column:
    return is_json(text) & F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))


def spaced(compact: Column) -> Column:
    """Rewrite compact JSON with a space after every comma and colon outside strings."""
    pieces = F.regexp_extract_all(compact, F.lit(_JSON_PIECE), F.lit(0))
    return F.array_join(
        F.transform(pieces, lambda p: F.when(p.isin(",", ":"), F.concat(p, F.lit(" "))).otherwise(p)), ""
    )


def field_kind(text: Column, path: str) -> Column:
    """Type name of a JSON field: STRING, BIGINT, OBJECT<…>, ARRAY<…>, VOID …; null if missing."""
    variant = F.try_parse_json(text)
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def field_json(text: Column, path: str, missing: str) -> Column:
    """A JSON field written back as JSON text: key order kept, strings quoted, standard spacing."""

    def render(kind: Column) -> Column:
        raw = F.get_json_object(text, path)
        quoted = F.regexp_extract(
            F.to_json(F.struct(raw.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1
        )
        return (
            F.when(kind.isNull(), F.lit(missing))
            .when(kind == "VOID", F.lit("null"))
            .when(kind == "STRING", quoted)
            .otherwise(spaced(raw))
        )

    return let(field_kind(text, path), render)


def last_member(text: Column, name: str) -> Column:
    """A member of a JSON object as text; of several with that name the last. Null if missing."""
    members = F.map_entries(F.from_json(text, "map<string,string>"))
    return F.try_element_at(F.filter(members, lambda m: m["key"] == name), F.lit(-1))["value"]


_JSON_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^\s{}\[\],:"]+'
_OPEN = "struct<kind:string,names:array<string>,keys:array<string>,values:array<string>,key:string>"


def last_values(text: Column) -> Column:
    """Valid JSON in which every repeated key has its last value, at its first place, at any depth.

    A fold over the tokens. The state is a stack of the objects and arrays open at a token, with the members they have so far;
    one that closes is written out and becomes a value of the one around it.
    """
    texts = F.array().cast("array<string>")

    def opened(kind: Column, names: Column, keys: Column, values: Column, key: Column) -> Column:
        parts = [kind.alias("kind"), names.alias("names"), keys.alias("keys"), values.alias("values"), key.cast("string").alias("key")]
        return F.struct(*parts).cast(_OPEN)

    def with_key(o: Column, key: Column) -> Column:
        return opened(o["kind"], o["names"], o["keys"], o["values"], key)

    def name_of(key: Column) -> Column:
        """The key without quotes and escapes."""
        return F.get(F.from_json(F.concat(F.lit("["), key, F.lit("]")), "array<string>"), F.lit(0))

    def with_value(o: Column, value: Column) -> Column:
        def put(name: Column) -> Column:
            place = F.array_position(o["names"], name)
            new = place.isNull() | (place == 0)
            replaced = F.transform(o["values"], lambda v, i: F.when(i + 1 == place, value).otherwise(v))
            return F.when(
                new, opened(o["kind"], F.concat(o["names"], F.array(name)), F.concat(o["keys"], F.array(o["key"])), F.concat(o["values"], F.array(value)), F.lit(None))
            ).otherwise(opened(o["kind"], o["names"], o["keys"], replaced, F.lit(None)))

        listed = opened(o["kind"], texts, texts, F.concat(o["values"], F.array(value)), F.lit(None))
        return F.when(o["kind"] == "{", let(name_of(o["key"]), put)).otherwise(listed)

    def closed(o: Column) -> Column:
        members = F.zip_with(o["keys"], o["values"], lambda k, v: F.concat(k, F.lit(": "), v))
        whole = F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
        return F.when(o["kind"] == "{", whole).otherwise(F.concat(F.lit("["), F.array_join(o["values"], ", "), F.lit("]")))

    def inner(stack: Column) -> Column:
        return F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))

    def with_top(stack: Column, o: Column) -> Column:
        return F.concat(inner(stack), F.array(o))

    def step(stack: Column, token: Column) -> Column:
        """The bottom of the stack is an array that takes the whole text as its one value."""
        top = F.element_at(stack, -1)
        awaits_key = (top["kind"] == "{") & top["key"].isNull()
        below = inner(stack)
        return (
            F.when(token.isin("{", "["), F.concat(stack, F.array(opened(token, texts, texts, texts, F.lit(None)))))
            .when(token.isin("}", "]"), with_top(below, with_value(F.element_at(below, -1), closed(top))))
            .when(token.isin(",", ":"), stack)
            .when(awaits_key, with_top(stack, with_key(top, token)))
            .otherwise(with_top(stack, with_value(top, token)))
        )

    bottom = F.array(opened(F.lit("["), texts, texts, texts, F.lit(None)))
    tokens = F.regexp_extract_all(text, F.lit(_JSON_TOKEN), F.lit(0))
    return F.aggregate(tokens, bottom, step, lambda stack: F.get(F.element_at(stack, 1)["values"], F.lit(0)))


def without_repeats(text: Column) -> Column:
    """``last_values`` of a JSON object in which some key repeats at some depth; others stay as written."""
    repeats = is_json_object(text) & F.try_parse_json(text).isNull()
    return F.when(repeats, last_values(F.when(repeats, text))).otherwise(text)


def one_value_per_key(call: Column) -> Column:
    """A tool call's JSON object as it is, or if keys repeat in it, its name and arguments by their last values."""

    def rebuild(name: Column, raw: Column) -> Column:
        parts = F.to_json(F.struct(name.alias("name"), F.when(~is_json_object(raw), raw).alias("arguments")))
        whole = F.concat(F.regexp_replace(parts, r"\}$", ""), F.lit(',"arguments":'), without_repeats(raw), F.lit("}"))
        return F.when(is_json_object(raw), whole).otherwise(parts)

    def repaired() -> Column:
        return let(last_member(call, "name"), lambda n: let(last_member(call, "arguments"), lambda r: rebuild(n, r)))

    return F.when(F.try_parse_json(call).isNull(), F.coalesce(repaired(), call)).otherwise(call)


def argument_object(text: Column) -> Column:
    """The ``arguments`` member as JSON object text, whether it was an object or a JSON string.

    Repeated keys take their last value. Anything unusable becomes ``{}``.
    """
    raw = last_member(text, "arguments")
    return let(raw, lambda r: F.when(~is_json_object(r), F.lit("{}")).when(F.try_parse_json(r).isNull(), without_repeats(r)).otherwise(r))


def python_truthy(json_text: Column, path: str) -> Column:
    """Truth of a JSON field: missing, null, false, zero and empty values are false."""
    kind = field_kind(json_text, path)
    raw = F.get_json_object(json_text, path)
    numeric = raw.try_cast("double")
    return F.coalesce(
        F.when(kind.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "BOOLEAN", raw == "true")
        .when(kind == "STRING", F.length(raw) > 0)
        .when(F.startswith(kind, F.lit("OBJECT")), raw != "{}")
        .when(F.startswith(kind, F.lit("ARRAY")), raw != "[]")
        .otherwise(numeric != 0.0),
        F.lit(False),
    )


def not_null(json_text: Column, path: str) -> Column:
    kind = field_kind(json_text, path)
    return F.coalesce(kind != "VOID", F.lit(False))


def any_flag(*flags: Column) -> Column:
    """First true flag wins; null counts as false."""
    result = F.lit(False)
    for flag in flags:
        result = result | F.coalesce(flag, F.lit(False))
    return result


def get_or(mapping: Column, key: Column, default: Column) -> Column:
    """Map lookup with a default for missing keys."""
    return F.coalesce(F.try_element_at(mapping, key), default)
