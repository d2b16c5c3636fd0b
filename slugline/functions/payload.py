"""Reading a webhook body: strict JSON into a VARIANT, then one typed projection of it."""

from pyspark.sql import Column, functions as F

# The parts of a payload that are read, in one cast. A key that is missing or of another type
# comes out NULL by itself. Texts are asked for as BINARY because that is the one target a JSON
# string converts to and a number, boolean, array or object does not.
_TIMES = "updatedAt: binary, updated_at: binary"
_OLD = f"struct<status: variant, {_TIMES}>"
_NEW = (
    f"struct<status: variant, {_TIMES}, draftValue: struct<createdAt: binary>,"
    " publishValue: struct<createdAt: binary, publishedAt: binary>>"
)
PAYLOAD = (
    "struct<service: binary, api: binary, id: binary, type: binary,"
    f" contents: struct<old: {_OLD}, new: {_NEW}>>"
)
ENVELOPE_FIELDS = ("service", "api", "id", "type", "contents")
CONTENT_SIDES = ("old", "new")
# The parser's limits lie beyond what a column value can hold, and its leniencies are off.
PARSER = {
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def parse_sealed(text: Column, seal: Column) -> Column:
    """The variant `[document, seal]`, or NULL unless `text` is exactly one JSON document.

    Spark's parser stops after the first complete value and ignores what follows it. Closing
    the text into an array whose last element must come back as `seal` turns that leniency
    into a check with a single parse. `seal` must be plain text the document cannot contain,
    such as a keyed digest of it.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]')), "variant", PARSER)


# A text that can repeat a field's key holds its quoted name twice, or spells a letter as an escape.
_NAMES = "|".join((*ENVELOPE_FIELDS, *CONTENT_SIDES))
_QUOTED_NAME = f'"(?:{_NAMES})"'
_ESCAPED_LETTER = r"\\u00[67]"


def _repeats(keys: Column, names: tuple[str, ...]) -> Column:
    """Whether one of `names` is twice among `keys`, which are computed once."""

    def counted(held: Column) -> Column:
        named = F.filter(held, lambda key: key.isin(*names))
        return F.size(named) > F.size(F.array_distinct(named))

    return F.get(F.transform(F.array(keys), counted), F.lit(0))


def repeats_envelope_key(text: Column) -> Column:
    """Whether a field of the envelope, or a side of its contents, is given twice.

    Keys that repeat anywhere else are free values of the sender: the last one counts. Read as a
    map, an object keeps its repeated keys, whatever the length of its values. That costs two more
    readings of the text, so it is left to texts that name a field twice at all or have an
    escape that could stand for a letter of a name; all others are settled by one search. NULL
    where the text can't be read.
    """
    quoted = F.regexp_extract_all(text, F.lit(_QUOTED_NAME), F.lit(0))
    twice = F.get(F.transform(F.array(quoted), lambda q: F.size(q) > F.size(F.array_distinct(q))), F.lit(0))
    fields = F.map_keys(F.from_json(text, "map<string,string>", PARSER))
    contents = F.from_json(text, "struct<contents: map<string,string>>", PARSER)["contents"]
    sides = F.coalesce(F.map_keys(contents), F.array().cast("array<string>"))
    repeated = _repeats(fields, ENVELOPE_FIELDS) | _repeats(sides, CONTENT_SIDES)
    return F.when(twice | text.rlike(_ESCAPED_LETTER), repeated).otherwise(False)


def sealed_by(parsed: Column, seal: Column) -> Column:
    return F.try_variant_get(parsed, "$[1]", "string") == seal


def payload_of(parsed: Column) -> Column:
    """The typed parts of a sealed document; NULL if it is no object."""
    return F.try_variant_get(parsed, "$[0]", PAYLOAD)


def has_envelope_types(parsed: Column, payload: Column) -> Column:
    """Whether every envelope field is of its type, JSON null or missing.

    A part that came out typed needs no second look; only one that did not is looked up again,
    to tell a missing value from one of a wrong type.
    """
    valid = payload.isNotNull()
    for name in ENVELOPE_FIELDS:
        value = F.try_variant_get(parsed, f"$[0].{name}", "variant")
        absent = value.isNull() | F.is_variant_null(value)
        valid = valid & F.when(payload[name].isNotNull(), True).otherwise(absent)
    return valid


def status_list(status: Column) -> Column:
    """A status as a sorted list without repeats: a string, or the strings of an array.

    NULL where it is neither.
    """
    single = F.try_variant_get(status, "$", "binary")
    listed = F.coalesce(
        F.try_variant_get(status, "$", "array<binary>"), F.when(single.isNotNull(), F.array(single))
    )
    nothing = F.array(F.lit(None).cast("string"))
    return F.sort_array(F.array_except(listed.cast("array<string>"), nothing))


def status_csv(statuses: Column) -> Column:
    return F.when(F.size(statuses) > 0, F.array_join(statuses, ","))


def updated_at_text(content: Column) -> Column:
    """The first of two spellings that holds a string."""
    return F.coalesce(content["updatedAt"], content["updated_at"]).cast("string")
