"""Reading the answers of language models: verdicts, labels and fields in JSON that is often broken.

The outermost braces are taken, code fences removed, and the rest parsed
strictly: single quotes are an error, as is a second object behind the first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.binding import let

_STRICT = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def json_body(raw: Column, repair: bool = False) -> Column:
    """The text from the first to the last brace, or all of it, without code fences; one missing brace closed where asked."""
    found = let(F.regexp_extract(raw, r"(?s)\{.*\}", 0), lambda x: F.when(x != "", x).otherwise(raw))
    body = F.regexp_replace(F.regexp_replace(found, "```json|```", ""), r"(?U)^\s+|(?<!\s)\s+$", "")
    if not repair:
        return body

    def closed(text: Column) -> Column:
        count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
        return F.when(count("{") > count("}"), F.concat(text, F.lit("}"))).otherwise(text)

    return let(body, closed)


def single_object(body: Column) -> Column:
    """True for one JSON object with nothing behind it.

    The JVM's parser ends at the first object's brace.  Strings are taken out;
    the brackets that remain must close to depth 0 once, at the closing brace.
    """
    # Escapes go first, so that a string is a run without quotes, which the JVM matches without recursion.
    flat = F.regexp_replace(F.regexp_replace(body, r"(?s)\\.", ""), r'"[^"]*+"', "0")
    step = lambda c: F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"))
    after = lambda s, c: F.struct((s["depth"] + step(c)).alias("depth"), (s["closed"] + F.when((c != "") & (s["depth"] + step(c) == 0), 1).otherwise(0)).alias("closed"))

    def whole(text: Column) -> Column:
        end = F.aggregate(F.split(F.regexp_replace(text, r"[^{}\[\]]", ""), ""), start, after)
        return text.rlike(r"^\s*\{") & text.rlike(r"\}\s*$") & let(end, lambda e: (e["depth"] == 0) & (e["closed"] == 1))

    return let(flat, whole)


def json_field(raw: Column, field: str, repair: bool = False) -> Column:
    """Struct of ``parsed``, ``value`` and ``null``: whether the answer is one valid object, a field of it as text, and whether that is a JSON null.

    The body is taken out, parsed and held to be one object once for each row.
    """
    schema = f"`{field}` STRING, _bad STRING"

    def read(body: Column) -> Column:
        def fields(row: Column) -> Column:
            parsed = F.coalesce(row.isNotNull() & row["_bad"].isNull() & single_object(body), F.lit(False))
            return let(
                parsed,
                lambda ok: F.struct(
                    ok.alias("parsed"), F.when(ok, row[field]).alias("value"),
                    (ok & row[field].isNull() & F.coalesce(body.rlike(rf'"{field}"\s*:\s*null'), F.lit(False))).alias("null"),
                ),
            )

        return let(F.from_json(body, schema, {**_STRICT, "columnNameOfCorruptRecord": "_bad"}), fields)

    return let(json_body(raw, repair), read)


def _spelt(raw: Column, verdict: str) -> Column:
    """True where the raw answer spells the verdict as a field, with or without one blank."""
    return F.upper(raw).rlike(f'"VERDICT": ?"{verdict}"')


def has_verdict(raw: Column, verdict: str) -> Column:
    """Regular expression test on the raw answer, in any case and spacing."""
    return F.coalesce(raw.rlike(rf'(?i)"Verdict":\s*"{verdict}"'), F.lit(False))


def verdict(
    raw: Column, on_empty: str = "ERROR", on_missing: str = "UNKNOWN", repair: bool = False, contains: bool = False,
    search: tuple[str, ...] = ("KEEP", "DISCARD"), fallback_when_missing: bool = False,
) -> Column:
    """The verdict of an answer.

    ``contains`` reduces a parsed value to KEEP, DISCARD or ``on_missing``;
    otherwise the value stands in upper case, an absent one empty and a JSON
    null as ``NONE``.  Where parsing fails, the raw answer is searched for the
    spellings of ``search``; ``fallback_when_missing`` searches also where the
    parsed answer has no verdict.
    """
    found = None
    for word in search:
        hit = _spelt(raw, word)
        found = F.when(hit, word) if found is None else found.when(hit, word)
    searched = F.lit(on_missing) if found is None else found.otherwise(F.lit(on_missing))

    def told(got: Column) -> Column:
        value = F.when(got["null"], F.lit("NONE")).otherwise(F.upper(F.coalesce(got["value"], F.lit(""))))
        if not contains:
            return F.when(got["parsed"], value).otherwise(searched)
        other = searched if fallback_when_missing else F.lit(on_missing)
        reduced = let(value, lambda v: F.when(v.contains("KEEP"), "KEEP").when(v.contains("DISCARD"), "DISCARD").otherwise(other))
        return F.when(got["parsed"], reduced).otherwise(searched)

    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit(on_empty)).otherwise(let(json_field(raw, "Verdict", repair), told))


def report_verdict(raw: Column) -> Column:
    """KEEP, DISCARD or ERROR for reports: brackets repaired, anything unclear an error."""
    return verdict(F.coalesce(raw, F.lit("")), on_empty="ERROR", on_missing="ERROR", repair=True, contains=True)


def analysis_verdict(raw: Column) -> Column:
    """KEEP, DISCARD, ERROR (no answer), UNKNOWN, or the value itself."""
    return verdict(raw, on_empty="ERROR", on_missing="UNKNOWN")


def audit_verdict(raw: Column) -> Column:
    """Like the analysis, but an answer that cannot be read is kept."""
    return verdict(raw, on_empty="UNKNOWN", on_missing="KEEP", search=("DISCARD",))


def answer_labels(raw: Column, field: str = "Emotion_Label") -> Column:
    """A list field in lower case; a scalar as a list of one; empty where there is none or parsing fails."""

    def labels(got: Column) -> Column:
        value = got["value"]
        listed = F.coalesce(F.from_json(value, "array<string>"), F.array(value))
        return F.when(value.isNull(), F.array().cast("array<string>")).when(value.rlike(r"^\s*\["), listed).otherwise(F.array(value))

    return F.transform(let(json_field(raw, field), labels), F.lower)


def json_argument(value: Column) -> Column:
    """Map of the fields of a JSON object given as a string, values as text; null where it is anything but one object."""
    return let(
        F.trim(value),
        lambda v: F.when(single_object(v) & F.coalesce(F.try_parse_json(v).isNotNull(), F.lit(False)), F.from_json(v, "map<string,string>")),
    )


def answer_is_true(raw: Column, marker: str = "Transcript:") -> Column:
    """Whether the text behind the last marker holds TRUE."""
    return F.coalesce(F.upper(F.substring_index(raw, marker, -1)).contains("TRUE"), F.lit(False))


def labelled_answer(raw: Column, labels: tuple[str, ...] = ("Intensity", "Emotion", "Reasoning", "Sections")) -> Column:
    """Struct of the lines ``Label: value`` of a plain-text answer; null where a label or its value is missing."""
    return F.struct(*[F.nullif(F.trim(F.regexp_extract(raw, rf"(?im)^[ \t]*{x}[ \t]*:[ \t]*(.*)$", 1)), F.lit("")).alias(x.lower()) for x in labels])


def split_thinking(raw: Column, mark: str = "</think>") -> Column:
    """Struct of ``thinking`` and ``answer``, cut at the last mark; without one everything is the answer."""
    at = F.length(raw) - F.length(F.substring_index(raw, mark, -1))
    return F.struct(
        F.when(F.contains(raw, F.lit(mark)), F.trim(F.substr(raw, F.lit(1), at - len(mark)))).otherwise(F.lit("")).alias("thinking"),
        F.trim(F.substring_index(raw, mark, -1)).alias("answer"),
    )
