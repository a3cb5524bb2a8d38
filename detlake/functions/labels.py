"""Scalar functions over names, labels, keys and small strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix and actions of event names.
EVENT_PREFIX = "minecraft."
NO_TARGET = ("custom", "open_chest", "craft")
NO_LABEL = ("right_click", "landmark", "attack", "craft")
#: Label alignment, identity for any other.
ALIGNED = {"tree_trunk": "oak_log", "ground": "dirt", "portal_frame": "obsidian", "ocean": "water", "cliff_edge": "stone"}


def event_label(event: Column, mode: str = "first", extra_excluded: tuple[str, ...] = ()) -> Column:
    """The object an event is about, or null.

    ``mode`` first: split once, the trimmed rest, null if blank.  ``mode`` last:
    split at every colon, the last part trimmed, which may be blank.
    """
    s = F.replace(event, F.lit(EVENT_PREFIX), F.lit(""))
    action, excluded = F.substring_index(s, ":", 1), F.lit(None).cast("string")
    actions = [*NO_TARGET, *extra_excluded]
    if mode == "first":
        rest = F.nullif(F.trim(s.substr(F.instr(s, ":") + 1, F.length(s))), F.lit(""))
        plain = F.nullif(F.trim(s), F.lit(""))
    else:
        rest, plain = F.trim(F.element_at(F.split(s, ":"), -1)), F.trim(s)
    told = F.when(F.instr(s, ":") > 0, F.when(action.isin(actions), excluded).otherwise(rest))
    bare = F.when(s.isin([*NO_LABEL, *extra_excluded]), excluded).otherwise(plain)
    return F.when(event.isNull() | (event == ""), excluded).otherwise(F.when(F.instr(s, ":") > 0, told).otherwise(bare))


def part_number(name: Column) -> Column:
    """``part-950`` -> 950; anything else 0."""
    return F.coalesce(F.substring_index(name, "-", -1).try_cast("int"), F.lit(0))


def episode_prefix(name: Column) -> Column:
    """Struct (prefix, ts): the last dash-separated segment is a time stamp iff all digits."""
    timed = name.rlike(r"^.*-\d+$")
    return F.struct(
        F.when(timed, F.regexp_extract(name, r"^(.*)-(\d+)$", 1)).otherwise(name).alias("prefix"),
        F.when(timed, F.regexp_extract(name, r"^(.*)-(\d+)$", 2)).otherwise("").alias("ts"),
    )


def chunk_of(frame: Column, size: int = 32) -> tuple[Column, Column]:
    """(offset of the chunk, place in it)."""
    return frame - F.pmod(frame, F.lit(size)), F.pmod(frame, F.lit(size))


def frame_file(dataset: Column, part: Column, ep: Column, frame: Column) -> Column:
    return F.format_string("%s_%s_ep%d_f%06d.png", dataset, part, ep, frame)


def caption_text(text: Column) -> Column:
    """Lower-case, trimmed, with one full stop at the end."""
    t = F.lower(F.trim(text))
    return F.when(t.endswith("."), t).otherwise(F.concat(t, F.lit(".")))


def caption_of(names: Column, style: str = "spaced") -> Column:
    """``a . b .`` (spaced) or ``a. b`` (plain)."""
    return F.concat(F.array_join(names, " . "), F.lit(" .")) if style == "spaced" else F.array_join(names, ". ")


def phrase_class(phrase: Column, classes: Column) -> Column:
    """Index of the first class that occurs in the phrase, else null."""
    at = F.array_position(F.transform(classes, lambda c: F.contains(phrase, c)), True)
    return F.nullif(at, F.lit(0)).cast("int") - 1


def display_phrase(phrase: Column, score: Column) -> Column:
    """Phrase without full stops and its score, cut after four characters."""
    return F.concat(F.replace(phrase, F.lit("."), F.lit("")), F.lit("("), score.cast("string").substr(1, 4), F.lit(")"))


def align_label(label: Column, mapping: dict[str, str] | None = None) -> Column:
    known = F.create_map(*[F.lit(x) for kv in (mapping or ALIGNED).items() for x in kv])
    return F.coalesce(F.try_element_at(known, label), label)


def prompt_variants(prompt: Column, label: Column) -> Column:
    """Array of (style, prompt): as given, the bare label, the aligned label."""
    spaced = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    styles = {"original": prompt, "simple": spaced(label), "aligned": spaced(align_label(label))}
    return F.array(*[F.struct(F.lit(k).alias("style"), v.alias("prompt")) for k, v in styles.items()])


def export_round(value: Column) -> Column:
    """Two places, correctly rounded: the binary value decides, halves go to even (2.675, stored below it, gives 2.67).

    For export only, the lake keeps raw values.  The value is split into parts
    whose products with 200 are exact, so its place beside the half is known exactly.
    """
    v = value.cast("double")
    wide = v * 134217729.0  # 2^27 + 1
    hi = wide - (wide - v)
    m = F.floor(v * 100).cast("double")
    beyond = (hi * 200 - (2 * m + 1)) + (v - hi) * 200
    up = (beyond > 0) | ((beyond == 0) & (F.pmod(m, F.lit(2.0)) == 1))
    rounded = (m + F.when(up, 1.0).otherwise(0.0)) / 100
    return F.when(F.abs(v) < 1e13, rounded).otherwise(v)


def python_round(value: Column) -> Column:
    return F.bround(value, 0).cast("int")


def strip_prefix(m: Column, prefix: str = "module.") -> Column:
    """Map keys without a leading prefix."""
    return F.transform_keys(m, lambda k, v: F.when(k.startswith(prefix), k.substr(F.lit(len(prefix) + 1), F.length(k))).otherwise(k))


def has_prefix(name: Column, prefixes: Column) -> Column:
    return F.exists(prefixes, lambda p: F.startswith(name, p))


def parse_scalar(text: Column) -> Column:
    """Struct (kind, value as text): integer, then number, then boolean, then null, else string."""
    kind = (
        F.when(text.try_cast("long").isNotNull() & text.rlike(r"^[+-]?\d+$"), "int").when(text.try_cast("double").isNotNull(), "float")
        .when(F.lower(text).isin("true", "false"), "bool").when(F.lower(text).isin("none", "null"), "null").otherwise("str")
    )
    return F.struct(kind.alias("kind"), F.when(kind == "null", None).otherwise(text).alias("value"))


def decode_key(key: Column) -> Column:
    """UTF-8 text of a binary key, else its hexadecimal digits."""
    return F.coalesce(F.try_validate_utf8(key.cast("string")), F.lower(F.hex(key)))


def parse_key(key: Column) -> Column:
    """Struct (ep_idx, frame_offset) of a key ``(ep, offset)``; null fields for any other."""
    rx = r"^\(\s*(\d+)\s*,\s*(\d+)\s*\)$"
    part = lambda i: F.when(key.rlike(rx), F.regexp_extract(key, rx, i).cast("int"))
    return F.struct(part(1).alias("ep_idx"), part(2).alias("frame_offset"))


def sparse_to_compact(ids: Column) -> Column:
    """Place of each value in an ordered array of used ids: map sparse id -> compact id."""
    ordered = F.array_sort(F.array_distinct(ids))
    return F.map_from_arrays(ordered, F.transform(ordered, lambda x, i: i))
