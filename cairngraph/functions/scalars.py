"""Column expressions: ids, text, recency, coercion, repair rules, metadata."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions and the language each one publishes.
SUPPORTED_LANGUAGES = {
    ".js": "javascript",
    ".jsx": "javascript",
    ".ts": "typescript",
    ".tsx": "typescript",
    ".py": "python",
}
PLANNED_LANGUAGES = {
    ".go": "go",
    ".rs": "rust",
    ".java": "java",
    ".c": "c",
    ".cpp": "cpp",
    ".rb": "ruby",
    ".php": "php",
}
# Recency curve (hours) and risk thresholds.
RECENCY_MIDPOINT_H = 72.0
RECENCY_WIDTH_H = 36.0
RECENCY_FLOOR = 0.1
RISK_HIGH = 20
RISK_MEDIUM = 5
# Repair policies and the default first valid year.
REPAIR_POLICIES = ("pre2026", "before-created", "all")
YEAR_FLOOR = 2026

MICROS_PER_HOUR = 3.6e9


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _joined(*parts: str | Column) -> Column:
    return F.concat_ws(":", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


# --- ids and text ---------------------------------------------------------------------------


def symbol_id(project, language, file, qualified_name, signature) -> Column:
    return F.sha2(_joined(project, language, file, qualified_name, signature), 256)


def generation_id(path, now) -> Column:
    return F.substring(F.sha2(_joined(path, now), 256), 1, 16)


def edge_id(generation, source, edge_type, target) -> Column:
    return F.sha2(_joined(generation, source, edge_type, target), 256)


def node_id(generation, symbol) -> Column:
    return _joined(generation, symbol)


def content_text(kind, qualified_name, file, line) -> Column:
    return F.format_string(
        "%s: %s in %s:%s", _col(kind), _col(qualified_name), _col(file), _col(line).cast("string")
    )


def matches_query(query: str, *columns: str | Column) -> Column:
    """True when the query is part of any of the columns, ignoring case."""
    needle = F.lit(query.lower())
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.contains(F.lower(_col(c)), needle), F.lit(False))
    return found


def path_segments(path: str | Column) -> Column:
    """Path parts with `.` and `..` folded; climbing above the start stays at the start."""
    return F.aggregate(
        F.split(_col(path), "/"),
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part.isin("", "."), acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(part))),
    )


def normalize_path(path: str | Column, base: str = "/") -> Column:
    """Absolute path with `.`, `..` and doubled slashes folded; relative ones start at `base`."""
    c = _col(path)
    absolute = F.when(c.startswith("/"), c).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), c))
    return F.concat(F.lit("/"), F.array_join(path_segments(absolute), "/"))


def extension_of(path: str | Column) -> Column:
    """Lower-cased suffix with the dot, or an empty text (also for dot-files)."""
    return F.lower(F.regexp_extract(_col(path), r"[^/](\.[^./]+)$", 1))


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def language_of(ext: str | Column) -> Column:
    lowered = F.lower(_col(ext))
    return F.coalesce(_lookup(SUPPORTED_LANGUAGES, lowered), _lookup(PLANNED_LANGUAGES, lowered))


def support_of(ext: str | Column) -> Column:
    lowered = F.lower(_col(ext))
    return (
        F.when(lowered.isin(*SUPPORTED_LANGUAGES), F.lit("supported"))
        .when(lowered.isin(*PLANNED_LANGUAGES), F.lit("planned_v2"))
        .otherwise(F.lit("unsupported"))
    )


# --- recency --------------------------------------------------------------------------------


def age_hours(last, ref) -> Column:
    micros = F.unix_micros(_col(ref).cast("timestamp")) - F.unix_micros(_col(last).cast("timestamp"))
    return micros / F.lit(MICROS_PER_HOUR)


def age_z(last, ref) -> Column:
    return (age_hours(last, ref) - RECENCY_MIDPOINT_H) / RECENCY_WIDTH_H


def recency_factor(last, salience, ref) -> Column:
    clamped = F.greatest(F.lit(-100.0), F.least(F.lit(100.0), age_z(last, ref)))
    fading = F.greatest(F.lit(RECENCY_FLOOR), F.lit(1.0) / (F.lit(1.0) + F.exp(clamped)))
    return F.when(_col(last).isNull(), F.lit(0.3) + F.lit(0.4) * _col(salience)).otherwise(fading)


# --- coercion of loosely typed input --------------------------------------------------------

INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT_TEXT = (
    r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?"
    r"|inf|infinity|nan)\s*$"
)
TS_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)


def to_bool(c, source: str = "string") -> Column:
    """Numbers: not zero. Text: true, 1 or yes in any case, everything else false. Null stays."""
    c = _col(c)
    if source == "string":
        return F.lower(c).isin("true", "1", "yes")
    if source == "boolean":
        return c
    return c != 0


def to_int(c, source: str = "string") -> Column:
    c = _col(c)
    if source == "string":
        return F.when(c.rlike(INT_TEXT), F.regexp_replace(c, r"[\s_]", "").try_cast("bigint"))
    return c.try_cast("bigint")


def to_float(c, source: str = "string") -> Column:
    c = _col(c)
    if source == "string":
        return F.when(c.rlike(FLOAT_TEXT), F.regexp_replace(c, r"[\s_]", "").try_cast("double"))
    return c.try_cast("double")


def to_ts(c, source: str = "string") -> Column:
    """ISO text with blank or T, optional fraction and zone; numbers are epoch seconds."""
    c = _col(c)
    if source == "string":
        return F.when(c.rlike(TS_TEXT), F.try_to_timestamp(c))
    if source == "number":
        return F.timestamp_micros((c.cast("double") * 1e6).cast("bigint"))
    return F.lit(None).cast("timestamp")


def bytes_to_text(c) -> Column:
    return F.coalesce(F.try_validate_utf8(_col(c).cast("string")), F.lower(F.hex(_col(c))))


# --- repair of last-used timestamps ---------------------------------------------------------


def repair_reason(created, last, policy: str = "all", floor: int = YEAR_FLOOR) -> Column:
    if policy not in REPAIR_POLICIES:
        raise ValueError(f"repair policy {policy!r} is none of {sorted(REPAIR_POLICIES)}")
    created, last = _col(created), _col(last)
    reason = F.when(last.isNull(), F.lit(None).cast("string"))
    if policy in ("pre2026", "all"):
        reason = reason.when(F.year(last) < floor, F.lit("pre2026"))
    if policy in ("before-created", "all"):
        reason = reason.when(last < created, F.lit("before-created"))
    return reason


def normalize_last(created, last, floor: int = YEAR_FLOOR) -> Column:
    """Independent of the repair policy: too early or before creation becomes the creation time."""
    created, last = _col(created), _col(last)
    return F.when((F.year(last) < floor) | (last < created), created).otherwise(last)


def utc_iso(c) -> Column:
    utc = F.to_utc_timestamp(_col(c).cast("timestamp"), F.current_timezone())
    seconds = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, "SSSSSS")
    fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(seconds, fraction, F.lit("+00:00"))


# --- risk and metadata ----------------------------------------------------------------------


def risk(n) -> Column:
    return (
        F.when(_col(n) >= RISK_HIGH, F.lit("high"))
        .when(_col(n) >= RISK_MEDIUM, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def has_tag(tags, tag: str) -> Column:
    return F.coalesce(F.array_contains(_col(tags), tag), F.lit(False))


def meta_get(meta, key: str) -> Column:
    return F.get_json_object(_col(meta), f"$.{key}")


def meta_has_tag(meta, tag: str) -> Column:
    return has_tag(F.from_json(meta_get(meta, "tags"), "array<string>"), tag)


def meta_patch(meta, **values: Any) -> Column:
    """JSON object text with the given keys set and all others kept, value types included."""
    current = F.coalesce(
        F.from_json(_col(meta), "map<string,variant>"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")),
    )
    kept = F.map_filter(current, lambda key, _: ~key.isin(*values))
    patched = []
    for key, value in values.items():
        if isinstance(value, Column):
            wrapped = F.parse_json(F.to_json(F.struct(value.alias("v"))))
            variant = F.variant_get(wrapped, "$.v", "variant")
        else:
            variant = F.parse_json(F.lit(json.dumps(value)))
        patched += [F.lit(key), variant]
    return F.to_json(F.map_concat(kept, F.create_map(*patched)))
