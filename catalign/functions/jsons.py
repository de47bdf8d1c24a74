"""Nested JSON: flattening, response parsing, path lookups."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed layout of a specification response; a trailing [] marks arrays kept as JSON text
SPEC_LAYOUT: dict[str, list] = {
    "basicInfo": ["brand", "model", "configuration", "category", "modelYear", "description"],
    "marketingContent": ["whatsNew[]", "packageHighlights[]", "springOptions[]"],
    "engines[]": [],
    "weight": ["min", "max"],
    "dimensions": [("overall", ["length", "width", "height"]), "skiStance", "fuelCapacity"],
    "tracks[]": [],
    "suspension": [("front", ["type", "travel", "shock", "adjustable"]), ("rear", ["type", "travel", "shock", "adjustable"]),
                   ("center", ["type", "shock"])],
    "powertrain": ["driveClutch", "drivenClutch", "sprocketPitch", "beltType", "reverse"],
    "brakes": ["type", "pistons", "adjustableLever", "description"],
    "features": ["platform", "headlights", "skis", "seating", "handlebar", "riserBlockHeight", "windshield", "visorPlug", "usb",
                 "bumpers", "runner", "heatedGrips", "additionalFeatures[]"],
    "colors[]": [],
    "pricing": ["msrp", "currency", "market"],
    "metadata": ["extractionNotes", "documentType", "completeness"],
}
NUMBERS = {"basic_info_model_year": "int", "weight_min": "double", "weight_max": "double", "pricing_msrp": "double"}


def snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def _leaves(layout: Sequence, path: tuple[str, ...]) -> list[tuple[tuple[str, ...], bool]]:
    out = []
    for item in layout:
        if isinstance(item, tuple):
            out += _leaves(item[1], (*path, item[0]))
        else:
            out.append(((*path, item.removesuffix("[]")), item.endswith("[]")))
    return out


def spec_paths() -> list[tuple[tuple[str, ...], bool]]:
    """Every leaf of the layout with its array mark, in order."""
    out = []
    for name, layout in SPEC_LAYOUT.items():
        out += _leaves(layout, (name,)) if layout else [((name.removesuffix("[]"),), True)]
    return out


def _schema(paths: Sequence[tuple[str, ...]]) -> str:
    """DDL in which every leaf is text, so mixed and nested values stay readable."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path[:-1]:
            node = node.setdefault(step, {})
        node[path[-1]] = None

    def ddl(node: dict) -> str:
        return "struct<" + ",".join(f"`{k}`:{'string' if v is None else ddl(v)}" for k, v in node.items()) + ">"

    return ddl(tree)


def flatten_spec(text: Column) -> list[Column]:
    """Flat columns of a nested specification response: one parse, arrays as JSON text, empty ones null."""
    paths = spec_paths()
    parsed = F.from_json(text, _schema([p for p, _ in paths]))
    columns = []
    for path, is_array in paths:
        value = parsed
        for step in path:
            value = value.getField(step)
        name = "_".join(snake(step) for step in path)
        if is_array:
            value = F.when(~value.isin("[]", "", "null"), value)
        columns.append(value.cast(NUMBERS.get(name, "string")).alias(name))
    return [*columns, text.alias("full_llm_json")]


def response_items(text: Column) -> Column:
    """Objects of a model response as maps: bare array, fenced array, ``articles`` object, or array inside prose.

    Broken responses give an empty array.
    """
    kind = "array<map<string,string>>"
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), "```json|```", ""), r"^\s+|\s+$", ""))
    start, end = F.instr(clean, "["), F.length(clean) - F.instr(F.reverse(clean), "]") + 1
    inner = F.when((start > 0) & (end > start), F.substr(clean, start, end - start + 1))
    body = F.when(clean.startswith("["), clean).when(
        clean.startswith("{"), F.get_json_object(clean, "$.articles")).otherwise(inner)
    return F.coalesce(F.from_json(body, kind), F.array().cast(kind))


def batch_results(response: Column, expected: Column, tokens: Column, cost: Column) -> Column:
    """Per-item results of a batch response with its usage split evenly.

    A response whose length differs from ``expected`` gives that many failed items.
    """
    items = F.from_json(response, "array<struct<enrichment_result:string,confidence:double>>")
    good = items.isNotNull() & (F.size(items) == expected)
    done = F.transform(items, lambda x: F.struct(
        F.lit(True).alias("success"), F.coalesce(x["enrichment_result"], F.lit("{}")).alias("content"),
        F.coalesce(x["confidence"], F.lit(0.7)).alias("confidence"), F.floor(tokens / expected).alias("tokens"),
        (cost / expected).cast("double").alias("cost")))
    failed = F.transform(F.sequence(F.lit(1).cast("long"), expected.cast("long")), lambda _: F.struct(
        F.lit(False).alias("success"), F.lit(None).cast("string").alias("content"), F.lit(0.0).alias("confidence"),
        F.lit(0).cast("long").alias("tokens"), F.lit(0.0).alias("cost")))
    return F.when(good, done).otherwise(failed)


def valid_options(response: Column) -> dict[str, Column]:
    """Detected options that have all required keys, and the clamped overall confidence."""
    parsed = F.from_json(response, "struct<detected_options:array<map<string,string>>,overall_confidence:double>")
    keep = F.filter(parsed["detected_options"], lambda o: F.map_contains_key(o, "option_type")
                    & F.map_contains_key(o, "description") & F.map_contains_key(o, "confidence"))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(parsed["overall_confidence"], F.lit(0.7))))
    return {"options": F.coalesce(keep, F.array().cast("array<map<string,string>>")), "confidence": score}


def indexed_columns(spec: Column) -> dict[str, Column]:
    """Hot values of a specification text: displacement, weights, price, turbo, engine count."""
    engine = "struct<name:string,displacement:double,turbo:boolean,type:string,dryWeight:double>"
    weight = "struct<min:double,max:double,dry:double>"
    s = F.from_json(spec, f"struct<engines:array<{engine}>,engine:{engine},weight:{weight},dimensions:struct<dryWeight:double>,"
                          "pricing:struct<msrp:double>>")
    engines = s["engines"]
    return {
        "primary_displacement": F.coalesce(F.get(engines, F.lit(0))["displacement"], s["engine"]["displacement"]).cast("int"),
        "min_dry_weight_kg": F.coalesce(s["weight"]["min"], s["dimensions"]["dryWeight"], s["weight"]["dry"]).cast("int"),
        "max_dry_weight_kg": F.coalesce(s["weight"]["max"], s["dimensions"]["dryWeight"], s["weight"]["dry"]).cast("int"),
        "msrp": s["pricing"]["msrp"].cast("decimal(10,2)"),
        "has_turbo": F.coalesce(F.exists(engines, lambda e: F.coalesce(e["turbo"], F.lit(False))), s["engine"]["turbo"], F.lit(False)),
        "engine_count": F.coalesce(F.size(engines), F.lit(1)),
    }


def path_values(spec: Column) -> dict[str, Column]:
    """Engine names, displacements and front suspension type by path."""
    s = F.from_json(spec, "struct<engines:array<struct<name:string,displacement:double>>,suspension:struct<front:struct<type:string>>>")
    return {"engine_names": F.transform(s["engines"], lambda e: e["name"]),
            "displacements": F.transform(s["engines"], lambda e: e["displacement"].cast("int")),
            "front_suspension": s["suspension"]["front"]["type"]}


# fixed field names of the page groups: (group, {shown name: stored name})
PAGE_GROUPS: dict[str, Mapping[str, str]] = {
    "engine": {"model": "name", "displacement": "displacement_info", "type": "engine_type", "max_rpm": "maximum_engine_speed"},
    "track": {"length": "length", "width": "width", "profile": "profile", "type": "track_type"},
    "suspension": {"front_type": "front_suspension", "rear_type": "rear_suspension"},
}


def page_groups(spec: Column, options: Column) -> dict[str, Column]:
    """Engine, track, suspension and applied option groups of a full specification."""
    parsed = F.from_json(spec, _schema([(g, f) for g, names in PAGE_GROUPS.items() for f in names.values()]))
    out = {g: F.struct(*[parsed[g][stored].alias(shown) for shown, stored in names.items()]) for g, names in PAGE_GROUPS.items()}
    kinds = ["color_changes", "track_upgrades", "feature_additions", "suspension_upgrades"]
    applied = F.from_json(options, _schema([("applied_modifications", k) for k in kinds]))["applied_modifications"]
    out["applied"] = F.struct(*[applied[k].alias(k) for k in kinds])
    return out
