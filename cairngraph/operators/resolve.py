"""From fact tables to symbols and edges: module paths, import bindings, name resolution.

All lookups are keyed by project and file, so the joins spread over the files of the code base.
References are reduced to distinct names before they are looked up.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairngraph.functions import scalars as S
from cairngraph.operators.common import first_by, grown, looked_up, union_all
from cairngraph.schemas import SYMBOLS

# The order in which suffixes are tried for an import without one.
JS_SUFFIXES = (".ts", ".tsx", ".js", ".jsx")
_SYMBOL_COLUMNS = [field.split()[0] for field in SYMBOLS.split(", ")]


# --- symbols --------------------------------------------------------------------------------


def module_symbols(files: DataFrame) -> DataFrame:
    """One symbol per supported file; it stands before all others of the file (`ord` 0)."""
    ext = S.extension_of("path")
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = files.filter(S.support_of(ext) == "supported").select(
        "project",
        F.col("path").alias("file"),
        F.lit(0).alias("ord"),
        F.regexp_replace(base, r"(?<=.)\.[^.]+$", "").alias("name"),
        F.col("path").alias("qualified_name"),
        F.lit("module").alias("kind"),
        F.lit(1).alias("line"),
        S.language_of(ext).alias("language"),
        F.lit("").alias("signature"),
    )
    return with_symbol_id(rows)


def with_symbol_id(rows: DataFrame) -> DataFrame:
    sid = S.symbol_id("project", "language", "file", "qualified_name", "signature")
    return rows.withColumn("symbol_id", sid).select(*_SYMBOL_COLUMNS)


def all_symbols(files: DataFrame, defs: DataFrame) -> DataFrame:
    return module_symbols(files).unionByName(with_symbol_id(defs))


# --- module paths ---------------------------------------------------------------------------


def _folder(file: str = "file") -> Column:
    parts = F.split(F.col(file), "/")
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def _first_existing(specs: DataFrame, files: DataFrame, imports: DataFrame) -> DataFrame:
    """Adds `target_file`: the first candidate of each import that exists, null when none does.

    `specs`: (project, folder, module_spec, candidates), distinct, so that a module imported
    everywhere is looked up once per folder and not once per import.
    """
    # Outer: a filter on the candidates would be moved before the distinct and work them out for every import.
    candidates = specs.select(
        "project", "folder", "module_spec", F.posexplode_outer("candidates").alias("priority", "path")
    )
    found = (
        candidates.join(looked_up(files.select("project", "path").distinct()), ["project", "path"])
        .groupBy("project", "folder", "module_spec")
        .agg(F.min_by("path", "priority").alias("target_file"))
    )
    keyed = imports.withColumn("folder", _import_folder())
    joined = keyed.join(looked_up(found), ["project", "folder", "module_spec"], "left")
    supported = S.support_of(S.extension_of("target_file")) == "supported"
    return joined.select(
        *imports.columns, F.when(supported, F.col("target_file")).alias("target_file")
    )


def _import_folder() -> Column:
    """Start folder of an import: the file's own for relative ones, the project root otherwise."""
    relative = F.col("module_spec").startswith(".")
    return F.when(relative, F.array_join(_folder(), "/")).otherwise(F.lit(""))


def resolve_python_modules(imports: DataFrame, files: DataFrame) -> DataFrame:
    """Leading dots climb from the file's folder; then `<m>.py`, then `<m>/__init__.py`."""
    specs = imports.select("project", _import_folder().alias("folder"), "module_spec").distinct()
    dots = F.length(F.regexp_extract("module_spec", r"^(\.*)", 1))
    climb = F.greatest(dots - 1, F.lit(0))
    start = F.when(F.col("folder") == "", F.array().cast("array<string>")).otherwise(
        F.split("folder", "/")
    )
    base = F.slice(start, F.lit(1), F.greatest(F.size(start) - climb, F.lit(0)))
    module = F.replace(F.ltrim(F.col("module_spec"), F.lit(".")), F.lit("."), F.lit("/"))

    def path(*tail: Column) -> Column:
        return F.array_join(F.concat(base, F.array(*tail)), "/")

    init = F.lit("__init__.py")
    paths = F.when(module == "", F.array(path(init))).otherwise(
        F.array(path(F.concat(module, F.lit(".py"))), path(module, init))
    )
    # Climbing past the project root finds nothing.
    inside = (climb <= F.size(start)) & (F.trim("module_spec") != "")
    return _first_existing(
        specs.withColumn("candidates", F.when(inside, paths)), files, imports
    )


def resolve_js_modules(imports: DataFrame, files: DataFrame) -> DataFrame:
    """Only specs that start with a dot; an exact path when it has a suffix, else by suffix list."""
    specs = imports.select("project", _import_folder().alias("folder"), "module_spec").distinct()
    steps = F.split(F.concat_ws("/", "folder", "module_spec"), "/")
    # A path that leaves the root on the way has more climbs than names in some prefix.
    depth = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("lowest")),
        lambda acc, part: _descend(acc, part),
    )
    target = F.array_join(S.path_segments(F.concat_ws("/", "folder", "module_spec")), "/")
    has_suffix = F.regexp_extract(target, r"[^/](\.[^./]+)$", 1) != ""
    prefix = F.when(target == "", F.lit("")).otherwise(F.concat(target, F.lit("/")))
    with_suffix = [F.concat(target, F.lit(s)) for s in JS_SUFFIXES]
    index = [F.concat(prefix, F.lit(f"index{s}")) for s in JS_SUFFIXES]
    paths = (
        F.when(has_suffix, F.array(target))
        .when(target == "", F.array(*index))
        .otherwise(F.array(*with_suffix, *index))
    )
    inside = F.col("module_spec").startswith(".") & (depth["lowest"] >= 0)
    return _first_existing(
        specs.withColumn("candidates", F.when(inside, paths)), files, imports
    )


def _descend(acc: Column, part: Column) -> Column:
    move = F.when(part.isin("", "."), F.lit(0)).when(part == "..", F.lit(-1)).otherwise(F.lit(1))
    at = acc["at"] + move
    return F.struct(at.alias("at"), F.least(acc["lowest"], at).alias("lowest"))


# --- edges by rule --------------------------------------------------------------------------


def import_edges(resolved: DataFrame, modules: DataFrame) -> DataFrame:
    """Importing module -> imported module; unresolved imports drop out."""
    source = modules.select("project", "file", F.col("symbol_id").alias("source_sid"))
    target = modules.select(
        "project", F.col("file").alias("target_file"), F.col("symbol_id").alias("target_sid")
    )
    return (
        resolved.filter(F.col("target_file").isNotNull())
        .groupBy("project", "file", "target_file")
        .agg(F.min_by(F.struct("line", "ord"), "ord").alias("first"))
        .join(grown(source), ["project", "file"])
        .join(grown(target), ["project", "target_file"])
        .select(
            "project", "file", "first.ord", "source_sid", "target_sid",
            F.lit("IMPORTS").alias("type"), "first.line",
        )
    )


def import_bindings(resolved: DataFrame, symbols: DataFrame) -> DataFrame:
    """(project, file, binding_name, target_sid); of several bindings of a name the last one."""
    bound = resolved.filter(
        F.col("target_file").isNotNull() & F.col("binding_name").isNotNull()
    )
    names = (
        symbols.filter(F.col("kind") != "module")
        .select(
            "project",
            F.col("file").alias("target_file"),
            F.explode(F.array_distinct(F.array("name", "qualified_name"))).alias("imported_name"),
            "ord",
            "symbol_id",
        )
        .groupBy("imported_name", "target_file", "project")
        .agg(F.min_by("symbol_id", "ord").alias("target_sid"))
    )
    by_name = bound.filter(F.col("form") == "from").join(
        looked_up(names), ["project", "target_file", "imported_name"]
    )
    modules = symbols.filter(F.col("kind") == "module").select(
        "project", F.col("file").alias("target_file"), F.col("symbol_id").alias("target_sid")
    )
    whole = bound.filter(F.col("form").isin("module", "namespace")).join(
        looked_up(modules), ["project", "target_file"]
    )
    columns = ["project", "file", "binding_name", "ord", "target_sid"]
    return (
        by_name.select(*columns)
        .unionByName(whole.select(*columns))
        .groupBy("binding_name", "file", "project")
        .agg(F.max_by("target_sid", "ord").alias("target_sid"))
        .select("project", "file", "binding_name", "target_sid")
    )


def _by_qualified(symbols: DataFrame) -> DataFrame:
    """One symbol per qualified name of a file: the last one."""
    return symbols.groupBy("project", "file", "qualified_name").agg(
        F.max_by("symbol_id", "ord").alias("symbol_id")
    )


def contains_edges(symbols: DataFrame) -> DataFrame:
    """Parent -> member: the module for plain names, else the symbol named up to the last dot."""
    members = symbols.filter(F.col("kind") != "module").withColumn(
        "parent",
        F.when(
            F.contains("qualified_name", F.lit(".")),
            F.regexp_replace("qualified_name", r"\.[^.]*$", ""),
        ),
    )
    modules = symbols.filter(F.col("kind") == "module")
    # The module answers for members without a parent name: both lookups in one join.
    parents = union_all(
        [
            _by_qualified(symbols).select(
                "project", "file", F.col("qualified_name").alias("parent"),
                F.col("symbol_id").alias("source_sid"),
            ),
            modules.select(
                "project", "file", F.lit("").alias("parent"),
                F.col("symbol_id").alias("source_sid"),
            ),
        ]
    )
    return (
        members.withColumn("parent", F.coalesce("parent", F.lit("")))
        .join(grown(parents), ["project", "file", "parent"])
        .select(
            "project", "file", "ord", "source_sid", F.col("symbol_id").alias("target_sid"),
            F.lit("CONTAINS").alias("type"), "line",
        )
    )


# --- the name-resolution cascade ------------------------------------------------------------

# What tells references apart for the cascade; the most telling first, since sorts compare in this order.
NAME = ["raw_name", "containers", "file", "project"]


def _lookups(symbols: DataFrame, bindings: DataFrame) -> DataFrame:
    """(project, file, key, space, at_rule, target_sid): what each key of a file leads to, one row per name space.

    imported: the target of an imported name; qualified: that of a full name; simple: target and rule
    of a name that only one symbol of the file has, or only one symbol at top level.
    """
    top = ~F.contains("qualified_name", F.lit("."))
    simple = (
        symbols.groupBy("project", "file", "name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(top).alias("n_top"),
            F.min("symbol_id").alias("only"),
            F.min(F.when(top, F.col("symbol_id"))).alias("only_top"),
        )
        .filter((F.col("n") == 1) | (F.col("n_top") == 1))
        .select(
            "project", "file", F.col("name").alias("key"), F.lit("simple").alias("space"),
            F.when(F.col("n") == 1, F.lit(6)).otherwise(F.lit(7)).alias("at_rule"),
            F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("only_top")).alias("target_sid"),
        )
    )
    qualified = _by_qualified(symbols).select(
        "project", "file", F.col("qualified_name").alias("key"), F.lit("qualified").alias("space"),
        F.lit(None).cast("int").alias("at_rule"), F.col("symbol_id").alias("target_sid"),
    )
    imported = bindings.select(
        "project", "file", F.col("binding_name").alias("key"), F.lit("imported").alias("space"),
        F.lit(1).alias("at_rule"), "target_sid",
    )
    return union_all([simple, qualified, imported])


def _candidates() -> Column:
    """The cascade as the keys to look up for one reference, null for those it does not try.

    A key is looked up once for all name spaces: `imported` and `simple` tell whether it is tried as an
    imported (rule 1) or simple name (rules 6 and 7), `rule` is its rule as a qualified name. A key that
    an earlier rule has tried in the same name space is left out.
    """
    raw, containers = F.col("raw_name"), F.col("containers")
    depth = F.size(containers)
    nested = F.coalesce(depth > 0, F.lit(False))
    own = nested & (raw.startswith("self.") | raw.startswith("this."))
    # Both prefixes are five characters long.
    rest = F.when(own, F.substring(raw, 6, 1 << 30)).otherwise(raw)
    outer = F.try_element_at(containers, F.lit(1))
    in_outer = F.concat_ws(".", outer, rest)
    in_all = F.concat_ws(".", F.array_join(containers, "."), rest)

    def option(key: Column, when: Column, rule: Column, imported: Column, simple: Column) -> Column:
        entry = F.struct(
            *NAME, key.alias("key"), rule.cast("int").alias("rule"),
            imported.alias("imported_key"), simple.alias("simple_key"),
        )
        return F.when((raw != "") & when, entry)

    yes, no = F.lit(True), F.lit(False)
    return F.array(
        option(raw, yes, F.when(~own, F.lit(3)), yes, ~own),
        option(rest, own, F.lit(3), no, yes),
        option(in_outer, own | (nested & (depth > 1)), F.when(own, F.lit(2)).otherwise(F.lit(5)), no, no),
        option(in_all, nested & ~(own & (depth == 1)), F.lit(4), no, no),
    )


def resolve_names(refs: DataFrame, symbols: DataFrame, bindings: DataFrame) -> DataFrame:
    """`refs` (project, file, containers, raw_name, ...) with `target_sid` and `rule`, or nulls.

    Each distinct reference becomes its few candidate keys, all candidates meet one lookup in a
    single join, and the lowest rule wins. A key has at most one row per name space there.
    """
    # The name goes through the candidates: the joins' filters on nulls would be moved before the distinct, which could
    # then not be the same shuffle as that of `refs` where these are distinct.
    tried = (
        refs.select(*NAME).distinct()
        .select(F.explode(_candidates()).alias("c"))
        .filter(F.col("c").isNotNull())
        .select("c.*")
    )

    space = F.col("space")
    rule = (
        F.when(space == "qualified", F.col("rule"))
        .when((space == "imported") & F.col("imported_key"), F.col("at_rule"))
        .when((space == "simple") & F.col("simple_key"), F.col("at_rule"))
    )
    hit = F.when(rule.isNotNull(), F.struct(rule.alias("rule"), "target_sid"))
    hits = (
        tried.join(looked_up(_lookups(symbols, bindings)), ["project", "file", "key"])
        .select(*NAME, hit.alias("hit"))
        .filter(F.col("hit").isNotNull())
        .groupBy(*NAME)
        .agg(F.min("hit").alias("hit"))
    )
    # Hits grow with the references and come sorted by name: a merge join can spill them.
    resolved = refs.join(grown(hits), NAME, "left")
    return resolved.select(*refs.columns, "hit.target_sid", "hit.rule")


def base_references(bases: DataFrame) -> DataFrame:
    return bases.select(
        "project", "file", F.col("class_qname").alias("src_qname"), F.col("relation").alias("type"),
        "containers", F.col("base_name").alias("raw_name"), "ord", "line",
    )


def call_references(calls: DataFrame) -> DataFrame:
    return calls.select(
        "project", "file", "src_qname", F.lit("CALLS").alias("type"), "containers", "raw_name",
        "ord", "line",
    )


def reference_edges(refs: DataFrame, symbols: DataFrame, bindings: DataFrame) -> DataFrame:
    """Edges of references whose name leads somewhere, one per pair and type with the first line.

    A symbol that calls itself gives no edge.
    """
    found = resolve_names(refs, symbols, bindings).filter(F.col("target_sid").isNotNull())
    sources = _by_qualified(symbols).withColumnsRenamed(
        {"qualified_name": "src_qname", "symbol_id": "source_sid"}
    )
    return (
        found.join(looked_up(sources), ["project", "file", "src_qname"])
        .filter((F.col("type") != "CALLS") | (F.col("source_sid") != F.col("target_sid")))
        .groupBy("project", "file", "source_sid", "target_sid", "type")
        .agg(F.min(F.struct("ord", "line")).alias("first"))
        .select("project", "file", "first.ord", "source_sid", "target_sid", "type", "first.line")
    )


def inheritance_edges(bases: DataFrame, symbols: DataFrame, bindings: DataFrame) -> DataFrame:
    """EXTENDS and IMPLEMENTS; bases that lead nowhere are dropped."""
    return reference_edges(base_references(bases), symbols, bindings)


def call_edges(calls: DataFrame, symbols: DataFrame, bindings: DataFrame) -> DataFrame:
    """CALLS, without calls that lead nowhere."""
    return reference_edges(call_references(calls), symbols, bindings)


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """One row per (source, target, type), the first in file and fact order."""
    return first_by(edges, ["source_sid", "target_sid", "type"], ["project", "file", "ord", "line"])


def all_edges(
    symbols: DataFrame,
    resolved: DataFrame,
    bases: DataFrame,
    calls: DataFrame,
    step: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Every relation of the code base from its facts, deduplicated. `step` may store what the next steps read."""
    modules = symbols.filter(F.col("kind") == "module")
    bindings = step(import_bindings(resolved, symbols))
    # Bases and calls run through the cascade together.
    refs = base_references(bases).unionByName(call_references(calls))
    parts = [
        import_edges(resolved, modules),
        step(contains_edges(symbols)),
        step(reference_edges(refs, symbols, bindings)),
    ]
    return dedupe_edges(reduce(DataFrame.unionByName, parts))
