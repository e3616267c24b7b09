"""Fact extraction: one job over a table of source files.

`extract_facts` reads each Python file once and emits rows of five kinds (definitions, imports,
bases, calls, errors). Everything after it is joins over these tables, whatever the language; facts
of other languages come in as tables of the same shape.
"""

from __future__ import annotations

import ast
import io
import tokenize
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairngraph.functions.scalars import extension_of, language_of
from cairngraph.operators.common import grown
from cairngraph.session import cut, ship_with_tasks

ship_with_tasks(__name__)

FACTS = (
    "fact string, project string, file string, ord int, line int, name string, "
    "qualified_name string, kind string, signature string, form string, module_spec string, "
    "imported_name string, binding_name string, containers array<string>, raw_name string, "
    "error string"
)
_ARROW = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
FACT_SCHEMA = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in FACTS.split(", ")])
OUTPUT_ROWS = 10_000
_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)
# Nodes that hold neither definitions nor calls.
_LEAVES = (ast.Name, ast.Constant, ast.expr_context, ast.operator, ast.cmpop, ast.alias)


class _Source:
    """Text lookups by the byte positions that `ast` reports."""

    def __init__(self, text: str) -> None:
        self.lines = [line.encode() for line in io.StringIO(text, newline="")]

    def slice(self, first: int, col: int, last: int, end_col: int) -> str:
        if first == last:
            return self.lines[first - 1][col:end_col].decode()
        parts = [self.lines[first - 1][col:], *self.lines[first : last - 1]]
        return b"".join([*parts, self.lines[last - 1][:end_col]]).decode()

    def of(self, node: ast.AST) -> str:
        return self.slice(node.lineno, node.col_offset, node.end_lineno, node.end_col_offset)


def _parameter_texts(text: str) -> list[str]:
    """Parameter lists with their parentheses, one per `def` in source order."""
    lines = list(io.StringIO(text, newline=""))
    found: list[str] = []
    waiting = False
    depth = 0
    start = (0, 0)
    for token in tokenize.generate_tokens(iter([*lines, ""]).__next__):
        if token.type == tokenize.NAME and token.string == "def":
            waiting, depth = True, 0
        elif waiting and token.type == tokenize.OP:
            if token.string in "([{":
                if depth == 0 and token.string == "(":
                    start = token.start
                    depth = 1
                else:
                    depth += 1
            elif token.string in ")]}":
                depth -= 1
                if depth == 0 and token.string == ")":
                    (top, left), (bottom, right) = start, token.end
                    if top == bottom:
                        found.append(lines[top - 1][left:right])
                    else:
                        middle = lines[top : bottom - 1]
                        found.append(
                            "".join([lines[top - 1][left:], *middle, lines[bottom - 1][:right]])
                        )
                    waiting = False
    return found


def _callee(call: ast.Call, source: _Source) -> str:
    """`name` or `object.attribute` as written, anything else is empty."""
    func = call.func
    if (func.lineno, func.col_offset) != (call.lineno, call.col_offset):
        return ""
    if isinstance(func, ast.Name):
        return func.id
    if isinstance(func, ast.Attribute):
        owner = source.of(func).removesuffix(func.attr).rstrip().removesuffix(".").rstrip()
        return f"{owner}.{func.attr}"
    return ""


def _import_facts(tree: ast.Module) -> Iterator[dict]:
    """Top-level imports in order; a star binds nothing."""
    order = 0
    for node in tree.body:
        if isinstance(node, ast.Import):
            for item in node.names:
                binding = item.asname or item.name.split(".")[-1]
                yield _import(order, node, "module", item.name, None, binding)
                order += 1
        elif isinstance(node, ast.ImportFrom) and node.module != "__future__":
            spec = "." * node.level + (node.module or "")
            for item in node.names:
                star = item.name == "*"
                binding = None if star else item.asname or item.name
                yield _import(order, node, "from", spec, item.name, binding)
                order += 1


def _import(order, node, form, spec, imported, binding) -> dict:
    return {
        "fact": "import", "ord": order, "line": node.lineno, "form": form, "module_spec": spec,
        "imported_name": imported, "binding_name": binding,
    }


def _tree_facts(tree: ast.Module, source: _Source, text: str) -> Iterator[dict]:
    """Definitions, bases and calls.

    Containers of definitions and calls are all enclosing classes and functions, those of bases only
    classes. A call counts for every function around it, each with the containers of that function.
    """
    # (node, enclosing names, enclosing classes, functions around it as (name, containers))
    stack: list[tuple[ast.AST, tuple, tuple, tuple]] = [(tree, (), (), ())]
    definitions, bases, calls = [], [], []
    while stack:
        node, names, classes, functions = stack.pop()
        inner, inner_classes, inside = names, classes, functions
        if isinstance(node, ast.ClassDef):
            inner, inner_classes = (*names, node.name), (*classes, node.name)
            definitions.append((node, inner, "class"))
            for base in node.bases:
                if isinstance(base, (ast.Name, ast.Attribute)):
                    bases.append((node, inner_classes, classes, source.of(base), base))
        elif isinstance(node, _FUNCTIONS):
            inner = (*names, node.name)
            definitions.append((node, inner, "method" if names else "function"))
            inside = (*functions, (".".join(inner), names))
        elif isinstance(node, ast.Call):
            raw = _callee(node, source)
            calls += [(node, name, containers, raw) for name, containers in functions]
        decorators = getattr(node, "decorator_list", ())
        for child in ast.iter_child_nodes(node):
            if isinstance(child, _LEAVES):
                continue
            # A decorator belongs to what surrounds the definition.
            if decorators and child in decorators:
                stack.append((child, names, classes, functions))
            else:
                stack.append((child, inner, inner_classes, inside))

    def place(item):
        return item[0].lineno, item[0].col_offset

    definitions.sort(key=place)
    functions_only = [node for node, _, kind in definitions if kind != "class"]
    signatures = dict(zip(map(id, functions_only), _parameter_texts(text), strict=True))
    for order, (node, path, kind) in enumerate(definitions, start=1):
        signature = signatures.get(id(node), "")
        yield {
            "fact": "def", "ord": order, "line": node.lineno, "name": path[-1],
            "qualified_name": ".".join(path), "kind": kind, "signature": signature,
        }
    ordered = sorted(bases, key=lambda b: (b[4].lineno, b[4].col_offset))
    for order, (node, path, containers, base, _) in enumerate(ordered):
        yield {
            "fact": "base", "ord": order, "line": node.lineno, "qualified_name": ".".join(path),
            "containers": list(containers), "raw_name": base, "kind": "EXTENDS",
        }
    for order, (node, name, containers, raw) in enumerate(sorted(calls, key=place)):
        yield {
            "fact": "call", "ord": order, "line": node.lineno, "qualified_name": name,
            "containers": list(containers), "raw_name": raw,
        }


def file_facts(text: str) -> list[dict]:
    """All facts of one Python file; raises on text that is no Python."""
    text = text.removeprefix("\ufeff")
    tree = ast.parse(text)
    return [*_import_facts(tree), *_tree_facts(tree, _Source(text), text)]


def _batch_of(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([row.get(f.name) for row in rows], f.type) for f in FACT_SCHEMA]
    return pa.RecordBatch.from_arrays(columns, schema=FACT_SCHEMA)


def _facts_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[dict] = []
        for file in batch.to_pylist():
            try:
                facts = file_facts(file["content"])
            except Exception as error:  # one bad file must not stop the others
                facts = [{"fact": "error", "error": f"{type(error).__name__}: {error}"}]
            rows += [{"project": file["project"], "file": file["path"], **fact} for fact in facts]
            if len(rows) >= OUTPUT_ROWS:
                yield _batch_of(rows)
                rows = []
        if rows:
            yield _batch_of(rows)


def facts_table(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """All facts of the Python files as one table, `fact` telling the kind.

    Parsing costs far more time per byte than scanning: `partitions` spreads files that come in
    fewer or uneven partitions.
    """
    python = files.filter(language_of(extension_of("path")) == "python")
    if partitions:
        python = python.repartition(partitions, "project", "path")
    return python.select("project", "path", "content").mapInArrow(_facts_of_batches, FACTS)


def split_facts(facts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    def kind(name: str, *columns: str) -> DataFrame:
        return facts.filter(F.col("fact") == name).select("project", "file", *columns)

    defs = kind("def", "ord", "name", "qualified_name", "kind", "line", "signature").withColumn(
        "language", F.lit("python")
    )
    imports = kind(
        "import", "ord", "line", "form", "module_spec", "imported_name", "binding_name"
    )
    bases = kind("base", "ord", "qualified_name", "containers", "raw_name", "kind", "line")
    bases = bases.withColumnsRenamed(
        {"qualified_name": "class_qname", "raw_name": "base_name", "kind": "relation"}
    )
    calls = kind("call", "ord", "qualified_name", "containers", "raw_name", "line")
    calls = calls.withColumnRenamed("qualified_name", "src_qname")
    return defs, imports, bases, calls, kind("error", "error")


def extract_facts(
    files: DataFrame, partitions: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(defs, imports, bases, calls, errors). Files are parsed once and the facts written."""
    return split_facts(cut(facts_table(files, partitions)))


def healthy_files(files: DataFrame, errors: DataFrame) -> DataFrame:
    """Files that could be read; a failing file leaves no rows anywhere."""
    failing = errors.select("project", F.col("file").alias("path")).distinct()
    return files.join(grown(failing), ["project", "path"], "left_anti").select(*files.columns)
