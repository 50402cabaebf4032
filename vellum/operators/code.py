"""Chunks of source code: functions and classes with the imports that they use, and the rest."""

from __future__ import annotations

import ast
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = "seq long, type string, name string, docstring string, start_line int, end_line int, sha256 string, text string"
#: Words of comments that are licences, not code.
LICENCE = ("copyright", "license", "licensed under", "all rights reserved")


def _imports(tree: ast.Module, lines: list[str]) -> list[tuple[set[str], str]]:
    out = []
    for node in tree.body:
        if isinstance(node, (ast.Import, ast.ImportFrom)):
            names = {(a.asname or a.name).split(".")[0] for a in node.names}
            out.append((names, "\n".join(lines[node.lineno - 1 : node.end_lineno])))
    return out


def chunks_of(code: str) -> list[tuple]:
    """Chunks of a Python module; code that doesn't parse is one block."""
    lines = code.split("\n")

    def chunk(kind: str, name: str, doc: str | None, first: int, last: int, text: str) -> tuple:
        return kind, name, doc, first, last, hashlib.sha256(text.encode()).hexdigest(), text

    try:
        tree = ast.parse(code)
    except (SyntaxError, ValueError, RecursionError):
        return [chunk("code_block", "", None, 1, len(lines), code)] if code.strip() else []
    imports, used, out = _imports(tree, lines), set(), []

    def body(node: ast.AST) -> tuple[int, int]:
        first = min([node.lineno, *[d.lineno for d in getattr(node, "decorator_list", [])]])
        return first, node.end_lineno

    def needed(node: ast.AST) -> str:
        names = {n.id for n in ast.walk(node) if isinstance(n, ast.Name)}
        return "\n".join(sorted(text for given, text in imports if given & names or "*" in given))

    def function(node: ast.AST, kind: str, owner: ast.ClassDef | None = None) -> None:
        first, last = body(node)
        used.update(range(first, last + 1))
        head = lines[body(owner)[0] - 1 : owner.lineno] if owner else []
        text = "\n".join(x for x in (needed(node), *head, "\n".join(lines[first - 1 : last])) if x)
        name = f"{owner.name}.{node.name}" if owner else node.name
        out.append(chunk(kind, name, ast.get_docstring(node), first, last, text))

    for node in tree.body:
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            function(node, "function")
        elif isinstance(node, ast.ClassDef):
            methods = [m for m in node.body if isinstance(m, (ast.FunctionDef, ast.AsyncFunctionDef))]
            shown = [m for m in methods if m.name != "__init__"] or methods
            for m in shown:
                function(m, "method", node)
            first, last = body(node)
            if not methods:
                text = "\n".join(x for x in (needed(node), "\n".join(lines[first - 1 : last])) if x)
                out.append(chunk("class", node.name, ast.get_docstring(node), first, last, text))
            used.update(range(first, last + 1))
    licence = lambda x: x.lstrip().startswith("#") and any(w in x.lower() for w in LICENCE)
    rest = [k for k in range(1, len(lines) + 1) if k not in used and lines[k - 1].strip() and not licence(lines[k - 1])]
    if rest:
        text = "\n".join(lines[k - 1] for k in rest)
        out.insert(0, chunk("preamble", "", ast.get_docstring(tree), rest[0], rest[-1], text))
    return out


def code_chunks(files: DataFrame, key: str, code: str, language: str | None = None) -> DataFrame:
    """One row a chunk. Languages other than Python are one block a file.

    ``language`` names the column that says which it is; without one all files are Python.
    """
    columns = [key, code, *([language] if language else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in CHUNK.split(", ")]
        kinds = [pa.int64(), *[pa.string()] * 3, pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            owner, rows = [], []
            kind = batch.column(2).to_pylist() if language else ["python"] * batch.num_rows
            for k, (text, lang) in enumerate(zip(batch.column(1).to_pylist(), kind, strict=True)):
                text = text or ""
                if (lang or "").lower() == "python":
                    found = chunks_of(text)
                else:
                    digest = hashlib.sha256(text.encode()).hexdigest()
                    found = [("code_block", "", None, 1, text.count("\n") + 1, digest, text)] if text.strip() else []
                rows += [(seq, *x) for seq, x in enumerate(found)]
                owner += [k] * len(found)
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *arrays], [key, *names])

    kind = files.schema[key].dataType.simpleString()
    return files.select(*columns).mapInArrow(run, f"{key} {kind}, {CHUNK}")
