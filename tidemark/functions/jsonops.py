"""Read and edit JSON held as text, JVM-side.

Reading goes through ``get_json_object`` with quoted steps, so keys may hold spaces
and dots.  Editing goes through variants: the values keep their own types and nesting, so
any depth can be edited without a Python function.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Session setting that lets the last of several equal keys win instead of raising.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _steps(path: Sequence[str | int]) -> str:
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in path)


def text_at(c: Column | str, *path: str | int) -> Column:
    """Text at a path; JSON null and a missing path both give NULL."""
    return F.get_json_object(_col(c), _steps(path))


def first_text(c: Column | str, *keys: str) -> Column:
    """First of several spellings of a top-level key that is present."""
    return F.coalesce(*[text_at(c, k) for k in keys])


def present(c: Column | str, *path: str | int) -> Column:
    """True only if the path exists and does not hold JSON null."""
    return text_at(c, *path).isNotNull()


def is_json(c: Column | str) -> Column:
    """Whether a text can be edited; NULL for NULL."""
    text = _col(c)
    return F.when(text.isNotNull(), F.try_parse_json(text).isNotNull())


def is_json_null(c: Column | str, *path: str | int) -> Column:
    """True if the path holds JSON null, false if it holds a value, NULL if missing."""
    v = F.try_variant_get(F.try_parse_json(_col(c)), _steps(path), "variant")
    return F.when(v.isNotNull(), F.is_variant_null(v))


# Editing works on variants.  Each level is opened once as a map (or array) of variants,
# changed by a higher-order function and closed again, so the size of the expression
# grows with the number of paths only and a text is parsed and written once.

_Edit = Callable[[Column], Column]


def _edited(c: Column | str, *edits: _Edit) -> Column:
    """Apply edits to a JSON text.

    Text that is no JSON raises: it can neither be edited nor pass, and a NULL would lose it.
    Route such rows elsewhere first with ``is_json``.  Of a repeated key the last value counts,
    for which the session needs ``REPEATED_KEYS`` on (``session.SETTINGS`` has it); without it such a text raises.
    """
    cell = F.array(F.parse_json(_col(c)))
    for edit in edits:
        cell = F.transform(cell, edit)
    return F.to_json(F.get(cell, F.lit(0)))


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _tree(paths: Sequence[Sequence[str]]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for step in path[:-1]:
            node = node.setdefault(step, {})
            if node is None:
                break
        else:
            node[path[-1]] = None
    return root


def _pruned(v: Column, tree: dict) -> Column:
    gone = [k for k, sub in tree.items() if sub is None]
    deeper = {k: sub for k, sub in tree.items() if sub is not None}

    def descend(name: Column, x: Column) -> Column:
        out = x
        for k, sub in deeper.items():
            out = F.when(name == F.lit(k), _pruned(x, sub)).otherwise(out)
        return out

    level = F.map_filter(_as_map(v), lambda k, _: ~k.isin(gone)) if gone else _as_map(v)
    if deeper:
        level = F.transform_values(level, descend)
    candidates = [F.to_variant_object(level)]
    if any(k.isdigit() for k in tree):
        items = _as_array(v)
        if deeper:
            items = F.transform(items, lambda x, i: descend(i.cast("string"), x))
        if gone:
            items = F.filter(items, lambda _, i: ~i.cast("string").isin(gone))
        candidates.append(F.to_variant_object(items))
    return F.coalesce(*candidates, v)


def drop_keys(c: Column | str, *keys: str) -> Column:
    """Remove top-level keys from a JSON object; other JSON is left alone."""
    return drop_paths(c, [[k] for k in keys])


def drop_path(c: Column | str, *path: str) -> Column:
    """Remove what stands at a nested path; a missing path changes nothing."""
    return drop_paths(c, [path])


def drop_paths(c: Column | str, paths: Sequence[Sequence[str]]) -> Column:
    """Remove several paths in one pass.  Steps are object keys; digits also name array places."""
    return edit(c, drop=paths)


def _placed(v: Column, path: Sequence[str], value: Column) -> Column:
    head, rest = path[0], path[1:]
    if rest:
        level = F.transform_values(
            _as_map(v), lambda k, x: F.when(k == F.lit(head), _placed(x, rest, value)).otherwise(x))
    else:
        level = F.map_concat(F.map_filter(_as_map(v), lambda k, _: k != F.lit(head)), F.create_map(F.lit(head), value))
    return F.coalesce(F.to_variant_object(level), v)


def _placing(path: list[str], value: Column) -> _Edit:
    return lambda v: _placed(v, path, value)


def set_path(c: Column | str, path: Sequence[str], value_json: Column) -> Column:
    """Put JSON at an object path whose parents exist; otherwise nothing changes."""
    return edit(c, put={tuple(path): value_json})


def overlay(c: Column | str, fields: Mapping[str, Column]) -> Column:
    """Put named text values over a JSON object; a NULL value becomes JSON null."""
    return edit(c, over=fields)


def edit(c: Column | str, drop: Sequence[Sequence[str]] = (), over: Mapping[str, Column] | None = None,
         put: Mapping[Sequence[str], Column] | None = None) -> Column:
    """Drop paths, lay text fields over the top level, put JSON at paths: in this order,
    with the text parsed and written once."""
    edits: list[_Edit] = []
    if drop:
        tree = _tree(sorted(drop, key=len))
        edits.append(lambda v: _pruned(v, tree))
    if over:
        flat = [x for k, v in over.items() for x in (F.lit(k), _text_variant(v))]
        edits.append(lambda v: F.coalesce(F.to_variant_object(F.map_concat(
            F.map_filter(_as_map(v), lambda k, _: ~k.isin(list(over))), F.create_map(*flat))), v))
    for path, value_json in (put or {}).items():
        value = F.parse_json(F.coalesce(value_json, F.lit("null")))
        edits.append(_placing(list(path), value))
    return _edited(c, *edits)


def _text_variant(value: Column) -> Column:
    """A text as a variant; NULL as JSON null."""
    return F.coalesce(value.cast("string").cast("variant"), F.parse_json(F.lit("null")))


def build(fields: Mapping[str, Column]) -> Column:
    """A JSON object from named columns; NULLs are written as null."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
