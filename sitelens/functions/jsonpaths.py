"""Flattening of JSON documents in Arrow batches.

Spark's VARIANT functions explode one level at a time; documents of unknown
depth are walked next to the data, one batch of documents a call.  All joins,
ordering and merging happen in Spark afterwards.
"""

from __future__ import annotations

import json

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def kind_of(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "string"
    if isinstance(v, list):
        return "array"
    return "object"


def _num(v):
    if isinstance(v, float) and v.is_integer() and abs(v) < 2 ** 53:
        return int(v)
    return v


def canonical(v) -> str:
    """JSON text with sorted keys and integral floats as integers, so values
    that Python's ``==`` treats as equal map to one string (``1 == 1.0``;
    object key order ignored).  ``true`` and ``1`` stay distinct."""
    def norm(x):
        if isinstance(x, dict):
            return {k: norm(x[k]) for k in sorted(x)}
        if isinstance(x, list):
            return [norm(i) for i in x]
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return x
        return _num(x)
    return json.dumps(norm(v), ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def scalar_text(v) -> str | None:
    """Leaf value as text: strings raw, JSON null as NULL, others canonical."""
    if v is None:
        return None
    if isinstance(v, str):
        return v
    return canonical(v)


def parse_object(text: str | None) -> dict:
    """The document as an object, with the reason as a ``ValueError`` otherwise.

    Accepted is what Python's reader accepts: of repeated keys the last counts."""
    try:
        doc = json.loads(text)
    except json.JSONDecodeError:
        raise
    except TypeError:
        raise ValueError("no document") from None
    except RecursionError:
        raise ValueError("nested too deeply") from None
    if not isinstance(doc, dict):
        raise ValueError("not an object")
    return doc


def walk(doc: dict, into_lists: bool) -> Iterator[tuple[tuple, object]]:
    """(path, value) of everything below a document, parents first, in document
    order, on an explicit stack.  A path holds keys and list positions; a list
    inside a list is not opened."""
    todo = [((key,), value) for key, value in reversed(doc.items())]
    while todo:
        path, value = todo.pop()
        yield path, value
        if isinstance(value, dict):
            below = value.items()
        elif into_lists and isinstance(value, list) and isinstance(path[-1], str):
            below = enumerate(value)
        else:
            continue
        todo.extend([((*path, step), child) for step, child in below][::-1])


def rendered(path: tuple) -> str:
    return "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in path)[1:]


def leaves(text: str | None) -> list[tuple[str, str, str | None, int]]:
    """(field path, kind, value, place) of a document's leaves; no rows without an object.

    Objects and lists are opened, lists in lists are leaves; what is empty has none."""
    try:
        found = [(path, value) for path, value in walk(parse_object(text), into_lists=True)
                 if not isinstance(value, dict) and (not isinstance(value, list) or isinstance(path[-1], int))]
        return [(rendered(path), kind_of(value), scalar_text(value), place)
                for place, (path, value) in enumerate(found)]
    except (ValueError, RecursionError):
        return []


def schema_paths(program: dict) -> list[tuple[list[str], str, int]]:
    """(path, kind, place) of every key of a schema, objects opened."""
    return [(list(path), kind_of(value), place) for place, (path, value) in enumerate(walk(program, into_lists=False))]


def json_leaves(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``field_path, kind, value, ord`` of each leaf of the JSON column."""
    def flatten(batches):
        for pdf in batches:
            per_row = [leaves(t) for t in pdf[column]]
            at = [k for k, rows in enumerate(per_row) for _ in rows]
            out = pd.DataFrame([r for rows in per_row for r in rows], columns=["field_path", "kind", "value", "ord"])
            yield pd.concat([pdf[keep].iloc[at].reset_index(drop=True), out], axis=1)

    schema = T.StructType([df.schema[c] for c in keep] + [
        T.StructField("field_path", T.StringType()), T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()), T.StructField("ord", T.IntegerType())])
    return df.select(*keep, column).mapInPandas(flatten, schema)


NODE_SCHEMA = ("path array<string>, depth int, kind string, value string, truthy boolean, "
               "items array<struct<kind:string,value:string,canon:string>>, error string, position int")
#: Characters of a broken document that its error row shows on either side.
AROUND = 50


def nodes(text: str | None, fill: list[str]) -> list[tuple]:
    """Every node reachable through object keys, in the order of ``NODE_SCHEMA``.

    Lists are atomic: their items are listed.  Keys of ``fill`` that the document
    lacks are empty objects.  A text without an object is one row with the error,
    its position and the text around it."""
    try:
        doc = parse_object(text)
        rows = [((k,), {}) for k in fill if k not in doc] + list(walk(doc, into_lists=False))
        out = []
        for path, value in rows:
            kind = kind_of(value)
            items = [{"kind": kind_of(i), "value": scalar_text(i), "canon": canonical(i)} for i in value] \
                if kind == "array" else None
            out.append((list(path), len(path), kind, None if kind in ("object", "array") else scalar_text(value),
                        bool(value), items, None, None))
        return out
    except json.JSONDecodeError as e:
        around = text[max(0, e.pos - AROUND):e.pos + AROUND]
        return [(None, 0, "error", around, False, None, f"invalid JSON: {e.msg}", e.pos)]
    except RecursionError:
        return [(None, 0, "error", text[:2 * AROUND], False, None, "nested too deeply", 0)]
    except ValueError as e:
        return [(None, 0, "error", (text or "")[:2 * AROUND], False, None, str(e), 0)]


def json_nodes(df: DataFrame, column: str, keep: list[str], fill: list[str]) -> DataFrame:
    """``keep`` and ``NODE_SCHEMA`` of each node of the JSON column, error rows included."""
    names = ["path", "depth", "kind", "value", "truthy", "items", "error", "position"]

    def flatten(batches):
        for pdf in batches:
            per_row = [nodes(t, fill) for t in pdf[column]]
            at = [k for k, rows in enumerate(per_row) for _ in rows]
            out = pd.DataFrame([r for rows in per_row for r in rows], columns=names)
            out["position"] = out["position"].astype("Int32")
            yield pd.concat([pdf[keep].iloc[at].reset_index(drop=True), out], axis=1)

    schema = T.StructType([df.schema[c] for c in keep] + T.StructType.fromDDL(NODE_SCHEMA).fields)
    return df.select(*keep, column).mapInPandas(flatten, schema)
