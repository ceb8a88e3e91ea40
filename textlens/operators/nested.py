"""Nested records into related flat tables, by Merkle subtree identities.

Every object of a record is canonicalised (fields in name order, nulls left out, child objects
replaced by their identities) and hashed bottom-up, so two equal subtrees have one identity
wherever they occur. ``shred`` returns

* ``roots``   (key columns, root_id): one row per record; identities are SHA-256 digests (binary),
* ``bridges`` (parent_id, slot, ordinal, child_id): every occurrence of a child in a parent, the
  ordinal counts from 0 with null elements keeping their place, -1 for a lone object,
* ``objects`` (object_id, kind, body): every distinct object once, body is its canonical JSON.

Since an identity fixes the whole subtree, the bridges of a parent are stored once as well, however
many records hold it. ``descend`` walks from the roots down a path and gives the ordinals back.

Nulls: a null list or object has no rows. Null elements have none either but count as places.
Empty objects are objects (body ``{}``). Repeated rows give repeated roots; objects and bridges
stay distinct. Empty input gives three empty tables. Extra columns are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from textlens.session import written


@dataclass(frozen=True)
class Shredded:
    roots: DataFrame
    bridges: DataFrame
    objects: DataFrame


def _is_objects(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def _let(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


_EDGE = "struct<parent_id:binary,slot:string,ordinal:int,child_id:binary,kind:string,body:string>"


def _occurrence(parent: Column, slot: str, kind: str):
    return lambda e, i: F.when(
        e.isNotNull(),
        F.struct(parent.alias("parent_id"), F.lit(slot).alias("slot"), i.cast("int").alias("ordinal"), F.unhex(e["id"]).alias("child_id"), F.lit(kind).alias("kind"), e["body"].alias("body")),
    )


def _node(x: Column, t: T.StructType, kind: str) -> Column:
    """struct<id, body, below> of an object: identity (hex), canonical JSON, and all occurrences below it.

    One pass from the leaves up: every object is written as JSON and hashed once, its parents take the identity.
    """
    kids = [f for f in t.fields if isinstance(f.dataType, T.StructType) or _is_objects(f.dataType)]
    name = lambda f: f"{kind}.{f.name}" if kind else f.name

    def made(known: Column | None) -> Column:
        def value(f):
            if f not in kids:
                return x[f.name]
            return known[f.name]["id"] if isinstance(f.dataType, T.StructType) else F.transform(known[f.name], lambda e: e["id"])

        body = F.to_json(F.struct(*[value(f).alias(f.name) for f in sorted(t.fields, key=lambda f: f.name)]), {"ignoreNullFields": "true"})
        return _let(body, lambda b: _let(F.sha2(b, 256), lambda i: F.struct(i.alias("id"), b.alias("body"), below(known, F.unhex(i)).alias("below"))))

    def below(known: Column | None, parent: Column) -> Column:
        parts = []
        for f in kids:
            row = _occurrence(parent, f.name, name(f))
            v = known[f.name]
            if isinstance(f.dataType, T.StructType):
                parts += [F.when(v.isNotNull(), F.array(row(v, F.lit(-1)))), v["below"]]
            else:
                parts.append(F.filter(F.transform(v, row), lambda r: r.isNotNull()))
                if any(isinstance(g.dataType, T.StructType) or _is_objects(g.dataType) for g in f.dataType.elementType.fields):
                    parts.append(F.flatten(F.transform(F.filter(v, lambda e: e.isNotNull()), lambda e: e["below"])))
        none = F.array().cast(f"array<{_EDGE}>")
        return F.concat(*[F.coalesce(p, none) for p in parts]) if parts else none

    if not kids:
        return F.when(x.isNotNull(), made(None))
    inner = lambda f: lambda e: _node(e, f.dataType.elementType, name(f))
    each = [(_node(x[f.name], f.dataType, name(f)) if isinstance(f.dataType, T.StructType) else F.transform(x[f.name], inner(f))).alias(f.name) for f in kids]
    return F.when(x.isNotNull(), _let(F.struct(*each), made))


def shred(records: DataFrame, keys: list[str], columns: list[str]) -> Shredded:
    """Shred the nested ``columns`` of ``records``; ``keys`` identify a record and are kept in roots.

    Records are hashed once and written (shared folder); the three tables read what they need of it.
    """
    t = T.StructType([records.schema[c] for c in columns])
    held = records.select(*keys, F.struct(*[F.col(c) for c in columns]).alias("_record"))
    node = held.select(*keys, _node(F.col("_record"), t, "").alias("_n"))
    hashed = written(node.select(*keys, F.unhex("_n.id").alias("root_id"), F.col("_n.below").alias("_edges")), "shredded")
    rows = hashed.select(F.explode("_edges").alias("r")).select("r.*")
    bridges = rows.select("parent_id", "slot", "ordinal", "child_id").distinct()
    # The kind is part of the key: an empty designation and an empty definition are two objects.
    objects = rows.select(F.col("child_id").alias("object_id"), "kind", "body").distinct()
    return Shredded(hashed.select(*keys, "root_id"), bridges, objects)


def descend(s: Shredded, path: list[str]) -> DataFrame:
    """Roots joined down the slots of ``path``: the key columns, ``object_id`` and an array ``ordinals``."""
    at = s.roots.withColumnRenamed("root_id", "object_id").withColumn("ordinals", F.array().cast("array<int>"))
    for slot in path:
        step = s.bridges.where(F.col("slot") == slot).select(F.col("parent_id").alias("object_id"), "ordinal", "child_id")
        at = (
            at.join(step, "object_id")
            .withColumn("ordinals", F.concat("ordinals", F.array("ordinal")))
            .drop("object_id", "ordinal")
            .withColumnRenamed("child_id", "object_id")
        )
    return at


def field_values(s: Shredded, keys: list[str], path: list[str], fields: list[str]) -> DataFrame:
    """(keys, field_path, text): one row for each non-blank text field of each occurrence at path."""
    kind = ".".join(path)
    values = s.objects.where(F.col("kind") == kind).select(
        "object_id",
        F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.get_json_object("body", f"$.{f}").alias("text")) for f in fields])).alias("v"),
    ).select("object_id", "v.f", "v.text").where(F.expr(r"text is not null and not text rlike '(?U)^\\s*$'"))
    places = [
        F.concat(F.lit(slot), F.when(F.get("ordinals", F.lit(i)) >= 0, F.concat(F.lit("["), F.get("ordinals", F.lit(i)), F.lit("]"))).otherwise(""))
        for i, slot in enumerate(path)
    ]
    # values is unique by object_id; a hot object (a common answer) sits on the left, where AQE splits it.
    return descend(s, path).join(values, "object_id").select(*keys, F.concat_ws(".", *places, "f").alias("field_path"), "text")


def latest_version(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of the highest version of each key; rows without key are left out, equal rows stay once.

    The highest version is found by a partial aggregate, so a key with very many versions is combined
    before it moves; no window sorts a key's records.
    """
    df = df.where(F.col(key).isNotNull())
    top = df.groupBy(F.col(key).alias("_k")).agg(F.max(version).alias("_v"))
    return df.join(top, (F.col(key) == F.col("_k")) & F.col(version).eqNullSafe(F.col("_v"))).drop("_k", "_v")


LABEL = T.StructType([T.StructField(n, T.StringType()) for n in ("designation",)] + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("sources", "tags")])
MEANING = T.StructType([T.StructField("definition", T.StringType()), T.StructField("definitionFormat", T.StringType())] + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("sources", "tags")])
VALUE = T.StructType([T.StructField(n, T.StringType()) for n in ("permissibleValue", "valueMeaningName", "valueMeaningDefinition", "valueMeaningCode", "codeSystemName", "codeSystemVersion", "conceptId", "conceptSource")])
DOMAIN = T.StructType([T.StructField(n, T.StringType()) for n in ("datatype", "name", "definition", "uom", "vsacOid")] + [T.StructField("permissibleValues", T.ArrayType(VALUE))])
RECORD = T.StructType([
    T.StructField("tinyId", T.StringType()), T.StructField("__v", T.LongType()),
    T.StructField("designations", T.ArrayType(LABEL)), T.StructField("definitions", T.ArrayType(MEANING)), T.StructField("valueDomain", DOMAIN),
])


def _listed(v, field: str):
    """A list of objects or nulls; a lone object is a list of one, a bare text an object with that text."""
    if v is None:
        return None
    return [{field: e} if isinstance(e, str) else e if isinstance(e, dict) else None for e in (v if isinstance(v, list) else [v])]


def _texts(o: dict | None, names: tuple[str, ...]) -> dict | None:
    if o is None:
        return None
    out = {n: o[n] if isinstance(o[n], str) else json.dumps(o[n]) for n in names if o.get(n) is not None}
    for n in ("sources", "tags"):
        if isinstance(o.get(n), (list, str)):
            out[n] = [x for x in (o[n] if isinstance(o[n], list) else [o[n]]) if isinstance(x, str) or x is None]
    return out


def _no_constant(x: str):
    raise ValueError(f"{x} is not JSON")


def records_in(payload: str | None) -> list[str]:
    """The records in a JSON text in one regular shape, as JSON; nothing if the text is not valid JSON."""
    try:
        top = json.loads(payload, parse_constant=_no_constant)
    except (ValueError, TypeError, RecursionError):
        return []
    out, todo = [], [top]
    while todo:
        v = todo.pop(0)
        if isinstance(v, list):
            todo = v + todo
        elif isinstance(v, dict):
            if {"tinyId", "designations", "definitions", "valueDomain"} & v.keys():
                domain = v.get("valueDomain")
                r = {
                    "tinyId": v.get("tinyId") if isinstance(v.get("tinyId"), str) else None,
                    "__v": v.get("__v") if isinstance(v.get("__v"), int) else None,
                    "designations": (a := _listed(v.get("designations"), "designation")) and [_texts(e, ("designation",)) for e in a],
                    "definitions": (a := _listed(v.get("definitions"), "definition")) and [_texts(e, ("definition", "definitionFormat")) for e in a],
                }
                if isinstance(domain, dict):
                    values = _listed(domain.get("permissibleValues"), "permissibleValue")
                    r["valueDomain"] = _texts(domain, tuple(f.name for f in DOMAIN if f.name != "permissibleValues")) | {"permissibleValues": values and [_texts(e, tuple(VALUE.names)) for e in values]}
                out.append(json.dumps(r))
            else:
                todo = [x for x in v.values() if isinstance(x, (dict, list))] + todo
    return out


def parse_records(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON payloads as typed rows of RECORD, whatever wrapper they come in.

    Broken JSON and nulls give no rows. Python only reads the irregular shapes; typing is from_json's.
    """

    @F.pandas_udf("array<string>")
    def regular(s):
        return s.map(records_in)

    return raw.select(F.explode(regular(F.col(payload))).alias("j")).select(F.from_json("j", RECORD).alias("r")).select("r.*")
