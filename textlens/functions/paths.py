"""One path language for nested rows: names, numbers (positions from 0), * for every list element.

``get`` gives the value at a path, an array where the path has a star (nulls dropped, nested arrays
flat); a missing position gives null. ``put`` rewrites the texts at a path in place and keeps the row's
shape. Both are expressions built from the schema, so Parquet reads only the fields named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _parts(path: str) -> list[str]:
    return [p for p in path.replace("[", ".").replace("]", "").split(".") if p]


def get(df: DataFrame, path: str) -> Column:
    def walk(c: Column, t: T.DataType, parts: list[str]) -> tuple[Column, T.DataType]:
        if not parts:
            return c, t
        p, rest = parts[0], parts[1:]
        if isinstance(t, T.ArrayType):
            if p.isdigit():
                return walk(F.get(c, F.lit(int(p))), t.elementType, rest)
            if p != "*":
                rest = parts
            inner: list[T.DataType] = []

            def each(x: Column) -> Column:
                v, vt = walk(x, t.elementType, rest)
                inner.append(vt)
                return v

            out = F.filter(F.transform(c, each), lambda v: v.isNotNull())
            if isinstance(inner[0], T.ArrayType) and "*" in rest:
                return F.flatten(out), inner[0]
            return out, T.ArrayType(inner[0])
        if not isinstance(t, T.StructType) or p not in t.names:
            raise ValueError(f"{path}: no field {p} in {t.simpleString()}")
        return walk(c[p], t[p].dataType, rest)

    first, *rest = _parts(path)
    return walk(F.col(first), df.schema[first].dataType, rest)[0]


def put(df: DataFrame, path: str, f: Callable[[Column], Column]) -> Column:
    """The top-level column of ``path`` with f applied to every text at the path."""

    def walk(c: Column, t: T.DataType, parts: list[str]) -> Column:
        if not parts:
            return F.transform(c, f) if isinstance(t, T.ArrayType) else f(c)
        p, rest = parts[0], parts[1:]
        if isinstance(t, T.ArrayType):
            if p.isdigit():
                return F.transform(c, lambda x, i: F.when(i == int(p), walk(x, t.elementType, rest)).otherwise(x))
            return F.transform(c, lambda x: walk(x, t.elementType, rest if p == "*" else parts))
        return F.when(c.isNotNull(), c.withField(p, walk(c[p], t[p].dataType, rest)))

    first, *rest = _parts(path)
    return walk(F.col(first), df.schema[first].dataType, rest)


def leaves(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Array of (path, value as text) of every leaf; list levels are written *. Nulls keep a leaf, empty lists give none."""
    kind = "array<struct<path:string,value:string>>"

    def walk(c: Column, t: T.DataType, path: str) -> Column:
        if isinstance(t, T.StructType):
            inside = F.concat(*[walk(c[f.name], f.dataType, f"{path}.{f.name}") for f in t.fields])
            return F.when(c.isNull(), F.array(F.struct(F.lit(path).alias("path"), F.lit(None).cast("string").alias("value")))).otherwise(inside)
        if isinstance(t, T.ArrayType):
            each = F.flatten(F.transform(c, lambda x: walk(x, t.elementType, f"{path}.*")))
            return F.when(c.isNull(), F.array(F.struct(F.lit(path).alias("path"), F.lit(None).cast("string").alias("value")))).otherwise(each)
        return F.array(F.struct(F.lit(path).alias("path"), c.cast("string").alias("value")))

    return F.concat(*[F.coalesce(walk(F.col(n), df.schema[n].dataType, n), F.array().cast(kind)) for n in columns or df.columns])
