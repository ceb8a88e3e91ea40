"""Projections of nested records: field texts, names and questions, value lists, embedding text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from textlens.functions import paths, text as tx

# Tags that tell questions and names (fixed values).
QUESTION_TAGS, NAME_TAGS = "Question", "Primary Name|Long Common Name|Short Name|Shortname"


def field_texts(items: DataFrame, key: str = "tinyId") -> DataFrame:
    """(tinyId, field, idx, field_path, text) of non-blank texts; rows without key are left out.

    A narrow plan: one pass, no shuffle; Parquet reads the four text fields only.
    """
    one = lambda array, field, prefix: F.transform(array, lambda e, i: F.struct(F.lit(field).alias("field"), i.cast("int").alias("idx"), F.concat(F.lit(prefix + "["), i, F.lit(f"].{field}")).alias("field_path"), e[field].alias("text")))
    values = F.col("valueDomain.permissibleValues")
    parts = [one(F.col("designations"), "designation", "designations"), one(F.col("definitions"), "definition", "definitions")]
    parts += [one(values, f, "valueDomain.permissibleValues") for f in ("valueMeaningName", "valueMeaningDefinition")]
    kind = "array<struct<field:string,idx:int,field_path:string,text:string>>"
    rows = items.where(F.col(key).isNotNull()).select(key, F.explode(F.concat(*[F.coalesce(p, F.array().cast(kind)) for p in parts])).alias("t"))
    return rows.select(key, "t.*").where("text is not null and trim(text) <> ''")


def name_and_question(designations: Column) -> Column:
    """struct<name, question>: first designation with a matching tag, else the first and the second."""

    def tagged(pattern: str) -> Column:
        found = F.filter(designations, lambda d: F.exists(d["tags"], lambda t: t.rlike(pattern)) & d["designation"].isNotNull())
        return F.get(found, F.lit(0))["designation"]

    second = F.get(designations, F.lit(1))["designation"]
    first = F.get(designations, F.lit(0))["designation"]
    return F.struct(F.coalesce(tagged(NAME_TAGS), first).alias("name"), F.coalesce(tagged(QUESTION_TAGS), second).alias("question"))


def _plain(c: Column) -> Column:
    return F.coalesce(tx.flatten_lines(F.trim(c)), F.lit(""))


def simplified_values(values: Column) -> Column:
    """struct<values, meanings>: permissible values and their meanings joined by ``;; ``.

    The definition of a meaning goes before its name; meanings equal to the value and bare number lists
    are blank.
    """
    value = F.filter(F.transform(values, lambda v: _plain(v["permissibleValue"])), lambda s: s != "")

    def meaning(v: Column) -> Column:
        m = _plain(F.coalesce(F.nullif(v["valueMeaningDefinition"], F.lit("")), v["valueMeaningName"]))
        return F.when(m == _plain(v["permissibleValue"]), "").otherwise(m)

    joined = lambda a: F.array_join(F.coalesce(a, F.array().cast("array<string>")), ";; ")
    blank = lambda s: F.when(s.rlike(r"(?:\d+;;\s*)+\d+"), "").otherwise(s)
    return F.struct(blank(joined(value)).alias("values"), blank(joined(F.filter(F.transform(values, meaning), lambda s: s != ""))).alias("meanings"))


def embed_text(df: DataFrame, schema: dict[str, str], separator: str = " :--: ") -> list[Column]:
    """Columns of a tag -> path schema, lists joined by ``;; ``, and ``embed_text`` of the non-empty parts."""
    cols = []
    for tag, path in schema.items():
        c = paths.get(df, path)
        if isinstance(df.select(c).schema[0].dataType, T.ArrayType):
            c = F.array_join(F.transform(c, _plain), ";; ")
        cols.append(_plain(c).alias(tag))
    return [*cols, F.concat_ws(separator, *[F.nullif(c, F.lit("")) for c in cols]).alias("embed_text")]


def without_leading_underscore(df: DataFrame, prefix: str = "x") -> DataFrame:
    """Fields that begin with an underscore get a prefix, at every depth; data move by cast only."""

    def fix(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(prefix + f.name if f.name.startswith("_") else f.name, fix(f.dataType)) for f in t.fields])
        return T.ArrayType(fix(t.elementType)) if isinstance(t, T.ArrayType) else t

    return df.select(*[F.col(f"`{f.name}`").cast(fix(f.dataType)).alias(prefix + f.name if f.name.startswith("_") else f.name) for f in df.schema.fields])


EMBED_NAMES = {"Name": "name", "Question": "question", "Definition": "definition", "Pv1": "values", "Pv2": "meanings"}


def renamed(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """df with its columns renamed, case aside; names that it lacks are passed over, a clash raises."""
    by_lower = {c.lower(): c for c in df.columns}
    wanted = {by_lower[old.lower()]: new for old, new in (EMBED_NAMES if names is None else names).items() if old.lower() in by_lower}
    after = [wanted.get(c, c) for c in df.columns]
    if len({c.lower() for c in after}) < len(after):
        raise ValueError(f"renaming gives two columns one name: {after}")
    return df.withColumnsRenamed(wanted)


def joined_objects(objects: Column, fields: list[str], separator: str = ";; ") -> Column:
    """A struct with the texts of each field over a list of objects, joined; a field without texts is empty."""
    return F.struct(*[F.array_join(F.filter(F.coalesce(F.transform(objects, _field(f)), F.array().cast("array<string>")), lambda s: s != ""), separator).alias(f) for f in fields])


def _field(name: str):
    return lambda o: _plain(o[name])


def concatenated(df: DataFrame, key: str, only: list[str] | None = None, without: list[str] = (), separator: str = " ", skip_empty: bool = False) -> DataFrame:
    """(key, text): the columns of ``only`` (by default all but the key) without those of ``without``, trimmed and joined; empty parts are left out.

    With skip_empty rows without any text are left out as well. Unknown names raise.
    """
    unknown = {*(only or ()), *without} - set(df.columns)
    if unknown:
        raise ValueError(f"no columns {sorted(unknown)}; there are {df.columns}")
    cols = [c for c in (only or [c for c in df.columns if c != key]) if c not in without]
    text = F.concat_ws(separator, *[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in cols])
    out = df.select(F.col(key), text.alias("text"))
    return out.where("text <> ''") if skip_empty else out
